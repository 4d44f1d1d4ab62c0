"""Queries over many forms of the same content. Their SQL tells results from how inputs are made, not from how they are read."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievemill.functions import literals, molecules
from sievemill.operators import curate, grade
from sievemill.plans.registry import dna, dna_sql, query, table


@query("""select p_partkey, case p_partkey % 9 when 2 then null when 6 then null when 7 then null when 8 then null when 0 then 'benign' when 1 then 'benign' else 'pathogenic' end pathogenicity,
 case p_partkey % 9 when 0 then '' when 1 then '' when 4 then p_name when 5 then p_name || '|' || p_brand end names, p_partkey % 9 in (2, 6, 7, 8) as error from part""")
def label_forms(spark, sf_dir):
    """Labels with and without diseases, lists, blanks and what breaks the format."""
    forms = F.expr("""case p_partkey % 9 when 0 then 'benign' when 1 then ' BENIGN ; ' when 2 then 'benign; ' || p_name when 3 then 'pathogenic; Not Provided'
     when 4 then 'Pathogenic;' || p_name when 5 then 'PATHOGENIC; [''' || p_name || ''', "' || p_brand || '"]' when 6 then 'pathogenic; [''' || p_name || ''', 3]'
     when 7 then 'pathogenic; [''' || p_name else 'likely benign' end""")
    parsed = table(spark, sf_dir, "part").select("p_partkey", literals.parse_label(forms).alias("p"))
    return parsed.select("p_partkey", "p.pathogenicity", F.array_join("p.diseases", "|").alias("names"), "p.error")


@query("""select p_partkey, case p_partkey % 8 when 0 then 'A. ' || p_name || '|B. it''s ' || p_brand when 1 then p_name || '|' || p_brand when 2 then p_name || '|7' when 3 then p_name || ' or ' || p_brand
 when 4 then null when 5 then '[' || p_name when 6 then '1|2.5' else 'A. "' || p_name || '"|C. ' || p_brand end choices from part""")
def choice_forms(spark, sf_dir):
    """Labelled lists with quotes inside and lost commas, quoted lists, tuples, plain texts and null markers."""
    forms = F.expr(r"""case p_partkey % 8 when 0 then '[''A. ' || p_name || ''' "B. it''s ' || p_brand || '"]' when 1 then '["' || p_name || '" ''' || p_brand || ''']'
     when 2 then '(''' || p_name || ''', 7)' when 3 then ' ' || p_name || ' or ' || p_brand || ' ' when 4 then elt(1 + p_partkey % 3, 'None', 'nan', '  ')
     when 5 then '[' || p_name when 6 then '[1, 2.5]' else '[''A. "' || p_name || '"'', ''C. ' || p_brand || ''']' end""")
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(literals.parse_choices(forms), "|").alias("choices"))


_WIDE = "ＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺ"


@query("select p_partkey, trim(regexp_replace(lower(p_name), '[_#]+', ' ', 'g')) || case p_partkey % 5 when 0 then ' strasse' when 1 then ' fine' when 2 then ' é' when 3 then ' 12 σσ' else '' end as key from part")
def key_forms(spark, sf_dir):
    """Names in full-width capitals, with ligatures, sharp s, combining accents, circled numbers and final sigma."""
    end = F.expr("case p_partkey % 5 when 0 then '-STRAßE' when 1 then '—ﬁne' when 2 then ' É' when 3 then '⑫ Σς' else '!?' end")
    wide = F.translate(F.upper("p_name"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", _WIDE)
    return table(spark, sf_dir, "part").select("p_partkey", literals.disease_key(F.concat(wide, F.when(F.col("p_partkey") % 5 == 3, F.lit(" ")).otherwise(F.lit("")), end)).alias("key"))


@query(r"""select event_id, case event_id % 6 when 0 then props when 1 then '\frac{' || event_type || '}{2}' when 2 then event_type when 3 then null when 4 then '' else 'x_{' || event_id || '}^{{2}}' end answer from events""")
def boxed_forms(spark, sf_dir):
    """Nested braces, a last box that doesn't close, none at all, an empty one."""
    forms = F.concat(
        F.when(F.col("event_id") % 6 == 0, F.concat(F.lit("so \\boxed{ "), F.col("props"), F.lit(" } and then \\boxed{open {")))
        .when(F.col("event_id") % 6 == 1, F.concat(F.lit("\\boxed{a} = $\\boxed{\\frac{"), F.col("event_type"), F.lit("}{2}}$.")))
        .when(F.col("event_id") % 6 == 2, F.concat(F.lit("\\fboxed{"), F.col("event_type"), F.lit("}")))
        .when(F.col("event_id") % 6 == 3, F.concat(F.lit("boxed "), F.col("props")))
        .when(F.col("event_id") % 6 == 4, F.lit("\\boxed{}"))
        .otherwise(F.concat(F.lit("\\boxed{x_{"), F.col("event_id").cast("string"), F.lit("}^{{2}}}}")))
    )
    return table(spark, sf_dir, "events").select("event_id", literals.boxed_answer(forms).alias("answer"))


@query(r"""select event_id, case when event_id % 7 in (4, 5, 6) then null else cast(json_extract(props, '$.k') as bigint) end k,
 case event_id % 7 when 1 then event_type || '\d' when 2 then event_type || chr(10) || '}' when 3 then '\"' || event_type end t from events""")
def json_forms(spark, sf_dir):
    """Fences, text before an object, stray backslashes, raw line ends and braces in strings, and what can't be mended."""
    k = F.concat(F.lit('"k": '), F.get_json_object("props", "$.k"))
    forms = (
        F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```")))
        .when(F.col("event_id") % 7 == 1, F.concat(F.lit("{"), k, F.lit(', "t": "'), F.col("event_type"), F.lit('\\d"}')))
        .when(F.col("event_id") % 7 == 2, F.concat(F.lit("Here it is: {"), k, F.lit(', "t": "'), F.col("event_type"), F.lit('\n}"}')))
        .when(F.col("event_id") % 7 == 3, F.concat(F.lit("```\n{"), k, F.lit(', "t": "\\\\\\"'), F.col("event_type"), F.lit('"}\n```')))
        .when(F.col("event_id") % 7 == 4, F.concat(F.col("props"), F.lit("}")))
        .when(F.col("event_id") % 7 == 5, F.lit("no object"))
        .otherwise(F.concat(F.lit("{"), k))
    )
    mended = literals.repair_json(forms)
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object(mended, "$.k").cast("long").alias("k"), F.get_json_object(mended, "$.t").alias("t"))


_SET_FORMS = """case doc_id % 8 when 0 then '{"pathogenicity": "benign", "diseases": ["Ab_C", "x"]}' when 1 then '{"diseases": ["X", "ab-c", "AB C"], "pathogenicity": "benign"}'
 when 2 then '{"pathogenicity": "benign", "diseases": ["ab c"]}' when 3 then '{"pathogenicity": "Benign", "diseases": ["x", "ab c"]}'
 when 4 then '{"pathogenicity": "pathogenic", "diseases": []}' when 5 then '{"pathogenicity": "benign", "diseases": ["x", 1]}'
 when 6 then '{"pathogenicity": "benign", "diseases": ["x", "ab c"], "more": 1}' else '{"pathogenicity": "benign", "pathogenicity": "benign", "diseases": ["x"]}' end"""


@query("""with f as (select *, doc_id % 8 in (0, 1, 2, 4) fits, doc_id % 8 in (0, 1) names, doc_id % 8 in (0, 1, 2) said from labels)
select doc_id, fits::int::double as format, (fits and said = (quality = 1))::int::double pathogenicity, (fits and names and toxic = 1)::int::double diseases,
 (fits and said = (quality = 1) and names and toxic = 1)::int::double reward from f""")
def set_forms(spark, sf_dir):
    """Names in other writing and order, repeated names, labels in other case, empty lists, numbers among names, other keys, repeated keys."""
    label = F.when(F.col("quality") == 1, F.lit("benign")).otherwise(F.lit("pathogenic"))
    names = F.when(F.col("toxic") == 1, F.array(F.lit("X"), F.lit("ab c"))).otherwise(F.array(F.lit("other")))
    return table(spark, sf_dir, "labels").select("doc_id", grade.label_and_names(F.expr(_SET_FORMS), label, names).alias("g")).select("doc_id", "g.*")


_MOLECULES = """with m as (select p_partkey, p_partkey % 6 form, 2 + p_partkey % 7 n from part)
select p_partkey, {columns} from m"""


def _counts_sql() -> str:
    """Counts of the molecules of atom_counts, by form."""
    values = {
        molecules.COUNTS[0]: ("n", "n + 3", "n + 1", "6", "n", "null"),
        molecules.COUNTS[1]: ("1", "0", "2", "1", "2", "null"),
        molecules.COUNTS[2]: ("1", "0", "0", "1", "0", "null"),
        molecules.COUNTS[3]: ("n + 1", "n + 3", "n + 3", "7", "n + 2", "null"),
        molecules.COUNTS[4]: ("1", "3", "1", "0", "1", "null"),
        molecules.COUNTS[5]: ("0", "1", "1", "1", "0", "null"),
        molecules.COUNTS[6]: ("n + 1", "n + 3", "n + 3", "7", "n + 2", "null"),
    }
    case = lambda v: "case form " + " ".join(f"when {i} then {x}" for i, x in enumerate(v)) + " end"
    return _MOLECULES.format(columns=", ".join(f"({case(v)})::int {c}" for c, v in values.items()))


@query(_counts_sql())
def atom_counts(spark, sf_dir):
    """Chains with a halogen, a fork, an acid's end, a ring, a charge, and a ring that doesn't close."""
    chain = F.repeat(F.lit("C"), (2 + F.col("p_partkey") % 7).cast("int"))
    forms = (
        F.when(F.col("p_partkey") % 6 == 0, F.concat(chain, F.lit("Cl")))
        .when(F.col("p_partkey") % 6 == 1, F.concat(chain, F.lit("C(C)C")))
        .when(F.col("p_partkey") % 6 == 2, F.concat(chain, F.lit("C(=O)O")))
        .when(F.col("p_partkey") % 6 == 3, F.lit("c1ccccc1Br"))
        .when(F.col("p_partkey") % 6 == 4, F.concat(chain, F.lit("[N+][O-]")))
        .otherwise(F.concat(F.lit("C1"), chain))
    )
    return table(spark, sf_dir, "part").select("p_partkey", molecules.atom_counts(forms).alias("m")).select("p_partkey", "m.*")


_PRIMER = 18
_GOLD = f"""with s as (select item_id, item_id % 6 f, (item_id // 6) % 2 = 0 stated, {dna_sql()} s from benchmark),
 u as (select *, (length(s) - length(replace(s, substr(s, 1, {_PRIMER}), ''))) = {_PRIMER} and (length(s) - length(replace(s, substr(s, length(s) - {_PRIMER - 1}), ''))) = {_PRIMER} once from s)
select item_id, case f when 3 then stated and once else stated end as valid from u"""


@query(_GOLD)
def computed_gold_families(spark, sf_dir):
    """Each item's DNA in a question of one of the six families; every second group of six states a wrong answer.

    The reading frames' sequences open with a long planted protein; primers are both ends of the DNA, so the product is all of it."""
    s, n, primer = dna(F.col("text")), 150, F.lit(_PRIMER)
    planted = F.concat(F.lit("ATG"), F.lit("GCT" * n), F.lit("TAA"), s)
    first, last = F.substring(s, 1, _PRIMER), F.translate(F.reverse(F.expr("right(_s, 18)")), "ACGT", "TGCA")
    items = table(spark, sf_dir, "benchmark").select("item_id", "text", s.alias("_s"))
    family = F.element_at(F.array(*[F.lit(x) for x in curate.FAMILIES]), (F.col("item_id") % 6 + 1).cast("int"))
    pair, size = F.concat(first, F.lit(", "), last), F.length(s).cast("string")
    protein = "M" + "A" * n + "*"
    gc = F.floor((200 * F.length(F.regexp_replace(s, "[AT]", "")) + F.length(s)) / (2 * F.length(s))).cast("string")
    by = lambda *forms: F.element_at(F.array(*forms), (F.col("item_id") % 6 + 1).cast("int"))
    question = by(
        F.concat(F.lit("Longest protein of "), planted), F.concat(F.lit(f"How many longer or greater than {n - 3} residues in "), planted),
        F.concat(F.lit("Primers for "), size, F.lit(" bp on "), s), F.concat(F.lit("Length with "), first, F.lit(" and "), last, F.lit(" on "), s),
        F.concat(F.lit("Primers for "), s, F.lit(" on "), s), F.concat(F.lit("GC of "), s),
    )
    right = by(F.lit(protein), F.lit("1"), pair, size, pair, gc)
    wrong = by(F.lit(protein[:-2] + "*"), F.lit("2"), F.concat(first, F.lit(", "), first), (F.length(s) + 1).cast("string"), F.concat(last, F.lit(", "), last), F.lit("101"))
    stated = F.floor(F.col("item_id") / 6) % 2 == 0
    ideal, other = F.when(stated, right).otherwise(wrong), F.when(stated, wrong).otherwise(right)
    asked = items.withColumns({"family": family, "q": question, "ideal": ideal, "other": other})
    checked = curate.computed_gold(F.col("family"), F.col("q"), F.col("ideal"), F.array("other"))
    return asked.select("item_id", checked["valid"].alias("valid"))
