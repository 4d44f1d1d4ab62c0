"""Queries of validation, TeX, grading contracts and small operators, over forms made from the tables' own values."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievemill.functions import literals, sequences, text
from sievemill.operators import curate, grade, joins, project, sample, stats, validate
from sievemill.plans.registry import dna, dna_sql, query, table
from sievemill.sources import readers


@query("select p_partkey, p_partkey % 7 = 0 as valid from part")
def lattice_checks(spark, sf_dir):
    """Crystals that are good, singular, short of a row, without sites, with a split or nameless site, with a coordinate that isn't finite."""
    a, form = F.col("p_retailprice"), F.col("p_partkey") % 7
    row = lambda *x: F.array(*[F.lit(v).cast("double") if isinstance(v, (int, float)) else v for v in x])
    rows = F.array(row(a, 0, 0), F.when(form == 1, row(a * 2, 0, 0)).otherwise(row(1, a, 0)), row(0, 0, a))
    lattice = F.when(form == 2, F.slice(rows, 1, 2)).otherwise(rows)
    species = lambda *x: F.array(*[F.struct(F.lit(e).alias("element"), F.lit(o).alias("occu")) for e, o in x])
    site = F.struct(
        F.when(form == 4, species(("Fe", 1), ("O", 1))).when(form == 5, species(("F3", 1))).otherwise(species(("Fe", 1))).alias("species"),
        F.array(F.lit(0.0), F.lit(0.5), F.when(form == 6, F.lit(float("nan"))).otherwise(F.lit(0.25))).alias("abc"),
    )
    sites = F.when(form == 3, F.slice(F.array(site), 1, 0)).otherwise(F.array(site))
    return table(spark, sf_dir, "part").select("p_partkey", F.coalesce(validate.valid_structure(lattice, sites), F.lit(False)).alias("valid"))


@query("select p_partkey, p_partkey % 6 = 0 and p_name <> p_brand as valid from part")
def option_checks(spark, sf_dir):
    """Options that are good, with a repeated letter, a small letter, a blank text, equal texts but for spaces, and one alone."""
    form = F.col("p_partkey") % 6
    first = F.struct(F.when(form == 2, "a").otherwise("A").alias("letter"), F.col("p_name").alias("text"))
    second = F.struct(
        F.when(form == 1, "A").otherwise("B").alias("letter"), F.when(form == 3, F.lit("  ")).when(form == 4, F.concat(F.lit(" "), "p_name")).otherwise(F.col("p_brand")).alias("text")
    )
    options = F.when(form == 5, F.array(first)).otherwise(F.array(first, second))
    return table(spark, sf_dir, "part").select("p_partkey", validate.valid_options(options).alias("valid"))


@query("select doc_id, doc_id % 6 = 0 as safe, doc_id % 3 <> 1 as agrees from documents")
def path_checks(spark, sf_dir):
    """Relative paths that stay inside and that don't; task ids against their split and index."""
    name = F.concat_ws("/", "source", F.col("doc_id").cast("string"))
    forms = F.expr("case doc_id % 6 when 0 then n when 1 then '/' || n when 2 then '../' || n when 3 then n || '/..' when 4 then replace(n, '/', '\\\\') else '' end")
    task = F.format_string("bench-%s-%06d", "lang", F.when(F.col("doc_id") % 3 == 1, F.col("doc_id") + 1).otherwise(F.col("doc_id")))
    docs = table(spark, sf_dir, "documents").withColumn("n", name)
    return docs.select("doc_id", validate.safe_relative_path(forms).alias("safe"), curate.path_agrees(task, F.col("lang"), F.col("doc_id")).alias("agrees"))


@query("select doc_id, doc_id % 3 = 0 as holds from documents")
def content_addresses(spark, sf_dir):
    """Texts as bytes against digest and size as stated, right, with another digest, with another size."""
    raw, form = F.encode("text", "UTF-8"), F.col("doc_id") % 3
    sha = F.when(form == 1, F.sha2(F.concat("text", F.lit(" ")), 256)).otherwise(F.sha2("text", 256))
    size = F.octet_length(F.col("text")) + F.when(form == 2, 1).otherwise(0)
    return table(spark, sf_dir, "documents").select("doc_id", validate.same_content(raw, sha, size).alias("holds"))


@query("select event_id, event_id % 6 = 0 as all_true from events")
def strict_conjunctions(spark, sf_dir):
    """Fields that are the literal true, 1, a text, false, missing or null."""
    b = F.expr("case event_id % 6 when 0 then ', \"b\": true' when 1 then ', \"b\": 1' when 2 then ', \"b\": \"true\"' when 3 then ', \"b\": false' when 4 then '' else ', \"b\": null' end")
    value = validate.strict_object(F.concat(F.lit('{"a": true'), b, F.lit("}")))
    return table(spark, sf_dir, "events").select("event_id", validate.strictly_true(value, ["$.a", "$.b"]).alias("all_true"))


@query("""with d as (select doc_id, source, lang, text t, length(text) // 2 h from documents where source is not null and not contains(text, '\\ref') and doc_id % 2 = 0)
select source, lang as label, sha256(substr(substr(t, 1, h), greatest(1, h - 2199), 2200) || ' ' || substr(substr(t, h + 1), 1, 2200)) passage from d where lang in ('en', 'de')""")
def mention_passages(spark, sf_dir):
    """Texts around a mention of their language in the middle, for the labels of two languages in each source."""
    docs = table(spark, sf_dir, "documents").where("source is not null and not contains(text, '\\\\ref') and doc_id % 2 = 0").withColumn("h", F.expr("length(text) div 2"))
    said = F.concat(F.expr("substring(text, 1, h)"), F.lit("\\ref{"), F.col("lang"), F.lit("}"), F.expr("substring(text, h + 1)"))
    labels = docs.select("source").distinct().select("source", F.explode(F.array(F.lit("en"), F.lit("de"))).alias("label"))
    return joins.passages_around(docs.select("source", said.alias("t")), labels, "source", "t", "label").select("source", "label", F.sha2("passage", 256).alias("passage"))


@query("""select event_id, case when event_type = 'k' then 9 else cast(json_extract(props, '$.k') as bigint) end k, event_id typed, case when event_type in ('k', 'z') then 2 else 3 end n from events""")
def merged_maps(spark, sf_dir):
    """Maps of which later ones win: by a literal key, by a column's value, by both."""
    k = F.get_json_object("props", "$.k").cast("long")
    maps = F.create_map(F.lit("k"), F.lit(-1).cast("long"), F.lit("z"), F.lit(0).cast("long")), F.create_map(F.lit("k"), k), F.create_map("event_type", "event_id")
    merged = project.merge_maps(*maps)
    return table(spark, sf_dir, "events").select("event_id", merged["k"].alias("k"), F.try_element_at(merged, F.col("event_type")).alias("typed"), F.size(merged).alias("n"))


@query("""select doc_id, 'fig:' || lang || '-' || doc_id labels, 'a' || doc_id || '.png|b.pdf' images, 'A {nested \\{ ' || lang || '} one' caption, 2 as figures from documents where lang is not null""")
def figure_parts(spark, sf_dir):
    """Figures in TeX before each text: labels that name figures, images once, a caption with nested and escaped braces."""
    tex = F.format_string(
        "\\begin{figure}[t]\\includegraphics[width=1]{ a%1$s.png }\\includegraphics{b.pdf}\\input{b.pdf}\\caption[s]{A {nested \\{ %2$s} one}\\label{fig:%2$s-%1$s}\\label{tab:x}\\end{figure}\n\\begin{figure*}z\\end{figure*}",
        F.col("doc_id").cast("string"), "lang",
    )
    docs = table(spark, sf_dir, "documents").where("lang is not null").select("doc_id", text.figure_bodies(F.concat(tex, F.regexp_replace("text", r"\\", " "))).alias("b"))
    body = docs.select("doc_id", F.size("b").alias("figures"), F.col("b")[0].alias("b"))
    return body.select(
        "doc_id", F.array_join(text.figure_labels(F.col("b")), "|").alias("labels"), F.array_join(text.figure_images(F.col("b")), "|").alias("images"),
        literals.command_argument(F.col("b"), "caption").alias("caption"), "figures",
    )


@query("""select p_partkey, case when p_partkey % 5 = 0 then 'X' else cast(1 + p_partkey % 22 as varchar) end chromosome, case when p_partkey % 3 = 2 then null else cast(p_partkey as varchar) end as position,
 case p_partkey % 3 when 0 then 'GENE' || p_size when 1 then 'BRCA' || p_size end gene from part""")
def variant_contexts(spark, sf_dir):
    """Questions that name a gene before a bracket, after a cue, or not at all."""
    forms = F.expr("""'A variant on Chromosome ' || if(p_partkey % 5 = 0, 'X', cast(1 + p_partkey % 22 as string)) || case p_partkey % 3
     when 0 then ' at position ' || p_partkey || ' hits GENE' || p_size || ' (DNA repair).' when 1 then ', location ' || p_partkey || ', affecting BRCA' || p_size || ' here'
     else ' lies where none is known.' end""")
    return table(spark, sf_dir, "part").select("p_partkey", text.variant_context(forms).alias("v")).select("p_partkey", "v.*")


@query(f"""with s as (select item_id, {dna_sql()} s, 1 + item_id % 40 p from benchmark)
select item_id, case item_id % 4 when 0 then substr(s, 1, p - 1) || 'W' || substr(s, p + 1) end made from s""")
def mutations(spark, sf_dir):
    """Substitutions that fit, name another residue, lie outside, or change nothing."""
    s, at = dna(F.col("text")), 1 + F.col("item_id") % 40
    old = F.expr("substring(s, 1 + item_id % 40, 1)").alias("old")
    items = table(spark, sf_dir, "benchmark").select("item_id", s.alias("s")).select("*", old)
    code = F.expr("case item_id % 4 when 0 then old || at || 'W' when 1 then 'Q' || at || 'W' when 2 then old || (length(s) + 1) || 'W' else old || at || old end")
    return items.withColumn("at", at).select("item_id", sequences.apply_mutation(F.col("s"), code).alias("made"))


@query("""with m as (select l_orderkey, l_linenumber, l_quantity a, l_discount b, l_tax c, l_linenumber d, l_quantity - 7 e, 2.0 f, 1.0 g, l_tax * 10 h, l_quantity + l_linenumber i from lineitem)
select l_orderkey, l_linenumber, round(a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g), 4) as d from m""")
def determinants(spark, sf_dir):
    q, n, t = F.col("l_quantity"), F.col("l_linenumber").cast("double"), F.col("l_tax")
    m = F.array(F.array(q, F.col("l_discount"), t), F.array(n, q - 7, F.lit(2.0)), F.array(F.lit(1.0), t * 10, q + n))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(sequences.determinant3(m), 4).alias("d"))


@query("""select event_id, sha256('{"a": "é", "k": ' || json_extract_string(props, '$.k') || ', "t": ["' || event_type || '", null, 1.5]}') digest from events where event_id % 4 <> 3
union all select event_id, null from events where event_id % 4 = 3""")
def canonical_digests(spark, sf_dir):
    """One object in three writings: other order, other spaces, escaped letters; and one that isn't JSON."""
    k = F.get_json_object("props", "$.k")
    forms = (
        F.when(F.col("event_id") % 4 == 0, F.format_string('{"t": ["%1$s", null, 1.5], "k": %2$s, "a": "é"}', "event_type", k))
        .when(F.col("event_id") % 4 == 1, F.format_string('{"a":"é","t":["%1$s",null,1.50],\n"k":%2$s}', "event_type", k))
        .when(F.col("event_id") % 4 == 2, F.format_string('{"k": %2$s, "a": "\\u00e9", "t": ["%1$s", null, 15e-1]}', "event_type", k))
        .otherwise(F.format_string("{'k': %s", k))
    )
    return table(spark, sf_dir, "events").select("event_id", literals.canonical_digest(forms).alias("digest"))


@query("""select event_id, case event_id % 5 when 0 then event_type when 1 then 'from ' || event_type when 2 then '["a", ' || event_id || ']' when 3 then '{"a": 1, "b": "' || event_type || '"}' end answer from events""")
def answer_forms(spark, sf_dir):
    """Answers as JSON texts: a string, null with a fallback, a list, an object, and neither."""
    said = F.expr("""case event_id % 5 when 0 then '"' || event_type || '"' when 1 then 'null' when 2 then '["a",' || event_id || ']' when 3 then '{"b":"' || event_type || '","a":1}' end""")
    other = F.expr("case when event_id % 5 = 1 then '\"from ' || event_type || '\"' when event_id % 5 < 4 then '\"unused\"' end")
    return table(spark, sf_dir, "events").select("event_id", literals.coalesce_answer(said, other).alias("answer"))


@query("""select doc_id, '[{"a":' || doc_id || ',"c":"' || lang || '"},{"a":null,"c":"x"}]' public from documents where lang is not null""")
def sanitized(spark, sf_dir):
    """Structs of which the allowed fields are kept, in the order allowed, the hidden one is not."""
    item = lambda a, c: F.struct(c.alias("c"), F.col("source").alias("gold"), a.alias("a"))
    items = F.array(item(F.col("doc_id"), F.col("lang")), item(F.lit(None).cast("long"), F.lit("x")))
    kept = F.to_json(project.allow_fields(items, ["a", "c"]), {"ignoreNullFields": "false"})
    return table(spark, sf_dir, "documents").where("lang is not null").select("doc_id", kept.alias("public"))


@query("select item_id as task, text as question from benchmark")
def renamed_columns(spark, sf_dir):
    names = {"public": {"item_id": "task", "text": "question"}, "other": {"item_id": "x"}}
    return project.rename_for(table(spark, sf_dir, "benchmark").select("item_id", "text"), "public", names)


@query("select doc_id, flag from (select doc_id, case doc_id % 4 when 0 then 'True' when 1 then 'False' when 2 then null else 'maybe' end flag from documents) where flag in ('True', 'False') or flag is null")
def nullable_categories(spark, sf_dir):
    """Values of an enumeration, and none; anything else goes."""
    flag = F.expr("case doc_id % 4 when 0 then 'True' when 1 then 'False' when 2 then null else 'maybe' end")
    return table(spark, sf_dir, "documents").select("doc_id", flag.alias("flag")).where(F.col("flag").isin("True", "False") | F.col("flag").isNull())


@query("select p_partkey, (p_partkey % 5 in (0, 1, 3))::int::double as reward from part")
def lenient_grades(spark, sf_dir):
    """Texts in other case and with spaces, wrong ones, and subjective questions with any answer and with none."""
    said = F.expr("case p_partkey % 5 when 0 then p_name when 1 then ' ' || upper(p_name) || ' ' when 2 then p_name || '.' when 3 then 'anything' else '  ' end")
    return table(spark, sf_dir, "part").select("p_partkey", grade.lenient_text(said, F.col("p_name"), F.col("p_partkey") % 5 >= 3).alias("reward"))


@query("select event_id, (event_id % 7 in (0, 1))::int::double as reward from events")
def letter_contracts(spark, sf_dir):
    """One key with a letter: right, with spaces in the JSON, wrong, not allowed, small, a list, with another key."""
    said = F.expr("""case event_id % 7 when 0 then '{"answer": "B"}' when 1 then '{ "answer" :"B" }' when 2 then '{"answer": "C"}' when 3 then '{"answer": "E"}'
     when 4 then '{"answer": "b"}' when 5 then '{"answer": ["B"]}' else '{"answer": "B", "why": ""}' end""")
    return table(spark, sf_dir, "events").select("event_id", grade.json_letter(said, "answer", list("ABCD"), F.lit("B")).alias("reward"))


@query("""select event_id, case event_id % 8 when 0 then 0.25e0 when 1 then 1e0 when 2 then 0e0 end ordinal, case event_id % 8 when 0 then 1e0 when 1 then 0e0 end as binary from events""")
def judge_verdicts(spark, sf_dir):
    """Verdicts that keep their contracts, and that break them in score, flag, reason, keys or form."""
    ordinal = F.expr("""case event_id % 8 when 0 then '{"score": 0.25, "rationale": "' || event_type || '"}' when 1 then '{"rationale": "r", "score": 1}' when 2 then '{"score": 0.0, "rationale": "r"}'
     when 3 then '{"score": 0.3, "rationale": "r"}' when 4 then '{"score": "1", "rationale": "r"}' when 5 then '{"score": 1, "rationale": " "}' when 6 then '{"score": 1}' else '{"score": 1, "rationale": "r"}.' end""")
    binary = F.expr("""case event_id % 8 when 0 then '{"answer_correct": true, "score": 1, "rationale": "' || event_type || '"}' when 1 then '{"score": 0, "answer_correct": false, "rationale": "r"}'
     when 2 then '{"answer_correct": true, "score": 0, "rationale": "r"}' when 3 then '{"answer_correct": "true", "score": 1, "rationale": "r"}' when 4 then '{"answer_correct": true, "score": 1.0, "rationale": "r"}'
     when 5 then '{"answer_correct": true, "score": 1, "rationale": ""}' when 6 then '{"answer_correct": true, "score": 1, "rationale": "' || repeat('x', 1201) || '"}' else 'true' end""")
    return table(spark, sf_dir, "events").select("event_id", grade.ordinal_verdict(ordinal).alias("ordinal"), grade.binary_verdict(binary).alias("binary"))


@query("""select event_id, case when event_type = 'error' then 'infrastructure_error' when value < 20 then 'invalid_submission' else 'graded' end status,
 case when event_type = 'error' then null when value < 20 then 0e0 else value end reward from events""")
def outcomes(spark, sf_dir):
    found = grade.outcome(F.col("value"), F.col("value") < 20, F.col("event_type") == "error")
    return table(spark, sf_dir, "events").select("event_id", found.alias("o")).select("event_id", "o.*")


@query("""select source, case when count(quality) = 0 then 'not_measured' when count(quality) < count(*) then 'incomplete' else 'complete' end status from documents left join labels using (doc_id) group by source""")
def report_statuses(spark, sf_dir):
    rows = joins.planned_outcomes(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")
    counted = rows.groupBy("source").agg(F.count("*").alias("n"), F.count("quality").alias("k"))
    return counted.select("source", stats.report_status(F.col("n"), F.col("k")).alias("status"))


_DRAW = "select doc_id from documents order by sha256('{}:' || cast(doc_id as varchar)), doc_id limit 60"


@query(f"""with a as ({_DRAW.format("s1")}), b as ({_DRAW.format("s9")})
select doc_id, 'left' side from a where doc_id not in (select doc_id from b) union all select doc_id, 'right' from b where doc_id not in (select doc_id from a)""")
def redrawn_samples(spark, sf_dir):
    """What tells a sample from one drawn with another seed; tests redraw with the same one."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return sample.redrawn_difference(sample.hash_sample(docs, "doc_id", 60, "s1"), sample.hash_sample(docs, "doc_id", 60, "s9"), "doc_id")


@query("""with f as (select lang || '/' || doc_id || '.txt' name from documents where doc_id % 7 <> 3), l as (select lang || '/' || doc_id || '.txt' name from documents where doc_id % 5 <> 1)
select name, 'left' side from f where name is not null and name not in (select name from l where name is not null) union all select name, 'right' from l where name is not null and name not in (select name from f where name is not null)""")
def listed_files(spark, sf_dir):
    """Names of files that are there and aren't listed, and of those that are listed and aren't there."""
    names = table(spark, sf_dir, "documents").where("lang is not null").select("doc_id", F.concat("lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"))
    return readers.file_set_difference(names.where("doc_id % 7 <> 3"), names.where("doc_id % 5 <> 1"), "name")
