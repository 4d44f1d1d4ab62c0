"""Queries of aggregation, scalar functions, grading and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievemill.functions import fixed, literals, sequences, text
from sievemill.operators import aggregate, grade, joins, stats, validate
from sievemill.plans.registry import dna, dna_sql, query, table


@query("select lang || '/' || cast(quality as varchar) cell, count(*) n from documents join labels using (doc_id) group by 1")
def category_crosstab(spark, sf_dir):
    return aggregate.cross_tab(table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id"), "lang", "quality")


@query("select user_id, count(*) n from events group by user_id order by n desc, user_id limit 20")
def topk_categories(spark, sf_dir):
    return aggregate.top_counts(table(spark, sf_dir, "events"), "user_id", 20)


@query("select source, lang, count(*) n from documents group by all")
def category_counts(spark, sf_dir):
    return aggregate.counts(table(spark, sf_dir, "documents"), "source", "lang")


@query("with c as (select unnest(string_split(text, '')) character from benchmark) select character, count(*) n from c where character <> '' group by character")
def char_histogram(spark, sf_dir):
    return aggregate.character_histogram(table(spark, sf_dir, "benchmark"), "text")


@query("select count(*) n, count(*) filter (value > 50) high, count(*) filter (event_type = 'error') errors from events")
def conditional_counts(spark, sf_dir):
    return aggregate.conditional_counts(table(spark, sf_dir, "events"), high=F.col("value") > 50, errors=F.col("event_type") == "error")


@query("select count(distinct source) n_source, count(distinct lang) n_lang, count(distinct text) n_text from documents")
def distinct_counts(spark, sf_dir):
    return aggregate.distinct_counts(table(spark, sf_dir, "documents"), "source", "lang", "text")


@query("select max(abs(l_extendedprice - l_quantity * p_retailprice)) largest from lineitem join part on p_partkey = l_partkey")
def largest_deviation(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice"), "l_partkey")
    return aggregate.largest_deviation(lines.withColumn("stated", F.col("l_quantity") * F.col("p_retailprice")), "l_extendedprice", "stated")


@query("select event_type, round(avg(value), 9) mean_score, count(*) filter (value = 3) fully_correct, bool_and(value >= 0) all_valid from events group by event_type")
def score_summary(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("ok", F.col("value") >= 0)
    return aggregate.score_summary(events, "event_type", "value", 3.0, "ok").withColumn("mean_score", F.round("mean_score", 9))


@query("select event_type, event_id, n as example from (select event_type, event_id, row_number() over (partition by event_type order by event_id) n from events) where n <= 2")
def first_examples(spark, sf_dir):
    return aggregate.first_examples(table(spark, sf_dir, "events"), "event_type", "event_id").select("event_type", "event_id", F.col("example").cast("long"))


#: Ids of a list that one task digests, in this query.
_LEAF = 64


@query(f"""with n as (select source, greatest(0, ceil(round(log(count(*) / {_LEAF}.0) / log(16.0), 9)))::int d from documents group by source),
 p as (select source, d, cast(doc_id as varchar) i, substr(sha256(cast(doc_id as varchar)), 1, d) part from documents join n using (source)),
 q as (select source, any_value(d) d, part, sha256(string_agg(i, chr(10) order by i)) s from p group by source, part)
select source, case when any_value(d) = 0 then any_value(s) else sha256(string_agg(s, chr(10) order by part)) end digest from q group by source""")
def id_list_digest(spark, sf_dir):
    return aggregate.id_list_digest(table(spark, sf_dir, "documents"), "doc_id", "source", leaf=_LEAF)


@query("""with r as (select doc_id // 100000 b, doc_id, sha256('{"doc_id":' || doc_id || ',"lang":"' || lang || '"}') d from documents),
 g as (select b, sha256(string_agg(d, chr(10) order by doc_id)) d from r group by b) select sha256(string_agg(d, chr(10) order by b)) digest from g""")
def dataset_digest(spark, sf_dir):
    return aggregate.dataset_digest(table(spark, sf_dir, "documents"), "doc_id", "doc_id", "lang")


@query("select doc_id, cast(instr(text, ';') > 0 as boolean) has_tail, split_part(text, '. ', 1) head from documents")
def partition_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", (F.instr("text", ";") > 0).alias("has_tail"), text.partition_first(F.col("text"), ". ")["head"].alias("head"))


@query("select page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim('https://arxiv.org/abs/24' || lpad(cast(page_id as varchar), 2, '0') || '.0' || lpad(cast(page_id * 37 % 10000 as varchar), 4, '0') || 'v' || cast(page_id % 3 + 1 as varchar)), '^https?://arxiv\\.org/(?:abs|pdf)/', ''), '\\.pdf$', ''), '/$', ''), 'v\\d+$', '') paper_id from pages")
def id_normalize(spark, sf_dir):
    p = F.col("page_id")
    raw = F.concat(F.lit("https://arxiv.org/abs/24"), F.lpad(p.cast("string"), 2, "0"), F.lit(".0"), F.lpad((p * 37 % 10000).cast("string"), 4, "0"), F.lit("v"), (p % 3 + 1).cast("string"))
    return table(spark, sf_dir, "pages").select("page_id", text.normalize_paper_id(raw).alias("paper_id"))


_TEX = """select doc_id, substr(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace('\\textbf{' || text || '} \\cite{a} \\alpha x', '(^|[^\\\\])%[^\\n]*', '\\1', 'g'),
 '\\\\(?:cite|citep|citet|footnote)\\s*\\{[^}]*\\}', '', 'g'), '\\\\(?:textbf|textit|emph|mathrm|mathbf|operatorname)\\s*', '', 'g'),
 '\\\\[a-zA-Z]+\\*?(?:\\[[^\\]]*\\])?\\s*', '', 'g'), '[{}]', '', 'g'), '\\s+', ' ', 'g'), ' '), 1, 12000) cleaned from documents"""


@query(_TEX)
def tex_clean(spark, sf_dir):
    raw = F.concat(F.lit("\\textbf{"), F.col("text"), F.lit("} \\cite{a} \\alpha x"))
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_tex(raw).alias("cleaned"))


@query("select page_id, regexp_replace(url, '[^A-Za-z0-9_.-]', '_', 'g') as name, 'case-' || lpad(cast(page_id as varchar), 6, '0') id6, 'm-' || substr(sha256(url), 1, 20) hashed, cast(page_id as varchar) || ':' || url as joined from pages")
def identifiers(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", text.sanitize_filename(u).alias("name"), text.padded_id(F.col("page_id"), 6, "case-").alias("id6"), text.hash_id(u, "m-").alias("hashed"), text.composite_id(F.col("page_id").cast("string"), u).alias("joined"))


@query("select p_partkey, 'Part ' || p_name || ' of ' || p_brand || chr(10) || '- ' || p_type || chr(10) || '- ' || cast(p_size as varchar) as prompt, lower(hex(encode(p_name))) payload, base64(encode(p_brand)) b64 from part")
def rendered_prompts(spark, sf_dir):
    body = text.render(F.lit("Part {{ name }} of {{ brand }}\n{{ list }}"), {"name": F.col("p_name"), "brand": F.col("p_brand"), "list": text.bullet_list(F.array(F.array("p_type"), F.array(F.col("p_size").cast("string"))))}, strict=True)
    return table(spark, sf_dir, "part").select("p_partkey", body.alias("prompt"), text.encode_payload(F.col("p_name"), "hex").alias("payload"), text.encode_payload(F.col("p_brand")).alias("b64"))


@query("select item_id, 'Q: ' || substr(text, 1, 40) || ' A: ' || substr(text, 1, 10) prompt from benchmark")
def truncated_prompts(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", text.prompt("Q: {q} A: {a}", q=(F.col("text"), 40), a=(F.col("text"), 10)).alias("prompt"))


@query("select doc_id, regexp_matches(text, '(?i)\\bsecret\\b') secret, regexp_matches(text, '(?i)licen[cs]e') licence from documents")
def presence_flags(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", *text.presence_flags(F.col("text"), {"secret": r"\bsecret\b", "licence": "licen[cs]e"}))


_S = dna_sql()


@query(f"select doc_id, reverse(translate(s, 'ACGT', 'TGCA')) rc, case when length(s) > 0 then cast((200 * len(regexp_extract_all(s, '[GC]')) + length(s)) // (2 * length(s)) as bigint) end gc from (select doc_id, {_S} s from documents)")
def reverse_complement(spark, sf_dir):
    s = dna(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", sequences.reverse_complement(s).alias("rc"), sequences.gc_percent(s).alias("gc"))


def _turned(s):
    """The sequence without its first three letters, which go to the end."""
    return F.concat(F.substring(s, F.lit(4), F.length(s)), F.substring(s, 1, 3))


@query(f"""with p as (select item_id, s a, substr(s, 4) || substr(s, 1, 3) b from (select item_id, {_S} s from benchmark)), q as (select *, list_filter(range(1, least(length(a), length(b)) + 1), lambda i: substr(a, i, 1) <> substr(b, i, 1)) w from p)
select item_id, case when length(a) = length(b) then len(w) end distance, case when a <> b then coalesce(w[1] - 1, least(length(a), length(b))) end first_at from q""")
def hamming_diff(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark").select("item_id", dna(F.col("text")).alias("a")).withColumn("b", _turned(F.col("a")))
    a, b = F.col("a"), F.col("b")
    return items.select("item_id", sequences.hamming(a, b).cast("long").alias("distance"), sequences.first_difference(a, b).cast("long").alias("first_at"))


@query()
def change_classes(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark").select("item_id", dna(F.col("text")).alias("a"))
    a = F.col("a")
    changed = F.when(F.col("item_id") % 3 == 0, a).when(F.col("item_id") % 3 == 1, F.concat(F.substring(a, 1, 50), F.lit("ACGTT"), F.substring(a, F.lit(51), F.length(a)))).otherwise(F.concat(F.substring(a, 1, 50), F.substring(a, F.lit(54), F.length(a))))
    return items.select("item_id", sequences.classify_change(a, changed).alias("c")).select("item_id", "c.*")


@query(f"select item_id, array_to_string(list_filter(range(0, length(s) - 2), lambda i: substr(s, i + 1, 3) = 'ATG'), ',') starts from (select item_id, {_S} s from benchmark)")
def match_positions(spark, sf_dir):
    found = sequences.match_positions(dna(F.col("text")), F.lit("ATG"))
    return table(spark, sf_dir, "benchmark").select("item_id", F.array_join(F.transform(found, lambda i: i.cast("string")), ",").alias("starts"))


_CODE = "'" + fixed.AMINO_ACIDS + "'"
_FRAMES = """with s as (select item_id, """ + dna_sql() + """ s from benchmark), f as (select item_id, substr(s, f + 1) s from s, range(3) t(f)),
 c as (select item_id, list_transform(regexp_extract_all(s, '...'), lambda c: substr(""" + _CODE + """,
  (16 * (instr('TCAG', substr(c, 1, 1)) - 1) + 4 * (instr('TCAG', substr(c, 2, 1)) - 1) + instr('TCAG', substr(c, 3, 1)))::int, 1)) a from f),
 x as (select item_id, string_split(array_to_string(a, ''), '*') g from c), y as (select item_id, unnest(g[1:len(g) - 1]) g from x),
 z as (select item_id, unnest(list_transform(list_filter(range(1, length(g) + 1), lambda i: substr(g, i, 1) = 'M'), lambda i: substr(g, i) || '*')) p from y),
 k as (select item_id, p, count(*) over (partition by item_id) n, rank() over (partition by item_id order by length(p) desc) r from z),
 l as (select item_id, any_value(n)::int n, count(*) filter (r = 1) ties, any_value(p) filter (r = 1) p from k group by item_id)
select item_id, coalesce(n, 0)::int n, case when ties = 1 then p end longest from benchmark left join l using (item_id)"""


@query(_FRAMES)
def reading_frames(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark").select("item_id", sequences.complete_proteins(dna(F.col("text"))).alias("p"))
    return items.select("item_id", F.size("p").alias("n"), sequences.longest_unique(F.col("p")).alias("longest"))


@query()
def alignment_identity(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark").select("item_id", dna(F.col("text")).alias("a")).withColumn("b", _turned(F.col("a")))
    return items.select("item_id", sequences.alignment("a", "b").alias("x")).select("item_id", "x.*")


@query(f"select doc_id, regexp_matches(s, '[^ACGT]') other_than_acgt, regexp_matches(s, '[^ACGTN]') other_than_acgtn, ends_with(s, 'N') and not contains(rtrim(s, 'N'), 'N') n_tail from (select doc_id, case when doc_id % 2 = 0 then {_S} || 'NN' else {_S} end s from documents)")
def alphabet_flags(spark, sf_dir):
    s = dna(F.col("text"))
    seq = F.when(F.col("doc_id") % 2 == 0, F.concat(s, F.lit("NN"))).otherwise(s)
    return table(spark, sf_dir, "documents").select("doc_id", sequences.alphabet_flags(seq).alias("f")).select("doc_id", "f.*")


@query("select doc_id, quality, toxic, 'pathogenic' as pathogenicity, cast(0 as bigint) n_diseases from labels where quality = 1 union all select doc_id, quality, toxic, 'benign', 0 from labels where quality = 0")
def source_labels(spark, sf_dir):
    raw = F.when(F.col("quality") == 1, F.lit("Pathogenic; not provided")).otherwise(F.lit("benign"))
    parsed = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic", literals.parse_label(raw).alias("p"))
    return parsed.select("doc_id", "quality", "toxic", "p.pathogenicity", F.coalesce(F.size("p.diseases"), F.lit(0)).cast("long").alias("n_diseases"))


@query("select p_partkey, p_name || '|' || p_brand as choices from part")
def parsed_choices(spark, sf_dir):
    raw = F.concat(F.lit("['"), F.col("p_name"), F.lit("' '"), F.col("p_brand"), F.lit("']"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(literals.parse_choices(raw), "|").alias("choices"))


@query("select item_id, trim(text) as answer from benchmark")
def boxed_extract(spark, sf_dir):
    reply = F.concat(F.lit("so \\boxed{wrong} then $\\boxed{"), F.col("text"), F.lit("}$"))
    return table(spark, sf_dir, "benchmark").select("item_id", literals.boxed_answer(reply).alias("answer"))


@query("select p_partkey, lower(p_type) || ' ' || lower(replace(p_name, '_', ' ')) as key from part")
def disease_key(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", literals.disease_key(F.concat(F.upper("p_type"), F.lit("_-_"), F.col("p_name"))).alias("key"))


@query("select event_id, cast(json_extract(props, '$.k') as bigint) k from events")
def repaired_json(spark, sf_dir):
    reply = F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```"))
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object(literals.repair_json(reply), "$.k").cast("long").alias("k"))


@query("select event_id, case when k between 0 and 50 and k = event_id % 60 then 1e0 else 0e0 end reward from (select event_id, cast(json_extract(props, '$.k') as bigint) k from events)")
def grade_bounded_int(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", grade.json_int(F.col("props"), "k", F.lit(50), F.col("event_id") % 60).alias("reward"))


@query("select event_id, case when s in ('B', 'B' || chr(10)) then 1e0 else 0e0 end reward from (select event_id, case event_id % 6 when 0 then 'B' when 1 then 'B' || chr(10) when 2 then ' B' when 3 then 'b' when 4 then 'E' else '' end s from events)")
def grade_letter(spark, sf_dir):
    said = F.expr("case event_id % 6 when 0 then 'B' when 1 then 'B' || chr(10) when 2 then ' B' when 3 then 'b' when 4 then 'E' else '' end")
    letters = F.array(*[F.lit(x) for x in "ABCD"])
    return table(spark, sf_dir, "events").select("event_id", grade.letter(said, letters, F.lit("B")).alias("reward"))


@query("""select event_id, case when event_id % 5 = 0 then 'missing' when event_id % 5 = 1 then 'malformed' else 'graded' end status,
 case when event_id % 5 > 1 and value between 10 and 60 then 1e0 else 0e0 end reward from events""")
def grade_range(spark, sf_dir):
    said = F.when(F.col("event_id") % 5 == 1, F.lit("no tag")).when(F.col("event_id") % 5 > 1, F.concat(F.lit(" <answer>"), F.col("value").cast("string"), F.lit("</answer>\n")))
    graded = grade.tagged(said, F.lit("range_verifier"), F.lit(10).cast("decimal(38,18)"), F.lit(60).cast("decimal(38,18)"), F.lit(None).cast("string"))
    return table(spark, sf_dir, "events").select("event_id", graded.alias("g")).select("event_id", "g.*")


@query("select doc_id, 1e0 as format, case when quality = 1 then 1e0 else 0e0 end pathogenicity, case when toxic = 1 then 1e0 else 0e0 end diseases, case when quality = 1 and toxic = 1 then 1e0 else 0e0 end reward from labels")
def grade_set(spark, sf_dir):
    label = F.when(F.col("quality") == 1, F.lit("benign")).otherwise(F.lit("pathogenic"))
    said = F.lit('{"pathogenicity": "benign", "diseases": ["Ab_C", "x"]}')
    names = F.when(F.col("toxic") == 1, F.array(F.lit("X"), F.lit("ab c"))).otherwise(F.array(F.lit("other")))
    return table(spark, sf_dir, "labels").select("doc_id", grade.label_and_names(said, label, names).alias("g")).select("doc_id", "g.*")


@query("select event_id, case event_id % 4 when 0 then 'correct' when 1 then 'incorrect' else 'invalid' end status from events")
def grade_bool(spark, sf_dir):
    said = F.expr("""case event_id % 4 when 0 then '{"stable": true}' when 1 then '{"stable": false}' when 2 then '{"stable": 1}' else '{"stable": true, "stable": true}' end""")
    return table(spark, sf_dir, "events").select("event_id", grade.json_bool(said, "stable", F.lit(True))["status"].alias("status"))


@query("""select event_id, event_id % 9 in (0, 5, 6, 7, 8) as is_object, case event_id % 9 when 0 then cast(json_extract(props, '$.k') as bigint) when 7 then 3 when 8 then 1 end k,
 event_id % 9 in (0, 5, 6, 7) as exact from events""")
def strict_json_status(spark, sf_dir):
    forms = F.expr("""case event_id % 9 when 0 then props when 1 then props || 'x' when 2 then '[' || props || ']' when 3 then '{"k":1,"k":2}' when 4 then '{"k":NaN}' when 5 then '{"k":2.0}' when 6 then '{"k":true}' when 7 then ' {"k": 3} ' else '{"k":1,"z":2}' end""")
    whole = validate.strict_object(forms)
    return table(spark, sf_dir, "events").select("event_id", whole.isNotNull().alias("is_object"), validate.strict_int(whole, "$.k").alias("k"), F.coalesce(whole.isNotNull() & validate.has_exact_keys(forms, ["k"]), F.lit(False)).alias("exact"))


@query("select lang, count(*) planned, count(quality) scored, count(*) filter (quality = 1) correct, (count(*) filter (quality = 1)) / count(*) accuracy from documents left join labels using (doc_id) group by lang")
def planned_left_join_accuracy(spark, sf_dir):
    rows = joins.planned_outcomes(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id")
    return stats.accuracy(rows, "lang", "quality")


_W = "case when k = 0 then 0.0 else greatest(0.0, (k / n + {z} * {z} / (2 * n)) / (1 + {z} * {z} / n) - {z} * sqrt(k / n * (1 - k / n) / n + {z} * {z} / (4 * n * n)) / (1 + {z} * {z} / n)) end low, case when k = n then 1.0 else least(1.0, (k / n + {z} * {z} / (2 * n)) / (1 + {z} * {z} / n) + {z} * sqrt(k / n * (1 - k / n) / n + {z} * {z} / (4 * n * n)) / (1 + {z} * {z} / n)) end high".format(z=stats.Z)


@query(f"with g as (select source, count(*) filter (quality = 1) k, count(*) n from documents join labels using (doc_id) group by source), w as (select source, {_W} from g) select source, round(low, 9) low, round(high, 9) high from w")
def wilson_by_group(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels"), "doc_id")
    counted = rows.groupBy("source").agg(F.count_if(F.col("quality") == 1).alias("k"), F.count("*").alias("n"))
    return counted.select("source", stats.wilson(F.col("k"), F.col("n")).alias("w")).select("source", F.round("w.low", 9).alias("low"), F.round("w.high", 9).alias("high"))


@query("select lang, round((count(*) filter (toxic = 1)) / count(*), 9) low, round((count(*) filter (toxic = 1) + count(*) - count(toxic)) / count(*), 9) high from documents left join labels using (doc_id) group by lang")
def missing_bounds(spark, sf_dir):
    rows = joins.planned_outcomes(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id")
    counted = rows.groupBy("lang").agg(F.count_if(F.col("toxic") == 1).alias("e"), F.count("toxic").alias("j"), F.count("*").alias("n"))
    bounds = stats.missing_bounds(F.col("e"), F.col("j"), F.col("n"))
    return counted.select("lang", F.round(bounds["low"], 9).alias("low"), F.round(bounds["high"], 9).alias("high"))


@query("select n_nationkey, round(1 - pow(0.025, 1 / (n_nationkey + 1)), 9) upper from nation")
def exact_zero_upper(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", F.round(stats.exact_upper_bound(F.col("n_nationkey") + 1), 9).alias("upper"))


@query("select count(*) filter (quality = 0 and toxic = 1) fp, count(*) filter (quality = 0) n_invalid, count(*) filter (quality = 1 and toxic = 1) fn, count(*) filter (quality = 1) n_valid, round(count(*) filter (quality = 0 and toxic = 1) / count(*) filter (quality = 0), 9) fp_rate from labels")
def error_rates(spark, sf_dir):
    q, t = F.col("quality"), F.col("toxic") == 1
    found = stats.error_rates(table(spark, sf_dir, "labels"), t, t, q == 0, q == 1)
    return found.select("fp", "n_invalid", "fn", "n_valid", F.round("fp_rate", 9).alias("fp_rate"))


@query("with c as (select quality, count(*) n, avg(case when toxic = 0 then 1e0 else 0e0 end) r from labels group by quality) select round(avg(r), 9) balanced_accuracy, round(max(n) / sum(n), 9) majority_baseline from c")
def balanced_accuracy(spark, sf_dir):
    found = stats.balanced_accuracy(table(spark, sf_dir, "labels"), "quality", F.col("toxic") == 0)
    return found.select(F.round("balanced_accuracy", 9).alias("balanced_accuracy"), F.round("majority_baseline", 9).alias("majority_baseline"))


@query(f"with g as (select lang, count(*) filter (toxic = 1) k, count(*) n from documents join labels using (doc_id) group by lang), w as (select lang, {_W} from g) select lang, low > 0.10 and high < 0.70 as passed from w")
def status_gate(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id")
    counted = rows.groupBy("lang").agg(F.count_if(F.col("toxic") == 1).alias("k"), F.count("*").alias("n"))
    return counted.select("lang", stats.gate(stats.wilson(F.col("k"), F.col("n")), F.lit(0.0), F.lit(0.0)).alias("passed"))


@query("select count(*) filter (abs(c_acctbal) <= 50) n from customer")
def near_threshold(spark, sf_dir):
    return table(spark, sf_dir, "customer").agg(stats.near_threshold(F.col("c_acctbal"), 50).alias("n"))


@query("select l_orderkey, l_linenumber, round(l_extendedprice - l_quantity * p_retailprice, 6) delta from lineitem join part on p_partkey = l_partkey where l_quantity = 50")
def signed_errors(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").where("l_quantity = 50").join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice"), "l_partkey")
    return lines.select("l_orderkey", "l_linenumber", F.round(stats.signed_error(F.col("l_extendedprice"), F.col("l_quantity") * F.col("p_retailprice"))["delta"], 6).alias("delta"))


@query("select doc_id, case when toxic = 0 then quality when quality = 1 - toxic then quality else 2 end verdict from labels")
def staged_resolution(spark, sf_dir):
    q, t = F.col("quality"), F.col("toxic")
    return table(spark, sf_dir, "labels").select("doc_id", stats.resolve(q, t == 1, 1 - t, F.lit(2)).alias("verdict"))


@query("select event_id, should_pass, cast(case when should_pass then 1e0 else 0e0 end as double) reward from events, (values (true), (false)) s(should_pass)")
def paired_calibration(spark, sf_dir):
    from sievemill.operators.sample import wrong_alternative

    v = F.get_json_object("props", "$.k").cast("long")
    events = table(spark, sf_dir, "events").select("event_id", v.alias("gold"), wrong_alternative(v, F.lit(100), F.col("event_id"), "pc").alias("wrong"))
    text_of = lambda c: F.concat(F.lit('{"k": '), c.cast("string"), F.lit("}"))
    both = stats.paired_candidates(events, "event_id", text_of(F.col("gold")), text_of(F.col("wrong"))).join(events.select("event_id", "gold"), "event_id")
    return both.select("event_id", "should_pass", grade.json_int(F.col("candidate"), "k", F.lit(100), F.col("gold")).alias("reward"))


@query()
def bootstrap_interval(spark, sf_dir):
    """All 100,000 resamples of a published audit."""
    return stats.bootstrap_interval(table(spark, sf_dir, "labels"), "quality")


@query("select event_type, count(*) n from events where event_type <> 'view' group by event_type")
def exception_histogram(spark, sf_dir):
    return aggregate.counts(table(spark, sf_dir, "events").where("event_type <> 'view'"), "event_type")


@query("select date_trunc('hour', ts) as start, event_type, count(*) n from events group by all")
def hourly_counts(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("select l_returnflag, l_linestatus, sum(l_quantity) sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) revenue, count(*) n from lineitem where l_shipdate <= timestamp '1998-09-02' group by grouping sets ((l_returnflag, l_linestatus), (l_returnflag), ())")
def rollup_sql(spark, sf_dir):
    return spark.sql("select l_returnflag, l_linestatus, sum(l_quantity) sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) revenue, count(*) n from {t} where l_shipdate <= timestamp '1998-09-02' group by rollup (l_returnflag, l_linestatus)", t=table(spark, sf_dir, "lineitem"))
