"""Quality rules: thresholds per language and source from mergeable quantile sketches, then joined filtering.

Each metric of each (lang, source) has a sketch of logarithmic buckets: counts add up, so sketches merge exactly in
any order, from tasks to groups, from groups to their language and from languages to the corpus. A quantile read
from one is within ACCURACY of the true value, relatively.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemill.llm.common import Words, as_bytes, chunks, cut, gram_hashes, tuck, untuck

ACCURACY = 0.01
#: metric: (smallest spread that counts, spreads above the median at which a document is rejected, and below it or None).
FENCES = {"symbols_per_word": (0.02, 5.0, None), "dup_line_share": (0.06, 10.0, None), "word_length": (0.25, 10.0, 10.0)}
#: A group's fences count for its documents and those of its language, and of these the corpus', for so many more.
BORROWED = 100
SALTS = 16
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1


def measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    """BASE of each text."""
    w = Words(texts, lower=False)
    n = len(texts)
    out = {"n_words": np.diff(w.first)}
    total = lambda x: np.concatenate([[0], np.cumsum(x)])
    points = total((w.raw & 0xC0) != 0x80)
    out["word_chars"] = np.bincount(w.doc, points[w.ends] - points[w.starts], n).astype(np.int64)
    out["n_symbols"] = np.diff(total(_SYMBOL[w.raw])[w.offsets])
    grams = gram_hashes(w.hash, 5)
    whole = w.doc[: len(grams)] == w.doc[4:] if len(grams) else np.zeros(0, bool)
    at = np.flatnonzero(whole)
    grams, doc = grams[at], w.doc[at]
    order = np.lexsort((grams, doc))
    same = (np.diff(doc[order]) == 0) & (grams[order][1:] == grams[order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    marks = np.zeros(len(w.hash) + 1, np.int64)
    np.add.at(marks, at[twice], 1)
    np.add.at(marks, at[twice] + 5, -1)
    out["n_repeat_words"] = np.bincount(w.doc[np.cumsum(marks)[:-1] > 0], minlength=n)
    lines, dups = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i, text in enumerate(texts):
        full = [x for x in text.split(b"\n") if x and not x.isspace()]
        lines[i], dups[i] = len(full), len(full) - len(set(full))
    return out | {"n_lines": lines, "n_dup_lines": dups}


def features(df: DataFrame, text: str = "text") -> DataFrame:
    """df with the BASE columns, in place of any of these names; a null text has no words and no lines."""
    tucked = tuck(df, text)
    schema = T.StructType([*tucked.schema, *[T.StructField(c, T.LongType()) for c in BASE]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(0))
            found = [measure(texts[a:b]) for a, b in chunks([len(t) for t in texts])]
            new = [pa.array(np.concatenate([f[c] for f in found]) if found else [], pa.int64()) for c in BASE]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], schema.names)

    made = tucked.mapInArrow(run, schema)
    return made.select(*[F.col(f"`{c}`") if c == text else F.col(f"_rest.`{c}`") for c in df.columns if c not in BASE], *BASE)


def metrics() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {"symbols_per_word": F.col("n_symbols") / n, "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), "word_length": F.col("word_chars") / n}


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


_GAMMA = (1 + ACCURACY) / (1 - ACCURACY)


def bucket(value: Column) -> Column:
    """0 for 0, else 100000 + the logarithmic bucket, so that buckets sort as the values (all at least 0)."""
    return F.when(value <= 0, F.lit(0)).otherwise(F.ceil(F.log(value) / math.log(_GAMMA)) + 100_000).cast("int")


def bucket_value(b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(2 * F.pow(F.lit(_GAMMA), b - 100_000) / (_GAMMA + 1))


def thresholds(rows: DataFrame) -> DataFrame:
    """(lang_key, source_key, low_<m>, high_<m> of each metric) of every group in rows, which has the BASE columns.

    Sketches come from the documents that pass the base rules. The fences stand at the median, plus or minus a number
    of spreads; the spread is the distance from the lower quartile to the median, the half that junk hardly moves.
    """
    long = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), bucket(v).alias("bucket")) for m, v in metrics().items()]))
    keyed = rows.where(~base_failed()).select(_key("lang").alias("lang_key"), _key("source").alias("source_key"), long.alias("x")).select("lang_key", "source_key", "x.*")
    leaf = keyed.groupBy("lang_key", "source_key", "metric", "bucket").agg(F.count("*").alias("n"))
    of_lang = leaf.groupBy("lang_key", F.lit("*").alias("source_key"), "metric", "bucket").agg(F.sum("n").alias("n"))
    of_all = leaf.groupBy(F.lit("*").alias("lang_key"), F.lit("*").alias("source_key"), "metric", "bucket").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("lang_key", "source_key", "metric")
    sketch = leaf.unionByName(of_lang).unionByName(of_all).withColumn("up_to", F.sum("n").over(w.orderBy("bucket"))).withColumn("total", F.sum("n").over(w))
    quantile = lambda q: F.min(F.when(F.col("up_to") >= q * F.col("total"), F.col("bucket")))
    fence = sketch.groupBy("lang_key", "source_key", "metric").agg(F.max("total").alias("n"), bucket_value(quantile(0.25)).alias("q25"), bucket_value(quantile(0.5)).alias("q50"))
    spread, above, below = (F.element_at(F.create_map(*[F.lit(x) for m, f in FENCES.items() for x in (m, float("inf") if f[i] is None else f[i])]), F.col("metric")) for i in range(3))
    wide = F.greatest(F.col("q50") - F.col("q25"), spread)
    fence = fence.withColumn("high", F.col("q50") + above * wide).withColumn("low", F.col("q50") - below * wide)
    one = lambda c, m: F.max(F.when(F.col("metric") == m, F.col(c)))
    names = [f"{c}_{m}" for m in FENCES for c in ("low", "high")]
    flat = fence.groupBy("lang_key", "source_key").agg(F.max("n").alias("n"), *[one(c, m).alias(f"{c}_{m}") for m in FENCES for c in ("low", "high")])
    level = lambda i: [F.col("n").alias(f"n{i}"), *[F.col(x).alias(f"{x}{i}") for x in names]]
    groups = rows.select(_key("lang").alias("lang_key"), _key("source").alias("source_key")).distinct()
    own = flat.where("source_key <> '*'").select("lang_key", "source_key", *level(0))
    lang = flat.where("source_key = '*' and lang_key <> '*'").select("lang_key", *level(1))
    everything = flat.where("lang_key = '*'").select(*level(2))
    joined = groups.join(own, ["lang_key", "source_key"], "left").join(lang, "lang_key", "left").join(everything, F.lit(True), "left")
    # However small a group is, its own documents count; the more it has, the less it borrows.
    of_lang = lambda x: F.coalesce((F.col("n1") * F.col(f"{x}1") + BORROWED * F.col(f"{x}2")) / (F.col("n1") + BORROWED), F.col(f"{x}2"))
    of_group = lambda x: F.coalesce((F.col("n0") * F.col(f"{x}0") + BORROWED * of_lang(x)) / (F.col("n0") + BORROWED), of_lang(x))
    return joined.select("lang_key", "source_key", *[of_group(x).alias(x) for x in names])


def _key(name: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(name)), F.lit(""))


def judge(rows: DataFrame, fences: DataFrame) -> DataFrame:
    """rows (with the BASE columns) with base_failed and kept. The fences have a row a group; they are salted, so that
    a hot group's rows spread over tasks where the table of fences is too large to be broadcast."""
    salted = fences.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = rows.withColumn("lang_key", _key("lang")).withColumn("source_key", _key("source")).withColumn("_salt", F.pmod(F.xxhash64("n_words", "word_chars", "n_symbols"), F.lit(SALTS)).cast("int")).join(salted, ["lang_key", "source_key", "_salt"], "left")
    # A bucket's value is within ACCURACY; the fences allow for it.
    outside = F.lit(False)
    for m, v in metrics().items():
        # A mean over few words varies more, so its fences are wider.
        slack = (F.col(f"high_{m}") - F.col(f"low_{m}")) / 2 * 40 / F.greatest(F.col("n_words"), F.lit(1)) if FENCES[m][2] else F.lit(0.0)
        outside = outside | F.coalesce(v > F.col(f"high_{m}") * (1 + ACCURACY) + slack, F.lit(False)) | F.coalesce(v < F.col(f"low_{m}") * (1 - ACCURACY) - slack, F.lit(False))
    names = [f"{c}_{m}" for m in FENCES for c in ("low", "high")]
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~base_failed() & ~outside).drop("_salt", "lang_key", "source_key", *names)


def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with the columns of docs. Null text: rejected, as it has no words. Null lang or source:
    a group of its own. Repeated rows are judged alike. Other columns may have any names. An empty table gives an empty
    table."""
    tucked = tuck(docs, "text", "lang", "source")
    slim = features(docs.select("text", "lang", "source")).drop("text")
    fences = cut(thresholds(cut(slim)))
    return untuck(judge(features(tucked), fences).where("kept"), docs.columns, "text", "lang", "source")


def op7_quality(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    rows = cut(features(docs).drop("text"))
    judged = judge(rows, cut(thresholds(rows)))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lang", "source")


def _sql() -> str:
    value = {"symbols_per_word": "n_symbols / greatest(n_words, 1)", "dup_line_share": "n_dup_lines / greatest(n_lines, 1)", "word_length": "word_chars / greatest(n_words, 1)"}
    number = lambda x: "'infinity'::double" if x is None else f"{x!r}::double"
    bucket_of = lambda v: f"case when {v} <= 0 then 0 else cast(ceil(ln({v}) / {math.log(_GAMMA)!r}::double) as integer) + 100000 end"
    quantile = lambda q: f"min(bucket) filter (up_to >= {q} * total)"
    at = lambda b: f"case when {b} = 0 then 0.0::double else 2 * pow({_GAMMA!r}::double, {b} - 100000) / {_GAMMA + 1!r}::double end"
    names = [f"{c}_{m}" for m in FENCES for c in ("low", "high")]
    fences = [f"max({end}) filter (metric = '{m}') {end}_{m}" for m in FENCES for end in ("low", "high")]
    of_lang = lambda x: f"coalesce((l.n * l.{x} + {BORROWED} * e.{x}) / (l.n + {BORROWED}), e.{x})"
    of_group = [f"coalesce((o.n * o.{x} + {BORROWED} * {of_lang(x)}) / (o.n + {BORROWED}), {of_lang(x)}) {x}" for x in names]
    outside = []
    for m in FENCES:
        slack = f"(high_{m} - low_{m}) / 2 * 40 / greatest(n_words, 1)" if FENCES[m][2] else "0.0"
        outside += [f"coalesce({value[m]} > high_{m} * {1 + ACCURACY!r}::double + {slack}, false)", f"coalesce({value[m]} < low_{m} * {1 - ACCURACY!r}::double - {slack}, false)"]
    metric = lambda i: "case metric " + " ".join(f"when '{m}' then {number(f[i])}" for m, f in FENCES.items()) + " end"
    return f"""
with d as (select doc_id, lang, source, coalesce('=' || lang, '') lang_key, coalesce('=' || source, '') source_key, coalesce(text, '') text,
  list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') tk, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) ls from documents),
g as (select doc_id, i, array_to_string(tk[i : i + 4], ' ') gram from (select doc_id, tk, unnest(range(1, len(tk) - 3)) i from d)),
r as (select doc_id, gram from g group by doc_id, gram having count(*) > 1),
q as (select doc_id, count(distinct i + k) n from (select doc_id, i, unnest(range(5)) k from g join r using (doc_id, gram)) group by doc_id),
f as (select d.doc_id, lang, source, lang_key, source_key, len(tk)::bigint n_words, coalesce(list_sum(list_transform(tk, lambda x: length(x))), 0)::bigint word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint n_symbols, len(ls)::bigint n_lines, (len(ls) - len(list_distinct(ls)))::bigint n_dup_lines, coalesce(q.n, 0)::bigint n_repeat_words
  from d left join q using (doc_id)),
j as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words base_failed from f),
a as (select * from j where not base_failed),
b as ({" union all ".join(f"select lang_key, source_key, '{m}' metric, {bucket_of(v)} bucket from a" for m, v in value.items())}),
h as (select lang_key, source_key, metric, bucket, count(*) n from b group by all union all select lang_key, '*', metric, bucket, count(*) from b group by all union all select '*', '*', metric, bucket, count(*) from b group by all),
c as (select *, sum(n) over (partition by lang_key, source_key, metric order by bucket) up_to, sum(n) over (partition by lang_key, source_key, metric) total from h),
u as (select lang_key, source_key, metric, max(total) n, {quantile(0.25)} b25, {quantile(0.5)} b50 from c group by lang_key, source_key, metric),
v as (select *, {at("b25")} q25, {at("b50")} q50 from u),
w as (select *, q50 + {metric(1)} * greatest(q50 - q25, {metric(0)}) high, q50 - {metric(2)} * greatest(q50 - q25, {metric(0)}) low from v),
z as (select lang_key, source_key, max(n)::bigint n, {", ".join(fences)} from w group by lang_key, source_key),
k as (select x.lang_key, x.source_key, {", ".join(of_group)} from (select distinct lang_key, source_key from j) x
  left join (select * from z where source_key <> '*') o using (lang_key, source_key)
  left join (select * from z where source_key = '*' and lang_key <> '*') l on x.lang_key = l.lang_key left join (select * from z where lang_key = '*') e on true)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not ({" or ".join(outside)}) kept, lang, source from j join k using (lang_key, source_key)"""


#: The same over plain lists, with one count for each value's bucket; doc_id is unique in the tables.
OP7_SQL = _sql()
