"""Line dedup by a log-template tree, in DataFrame operations only.

Lines descend a tree of fixed depth: by their token count, then by their leading tokens, tokens with a digit being
variable. A leaf that holds lines of enough documents generalises them: a token is constant at its position where a
share of the leaf's documents has it there, and variable otherwise. Two shares are in use, so that a leaf may hold
several templates as well as fields with few values; both are shares, so that more documents of the same kind give the
same templates. A line's templates are the line itself and its constants at each share, if these are enough of its
tokens. A template of enough documents recurs, and its lines are dropped from all documents but the first.

Tokens, leaves and templates are carried as 64-bit hashes. Every count groups by (leaf, token) or (leaf, template)
with partial sums, so a line in a third of all documents is a row a task. A leaf's constants are at most
100 / NARROW tokens a position, times the lines that its documents have there on average.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.llm.common import cut, dealt, release, tuck, untuck, words

#: Leading tokens on the path to a leaf.
DEPTH = 4
#: Lines of fewer tokens aren't looked at: a lone word or bracket says nothing by itself.
LEAST_TOKENS = 2
#: Lines of fewer tokens recur only as they are.
GENERAL_TOKENS = 6
#: Documents that make a leaf, a constant and a template.
LEAST_DOCS = 10
#: Shares of a leaf's documents, in percent, that make a token constant.
NARROW, WIDE = 10, 50
#: Share of constant tokens below which a line has no general template.
CONSTANT_PERCENT = 60
NO_ID = (1 << 63) - 1


def _leaf(tokens: Column, depth: int) -> Column:
    lead = F.transform(F.slice(tokens, 1, depth), lambda t: F.when(t.rlike("[0-9]"), F.lit("<*>")).otherwise(t))
    return F.xxhash64(F.size(tokens), lead)


def _keys(tokens: Column) -> Column:
    return F.transform(tokens, lambda t, i: F.xxhash64(i, t))


def _by_documents(rows: DataFrame, *keys: str) -> DataFrame:
    """rows (doc, text_key, *keys) counted by keys, once a document."""
    return rows.groupBy("doc", "text_key", *keys).agg(F.lit(1).alias("one")).groupBy(*keys)


def recurring_lines(docs: DataFrame, least_docs: int = LEAST_DOCS, depth: int = DEPTH, least_tokens: int = LEAST_TOKENS) -> DataFrame:
    """(doc, text_key, dropped: the line numbers to drop, from 0) of documents that lose lines; docs has (doc, text_key, text)."""
    row = ["doc", "text_key"]
    lines = docs.select(*row, F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")).withColumn("tokens", words(F.col("line")))
    lines = lines.where(F.size("tokens") >= least_tokens)
    short = F.when(F.size("tokens") < GENERAL_TOKENS, F.xxhash64(_keys(F.col("tokens"))))
    paths = cut(lines.select(*row, "line_no", _leaf(F.col("tokens"), depth).alias("leaf"), short.alias("template")))
    # Tables of recurring leaves, constants and templates are written, so that each join with them has an exchange on
    # both sides: a leaf with a third of all lines is then split among tasks, or the table is broadcast for its known size.
    leaves = cut(_by_documents(paths, "leaf").agg(F.count("*").alias("docs")).where(F.col("docs") >= least_docs))
    found = paths.join(leaves.select("leaf"), "leaf")
    marks = found.where(F.col("template").isNull()).groupBy(*row).agg(F.collect_list(F.struct("line_no", "leaf")).alias("marks"))
    held = docs.join(marks, row).withColumn("lines", F.split("text", "\n", -1))
    marked = lambda m: F.struct(m["line_no"].alias("line_no"), m["leaf"].alias("leaf"), F.element_at("lines", m["line_no"] + 1).alias("line"))
    general = cut(held.select(*row, F.explode(F.transform("marks", marked)).alias("m")).select(*row, "m.line_no", "m.leaf", _keys(words(F.col("m.line"))).alias("keys")))
    # A document votes once for a token of a leaf, by all its lines there.
    votes = general.groupBy(*row, "leaf").agg(F.array_distinct(F.flatten(F.collect_list("keys"))).alias("keys")).select("leaf", F.explode("keys").alias("key"))
    counted = votes.groupBy("leaf", "key").agg(F.count("*").alias("votes")).where(F.col("votes") >= least_docs).join(leaves, "leaf").where(100 * F.col("votes") >= NARROW * F.col("docs"))
    at_share = [F.collect_list(F.when(100 * F.col("votes") >= share * F.col("docs"), F.col("key"))).alias(name) for name, share in (("narrow", NARROW), ("wide", WIDE))]
    constant = cut(counted.groupBy("leaf").agg(*at_share))
    fixed = [F.array_intersect("keys", F.coalesce(c, F.array().cast("array<long>"))) for c in ("narrow", "wide")]
    enough = lambda x: 100 * F.size(x) >= CONSTANT_PERCENT * F.size("keys")
    templates = F.array_distinct(F.array_compact(F.array(F.xxhash64("keys"), *[F.when(enough(x), F.xxhash64(x)) for x in fixed])))
    typed = cut(general.join(constant, "leaf", "left").select(*row, "line_no", "leaf", F.explode(templates).alias("template")).unionByName(found.where(F.col("template").isNotNull())))
    one = typed.groupBy(*row, "leaf", "template").agg(F.lit(1).alias("one"))
    recurring = cut(one.groupBy("leaf", "template").agg(F.count("*").alias("docs"), F.min(F.struct("doc", "text_key")).alias("first")).where(F.col("docs") >= least_docs))
    gone = typed.join(recurring.select("leaf", "template", "first"), ["leaf", "template"]).where((F.col("doc") != F.col("first.doc")) | (F.col("text_key") != F.col("first.text_key")))
    dropped = cut(gone.groupBy(*row).agg(F.array_distinct(F.collect_list("line_no")).alias("dropped")))
    release(paths, leaves, general, constant, typed, recurring)
    return dropped


def drop_lines(docs: DataFrame, least_docs: int = LEAST_DOCS, depth: int = DEPTH, least_tokens: int = LEAST_TOKENS) -> DataFrame:
    """docs with text without its recurring lines, n_lines (before) and n_dropped; all rows stay, some with empty text.

    A null text has no lines and stays null; lines of any length and texts of any number of lines are taken whole. The
    first document of a template is that with the smallest doc_id, null last, and it keeps that template's lines, unless
    a wider template that they have too comes first elsewhere. Rows that are equal in doc_id and text count as one document and are treated
    alike. n_lines and n_dropped replace columns of these names; other columns stay as they are. An empty table gives an
    empty table."""
    keyed = docs.withColumn("_doc", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).withColumn("_text_key", F.xxhash64("text"))
    # Texts meet the lines of interest, and then the lines to drop: they are dealt once for both joins.
    keyed = dealt(keyed, "_doc", "_text_key")
    slim = keyed.select(F.col("_doc").alias("doc"), F.col("_text_key").alias("text_key"), "text")
    dropped = recurring_lines(slim, least_docs, depth, least_tokens).select(F.col("doc").alias("_doc"), F.col("text_key").alias("_text_key"), F.col("dropped").alias("_dropped"))
    lines = F.split("text", "\n", -1)
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("_dropped", i)), "\n")
    joined = keyed.join(dropped, ["_doc", "_text_key"], "left").withColumn("n_lines", F.coalesce(F.size(lines), F.lit(0)).cast("long")).withColumn("n_dropped", F.coalesce(F.size("_dropped"), F.lit(0)).cast("long"))
    return joined.withColumn("text", F.when(F.col("_dropped").isNull(), F.col("text")).otherwise(kept)).drop("_doc", "_text_key", "_dropped")


def clean_documents(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, n_chars and others, of any names) without recurring lines; n_chars follows a text that changed."""
    cleaned = drop_lines(tuck(docs, "doc_id", "text", "n_chars"))
    counted = cleaned.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return untuck(counted, docs.columns, "doc_id", "text", "n_chars")


def op5_line_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


#: The same over plain strings and lists; null doc_id and repeated rows, which the tables don't have, are left out.
OP5_SQL = f"""
with d as (select doc_id, string_split(text, chr(10)) ls from documents),
l as (select doc_id, unnest(range(len(ls))) line_no, unnest(ls) line from d),
t as (select doc_id, line_no, list_filter(regexp_split_to_array(line, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') tk from l),
p as (select doc_id, line_no, tk, len(tk) n, list_transform(tk[1:{DEPTH}], lambda x: case when regexp_matches(x, '[0-9]') then '<*>' else x end) lead from t where len(tk) >= {LEAST_TOKENS}),
leaf as (select n, lead, count(distinct doc_id) docs from p group by n, lead having count(distinct doc_id) >= {LEAST_DOCS}),
s as (select p.*, docs from p join leaf using (n, lead)),
x as (select n, lead, docs, doc_id, line_no, unnest(range(n)) pos, unnest(tk) tok from s),
c as (select n, lead, pos, tok, 100 * count(distinct doc_id) >= {WIDE} * any_value(docs) wide from x where n >= {GENERAL_TOKENS} group by n, lead, pos, tok
  having count(distinct doc_id) >= {LEAST_DOCS} and 100 * count(distinct doc_id) >= {NARROW} * any_value(docs)),
m as (
  select n, lead, doc_id, line_no, list({{'pos': pos, 'tok': tok}} order by pos) template from x group by n, lead, doc_id, line_no
  union select n, lead, doc_id, line_no, list({{'pos': pos, 'tok': tok}} order by pos) from x join c using (n, lead, pos, tok) group by n, lead, doc_id, line_no having 100 * count(*) >= {CONSTANT_PERCENT} * n
  union select n, lead, doc_id, line_no, list({{'pos': pos, 'tok': tok}} order by pos) from x join c using (n, lead, pos, tok) where wide group by n, lead, doc_id, line_no having 100 * count(*) >= {CONSTANT_PERCENT} * n),
f as (select n, lead, template, min(doc_id) first_doc from m group by n, lead, template having count(distinct doc_id) >= {LEAST_DOCS}),
g as (select doc_id, list(distinct line_no) gone from m join f using (n, lead, template) where doc_id <> first_doc group by doc_id)
select d.doc_id, cast(len(ls) as bigint) n_lines, cast(coalesce(len(gone), 0) as bigint) n_dropped,
  sha256(array_to_string(list_filter(ls, lambda y, i: not list_contains(coalesce(gone, []), i - 1)), chr(10))) kept_sha256
from d left join g using (doc_id)"""
