"""Queries of grouping, sampling, joins and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievemill.functions import sequences
from sievemill.operators import aggregate, curate, group, joins, project, sample, validate
from sievemill.plans.registry import dna, dna_sql, query, table

_KEYED = """j as (select d.doc_id, sha256(lower(trim(d.text, ' '))) k, d.source, cast(l.quality as varchar) quality
  from documents d left join labels l using (doc_id)),
 e as (select doc_id, k, {sig} sig, row_number() over (partition by k order by doc_id) rn from j where quality is not null),
 c as (select k, count(distinct sig) n from e group by k)"""
_EXCLUDED = "with " + _KEYED + """
select doc_id, cast(case when n > 1 then 'conflict' when rn > 1 then 'duplicate' end as varchar) reason from e join c using (k)
union all select doc_id, 'missing' from j where quality is null"""


def _exclude(spark, sf_dir, signature):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2(F.lower(F.trim("text")), 256).alias("k"))
    rows = docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return group.exclude_duplicates(rows, "k", "doc_id", signature, F.col("quality").isNull()).select("doc_id", "reason")


@query(_EXCLUDED.format(sig="source"))
def exclude_dup_conflict(spark, sf_dir):
    return _exclude(spark, sf_dir, "source")


@query(_EXCLUDED.format(sig="quality"))
def exclude_dup_by_label(spark, sf_dir):
    return _exclude(spark, sf_dir, "quality")


@query("""with g as (select sha256(text) k, count(*) n, min(doc_id) f, min(source) <> max(source) mixed from documents group by 1 having count(*) > 1)
select count(*) n_groups, cast(coalesce(sum(n), 0) as bigint) n_rows, cast(count(*) filter (mixed) as bigint) n_conflicting,
 (select array_to_string(list(f order by f), ',') from (select f from g order by f, k limit 5)) examples from g""")
def dup_report(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2("text", 256).alias("k"))
    return group.duplicate_report(docs, "k", "doc_id", "source").withColumn("examples", F.array_join(F.transform("examples", lambda x: x.cast("string")), ","))


@query("select min(conv_id * 1000 + turn) first_id from conversations where role = 'user' group by lower(trim(text, ' '))")
def norm_question_dedup(spark, sf_dir):
    asked = table(spark, sf_dir, "conversations").where("role = 'user'").select((F.col("conv_id") * 1000 + F.col("turn")).alias("first_id"), "text")
    return group.first_by_normal_form(asked, "text", ["first_id"]).select("first_id")


@query("select user_id, max_by(event_id, ts) event_id from events group by user_id")
def latest_event(spark, sf_dir):
    return group.latest(table(spark, sf_dir, "events"), "user_id", ["ts"]).select("user_id", "event_id")


@query("select event_type, min(event_id) first from events group by event_type")
def ordered_event_types(spark, sf_dir):
    return group.ordered_distinct(table(spark, sf_dir, "events"), "event_type", "event_id")


@query("""with p as (select conv_id, turn, text passage, row_number() over (partition by conv_id, text order by turn) n from conversations where text <> '')
select conv_id, substr(string_agg(passage, ' ' order by turn), 1, 7000) as text from p where n = 1 group by conv_id""")
def distinct_passages(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("passage"))
    return group.distinct_passages(turns, ["conv_id"], "passage", "turn")


@query("""with k as (select doc_id, least(s, reverse(translate(s, 'ACGT', 'TGCA'))) c from (select doc_id, """ + dna_sql() + """ s from documents))
select sha256(c) sequence_id, count(*) n, min(doc_id) first_doc from k group by c""")
def canonical_sequences(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", sequences.canonical_orientation(dna(F.col("text"))).alias("c"))
    return docs.groupBy(F.sha2("c", 256).alias("sequence_id")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))


_EDGES = "select n_nationkey a, 100 + s_suppkey b from {n} join {s} on s_nationkey = n_nationkey union all select n_nationkey, 100000000 + c_custkey from {n} join {c} on c_nationkey = n_nationkey"


@query(f"""with recursive e as ({_EDGES.format(n="nation", s="supplier", c="customer")}), b as (select a, b from e union select b, a from e),
 r(node, reach) as (select a, a from b union select r.node, b.b from r join b on b.a = r.reach)
select cast(node as bigint) node, cast(min(reach) as bigint) component from r group by node""")
def components(spark, sf_dir):
    tables = {k[0]: table(spark, sf_dir, k) for k in ("nation", "supplier", "customer")}
    edges = spark.sql(_EDGES, **tables)
    return group.components(edges.select(F.col("a").cast("long"), F.col("b").cast("long")))


@query("""with recursive e as (select distinct d1.doc_id a, d2.doc_id b from documents d1 join documents d2 on d1.text = d2.text and d1.doc_id < d2.doc_id),
 b as (select a, b from e union select b, a from e), r(node, reach) as (select a, a from b union select r.node, b.b from r join b on b.a = r.reach),
 l as (select node, min(reach) component from r group by node)
select component, sha256(string_agg(cast(node as varchar), chr(10) order by cast(node as varchar))) group_id from l group by component""")
def copy_group_digests(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("k"))
    # A star around each text's first document: as many edges as copies.
    first = docs.groupBy("k").agg(F.min("doc_id").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    return group.group_digest(group.components(docs.join(first, "k").where("doc_id <> a").select("a", F.col("doc_id").alias("b"))))


_CONTAINED = """with recursive s as (select item_id node, """ + dna_sql() + """ s from benchmark), q as (select node, s from s union select node, reverse(translate(s, 'ACGT', 'TGCA')) from s),
 b as (select distinct s.node a, q.node b from s join q on contains(s.s, q.s) where s.node <> q.node), e as (select a, b from b union select b, a from b),
 r(node, reach) as (select node, node from s union select r.node, e.b from r join e on e.a = r.reach), l as (select node, min(reach) c from r group by node),
 g as (select c, sha256(string_agg(cast(node as varchar), chr(10) order by cast(node as varchar))) group_id from l group by c)
select node as item_id, group_id from l join g using (c)"""


@query(_CONTAINED)
def containment_groups(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark").select("item_id", dna(F.col("text")).alias("s"))
    return curate.containment_groups(items, "item_id", "s")


@query("""with s as (select item_id, """ + dna_sql() + """ s from benchmark),
 g as (select item_id, (200 * length(replace(replace(s, 'A', ''), 'T', '')) + length(s)) // (2 * length(s)) gc from s)
select item_id, gc = 45 + item_id % 11 and gc <> 45 + (item_id // 2) % 11 as valid from g""")
def computed_gold(spark, sf_dir):
    s = dna(F.col("text"))
    stated, other = (45 + F.col("item_id") % 11).cast("string"), (45 + F.floor(F.col("item_id") / 2) % 11).cast("string")
    items = table(spark, sf_dir, "benchmark").select("item_id", F.concat(F.lit("GC percent of "), s).alias("q"), stated.alias("ideal"), other.alias("other"))
    checked = curate.computed_gold(F.lit("Prop-seq-gcpercent"), F.col("q"), F.col("ideal"), F.array("other"))
    return items.select("item_id", checked["valid"].alias("valid"))


@query("select source from documents where lang = 'de' intersect select source from documents where lang = 'es'")
def shared_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return group.disjoint(docs.where("lang = 'de'"), docs.where("lang = 'es'"), "source")


@query("select doc_id from documents order by sha256('s1:' || cast(doc_id as varchar)), doc_id limit 100")
def hash_sample(spark, sf_dir):
    return sample.hash_sample(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 100, "s1")


@query("select doc_id, lang from (select doc_id, lang, row_number() over (partition by lang order by sha256('s2:' || cast(doc_id as varchar)), doc_id) n from documents) where n <= 20")
def stratified_sample(spark, sf_dir):
    return sample.stratified(table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", "doc_id", 20, "s2")


_QUOTAS = """s as (select {g} g, count(*) n from {t} group by 1), f as (select g, n * {k} // sum(n) over () fl, n * {k} % sum(n) over () rm from s),
 q as (select g, fl + case when row_number() over (order by rm desc, g) <= {k} - sum(fl) over () then 1 else 0 end quota from f)"""


@query("with " + _QUOTAS.format(g="lang", t="documents", k=80) + ", r as (select doc_id, lang, row_number() over (partition by lang order by sha256('s3:' || cast(doc_id as varchar)), doc_id) n from documents) select doc_id, lang from r join q on g = lang where n <= quota")
def quota_sample(spark, sf_dir):
    return sample.quota_sample(table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", "doc_id", 80, "s3")


@query("with " + _QUOTAS.format(g="source", t="documents", k=77) + " select g as source, cast(quota as bigint) quota from q")
def largest_remainder_quotas(spark, sf_dir):
    sizes = aggregate.counts(table(spark, sf_dir, "documents"), "source")
    return sample.largest_remainder(sizes, "source", "n", 77).select("source", "quota")


@query("select source, arg_min(doc_id, sha256('s4:representative:' || cast(doc_id as varchar))) representative from documents group by source")
def group_representative(spark, sf_dir):
    return sample.representatives(table(spark, sf_dir, "documents"), "source", "doc_id", "s4")


@query("""with p as (select arg_min(doc_id, sha256('s5:representative:' || cast(doc_id as varchar))) doc_id from documents group by text),
 d as (select doc_id, lang from documents join p using (doc_id)), """ + _QUOTAS.format(g="lang", t="d", k=40) + """,
 r as (select doc_id, lang, row_number() over (partition by lang order by sha256('s5:' || cast(doc_id as varchar)), doc_id) n from d) select doc_id, lang from r join q on g = lang where n <= quota""")
def representative_sample(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.sha2("text", 256).alias("k"))
    return sample.representative_quota_sample(docs, "k", "lang", "doc_id", 40, "s5").select("doc_id", "lang")


@query("""with r as (select doc_id, row_number() over (partition by source order by n_chars desc, doc_id desc) n, source, n_chars from documents),
 m as (select source, max(n_chars * 10000000 + doc_id) most from documents group by source)
select doc_id from r join m using (source) order by n, most desc, n_chars desc, doc_id desc limit 50""")
def round_robin_select(spark, sf_dir):
    return sample.round_robin(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), "source", ["n_chars", "doc_id"], 50).select("doc_id")


@query("""with g as (select source, row_number() over (order by source) n, count(*) over () k from (select distinct source from documents))
select doc_id, case when n <= greatest(1, round_even(k * 0.125, 0)) then 'validation' else 'test' end split from documents join g using (source)""")
def disjoint_split(spark, sf_dir):
    return sample.disjoint_split(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", 0.125).select("doc_id", "split")


@query("with s as (select doc_id, sha256('s1:' || cast(doc_id as varchar)) h from documents order by h, doc_id limit 100) select doc_id, 'blind-' || lpad(cast(row_number() over (order by h, doc_id) - 1 as varchar), 3, '0') opaque_id from s")
def blind_ids(spark, sf_dir):
    drawn = sample.hash_sample(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 100, "s1")
    return sample.opaque_ids(drawn, sample.hash_order(F.col("doc_id"), "s1"), "blind")


@query("select lang, count(*) / 20 weight from documents group by lang")
def sampling_weight(spark, sf_dir):
    return aggregate.counts(table(spark, sf_dir, "documents"), "lang").select("lang", sample.sampling_weight(F.col("n"), 20).alias("weight"))


@query("""with o as (select event_id, cast(json_extract(props, '$.k') as bigint) v from events),
 a as (select event_id, v, list_filter(range(0, 101), lambda x: x <> v) others, cast(('0x' || substr(sha256('s6:' || cast(event_id as varchar)), 1, 8)) as bigint) h from o)
select event_id, v, others[h % len(others) + 1] wrong from a""")
def wrong_alternative(spark, sf_dir):
    v = F.get_json_object("props", "$.k").cast("long")
    return table(spark, sf_dir, "events").select("event_id", v.alias("v"), sample.wrong_alternative(v, F.lit(100), F.col("event_id"), "s6").cast("long").alias("wrong"))


@query("""with o as (select p_partkey, [p_name, p_brand, p_type, cast(p_size as varchar)] x from part), k as (select p_partkey, x, unnest(range(4)) i from o),
 r as (select p_partkey, i, x[i + 1] t, row_number() over (partition by p_partkey order by sha256('s7:' || cast(p_partkey as varchar) || ':' || cast(i as varchar))) n from k)
select p_partkey, string_agg(chr(cast(64 + n as int)) || '. ' || t, chr(10) order by n) options, max(case when i = 0 then chr(cast(64 + n as int)) end) gold from r group by p_partkey""")
def shuffled_options(spark, sf_dir):
    from sievemill.functions.text import option_list

    part = table(spark, sf_dir, "part")
    mixed = sample.shuffled_options(F.array("p_name", "p_brand", "p_type", F.col("p_size").cast("string")), F.col("p_partkey"), "s7")
    return part.select("p_partkey", mixed.alias("m")).select("p_partkey", option_list(F.col("m.options")).alias("options"), F.col("m.gold").alias("gold"))


@query("select event_id, user_id from events anti join (select event_id from events where event_type = 'error') using (event_id) where event_id not in (select event_id from events where value < 5)")
def resume_anti_join(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return sample.unfinished(events, events.where("event_type = 'error'"), events.where("value < 5"), key="event_id").select("event_id", "user_id")


@query("select i.pos, d.doc_id, d.lang from (values (0, 7), (1, 3), (2, 5)) i(pos, doc_id) join documents d on d.doc_id = i.doc_id")
def requested_ids(spark, sf_dir):
    ids = spark.createDataFrame([(0, 7), (1, 3), (2, 5)], "pos int, doc_id long")
    return sample.take_ids(table(spark, sf_dir, "documents").select("doc_id", "lang"), ids, "doc_id", "pos").select("pos", "doc_id", "lang")


@query("select doc_id, lang from documents order by doc_id limit 25")
def source_order_limit(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang").orderBy("doc_id").limit(25)


@query("select l_orderkey, l_partkey, p_name from lineitem join part on p_partkey = l_partkey where l_quantity > 45 and l_returnflag in ('A', 'R') and p_type = 'ECONOMY'")
def lookup_join(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").where("l_quantity > 45 and l_returnflag in ('A', 'R')").select("l_orderkey", F.col("l_partkey").alias("p_partkey"))
    found = joins.lookup(lines, table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type"), "p_partkey")
    return found.where("p_type = 'ECONOMY'").select("l_orderkey", F.col("p_partkey").alias("l_partkey"), "p_name")


@query("""select c_custkey, cast(case when n is null then 'missing_orders' end as varchar) reason, n from customer left join (select o_custkey c_custkey, count(*) n from orders where o_orderstatus = 'F' and o_totalprice > 300000 group by 1) using (c_custkey)""")
def two_source_eligibility(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'F' and o_totalprice > 300000").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    good, bad = joins.eligible(customers, orders, "c_custkey", "missing_orders")
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad.withColumn("n", F.lit(None).cast("long"))).select("c_custkey", "reason", "n")


@query("""with p as (select s_suppkey pair_id, s_suppkey * 7 a, s_suppkey * 11 + 1 b from supplier), r as (select l_orderkey, count(*) n, max(l_quantity) q from lineitem where l_linenumber <= 2 group by 1)
select pair_id, coalesce(x.n, 0) n_a, coalesce(y.n, 0) n_b, case when x.n = 1 then x.q end l_quantity_a, case when y.n = 1 then y.q end l_quantity_b
from p left join r x on x.l_orderkey = a left join r y on y.l_orderkey = b""")
def pair_side_join(spark, sf_dir):
    pairs = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("pair_id"), (F.col("s_suppkey") * 7).alias("left_key"), (F.col("s_suppkey") * 11 + 1).alias("right_key"))
    lines = table(spark, sf_dir, "lineitem").where("l_linenumber <= 2").select("l_orderkey", "l_quantity")
    return joins.pair_sides(pairs, lines, "pair_id", {"a": "left_key", "b": "right_key"}, "l_orderkey", ["l_quantity"])


@query("select l_orderkey, l_linenumber, l_partkey from lineitem join part on p_partkey = l_partkey where abs(l_extendedprice / l_quantity - p_retailprice) <= 25")
def tolerance_join(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit"))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return joins.tolerant_join(lines, parts, ["p_partkey"], F.col("unit"), F.col("p_retailprice"), 25.0).select("l_orderkey", "l_linenumber", F.col("p_partkey").alias("l_partkey"))


@query("select coalesce(d.doc_id, l.doc_id) doc_id, case when l.doc_id is null then 'left' else 'right' end side from (select distinct doc_id from documents where n_chars > 2000) d full outer join (select distinct doc_id from labels) l on d.doc_id = l.doc_id where d.doc_id is null or l.doc_id is null")
def key_set_equality(spark, sf_dir):
    return joins.keys_match(table(spark, sf_dir, "documents").where("n_chars > 2000"), table(spark, sf_dir, "labels"), "doc_id")


@query("select doc_id from documents where doc_id not in (select doc_id from labels)")
def missing_ids(spark, sf_dir):
    return joins.missing_keys(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


@query("select d.doc_id, b.item_id from documents d join benchmark b on contains(d.text, b.text)")
def containment_join(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("item"))
    return joins.containment_join(docs, items, "text", "item", ["doc_id"], ["item_id"]).select("doc_id", "item_id")


@query("select c_custkey, c_name, n_name from customer join nation on n_nationkey = c_nationkey where c_mktsegment = 'BUILDING'")
def relabel_join(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return joins.relabel(table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name", "c_nationkey"), nations, "c_nationkey", "n_name")


@query("select page_id, split_part(url, '://', 1) as scheme, port from pages join (values ('http', 80), ('https', 443)) s(scheme, port) on s.scheme = split_part(url, '://', 1)")
def prefix_join(spark, sf_dir):
    schemes = spark.createDataFrame([("http", 80), ("https", 443)], "scheme string, port int")
    return joins.prefix_join(table(spark, sf_dir, "pages").select("page_id", "url"), schemes, "url", "://", "scheme").select("page_id", "scheme", "port")


_RULES = [("short", "n_chars >= 300"), ("language", "lang in ('en', 'de')"), ("source", "source <> 'src0'")]


@query("select doc_id, case when not n_chars >= 300 then 'short' when not lang in ('en', 'de') then 'language' when not source <> 'src0' then 'source' end reason from documents")
def first_failure(spark, sf_dir):
    return validate.with_reason(table(spark, sf_dir, "documents"), [(n, F.expr(c)) for n, c in _RULES]).select("doc_id", "reason")


@query("select doc_id, array_to_string(list_filter([case when n_chars < 300 then 'short' end, case when lang not in ('en', 'de') then 'language' end, case when source = 'src0' then 'source' end], lambda x: x is not null), ',') reasons from documents")
def all_failures(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(validate.all_reasons([(n, F.expr(c)) for n, c in _RULES]), ",").alias("reasons"))


@query("select doc_id from documents where n_chars >= 300 and lang in ('en', 'de') and source <> 'src0'")
def valid_rows(spark, sf_dir):
    return validate.split_valid(table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source"), [(n, F.expr(c)) for n, c in _RULES])[0].select("doc_id")


_FLAGS = {"long": "n_chars > 6000", "digits": "text rlike '[0-9]{6}'", "any": "n_chars > 0"}


@query("""with f as (select doc_id, unnest(list_filter([case when n_chars > 6000 then 'long' end, case when regexp_matches(text, '[0-9]{6}') then 'digits' end, case when n_chars > 0 then 'any' end], lambda x: x is not null)) flag from documents),
 c as (select flag, count(*) n from f group by flag), t as (select count(*) total from documents)
select flag, n, doc_id as position from f join c using (flag), t where n < total union all select flag, n, null from c, t where n = total""")
def flag_counts(spark, sf_dir):
    return validate.flag_positions(table(spark, sf_dir, "documents"), {n: F.expr(c) for n, c in _FLAGS.items()}, "doc_id")


@query("select unnest(list_filter([case when count(*) filter (n_chars < 0) = 0 then 'negative' end, case when count(*) filter (lang = 'en') = 0 then 'english' end, case when count(*) filter (text is null) = 0 then 'null_text' end], lambda x: x is not null)) as name from documents")
def zero_checks(spark, sf_dir):
    checks = {"negative": F.col("n_chars") < 0, "english": F.col("lang") == "en", "null_text": F.col("text").isNull()}
    return validate.zero_checks(table(spark, sf_dir, "documents"), checks)


@query("""select 'rows' as name, count(*) as found, cast(25 as bigint) as expected, count(*) = 25 as holds from nation
union all select 'first region', count(*) filter (n_regionkey = 0), 5, count(*) filter (n_regionkey = 0) = 5 from nation
union all select 'customers', count(*), 3, count(*) = 3 from customer""")
def cardinalities(spark, sf_dir):
    nations = validate.count_status(table(spark, sf_dir, "nation"), {"rows": (F.lit(True), 25), "first region": (F.col("n_regionkey") == 0, 5)})
    return nations.union(validate.count_status(table(spark, sf_dir, "customer"), {"customers": (F.lit(True), 3)}))


@query("""select sha256(text) as key, count(*) n from documents group by 1 having count(*) > 1
union all select cast(user_id as varchar), count(*) from events group by user_id having count(*) > 1
union all select cast(doc_id as varchar), count(*) from labels group by doc_id having count(*) > 1""")
def repeated_keys(spark, sf_dir):
    texts = validate.duplicates(table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("key")), "key")
    users = validate.duplicates(table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("key")), "key")
    return texts.union(users).union(validate.duplicates(table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("key")), "key"))


@query("select conv_id, turn, text from conversations where role = 'user'")
def public_projection(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").where("role = 'user'")
    return project.public_gold(turns, "conv_id", ["turn", "text"], ["role"])[0]


@query("select page_id, i - 1 as position, p as item from (select page_id, string_split(split_part(url, '://', 2), '/') a from pages), unnest(a) with ordinality t(p, i)")
def nested_explode(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.split(F.element_at(F.split("url", "://"), 2), "/", -1).alias("parts"))
    return project.explode_items(pages, "parts").withColumn("position", F.col("position").cast("long"))


@query("select c_custkey, c_acctbal from customer where isfinite(c_acctbal) and c_mktsegment in ('BUILDING', 'MACHINERY') and contains(c_name, '#0000000') and length(trim(c_name)) > 0")
def predicates(spark, sf_dir):
    c = F.col
    return table(spark, sf_dir, "customer").where(validate.finite(c("c_acctbal")) & c("c_mktsegment").isin("BUILDING", "MACHINERY") & c("c_name").contains("#0000000") & (F.length(F.trim("c_name")) > 0)).select("c_custkey", "c_acctbal")
