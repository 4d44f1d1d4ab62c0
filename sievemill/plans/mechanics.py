"""Queries over time, stored sketches, and the heavier joins of curation."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievemill.operators import curate, sketches, timeline
from sievemill.plans.registry import query, table


@query("""with e as (select *, user_id % 2 half from events), r as (select half, ts, max(event_id) error_id, arg_max(value, event_id) error_value from e
 where event_type = 'error' group by half, ts)
select e.event_id, r.error_id, r.error_value from e asof left join r on e.half = r.half and e.ts >= r.ts""")
def asof_join(spark, sf_dir):
    """Each event with the last error up to its time among half of the users: two keys, each with half of all rows."""
    events = table(spark, sf_dir, "events").withColumn("half", F.col("user_id") % 2)
    errors = events.where("event_type = 'error'").select("half", "ts", "event_id", "value")
    found = timeline.asof_join(events.select("event_id", "half", "ts"), errors, ["half"], "ts", "ts", "error", ["event_id"], slice_rows=20_000)
    return found.select("event_id", F.col("error.event_id").alias("error_id"), F.col("error.value").alias("error_value"))


@query("""select p.o_orderkey order_before, p.o_custkey custkey, q.l_orderkey shipped, q.l_linenumber line from orders p
join (select l_orderkey, l_linenumber, l_shipdate, o_custkey, l_quantity from lineitem join orders on o_orderkey = l_orderkey) q on p.o_custkey = q.o_custkey
where p.o_orderdate < q.l_shipdate + to_days(cast(q.l_quantity as integer)) and q.l_shipdate < p.o_orderdate + interval 30 day""")
def interval_join(spark, sf_dir):
    """A customer's orders, open for 30 days each, with the lines under way in that time, for as many days as their quantity."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_shipdate", "l_quantity").join(orders, "o_orderkey")
    opened = orders.withColumn("o_end", F.col("o_orderdate") + F.expr("interval 30 days"))
    under_way = lines.withColumn("l_end", F.col("l_shipdate") + F.make_dt_interval(F.col("l_quantity").cast("int")))
    met = timeline.interval_join(opened, under_way, ["o_custkey"], ("o_orderdate", "o_end"), ("l_shipdate", "l_end"), ("p", "q"))
    return met.select(
        F.col("p.o_orderkey").alias("order_before"), F.col("p.o_custkey").alias("custkey"), F.col("q.o_orderkey").alias("shipped"), F.col("q.l_linenumber").alias("line")
    )


@query("""with g as (select user_id, ts, value, coalesce(ts - lag(ts) over (partition by user_id order by ts) > interval 6 hour, true) fresh from events),
s as (select *, sum(fresh::int) over (partition by user_id order by ts rows unbounded preceding) k from g)
select user_id, epoch_us(min(ts)) start_us, epoch_us(max(ts) + interval 6 hour) end_us, count(*) n, round(sum(value), 6) total from s group by user_id, k""")
def session_summary(spark, sf_dir):
    found = timeline.sessions(table(spark, sf_dir, "events"), ["user_id"], "ts", "6 hours", F.round(F.sum("value"), 6).alias("total"))
    return found.select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "n", "total")


@query("""with e as (select *, strftime(ts, '%Y-%m') m from events)
select m as month, count(*) n, count(distinct user_id) n_users, true as distinct_holds, true as quantiles_hold from e group by m""")
def merged_sketches(spark, sf_dir):
    """States stored by day, merged by month, held to their stated errors against exact figures."""
    from sievemill.sources.tables import cut

    events = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    stored = cut(sketches.states(events, ["day"], "user_id", "value")).withColumn("month", F.substring("day", 1, 7))
    months = sketches.merged(stored, ["month"]).withColumn("users", sketches.distinct_estimate())
    for name, share in (("q50", 0.5), ("q95", 0.95)):
        months = months.withColumn(name, sketches.quantile_estimate(share))
    rows = events.withColumn("month", F.substring("day", 1, 7)).join(months.select("month", "users", "q50", "q95"), "month")
    # The share of rows below an estimate, and up to it, must enclose the share asked for within the error.
    below = lambda q: F.avg((F.col("value") < F.col(q)).cast("double"))
    upto = lambda q: F.avg((F.col("value") <= F.col(q)).cast("double"))
    near = [(below(q) <= s + sketches.RANK_ERROR) & (upto(q) >= s - sketches.RANK_ERROR) for q, s in (("q50", 0.5), ("q95", 0.95))]
    exact = F.countDistinct("user_id")
    held = F.abs(F.max("users") - exact) <= F.greatest(F.lit(1.0), sketches.DISTINCT_ERROR * exact)
    return rows.groupBy("month").agg(F.count("*").alias("n"), exact.alias("n_users"), held.alias("distinct_holds"), (near[0] & near[1]).alias("quantiles_hold"))


@query()
def similarity_groups(spark, sf_dir):
    """The letters of the items as sequences, with the bounds for proteins; tests align all pairs."""
    letters = F.regexp_replace(F.upper("text"), "[^A-Z]", "")
    return curate.similarity_groups(table(spark, sf_dir, "benchmark").select("item_id", letters.alias("s")), "item_id", "s")
