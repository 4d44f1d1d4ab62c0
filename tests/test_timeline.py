"""As-of joins, interval joins, sessions and sketches against brute force; sessions of a stream against those of a table."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from sievemill.operators import sketches, timeline
from sievemill.streaming import sessions


def random_rows(seed, n, keys, span):
    rng = random.Random(seed)
    return [(i, rng.choice(keys), rng.choice([None, *[rng.randrange(span)] * 20]), rng.randrange(5)) for i in range(n)]


@pytest.mark.parametrize("slice_rows, same_time", [(10, True), (10, False), (10_000, True)])
def test_asof_join(spark, slice_rows, same_time):
    keys = ["hot"] * 8 + ["a", "b", None]
    lefts, rights = random_rows(1, 300, keys, 200), random_rows(2, 200, keys, 260)
    lefts += lefts[:5]
    left, right = (spark.createDataFrame(x, "id long, k string, t long, v int").repartition(3) for x in (lefts, rights))
    found = timeline.asof_join(left, right, ["k"], "t", "t", "m", ["id"], same_time, slice_rows)
    assert found.columns == ["id", "k", "t", "v", "m"]

    def last(k, t):
        usable = [r for r in rights if None not in (k, t, r[2]) and r[1] == k and (r[2] <= t if same_time else r[2] < t)]
        return max(usable, key=lambda r: (r[2], r[0]), default=None)

    want = [(*r, last(r[1], r[2])) for r in lefts]
    text = lambda rows: sorted(map(str, rows))
    assert text((*r[:4], r["m"] and tuple(r["m"])) for r in found.collect()) == text(want)
    assert sum(m is not None for *_, m in want) > 200
    assert timeline.asof_join(left.limit(0), right, ["k"], "t", "t", "m").count() == 0
    alone = timeline.asof_join(left, right.limit(0), ["k"], "t", "t", "m").collect()
    assert len(alone) == len(lefts) and not any(r["m"] for r in alone)
    with pytest.raises(ValueError):
        timeline.asof_join(left, right, ["k"], "t", "t", "v")


def test_asof_join_spreads_a_hot_key(spark):
    """The rows of one key are sorted by slice, not in one task."""
    left, right = (spark.range(20000).select(F.lit(1).alias("k"), F.col("id").alias("t")) for _ in range(2))
    sizes = timeline.asof_join(left, right, ["k"], "t", "t", "m", slice_rows=2000).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 1 and max(r[1] for r in sizes) < 20000


def test_interval_join(spark):
    rng = random.Random(5)

    def made(n):
        rows = []
        for i in range(n):
            a = rng.randrange(-500, 1000)
            rows.append((i, rng.choice(["x", "x", "y", None]), rng.choice([a, a, a, None]), a + rng.choice([-1, 0, 1, 1, 2, 3, 8, 9, 60, 1000])))
        return rows

    lefts, rights = made(150), made(170)
    lefts += lefts[:3]
    left, right = (spark.createDataFrame(x, "id long, k string, a long, b long") for x in (lefts, rights))
    found = timeline.interval_join(left, right, ["k"], ("a", "b"), ("a", "b"))
    want = [
        (p, q) for p in lefts for q in rights
        if p[1] is not None and p[1] == q[1] and None not in (p[2], q[2]) and p[2] < p[3] and q[2] < q[3] and p[2] < q[3] and q[2] < p[3]
    ]
    assert sorted((tuple(r["l"]), tuple(r["r"])) for r in found.collect()) == sorted(want) and len(want) > 100
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan.split("== Physical Plan ==")[1] and "Cartesian" not in plan
    assert timeline.interval_join(left.limit(0), right, ["k"], ("a", "b"), ("a", "b")).count() == 0
    everywhere = timeline.interval_join(left.withColumn("k", F.lit(1)), right.withColumn("k", F.lit(1)), [], ("a", "b"), ("a", "b"))
    assert everywhere.count() == sum(None not in (p[2], q[2]) and p[2] < p[3] and q[2] < q[3] and p[2] < q[3] and q[2] < p[3] for p in lefts for q in rights)


def grouped(rows, gap):
    out, by_key = [], {}
    for k, t in rows:
        by_key.setdefault(k, []).append(t)
    for k, ts in by_key.items():
        ts.sort()
        first = 0
        for i in range(1, len(ts) + 1):
            if i == len(ts) or (ts[i] - ts[i - 1]).total_seconds() > gap:
                out.append((k, ts[first], ts[i - 1] + datetime.timedelta(seconds=gap), i - first))
                first = i
    return sorted(out)


START = datetime.datetime(2024, 1, 1)


def timed_rows(seed, n):
    rng = random.Random(seed)
    return [(rng.choice("abb"), START + datetime.timedelta(seconds=rng.randrange(40 * n), microseconds=rng.choice([0, 0, 1, 999_999]))) for _ in range(n)]


def test_sessions(spark):
    rows = timed_rows(3, 200) + [("edge", START), ("edge", START + datetime.timedelta(seconds=60)), ("edge", START + datetime.timedelta(seconds=121))]
    df = spark.createDataFrame([*rows, ("none", None)], "k string, t timestamp")
    found = timeline.sessions(df, ["k"], "t", "60 seconds", F.max("t").alias("latest"))
    assert found.columns == ["k", "start", "end", "n", "latest"]
    assert sorted((r["k"], r["start"], r["end"], r["n"]) for r in found.collect()) == grouped(rows, 60)
    assert timeline.sessions(df.limit(0), ["k"], "t", "60 seconds").count() == 0


@pytest.mark.parametrize("kind", ["window", "state"])
def test_sessions_of_a_stream(spark, tmp_path, kind):
    """Rows in three batches, out of order within the delay; rows later than that are dropped."""
    rows = sorted(timed_rows(4, 150), key=lambda r: r[1])
    rng = random.Random(6)
    late = [("a", START - datetime.timedelta(days=1)), ("b", START - datetime.timedelta(hours=2))]
    batches = [rows[:60], rows[60:], [*late, ("end", rows[-1][1] + datetime.timedelta(days=2))], [("end", rows[-1][1] + datetime.timedelta(days=9))]]
    source = str(tmp_path / "in")
    for i, batch in enumerate(batches):
        rng.shuffle(batch)
        spark.createDataFrame(batch, "k string, t timestamp").coalesce(1).write.mode("append").parquet(f"{source}/{i}")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream = spark.readStream.schema("k string, t timestamp").option("maxFilesPerTrigger", 1).parquet(f"{source}/*")
        if kind == "state":
            told = sessions.stateful_sessions(stream, "k", "t", "1 hour", 60_000)
        else:
            told = timeline.sessions(stream.withWatermark("t", "1 hour"), ["k"], "t", "60 seconds")
        query = told.writeStream.format("memory").queryName(f"told_{kind}").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        query.awaitTermination(180)
        assert query.exception() is None
        found = sorted((r["k"], r["start"], r["end"], r["n"]) for r in spark.table(f"told_{kind}").collect() if r["k"] != "end")
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert found == grouped(rows, 60)


def test_sketches_merge(spark, tmp_path):
    df = spark.range(20000).select((F.col("id") % 7).alias("part"), (F.col("id") % 3000).alias("who"), (F.col("id") % 1000).alias("v"))
    df = df.union(spark.createDataFrame([(99, None, None)] * 2, "part long, who long, v long"))
    sketches.states(df, ["part"], "who", "v").write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    both = sketches.merged(stored, []).select("n", sketches.distinct_estimate().alias("d"), sketches.quantile_estimate(0.5).alias("q")).first()
    assert both["n"] == 20002 and abs(both["d"] - 3000) < 3000 * sketches.DISTINCT_ERROR and abs(both["q"] - 500) < 1000 * sketches.RANK_ERROR
    none = sketches.merged(stored.where("part = 99"), ["part"]).select("n", sketches.distinct_estimate().alias("d"), sketches.quantile_estimate(0.5).alias("q")).first()
    assert tuple(none) == (2, 0, None)
