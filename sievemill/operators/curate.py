"""Whole curation steps: recomputed gold answers, transitive groups of similar sequences, source path checks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.functions import sequences as seq
from sievemill.operators import group, joins
from sievemill.sources.tables import cut

#: Question families with a gold answer that can be recomputed. Fixed values.
FAMILIES = ("ORF-seq-AAseq", "ORF-seq-numlen", "PCR-len-primers", "PCR-primers-len", "PCR-seq-primers", "Prop-seq-gcpercent")


def computed_gold(family: Column, question: Column, ideal: Column, distractors: Column) -> Column:
    """struct(valid, reason): the answer is computed anew and must equal the ideal option and no distractor."""
    options = F.concat(F.array(ideal), distractors)
    strands = F.regexp_extract_all(question, F.lit("[ACGT]{15,}"), 0)
    template = F.when(family.startswith("PCR"), F.try_element_at(strands, F.lit(-1))).otherwise(F.try_element_at(strands, F.lit(1)))
    proteins = seq.complete_proteins(template)
    number = lambda pattern: F.regexp_extract(question, pattern, 1).try_cast("int")
    threshold, target = number(r"greater than (\d+)"), number(r"(\d+) bp")
    longest = seq.longest_unique(proteins)
    lengths = F.array_distinct(F.transform(seq.amplicons(template, F.try_element_at(strands, F.lit(1)), F.try_element_at(strands, F.lit(2))), F.length))
    computed = (
        F.when(family == "ORF-seq-AAseq", longest)
        .when(family == "ORF-seq-numlen", F.size(F.filter(proteins, lambda p: F.length(p) - 1 > threshold)).cast("string"))
        .when(family == "Prop-seq-gcpercent", seq.gc_percent(template).cast("string"))
        .when((family == "PCR-primers-len") & (F.size(lengths) == 1), lengths[0].cast("string"))
    )

    def fits(option: Column) -> Column:
        """Whether an option names primers whose product is the one asked for."""
        pair = F.split(option, ",")
        products = seq.amplicons(template, F.trim(pair[0]), F.trim(F.try_element_at(pair, F.lit(2))))
        return F.when(family == "PCR-len-primers", F.exists(products, lambda p: F.length(p) == target)).otherwise(F.exists(products, lambda p: p == strands[0]))

    by_primers = family.isin("PCR-len-primers", "PCR-seq-primers")
    hits = F.transform(options, lambda o: F.coalesce(F.when(by_primers, fits(o)).otherwise(o == computed), F.lit(False)))
    only_first = hits[0] & (F.size(F.filter(hits, lambda h: h)) == 1)
    reason = (
        F.when(~family.isin(*FAMILIES), "unsupported_family")
        .when(F.size(F.array_distinct(options)) < F.size(options), "duplicate_options")
        .when((family == "ORF-seq-AAseq") & longest.isNull(), "tied_or_missing_longest_complete_forward_ORF")
        .when((family == "PCR-primers-len") & (F.size(lengths) != 1), "ambiguous_or_missing_amplicon_length")
        .when(~only_first, "gold_mismatch_or_distractor_collision")
    )
    return F.struct(reason.isNull().alias("valid"), reason.alias("reason"))


def containment_groups(df: DataFrame, identity: str, sequence: str) -> DataFrame:
    """(identity, group_id): sequences that contain one another, also as reverse complement, are one group, transitively."""
    base = df.select(F.col(identity).alias("node"), F.col(sequence).alias("s"))
    short = base.select(F.col("node").alias("part"), F.explode(F.array_distinct(F.array("s", seq.reverse_complement(F.col("s"))))).alias("q"))
    edges = joins.containment_join(base, short, "s", "q", ["node"], ["part", "q"]).where("node <> part").select(F.col("node").alias("a"), F.col("part").alias("b"))
    return _named(base, edges, identity)


#: Sequences of a block, on average at most; two blocks meet in a task.
BLOCK = 1024
#: Classes that letters are counted in.
LETTERS = 32


def similar_pairs(reps: DataFrame, identity_at_least: float, coverage_at_least: float, block: int = BLOCK) -> DataFrame:
    """(a, b), a < b, of distinct sequences (node long, s) that may reach both bounds; no pair that does is left out.

    Coverage is at most the ratio of the lengths, and identity times coverage at most the letters that both have, with
    repeats, over the greater length. Sequences stand in blocks of neighbouring lengths; each pair of blocks whose lengths
    allow it is a group of its own, so that a length with a third of all rows is dealt to many tasks. Groups get ids,
    lengths and letter counts (in LETTERS classes, which can only raise the bound), not sequences."""
    counted = "node long, n int, letters binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [np.frombuffer(x.encode("utf-32-le"), np.uint32) for x in batch.column(1).to_pylist()]
            letters = [np.bincount(c % LETTERS, minlength=LETTERS).astype("<i4").tobytes() for c in codes]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(c) for c in codes], pa.int32()), pa.array(letters, pa.binary())], ["node", "n", "letters"])

    spark = reps.sparkSession
    slim = cut(reps.select("node", "s").mapInArrow(count, counted))
    # A row for each length that occurs: which blocks it fills. Short lengths share a block, long ones have several.
    filled, ranges, room = [], [], 0
    for n, many in sorted(slim.groupBy("n").count().collect()):
        if many > room:
            parts = -(-many // block)
            filled.append((n, len(ranges), parts))
            ranges += [(n, n)] * parts
            room = block * parts - many if parts == 1 else 0
        else:
            filled.append((n, len(ranges) - 1, 1))
            ranges[-1] = (ranges[-1][0], n)
            room -= many
    reach, k = [], 0  # of each block, the last whose shortest sequences aren't too long for its longest
    for low, high in ranges:
        while k + 1 < len(ranges) and ranges[k + 1][0] * coverage_at_least <= high:
            k += 1
        reach.append(k)
    if not ranges:
        return spark.createDataFrame([], "a long, b long")
    blocks = spark.createDataFrame(filled, "n int, _first int, _parts int")
    met = spark.createDataFrame([(i, j) for i, j in enumerate(reach)], "_block int, _last int")
    placed = slim.join(blocks, "n").withColumn("_block", F.col("_first") + F.pmod(F.hash("node"), F.col("_parts"))).select("node", "n", "letters", "_block")
    lefts = placed.join(met, "_block").select("node", "n", "letters", F.col("_block").alias("i"), F.explode(F.sequence("_block", "_last")).alias("j"))
    back = met.select(F.col("_block").alias("i"), F.explode(F.sequence("_block", "_last")).alias("_block")).where("i < _block")
    rights = placed.join(back, "_block").select("node", "n", "letters", "i", F.col("_block").alias("j"))
    both = lefts.withColumn("left", F.lit(True)).union(rights.withColumn("left", F.lit(False)))

    def compare(group: pa.Table) -> pa.Table:
        node, n, left = (group.column(c).to_numpy() for c in ("node", "n", "left"))
        letters = np.frombuffer(b"".join(group.column("letters").to_pylist()), "<i4").reshape(-1, LETTERS)
        same = group.column("i")[0].as_py() == group.column("j")[0].as_py()
        x, y = np.flatnonzero(left), np.flatnonzero(left if same else ~left)
        out_a, out_b = [], []
        for at in range(0, len(x), 64):
            rows = x[at : at + 64]
            longer, shorter = np.maximum(n[rows, None], n[y]), np.minimum(n[rows, None], n[y])
            shared = np.zeros(longer.shape, np.int64)
            for c in range(LETTERS):
                shared += np.minimum(letters[rows, c][:, None], letters[y, c])
            good = (shorter >= coverage_at_least * longer - 1e-9) & (shared >= identity_at_least * coverage_at_least * longer - 1e-9)
            if same:
                good &= node[rows, None] < node[y]
            p, q = np.nonzero(good)
            out_a.append(np.minimum(node[rows[p]], node[y[q]]))
            out_b.append(np.maximum(node[rows[p]], node[y[q]]))
        return pa.table({"a": np.concatenate(out_a or [np.zeros(0, np.int64)]), "b": np.concatenate(out_b or [np.zeros(0, np.int64)])})

    return both.groupBy("i", "j").applyInArrow(compare, "a long, b long")


def similarity_groups(df: DataFrame, identity: str, sequence: str, identity_at_least: float = 0.3, coverage_at_least: float = 0.8, block: int = BLOCK) -> DataFrame:
    """(identity, group_id): sequences whose global alignment reaches both bounds are one group, transitively; exact.

    Equal sequences stand for one another. Of the others, similar_pairs leaves out what can't reach the bounds; sequences
    join the pairs that are left and are aligned. Null and empty sequences are groups by themselves. Identities tell rows
    apart; an empty table gives an empty table."""
    base = df.select(F.col(identity).alias("node"), F.col(sequence).alias("s"))
    known = base.where(F.length("s") > 0)
    # Distinct sequences by number: the hash of the text, so that no sequence is exchanged to be named.
    reps = cut(known.groupBy("s").agg(F.min("node").alias("first")).withColumn("node", F.xxhash64("s")))
    if reps.groupBy("node").count().where("count > 1").limit(1).count():
        raise ValueError("two sequences share a hash")
    pairs = similar_pairs(reps, identity_at_least, coverage_at_least, block)
    side = lambda key, text, name: reps.select(F.col("node").alias(key), F.col("s").alias(text), F.col("first").alias(name))
    aligned = pairs.join(side("a", "s", "x"), "a").join(side("b", "t", "y"), "b").withColumn("z", seq.alignment("s", "t"))
    edges = aligned.where((F.col("z.identity") >= identity_at_least) & (F.col("z.coverage") >= coverage_at_least)).select(F.col("x").alias("a"), F.col("y").alias("b"))
    copies = known.join(reps.select("s", "first"), "s").where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    return _named(base, edges.union(copies), identity)


def _named(base: DataFrame, edges: DataFrame, identity: str) -> DataFrame:
    labels = base.select("node").join(group.components(edges), "node", "left").withColumn("component", F.coalesce("component", "node"))
    return labels.join(group.group_digest(labels), "component").select(F.col("node").alias(identity), "group_id")


def path_agrees(task_id: Column, split: Column, index: Column) -> Column:
    """A task id such as name-split-000012 against its columns."""
    return (F.regexp_extract(task_id, r"-([a-z]+)-(\d+)\z", 1) == split) & (F.regexp_extract(task_id, r"-([a-z]+)-(\d+)\z", 2).try_cast("int") == index)


def mutation_pair(wild: Column, mutation: Column, sequence: Column, processed: Column) -> Column:
    """Whether a substitution of the wild type gives both the raw and the processed sequence."""
    made = seq.apply_mutation(wild, mutation)
    return F.coalesce((made == sequence) & (made == processed), F.lit(False))
