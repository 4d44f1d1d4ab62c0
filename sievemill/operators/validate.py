"""Validation with reasons: contracts, strict JSON, first failure or all failures, assertions inside the plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """The name of the first rule whose condition is not true; null where all hold. An unknown condition fails."""
    out = None
    for name, holds in rules:
        failed = ~F.coalesce(holds, F.lit(False))
        out = F.when(failed, name) if out is None else out.when(failed, name)
    return out


def all_reasons(rules: list[tuple[str, Column]]) -> Column:
    """array<string> of all rules that fail, in their order."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(holds, F.lit(False)), name) for name, holds in rules]))


def with_reason(df: DataFrame, rules: list[tuple[str, Column]], name: str = "reason") -> DataFrame:
    return df.withColumn(name, first_reason(rules))


def split_valid(df: DataFrame, rules: list[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, excluded rows with reason): every row is in one of both."""
    marked = with_reason(df, rules)
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null")


def strict_object(text: Column, limit: int = 4096) -> Column:
    """VARIANT of a JSON object, null unless the text is exactly one: no duplicate keys, no NaN or Infinity, no text
    around it, at most limit bytes. One parser alone lets trailing text pass; wrapped in two ways it can't."""
    bounded = F.when(F.octet_length(text) <= limit, text)
    as_item = F.try_parse_json(F.concat(F.lit("["), bounded, F.lit("]")))
    as_field = F.try_parse_json(F.concat(F.lit('{"a":'), bounded, F.lit("}")))
    value = F.try_parse_json(bounded)
    whole = as_item.isNotNull() & as_field.isNotNull() & F.schema_of_variant(value).startswith("OBJECT")
    return F.when(whole, value)


def has_exact_keys(text: Column, keys: list[str]) -> Column:
    """Whether the object's top-level keys are just these."""
    return F.array_sort(F.json_object_keys(text)) == F.array(*[F.lit(k) for k in sorted(keys)])


def token_type(value: Column, path: str) -> Column:
    """Type of a field as it is written: BIGINT, DECIMAL(..), DOUBLE, BOOLEAN, STRING, VOID, ARRAY<..>, OBJECT<..>."""
    return F.schema_of_variant(F.try_variant_get(value, path, "variant"))


def strict_int(value: Column, path: str) -> Column:
    """A field that is written as an integer: neither boolean, float nor string."""
    return F.when(token_type(value, path) == "BIGINT", F.try_variant_get(value, path, "long"))


def strict_bool(value: Column, path: str) -> Column:
    return F.when(token_type(value, path) == "BOOLEAN", F.try_variant_get(value, path, "boolean"))


def strict_string(value: Column, path: str) -> Column:
    return F.when(token_type(value, path) == "STRING", F.try_variant_get(value, path, "string"))


def strict_number(value: Column, path: str) -> Column:
    """A field that is written as a number of any kind."""
    return F.when(token_type(value, path).rlike("^(BIGINT|DECIMAL|DOUBLE)"), F.try_variant_get(value, path, "double"))


def strictly_true(value: Column, paths: list[str]) -> Column:
    """Whether every field is the literal true."""
    out = F.lit(True)
    for p in paths:
        out = out & F.coalesce(strict_bool(value, p), F.lit(False))
    return out


def valid_options(options: Column, least: int = 2) -> Column:
    """array<struct(letter, text)>: enough options, distinct capital letters, distinct texts of which none is blank."""
    letters, texts = F.transform(options, lambda o: o["letter"]), F.transform(options, lambda o: F.trim(o["text"]))
    return (F.size(options) >= least) & F.forall(letters, lambda x: x.rlike(r"^[A-Z]\z")) & (F.size(F.array_distinct(letters)) == F.size(options)) & F.forall(texts, lambda x: x != "") & (F.size(F.array_distinct(texts)) == F.size(options))


def safe_relative_path(path: Column) -> Column:
    """Neither absolute nor empty, no backslash and no part that is '..'."""
    return (path != "") & ~path.startswith("/") & ~path.contains("\\") & ~F.array_contains(F.split(path, "/"), "..")


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def close(a: Column, b: Column, absolute: float = 0.0, relative: float = 0.0) -> Column:
    """|a - b| within the larger of both tolerances."""
    return F.abs(a - b) <= F.greatest(F.lit(absolute), relative * F.greatest(F.abs(a), F.abs(b)))


def valid_structure(lattice: Column, sites: Column) -> Column:
    """A crystal: 3 by 3 finite lattice that isn't singular; sites, each one whole element with three finite coordinates."""
    from sievemill.functions.sequences import determinant3

    shape = (F.size(lattice) == 3) & F.forall(lattice, lambda r: F.size(r) == 3)
    numbers = F.forall(F.flatten(lattice), finite)
    ordered = F.forall(sites, lambda s: (F.size(s["species"]) == 1) & (s["species"][0]["occu"] == 1) & s["species"][0]["element"].rlike(r"^\p{L}+\z"))
    placed = F.forall(sites, lambda s: (F.size(s["abc"]) == 3) & F.forall(s["abc"], finite))
    return shape & numbers & F.when(shape, F.abs(determinant3(lattice)) >= 1e-10) & (F.size(sites) > 0) & ordered & placed


def agreeing_pair(raw: Column, processed: Column, low: Column, value: Column, high: Column, tolerance: float = 1e-8) -> Column:
    """Raw and processed scores agree and the interval is finite and ordered."""
    return close(raw, processed, tolerance) & finite(low) & finite(value) & finite(high) & (low <= value) & (value <= high)


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with n; empty where they are unique."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def require(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """df, failing as the plan runs on a row for which the condition isn't true."""
    return df.where(F.when(F.coalesce(condition, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.lit(message))))


def require_unique(df: DataFrame, *keys: str) -> DataFrame:
    """df, failing on repeated keys; one scan, the count travels with the rows' own shuffle."""
    from pyspark.sql import Window

    counted = df.withColumn("_n", F.count("*").over(Window.partitionBy(*keys)))
    return require(counted, F.col("_n") == 1, f"repeated {', '.join(keys)}").drop("_n")


def count_status(df: DataFrame, expected: dict[str, tuple[Column, int]]) -> DataFrame:
    """(name, found, expected, holds): counted conditions against expected numbers, all in one scan."""
    counts = df.agg(*[F.count_if(c).alias(n) for n, (c, _) in expected.items()])
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("found"), F.lit(k).cast("long").alias("expected")) for n, (_, k) in expected.items()]))
    return counts.select(rows.alias("r")).select("r.*").withColumn("holds", F.col("found") == F.col("expected"))


def zero_checks(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Names of the checks that no row meets."""
    counts = df.agg(*[F.count_if(c).alias(n) for n, c in checks.items()])
    names = F.array_compact(F.array(*[F.when(F.col(n) == 0, n) for n in checks]))
    return counts.select(F.explode(names).alias("name"))


def flag_positions(df: DataFrame, flags: dict[str, Column], index: str) -> DataFrame:
    """(flag, n, position): a row for each row that has a flag; for a flag that all rows have, one row without position.

    Positions stay rows, so that a frequent flag isn't gathered in one task; the counts are a row a flag."""
    counts = df.agg(F.count("*").alias("total"), *[F.count_if(c).alias(f"_{n}") for n, c in flags.items()])
    each = counts.select("total", F.explode(F.array(*[F.struct(F.lit(n).alias("flag"), F.col(f"_{n}").alias("n")) for n in flags])).alias("x")).select("x.*", "total").where("n > 0")
    long = df.select(F.col(index).alias("position"), F.explode(F.array_compact(F.array(*[F.when(c, n) for n, c in flags.items()]))).alias("flag"))
    some = long.join(F.broadcast(each.where("n < total")), "flag").select("flag", "n", "position")
    return some.unionByName(each.where("n = total").select("flag", "n", F.lit(None).cast(df.schema[index].dataType).alias("position")))


def same_content(content: Column, sha256: Column, size: Column) -> Column:
    """Content address: the bytes' digest and size are as stated."""
    return (F.sha2(content, 256) == sha256) & (F.octet_length(content) == size)
