"""Projections: public against gold columns, nested rebuilds, explosions, merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def public_gold(df: DataFrame, key: str, public: list[str], gold: list[str]) -> tuple[DataFrame, DataFrame]:
    """(public columns, gold columns), both with key. The plan of the first never reads a gold column."""
    if clash := set(public) & set(gold):
        raise ValueError(f"public and gold: {sorted(clash)}")
    return df.select(key, *[c for c in public if c != key]), df.select(key, *[c for c in gold if c != key])


def gold_leaks(rendered: DataFrame, gold: DataFrame, key: str, text: str, value: str) -> DataFrame:
    """Keys whose rendered public text holds their gold value."""
    return rendered.join(gold, key).where(F.col(text).contains(F.col(value).cast("string"))).select(key)


def allow_fields(structs: Column, fields: list[str]) -> Column:
    """array<struct> rebuilt with the allowed fields alone."""
    return F.transform(structs, lambda s: F.struct(*[s[f].alias(f) for f in fields]))


def public_structure(lattice: Column, sites: Column) -> Column:
    """A crystal without labels and energies: its lattice, and species and coordinates of its sites."""
    rebuilt = F.transform(sites, lambda s: F.struct(F.array(F.struct(s["species"][0]["element"].alias("element"), F.lit(1).alias("occu"))).alias("species"), s["abc"].alias("abc")))
    return F.struct(F.lit(0).alias("charge"), F.struct(lattice.alias("matrix"), F.array(F.lit(True), F.lit(True), F.lit(True)).alias("pbc")).alias("lattice"), rebuilt.alias("sites"))


def rename_for(df: DataFrame, setting: str, names: dict[str, dict[str, str]]) -> DataFrame:
    """Columns renamed as the setting has it."""
    return df.withColumnsRenamed(names[setting])


def explode_items(df: DataFrame, items: str, position: str = "position", item: str = "item") -> DataFrame:
    """A row for each element, with its 0-based position; parents without elements give none."""
    return df.select("*", F.posexplode(items).alias(position, item)).drop(items)


def merge_maps(*maps: Column) -> Column:
    """Later maps win. Independent of the session's policy on repeated keys."""
    out = maps[0]
    for m in maps[1:]:
        out = F.map_concat(_without(out, m), m)
    return out


def _without(base: Column, other: Column) -> Column:
    return F.map_filter(base, lambda k, v: ~F.array_contains(F.map_keys(other), k))
