"""Sinks: rendered task trees, append logs, exclusions, manifests. The only place that writes files by name."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_tree(files: DataFrame, root: str) -> DataFrame:
    """(path, content, executable) rows as files under root, a folder that the executors share; returns (path, sha256)
    of what was written. A file is written beside its name and renamed, so that a task may run twice. Paths that leave
    root are an error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        top = Path(root).resolve()
        for frame in frames:
            for path, content, executable in zip(frame["path"], frame["content"], frame["executable"]):
                target = (top / path).resolve()
                if top not in target.parents:
                    raise ValueError(f"unsafe path: {path}")
                target.parent.mkdir(parents=True, exist_ok=True)
                part = target.with_name(f".{target.name}.{uuid.uuid4().hex}")
                part.write_bytes(content)
                part.chmod(0o755 if executable else 0o644)
                os.replace(part, target)
            yield frame[["path"]]

    ready = files.select("path", F.encode("content", "UTF-8").alias("content"), F.coalesce("executable", F.lit(False)).alias("executable"))
    written = ready.mapInPandas(run, "path string")
    return written.join(files.select("path", F.sha2(F.encode("content", "UTF-8"), 256).alias("sha256")), "path")


def render_tasks(df: DataFrame, key: str, parts: dict[str, tuple[object, bool]]) -> DataFrame:
    """(path '<key>/<name>', content, executable): a row for each file of each task; parts: name -> (column, executable)."""
    each = F.array(*[F.struct(F.concat(F.col(key).cast("string"), F.lit("/" + n)).alias("path"), c.alias("content"), F.lit(x).alias("executable")) for n, (c, x) in parts.items()])
    return df.select(F.explode(each).alias("f")).select("f.*")


def write_table(df: DataFrame, path: str, mode: str = "refuse", kind: str = "parquet") -> None:
    """mode: refuse if there is output, skip, replace or append."""
    names = {"refuse": "errorifexists", "skip": "ignore", "replace": "overwrite", "append": "append"}
    df.write.mode(names[mode]).format(kind).save(path)


def append_json_lines(df: DataFrame, path: str) -> None:
    """Durable per batch: a log that is read back as JSON lines."""
    df.write.mode("append").json(path)


def write_document(value: object, path: Path, sort_keys: bool = True, ascii_only: bool = True) -> None:
    """A small JSON document from the driver, indented by two, by way of a rename."""
    part = path.with_name(path.name + ".part")
    part.write_text(json.dumps(value, indent=2, sort_keys=sort_keys, ensure_ascii=ascii_only) + "\n")
    part.replace(path)


def write_split(valid: DataFrame, excluded: DataFrame, path: str) -> None:
    """Valid rows and, beside them, those excluded with their reasons."""
    write_table(valid, f"{path}/valid")
    write_table(excluded, f"{path}/excluded")


def manifest(found: DataFrame, root: str, excluded: tuple[str, ...] = ()) -> DataFrame:
    """(path relative to root, sha256) of files(), without excluded parts. A row a file, not one map of all files."""
    relative = F.regexp_replace(F.col("path"), f"^(file:)?/*{root.strip('/')}/", "")
    out = found.select(relative.alias("path"), "sha256")
    for part in excluded:
        out = out.where(~F.array_contains(F.split("path", "/"), part))
    return out.orderBy("path")


def manifest_map(rows: DataFrame) -> DataFrame:
    """One row: a map path -> sha256 of a sample's manifest."""
    return rows.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("path", "sha256")))).alias("files"))


def refuse_if_frozen(path: Path) -> None:
    """A sample that has been drawn isn't drawn again."""
    if path.exists():
        raise FileExistsError(f"{path} is frozen")
