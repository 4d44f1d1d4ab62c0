"""Sources: pinned tables, JSON lines, archives, feeds, images and result trees as DataFrames."""

from __future__ import annotations

import csv
import hashlib
import io
import tarfile
import urllib.request
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path, PurePosixPath

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from sievemill.functions.text import normalize_paper_id, squeeze


def parquet(spark: SparkSession, path: str, row_index: bool = False) -> DataFrame:
    """row_index adds file_name and row_index, a row's place in its file, from the reader's metadata."""
    df = spark.read.parquet(path)
    return df.select("*", F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.row_index").alias("row_index")) if row_index else df


def rows_at(spark: SparkSession, path: str, positions: list[int]) -> DataFrame:
    """Rows of one file at 0-based positions. A position the file doesn't have fails as the plan runs."""
    if len(set(positions)) != len(positions) or any(p < 0 for p in positions):
        raise IndexError(f"positions: {positions}")
    wanted = spark.createDataFrame([(p,) for p in positions], "row_index long")
    found = wanted.join(parquet(spark, path, row_index=True).where(F.col("row_index").isin(positions)), "row_index", "left")
    return found.where(F.when(F.col("file_name").isNotNull(), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("no row "), F.col("row_index").cast("string")))))


def pinned(spark: SparkSession, root: str, revision: str, split: str, expected: int | None = None) -> DataFrame:
    """A split kept under its revision; a different number of rows is an error."""
    df = spark.read.parquet(f"{root}/{revision}/{split}.parquet")
    if expected is not None and (n := df.count()) != expected:
        raise ValueError(f"{split} has {n} rows, not {expected}")
    return df


def json_lines(spark: SparkSession, path: str, schema: str, skip_blank: bool = True) -> DataFrame:
    """One object a line, with _corrupt for lines that don't parse. skip_blank False keeps blank lines, as rows of nulls."""
    if skip_blank:
        return spark.read.schema(f"{schema}, _corrupt string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    parsed = F.from_json("value", f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    return spark.read.text(path).select(parsed.alias("x")).select("x.*")


def known_ids(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Distinct ids of a log of JSON lines; lines that don't parse or lack the key are passed over."""
    value = F.try_variant_get(F.try_parse_json("value"), f"$.{key}", "string")
    return spark.read.text(path).select(value.alias(key)).where(F.col(key).isNotNull()).distinct()


def compressed(spark: SparkSession, path: str, schema: str, kind: str = "csv", spread: int | None = None) -> DataFrame:
    """Gzip CSV with a header, or gzip JSON lines. A gzip file is read by one task; spread deals its rows out after it."""
    reader = spark.read.schema(schema)
    df = reader.option("header", True).csv(path) if kind == "csv" else reader.json(path)
    return df.repartition(spread) if spread else df


def safe_member(name: str) -> bool:
    p = PurePosixPath(name)
    return not p.is_absolute() and ".." not in p.parts and "\\" not in name and bool(name)


def _archives(spark: SparkSession, path: str, members: Callable[[bytes], Iterator[tuple[str, bytes]]]) -> DataFrame:
    """(archive, member, content): archives are read where they lie, one a row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for archive, content in zip(frame["path"], frame["content"]):
                for name, data in members(content):
                    yield pd.DataFrame({"archive": [archive], "member": [name], "content": [data]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "archive string, member string, content binary")


def zip_members(spark: SparkSession, path: str, prefix: str = "", excluded: tuple[str, ...] = (".ipynb",)) -> DataFrame:
    """Files of zip archives under a prefix. Absolute paths and '..' are an error, and so is an empty result per archive."""

    def members(content: bytes) -> Iterator[tuple[str, bytes]]:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            names = [n for n in z.namelist() if n.startswith(prefix) and not n.endswith(("/", *excluded))]
            if bad := [n for n in names if not safe_member(n)]:
                raise ValueError(f"unsafe members: {bad[:3]}")
            if not names:
                raise ValueError(f"no members under {prefix!r}")
            for n in names:
                yield n, z.read(n)

    return _archives(spark, path, members)


def tar_members(spark: SparkSession, path: str, suffixes: tuple[str, ...] = ()) -> DataFrame:
    """Regular files of tar archives, plain or compressed; members that would leave the root are an error."""

    def members(content: bytes) -> Iterator[tuple[str, bytes]]:
        with tarfile.open(fileobj=io.BytesIO(content)) as t:
            for m in t:
                if not safe_member(m.name):
                    raise ValueError(f"unsafe member: {m.name}")
                if m.isfile() and (not suffixes or m.name.endswith(suffixes)):
                    yield m.name, t.extractfile(m).read()

    return _archives(spark, path, members)


def zip_csv(spark: SparkSession, path: str, columns: list[str], prefix: str = "") -> DataFrame:
    """Rows of CSV files inside zip archives, all strings, with archive and member."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for archive, member, content in zip(frame["archive"], frame["member"], frame["content"]):
                rows = list(csv.DictReader(io.StringIO(bytes(content).decode())))
                if rows:
                    yield pd.DataFrame(rows, columns=columns).assign(archive=archive, member=member)

    schema = ", ".join(f"`{c}` string" for c in [*columns, "archive", "member"])
    return zip_members(spark, path, prefix).mapInPandas(run, schema)


def tagged_json(spark: SparkSession, paths: dict[str, str], schema: str, tag: str = "kind") -> DataFrame:
    """JSON array documents, one a tag, as one table."""
    parts = [spark.read.schema(schema).option("multiLine", True).json(p).withColumn(tag, F.lit(t)) for t, p in paths.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


ATOM = "id string, title string, summary string, published string, category array<struct<_term: string>>, link array<struct<_href: string, _title: string>>"


def atom_papers(spark: SparkSession, path: str) -> DataFrame:
    """(paper_id, title, abstract, categories, published, pdf_url) of an Atom feed's entries."""
    return papers_of(spark.read.format("xml").option("rowTag", "entry").schema(ATOM).load(path))


def papers_of(entries: DataFrame, *others: str) -> DataFrame:
    """What feed entries tell of their papers, and other columns."""
    paper = normalize_paper_id(F.substring_index("id", "/", -1))
    pdf = F.try_element_at(F.filter("link", lambda x: x["_title"] == "pdf"), F.lit(1))["_href"]
    return entries.select(
        *others, paper.alias("paper_id"), squeeze(F.col("title")).alias("title"), squeeze(F.col("summary")).alias("abstract"),
        F.transform("category", lambda c: c["_term"]).alias("categories"), F.coalesce("published", F.lit("")).alias("published"),
        F.coalesce(pdf, F.concat(F.lit("https://arxiv.org/pdf/"), paper)).alias("pdf_url"),
    )


class PagedSource(DataSource):
    """spark.read.format("paged"): pages of a text API, one a task. Options: url with {page}, pages. Every page is a row
    (page, body). Recorded pages are read the same way by file:// URLs."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "page int, body string"

    def reader(self, schema):
        return PagedReader(self.options)


class PagedReader(DataSourceReader):
    def __init__(self, options):
        self.url, self.pages = options["url"], int(options.get("pages", "1"))

    def partitions(self):
        return [InputPartition(i) for i in range(self.pages)]

    def read(self, partition):
        with urllib.request.urlopen(self.url.replace("{page}", str(partition.value)), timeout=60) as r:
            yield partition.value, r.read().decode()


def upsert_by_name(pages: DataFrame, key: str, order: str) -> DataFrame:
    """The latest row of each key over all pages."""
    from sievemill.operators.group import latest

    return latest(pages, key, [order])


def fetch(url: str, target: Path, sha256: str | None = None) -> Path:
    """Download once: a file that is there is checked and kept; a new one is written beside and then renamed."""
    digest = lambda p: hashlib.sha256(p.read_bytes()).hexdigest()
    if not target.exists():
        part = target.with_name(target.name + ".part")
        with urllib.request.urlopen(url, timeout=300) as r, part.open("wb") as f:
            while block := r.read(1 << 20):
                f.write(block)
        if sha256 and digest(part) != sha256:
            part.unlink()
            raise ValueError(f"{url}: digest differs")
        part.replace(target)
    if sha256 and digest(target) != sha256:
        raise ValueError(f"{target}: digest differs")
    return target


def line_list(spark: SparkSession, path: str) -> DataFrame:
    """(value) of the lines that are neither blank nor comments."""
    return spark.read.text(path).select(F.trim("value").alias("value")).where("value <> '' and not startswith(value, '#')")


def files(spark: SparkSession, path: str, most_bytes: int | None = None) -> DataFrame:
    """(path, length, content, sha256); files over most_bytes are left unread."""
    df = spark.read.format("binaryFile").load(path)
    if most_bytes is not None:
        df = df.where(F.col("length") <= most_bytes)
    return df.select("path", "length", "content", F.sha2("content", 256).alias("sha256"))


def images(found: DataFrame, most_side: int = 2048, most_ratio: float = 4.0) -> DataFrame:
    """files with format, width, height and pixel_sha256 (RGB); null for what isn't an image. keep is false for images
    that are too long for their breadth, shrink true for those with a side over most_side. Needs Pillow on the executors."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from PIL import Image

        for frame in frames:
            out = []
            for content in frame["content"]:
                try:
                    with Image.open(io.BytesIO(content)) as im:
                        out.append((im.format, im.width, im.height, hashlib.sha256(im.convert("RGB").tobytes()).hexdigest()))
                except OSError:
                    out.append((None, None, None, None))
            extra = pd.DataFrame(out, columns=["format", "width", "height", "pixel_sha256"], index=frame.index)
            yield pd.concat([frame[["path", "sha256"]], extra], axis=1)

    seen = found.mapInPandas(run, "path string, sha256 string, format string, width int, height int, pixel_sha256 string")
    ratio = F.greatest("width", "height") / F.least("width", "height")
    return seen.withColumns({"keep": ratio <= most_ratio, "shrink": F.greatest("width", "height") > most_side})


def results(spark: SparkSession, glob: str, schema: str, separator: str = "__") -> DataFrame:
    """Result documents of a tree, with trial_id: the folder's name before the separator."""
    df = spark.read.schema(schema).option("multiLine", True).json(glob)
    folder = F.element_at(F.split(F.input_file_name(), "/"), -2)
    return df.withColumn("trial_id", F.substring_index(F.url_decode(folder), separator, 1))


def file_set_difference(found: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Names that only one of both has; empty where files and list agree."""
    from sievemill.operators.joins import keys_match

    return keys_match(found, listed, key)


def verify_digests(found: DataFrame, pins: dict[str, str]) -> Column:
    """Condition on files(): the digest is the one pinned for the file's name."""
    name = F.substring_index(F.col("path"), "/", -1)
    table = F.create_map(*[F.lit(x) for item in pins.items() for x in item])
    return F.coalesce(F.try_element_at(table, name) == F.col("sha256"), F.lit(False))
