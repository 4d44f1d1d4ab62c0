"""Remote listings and feeds, page by page, and files that are read without trusting what they are."""

from __future__ import annotations

import json
import os
import re
import stat
import time
import urllib.parse
import urllib.request
from collections.abc import Iterator
from pathlib import PurePosixPath

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, SimpleDataSourceStreamReader

from sievemill.functions import fixed
from sievemill.sources.readers import ATOM, papers_of

AGENT = "sievemill/1.0"


def get(url: str, timeout: float) -> bytes:
    request = urllib.request.Request(url, headers={"User-Agent": AGENT})
    with urllib.request.urlopen(request, timeout=timeout) as r:
        return r.read()


class Listing:
    """Pages of a listing that tells its length only by a page shorter than asked for.

    Options: url with {offset} and {limit}; limit, rows of a page (100); most, rows after which to stop (2000); items, the
    key that holds a page's rows (data; empty: the page is the list); delay between pages and timeout, in seconds."""

    def __init__(self, options: dict[str, str]):
        self.url = options["url"]
        self.limit, self.most = int(options.get("limit", "100")), int(options.get("most", "2000"))
        self.items, self.delay, self.timeout = options.get("items", "data"), float(options.get("delay", "0")), float(options.get("timeout", "60"))

    def page(self, offset: int) -> list:
        if offset:
            time.sleep(max(0.0, self.delay))
        found = json.loads(get(self.url.replace("{offset}", str(offset)).replace("{limit}", str(self.limit)), self.timeout))
        return found[self.items] if self.items else found

    def after(self, offset: int) -> tuple[list[tuple[int, str]], int]:
        """(place, row as JSON) of the page at offset, and the next offset: a short page, or most, is the end, told by -1."""
        if offset < 0 or offset >= self.most:
            return [], -1
        rows = self.page(offset)
        last = len(rows) < self.limit or offset + self.limit >= self.most
        return [(offset + i, json.dumps(r, sort_keys=True)) for i, r in enumerate(rows)], -1 if last else offset + self.limit


class ListingSource(DataSource):
    """spark.read.format("listing") and readStream: (place long, item string), a JSON text for each row of the listing.

    A page's existence depends on the one before, so pages are asked for one after the other, each once: by one task for
    a table, and by the driver, one page a batch, for a stream. A listing is small; what its rows name is read elsewhere."""

    @classmethod
    def name(cls) -> str:
        return "listing"

    def schema(self) -> str:
        return "place long, item string"

    def reader(self, schema):
        return ListingReader(self.options)

    def simpleStreamReader(self, schema):
        return ListingStream(self.options)


class ListingReader(DataSourceReader):
    def __init__(self, options):
        self.listing = Listing(options)

    def read(self, partition):
        offset = 0
        while offset >= 0:
            rows, offset = self.listing.after(offset)
            yield from rows


class ListingStream(SimpleDataSourceStreamReader):
    def __init__(self, options):
        self.listing = Listing(options)

    def initialOffset(self) -> dict:
        return {"offset": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, offset = self.listing.after(start["offset"])
        return iter(rows), {"offset": offset}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        """The same rows again, after a batch failed: offsets differ by one page."""
        return iter(self.listing.after(start["offset"])[0])


def latest_by_name(listing: DataFrame, known: DataFrame, fields: list[str]) -> DataFrame:
    """known (name, item), with the rows of a listing put in by name; of rows with one name the last counts. Only fields are kept.

    Rows without a name are left out; empty tables add nothing."""
    whole = F.try_parse_json("item")
    name = F.try_variant_get(whole, "$.name", "string")
    item = F.to_json(F.struct(*[F.try_variant_get(whole, f"$.{f}", "string").alias(f) for f in fields]))
    new = listing.select(name.alias("name"), item.alias("item"), F.col("place")).where("name is not null")
    last = new.groupBy("name").agg(F.max_by("item", "place").alias("item"))
    return known.join(last.select("name"), "name", "left_anti").select("name", "item").union(last.select("name", "item"))


def feed(spark: SparkSession, urls: list[str], delay: float = 0.0, timeout: float = 60.0) -> DataFrame:
    """Papers of the feeds behind urls, with source (the place in urls). Requests keep delay seconds between them, so one
    task sends them all; a request that fails fails the plan."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sent = 0
        for frame in frames:
            bodies = []
            for url in frame["url"]:
                if sent:
                    time.sleep(max(0.0, delay))
                bodies.append(get(url, timeout).decode())
                sent += 1
            yield pd.DataFrame({"source": frame["source"], "body": bodies})

    asked = spark.createDataFrame(list(enumerate(urls)), "source int, url string").coalesce(1).mapInPandas(run, "source int, body string")
    entries = asked.select("source", F.explode(F.from_xml("body", f"entry array<struct<{ATOM}>>")["entry"]).alias("e"))
    return papers_of(entries.select("source", "e.*"), "source")


def papers_by_id(spark: SparkSession, api: str, ids: list[str], at_once: int = 100, delay: float = 0.0, timeout: float = 60.0) -> DataFrame:
    """Papers of a list of ids, at_once a request. An id without an entry fails as the plan runs. Repeated ids count once;
    no ids give an empty table without a request."""
    wanted = list(dict.fromkeys(ids))
    parts = [wanted[i : i + at_once] for i in range(0, len(wanted), at_once)]
    found = feed(spark, [f"{api}?{urllib.parse.urlencode({'id_list': ','.join(p), 'max_results': len(p)})}" for p in parts], delay, timeout)
    rows = spark.createDataFrame([(i,) for i in wanted], "paper_id string").join(found.dropDuplicates(["paper_id"]), "paper_id", "left")
    return rows.where(F.when(F.col("source").isNotNull(), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("no metadata for "), F.col("paper_id"))))).drop("source")


def papers_by_domain(spark: SparkSession, api: str, domains: list[str], each: int, delay: float = 0.0, timeout: float = 60.0) -> DataFrame:
    """The newest papers of each domain, each of them at most; of one paper in several domains the last one's entry counts."""
    for d in domains:
        if not re.fullmatch(fixed.DOMAIN, d):
            raise ValueError(f"not a domain: {d!r}")
    asked = [{"search_query": f"cat:{d}", "start": 0, "max_results": each, "sortBy": "submittedDate", "sortOrder": "descending"} for d in domains]
    found = feed(spark, [f"{api}?{urllib.parse.urlencode(q)}" for q in asked], delay, timeout)
    last = found.groupBy("paper_id").agg(F.max_by(F.struct("*"), "source").alias("p"))
    return last.select("p.*").drop("source")


def read_guarded(path: str, most_bytes: int, most_links: int | None = 1) -> tuple[bytes | None, str | None]:
    """(content, None) of a regular file, or (None, reason): 'missing', 'symlink', 'not_regular', 'linked', 'oversize', 'unreadable'.

    Each part of the path is opened below the one before without following links, and type, links and size are those of the
    open file, so that nothing can be exchanged between check and read. Opening doesn't wait for a writer."""
    flags = os.O_RDONLY | os.O_NOFOLLOW | os.O_NONBLOCK | os.O_CLOEXEC
    *parents, last = PurePosixPath(path).parts if path.startswith("/") else ("", "")
    if not last:
        return None, "missing"
    opened: list[int] = []
    try:
        opened.append(os.open("/", os.O_RDONLY | os.O_DIRECTORY))
        for part in parents[1:]:
            if stat.S_ISLNK(os.stat(part, dir_fd=opened[-1], follow_symlinks=False).st_mode):
                return None, "symlink"
            opened.append(os.open(part, flags | os.O_DIRECTORY, dir_fd=opened[-1]))
        if stat.S_ISLNK(os.stat(last, dir_fd=opened[-1], follow_symlinks=False).st_mode):
            return None, "symlink"
        opened.append(os.open(last, flags, dir_fd=opened[-1]))
        info = os.fstat(opened[-1])
        if not stat.S_ISREG(info.st_mode):
            return None, "not_regular"
        if most_links is not None and info.st_nlink > most_links:
            return None, "linked"
        if info.st_size > most_bytes:
            return None, "oversize"
        content, size = [], 0
        while size <= most_bytes and (block := os.read(opened[-1], min(1 << 20, most_bytes + 1 - size))):
            content.append(block)
            size += len(block)
        return (None, "oversize") if size > most_bytes else (b"".join(content), None)
    except FileNotFoundError:
        return None, "missing"
    except OSError:
        return None, "unreadable"
    finally:
        for fd in opened:
            os.close(fd)


def guarded(paths: DataFrame, path: str, most_bytes: int, most_links: int | None = 1) -> DataFrame:
    """paths with content and reason, as read_guarded tells them; a null or relative path is 'missing'.

    For files in folders that executors see, such as submissions to be verified; other stores have no links. Columns of
    paths named content or reason are an error. Repeated rows are read repeatedly."""
    if clash := {"content", "reason"} & set(paths.columns):
        raise ValueError(f"columns {sorted(clash)} are there already")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            read = [read_guarded(p, most_bytes, most_links) if isinstance(p, str) else (None, "missing") for p in frame["_path"]]
            yield pd.DataFrame({"_path": frame["_path"], "content": [c for c, _ in read], "reason": [r for _, r in read]})

    asked = paths.select(F.col(path).alias("_path")).distinct().mapInPandas(run, "_path string, content binary, reason string")
    return paths.join(asked, F.col(path).eqNullSafe(F.col("_path"))).drop("_path")
