"""Sources, sinks and streams in temporary folders."""

import gzip
import hashlib
import io
import json
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from sievemill.sources import readers, sinks
from sievemill.streaming import resume


def test_positions(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).withColumn("v", F.col("id") * 10).coalesce(1).write.parquet(path)
    assert {(r["row_index"], r["v"]) for r in readers.rows_at(spark, path, [2, 0]).collect()} == {(2, 20), (0, 0)}
    with pytest.raises(IndexError):
        readers.rows_at(spark, path, [-1])
    with pytest.raises(Exception, match="no row 9"):
        readers.rows_at(spark, path, [9]).collect()


def test_json_lines(spark, tmp_path):
    f = tmp_path / "a.jsonl"
    f.write_text('{"id": "x"}\n\n{broken\n{"id": "y"}\n{"other": 1}\n')
    assert {r["id"] for r in readers.known_ids(spark, str(f), "id").collect()} == {"x", "y"}
    rows = readers.json_lines(spark, str(f), "id string").collect()
    assert sum(r["_corrupt"] is not None for r in rows) == 1
    (tmp_path / "one.json").write_text(json.dumps([{"q": "a"}]))
    (tmp_path / "two.json").write_text(json.dumps([{"q": "b"}, {"q": "c"}]))
    both = readers.tagged_json(spark, {"single": str(tmp_path / "one.json"), "multi": str(tmp_path / "two.json")}, "q string")
    assert {(r["kind"], r["q"]) for r in both.collect()} == {("single", "a"), ("multi", "b"), ("multi", "c")}


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("d/x.csv", "m,s\nA1B,2\nC2D,3\n")
        z.writestr("d/n.ipynb", "no")
    rows = readers.zip_csv(spark, str(tmp_path / "a.zip"), ["m", "s"], "d/").collect()
    assert {(r["m"], r["s"]) for r in rows} == {("A1B", "2"), ("C2D", "3")}
    with zipfile.ZipFile(tmp_path / "bad.zip", "w") as z:
        z.writestr("d/../../x", "no")
    with pytest.raises(Exception, match="unsafe"):
        readers.zip_members(spark, str(tmp_path / "bad.zip")).collect()
    with tarfile.open(tmp_path / "t.tar.gz", "w:gz") as t:
        info = tarfile.TarInfo("p/main.tex")
        info.size = 3
        t.addfile(info, io.BytesIO(b"abc"))
    assert [(r["member"], bytes(r["content"])) for r in readers.tar_members(spark, str(tmp_path / "t.tar.gz"), (".tex",)).collect()] == [("p/main.tex", b"abc")]


def test_feed_and_compressed(spark, tmp_path):
    (tmp_path / "f.xml").write_text('<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://arxiv.org/abs/2401.1v2</id><title> A\n  b </title><summary>s</summary><published>2024</published><category term="cs"/><link href="u" rel="x"/><link href="p" title="pdf"/></entry></feed>')
    r = readers.atom_papers(spark, str(tmp_path / "f.xml")).first()
    assert (r["paper_id"], r["title"], r["categories"], r["pdf_url"]) == ("2401.1", "A b", ["cs"], "p")
    with gzip.open(tmp_path / "x.csv.gz", "wt") as f:
        f.write("a,b\n1,2\n")
    assert readers.compressed(spark, str(tmp_path / "x.csv.gz"), "a int, b int").collect() == [(1, 2)]
    (tmp_path / "l.txt").write_text("# no\n\n x \n")
    assert [r["value"] for r in readers.line_list(spark, str(tmp_path / "l.txt")).collect()] == ["x"]


def test_pages_and_fetch(spark, tmp_path):
    for i in range(2):
        (tmp_path / f"p{i}.json").write_text(json.dumps([{"name": f"n{i}"}]))
    spark.dataSource.register(readers.PagedSource)
    pages = spark.read.format("paged").option("url", f"file://{tmp_path}/p{{page}}.json").option("pages", 2).load()
    assert {r["page"] for r in pages.collect()} == {0, 1}
    digest = hashlib.sha256((tmp_path / "p0.json").read_bytes()).hexdigest()
    readers.fetch(f"file://{tmp_path}/p0.json", tmp_path / "c.json", digest)
    with pytest.raises(ValueError):
        readers.fetch(f"file://{tmp_path}/p0.json", tmp_path / "d.json", "0" * 64)
    assert not (tmp_path / "d.json").exists()


def test_tree_and_manifest(spark, tmp_path):
    df = spark.createDataFrame([(1, "é"), (2, "b")], "id int, t string")
    files = sinks.render_tasks(df, "id", {"instruction.md": (F.col("t"), False), "run.sh": (F.lit("x"), True)})
    assert sinks.write_tree(files, str(tmp_path / "tree")).count() == 4
    assert (tmp_path / "tree/1/instruction.md").read_text() == "é" and (tmp_path / "tree/1/run.sh").stat().st_mode & 0o111
    rows = {r["path"]: r["sha256"] for r in sinks.manifest(readers.files(spark, str(tmp_path / "tree/*/*")), str(tmp_path / "tree")).collect()}
    assert rows["1/instruction.md"] == hashlib.sha256("é".encode()).hexdigest() and len(rows) == 4
    with pytest.raises(Exception, match="unsafe"):
        sinks.write_tree(spark.createDataFrame([("../x", "c", False)], "path string, content string, executable boolean"), str(tmp_path / "tree")).collect()
    with pytest.raises(FileExistsError):
        sinks.refuse_if_frozen(tmp_path)
    sinks.append_json_lines(df, str(tmp_path / "log"))
    sinks.append_json_lines(df, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 4
    sinks.write_document({"b": 1, "a": 2}, tmp_path / "d.json")
    assert (tmp_path / "d.json").read_text() == '{\n  "a": 2,\n  "b": 1\n}\n'


def test_streams(spark, tmp_path, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    q = resume.first_of_key(stream, "user_id", "ts", "1 hour").writeStream.format("memory").queryName("firsts").option("checkpointLocation", str(tmp_path / "c1")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("select user_id from firsts").count() >= events.select("user_id").distinct().count()
    q = stream.writeStream.foreachBatch(lambda b, _: resume.process_new(b, str(tmp_path / "log"), "user_id")).option("checkpointLocation", str(tmp_path / "c2")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(str(tmp_path / "log")).count() == events.select("user_id").distinct().count()
