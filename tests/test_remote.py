"""Dependent pages, feeds by id and domain, guarded reads and the log of calls, over recorded answers and real files."""

import http.server
import json
import os
import threading
import time
import urllib.error
import urllib.parse

import pytest
from pyspark.sql import functions as F

from sievemill.operators import calls
from sievemill.sources import remote

ROWS = [{"name": f"box {i % 23}", "id": i, "secret": "x"} for i in range(25)]
ENTRY = """<entry><id>http://arxiv.org/abs/{id}v2</id><title>On
 {id}</title><summary>S</summary><published>2024-01-0{n}</published><category term="{cat}"/><link href="http://x/{id}" title="pdf"/></entry>"""


class Recorded(http.server.BaseHTTPRequestHandler):
    """Pages of ROWS, and feeds: every asked id but 'gone', or two papers of a domain."""

    def do_GET(self):
        url = urllib.parse.urlparse(self.path)
        q = {k: v[0] for k, v in urllib.parse.parse_qs(url.query).items()}
        self.server.seen.append((time.time(), url.path, q, self.headers["User-Agent"]))
        if url.path == "/list":
            a, n = int(q["offset"]), int(q["limit"])
            body = json.dumps({"data": ROWS[: self.server.rows][a : a + n]})
        else:
            ids = q["id_list"].split(",") if "id_list" in q else [f"{q['search_query'][4:]}.{i}" for i in range(3)][: int(q["max_results"])]
            cat = q.get("search_query", "cat:any")[4:]
            entries = "".join(ENTRY.format(id=i, n=1 + k % 9, cat=cat) for k, i in enumerate(ids) if i != "gone")
            body = f'<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><title>t</title>{entries}</feed>'
        self.send_response(200)
        self.end_headers()
        self.wfile.write(body.encode())

    def log_message(self, *args):
        pass


@pytest.fixture
def server():
    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Recorded)
    s.seen, s.rows, s.url = [], len(ROWS), f"http://127.0.0.1:{s.server_address[1]}"
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield s
    s.shutdown()


def offsets(server):
    return [int(q["offset"]) for _, path, q, _ in server.seen if path == "/list"]


@pytest.mark.parametrize("rows, limit, want", [(25, 10, [0, 10, 20]), (20, 10, [0, 10, 20]), (0, 10, [0]), (25, 25, [0, 25])])
def test_listing_ends_at_a_short_page(spark, server, rows, limit, want):
    server.rows = rows
    spark.dataSource.register(remote.ListingSource)
    read = spark.read.format("listing").option("url", server.url + "/list?offset={offset}&limit={limit}").option("limit", limit).load()
    found = sorted(read.collect())  # a sort in the plan would read twice
    assert [json.loads(r["item"]) for r in found] == ROWS[:rows] and [r["place"] for r in found] == list(range(rows))
    assert offsets(server) == want and server.seen[0][3] == remote.AGENT


def test_listing_stops_at_most_and_waits(spark, server):
    spark.dataSource.register(remote.ListingSource)
    read = spark.read.format("listing").options(url=server.url + "/list?offset={offset}&limit={limit}", limit="5", most="15", delay="0.2").load()
    assert read.count() == 15 and offsets(server) == [0, 5, 10]
    times = [t for t, *_ in server.seen]
    assert all(b - a >= 0.2 for a, b in zip(times, times[1:]))


def test_listing_as_a_stream(spark, server, tmp_path):
    """A page a batch, each asked for once; a second start goes on where the first ended, and finds the end."""
    spark.dataSource.register(remote.ListingSource)

    def run():
        stream = spark.readStream.format("listing").options(url=server.url + "/list?offset={offset}&limit={limit}", limit="10").load()
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).start()
        query.processAllAvailable()
        query.stop()
        return sorted((r["place"], json.loads(r["item"])["id"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert run() == [(i, i) for i in range(25)] and offsets(server) == [0, 10, 20]
    assert run() == [(i, i) for i in range(25)]


def test_upsert_of_a_listing(spark, server):
    spark.dataSource.register(remote.ListingSource)
    listing = spark.read.format("listing").option("url", server.url + "/list?offset={offset}&limit={limit}").load()
    known = spark.createDataFrame([("old", "{}"), ("box 1", "{}")], "name string, item string")
    found = {r["name"]: json.loads(r["item"]) for r in remote.latest_by_name(listing, known, ["name", "id"]).collect()}
    assert len(found) == 24 and found["old"] == {} and found["box 1"] == {"name": "box 1", "id": "24"} and found["box 7"]["id"] == "7"


def test_papers_by_id(spark, server):
    ids = [f"2401.0000{i}" for i in range(5)] + ["2401.00001"]
    found = {r["paper_id"]: r for r in remote.papers_by_id(spark, server.url + "/api", ids, at_once=2).collect()}
    assert sorted(found) == sorted(set(ids)) and found["2401.00003"]["title"] == "On 2401.00003"
    assert [q["id_list"].count(",") for _, _, q, _ in server.seen] == [1, 1, 0]
    with pytest.raises(Exception, match="no metadata for gone"):
        remote.papers_by_id(spark, server.url + "/api", ["2401.00001", "gone"]).collect()
    server.seen.clear()
    assert remote.papers_by_id(spark, server.url + "/api", []).count() == 0 and not server.seen


def test_papers_by_domain(spark, server):
    found = remote.papers_by_domain(spark, server.url + "/api", ["cond-mat", "cs.LG"], 2, delay=0.3).collect()
    assert sorted(r["paper_id"] for r in found) == ["cond-mat.0", "cond-mat.1", "cs.LG.0", "cs.LG.1"]
    asked = [q for _, _, q, _ in server.seen]
    assert asked[0] == {"search_query": "cat:cond-mat", "start": "0", "max_results": "2", "sortBy": "submittedDate", "sortOrder": "descending"}
    assert server.seen[1][0] - server.seen[0][0] >= 0.3
    for bad in ("a b", "x&y", "", "cs.LG\n"):
        with pytest.raises(ValueError):
            remote.papers_by_domain(spark, server.url + "/api", [bad], 2)


def test_guarded_reads(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "good").write_bytes(b"A")
    (tmp_path / "edge").write_bytes(b"AB")
    (tmp_path / "big").write_bytes(b"ABC")
    (tmp_path / "empty").write_bytes(b"")
    (tmp_path / "d/inner").write_bytes(b"I")
    (tmp_path / "link").symlink_to(tmp_path / "good")
    (tmp_path / "loose").symlink_to(tmp_path / "nowhere")
    (tmp_path / "dirlink").symlink_to(tmp_path / "d")
    (tmp_path / "one").write_bytes(b"H")
    os.link(tmp_path / "one", tmp_path / "two")
    os.mkfifo(tmp_path / "pipe")
    want = {
        "good": (b"A", None), "edge": (b"AB", None), "empty": (b"", None), "d/inner": (b"I", None), "big": (None, "oversize"), "link": (None, "symlink"),
        "loose": (None, "symlink"), "dirlink/inner": (None, "symlink"), "one": (None, "linked"), "pipe": (None, "not_regular"), "d": (None, "not_regular"),
        "none": (None, "missing"), "good/x": (None, "unreadable"),
    }
    rows = [(str(tmp_path / k), 1) for k in want] + [(None, 2), ("good", 3), ("/", 4)]
    df = spark.createDataFrame(rows, "path string, reason_no int")
    found = {r["path"]: (r["content"] and bytes(r["content"]) if r["content"] is not None else None, r["reason"]) for r in remote.guarded(df, "path", 2).collect()}
    assert {k: (c if c is None else bytes(c), r) for k, (c, r) in found.items()} == {str(tmp_path / k): v for k, v in want.items()} | {p: (None, "missing") for p in (None, "good")} | {"/": (None, "not_regular")}
    assert remote.guarded(df.limit(0), "path", 2).count() == 0
    assert remote.read_guarded(str(tmp_path / "one"), 2, None) == (b"H", None)


def sender(folder, fails):
    """Notes each call in a file of its own, and answers, or fails as told."""

    def send(text):
        (folder / f"{text}-{time.time_ns()}-{os.getpid()}").touch()
        if text in fails:
            raise fails[text]
        return f"re: {text}"

    return send


def test_called_once(spark, tmp_path):
    """A run that breaks off in one of its rounds, and two more: no call of a finished round goes out again."""
    notes = tmp_path / "notes"
    notes.mkdir()
    sent = lambda: sorted(p.name.split("-")[0] for p in notes.iterdir())
    rows = spark.createDataFrame([("a", i, f"q{i}") for i in range(20)] + [("b", 0, "q0b"), (None, 1, "x"), ("a", None, "x"), ("c", 1, None)], "s string, i long, q string")
    log = str(tmp_path / "log")
    with pytest.raises(Exception):
        calls.called_once(rows, "s", "i", "q", sender(notes, {"q7": KeyboardInterrupt("stop")}), log, rounds=8)
    first = sent()
    answered = {r["index"] for r in spark.read.parquet(log).where("stage = 'a'").collect()}
    assert 0 < len(answered) < 20
    found = calls.called_once(rows, "s", "i", "q", sender(notes, {"q9": ValueError("bad")}), log, wait=0.0, rounds=8)
    again = sent()
    assert found.count() == 24 and all(again.count(f"q{i}") == 1 for i in answered)
    out = {(r["s"], r["i"]): r for r in found.collect()}
    assert out["a", 3]["body"] == "re: q3" and out["a", 3]["status"] == "ok" and out["a", 3]["same_request"]
    if 9 not in answered:
        assert out["a", 9]["status"] == "error" and out["a", 9]["attempts"][0]["error_type"] == "ValueError" and len(out["a", 9]["attempts"]) == 1
    assert all(out[k]["status"] is None for k in ((None, 1), ("a", None), ("c", 1)))
    changed = rows.withColumn("q", F.when(F.col("i") == 3, "other").otherwise(F.col("q")))
    third = {(r["s"], r["i"]): r for r in calls.called_once(changed, "s", "i", "q", sender(notes, {}), log, rounds=8).collect()}
    assert sent() == again and first and third["a", 3]["body"] == "re: q3" and not third["a", 3]["same_request"] and third["a", 4]["same_request"]
    assert calls.called_once(rows.limit(0), "s", "i", "q", sender(notes, {}), str(tmp_path / "other"), rounds=2).count() == 0


def test_tries(tmp_path):
    error = lambda code: urllib.error.HTTPError("u", code, "m", {}, None)
    for fault, tries in ((error(429), 3), (error(503), 3), (error(400), 1), (TimeoutError(), 3), (urllib.error.URLError("x"), 3), (KeyError("x"), 1)):
        seen = []

        def send(text):
            seen.append(text)
            raise fault

        status, body, attempts = calls.called("t", send, 3, 0.0)
        assert (status, body, len(attempts), len(seen)) == ("error", None, tries, tries) and attempts[0]["http_status"] == getattr(fault, "code", None)
    flaky = iter([TimeoutError(), "fine"])

    def recovers(text):
        x = next(flaky)
        if isinstance(x, Exception):
            raise x
        return x

    assert calls.called("t", recovers, 2, 0.0)[:2] == ("ok", "fine")
