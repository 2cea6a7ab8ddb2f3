"""Downloads from a server that fails: each address once, typed errors, and a second run that fetches what is missing only."""

import threading
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from tessaria.sources import download as d

POLICY = d.Policy(rate=2000, lanes=2, tries=3, wait=0.01, timeout=5, least=8, magic=b"%PDF")


class Server(BaseHTTPRequestHandler):
    seen: Counter = Counter()
    repaired = False

    def do_GET(self):
        Server.seen[self.path] += 1
        name = self.path.strip("/")
        status, body = 200, b"%PDF-1.7 " + name.encode()
        if name.startswith("flaky") and Server.seen[self.path] < 3:
            status = 503
        elif name.startswith("down") and not Server.repaired:
            status = 500
        elif name.startswith("gone"):
            status = 404
        elif name.startswith("html"):
            body = b"<html>not a document</html>"
        elif name.startswith("tiny"):
            body = b"%PDF"
        self.send_response(status)
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *args):
        pass


@pytest.fixture
def host():
    Server.seen.clear()
    Server.repaired = False
    server = ThreadingHTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def wanted(spark, host):
    names = ["ok1", "ok2", "flaky", "down", "gone", "html", "tiny"]
    rows = [(f"S{i}", f"{host}/{n}") for i, n in enumerate(names)] + [("S8", f" {host}/ok1 "), ("S9", None), ("S10", ""), ("S11", "no address"), ("S12", f"{host}/gone")]
    return spark.createDataFrame(rows, "sigla string, url string").repartition(3)


def test_each_address_once_and_again_only_what_is_missing(spark, host, tmp_path):
    rows, out = wanted(spark, host), str(tmp_path / "files")
    first = d.download(rows, out, POLICY)
    got = {r.url.rsplit("/", 1)[-1]: r for r in first.collect()}
    assert {k: (r.status, r.error_type) for k, r in got.items()} == {
        "ok1": ("fetched", None), "ok2": ("fetched", None), "flaky": ("fetched", None), "down": ("error", "http_status"), "gone": ("error", "http_status"),
        "html": ("error", "invalid_content"), "tiny": ("error", "small_content"), "no address": ("error", "bad_address"),
    }
    assert Server.seen == {"/ok1": 1, "/ok2": 1, "/flaky": 3, "/down": 3, "/gone": 1, "/html": 1, "/tiny": 1}
    assert (tmp_path / "files" / got["ok1"].name).read_bytes() == b"%PDF-1.7 ok1" and got["ok1"].bytes == 12
    assert not list((tmp_path / "files").rglob("*.new")) and len([p for p in (tmp_path / "files").rglob("*") if p.is_file()]) == 3

    files = {r.sigla: (r.file, r.fetch_error) for r in d.attach(rows, first).collect()}
    assert files["S0"] == files["S8"] == (got["ok1"].name, None) and files["S4"] == files["S12"] == (None, "http_status") and files["S9"] == (None, None)
    wrong = d.failures(rows, first, F.col("sigla"), F.lit("entregas")).collect()
    assert {(r.orgao_sigla, r.error_type, r.error_message) for r in wrong if r.url.endswith("gone")} == {("S4", "http_status", "404"), ("S12", "http_status", "404")}
    assert len(wrong) == 6 and all(r.stage == "download" and r.timestamp and r.document_type == "entregas" for r in wrong)

    Server.seen.clear()
    Server.repaired = True
    second = {r.url.rsplit("/", 1)[-1]: r.status for r in d.download(rows, out, POLICY).collect()}
    assert {k for k, v in second.items() if v == "present"} == {"ok1", "ok2", "flaky"} and second["down"] == "fetched"
    assert set(Server.seen) == {"/down", "/gone", "/html", "/tiny"}
    Server.seen.clear()
    d.download(rows.filter("sigla IN ('S0', 'S1', 'S2', 'S3', 'S8')"), out, POLICY).collect()
    assert not Server.seen


def test_no_rows(spark, tmp_path):
    none = spark.createDataFrame([], "sigla string, url string")
    results = d.download(none, str(tmp_path), POLICY)
    assert results.count() == 0 and d.attach(none, results).columns == ["sigla", "url", "file", "fetch_error"]


def test_bucket_keeps_the_rate():
    now = [0.0]
    bucket = d.Bucket(2.0, 3, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))
    times = []
    for _ in range(7):
        bucket.take()
        times.append(round(now[0], 6))
    assert times == [0, 0, 0, 0.5, 1.0, 1.5, 2.0]
    now[0] += 100
    bucket.take()
    assert now[0] == 102.0


def test_hosts_that_can_not_be_reached():
    waits = []
    body, kind, _ = d.get("http://127.0.0.1:9/x", d.Policy(rate=1000, tries=3, wait=1, timeout=1), d.Bucket(1000), waits.append)
    assert body is None and kind == "unreachable" and waits == [1, 2]
