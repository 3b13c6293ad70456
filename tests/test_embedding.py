"""The embedding service against a local server that fails in several ways."""

import json
import socket
import threading
import time
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from quire.operators import index


@pytest.fixture
def server():
    """Texts say what becomes of them: '<kind> <times> <name>' fails so many times before it is answered."""
    asked, lock, now = Counter(), threading.Lock(), {"open": 0, "most": 0}

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            kind, times, name = body["prompt"].split()
            with lock:
                asked[body["prompt"]] += 1
                n = asked[body["prompt"]]
                now["open"] += 1
                now["most"] = max(now["most"], now["open"])
            time.sleep(0.02)
            with lock:
                now["open"] -= 1
            if n <= int(times):
                if kind == "slow":
                    time.sleep(1)
                elif kind == "lost":
                    self.connection.shutdown(socket.SHUT_RDWR)
                    self.connection.close()
                    return
                elif kind in ("500", "503", "400", "404"):
                    self.send_error(int(kind))
                    return
            answer = json.dumps({"embedding": [float(len(name)), float(ord(name[0]))]} if kind != "empty" else {}).encode()
            try:
                self.send_response(200)
                self.send_header("Content-Length", str(len(answer)))
                self.end_headers()
                self.wfile.write(answer)
            except OSError:
                pass

        def log_message(self, *_):
            pass

    httpd = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=httpd.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{httpd.server_port}", asked, now
    httpd.shutdown()


def test_failures_are_tried_again_in_order(server):
    url, asked, now = server
    embed = index.service(url, "m", timeout=0.5, at_once=4, wait=0.01)
    texts = ["ok 0 a", "500 2 bb", "lost 1 ccc", "slow 1 dddd", *[f"ok 0 {'x' * i}" for i in range(1, 30)]]
    assert embed(texts) == [[float(len(t.split()[2])), float(ord(t.split()[2][0]))] for t in texts]
    assert asked["500 2 bb"] == 3 and asked["lost 1 ccc"] == 2 and asked["slow 1 dddd"] == 2 and asked["ok 0 a"] == 1
    assert 2 <= now["most"] <= 5 and embed([]) == []


@pytest.mark.parametrize(("text", "attempts", "message"), [("503 9 a", 3, "after 3 attempts"), ("lost 9 a", 3, "after 3 attempts"), ("400 9 a", 1, "refuses a text: 400"), ("404 1 a", 1, "404")])
def test_failures_that_stay(server, text, attempts, message):
    url, asked, _ = server
    with pytest.raises(RuntimeError, match=message):
        index.service(url, "m", wait=0.01)(["ok 0 b", text])
    assert asked[text] == attempts


def test_an_answer_without_an_embedding_and_no_server(server):
    with pytest.raises(KeyError):
        index.service(server[0], "m", wait=0.01)(["empty 0 a"])
    with pytest.raises(RuntimeError, match="after 2 attempts"):
        index.service("http://127.0.0.1:9", "m", attempts=2, wait=0.01)(["ok 0 a"])


def test_finished_batches_are_kept(server, tmp_path):
    url, asked, _ = server
    embed = index.resumed(index.service(url, "m", attempts=1, wait=0.01), str(tmp_path / "kept"), size=4)
    texts = [*[f"ok 0 {'y' * i}" for i in range(1, 9)], "500 1 z", "ok 0 w"]
    with pytest.raises(RuntimeError):
        embed(texts)
    made = embed(texts)
    assert made == [[float(len(t.split()[2])), float(ord(t.split()[2][0]))] for t in texts] and embed(texts) == made
    assert all(asked[t] == 1 for t in texts[:8]) and asked["500 1 z"] == 2


def test_vectors_by_the_service(spark, server, tmp_path):
    url, _, now = server
    rows = [("m", i, f"m::{i}", f"500 1 {'q' * (i + 1)}", ("", "", "", [], [], [])) for i in range(40)]
    meta = "level1_id: string, procedure_name: string, hierarchical_header: string, vehicle_models: array<string>, figure_references: array<string>, cross_references: array<string>"
    chunks = spark.createDataFrame(rows, f"manual_id string, chunk_ord int, chunk_id string, text string, metadata struct<{meta}>").coalesce(2)
    path = str(tmp_path / "index")
    assert index.build(chunks, path, index.resumed(index.service(url, "m", wait=0.01), str(tmp_path / "kept")), size=2) == 40
    assert now["most"] > 1
