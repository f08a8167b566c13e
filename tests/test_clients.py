"""Model clients against a service in this process."""

import functools
import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from tarnwork.functions import clients, models, resilience


class Service(BaseHTTPRequestHandler):
    seen: list = []

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        self.seen.append((self.path, self.headers["Authorization"], body))
        if body["model"] == "broken":
            self.send_response(500)
            self.end_headers()
            return
        answer = {"choices": [{"message": {"content": " A chart. "}}]} if "chat" in self.path else {"data": [{"index": k, "embedding": [float(k), 1.0]} for k in reversed(range(len(body["input"])))]}
        data = json.dumps({} if body["model"] == "odd" else answer).encode()
        self.send_response(200)
        self.end_headers()
        self.wfile.write(data)

    def log_message(self, *_):
        pass


@pytest.fixture(scope="module")
def url():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/v1"
    server.shutdown()


def test_requests(url):
    assert clients.ChatSummarizer(url, "k", "m")(b"image") == "A chart."
    path, auth, body = Service.seen[-1]
    assert (path, auth, body["max_tokens"], body["temperature"]) == ("/v1/chat/completions", "Bearer k", 300, 0.2)
    assert clients.PassageEmbedder(url, "k", "m")(["a", "b", "c"]) == [[0.0, 1.0], [1.0, 1.0], [2.0, 1.0]]
    assert Service.seen[-1][2]["input_type"] == "passage" and Service.seen[-1][2]["truncate"] == "END"


def test_errors(url):
    for make, error, again in ((clients.PassageEmbedder(url, model="broken"), clients.APIError, True), (clients.PassageEmbedder(url, model="odd"), clients.APIError, True), (clients.ChatSummarizer("http://127.0.0.1:9/v1"), ConnectionError, True)):
        with pytest.raises(error) as e:
            make([] if isinstance(make, clients.PassageEmbedder) else b"")
        assert resilience.classify(e.value) is again


def test_on_executors(spark, url):
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(20)], "i int, t string").coalesce(1)
    got = models.embed(rows, "t", functools.partial(clients.PassageEmbedder, url, "k", "m"), dimension=2).orderBy("i").collect()
    assert [r.vector[0] for r in got] == [float(i % 16) for i in range(20)] and all(r.error is None for r in got)
