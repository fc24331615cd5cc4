import json
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from tessera.operators import annotate, collect
from tessera.plans.pipeline import Pipeline
from tessera.sources import connectors, http
from tessera.sources.connectors import Request, StatusError

PNG = connectors.FixedPictures().fetch("")[1]


class Service(BaseHTTPRequestHandler):
    asked: list = []

    def log_message(self, *_):
        pass

    def answer(self, status, content, kind="application/json", **headers):
        content = content if isinstance(content, bytes) else json.dumps(content).encode()
        self.send_response(status)
        for k, v in {"Content-Type": kind, "Content-Length": str(len(content)), **headers}.items():
            self.send_header(k.replace("_", "-"), v)
        self.end_headers()
        self.wfile.write(content)

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        Service.asked.append((self.path, dict(self.headers), body))
        if self.path.startswith("/busy"):
            self.answer(429, {}, Retry_After="7")
        elif self.path.endswith("/chat/completions"):
            self.answer(200, {"choices": [{"message": {"content": ' {"a": 1} '}}]})
        elif ":generateContent" in self.path:
            self.answer(200, {"candidates": [{"content": {"parts": [{"text": '{"a":'}, {"text": " 2}"}]}}]})
        elif self.path == "/search":
            self.answer(200, {"organic": [{"link": f"http://h/{i}", "snippet": body["q"]} for i in range(body["num"])]} if body["q"] != "none" else {})
        else:
            self.answer(200, {"text": "naïve " + body["url"]})

    def do_GET(self):
        if self.path == "/gone":
            self.answer(404, b"")
        elif self.path == "/p.png":
            self.answer(200, PNG, "image/png")
        else:
            self.answer(200, "é".encode("latin-1"), "text/html; charset=latin-1")


@pytest.fixture(scope="module")
def home():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_text_generation(home):
    r = Request("1", "hi", "sys", (), {"top_p": 1})
    assert http.annotator("OpenAI", "m", "k", 0.5, home).complete(r) == '{"a": 1}'
    path, headers, body = Service.asked[-1]
    assert path == "/chat/completions" and headers["Authorization"] == "Bearer k"
    assert body == {"model": "m", "temperature": 0.5, "messages": [{"role": "system", "content": "sys"}, {"role": "user", "content": "hi"}], "response_format": {"type": "json_object"}, "top_p": 1}
    assert http.annotator("gemini", "m", "k&", 0.5, home).complete(r) == '{"a": 2}'
    path, _, body = Service.asked[-1]
    assert path == "/models/m:generateContent?key=k%26" and body["systemInstruction"] == {"parts": [{"text": "sys"}]}
    assert body["generationConfig"] == {"responseMimeType": "application/json", "temperature": 0.5, "top_p": 1}
    with pytest.raises(StatusError) as e:
        http.annotator("xai", "m", "k", base_url=home + "/busy").complete(r)
    assert (e.value.status, e.value.retry_after) == (429, "7")
    for bad in (("other", "m", "k"), ("openai", "m", "")):
        with pytest.raises(ValueError):
            http.annotator(*bad)


def test_collection(spark, home, tmp_path):
    queries = spark.createDataFrame([("q é",), ("none",)], "query string")
    hits = collect.searched(queries, http.Search("k", home + "/search"), 2, 3)
    assert sorted((r.rank, r.link, r.snippet) for r in hits.collect()) == [(0, "http://h/0", "q é"), (1, "http://h/1", "q é")]
    texts = collect.scraped(hits, http.Scrape("k", home + "/scrape"), 2).collect()
    assert sorted(r.full_text for r in texts) == ["naïve http://h/0", "naïve http://h/1"]
    assert Service.asked[-1][1]["X-Api-Key"] == "k"
    pages = spark.createDataFrame([(i, home + p) for i, p in enumerate(("/a", "/gone", "/b"))] + [(3, "http://127.0.0.1:1/x")], "page_id long, url string")
    assert sorted((r.page_id, r.html) for r in collect.fetched(pages, http.Pages(5), 4).collect()) == [(0, "é"), (2, "é")]
    asked = spark.createDataFrame([("a.jpg", home + "/p.png"), ("b.jpg", home + "/gone"), ("c.jpg", home + "/page")], "name string, url string")
    got = collect.pictures(asked, http.Pictures(), str(tmp_path / "img"), concurrency=2).collect()
    assert [(r.name, r.width, r.height) for r in got] == [("a.jpg", 800, 600)] and open(got[0].path, "rb").read() == PNG
    assert collect.pictures(asked, http.Pictures(), str(tmp_path / "img"), 801).count() == 0


class Slow:
    """Counts how many requests are under way at once, in files that tests can read."""

    def __init__(self, folder):
        self.folder = str(folder)

    def complete(self, request):
        began = time.time()
        time.sleep(0.3)
        with open(f"{self.folder}/{request.request_id}", "w") as f:
            f.write(f"{began} {time.time()}")
        if request.request_id == "3":
            raise StatusError(404)
        return '{"a": %s}' % request.request_id


def test_requests_in_flight_and_pauses(spark, tmp_path):
    items = spark.range(8).selectExpr("cast(id as string) as item_id", "'m' as message").coalesce(1)
    rows = annotate.annotated(items, Slow(tmp_path), batch_size=4, delay=0.5).collect()
    assert [(r.id, r.success, r.data) for r in rows] == [(str(i), i != 3, None if i == 3 else '{"a": %d}' % i) for i in range(8)]
    times = [tuple(map(float, (tmp_path / str(i)).read_text().split())) for i in range(8)]
    assert max(t[0] for t in times[:4]) < min(t[1] for t in times[:4])
    assert min(t[0] for t in times[4:]) - max(t[1] for t in times[:4]) >= 0.5


def test_keys_choose_services(spark, tmp_path):
    base = {"country": "x", "sft_target_language": "en", "hf_model_id": "m", "run_dir": str(tmp_path)}
    run = Pipeline(spark, base)
    assert isinstance(run.annotator, connectors.FixedAnnotator) and isinstance(run.search, connectors.FixedSearch)
    run = Pipeline(spark, base | {"llm_api_key": "k", "llm_provider": "openai", "llm_model": "g", "llm_temperature": 0.7, "llm_batch_size": 9, "llm_batch_delay": 0.1, "serper_api_key": "s"})
    assert run.annotator == http.ChatClient("https://api.openai.com/v1", "g", "k", 0.7) and run.decisions is run.annotator
    assert (run.search, run.scrape, run.pace) == (http.Search("s"), http.Scrape("s"), {"batch_size": 9, "delay": 0.1})
