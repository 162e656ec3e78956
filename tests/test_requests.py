"""Requests to a model: a local server, pace, retries, resumed runs."""

import json
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from folioforge import schemas
from folioforge.operators.translate import ModelSettings, Pace, TranslationError, ask_json, http_model, reply_text, select_chapters, translate
from folioforge.ordering import row_numbers, running_sums
from folioforge.plans import pipeline as P
from folioforge.sources import writers
from pyspark.sql import functions as F


class Stub(BaseHTTPRequestHandler):
    """Answers with a translated chapter; the first request for every third one fails."""

    asked: list = []
    under_way, most = 0, 0
    lock = threading.Lock()

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        chapter = json.loads(body["messages"][1]["content"].split("Chapter:\n", 1)[1])
        n = chapter["chapter_number"]
        with Stub.lock:
            Stub.under_way += 1
            Stub.most = max(Stub.most, Stub.under_way)
            first = n not in [a[0] for a in Stub.asked]
            Stub.asked.append((n, self.path, self.headers["Authorization"], body["model"], body["response_format"], time.monotonic()))
        time.sleep(0.05)
        with Stub.lock:
            Stub.under_way -= 1
        if n % 3 == 0 and first:
            self.send_error(503)
            return
        out = {k: [] for k in ("canonical_entities", "places", "themes", "translation_notes", "questions")} | {k: "x" for k in ("chapter_summary", "chapter_title", "kanda")}
        out |= {"chapter_id": "c", "chapter_number": n, "kanda_order": 1, "sarga_range": None}
        reply = {"choices": [{"message": {"content": json.dumps(out) if n != 7 else "  "}}]}
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps(reply).encode())

    def log_message(self, *args):
        pass


@pytest.fixture
def server():
    Stub.asked, Stub.under_way, Stub.most = [], 0, 0
    own = ThreadingHTTPServer(("127.0.0.1", 0), Stub)
    threading.Thread(target=own.serve_forever, daemon=True).start()
    yield ModelSettings("key", f"http://127.0.0.1:{own.server_port}/v1", "m", 0.1, 3, 10.0)
    own.shutdown()


def chapters(spark, numbers):
    fields = [f.split(" ", 1) for f in ("chapter_number int", "chapter_id string")]
    own = spark.createDataFrame([(n, f"c{n}") for n in numbers], ", ".join(" ".join(f) for f in fields))
    empty = spark.createDataFrame([], schemas.SOURCE_CHAPTER)
    return own.unionByName(empty, allowMissingColumns=True).select(empty.columns)




def test_requests_go_out_at_once_and_are_retried(spark, server):
    cache = spark.createDataFrame([], "chapter_number int, translated string")
    done = translate(select_chapters(chapters(spark, range(1, 9)).coalesce(1), None).coalesce(1), cache, lambda: http_model(server), sleep=lambda s: None, at_once=4).collect()
    got = {r.chapter_number: (r.status, r.attempts, r.request_no) for r in done}
    assert got == {n: ("failed", None, n - 1) if n == 7 else ("translated", 2 if n % 3 == 0 else 1, n - 1) for n in range(1, 9)}
    assert [r.error for r in done if r.chapter_number == 7] == ["no usable reply after 3 attempts: the reply has no text at choices.0.message.content"]
    assert all(a[1:5] == ("/v1/chat/completions", "Bearer key", "m", {"type": "json_object"}) for a in Stub.asked)
    assert 1 < Stub.most <= 4 and len(Stub.asked) == 5 + 2 * 2 + 3


def test_replies_without_text():
    for answer in (None, [], {}, {"choices": []}, {"choices": [{}]}, {"choices": [{"message": None}]}, {"choices": [{"message": {"content": 3}}]}, {"choices": [{"message": {"content": " "}}]}):
        with pytest.raises(TranslationError, match="no text"):
            reply_text(answer)
    assert reply_text({"choices": [{"message": {"content": "x"}}]}) == "x"


def test_pace_is_a_token_bucket():
    now, waits = [0.0], []
    pace = Pace(2, 3, clock=lambda: now[0], sleep=waits.append)
    for _ in range(5):
        pace.wait()
    assert waits == [0.5, 1.0]  # three at once, then two a second
    now[0] += 10
    for _ in range(4):
        pace.wait()
    assert waits == [0.5, 1.0, 0.5]


def test_retries_pass_the_pace_and_back_off():
    waits, calls = [], []

    def model(system, user):
        calls.append(user)
        raise OSError("down")

    with pytest.raises(TranslationError, match="after 4 attempts"):
        ask_json(model, "s", "u", 4, waits.append)
    assert waits == [1, 2, 4] and len(calls) == 4


def test_a_run_broken_off_goes_on_where_it_was(spark, tmp_path, monkeypatch):
    """The second wave breaks the run; the next run asks only for what is not in the cache."""
    ws = P.Workspace(f"file://{tmp_path}")
    writers.write_json_array(chapters(spark, range(1, 7)), ws.path("chapters_telugu.json"), ["chapter_number"])
    counted = tmp_path / "asked"

    def make():
        def ask(system, user):
            n = json.loads(user.split("Chapter:\n", 1)[1])["chapter_number"]
            with open(counted, "a") as f:
                f.write(f"{n}\n")
            out = {k: [] for k in ("canonical_entities", "places", "themes", "translation_notes", "questions")} | {k: "x" for k in ("chapter_summary", "chapter_title", "kanda", "chapter_id")}
            return json.dumps(out | {"chapter_number": n, "kanda_order": 1, "sarga_range": None})
        return ask

    write, waves = writers.write_cache, []

    def breaking(df, path):
        waves.append(df.count())
        if len(waves) == 2:
            raise RuntimeError("the driver is gone")
        write(df, path)

    monkeypatch.setattr(writers, "write_cache", breaking)
    with pytest.raises(RuntimeError, match="gone"):
        P.translate_file(spark, ws, make, wave=2)
    monkeypatch.setattr(writers, "write_cache", write)
    done = P.translate_file(spark, ws, make, wave=2)
    assert {r.chapter_number: r.status for r in done.collect()} == {n: "cached" if n <= 2 else "translated" for n in range(1, 7)}
    assert sorted(map(int, counted.read_text().split())) == [1, 2, 3, 3, 4, 4, 5, 6]
    audit = [json.loads(x) for x in (tmp_path / "translation_audit.jsonl").read_text().split("\n") if x]
    assert [a["chapter_number"] for a in audit] == list(range(1, 7))
    for a in audit:  # the path that an audit names is there
        assert (tmp_path / a["cache_path"].removeprefix(ws.path(""))).is_dir()


def test_numbers_and_sums_over_partitions(spark):
    df = spark.range(1000).select(((F.col("id") * 37) % 1000).alias("v")).repartition(7)
    got = row_numbers(df, ["v"], "no").collect()
    assert all(r.v == r.no for r in got) and len(got) == 1000
    sums = running_sums(spark.range(100).select((F.col("id") % 10).alias("at"), F.floor(F.col("id") / 10).alias("block")), "block", "at", {"s": F.lit(1), "t": F.col("at")}).collect()
    assert all(r.s == r.block * 10 + r["at"] and r.t == r.block * 45 + sum(range(r["at"])) for r in sums)
