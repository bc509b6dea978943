import json
import threading
import urllib.error

import pandas as pd
import pytest

from quillstone import config as C
from quillstone.model import breaker, client, streams
from quillstone.model.runner import ask, batch_prompt, retry_singly

END = "<!-- END -->"
POINT = C.Endpoint("e", "http://localhost:1/v1", "k")


def threads(n, work):
    gate = threading.Barrier(n)
    pool = [threading.Thread(target=lambda k=k: (gate.wait(), work(k))) for k in range(n)]
    for t in pool:
        t.start()
    for t in pool:
        t.join(10)
        assert not t.is_alive()


def test_breaker_counts_under_contention():
    s = breaker.EndpointState(POINT)
    threads(10, lambda _: [s.record_failure("err") for _ in range(100)])
    assert s.total_failures == 1000 and not s.is_available()


def test_breaker_opens_cools_and_resets():
    now, seen = [0.0], []
    s = breaker.EndpointState(POINT, lambda: now[0], seen.append)
    threads(3, lambda _: s.record_failure("err"))
    assert not s.is_available() and len(seen) == 1
    now[0] = breaker.COOL_DOWN_SECONDS
    assert s.is_available()
    s.record_failure("err")  # the count stands: one more failure opens again
    assert not s.is_available() and len(seen) == 2 and seen[1]["failures"] == 4
    now[0] *= 2
    assert s.is_available()
    s.record_success()
    s.record_failure("err")
    s.record_failure("err")
    assert s.is_available()


def test_breaker_readers_and_writers_finish():
    s = breaker.EndpointState(POINT)
    threads(10, lambda k: [(s.record_failure("x"), s.record_success()) if k % 2 else s.is_available() for _ in range(500)])


def test_run_log_is_complete():
    log = breaker.RunLog()
    threads(10, lambda k: [log.record(f"w{k}", f"u{i}", "ok", 0.1, "e" * 900 if i == 0 else None) for i in range(50)])
    s = log.summary("extract", 10)
    assert s["total_units"] == 500 and s["summary"] == {"ok": 500, "error": 0, "skip": 0} and max(len(r.get("error", "")) for r in s["records"]) == 500
    json.dumps(s)


def sse(*parts, reason="stop"):
    out = [b"data: " + json.dumps({"choices": [{"delta": {"content": p}}]}).encode() for p in parts]
    return [*out, b"data: " + json.dumps({"choices": [{"delta": {}, "finish_reason": reason}]}).encode(), b"data: [DONE]", b"data: junk"]


def test_streams():
    assert streams.read_openai([b"", b": hi", *sse("a", "é", reason="length")]) == ("aé", "length")
    with pytest.raises(streams.ModelError):
        streams.read_openai([b'data: {"error": {"message": "no"}}'])
    with pytest.raises(streams.ModelError):
        streams.read_openai(sse("Error 429: rate limit reached"))
    events = [{"type": "message_start"}, {"type": "content_block_delta", "delta": {"text": "x"}}, {"type": "message_delta", "delta": {"stop_reason": "max_tokens"}}, {"type": "message_stop"}, {"type": "content_block_delta", "delta": {"text": "late"}}]
    assert streams.read_claude([f"data: {json.dumps(e)}" for e in events]) == ("x", "max_tokens")
    with pytest.raises(streams.ModelError):
        streams.read_claude(['data: {"type": "error", "error": {"message": "busy"}}'])


STAGE = C.StageConfig("extract", "openai", "m", f"write {END}", "openai", (POINT,))
RUN = C.RuntimeConfig()


def test_failover_and_exhaustion():
    states = [breaker.EndpointState(C.Endpoint(n, f"http://{n}/v1", "k")) for n in "ab"]
    asked = []

    def transport(url, headers, payload, timeout):
        asked.append(url)
        if "//a/" in url:
            raise urllib.error.HTTPError(url, 503, "busy", {}, None)
        return sse("fine " + END)

    assert client.with_failover(STAGE, states, [{"role": "user", "content": "q"}], RUN, transport) == "fine " + END
    assert asked == ["http://a/v1/chat/completions", "http://b/v1/chat/completions"] and states[0].failures == 1

    def broken(*_):
        raise urllib.error.HTTPError("u", 401, "no", {}, None)

    for _ in range(2):
        with pytest.raises(streams.ModelError):
            client.with_failover(STAGE, states, [], RUN, broken)
    with pytest.raises(streams.EndpointsExhausted):
        client.with_failover(STAGE, states, [], RUN, broken)
    assert not issubclass(streams.EndpointsExhausted, streams.ModelError)


def test_continuation():
    answers = iter([sse("part one "), sse("part two " + END)])
    sent = []

    def transport(url, headers, payload, timeout):
        sent.append(payload["messages"])
        return next(answers)

    got = client.with_continuation(STAGE, [breaker.EndpointState(POINT)], "q", RUN, transport)
    assert got == "part onepart two"  # answers are trimmed one by one
    assert [m["content"] for m in sent[-1]][-1] == client.CONTINUE
    assert sent[0][0] == {"role": "system", "content": client.SYSTEM}
    assert sent[0][1]["content"] == f"<instructions>\nwrite {END}\n</instructions>\n\nq"


def failing(errors, then):
    left = iter(errors)

    def transport(*_):
        x = next(left, None)
        if isinstance(x, Exception):
            raise x
        return then if x is None else x

    return transport


def test_retry_budgets():
    def busy(code):
        return urllib.error.HTTPError("u", code, "busy", {}, None)

    def run(errors, retries, then=None, slept=None, point=POINT):
        return client.call(STAGE, point, [{"role": "user", "content": "q"}], RUN, failing(errors, then or sse("x")), retries, (slept if slept is not None else []).append)

    slept = []
    assert run([busy(429), ConnectionResetError("x"), sse(" "), urllib.error.URLError("no"), busy(524)], 3, slept=slept) == "x"
    wait = RUN.retry_delay_seconds
    assert slept == [wait, client.NETWORK_WAIT, client.EMPTY_WAIT, 2 * wait, 3 * wait]
    for errors, retries in (([busy(503)], 0), ([ConnectionResetError("x")], 0), ([sse(" ")], 0), ([busy(503)] * 3, 2), ([busy(401)], 5), ([ConnectionResetError("x")] * 4, 9), ([sse("")] * 4, 9)):
        with pytest.raises(streams.ModelError):
            run(errors, retries)
    answer = json.dumps({"output": [{"content": [{"type": "output_text", "text": "one"}, {"type": "other", "text": "no"}]}, {"content": None}, {"content": [{"type": "text", "text": "two"}]}]}).encode()
    point = C.Endpoint("r", "http://x/v1/responses", "k")
    assert run([], 0, [answer], point=point) == "one\ntwo"
    assert run([], 0, [b'{"output_text": " whole "}'], point=point) == "whole"
    with pytest.raises(streams.ModelError):
        run([busy(524)], 1, [answer], point=point)
    url, headers, body = client._payload(STAGE, point, [{"role": "user", "content": "q"}])
    assert url == "http://x/v1/responses" and "messages" not in body and len(body["input"]) == 2 and "stream" not in body


def test_unit_retries_and_exhaustion():
    tried = []

    def run(error):
        tried.append(1)
        raise error

    with pytest.raises(streams.ModelError):
        client.with_unit_retry(lambda: run(streams.ModelError("x")), lambda s: None)
    assert len(tried) == client.UNIT_RETRIES + 1
    with pytest.raises(streams.EndpointsExhausted):
        client.with_unit_retry(lambda: run(streams.EndpointsExhausted("x")), lambda s: None)
    assert len(tried) == client.UNIT_RETRIES + 2


def test_embeddings_keep_order():
    def transport(url, headers, payload, timeout):
        assert url == "http://localhost:1/v1/embeddings"
        n = len(payload["input"])
        return [json.dumps({"data": [{"index": i, "embedding": [float(payload["input"][i])]} for i in reversed(range(n))]}).encode()]

    got = client.embed([str(k) for k in range(7)], [breaker.EndpointState(POINT)], "m", RUN, 3, transport)
    assert got == [[float(k)] for k in range(7)]


def test_addresses():
    chat = {"": "https://api.openai.com/v1/chat/completions", "http://x": "http://x/v1/chat/completions", "http://x/v1/": "http://x/v1/chat/completions", "http://x/v1/y": "http://x/v1/y/chat/completions", "http://x/proxy?q=1": "http://x/proxy/v1/chat/completions?q=1", "http://x/v1/chat/completions": "http://x/v1/chat/completions", "http://x/a/responses": "http://x/a/responses"}
    assert {u: client.openai_url(u) for u in chat} == chat
    messages = {"": "https://api.anthropic.com/v1/messages", "http://x/": "http://x/v1/messages", "http://x/v1": "http://x/v1/messages", "http://x/proxy": "http://x/proxy/messages", "http://x/v1/messages": "http://x/v1/messages"}
    assert {u: client.anthropic_url(u) for u in messages} == messages
    base = "https://generativelanguage.googleapis.com"
    gemini = {
        "": f"{base}/v1beta/models/m%2F1:generateContent?key=k%26",
        "http://x": "http://x/v1beta/models/m%2F1:generateContent?key=k%26",
        "http://x/v1beta": "http://x/v1beta/models/m%2F1:generateContent?key=k%26",
        "http://x/p": "http://x/p/v1beta/models/m%2F1:generateContent?key=k%26",
        "http://x/models": "http://x/models/m%2F1:generateContent?key=k%26",
        "http://x/y/{model}:generateContent?z=1": "http://x/y/m%2F1:generateContent?z=1&key=k%26",
        "http://x/{api_key}/{model}:generateContent": "http://x/k%26/m%2F1:generateContent",
    }
    assert {u: client.gemini_url(u, "m/1", "k&") for u in gemini} == gemini


def test_answers_stream(monkeypatch):
    """Lines are read as they come: a reader that stops early leaves the rest unread."""
    taken = []

    class Answer:
        def __enter__(self):
            return self

        def __exit__(self, *_):
            taken.append("closed")

        def __iter__(self):
            for x in [*sse("a"), b"data: late"]:
                taken.append(x)
                yield x

    monkeypatch.setattr(client.urllib.request, "urlopen", lambda *_, **__: Answer())
    lines = client.post("http://x", {}, {}, 1)
    assert streams.read_openai(lines) == ("a", "stop")
    lines.close()
    assert taken[-1] == "closed" and b"data: late" not in taken


def test_ask_over_rows(spark):
    units = spark.createDataFrame([(k, f"p{k}") for k in range(20)], "k int, prompt string")

    def build():
        def answer(p):
            if p == "p3":
                raise streams.ModelError("bad")
            return p.upper()

        return answer

    out = {r.k: (r.answer, r.status, r.error) for r in ask(units, "k", "prompt", build).collect()}
    assert out[3] == (None, "error", "bad") and out[4][:2] == ("P4", "ok") and len(out) == 20

    def dead():
        def answer(p):
            raise streams.EndpointsExhausted("none")

        return answer

    statuses = [r.status for r in ask(units, "k", "prompt", dead).collect()]
    assert set(statuses) == {"skip"}


def test_answers_are_sent_on_many_at_once(spark, monkeypatch):
    """One answer a batch cost more than a quick call itself."""
    units, taken = spark.createDataFrame([(1, "p")], "k int, prompt string"), []
    monkeypatch.setattr(type(units), "mapInPandas", lambda self, run, schema: taken.append(run) or self)
    ask(units, "k", "prompt", lambda: str.upper)
    many = pd.DataFrame({"k": range(5000), "prompt": [f"p{k}" for k in range(5000)]})
    sizes = [len(x) for x in taken[0](iter([many[:3000], many[3000:]]))]
    assert sum(sizes) == 5000 and len(sizes) == 5
    large = pd.DataFrame({"k": range(20), "prompt": ["p" * (1 << 22)] * 20})
    assert [x["k"].tolist() for x in taken[0](iter([large]))] == [list(range(k, k + 4)) for k in range(0, 20, 4)]
    assert list(taken[0](iter([]))) == []


def test_answers_are_dealt_out_for_parsing(spark, sf):
    from quillstone.plans.catalog import QUERIES

    plan = QUERIES["model_extract_fake"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan[: plan.index("MapInPandas")]


def test_a_stop_reaches_all_workers(spark):
    units = spark.createDataFrame([(k, f"p{k}") for k in range(200)], "k int, prompt string").coalesce(1)

    def build():
        gate, seen = threading.Lock(), []

        def answer(p):
            with gate:
                seen.append(p)
                if len(seen) > 20:
                    raise streams.EndpointsExhausted("none")
            return p

        return answer

    out = [r.status for r in ask(units, "k", "prompt", build, 8).collect()]
    assert len(out) == 200 and out.count("ok") == 20 and out.count("skip") == 180

    def bad():
        def answer(p):
            raise streams.ModelError("bad")

        return answer

    out = [r.status for r in ask(units, "k", "prompt", bad, 1, give_up=3).collect()]
    assert out.count("error") == 3 and out.count("skip") == 197


def test_failed_batches_are_asked_singly(spark):
    files = spark.createDataFrame([(1, [("a", "x"), ("b", "y")]), (2, [("c", "z")])], "k int, items array<struct<name: string, text: string>>")
    answers = spark.createDataFrame([(1, "error"), (2, "ok")], "k int, status string")
    assert {r.name for r in retry_singly(files, answers, "k", "items").collect()} == {"a", "b"}
    assert files.select(batch_prompt(files.items).alias("p")).first().p.count("来源文件") == 2


def test_config():
    raw = {"similarity": {"threshold": 0.8, "method": "ngram"}, "concurrency": {"max_workers": 0}, "grouping": {"mapping": {"t": ["a"]}}, "stages": {"extract": {"provider": "openai", "model": "m", "api_url": "http://x", "api_key": "k1，k2, "}}}
    c = C.from_dict(raw, {})
    assert c.concurrency.max_workers == 1 and c.mapping == {"t": ["a"]} and [e.api_key for e in c.stages["extract"].endpoints] == ["k1", "k2"]
    assert "k1" not in repr(c.stages["extract"].endpoints[0])
    for bad in ({"similarity": {"threshold": 0}}, {"similarity": {"ngram_size": 1}}, {"batching": {"max_file_kb": 0}}, {"stages": {"s": {"provider": "x", "model": "m"}}}, {"stages": {"s": {"provider": "openai", "model": "m", "api_url": "ftp://x", "api_key": "k"}}}, {"stages": {"s": {"provider": "claude", "model": "m", "api_url": "http://x"}}}):
        with pytest.raises(C.ConfigError):
            C.from_dict(bad, {})
    assert C.from_dict({"stages": {"s": {"provider": "claude", "model": "m", "api_url": "http://x"}}}, {"CLAUDE_API_KEY": "z"}).stages["s"].api_type == "anthropic"
    assert C.ConcurrencyConfig().max_workers == 3
