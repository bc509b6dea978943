"""Model calls: provider payloads, retries, failover, continuation, embeddings.

A transport is a function (url, headers, payload, timeout) -> lines of the answer, so tests pass a fake one.
"""

from __future__ import annotations

import http.client
import json
import logging
import re
import ssl
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterable

from quillstone.config import Endpoint, RuntimeConfig, StageConfig
from quillstone.functions.text import END_MARKER
from quillstone.model.breaker import EndpointState
from quillstone.model.streams import EndpointsExhausted, ModelError, read_claude, read_openai

Transport = Callable[[str, dict, dict, float], Iterable[bytes]]

# Status codes worth another try, rounds and waits; fixed values.
RETRY_CODES = {429, 500, 502, 503, 504, 524}
NETWORK_RETRIES, NETWORK_WAIT, CONTINUATIONS, CONTINUE = 3, 8.0, 5, "继续"
EMPTY_RETRIES, EMPTY_WAIT = 3, 10.0
DROPPED = (ConnectionResetError, ConnectionAbortedError, BrokenPipeError, http.client.RemoteDisconnected, http.client.IncompleteRead, ssl.SSLEOFError)
CUT_OFF = {"length", "max_tokens"}
SYSTEM, OPENAI, ANTHROPIC, GEMINI = "请严格按照 <instructions> 中的指令执行任务。", "https://api.openai.com", "https://api.anthropic.com", "https://generativelanguage.googleapis.com"
UNIT_RETRIES, UNIT_WAIT = 3, 15.0


log = logging.getLogger("quillstone.model")


def post(url: str, headers: dict, payload: dict, timeout: float) -> Iterable[bytes]:
    """Lines of an answer as they come in."""
    request = urllib.request.Request(url, json.dumps(payload, ensure_ascii=False).encode(), {"Content-Type": "application/json", "User-Agent": "quillstone/1.0", **headers}, method="POST")
    with urllib.request.urlopen(request, timeout=timeout) as answer:
        yield from answer


# --- addresses


def _tail(url: str, done: tuple[str, ...], tail: Callable[[str], str]) -> str:
    """url with tail(path) on its path, unless the path ends in one of `done`."""
    path = urllib.parse.urlsplit(url).path.rstrip("/")
    return url if path.endswith(done) else urllib.parse.urlsplit(url)._replace(path=path + tail(path)).geturl()


def openai_url(url: str | None) -> str:
    """The chat address of a base address: a version is added where the path names none."""
    return _tail(url or OPENAI, ("/chat/completions", "/responses"), lambda p: "/chat/completions" if "/v1/" in p + "/" else "/v1/chat/completions")


def anthropic_url(url: str | None) -> str:
    """The message address of a base address: a version is added to a bare host only."""
    return _tail(url or ANTHROPIC, ("/messages",), lambda p: "/messages" if p else "/v1/messages")


def gemini_url(url: str | None, model: str, key: str) -> str:
    """The address of a model's generateContent; the key goes where the address has a place for it, or at its end."""
    name, secret = (urllib.parse.quote(x, safe="") for x in (model, key))
    out = (url or GEMINI).replace("{model}", name).replace("{api_key}", secret)
    if ":generateContent" not in out:

        def tail(p: str) -> str:
            if "/models/" in p + "/":
                return f"/{name}:generateContent"
            return ("" if p.endswith("/v1beta") else "/v1beta") + f"/models/{name}:generateContent"

        out = _tail(out, (":generateContent",), tail)
    if "key=" in out or "{api_key}" in (url or ""):
        return out
    return f"{out}{'&' if '?' in out else '?'}key={secret}"


def embedding_url(url: str | None) -> str:
    return re.sub(r"/(?:chat/completions|responses)$", "/embeddings", openai_url(url))


# --- one call


def _payload(stage: StageConfig, e: Endpoint, messages: list[dict]) -> tuple[str, dict, dict]:
    """(address, headers, body). Instructions go with the first message: not every relay takes a system field."""
    if stage.system_prompt.strip() and messages:
        first = f"<instructions>\n{stage.system_prompt}\n</instructions>\n\n{messages[0]['content']}"
        messages = [messages[0] | {"content": first}, *messages[1:]]
    model = e.model or stage.model
    kind = e.api_type or stage.api_type
    if kind == "anthropic":
        return anthropic_url(e.api_url), {"x-api-key": e.api_key, "anthropic-version": "2023-06-01"}, {"model": model, "system": SYSTEM, "max_tokens": 32_768, "stream": True, "messages": messages}
    if kind == "gemini":
        contents = [{"role": "model" if m["role"] == "assistant" else "user", "parts": [{"text": m["content"]}]} for m in messages]
        return gemini_url(e.api_url, model, e.api_key), {}, {"systemInstruction": {"parts": [{"text": SYSTEM}]}, "contents": contents, "generationConfig": {"temperature": 0.2}}
    url, headers = openai_url(e.api_url), {"Authorization": f"Bearer {e.api_key}"}
    said = [{"role": "system", "content": SYSTEM}, *messages]
    if urllib.parse.urlsplit(url).path.rstrip("/").endswith("/responses"):
        return url, headers, {"model": model, "input": said, "temperature": 0.2}
    return url, headers, {"model": model, "messages": said, "temperature": 0.2, "stream": True}


def _read_gemini(lines: Iterable[bytes]) -> tuple[str, str | None]:
    body = _json(lines)
    first = (body.get("candidates") or [{}])[0]
    parts = [p["text"] for p in (first.get("content") or {}).get("parts") or [] if p.get("text")]
    return "\n".join(parts), first.get("finishReason")


def _read_responses(lines: Iterable[bytes]) -> tuple[str, str | None]:
    """The whole text of a Responses answer, or the texts of its output blocks."""
    body = _json(lines)
    if isinstance(body.get("output_text"), str) and body["output_text"].strip():
        return body["output_text"], body.get("status")
    blocks = [b for item in body.get("output") or [] if isinstance(item, dict) for b in item.get("content") or [] if isinstance(b, dict)]
    texts = [str(b.get("text") or "").strip() for b in blocks if str(b.get("type", "")).lower() in ("output_text", "text")]
    return "\n".join(t for t in texts if t), body.get("status")


def _json(lines: Iterable[bytes]) -> dict:
    try:
        body = json.loads(b"".join(x if x.endswith(b"\n") else x + b"\n" for x in lines) or b"{}")
    except json.JSONDecodeError as x:
        raise ModelError(f"the answer is no JSON: {x}") from x
    if not isinstance(body, dict):
        raise ModelError("the answer is no JSON object")
    if body.get("error"):
        raise ModelError(str(body["error"]))
    return body


def call(stage: StageConfig, e: Endpoint, messages: list[dict], runtime: RuntimeConfig, transport: Transport = post, retries: int = 0, sleep=time.sleep) -> str:
    """One answer of one endpoint.

    Busy or broken servers and unreachable addresses share `retries`, with growing waits; dropped connections
    and empty answers have budgets of their own. Without retries nothing is tried again.
    """
    url, headers, body = _payload(stage, e, messages)
    kind = e.api_type or stage.api_type
    streamed = body.get("stream", False)
    read = read_claude if kind == "anthropic" else _read_gemini if kind == "gemini" else read_openai if streamed else _read_responses
    left = {"http": retries, "network": NETWORK_RETRIES if retries else 0, "empty": EMPTY_RETRIES if retries and streamed else 0}

    def again(budget: str, wait: float, why: str) -> bool:
        if not left[budget]:
            return False
        left[budget] -= 1
        log.warning("%s: %s, trying again in %s s", e.name, why, wait)
        sleep(wait)
        return True

    while True:
        growing = runtime.retry_delay_seconds * (retries - left["http"] + 1)
        try:
            text, reason = read(transport(url, headers, body, runtime.timeout_seconds))
        except urllib.error.HTTPError as x:
            if (x.code != 524 or streamed) and x.code in RETRY_CODES and again("http", growing, f"HTTP {x.code}"):
                continue
            raise ModelError(f"状态码 {x.code}") from x
        except DROPPED as x:
            if again("network", NETWORK_WAIT, f"connection dropped: {x}"):
                continue
            raise ModelError(f"network: {type(x).__name__}: {x}") from x
        except (urllib.error.URLError, TimeoutError, ConnectionError) as x:
            if again("http", growing, f"not reached: {x}"):
                continue
            raise ModelError(f"network: {x}") from x
        if reason in CUT_OFF:
            log.warning("%s: the answer was cut off (%s)", e.name, reason)
        if text.strip():
            return text.strip()
        if not again("empty", EMPTY_WAIT, "empty answer"):
            raise ModelError("content 为空")


def with_failover(stage: StageConfig, states: list[EndpointState], messages: list[dict], runtime: RuntimeConfig, transport: Transport = post, sleep=time.sleep) -> str:
    """The first available endpoint that answers; each failure counts towards its breaker."""
    last = None
    for s in [s for s in states if s.is_available()]:
        try:
            text = call(stage, s.endpoint, messages, runtime, transport, 0, sleep)
        except ModelError as x:
            s.record_failure(str(x))
            last = x
        else:
            s.record_success()
            return text
    if not any(s.is_available() for s in states):
        raise EndpointsExhausted("no endpoint is available") from last
    raise ModelError(f"all endpoints failed: {last}")


def with_continuation(stage: StageConfig, states: list[EndpointState], prompt: str, runtime: RuntimeConfig, transport: Transport = post, sleep=time.sleep) -> str:
    """Asks on until the end mark comes, if the prompts ask for one; what has come by then is kept."""
    messages = [{"role": "user", "content": prompt}]
    parts = [with_failover(stage, states, messages, runtime, transport, sleep)]
    if END_MARKER in stage.system_prompt + prompt:
        for _ in range(CONTINUATIONS):
            if END_MARKER in parts[-1]:
                break
            messages += [{"role": "assistant", "content": parts[-1]}, {"role": "user", "content": CONTINUE}]
            try:
                parts.append(with_failover(stage, states, messages, runtime, transport, sleep))
            except (ModelError, EndpointsExhausted):
                break
    return "".join(parts).replace(END_MARKER, "").strip()


def with_unit_retry(run: Callable[[], str], sleep=time.sleep) -> str:
    """run(), and up to UNIT_RETRIES times more where it fails; no endpoint left is not tried again."""
    for _ in range(UNIT_RETRIES):
        try:
            return run()
        except ModelError as x:
            log.warning("work unit failed, trying again in %s s: %s", UNIT_WAIT, x)
            sleep(UNIT_WAIT)
    return run()


def embed(texts: list[str], states: list[EndpointState], model: str, runtime: RuntimeConfig, batch: int = 100, transport: Transport = post) -> list[list[float]]:
    """Vectors of texts, in order, `batch` texts a request."""
    out: list[list[float]] = []
    for k in range(0, len(texts), batch):
        part, last = texts[k : k + batch], None
        for s in [s for s in states if s.is_available()]:
            e = s.endpoint
            try:
                body = _json(transport(embedding_url(e.api_url), {"Authorization": f"Bearer {e.api_key}"}, {"model": model or e.model, "input": part}, runtime.timeout_seconds))
                rows = sorted(body["data"], key=lambda r: r["index"])
                if len(rows) != len(part):
                    raise ModelError(f"{len(rows)} vectors for {len(part)} texts")
            except (ModelError, urllib.error.URLError, ConnectionError, KeyError, ValueError) as x:
                s.record_failure(str(x))
                last = x
            else:
                s.record_success()
                out += [r["embedding"] for r in rows]
                break
        else:
            raise EndpointsExhausted("no endpoint is available") if not any(s.is_available() for s in states) else ModelError(f"embedding failed: {last}")
    return out
