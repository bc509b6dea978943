"""Readers of streamed model answers: pure functions over lines."""

from __future__ import annotations

import json
from collections.abc import Iterable


class ModelError(RuntimeError):
    """A call that failed; the caller may try again."""


class EndpointsExhausted(RuntimeError):
    """No endpoint is left; not a ModelError, so a retry loop doesn't catch it."""


def _events(lines: Iterable[bytes | str]):
    for line in lines:
        text = line.decode("utf-8", "replace") if isinstance(line, bytes) else line
        text = text.strip()
        if text.startswith("data:"):
            data = text[5:].strip()
            if data == "[DONE]":
                return
            try:
                yield json.loads(data)
            except json.JSONDecodeError:
                continue
        elif text.startswith("{"):
            try:
                body = json.loads(text)
            except json.JSONDecodeError:
                continue
            if "error" in body:
                yield body


def _fail(error) -> None:
    message = error.get("message", error) if isinstance(error, dict) else error
    raise ModelError(f"stream error: {message}")


def read_openai(lines: Iterable[bytes | str]) -> tuple[str, str | None]:
    """(text, finish reason) of a chat-completion stream."""
    parts: list[str] = []
    reason = None
    for e in _events(lines):
        if e.get("error"):
            _fail(e["error"])
        for choice in e.get("choices") or []:
            parts.append((choice.get("delta") or {}).get("content") or "")
            reason = choice.get("finish_reason") or reason
    text = "".join(parts)
    if len(text) < 400 and "429" in text and "rate limit" in text.lower():
        raise ModelError(f"状态码 429: {text}")
    return text, reason


def read_claude(lines: Iterable[bytes | str]) -> tuple[str, str | None]:
    """(text, stop reason) of a message stream."""
    parts: list[str] = []
    reason = None
    for e in _events(lines):
        kind = e.get("type")
        if kind == "error" or (kind is None and e.get("error")):
            _fail(e.get("error"))
        elif kind == "content_block_delta":
            parts.append((e.get("delta") or {}).get("text") or "")
        elif kind == "message_delta":
            reason = (e.get("delta") or {}).get("stop_reason") or reason
        elif kind == "message_stop":
            break
    return "".join(parts), reason
