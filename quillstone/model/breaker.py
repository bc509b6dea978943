"""Per-endpoint circuit breaker and run log, safe to share between threads."""

from __future__ import annotations

import threading
import time
from collections import Counter
from collections.abc import Callable

from quillstone.config import Endpoint

#: Failures in a row that open a breaker, and how long it stays open; fixed values.
FAILURES, COOL_DOWN_SECONDS = 3, 18_000


class EndpointState:
    def __init__(self, endpoint: Endpoint, clock: Callable[[], float] = time.monotonic, log: Callable[[dict], None] | None = None):
        self.endpoint, self.clock, self.log = endpoint, clock, log
        self.lock = threading.Lock()
        self.failures = self.total_failures = 0
        self.open_until: float | None = None
        self.errors: list[str] = []

    @property
    def name(self) -> str:
        return self.endpoint.name

    def is_available(self) -> bool:
        """After the cool-down the count of failures stands: one success clears it, one more failure opens anew."""
        with self.lock:
            return self.open_until is None or self.clock() >= self.open_until

    def record_success(self) -> None:
        with self.lock:
            self.failures, self.open_until = 0, None

    def record_failure(self, error: str) -> None:
        with self.lock:
            self.failures += 1
            self.total_failures += 1
            self.errors = [*self.errors[-4:], error[:500]]
            now = self.clock()
            opened = self.failures >= FAILURES and (self.open_until is None or now >= self.open_until)
            if self.failures >= FAILURES:
                self.open_until = now + COOL_DOWN_SECONDS
            said = {"endpoint": self.name, "model": self.endpoint.model, "api_type": self.endpoint.api_type, "failures": self.failures, "cool_down_seconds": COOL_DOWN_SECONDS, "error": error[:500], "errors": list(self.errors)}
        if opened and self.log:
            self.log(said)


STATUSES = ("ok", "error", "skip")


def run_summary(stage: str, max_workers: int, total_units: int, seconds: float, records: list[dict]) -> dict:
    """What a stage's log says: every status is counted, also those that did not occur."""
    counts = dict.fromkeys(STATUSES, 0) | Counter(r["status"] for r in records)
    return {"stage": stage, "max_workers": max_workers, "total_units": total_units, "total_seconds": round(seconds, 3), "summary": counts, "records": records}


def summary_line(log: dict) -> str:
    counts = " ".join(f"{k}={n}" for k, n in log["summary"].items())
    return f"[{log['stage']}] {counts} seconds={log['total_seconds']} workers={log['max_workers']}"


class RunLog:
    """Work-unit records of one process; across executors the same fields are output columns."""

    def __init__(self):
        self.lock, self.records, self.began = threading.Lock(), [], time.monotonic()

    def record(self, worker: str, unit: str, status: str, duration_s: float, error: str | None = None) -> None:
        row = {"worker": worker, "unit": unit, "status": status, "duration_s": round(duration_s, 3)}
        if error:
            row["error"] = error[:500]
        with self.lock:
            self.records.append(row)

    def summary(self, stage: str, max_workers: int) -> dict:
        with self.lock:
            rows = list(self.records)
        return run_summary(stage, max_workers, len(rows), time.monotonic() - self.began, rows)
