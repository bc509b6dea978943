"""Model calls over DataFrames."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.model.streams import EndpointsExhausted, ModelError

#: prompt -> answer. Built once a task, so that breakers and connections live as long as it.
Answerer = Callable[[str], str]


def single_prompt(name: Column, text: Column) -> Column:
    return F.concat(F.lit("请处理以下文件。文件名："), name, F.lit("\n\n"), text)


def batch_prompt(items: Column) -> Column:
    """Prompt of an array of struct(name, text)."""
    part = F.transform(items, lambda x: F.concat(F.lit("---\n## 来源文件："), x["name"], F.lit("\n\n"), x["text"]))
    return F.concat(F.lit("请逐个处理以下文件。\n\n"), F.array_join(part, "\n\n"))


#: Threads of one task; more workers than that are spread over several tasks.
THREADS = 16
#: Calls, and letters of their prompts, that the workers of a task share out before the answers are sent on.
CALLS, LETTERS = 1024, 1 << 24


def ask(units: DataFrame, key: str, prompt: str, build: Callable[[], Answerer], max_workers: int = 3, give_up: int = 0) -> DataFrame:
    """(key, answer, status, duration_s, error): at most max_workers calls at a time.

    Status is ok, error, or skip once no endpoint is left. The workers of a task are threads that share its
    answerer, so its breakers count for all of them, and a stop reaches all of them: calls that have begun end,
    no other begins; `give_up` errors in a row (0: never) stop a task too. Rows stream: the prompts and
    answers of CALLS calls are held. The tasks are as few as the workers ask for, so deal answers out again
    before more work on them. Answers should be appended to a table
    keyed by `key` and later runs anti-join it: a task that runs again may call again, but no answer is stored
    twice. Speculation must be off.
    """
    tasks = -(-max_workers // THREADS)
    threads = -(-max_workers // tasks)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        answer, stopped, failed, lock = build(), threading.Event(), [0], threading.Lock()

        def count(bad: bool):
            with lock:
                failed[0] = failed[0] + 1 if bad else 0
                if give_up and failed[0] >= give_up:
                    stopped.set()

        def one(k, p):
            began = time.monotonic()
            text = error = None
            status = "skip"
            if not stopped.is_set():
                try:
                    text, status = answer(p), "ok"
                    count(False)
                except EndpointsExhausted as x:
                    stopped.set()
                    error = str(x)[:500]
                except ModelError as x:
                    status, error = "error", str(x)[:500]
                    count(True)
            return k, text, status, time.monotonic() - began, error

        def work(todo):
            out = []
            while True:
                with lock:
                    row = next(todo, None)
                if row is None:
                    return out
                out.append((row[0], *one(*row[1])))

        with ThreadPoolExecutor(threads) as pool:
            for part in parts(batches):
                todo = iter(list(enumerate(part)))
                found = [x for f in [pool.submit(work, todo) for _ in range(threads)] for x in f.result()]
                yield rows([x[1:] for x in sorted(found, key=lambda x: x[0])])

    def parts(batches):
        held, letters = [], 0
        for pdf in batches:
            for k, p in zip(pdf[key], pdf[prompt], strict=True):
                held.append((k, p))
                letters += len(p or "")
                if len(held) >= CALLS or letters >= LETTERS:
                    yield held
                    held, letters = [], 0
        if held:
            yield held

    def rows(found):
        return pd.DataFrame(found, columns=[key, "answer", "status", "duration_s", "error"])

    kind = units.schema[key].dataType.simpleString()
    dealt = units.select(key, prompt).repartition(tasks, key)
    return dealt.mapInPandas(run, f"{key} {kind}, answer string, status string, duration_s double, error string")


def retry_singly(batches: DataFrame, answers: DataFrame, key: str, items: str) -> DataFrame:
    """(name, text) of the files of batches that had no answer, to be asked one by one."""
    failed = batches.join(answers.where("status = 'ok'").select(key), key, "left_anti")
    return failed.select(F.explode(items).alias("f")).select("f.name", "f.text")
