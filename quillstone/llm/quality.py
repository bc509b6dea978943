"""Document quality by co-training of a text view and a page-metadata view.

The text view is numbers about the content: shares of byte classes, word and line statistics. The metadata
view is what is known about the page without reading it: language, source, size. Each view has a logistic
classifier. Over rounds, each labels documents of a pool without labels; the ones it is surest of join the
other's training set as pseudo-labels. At the end each view is calibrated on labelled documents kept from its
training, and a logistic combination of the calibrated views scores all documents.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import staged
from quillstone.llm.toxicity import carried_names, training_rows

HASHED = 32
_SETS = ["\n", "!", "?", "|", "#", "$", "%", "&", "*", "<>[]{}\\^~`=+_@", ",", ";:", ".", "'\"", "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", " \t\r"]
_MEMBER = np.zeros((256, len(_SETS) + 1))
for _k, _s in enumerate(_SETS):
    _MEMBER[list(_s.encode()), _k] = 1
_MEMBER[128:, len(_SETS)] = 1


def content_view(text: str | None) -> np.ndarray:
    """Numbers about a whole text."""
    raw = (text or "").encode("utf-8", "replace")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if raw else np.zeros(256)
    share = np.sqrt(counts @ _MEMBER / max(1, len(raw)))
    words = (text or "").split()
    n = len(words)
    lines = [x for x in (text or "").split("\n") if x]
    stats = [np.log1p(n), len(raw) / (n + 1), len(set(words)) / (n + 1), len(set(lines)) / (len(lines) + 1), np.log1p(len(lines)), n / (len(lines) + 1) / 50, float(n == 0), float(n < 5)]
    return np.concatenate([share, np.minimum(stats, 50.0)])


def metadata_view(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """Language and source as hashed indicators, and the stated size."""
    out = np.zeros(HASHED + 6)
    out[zlib.crc32(f"lang={lang}".encode()) % HASHED] += 1
    out[zlib.crc32(f"source={source}".encode()) % HASHED] += 1
    size = np.log1p(max(0, n_chars or 0))
    out[HASHED:] = [size / 10, (size / 10) ** 2, float(n_chars is None), float(size < 4), float(size < 6), float(size > 10)]
    return out


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(((x - self.mean) / self.scale) @ self.weights[1:] + self.weights[0], -30, 30)


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 25) -> Logistic:
    """Newton steps on the penalised likelihood; the intercept is free."""
    mean, scale = x.mean(0), x.std(0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w, ridge = np.zeros(z.shape[1]), np.full(z.shape[1], penalty)
    ridge[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(ridge), z.T @ (p - y) + ridge * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return Logistic(mean, scale, w)


@dataclass
class QualityModel:
    """Two views, their calibrations and the combination; `constant` where labels of one kind are missing."""

    views: list[Logistic]
    calibrations: list[Logistic]
    mix: Logistic | None
    constant: float = 1.0

    def score(self, views: list[np.ndarray]) -> np.ndarray:
        if self.mix is None:
            return np.full(len(views[0]), self.constant)
        z = np.column_stack([c.logit(v.logit(x)[:, None]) for v, c, x in zip(self.views, self.calibrations, views, strict=True)])
        return 1 / (1 + np.exp(-self.mix.logit(z)))


class Pool:
    """Unlabelled rows in memory: a matrix a view."""

    def __init__(self, views: list[np.ndarray]):
        self.views, self.free = views, [np.ones(len(views[0]), bool) for _ in views]

    def surest(self, models: list[Logistic], sure: float, want: dict[tuple[int, float], int]) -> dict[tuple[int, float], np.ndarray]:
        """By (view, label): the other view's numbers of at most so many rows that the view is surest of; each goes
        to a view once."""
        out = {}
        for (k, label), n in want.items():
            p = 1 / (1 + np.exp(-models[k].logit(self.views[k]))) if len(self.views[k]) else np.zeros(0)
            trust, other = p if label else 1 - p, 1 - k
            order = np.argsort(-trust, kind="stable")
            take = order[(trust[order] >= sure) & self.free[other][order]][:n]
            self.free[other][take] = False
            out[k, label] = self.views[other][take]
        return out


class TablePool:
    """All unlabelled rows, (id, view0, view1) in a table: scored where they lie, only the rows asked for come back."""

    def __init__(self, table: DataFrame):
        self.table = table
        self.taken: list[set[int]] = [set(), set()]

    def surest(self, models: list[Logistic], sure: float, want: dict[tuple[int, float], int]) -> dict[tuple[int, float], np.ndarray]:
        shared = self.table.sparkSession.sparkContext.broadcast((models, self.taken))

        def score(batches):
            models, taken = shared.value
            for b in batches:
                ids = b.column(0).to_numpy()
                p = [1 / (1 + np.exp(-m.logit(_unpacked(b.column(1 + k))))) if len(b) else np.zeros(0) for k, m in enumerate(models)]
                free = [~np.isin(ids, list(taken[1 - k])) for k in range(len(models))]
                yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(x) for x in p], *[pa.array(x) for x in free]], ["id", "p0", "p1", "free0", "free1"])

        scored = staged(self.table.mapInArrow(score, "id long, p0 double, p1 double, free0 boolean, free1 boolean"), "pool")
        tops = None
        for (k, label), n in want.items():
            trust = F.col(f"p{k}") if label else 1 - F.col(f"p{k}")
            top = scored.where(F.col(f"free{k}") & (trust >= sure)).select("id", trust.alias("trust"), F.lit(k).alias("view"), F.lit(label).alias("label")).orderBy(F.desc("trust"), "id").limit(n)
            tops = top if tops is None else tops.unionByName(top)
        found = tops.join(self.table, "id").groupBy("id", "view", "label").agg(F.min(F.struct("view0", "view1")).alias("v")).select("id", "view", "label", "v.*").toPandas()
        out = {}
        for k, label in want:
            mine = found[(found["view"] == k) & (found["label"] == label)].sort_values("id")
            mine = mine[~mine["id"].isin(self.taken[1 - k])]
            self.taken[1 - k].update(mine["id"].tolist())
            out[k, label] = _unpacked(mine[f"view{1 - k}"])
        return out


def _unpacked(blobs) -> np.ndarray:
    raw = [x.as_py() if hasattr(x, "as_py") else x for x in blobs]
    return np.frombuffer(b"".join(raw)).reshape(len(raw), -1) if raw else np.zeros((0, 0))


def co_train(labelled: list[np.ndarray], y: np.ndarray, pool, rounds: int = 4, sure: float = 0.95, share: float = 0.1) -> QualityModel:
    """labelled: one matrix a view; pool: the same of unlabelled rows, or a TablePool. Every fifth labelled row is
    kept for calibration. In a round each view hands the other at most `share` of its training rows a label."""
    held = np.arange(len(y)) % 5 == 0
    if len(np.unique(y[~held])) < 2 or len(np.unique(y[held])) < 2:
        return QualityModel([], [], None, 1.0 if not len(y) or y.mean() >= 0.5 else 0.0)
    pool = Pool(pool) if isinstance(pool, list) else pool
    own = [(x[~held], y[~held]) for x in labelled]
    for _ in range(rounds):
        models = [fit_logistic(*t) for t in own]
        want = {(k, label): max(1, int(share * (own[1 - k][1] == label).sum())) for k in (0, 1) for label in (0.0, 1.0)}
        for (k, label), rows in pool.surest(models, sure, want).items():
            if len(rows):
                own[1 - k] = np.concatenate([own[1 - k][0], rows]), np.concatenate([own[1 - k][1], np.full(len(rows), label)])
    models = [fit_logistic(*t) for t in own]
    z = [m.logit(x[held])[:, None] for m, x in zip(models, labelled, strict=True)]
    calibrations = [fit_logistic(a, y[held], 0.1) for a in z]
    both = np.column_stack([c.logit(a) for c, a in zip(calibrations, z, strict=True)])
    return QualityModel(models, calibrations, fit_logistic(both, y[held], 0.1))


def views_of(df: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str, size_col: str, extra: list[str]) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(size_col).cast("long").alias("size"), *extra)


def _matrices(got) -> list[np.ndarray]:
    content = [content_view(t) for t in got["text"]]
    meta = [metadata_view(a, b, None if c is None or c != c else int(c)) for a, b, c in zip(got["lang"], got["source"], got["size"], strict=True)]
    return [np.array(content).reshape(len(got), len(_SETS) + 9), np.array(meta).reshape(len(got), HASHED + 6)]


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = 8_000, chars: int = 50_000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", size_col: str = "n_chars") -> QualityModel:
    """Train on at most `rows` labelled documents of at most `chars` characters (a fifth of all ids, by crc32, stays
    unseen) and on all documents without a label, whole, which stay on the executors: a round brings back as many
    as it labels. Rows that repeat an id count once; a null id or text stays out of the pool."""
    extra = [F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(size_col).cast("long").alias("size")]
    got = training_rows(docs, labels, "quality", rows, chars, id_col, text_col, extra).toPandas().sort_values("id")
    src = views_of(docs, id_col, text_col, lang_col, source_col, size_col, []).where("id IS NOT NULL AND text IS NOT NULL")
    known = labels.select(F.col("doc_id").cast("long").alias("id")).distinct()

    def measure(batches):
        for b in batches:
            views = _matrices(_Rows({n: b.column(k).to_pylist() for k, n in enumerate(("id", "text", "lang", "source", "size"))}))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([x.tobytes() for x in v], pa.binary()) for v in views]], ["id", "view0", "view1"])

    measured = src.mapInArrow(measure, "id long, view0 binary, view1 binary")
    pool = staged(measured.join(known, "id", "left_anti"), "unlabelled")
    return co_train(_matrices(got), got["y"].to_numpy(float), TablePool(pool))


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", size_col: str = "n_chars", carry: list[str] | None = None) -> DataFrame:
    """(id, score, carried columns): probability that a document's quality label is 1, for every row's whole text.

    Null and empty texts are scored as texts without words; null metadata is a value of its own. Ids are whole
    numbers; nulls and repeats pass through, a row each. A carried column with a name of this operator's own comes
    out as name_carried. Without labels of both kinds every score is 1 (0 where all
    labels are 0). An empty table gives no rows; other columns than those named are not read. No shuffle; the
    model is a few hundred numbers.
    """
    m = docs.sparkSession.sparkContext.broadcast(model)
    carried = carry or []
    src = views_of(docs, id_col, text_col, lang_col, source_col, size_col, [F.col(c).alias(f"c{k}") for k, c in enumerate(carried)])

    def run(batches):
        for b in batches:
            got = {n: b.column(k).to_pylist() for k, n in enumerate(("id", "text", "lang", "source", "size"))}
            scores = m.value.score(_matrices(_Rows(got)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), *b.columns[5:]], ["id", "score", *b.schema.names[5:]])

    more = "".join(f", c{k} {src.schema[f'c{k}'].dataType.simpleString()}" for k in range(len(carried)))
    out = src.mapInArrow(run, f"id long, score double{more}")
    return out.select(F.col("id").alias(id_col), "score", *[F.col(f"c{k}").alias(c) for k, c in enumerate(carried_names(carried, (id_col, "score")))])


class _Rows(dict):
    """Columns by name; its length is the number of rows."""

    def __len__(self) -> int:
        return len(self["id"])
