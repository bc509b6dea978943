"""Toxicity by multiple-instance learning: labelled documents teach a scorer of sentences.

A document is a bag of sentences. A sentence's probability is a logistic function of its words' weights; the
document's is the noisy-or of its sentences, 1 - prod(1 - p). Training maximises the likelihood of document
labels by gradient steps through the noisy-or; sentences then carry their own probabilities, so the
offending ones can be pointed at. Features are a word and its beginnings, lower case; only those that lean to
toxic documents beyond chance get a weight, so a long clean text stays clean.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import Memo, staged

#: Words whose weight a worker keeps; words whose features a task keeps while it counts or marks; features that it
#: counts before it gives them back. They bound memory, never results.
MEMO, FEATURE_MEMO, COUNTED = 200_000, 30_000, 100_000
SENTENCE = re.compile(r"[^.!?\n]+[.!?\n]*|[.!?\n]+")
EDGES = " \t\r\n.,;:!?\"'()[]{}|#$%&*-_/\\<>«»“”„’…"
#: Log-odds of a sentence without any weighted word.
BIAS = -12.0


#: Kinds of features: the whole word, marked by $, and its first letters.
KINDS = (0, 3, 4, 5, 6)


def bare(word: str) -> str:
    return word.lower().strip(EDGES)


def feature(word: str, kind: int) -> str | None:
    """A bare word's feature of a kind, if it is long enough for it."""
    if not kind:
        return word + "$" if word else None
    return word[:kind] if len(word) >= kind else None


class WordWeights(dict):
    """Weight of each word as it stands in a text, worked out when first asked for."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights
        self.heads = {f.rstrip("$")[:3] for f in weights}

    def __missing__(self, word: str) -> float:
        w = bare(word)
        out = 0.0
        if w[:3] in self.heads:
            out = sum(self.weights.get(f, 0.0) for k in KINDS if (f := feature(w, k)) is not None)
        if len(self) >= MEMO:
            self.clear()
        self[word] = out
        return out


@dataclass
class ToxicityModel:
    weights: dict[str, float]

    def __post_init__(self):
        self.words = WordWeights(self.weights)

    def sentences(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, log-odds) of every sentence."""
        return [(m.start(), m.end(), BIAS + sum(map(self.words.__getitem__, m.group().split()))) for m in SENTENCE.finditer(text)]

    def score(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """(document probability, offending sentences as (start, end, probability)); null is empty."""
        text = text or ""
        if not any(map(self.words.__getitem__, text.split())):
            return -math.expm1(-len(SENTENCE.findall(text)) * math.log1p(math.exp(BIAS))), []
        each = self.sentences(text)
        miss = math.fsum(_softplus(z) for _, _, z in each)
        return -math.expm1(-miss), [(a, b, 1 / (1 + math.exp(-z))) for a, b, z in each if z >= 0]


def _softplus(z: float) -> float:
    return max(z, 0.0) + math.log1p(math.exp(-abs(z)))


def leaning(df1: np.ndarray, df0: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Signed log-likelihood ratio of a feature's document counts against independence of the label."""
    n, d = n1 + n0, df1 + df0

    def part(o, e):
        return np.where(o > 0, o * np.log(np.maximum(o, 1e-12) / np.maximum(e, 1e-12)), 0.0)

    g = 2 * (part(df1, d * n1 / n) + part(df0, d * n0 / n) + part(n1 - df1, (n - d) * n1 / n) + part(n0 - df0, (n - d) * n0 / n))
    return np.where(df1 * n0 > df0 * n1, g, -g)


def word_features(word: str) -> tuple[tuple[int, str], ...]:
    """(kind, name) of every feature of a word as it stands in a text."""
    w = bare(word)
    return tuple((k, f) for k in KINDS if (f := feature(w, k)) is not None)


class FeatureCounts:
    """Documents of each label that hold a feature."""

    def __init__(self):
        self.of_word = Memo(word_features, FEATURE_MEMO)
        self.counts: dict[tuple[int, str], list[int]] = {}

    def add(self, text: str, label: int) -> None:
        for f in {f for w in set(text.split()) for f in self.of_word[w]}:
            self.counts.setdefault(f, [0, 0])[label] += 1

    def batch(self) -> pa.RecordBatch:
        """The counts so far, which are then forgotten."""
        keys, counts = list(self.counts), list(self.counts.values())
        self.counts = {}
        return pa.RecordBatch.from_pydict({"kind": pa.array([k for k, _ in keys], pa.int32()), "name": pa.array([f for _, f in keys], pa.string()), "df1": pa.array([c[1] for c in counts], pa.int64()), "df0": pa.array([c[0] for c in counts], pa.int64())})


def marked(text: str, of_word: dict[str, list[int]]) -> tuple[int, list[int], list[int]]:
    """(sentences, numbers of chosen features in each sentence that has any, those features)."""
    sizes, feats, n = [], [], 0
    for m in SENTENCE.finditer(text):
        n += 1
        here = [f for w in dict.fromkeys(m.group().split()) for f in of_word[w]]
        if here:
            sizes.append(len(here))
            feats.extend(here)
    return n, sizes, feats


def numbers_of(chosen: list[tuple[int, str]]) -> Memo:
    """Chosen features of each word, as places in the list."""
    place = {f: k for k, f in enumerate(chosen)}
    return Memo(lambda w: [place[f] for f in word_features(w) if f in place], FEATURE_MEMO)


def train(texts: list[str], labels: list[int], least: float = 24.0, most: int = 20_000, steps: int = 300) -> ToxicityModel:
    """Fit on documents; features need a log-likelihood ratio of `least`. One class alone gives no weights."""
    n1 = sum(labels)
    n0 = len(labels) - n1
    if not n1 or not n0:
        return ToxicityModel({})
    counted = FeatureCounts()
    for t, y in zip(texts, labels, strict=True):
        counted.add(t, y)
    keys, counts = list(counted.counts), np.array(list(counted.counts.values())).reshape(-1, 2)
    g = leaning(counts[:, 1], counts[:, 0], n1, n0)
    best = sorted((-float(g[c]), keys[c][1], keys[c][0]) for c in np.flatnonzero((g >= least) & (counts[:, 1] >= 5)))[:most]
    chosen = [(kind, name) for _, name, kind in best]
    of_word = numbers_of(chosen)
    return fit_weights([name for _, name in chosen], np.array(labels), *zip(*[marked(t, of_word) for t in texts], strict=True), steps)


def fit_weights(names: list[str], labels: np.ndarray, per_doc, sizes, feats, steps: int = 300) -> ToxicityModel:
    """Weights of features, from what marked() gives for each document."""
    if not names:
        return ToxicityModel({})
    in_doc = [len(x) for x in sizes]
    doc = np.repeat(np.arange(len(in_doc)), in_doc)
    size, feat = (np.concatenate([np.asarray(x, np.int64) for x in many]) for many in (sizes, feats))
    total = len(size)
    sent = np.repeat(np.arange(total), size)
    y, plain = labels.astype(float), np.array(per_doc) - np.array(in_doc)  # sentences without any chosen feature
    w = np.full(len(names), 1.0)
    speed, scale = np.zeros(len(w)), np.zeros(len(w))
    floor = plain * math.log1p(math.exp(BIAS)) + 1e-9
    for step in range(1, steps + 1):
        z = BIAS + np.bincount(sent, w[feat], total)
        p = 1 / (1 + np.exp(-z))
        miss = np.bincount(doc, np.logaddexp(0, z), len(y)) + floor
        pull = np.where(y > 0, -np.exp(-miss) / -np.expm1(-miss), 1.0)
        grad = np.bincount(feat, (p * pull[doc])[sent], len(w)) / len(y) + 1e-5 * w
        speed, scale = 0.9 * speed + 0.1 * grad, 0.999 * scale + 0.001 * grad**2
        w = np.clip(w - 0.2 * (speed / (1 - 0.9**step)) / (np.sqrt(scale / (1 - 0.999**step)) + 1e-8), 0.0, 30.0)
    return ToxicityModel({name: float(x) for name, x in zip(names, w, strict=True) if x > 1e-3})


def training_rows(docs: DataFrame, labels: DataFrame, column: str, rows: int, chars: int, id_col: str, text_col: str, extra: list[str] | None = None) -> DataFrame:
    """At most `rows` labelled documents (id, text, y, extra) of at most `chars` characters, by hash of the id.

    Only ids whose crc32 (of their decimal text) leaves a remainder by 5 are taken; the rest stay unseen. Of rows
    that repeat an id the one of smallest text (then smallest extra columns) counts. Ids are whole numbers.
    """
    ids = labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1) & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0))
    ids = ids.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(column).cast("int").alias("y")).orderBy(F.xxhash64("id"), "id").limit(rows)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), *(extra or []))
    src = src.where(F.col("text").isNotNull() & (F.length("text") <= chars))
    joined = src.join(F.broadcast(ids), "id")  # the limit bounds the broadcast
    return joined.groupBy("id").agg(F.min(F.struct("text", *[c for c in src.columns if c not in ("id", "text")], "y")).alias("r")).select("id", "r.*")


def carried_names(carry: list[str], own: tuple[str, ...]) -> list[str]:
    """Names under which carried columns come out: one that clashes with an operator's own gets _carried."""
    return [f"{c}_carried" if c in own else c for c in carry]


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = 8_000, chars: int = 50_000, id_col: str = "doc_id", text_col: str = "text", least: float = 24.0, most: int = 20_000) -> ToxicityModel:
    """train() on a bounded sample: at most `rows` documents of at most `chars` characters.

    Executors count features and mark sentences; the driver holds at most `most` features and the numbers of the
    sentences that have one, no texts.
    """
    src = staged(training_rows(docs, labels, "toxic", rows, chars, id_col, text_col).select("id", "text", "y"), "toxicity")
    n = {r["y"]: r["count"] for r in src.groupBy("y").count().collect()}
    if len(n) < 2:
        return ToxicityModel({})

    def count(batches):
        counted = FeatureCounts()
        for b in batches:
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                counted.add(t, y)
                if len(counted.counts) >= COUNTED:
                    yield counted.batch()
        yield counted.batch()

    def lean(batches):
        for pdf in batches:
            yield pdf.assign(g=leaning(pdf["df1"].to_numpy(), pdf["df0"].to_numpy(), n[1], n[0]))[["kind", "name", "g"]]

    counts = src.select("text", "y").mapInArrow(count, "kind int, name string, df1 long, df0 long")
    counts = counts.groupBy("kind", "name").agg(F.sum("df1").alias("df1"), F.sum("df0").alias("df0")).where("df1 >= 5")
    best = counts.mapInPandas(lean, "kind int, name string, g double").where(F.col("g") >= least).orderBy(F.desc("g"), "name", "kind").limit(most)
    chosen = [(r["kind"], r["name"]) for r in best.collect()]
    if not chosen:
        return ToxicityModel({})
    shared = docs.sparkSession.sparkContext.broadcast(chosen)

    def mark(batches):
        of_word = numbers_of(shared.value)
        for b in batches:
            got = [marked(t, of_word) for t in b.column(1).to_pylist()]
            numbers = [pa.array([np.array(x[k], np.int32).tobytes() for x in got], pa.binary()) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([x[0] for x in got], pa.int32()), *numbers], ["id", "y", "sentences", "sizes", "feats"])

    got = src.mapInArrow(mark, "id long, y int, sentences int, sizes binary, feats binary").toPandas().sort_values("id")
    sizes, feats = ([np.frombuffer(x, np.int32) for x in got[c]] for c in ("sizes", "feats"))
    return fit_weights([name for _, name in chosen], got["y"].to_numpy(), got["sentences"].to_numpy(), sizes, feats)


_kept: list[tuple[dict, ToxicityModel]] = []


def toxicity_model(weights: dict[str, float]) -> ToxicityModel:
    """The worker's model; tasks of one worker share its memo."""
    if not _kept or _kept[0][0] != weights:
        _kept[:] = [(weights, ToxicityModel(weights))]
    return _kept[0][1]


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """(id, score, offending array of (start, end, score), carried columns): every row's whole text.

    Null and empty texts have no sentence and score 0. Nulls and repeats in the id pass through, a row each.
    Without labels of both kinds there are no weights and scores are near 0. An empty table gives no rows.
    Columns other than `carry` are not read; a carried column with a name of this operator's own comes out as
    name_carried. No shuffle; the weights' number is bounded by `most` in train().
    """
    weights = docs.sparkSession.sparkContext.broadcast(model.weights)
    carried = carry or []
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *[F.col(c).alias(f"c{k}") for k, c in enumerate(carried)])
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches):
        m = toxicity_model(weights.value)
        for b in batches:
            got = [m.score(t) for t in b.column(1).to_pylist()]
            bad = [[{"start": x, "end": y, "score": p} for x, y, p in s] for _, s in got]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s for s, _ in got], pa.float64()), pa.array(bad, spans), *b.columns[2:]], ["id", "score", "offending", *b.schema.names[2:]])

    kind = [f"{f.name} {f.dataType.simpleString()}" for f in src.schema.fields]
    out = src.mapInArrow(run, ", ".join([kind[0], "score double, offending array<struct<start:int,end:int,score:double>>", *kind[2:]]))
    return out.select(F.col("id").alias(id_col), "score", "offending", *[F.col(f"c{k}").alias(c) for k, c in enumerate(carried_names(carried, (id_col, "score", "offending")))])
