import math
import random
import zlib

import numpy as np

from quillstone.llm import quality, queries, toxicity
from tests.llm.helpers import AWKWARD, documents

VOCABULARY = [f"word{k}" for k in range(300)]


def corpus(seed, n, bad_words=("vilest", "scumbag", "vilely")):
    rng = random.Random(seed)
    texts, labels = [], []
    for _ in range(n):
        sentences = [" ".join(rng.choice(VOCABULARY) for _ in range(8)) + "." for _ in range(rng.randint(1, 20))]
        toxic = rng.random() < 0.2
        if toxic:
            k = rng.randrange(len(sentences))
            sentences[k] = sentences[k].replace(" ", f" {rng.choice(bad_words)} ", 1)
        texts.append(" ".join(sentences))
        labels.append(int(toxic))
    return texts, labels


def test_sentences_are_found_from_document_labels():
    model = toxicity.train(*corpus(1, 800))
    texts, labels = corpus(2, 300)
    right = 0
    for t, y in zip(texts, labels, strict=True):
        score, spans = model.score(t)
        right += (score >= 0.5) == bool(y)
        for a, b, p in spans:
            assert p >= 0.5 and any(w in t[a:b] for w in ("vilest", "scumbag", "vilely"))
    assert right >= 0.98 * len(texts)


def test_score_is_the_noisy_or():
    model = toxicity.train(*corpus(1, 400))
    text = "word1 vilest word2. word3! scumbag word4\nword5"
    z = [s for _, _, s in model.sentences(text)]
    assert math.isclose(model.score(text)[0], 1 - math.prod(1 - 1 / (1 + math.exp(-x)) for x in z), rel_tol=1e-9)
    assert model.score("")[0] == model.score(None)[0] == 0.0
    assert model.score("word1 word2. " * 50_000)[0] < 0.5  # length alone never makes a text toxic


def test_toxicity_without_labels():
    assert toxicity.train([], []).weights == {}
    assert toxicity.train(["a"], [1]).weights == {}


def test_toxicity_operator(spark):
    texts, y = corpus(3, 500)
    docs = documents(spark, [*enumerate(texts), *((1000 + k, t) for k, t in enumerate(AWKWARD)), (None, "vilest"), (1, texts[1])])
    labels = spark.createDataFrame([(k, v, None) for k, v in enumerate(y)] + [(None, 1, 1), (3, None, 0)], "doc_id long, toxic int, quality int")
    out = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels), carry=["lang", "score"])
    rows = out.collect()
    assert len(rows) == docs.count() and out.columns == ["doc_id", "score", "offending", "lang", "score_carried"]
    assert toxicity.score_toxicity(docs.limit(0), toxicity.ToxicityModel({})).count() == 0
    assert toxicity.fit_toxicity(docs.limit(0), labels).weights == {}


def test_every_labelled_row_up_to_the_bound_is_learnt_from(spark):
    rng = random.Random(6)
    y = [int(rng.random() < 0.2) for _ in range(9_000)]
    texts = [f"{rng.choice(VOCABULARY)} {rng.choice(VOCABULARY)}. {'Vilest' if v else rng.choice(VOCABULARY)} {rng.choice(VOCABULARY)}, vile." for v in y]
    seen = [k for k in range(len(y)) if zlib.crc32(str(k).encode()) % 5]
    assert 6_000 < len(seen) <= 8_000
    labels = spark.createDataFrame(list(enumerate(y)), "doc_id long, toxic int")
    got = toxicity.fit_toxicity(documents(spark, list(enumerate(texts))), labels).weights
    want = toxicity.train([texts[k] for k in seen], [y[k] for k in seen]).weights
    assert got and got == want


def test_held_out_labels_are_not_read(spark):
    texts, y = corpus(4, 300)
    docs = documents(spark, list(enumerate(texts)))
    true = spark.createDataFrame(list(enumerate(y)), "doc_id long, toxic int")
    turned = spark.createDataFrame([(k, 1 - v if zlib.crc32(str(k).encode()) % 5 == 0 else v) for k, v in enumerate(y)], "doc_id long, toxic int")
    assert toxicity.fit_toxicity(docs, true).weights == toxicity.fit_toxicity(docs, turned).weights


def test_repeated_ids_train_on_their_least_text(spark):
    texts, y = corpus(5, 300)
    labels = spark.createDataFrame(list(enumerate(y)), "doc_id long, toxic int")
    want = toxicity.fit_toxicity(documents(spark, list(enumerate(texts))), labels).weights
    twice = [*enumerate(texts), *((k, "~ later " + t) for k, t in enumerate(texts))]
    random.Random(1).shuffle(twice)
    assert want and toxicity.fit_toxicity(documents(spark, twice).repartition(7), labels).weights == want


def test_toxicity_query_is_the_noisy_or_of_its_weights(spark):
    """Every score of the query worked out plainly from the fitted weights."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    weights = toxicity.fit_toxicity(docs, labels).weights
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert weights
    for r in queries.op3_toxicity(spark, sf).collect():
        stay = 1.0
        for sentence in toxicity.SENTENCE.findall(texts[r.doc_id]):
            words = [w.lower().strip(toxicity.EDGES) for w in sentence.split()]
            names = [n for w in words for n in ([w + "$"] if w else []) + [w[:k] for k in (3, 4, 5, 6) if len(w) >= k]]
            stay *= 1 - 1 / (1 + math.exp(-max(-700.0, min(700.0, toxicity.BIAS + sum(weights.get(n, 0.0) for n in names)))))
        assert math.isclose(r.score, 1 - stay, rel_tol=1e-6, abs_tol=1e-9) and r.predicted == (r.score >= 0.5)


def test_toxicity_query_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    right = clean = false = n = 0
    for r in queries.op3_toxicity(spark, sf).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        if r.held_out and r.doc_id in labels:
            n += 1
            right += r.predicted == labels[r.doc_id]
            clean += labels[r.doc_id] == 0
            false += r.predicted == 1 and labels[r.doc_id] == 0
    assert right >= 0.96 * n and false <= 0.01 * clean


# --- quality


def test_logistic_recovers_a_line():
    rng = np.random.RandomState(0)
    x = rng.standard_normal((4000, 2))
    y = (rng.random_sample(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] + 0.5)))).astype(float)
    m = quality.fit_logistic(x, y)
    w = m.weights[1:] / m.scale
    assert np.allclose(w, [2, -1], atol=0.2) and abs(m.logit(np.zeros((1, 2)))[0] - 0.5) < 0.2


def test_co_training_uses_the_pool():
    """Two views, few labels, many free rows: the exchange must not hurt and the views must agree with truth."""
    rng = np.random.RandomState(1)
    y = rng.randint(0, 2, 3000)
    a, b = (y[:, None] * 1.5 + rng.standard_normal((3000, 6)) for _ in range(2))
    model = quality.co_train([a[:60], b[:60]], y[:60].astype(float), [a[60:2000], b[60:2000]])
    alone = quality.co_train([a[:60], b[:60]], y[:60].astype(float), [a[:0], b[:0]])
    truth = y[2000:] == 1
    got, base = (((m.score([a[2000:], b[2000:]]) >= 0.5) == truth).mean() for m in (model, alone))
    assert got > 0.95 and got >= base - 0.005


def test_a_table_pool_is_the_pool(spark):
    rng = np.random.RandomState(2)
    y = rng.randint(0, 2, 900)
    views = [y[:, None] * 1.5 + rng.standard_normal((900, 5)) for _ in range(2)]
    rows = [(k, views[0][k].tobytes(), views[1][k].tobytes()) for k in range(80, 900)]
    table = spark.createDataFrame(rows, "id long, view0 binary, view1 binary").repartition(6)
    first = [v[:80] for v in views]
    mine = quality.co_train(first, y[:80].astype(float), quality.TablePool(table))
    want = quality.co_train(first, y[:80].astype(float), [v[80:] for v in views])
    alone = quality.co_train(first, y[:80].astype(float), [v[:0] for v in views])
    assert np.allclose(mine.score(views), want.score(views), atol=1e-6) and not np.allclose(mine.score(views), alone.score(views), atol=1e-6)


def test_quality_query_is_its_views_and_weights(spark):
    """Every score of the query worked out plainly from the fitted numbers."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit_quality(docs, labels)
    rows = {r.doc_id: r for r in docs.collect()}

    def line(m, x):
        return sum(((a - b) / c) * w for a, b, c, w in zip(x, m.mean, m.scale, m.weights[1:], strict=True)) + m.weights[0]

    def clipped(z):
        return max(-30.0, min(30.0, z))

    for r in queries.op10_quality(spark, sf).collect():
        d = rows[r.doc_id]
        seen = [quality.content_view(d.text), quality.metadata_view(d.lang, d.source, d.n_chars)]
        z = [clipped(line(c, [clipped(line(v, x))])) for v, c, x in zip(model.views, model.calibrations, seen, strict=True)]
        assert math.isclose(r.score, 1 / (1 + math.exp(-clipped(line(model.mix, z)))), rel_tol=1e-6)


def test_quality_without_labels():
    none = quality.co_train([np.zeros((0, 2))] * 2, np.zeros(0), [np.zeros((0, 2))] * 2)
    assert none.score([np.zeros((3, 2))] * 2).tolist() == [1, 1, 1]


def test_quality_operator(spark):
    rng = random.Random(5)
    good = [" ".join(rng.choice(VOCABULARY) for _ in range(30)) + "." for _ in range(200)]
    bad = [" ".join(rng.choice(VOCABULARY).upper() + "!!" for _ in range(30)) for _ in range(100)]
    rows = [*enumerate(good + bad), *((1000 + k, t) for k, t in enumerate(AWKWARD)), (None, "x"), (2, good[2])]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(k, int(k < 200)) for k in range(0, 300, 2)] + [(None, 1), (1, None)], "doc_id long, quality int")
    out = {r.doc_id: r.score for r in quality.score_quality(docs, quality.fit_quality(docs, labels)).collect()}
    assert all(out[k] >= 0.5 for k in range(200)) and all(out[k] < 0.5 for k in range(200, 300))
    assert all(0 <= s <= 1 for s in out.values())
    empty = quality.fit_quality(docs.limit(0), labels)
    assert quality.score_quality(docs.limit(0), empty).count() == 0


def test_quality_query_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    right = n = 0
    for r in queries.op10_quality(spark, sf).collect():
        if r.doc_id in labels and zlib.crc32(str(r.doc_id).encode()) % 5 == 0:
            n += 1
            right += r.kept == bool(labels[r.doc_id])
    assert right >= 0.97 * n
