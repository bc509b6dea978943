import random
import re

import numpy as np
import pyarrow as pa

from quillstone.llm import darts, queries, substrings, wordhash
from quillstone.llm.common import U64, mix64
from quillstone.llm.wordhash import run_hashes, run_rows, word_hashes
from tests.llm.helpers import AWKWARD, LONG, documents
from tests.oracle import compare, connect

WORD = re.compile("[^\x20\x09-\x0d]+")


def words(t):
    return WORD.findall(t or "")


def test_word_hashes_see_words_as_the_pattern_does():
    texts = [*AWKWARD, "a\x0bb\x0cc\rd", "\x1ca b\x85c d", "x", "end "]
    found = [(row, n, h) for row, n, h in word_hashes(pa.array(texts))]
    counts = np.concatenate([n for _, n, _ in found])
    assert counts.tolist() == [len(words(t)) for t in texts]
    hashes = np.concatenate([h for _, _, h in found])
    by_word = {}
    for w, h in zip([w for t in texts for w in words(t)], hashes.tolist(), strict=True):
        assert by_word.setdefault(w, tuple(h)) == tuple(h)
    assert len(set(by_word.values())) == len(by_word)


def test_runs_stay_in_their_rows():
    per_row = np.array([3, 0, 1, 5])
    row, place = run_rows(per_row, 3)
    assert row.tolist() == [0, 3, 3, 3] and place.tolist() == [0, 0, 1, 2]
    assert len(run_hashes(np.zeros((2, 2), U64), 3)) == 0


def brute_cut(rows, n):
    first = {}
    for i, t in rows:
        if i is not None:
            w = words(t)
            for k in range(len(w) - n + 1):
                key = tuple(w[k : k + n])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = {k + j for k in range(len(w) - n + 1) if i is not None and first[tuple(w[k : k + n])] < i for j in range(n)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


def cut(df, n, **kw):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in substrings.remove_repeats(df, n=n, **kw).collect()), key=repr)


def test_repeats_against_brute_force(spark, monkeypatch):
    rng = random.Random(7)
    passage = [f"p{k}" for k in range(30)]
    rows = []
    for i in range(120):
        w = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 30))]
        if i % 3 == 0:
            w[len(w) // 2 : len(w) // 2] = passage[rng.randint(0, 10) :]
        rows.append((i * 7 % 120, " ".join(w)))
    rows += [(200 + k, rows[5][1]) for k in range(20)] + [(3, rows[3][1]), (None, " ".join(passage)), *((300 + k, t) for k, t in enumerate(AWKWARD[:-1]))]
    rows = [*rows, (400, LONG[:3000]), (401, LONG[:3000])]
    for n in (3, 13):
        for bits in (12, 28):  # a crowded table sends more windows to the exact step and changes nothing
            assert cut(documents(spark, rows).repartition(5), n, width_bits=bits) == brute_cut(rows, n)


def thue_morse(k):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(1 << k))


def test_long_words_that_cheap_hashes_confuse(spark):
    """Sums of letters times powers modulo 2^64 can't tell these two words apart."""
    word = thue_morse(11)
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, " ".join([*map(str, range(6)), word, *map(str, range(6, 12))])), (2, " ".join([*map(str, range(6)), other, *map(str, range(6, 12))]))]
    assert cut(documents(spark, rows), 13) == brute_cut(rows, 13)
    short = [(1, f"a b c d {word}"), (2, f"a b c d {other}"), (3, f"a b c d {word}")]
    assert {r.doc_id: r.component_id for r in darts.near_duplicates(documents(spark, short)).collect()} == {1: 1, 2: 2, 3: 1}


def test_words_across_slices(monkeypatch):
    monkeypatch.setattr(wordhash, "SLICE_BYTES", 7)
    texts = [*AWKWARD, "a" * 30 + " b", "  x  ", " y" * 40]
    got = list(word_hashes(pa.array(texts)))
    assert np.concatenate([n for _, n, _ in got]).tolist() == [len(words(t)) for t in texts]
    lanes = np.concatenate([h for _, _, h in got])
    monkeypatch.undo()
    assert (lanes == np.concatenate([h for _, _, h in word_hashes(pa.array(texts))])).all()


def test_repeats_that_only_other_blocks_show(spark):
    """No block settles a window by itself: two partitions, or a document that repeats its own passage."""
    text = " ".join(f"w{k}" for k in range(20))
    for rows, parts in (([(1, text), (2, text)], 2), ([(1, f"{text} {text}")], 1), ([(5, text), (4, "x"), (3, "")], 3)):
        df = documents(spark, rows).repartitionByRange(parts, "doc_id")
        assert cut(df, 13) == brute_cut(rows, 13)


def test_repeats_in_small_blocks(spark):
    rows = [(k, " ".join(f"w{(k * 13 + j) % 50}" for j in range(40))) for k in range(60)]
    assert cut(documents(spark, rows).repartition(9), 5) == brute_cut(rows, 5)
    assert cut(documents(spark, []), 13) == []


def test_repeats_query(spark, sf, tmp_path):
    compare(queries.op7_substring_dedup(spark, sf), connect(sf, tmp_path), queries.ORACLE_SQL["op7_substring_dedup"])


# --- near duplicates


def shingles(t, n=5):
    w = words(t)
    out = {}
    for k in range(max(len(w) - n + 1, 1 if w else 0)):
        key = tuple(w[k : k + n])
        out[key] = out.get(key, 0) + 1
    return out


def weighted(a, b):
    keys = a.keys() | b.keys()
    top = sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)
    return sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / top if top else 0.0


def brute_groups(rows, threshold=0.8):
    sets = [(i, shingles(t)) for i, t in rows]
    up = {i: i for i, _ in rows if i is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and a and b and min(len(a), len(b)) and weighted(a, b) >= threshold:
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return {i: root(i) for i in up}


def families(seed, many=60):
    rng = random.Random(seed)
    vocabulary = [f"v{k}" for k in range(400)]
    rows = []
    for _ in range(many):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 40, 150]))]
        rows.append(" ".join(base))
        for _ in range(rng.randint(0, 5)):
            other = list(base)
            for _ in range(rng.choice([0, 1, 2, 3])):
                other[rng.randrange(len(other))] = rng.choice(vocabulary)
            rows.append(" ".join(other))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_near_duplicates_against_brute_force(spark):
    rows = [*families(11), *((1000 + k, t) for k, t in enumerate(AWKWARD)), (2000, LONG + " extra"), (2001, "x y z " * 40), (2002, "x y z " * 41)]
    got = {r.doc_id: r.component_id for r in darts.near_duplicates(documents(spark, rows).repartition(6)).collect()}
    assert got == brute_groups(rows)


def test_near_duplicates_large_group(spark):
    """Hundreds of near copies and copies, which share buckets with documents of other similarity."""
    rng = random.Random(2)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for k in range(250):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 6, 12])):
            w[rng.randrange(120)] = f"r{k}"
        rows.append((k, " ".join(w)))
    assert {r.doc_id: r.component_id for r in darts.near_duplicates(documents(spark, rows)).collect()} == brute_groups(rows)


def test_linked_sets_against_brute_force(monkeypatch):
    monkeypatch.setattr(darts, "COLUMNS", 7)
    rng = np.random.RandomState(3)
    sets = [np.sort(rng.choice(60, rng.randint(0, 40), replace=False)).astype(U64) for _ in range(40)]
    left, right = np.arange(0, 25), np.arange(10, 40)
    i, j = darts.linked(sets, left, right, 0.5)
    want = {(int(a), int(b)) for a in left for b in right if len(sets[a]) and len(set(sets[a]) & set(sets[b])) >= 0.5 * len(set(sets[a]) | set(sets[b]))}
    assert {(int(left[a]), int(right[b])) for a, b in zip(i, j, strict=True)} == want


def test_near_duplicates_in_small_tiles(spark, monkeypatch):
    """Buckets of several components, cut into many tiles; links stand between blocks, components and tiles."""
    monkeypatch.setattr(darts, "BLOCK", 6)
    rng = random.Random(5)
    base = [f"b{k}" for k in range(100)]
    rows = []
    for k in range(90):
        w = list(base)
        for _ in range(rng.choice([1, 2, 2, 3])):
            w[rng.randrange(100)] = f"r{k % 40}"
        rows.append((k * 37 % 90, " ".join(w)))
    assert {r.doc_id: r.component_id for r in darts.near_duplicates(documents(spark, rows)).collect()} == brute_groups(rows)


def test_near_duplicates_rows(spark):
    rows = [(5, "one two three four five six"), (5, "one two three four five six"), (4, "one two three four five six"), (None, "one two three four five six"), (8, ""), (9, ""), (10, None)]
    out = darts.near_duplicates(documents(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in out) == [(0, 0, True), (4, 4, True), (5, 4, False), (5, 4, False), (8, 8, True), (9, 9, True), (10, 10, True)]
    assert darts.near_duplicates(documents(spark, [])).count() == 0


def test_near_duplicates_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert {r.doc_id: r.component_id for r in queries.op9_near_dups(spark, sf).collect()} == brute_groups(docs)


def test_signatures_estimate_weighted_similarity():
    a = {f"s{k}": 1 + k % 3 for k in range(300)}
    b = {f"s{k}": 1 + (k + k // 200) % 3 for k in range(60, 330)}

    def strips(x):
        return np.sort(np.array([hash((k, c)) & (2**63 - 1) for k, n in x.items() for c in range(n)], U64))

    ea, eb = strips(a), strips(b)
    row = np.concatenate([np.zeros(len(ea), int), np.ones(len(eb), int)])
    sig = darts.signatures(2, row, np.concatenate([ea, eb]), 4000)
    share = (sig[0] == sig[1]).mean()
    assert abs(share - weighted(a, b)) < 0.04


def test_lazy_cells_do_not_change_the_signature():
    """Opening more cells than needed gives the same least ranks."""
    e = mix64(np.arange(1, 40, dtype=U64))
    out = np.full((1, 64), np.iinfo(U64).max, U64)
    zero = np.zeros(len(e), np.int64)
    darts._throw(out, zero, e, zero, zero + 200)
    assert (out == darts.signatures(1, zero, e, 64)).all()
