import hashlib
import random
import struct

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from quillstone.llm import automaton, packing, queries, unigram
from tests.llm.helpers import AWKWARD, documents


@pytest.fixture(scope="module")
def words():
    return automaton.WordBpe(queries.tokenizer_json(queries.WORD_BPE)), Tokenizer.from_file(P.path(queries.WORD_BPE))


def texts(seed, n, letters):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(n)]


LETTERS = [*"abc thé\n\t '$日👩\x1c\x85\xa0ΣςİN12½", " the", "ing", "anan", "'ll", "<|endoftext|>", "rrr", "lll"]


def test_bpe_equals_library(words):
    mine, lib = words
    for t in [*texts(1, 3000, LETTERS), *[a or "" for a in AWKWARD]]:
        ids, decoded, n = mine.encode(t)
        e = lib.encode(t, add_special_tokens=False).ids
        assert ids == " ".join(map(str, e))
        assert decoded == lib.decode(e, skip_special_tokens=False)
        assert n == len(e)


def test_every_label_spells_its_own_path(words):
    """The merge gadgets against plain merging, for words made of repeated letters where order matters."""
    mine, lib = words
    for k in range(1, 30):
        for unit in ("a", "an", "r", "l", "ha", "the"):
            w = unit * k
            assert mine.ids(w) == lib.encode(w, add_special_tokens=False).ids


def merged(word, merges):
    """Plain merging: the earliest merge that fits, leftmost first, again and again."""
    parts = list(word)
    while True:
        found = [(merges.index((a, b)), k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if (a, b) in merges]
        if not found:
            return parts
        k = min(found)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_automaton_against_plain_merging():
    rng = random.Random(12)
    for _ in range(60):
        labels, merges = ["a", "b", "c"], []
        for _ in range(rng.randint(1, 14)):
            pair = (rng.choice(labels), rng.choice(labels))
            if "".join(pair) not in labels:
                merges.append(pair)
                labels.append("".join(pair))
        auto = automaton.MergeAutomaton({t: k for k, t in enumerate(labels)}, merges)
        for _ in range(120):
            word = "".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))
            assert auto.decode(auto.encode(word)) == merged(word, merges), (merges, word)


def test_every_letter_is_split_as_the_library_splits_it(words):
    """All code points of the planes that hold letters, between two letters."""
    mine, lib = words
    some = ["a%sb" % chr(c) for c in [*range(0xD800), *range(0xE000, 0x20000), *range(0x2F800, 0x2FA20), *range(0xE0000, 0xE0200)]]
    for k in range(0, len(some), 5000):
        for t, e in zip(some[k : k + 5000], lib.encode_batch(some[k : k + 5000], add_special_tokens=False), strict=True):
            assert mine.ids(t) == e.ids, repr(t)


def test_bpe_operator(spark):
    df = documents(spark, [*enumerate(AWKWARD), (None, "null id"), (3, "one")])
    out = automaton.bpe_encode(df, queries.tokenizer_json(queries.WORD_BPE))
    got = out.collect()
    assert len(got) == len(AWKWARD) + 2
    assert {r.n_tokens for r in got if r.doc_id in (0, 1, 2)} == {0}
    assert [r.n_tokens > 0 for r in got if r.doc_id is None] == [True]
    assert automaton.bpe_encode(df.limit(0), queries.tokenizer_json(queries.WORD_BPE)).count() == 0


def test_bpe_query_digests(spark, sf):
    lib = Tokenizer.from_file(P.path(queries.WORD_BPE))
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op2_bpe(spark, sf).collect():
        e = lib.encode(docs[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(e)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, e)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(e, skip_special_tokens=False).encode()).hexdigest()


def test_unigram_counts_equal_library(spark, sf):
    path = P.path(queries.PIECES)
    lib = sentencepiece.SentencePieceProcessor(model_proto=unigram.read_model(path).SerializeToString())
    counter = unigram.PieceCounter(*unigram.read_pieces(path))
    for t in texts(2, 2000, [*"abcthe \n$é日 ▁👩", " the", "  "]):
        assert counter.count(t) == len(lib.encode(t)), t
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op5_token_counts(spark, sf).collect():
        assert r.n_tokens == len(lib.encode(docs[r.doc_id] or ""))


def test_unigram_ties_and_rows(spark):
    counter = unigram.PieceCounter([("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -2.0)], -20.0)
    assert counter.viterbi("▁ab") == 2  # equal scores: the path offered first, with the longer last piece
    assert counter.viterbi("é") == 2  # an unknown letter counts its bytes
    df = documents(spark, [*enumerate(AWKWARD), (None, "x"), (3, "one")])
    pieces, unknown = unigram.read_pieces(P.path(queries.PIECES))
    got = {r.doc_id: r.n_tokens for r in unigram.token_counts(df, pieces, unknown).collect()}
    assert got[0] == got[1] == 0 and got[3] > 0 and None in got
    assert unigram.token_counts(df.limit(0), pieces, unknown).count() == 0


# --- packing


def test_byte_ids_equal_library():
    spec = queries.tokenizer_json(queries.BYTE_BPE)
    mine, lib = packing.ByteBpe(spec), Tokenizer.from_str(spec)
    for t in [*texts(3, 3000, LETTERS), *AWKWARD]:
        ids = mine.encode(t)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == (lib.encode(t, add_special_tokens=False).ids if t else [])


def brute_fill(counts, capacity):
    sums = {0}
    for k, v in counts.items():
        sums = {s + k * n for s in sums for n in range(v + 1) if s + k * n <= capacity}
    return max(sums)


def test_plan_of_many_lengths_and_large_windows():
    for lengths, capacity in (({k: 1 for k in range(1, 65)}, 4096), ({k: 1 for k in range(1, 65)}, 2048), ({k: 3 for k in range(1, 200)}, 256)):
        windows = list(packing.plan(lengths, capacity))
        full = [w for w in windows if sum(map(abs, w)) == capacity]
        assert len(full) >= len(windows) - 1
        assert sum(abs(k) for w in windows for k in w) == sum(k * n for k, n in lengths.items())


def test_fill_is_the_best_subset():
    rng = random.Random(4)
    for _ in range(300):
        capacity = rng.randint(5, 64)
        counts = {rng.randint(1, capacity): rng.randint(1, 3) for _ in range(rng.randint(1, 6))}
        taken = packing.fill(counts, capacity)
        assert all(n <= counts[k] for k, n in taken.items())
        assert sum(k * n for k, n in taken.items()) == brute_fill(counts, capacity)


def check_windows(pieces, docs, capacity):
    """Every id once, offsets gapless, windows full or of power-of-two length."""
    by_seq, by_doc = {}, {}
    for doc, start, ids, total, seq, off in pieces:
        by_seq.setdefault(seq, []).append((off, len(ids) // 4))
        by_doc.setdefault(doc, []).append((start, ids, total))
    for parts in by_seq.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at and n > 0
            at += n
        assert at <= capacity and at & (at - 1) == 0
    for doc, ids in docs.items():
        assert b"".join(x for _, x, _ in sorted(by_doc[doc])) == ids
        assert all(t == len(ids) // 4 for _, _, t in by_doc[doc])


def test_packer_round_trip(monkeypatch):
    rng = random.Random(5)
    monkeypatch.setattr(packing, "BLOCK_BYTES", 2000)
    for capacity in (8, 64):
        docs = {k: struct.pack(f"<{n}I", *[rng.randint(0, 9) for _ in range(n)]) for k, n in enumerate(rng.randint(1, 3 * capacity) for _ in range(200))}
        p = packing.Packer(capacity, 0)
        out = [x for k, ids in docs.items() for x in p.add(k, ids)] + list(p.flush(True))
        check_windows(out, docs, capacity)


def test_packing_operator(spark):
    rows = [*enumerate(AWKWARD), (None, "null id"), (3, "one")]
    out = packing.pack_documents(documents(spark, rows), queries.tokenizer_json(queries.BYTE_BPE), capacity=64).collect()
    lib = Tokenizer.from_file(P.path(queries.BYTE_BPE))
    want = sum(len(lib.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    assert sum(r.length for r in out) == want
    assert all(len(r.ids) == 4 * r.length for r in out)
    assert {r.doc_tokens for r in out if r.doc_id in (0, 1)} == {1}
    assert packing.pack_documents(documents(spark, rows).limit(0), queries.tokenizer_json(queries.BYTE_BPE)).count() == 0


def test_packing_query(spark, sf):
    import zlib

    lib = Tokenizer.from_file(P.path(queries.BYTE_BPE))
    ids = {r.doc_id: lib.encode(r.text or "", add_special_tokens=False).ids + [1] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    seen = dict.fromkeys(ids, 0)
    windows = {}
    for r in queries.op8_packing(spark, sf).collect():
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part)) and r.doc_tokens == len(ids[r.doc_id])
        seen[r.doc_id] += r.length
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert seen == {k: len(v) for k, v in ids.items()}
    for w in windows.values():
        w.sort()
        ends = [o + n for o, n in w]
        assert [o for o, _ in w] == [0, *ends[:-1]] and ends[-1] & (ends[-1] - 1) == 0
