"""Token counts under a unigram vocabulary, without keeping the tokens.

An Aho-Corasick automaton lists every vocabulary piece that ends at a position; dynamic programming
carries (best score, number of pieces). The tie rule is the lattice's: pieces starting earlier are offered
first at an end position, and a later offer wins only with a strictly higher score. A character that no
one-character piece spells costs the lowest score less 10 and counts as its UTF-8 bytes.

No unigram file is shipped with the box. The pieces and scores are those of the public sentence-piece
file, read as a unigram model; the library run on the same file with its model kind set to unigram is the
exact reference in the tests. Scores add up in double precision within a word. The library adds single-precision
numbers over a whole text, so beyond 2^24 its own sums are rounded; counts here are of the exact optimum.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import Memo

#: Words kept in a worker's memo, and again as many of the generation before.
MEMO = 600_000
MARK = "▁"
#: No piece crosses these cuts: a space opens a piece or stands in a run of spaces, a line feed is no piece.
SEGMENTS = re.compile(r"\n| *[^ \n]+| +")


#: Scores below this mean "no merge makes it" in the file; such pieces rank just under the lowest real score.
SENTINEL = -1e8


def read_model(model_file: str):
    """The file's model proto as a unigram model: same pieces, scores with the sentinel replaced."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(model_file, "rb") as f:
        m.ParseFromString(f.read())
    lowest = min(p.score for p in m.pieces if p.type == 1 and p.score > SENTINEL)
    for p in m.pieces:
        if p.type == 1 and p.score <= SENTINEL:
            p.score = lowest - 1
    m.trainer_spec.model_type = 1
    return m


def read_pieces(model_file: str) -> tuple[list[tuple[str, float]], float]:
    """(piece, score) of the ordinary pieces, and the score of an unknown character."""
    pieces = [(p.piece, p.score) for p in read_model(model_file).pieces if p.type == 1]
    return pieces, min(s for _, s in pieces) - 10.0


class PieceCounter:
    def __init__(self, pieces: list[tuple[str, float]], unknown: float):
        self.auto = ahocorasick.Automaton()
        for p, s in pieces:
            self.auto.add_word(p, (len(p), s))
        self.auto.make_automaton()
        if any(MARK in p.lstrip(MARK) for p, _ in pieces) or any("\n" in p for p, _ in pieces):
            raise ValueError("a piece crosses a word boundary; texts can't be cut into words")
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.unknown = unknown
        self.memo = Memo(self._new, MEMO)

    def viterbi(self, s: str) -> int:
        """Number of pieces on the best path over s, marks already in place of spaces."""
        n = len(s)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for e, x in self.auto.iter(s):
            ends[e].append(x)
        score, count = [0.0] * (n + 1), [0] * (n + 1)
        for e in range(n):
            best, pieces = None, 0
            for length, w in sorted(ends[e], key=lambda x: -x[0]):
                v = score[e + 1 - length] + w
                if best is None or v > best:
                    best, pieces = v, count[e + 1 - length] + 1
            if s[e] not in self.single:
                v = score[e] + self.unknown
                if best is None or v > best:
                    best, pieces = v, count[e] + len(s[e].encode("utf-8", "replace"))
            score[e + 1], count[e + 1] = best, pieces
        return count[n]

    def _new(self, s: str) -> int:
        return self.viterbi(s.replace(" ", MARK))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        return sum(map(self.memo.__getitem__, SEGMENTS.findall(" " + text.replace(MARK, " "))))


_kept: dict[int, PieceCounter] = {}


def piece_counter(pieces: list[tuple[str, float]], unknown: float) -> PieceCounter:
    """The worker's counter; tasks of one worker share its automaton and memo."""
    key = hash((tuple(pieces), unknown))
    if key not in _kept:
        _kept.clear()
        _kept[key] = PieceCounter(pieces, unknown)
    return _kept[key]


def token_counts(df: DataFrame, pieces: list[tuple[str, float]], unknown: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens long) of every row's whole text.

    Null and empty texts count 0. Nulls and repeats in the id column pass through, a row each; other
    columns are not read. An empty table gives no rows. No shuffle; the vocabulary (its size is the file's)
    travels with the tasks.
    """
    vocab = df.sparkSession.sparkContext.broadcast((pieces, unknown))

    def run(batches):
        counter = piece_counter(*vocab.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([counter.count(t) for t in b.column(1).to_pylist()], pa.int64())], ["id", "n_tokens"])

    src = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, n_tokens long").withColumnRenamed("id", id_col)
