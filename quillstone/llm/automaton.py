"""BPE encoding and decoding through a deterministic tokenization automaton.

The automaton reads token labels. It is compiled by one gadget per merge, in merge order, from a single state
with an arc for every letter. The gadget of merge (a, b) -> c

- lets arc c lead where arc b led,
- gives "after a" a new state that no longer has arc b,
- and adds an arc c wherever an arc a still leaves.

A merge whose arc b has gone from "after a" by then can never be applied and makes no gadget. As every arc a
leads to one state, the states are "the last token was t"; each is the state it came from less what its gadgets
took away. Tokens are numbered so that all that grew out of arc b after a given merge are neighbours (a walk of
the tree token -> left part, children in merge order), so what a gadget takes away is one span of numbers, and a
state's row of transitions is a short sorted list of spans that have no arc.

Every string has exactly one path from the start, and so has each prefix of it. A word is encoded by one pass
over its places: the state at a place is known when it is reached, every label that starts there and has an arc
settles one later place, and nothing is ever taken back. Decoding walks the ids and emits their arc labels.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillstone.llm.common import Memo

#: Words kept in each of a worker's memos, and again as many of the generation before; bounds memory, never results.
MEMO = 300_000


def byte_letters() -> list[str]:
    """Printable stand-ins for the 256 byte values, as byte-level vocabularies spell them."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


END = "end"  # no letter: letters are single characters


class MergeAutomaton:
    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str = ""):
        self.vocab, self.end = vocab, end
        self.label = {i: t for t, i in vocab.items()}
        size = max(vocab.values(), default=-1) + 1
        self.left, self.right, self.time = [-1] * size, [-1] * size, [-1] * size
        self.taken: list[dict[int, int]] = [{} for _ in range(size)]  # by token: arcs its own gadgets took, and when
        grown: list[list[int]] = [[] for _ in range(size)]  # tokens by their left part, in merge order
        self.real = [False] * size
        parts = {a + b for a, b in merges}
        for t, i in vocab.items():
            self.real[i] = t not in parts
        for at, (a, b) in enumerate(merges):
            self._gadget(vocab[a], vocab[b], vocab[a + b], at, grown)
        self._number(grown)
        self.rows: list[list[int] | None] = [None] * size
        # labels letter by letter: a node's next nodes by letter; "" and END: the label spelled so far, in a word and at its end
        self.root: dict = {}
        for t, i in vocab.items():
            if self.real[i]:
                node, last = self.root, bool(end) and t.endswith(end)
                for letter in t.removesuffix(end) if last else t:
                    node = node.setdefault(letter, {})
                node[END if last or not end else ""] = i
                if not end:
                    node[""] = i

    def _gadget(self, a: int, b: int, c: int, at: int, grown: list[list[int]]) -> None:
        if self.real[a] and self.real[b] and self._leaves(a, b):
            self.left[c], self.right[c], self.time[c], self.real[c] = a, b, at, True
            self.taken[a][b] = at
            grown[a].append(c)

    def _since(self, t: int, u: int) -> int | None:
        """When arc u was taken from "after t" as the gadgets so far left it; None: it was not.

        "After t" came from "after its right part" as that was when t was made.
        """
        until = 1 << 60
        while t >= 0:
            at = self.taken[t].get(u)
            if at is not None and at < until:
                return at
            until, t = min(until, self.time[t]), self.right[t]
        return None

    def _leaves(self, t: int, u: int) -> bool:
        """Whether arc u leaves "after t" as the gadgets so far left it: neither u nor any arc it grew out of
        was taken before the next had grown."""
        grew = 1 << 60
        while u >= 0:
            at = self._since(t, u)
            if at is not None and at <= grew:
                return False
            grew, u = self.time[u], self.left[u]
        return True

    def _number(self, grown: list[list[int]]) -> None:
        """number: places in the walk; last: past the place of all that grew out of a token; then: of what grew out of it and when."""
        size = len(grown)
        self.number, self.last = [0] * size, [0] * size
        n = 0
        for root in range(size):
            if self.real[root] and self.left[root] < 0:
                stack = [(root, False)]
                while stack:
                    t, done = stack.pop()
                    if done:
                        self.last[t] = n
                        continue
                    self.number[t] = n
                    n += 1
                    stack.append((t, True))
                    stack.extend((c, False) for c in reversed(grown[t]))
        self.grown = grown

    def row(self, t: int) -> list[int]:
        """Edges, ascending, of the spans of numbers that have no arc in "after t": compiled when t is first entered."""
        spans, until, r, seen = [], 1 << 60, t, set()
        while r >= 0:
            for u, at in self.taken[r].items():
                if at < until and u not in seen:
                    seen.add(u)
                    spans.append((self.number[u], self.number[u] + 1))
                    first = next((c for c in self.grown[u] if self.time[c] >= at), None)
                    if first is not None:
                        spans.append((self.number[first], self.last[u]))
            until, r = min(until, self.time[r]), self.right[r]
        edges: list[int] = []
        for a, b in sorted(spans):
            if edges and a <= edges[-1]:
                edges[-1] = max(edges[-1], b)
            else:
                edges += [a, b]
        self.rows[t] = edges
        return edges

    def encode(self, word: str) -> tuple[int, ...]:
        """Ids of one word spelled in byte letters: a pass over its places, each settled by exactly one arc."""
        n, number, rows = len(word), self.number, self.rows
        came, last = [0] * (n + 1), [-1] * (n + 1)  # where the arc into a place starts, and its label
        for i in range(n):
            if i:
                if (t := last[i]) < 0:
                    continue
                row = rows[t]
                if row is None:
                    row = self.row(t)
            node, j = self.root, i
            while (node := node.get(word[j])) is not None:
                j += 1
                u = node.get("" if j < n else END)
                if u is not None and (not i or not bisect_right(row, number[u]) & 1):
                    came[j], last[j] = i, u
                if j == n:
                    break
        path: list[int] = []
        at = n
        while at:
            if last[at] < 0:
                raise ValueError(f"no path spells {word!r}")
            path.append(last[at])
            at = came[at]
        return tuple(path[::-1])

    def decode(self, ids: list[int]) -> list[str]:
        return [self.label[i] for i in ids]


# The word pattern of the tokenizer file for printable ASCII without blanks, lower case; fixed value.
ASCII_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
ODD = re.compile("[\x1c-\x1f]")
BLANK = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


class WordBpe:
    """The word-level BPE file. The library's own normaliser and word splitter are run on what stands between
    blanks, so that letters, digits and cases are those of its tables (on ASCII a plain pattern gives the same
    words); the automaton encodes the words."""

    def __init__(self, spec: str):
        d = json.loads(spec)
        m = d["model"]
        merges = [tuple(x) if isinstance(x, list) else tuple(x.split(" ")) for x in m["merges"]]
        self.auto = MergeAutomaton(m["vocab"], merges, m.get("end_of_word_suffix") or "")
        self.special = {x["content"]: x["id"] for x in d["added_tokens"]}
        self.auto.label.update({i: t for t, i in self.special.items()})
        self.cut = re.compile("(" + "|".join(re.escape(x) for x in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        library = Tokenizer.from_str(spec)
        self.normal, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        size = max(self.auto.label, default=-1) + 1
        self.labels = [self.auto.label.get(i, "") for i in range(size)]
        self.digits = [str(i) for i in range(size)]
        self.word = Memo(self.auto.encode, MEMO)
        self.memo = Memo(self._chunk, MEMO)

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        if chunk.isascii() and chunk.isprintable():
            words = ASCII_WORDS.findall(chunk.lower())
        else:
            words = [w for w, _ in self.split(self.normal(chunk))]
        return self.word[words[0]] if len(words) == 1 else tuple([i for w in words for i in self.word[w]])

    def _plain(self, text: str) -> list[int]:
        # no rule reaches across a blank: blanks are dropped, and none is made of or joined with other letters
        chunks = [c for c in BLANK.split(text) if c] if ODD.search(text) else text.split()
        return list(chain.from_iterable(map(self.memo.__getitem__, chunks)))

    def ids(self, text: str | None) -> list[int]:
        """Ids of a whole text; null is empty. A special token's string in a text is that token."""
        if not text or self.cut is None or not self.cut.search(text):
            return self._plain(text or "")
        return [i for piece in self.cut.split(text) for i in ([self.special[piece]] if piece in self.special else self._plain(piece))]

    def encode(self, text: str | None) -> tuple[str, str, int]:
        """(decimal ids joined by a space, decoded text, number of ids) of a whole text."""
        ids = self.ids(text)
        return " ".join(map(self.digits.__getitem__, ids)), " ".join(map(self.labels.__getitem__, ids)), len(ids)


_kept: dict[int, WordBpe] = {}


def word_bpe(spec: str) -> WordBpe:
    """The worker's encoder; tasks of one worker share its tables and memo."""
    key = hash(spec)
    if key not in _kept:
        _kept.clear()
        _kept[key] = WordBpe(spec)
    return _kept[key]


def bpe_encode(df: DataFrame, tokenizer_json: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every row's whole text: (id, n_tokens long, ids string, decoded string).

    Null and empty texts give no ids. Nulls and repeats in the id column pass through, a row each; other
    columns are not read, so their names can't clash. An empty table gives no rows. No shuffle. The
    tokenizer file's content (a fixed few MB) travels with the tasks; each worker compiles it once.
    """
    spec = df.sparkSession.sparkContext.broadcast(tokenizer_json)

    def run(batches):
        bpe = word_bpe(spec.value)
        for b in batches:
            got = [bpe.encode(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([g[2] for g in got], pa.int64()), pa.array([g[0] for g in got], pa.large_string()).cast(pa.string()), pa.array([g[1] for g in got], pa.large_string()).cast(pa.string())],
                ["id", "n_tokens", "ids", "decoded"],
            )

    src = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    out = src.mapInArrow(run, f"id {kind}, n_tokens long, ids string, decoded string")
    return out.withColumnRenamed("id", id_col)
