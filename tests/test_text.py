"""Column expressions against literal answers and what holds of any text."""

import hashlib
import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillstone.functions import text as T

#: (text, without fences, as a file name, header of the text on one line)
ODD = [
    ('', '', 'untitled', ('未分类', 3, '')),
    (' ', '', 'untitled', ('未分类', 3, '')),
    ('a', 'a', 'a', ('未分类', 3, 'a')),
    ('## [t][P1] x', '## [t][P1] x', '##_[t][P1]_x', ('t', 1, 'x')),
    ('##[t] [P0]\u3000title\u3000', '##[t] [P0]\u3000title', '##[t]_[P0]_title', ('t', 0, 'title')),
    ('## [a][b] [P2] no', '## [a][b] [P2] no', '##_[a][b]_[P2]_no', ('未分类', 2, 'no')),
    ('## [x][P9] y', '## [x][P9] y', '##_[x][P9]_y', ('未分类', 3, 'y')),
    ('## plain [P1]', '## plain [P1]', '##_plain_[P1]', ('未分类', 1, 'plain [P1]')),
    ('x\u2028y', 'x\u2028y', 'x_y', ('未分类', 3, 'x\u2028y')),
    ('\x1c a \x85', 'a', 'a', ('未分类', 3, 'a')),
    ('\u3000全角\u3000', '全角', '全角', ('未分类', 3, '全角')),
    ('a/b\\c:d*?', 'a/b\\c:d*?', 'a_b_c_d', ('未分类', 3, 'a/b\\c:d*?')),
    ('...', '...', 'untitled', ('未分类', 3, '...')),
    ('._a b_.', '._a b_.', 'a_b', ('未分类', 3, '._a b_.')),
    ("é" * 90, "é" * 90, "é" * 90, ('未分类', 3, "é" * 90)),
    ('```md\nx\n```', 'x', '```md_x_```', ('未分类', 3, '```md x ```')),
    ('```\n```', '', '```_```', ('未分类', 3, '``` ```')),
    ('```python\nx\n```', '```python\nx\n```', '```python_x_```', ('未分类', 3, '```python x ```')),
    ('``` markdown \nbody ``` tail ```', '``` markdown \nbody ``` tail ```', '```_markdown__body_```_tail_```', ('未分类', 3, '``` markdown  body ``` tail ```')),
    ('no\nfence', 'no\nfence', 'no_fence', ('未分类', 3, 'no fence')),
    ('```text\n\n a \n```\nafter', 'a', '```text___a__```_after', ('未分类', 3, '```text   a  ``` after')),
    ('tab\there', 'tab\there', 'tab_here', ('未分类', 3, 'tab\there')),
    ('q"uote\n\x01', 'q"uote\n\x01', 'q_uote', ('未分类', 3, 'q"uote \x01')),
    ('<>|', '<>|', 'untitled', ('未分类', 3, '<>|')),
]
letters = st.lists(st.sampled_from([*"ab# []P0123/\\:*?._-`\n\t　\x1cé", "markdown", "```"]), max_size=30).map("".join)


def run(spark, texts, expr):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    return [r.v for r in df.select("k", expr(F.col("t")).alias("v")).orderBy("k").collect()]


def test_rules_on_odd_texts(spark):
    texts = [r[0] for r in ODD]
    assert run(spark, texts, T.strip) == [t.strip() for t in texts]
    assert run(spark, texts, T.strip_fences) == [r[1] for r in ODD]
    assert run(spark, texts, T.safe_filename) == [r[2] for r in ODD]
    assert [tuple(r) for r in run(spark, [t.replace("\n", " ") for t in texts], T.unit_header)] == [r[3] for r in ODD]
    assert run(spark, texts, T.fingerprint) == [hashlib.sha256(t.encode()).hexdigest()[:16] for t in texts]
    sizes = run(spark, texts, lambda c: T.payload_kb(F.lit("n"), c))
    assert sizes == [len(json.dumps({"source_file": "n", "content": t}, ensure_ascii=False).encode()) / 1024 for t in texts]


@settings(max_examples=20, deadline=None)
@given(st.lists(letters, min_size=1, max_size=40))
def test_rules_on_random_texts(spark, texts):
    """What holds of any text: names hold no letter that a path can't, and stay as they are when named again;
    a text without an opening fence is only trimmed; of a fenced one, what comes out stood between the fences."""
    names = run(spark, texts, T.safe_filename)
    assert all(n and not set(n) & set('<>:"/\\|?*\n\t ') and n == n.strip("._") for n in names)
    assert run(spark, names, T.safe_filename) == names
    for t, plain in zip(texts, run(spark, texts, T.strip_fences), strict=True):
        assert plain in t and plain == plain.strip()
        assert t.strip().startswith("```") or plain == t.strip()
    inner = [t.replace("`", "") for t in texts]
    assert run(spark, [f" ```markdown\n{t}\n``` " for t in inner], T.strip_fences) == [t.strip() for t in inner]


def test_ngrams_and_jaccard(spark):
    """Every run of n code points of the cleaned text, and no other."""
    cleaned = {"abcabc": "abcabc", "abcd": "abcd", "": "", "a": "a", "日本語テキスト": "日本語テキスト", "## x-y|z": "xyz", "ab  c d": "abcd", "👩‍👩‍👧 ok": "👩‍👩‍👧ok"}
    assert run(spark, list(cleaned), T.clean_for_ngrams) == list(cleaned.values())
    for n in (2, 3):
        for t, found in zip(cleaned.values(), run(spark, list(cleaned.values()), lambda c: T.ngrams(c, n)), strict=True):
            assert len(found) == len(set(found)) and all(len(g) == n and g in t for g in found)
            assert all(t[i : i + n] in found for i in range(len(t) - n + 1))
    df = spark.createDataFrame([(["a", "b"], ["b", "c"]), ([], ["a"]), ([], [])], "a array<string>, b array<string>")
    assert [r.v for r in df.select(T.jaccard(F.col("a"), F.col("b")).alias("v")).collect()] == [1 / 3, 0.0, 0.0]


def test_names_urls_and_answers(spark):
    df = spark.createDataFrame([(["b.txt", "a.txt"],)], "n array<string>")
    assert df.select(T.batch_name(F.col("n"))).first()[0] == "batch_" + hashlib.sha256(b"a.txt|b.txt").hexdigest()[:8] + ".md"
    urls = ["http://x/y?api_key=1&q=2", "http://x/?MyToken=a#f", "http://x/?q=token", "http://x"]
    assert run(spark, urls, T.sanitize_url) == ["http://x/y?api_key=***&q=2", "http://x/?MyToken=***#f", "http://x/?q=token", "http://x"]
    raws = ['x [1, 2] y', '```json\n{"a": 1}\n```', "none", '{"a": [1]} z']
    assert run(spark, raws, T.json_repair) == ["[1, 2]", '{"a": 1}', None, "[1]"]
    said = "1|KEEP_BOTH\n2:DUPLICATE:b\n3\tMERGE it\n3|dup|x\nx|MERGE\n４|MERGE\n5 MERGE"
    got = [(e.pair, e.verdict, e.keep) for e in run(spark, [said], T.verdict_lines)[0]]
    assert got == [(1, "KEEP_BOTH", None), (2, "DUPLICATE", "B"), (3, "MERGE", None), (3, "DUPLICATE", None)]
