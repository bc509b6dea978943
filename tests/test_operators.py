import hashlib
import random


from pyspark.sql import functions as F

from quillstone.functions import sha256
from quillstone.operators import folds, incremental, resolve, similarity, topics, units, verdicts
from quillstone.operators.folds import split_text


def test_parse_units_edges(spark):
    text = "intro\r\n## [a][P0] one\r\nbody\n### sub\n## #x\nstill one\n## two [P2]\n\n## [b] [P1]  three  \n   "
    files = spark.createDataFrame([("f", text), ("g", ""), ("h", None), ("i", "### no")], "file_name string, text string")
    got = [(r.file_name, r.unit_pos, r.tag, r.priority, r.title, r.body) for r in units.parse_units(files).orderBy("file_name", "unit_pos").collect()]
    assert got == [
        ("f", 1, "a", 0, "one", "## [a][P0] one\nbody\n### sub\n## #x\nstill one"),
        ("f", 2, "未分类", 2, "two [P2]", "## two [P2]"),
        ("f", 3, "b", 1, "three", "## [b] [P1]  three"),
    ]


def test_first_mapping_wins(spark):
    m = topics.mapping_table(spark, {"x": ["a", " b "], "y": ["b", "c"]})
    assert {(r.tag, r.topic) for r in m.collect()} == {("a", "x"), ("b", "x"), ("c", "y")}


def brute_batches(sizes, most, limit):
    out, n, used, opened, batch = [], 0, 0.0, False, -1
    for s in sizes:
        if s > limit or not opened or n >= most or used + s > limit:
            batch, n, used, opened = batch + 1, 0, 0.0, s <= limit
        n, used = n + 1, used + s
        out.append(batch)
    return out


def test_batches_and_volumes(spark):
    rng = random.Random(1)
    sizes = sorted(rng.choice([0.5, 1.25, 3.0, 9.0]) for _ in range(120))
    df = spark.createDataFrame(list(enumerate(sizes)), "k int, size_kb double").repartition(7)
    got = [r.batch for r in folds.assign_batches(df, 5, 6.0, ["size_kb", "k"]).orderBy("k").collect()]
    assert got == brute_batches(sizes, 5, 6.0)
    rows = [(t, k, rng.randint(1, 60)) for t in ("p", "q") for k in range(40)] + [("r", 0, 500), ("s", 0, 3), ("s", 1, 4)]
    df = spark.createDataFrame(rows, "topic string, k int, bytes long").repartition(5)
    got = {(r.topic, r.k): r.volume for r in folds.assign_volumes(df, 100, ["k"]).collect()}
    for t in ("p", "q"):
        volume, used, n = 1, 0, 0
        for _, k, b in [x for x in rows if x[0] == t]:
            if n and used + b + 2 > 100:
                volume, used, n = volume + 1, 0, 0
            used, n = used + b + 2, n + 1
            assert got[t, k] == volume
    assert got["r", 0] == got["s", 0] == got["s", 1] == 1


def test_split_text():
    assert split_text("short", 10) == ["short"]
    assert split_text("aaaa\n\nbbbb\n\ncccc", 10) == ["aaaa", "bbbb", "cccc"]
    assert split_text("aa\n \nbb\n\ncc", 9) == ["aa\n\nbb", "cc"]
    assert split_text("x" * 12 + "\n\nab", 10) == ["x" * 12, "ab"]
    assert split_text("abc\ndef\nghijklmnopqr\nst", 9) == ["abc\n\ndef", "ghijklmnopqr", "st"]
    for t in ("", "\n\n", "é" * 40, "a\n" * 30):
        assert "".join(split_text(t, 12)).replace("\n", "") == t.replace("\n", "")


def test_split_large_keeps_small_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "aaaa\n\nbbbb" * 200), (3, None)], "k int, text string")
    got = folds.split_large(df, "k", "text", 0.5).collect()
    assert {r.k: r.chunk_total for r in got} == {1: 1, 2: max(r.chunk_index for r in got if r.k == 2), 3: 1}


def test_merge_adjacent():
    assert folds.merge_adjacent([1, 1, 5, 1], 3) == [[0, 1], [2], [3]]
    assert folds.merge_adjacent([1, 1, 1, 1], 4) == [[0, 1, 2, 3]]
    assert folds.merge_adjacent([], 1) == []


def test_old_rows_never_meet(spark, monkeypatch):
    """Only blocks with a new row are made, whatever the number of old ones."""
    monkeypatch.setattr(similarity, "BLOCK", 4)
    rows = [(k, "t", f"same text number {k % 3}", k < 2) for k in range(60)]
    df = spark.createDataFrame(rows, "part int, topic string, body string, is_new boolean")
    got = {(r.a, r.b) for r in similarity.jaccard_intra(df, 0.99, ["part"], key="part").collect()}
    assert got == {(a, b) for a in (0, 1) for b in range(2, 60) if a == b % 3}
    v = spark.createDataFrame([(k, 1, [1.0, float(k % 2)], k % 5 == 0) for k in range(40)] + [(50, 1, [1.0], True), (51, 1, [1.0, None], True)], "id int, s int, v array<double>, is_new boolean")
    got = {(r.a, r.b) for r in similarity.cosine_intra(v, 0.9, "id", "s", "v").collect()}
    assert got == {(a, b) for a in range(0, 40, 5) for b in range(40) if (a - b) % 2 == 0 and a != b and (b % 5 or a < b)}


def test_gram_numbers_are_exact():
    """One number a run of code points, whatever the letters; none of a shorter text."""
    top = "\U0010ffff\U0010fffe\U0010fffd"
    for t in ("abcabc", "ab", "", None, "日本語テキスト", "👩‍👩‍👧ok", top):
        for n in (2, 3):
            runs = {(t or "")[i : i + n] for i in range(len(t or "") - n + 1)}
            assert similarity.gram_numbers(t, n).tolist() == sorted(sum(ord(c) << 21 * (n - 1 - k) for k, c in enumerate(g)) for g in runs)


def test_topic_digests(spark):
    rows = [("t", k, f"b{k % 7}") for k in range(50)] + [("u", 1, "é")]
    df = spark.createDataFrame(rows, "topic string, place int, body string").repartition(5)
    got = {r.topic: (r.units, r.fingerprint) for r in topics.joined_digests(df, ["place"]).collect()}
    assert got["t"] == (50, hashlib.sha256("".join(f"b{k % 7}" for k in range(50)).encode()).hexdigest()[:16])
    assert got["u"] == (1, hashlib.sha256("é".encode()).hexdigest()[:16])
    assert topics.tree_digests(df, [], "body").first().h == topics.tree_digests(df.repartition(2), [], "body").first().h


def test_jaccard_blocks_are_exact(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdefg") for _ in range(60)) for _ in range(12)]
    rows = []
    for k in range(90):
        t = list(rng.choice(base))
        for _ in range(rng.randint(0, 8)):
            t[rng.randrange(len(t))] = rng.choice("abcdefg")
        rows.append((k, rng.choice("xy"), "".join(t), k % 3 != 0))
    rows.append((200, "x", "", True))
    df = spark.createDataFrame(rows, "part int, topic string, body string, is_new boolean")

    def grams(t):
        return {t[i : i + 3] for i in range(len(t) - 2)}

    for rule, keep in ((similarity.NEW_NEW, lambda a, b: a[3] and b[3] and a[0] < b[0]), (similarity.NEW_OLD, lambda a, b: a[3] and not b[3]), (None, lambda a, b: a[3] and (not b[3] or a[0] < b[0]))):
        got = {(r.a, r.b): r.sim for r in similarity.jaccard_intra(df, 0.6, ["part"], rule, key="part").collect()}
        want = {}
        for a in rows:
            for b in rows:
                if a[1] == b[1] and a[2] and b[2] and keep(a, b):
                    s = len(grams(a[2]) & grams(b[2])) / len(grams(a[2]) | grams(b[2]))
                    if s >= 0.6:
                        want[a[0], b[0]] = s
        assert got == want and want


def test_resolution_chains(spark):
    u = spark.createDataFrame([(f"f{k}", "t", k % 3, f"T{k}", f"body{k}", k) for k in range(6)], "fingerprint string, tag string, priority int, title string, body string, place int")
    j = spark.createDataFrame(
        [("f0_f1", "MERGE", None, None, "m01", 0), ("f1_f2", "MERGE", None, None, "m12", 1), ("f3_f4", "DUPLICATE", "f3", "f4", None, 2), ("f3_f4", "DUPLICATE", "f4", "f3", None, 3), ("f5_f5", "DUPLICATE", "f5", "f5", None, 4)],
        "pair_key string, verdict string, keep_fp string, drop_fp string, merged_text string, ord long",
    )
    upstream = {r.body for r in resolve.resolve_reference(u, j, ["place"]).collect()}
    assert upstream == {"m01"}  # the chain loses f2's text, the cycle both its members
    safe = {r.body for r in resolve.resolve_safe(u, j, ["place"]).collect()}
    assert safe == {"m12", "body3", "body5"}


def test_verdict_defaults(spark):
    a = spark.createDataFrame([(1, "2|MERGE\n2|DUPLICATE|B\n7|MERGE", 3), (2, "", 1), (3, "1|MERGE", 0)], "b int, raw string, n int")
    got = {(r.b, r.pair): (r.verdict, r.keep) for r in verdicts.parse_verdicts(a, "b", "raw", "n").collect()}
    assert got == {(1, 1): ("KEEP_BOTH", None), (1, 2): ("DUPLICATE", "B"), (1, 3): ("KEEP_BOTH", None), (2, 1): ("KEEP_BOTH", None)}


def test_state(spark):
    assert incremental.merge_signature(a=1, b=[2]) == incremental.merge_signature(b=[2], a=1) != incremental.merge_signature(a=2, b=[2])
    t = spark.createDataFrame([("x", "s1"), ("y", "s2")], "fingerprint string, merge_sig string")
    assert [r.fingerprint for r in incremental.cached(t, "s1").collect()] == ["x"]
    assert incremental.cached(t, "s1", full_resync=True).count() == 0
    marked = incremental.with_is_new(spark.createDataFrame([("x",), ("z",)], "fingerprint string"), t)
    assert {r.fingerprint: r.is_new for r in marked.collect()} == {"x": False, "z": True}


def test_long_chains_have_one_root(spark):
    """By simulation this chain takes 60 rounds of minimum and jump."""
    fps = [hashlib.md5(f"39-{k}".encode()).hexdigest() for k in range(90)]
    edges = spark.createDataFrame(list(zip(fps, fps[1:], strict=False)), "a string, b string").coalesce(1)
    got = resolve.smallest_reachable(edges).collect()
    assert len(got) == 90 and {r.root for r in got} == {min(fps)}


def test_units_and_topics_deal_no_texts_out(spark, sf):
    """Mapping and first places are broadcast: by a join on tags, all texts of a frequent tag would meet in one task."""
    from quillstone.plans.bridge import topic_units

    plan = topic_units(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 2


def test_units_with_odd_line_ends(spark):
    texts = {"a": "\r## [t][P1] one\r\rx\r\n\r\n## two\n　\x1c\r", "b": "\n\n## ## no\n## yes", "c": "##　no\n## a"}
    got = [(r.file_name, r.unit_pos, r.body) for r in units.parse_units(spark.createDataFrame(list(texts.items()), "file_name string, text string")).orderBy("file_name", "unit_pos").collect()]
    assert got == [("a", 1, "## [t][P1] one\n\nx"), ("a", 2, "## two"), ("b", 0, "## ## no"), ("b", 1, "## yes"), ("c", 1, "## a")]


def test_split_large_equals_split_text(spark):
    """In the JVM, by sizes alone: Python is sent no text."""
    rng = random.Random(5)
    texts = ["".join(rng.choice(["a", "é", "日本", "x" * 9, "\n", "\n\n", "\n \u3000\x1c\n", "\r\n", "\x85", " "]) for _ in range(rng.randint(0, 60))) for _ in range(300)] + ["\n\n" * 9, "a\n" * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    got = folds.split_large(df, "k", "text", 16 / 1024)
    assert "starts(p" in (plan := got._jdf.queryExecution().executedPlan().toString()) and "starts(t" not in plan
    want = {(k, i + 1): (len(c), t) for k, text in enumerate(texts) if (c := split_text(text, 16)) for i, t in enumerate(c)}
    assert {(r.k, r.chunk_index): (r.chunk_total, r.chunk) for r in got.collect()} == want


def test_joins_of_units_parse_no_text_again(spark, sf):
    """Texts are parsed once, when the keys are settled; before, each use of the units in a join parsed them all."""
    from quillstone.plans.catalog import QUERIES

    for name in ("resolve_reference", "resolve_safe", "topic_summary_after_dedup", "changelog_lines", "volume_packing", "verdict_prompts"):
        assert "documents.parquet" not in QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString(), name


def test_merge_reduce_sends_sizes_of_many_groups(spark):
    rows = [("g", 2, 1.0), ("g", 1, 1.0), ("g", None, 5.0), ("g", 3, 1.0), (None, 1, 1.0), (None, 2, 1.0), ("h", 1, 9.0)]
    out = folds.merge_reduce(spark.createDataFrame(rows, "g string, turn int, kb double").repartition(3), "g", ["turn"], "kb", 3.0)
    assert "FlatMapGroups" not in out._jdf.queryExecution().executedPlan().toString()
    assert {(r.g, r.turn): r.merged for r in out.collect()} == {("g", 1): 0, ("g", 2): 0, ("g", 3): 0, ("g", None): 1, (None, 1): 0, (None, 2): 0, ("h", 1): 0}


def test_gram_counts_are_the_sizes_of_grams(spark):
    df = spark.createDataFrame([(1, "abcabc"), (2, "a b"), (3, None), (4, "# 日本語テ")], "part int, body string")
    got = {r.part: r["size"] for r in similarity.gram_counts(df).collect()}
    assert got == {r.part: r["size"] for r in similarity.with_grams(df).collect()} == {1: 3, 4: 2}


def test_cross_pairs_find_rows_with_null_places(spark):
    rows = [(t, k, None if k == 1 else "f", f"same text {k}", k != 2) for t in "xy" for k in range(120)]
    df = spark.createDataFrame(rows, "topic string, part int, file string, body string, is_new boolean").withColumn("id", F.concat("topic", F.col("part").cast("string")))
    got = {(r.a, r.b) for r in similarity.jaccard_cross(df.withColumn("seen", F.col("topic")), 0.99, ["file", "part"], ["seen"], key="id").collect()}
    assert got == {(f"x{k}", f"y{k}") for k in [0, 1, *range(3, 51)]}


def test_jaccard_pairs_of_a_pair_of_blocks(monkeypatch):
    """Tiles and the bound on rare n-grams lose nothing; a row is sent for few blocks."""
    rng = random.Random(9)
    sets = [similarity.np.array(sorted(rng.sample(range(60), rng.randint(1, 40)))) for _ in range(80)]
    sets += [similarity.np.append(s, 1000 + k) for k, s in enumerate(sets[:40])]
    for dense in (0, 8, 6144):
        monkeypatch.setattr(similarity, "DENSE", dense)
        for a, b, same in ((sets, sets, True), (sets[:50], sets[50:], False)):
            p, q, sim = similarity.jaccard_pairs(a, b, same, 0.7, 7)
            got = {((min(x, y), max(x, y)) if same else (x, y)): s for x, y, s in zip(p.tolist(), q.tolist(), sim.tolist(), strict=True)}
            js = {(x, y): len({*a[x].tolist()} & {*b[y].tolist()}) / len({*a[x].tolist()} | {*b[y].tolist()}) for x in range(len(a)) for y in range(len(b)) if not same or x < y}
            assert len(got) == len(p) and got == {k: s for k, s in js.items() if s >= 0.7} and got


def most_rows_read(spark, run, sent=None):
    """(result of run, most rows that one of its tasks read from a shuffle); adds to sent the bytes each sent to the driver."""
    store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway
    listed = lambda: store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    stages = lambda: {(s := x.apply(k)).stageId(): s.attemptId() for x in [listed()] for k in range(x.size())}
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    old = stages()
    out = run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    most = 0
    for stage, attempt in stages().items():
        if stage not in old:
            tasks = store.taskList(stage, attempt, 10000)
            for k in range(tasks.size()):
                if (m := tasks.apply(k).taskMetrics()).isDefined():
                    most = max(most, m.get().shuffleReadMetrics().recordsRead())
                    if sent is not None:
                        sent.append(m.get().resultSize())
    return out, most


def test_a_group_is_digested_in_slices(spark, monkeypatch):
    """A slice goes on with the digest of the one before it; before, one task read a whole group."""
    monkeypatch.setattr(topics, "SLICE", 400, raising=False)
    rng = random.Random(4)
    rows = [(t, k, rng.choice(["é" * rng.randint(0, 40), "x" * rng.randint(0, 70), None])) for t, n in (("a", 300), ("b", 1), ("c", 4), ("d", 200), (None, 90)) for k in range(n)]
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "topic string, place int, body string").repartition(5)
    got, most = most_rows_read(spark, lambda: {r.topic: (r.units, r.fingerprint) for r in topics.joined_digests(df, ["place"]).collect()})
    assert got == {t: (len(b), hashlib.sha256("".join(b).encode()).hexdigest()[:16]) for t in "abcd" for b in [[x[2] or "" for x in rows if x[0] == t]]} | {
        None: (90, hashlib.sha256("".join(x[2] or "" for x in rows if x[0] is None).encode()).hexdigest()[:16])
    }
    assert most < 150
    assert topics.joined_digests(df.limit(0), ["place"]).collect() == []


def test_sorted_bodies_are_dealt_by_their_heads(spark, monkeypatch):
    """The driver samples heads, not bodies, to cut slices; bodies of one head are sorted whole, ends and all."""
    monkeypatch.setattr(topics, "SLICE", 1 << 17, raising=False)
    monkeypatch.setattr(topics, "HEAD", 8, raising=False)
    rng = random.Random(8)
    heads = ["", "a", "é", "same head", "\U0001f600" * 9, "\uffee" * 9, "zz"]
    rows = [("t", rng.choice(heads) + rng.choice(["", "x", "é"]) * rng.choice([0, 3, 9000]) + str(rng.randrange(40))) for _ in range(400)]
    sent = []
    df = spark.createDataFrame(rows, "topic string, body string").repartition(4)
    whole = sum(len(b.encode()) for _, b in rows)
    got, most = most_rows_read(spark, lambda: topics.joined_digests(df, ["body"]).collect(), sent)
    assert [(r.units, r.fingerprint) for r in got] == [(400, hashlib.sha256(b"".join(sorted(b.encode() for _, b in rows))).hexdigest()[:16])]
    assert most < 400 and max(sent) < whole / 20


def test_sha256_is_taken_up_again(monkeypatch):
    """In any pieces, by OpenSSL and without it."""
    rng = random.Random(6)
    assert sha256._library()
    for size in (0, 1, 55, 56, 63, 64, 65, 119, 120, 1000):
        data = rng.randbytes(size)
        for kind in (sha256.Native, sha256.Plain):
            state, k = sha256.start(), 0
            while k < size:
                digest, step = kind(state), rng.randint(1, 90)
                digest.update(data[k : k + step])
                state, k = digest.state(), k + step
            assert sha256.hexdigest(state) == hashlib.sha256(data).hexdigest()
    assert sha256.Native((sha256.start()[0], 1 << 33, b"")).state()[1] == 1 << 33  # more bits than 32 hold
    monkeypatch.setattr(sha256, "_library", lambda: None)
    assert isinstance(sha256.resumed(sha256.start()), sha256.Plain)
