import corpus_pipeline as pipeline
from tests.llm.test_documents import brute_cut, brute_groups


def test_stages_against_brute_force(spark, sf, tmp_path):
    """Each stage on its predecessor's rows: filters drop whole rows, dedup keeps group heads, passages go, ids pack."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for k, (name, stage) in enumerate(pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, sf).write.parquet(str(tmp_path / f"{k}"))
        docs = spark.read.parquet(str(tmp_path / f"{k}"))
        after = docs.collect()
        if name == "packing":
            assert {r.doc_id for r in after} == set(before)
            break
        assert docs.columns == pipeline.COLUMNS
        kept = {r.doc_id: r for r in after}
        if name in ("toxicity", "quality"):
            assert all(kept[i] == before[i] for i in kept) and len(kept) >= 0.6 * len(before)
        elif name == "near_duplicates":
            groups = brute_groups([(i, r.text) for i, r in before.items()])
            assert set(kept) == {i for i, g in groups.items() if g == i}
        else:
            for i, n, gone, text in brute_cut([(i, r.text) for i, r in before.items()], 13):
                assert kept[i].text == (text if gone else before[i].text) and kept[i].n_chars == len(kept[i].text)
                assert n >= gone


def test_run_equals_the_stages(spark, sf):
    """run() is the stages one after another: equal rows, but for the numbers of windows and places in them."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, sf)
    out = pipeline.run(spark, sf)
    assert {(r.doc_id, r.doc_tokens) for r in out.collect()} == {(r.doc_id, r.doc_tokens) for r in docs.collect()}
    assert out.columns == docs.columns and sum(r.length for r in out.collect()) == sum(r.length for r in docs.collect())


def odd(spark, rows=None):
    """Nulls in every column, empty and long texts, repeated rows, and columns whose names the operators use too."""
    rows = rows if rows is not None else [
        (1, "one two three four five six", "en", "s", 27), (1, "one two three four five six", "en", "s", 27), (2, None, "en", "s", 0), (3, "", None, None, None),
        (None, "a text without an id", "en", "s", 20), (4, " ".join(f"w{k % 9973}" for k in range(60_000)), "en", None, None), (5, "six five four three two one", None, "s", 27), (6, " \n\t ", "fr", "t", 4),
    ]
    full = [(*r, 0.9, 7, 8, "x") for r in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, score double, id long, mark long, offending string")


def tables(spark, folder, labelled):
    spark.createDataFrame(labelled, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_filters_of_odd_rows(spark, tmp_path):
    """Without labels of both kinds nothing is known against a row: all stay, as often as they stand there."""
    for k, labelled in enumerate(([], [(1, 1, 0), (None, None, None), (5, None, 0)])):
        folder = tables(spark, tmp_path / str(k), labelled)
        for stage in (pipeline.drop_toxic, pipeline.drop_low_quality):
            want = sorted(map(repr, odd(spark).select(*pipeline.COLUMNS).collect()))
            assert sorted(map(repr, stage(spark, odd(spark), folder).collect())) == want
            out = stage(spark, odd(spark, []), folder)
            assert out.columns == pipeline.COLUMNS and out.count() == 0


def test_passages_and_packing_of_odd_rows(spark, tmp_path):
    out = pipeline.drop_repeated_passages(spark, odd(spark), "")
    assert out.columns == pipeline.COLUMNS
    got, given = out.collect(), odd(spark).collect()
    assert sorted(r.doc_id or 0 for r in got) == sorted(r.doc_id or 0 for r in given)
    long = {r.doc_id: r for r in got}[4]
    assert long.text == " ".join(f"w{k % 9973}" for k in range(60_000)) and long.n_chars == len(long.text)  # repeats of its own stay
    assert {r.doc_id: r.text for r in got}[2] is None and {r.doc_id: r.text for r in got}[6] == " \n\t "
    assert pipeline.drop_repeated_passages(spark, odd(spark, []), "").count() == 0
    packed = pipeline.pack(spark, odd(spark), "").collect()
    ends = {}
    for r in packed:
        ends.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
    assert set(ends) == {r.doc_id for r in given} and ends[2] == ends[3] == [(0, 1, 1)] and len(ends[1]) >= 2
    assert all(sum(n for _, n, _ in v) % v[0][2] == 0 for v in ends.values())
    assert pipeline.pack(spark, odd(spark, []), "").count() == 0


def test_near_duplicate_stage_keeps_odd_rows(spark):
    rows = [(1, "a b c d e f", "en", "s", 11), (1, "a b c d e f", "en", "s", 11), (2, "a b c d e f", None, None, None), (None, "a b c d e f", "en", "s", 11), (3, None, "en", "s", 0), (4, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted(r.doc_id or 0 for r in out) == [0, 1, 3, 4]
    assert pipeline.drop_near_duplicates(spark, docs.limit(0), "").count() == 0
