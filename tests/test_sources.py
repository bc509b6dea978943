import threading

from pyspark.sql import functions as F

from quillstone.sources import files, sinks
from quillstone.streaming.incremental import ingest


def test_corpus_listing_and_encodings(spark, tmp_path):
    root = tmp_path / "in"
    texts = {"a.txt": ("utf-8", "plain é", "utf-8"), "sub/B.txt": ("utf-8-sig", "mark", "utf-8-sig"), "le.txt": ("utf-16", "二进制", "utf-16-le(bom)"), "gb.txt": ("gb18030", "中文网文小说写作", "gb18030")}
    for name, (codec, text, _) in texts.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(text.encode(codec))
    (root / "be.txt").write_bytes(b"\xfe\xff" + "大端".encode("utf-16-be"))
    (root / "_empty.txt").write_bytes(b"")
    (root / "note.md").write_text("no")
    for skipped in (".git/x.txt", "VENV/x.txt", "out/x.txt"):
        (root / skipped).parent.mkdir(parents=True)
        (root / skipped).write_text("no")
    listed = files.list_files(spark, str(root), exclude=str(root / "out"))
    assert sorted(r.source_name for r in listed.collect()) == sorted([*texts, "be.txt", "_empty.txt"])
    got = {r.source_name: (r.text, r.detected_encoding, r.size_kb) for r in files.read_corpus(spark, str(root), str(root / "out")).collect()}
    for name, (_, text, seen) in texts.items():
        assert got[name] == (text, seen, len(text.encode()) / 1024)
    assert got["be.txt"][:2] == ("大端", "utf-16-be(bom)") and got["_empty.txt"] == ("", "utf-8", 0.0)


def test_decode_orders():
    assert files.decode(b"\xff\xfea\x00", files.SAFE_ORDER) == ("a", "utf-16-le(bom)")
    assert files.decode("中文网文".encode("gbk"), files.SAFE_ORDER)[0] == "中文网文"
    assert files.decode("中文网文".encode("gbk"), files.REFERENCE_ORDER)[1] == "utf-16"
    assert files.decode(b"\x81", ["utf-8"])[1] == "gb18030(replace)"


def test_extracts_volumes_and_stale_files(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "B.md").write_bytes(b"## [t][P0] b\r\nline")
    (tmp_path / "x" / "a.md").write_bytes(b" \n")
    ex = files.read_extracts(spark, str(tmp_path / "x"))
    assert {r.file_name: r.text for r in ex.collect()} == {"b.md": "## [t][P0] b\nline", "a.md": " \n"}
    assert files.joined_extracts(ex).first().text == "## [t][P0] b\nline"
    u = spark.createDataFrame([("to/pic", k, "x" * 600) for k in range(4)] + [("s", 0, "tiny")], "topic string, k int, body string")
    placed = sinks.volumes(u, 1, ["k"])
    texts = sinks.volume_texts(placed, ["k"])
    out = str(tmp_path / "out")
    sinks.write_text_files(spark, texts, out)
    sinks.write_text_files(spark, texts, out)
    names = sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith("."))
    assert names == ["s.md", "to_pic-002.md", "to_pic-003.md", "to_pic-004.md", "to_pic.md"]
    (tmp_path / "out" / "to_pic-009.md").write_text("old")
    assert sinks.remove_stale(spark, out, names) == ["to_pic-009.md"]


def test_manifest_and_caches(spark, tmp_path):
    assert files.read_manifest(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "m").write_text(" a.txt \n\nb.txt\na.txt\n")
    assert sorted(r.source_name for r in files.read_manifest(spark, str(tmp_path / "m")).collect()) == ["a.txt", "b.txt"]
    df = spark.createDataFrame([("f",)], "fingerprint string")
    sinks.write_cache(df, str(tmp_path / "c"), "s1")
    sinks.write_cache(df.withColumn("fingerprint", F.lit("g")), str(tmp_path / "c"), "s2")
    assert {(r.fingerprint, r.merge_sig) for r in spark.read.parquet(str(tmp_path / "c")).collect()} == {("f", "s1"), ("g", "s2")}
    e = spark.createDataFrame([('{"a": [1.0, 2.0]}',), ("broken",)], "value string")
    assert [(r.fingerprint, r.embedding) for r in files.read_embedding_json(e).collect()] == [("a", [1.0, 2.0])]


def test_manifest_loses_no_line(spark, tmp_path):
    """Threads that append to one manifest."""
    names = [[f"t{t}_f{i}" for i in range(5)] for t in range(6)]
    pool = [threading.Thread(target=lambda own=own: [sinks.append_lines(spark, [n], str(tmp_path), "m") for n in own]) for own in names]
    for t in pool:
        t.start()
    for t in pool:
        t.join(60)
    assert {r.source_name for r in files.read_manifest(spark, str(tmp_path / "m")).collect()} == {n for own in names for n in own}


def test_small_files(spark, tmp_path):
    folder = str(tmp_path / "d")
    assert sinks.read_text(spark, folder, "x") is None and sinks.read_json(spark, folder, "x") is None
    for text in ("old é", "new", ""):
        sinks.write_text(spark, text, folder, "x")
        assert sinks.read_text(spark, folder, "x") == text
    sinks.dump_json(spark, {"a": ["é"]}, folder, "j")
    assert sinks.read_json(spark, folder, "j") == {"a": ["é"]}
    assert sorted(p.name for p in (tmp_path / "d").iterdir() if not p.name.startswith(".")) == ["j", "x"]


def test_stream_takes_each_unit_once(spark, tmp_path):
    source, table, state = (tmp_path / n for n in ("md", "units", "state"))
    source.mkdir()
    (source / "a.md").write_text("## [t][P0] one\nx\n## [t][P1] two\ny")
    for more in (None, "## [t][P1] two\ny\n## [t][P2] three\nz"):
        if more:
            (source / "b.md").write_text(more)
        q = ingest(spark, str(source), str(table), str(state))
        q.awaitTermination()
    got = spark.read.parquet(str(table))
    assert sorted(r.title for r in got.collect()) == ["one", "three", "two"]
