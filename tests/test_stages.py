"""Both stages from a folder of texts to volumes, with answerers of our own."""

import json

import pytest

from quillstone import config as C
from quillstone import stages
from quillstone.__main__ import main, parse_args
from quillstone.model.streams import EndpointsExhausted, ModelError


def settings(tmp_path, **similarity):
    point = C.Endpoint("e", "http://localhost:1/v1", "k")
    stage = {n: C.StageConfig(n, "openai", "m", "", "openai", (point,)) for n in ("extract", "synthesize")}
    similar = C.SimilarityConfig(**({"method": "ngram", "threshold": 0.6, "max_file_size_kb": 1} | similarity))
    batching = C.BatchingConfig(max_files_per_batch=3, max_batch_kb=4)
    return C.PipelineConfig(str(tmp_path / "in"), str(tmp_path / "out"), {"01-first": ["a", "b"], "02-second": ["c"]}, similar, batching, stages=stage)


def body(name, tag, priority, n=40):
    return f"## [{tag}][P{priority}] {name}\n" + " ".join(f"{name}{k}" for k in range(n))


def write(tmp_path, texts):
    for name, text in texts.items():
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")


def extractor(asked, fail=()):
    """Answers with the text asked about: units as they stand in the prompt, fenced."""

    def build():
        def answer(prompt):
            with open(asked, "a", encoding="utf-8") as f:
                f.write(json.dumps(prompt[:40]) + "\n")
            if any(x in prompt for x in fail):
                raise ModelError("bad")
            text = "\n".join(x for x in prompt.split("\n") if not x.startswith(("请", "---", "## 来源文件")))
            return f"```markdown\n{text.strip()}\n```"

        return answer

    return build


def judge(asked, word):
    def build():
        def answer(prompt):
            with open(asked, "a", encoding="utf-8") as f:
                f.write("verdict\n")
            return "\n".join(f"{k}|{word}" for k in range(1, prompt.count("【对") + 1))

        return answer

    return build


def merger():
    return lambda prompt: "## [a][P0] merged\nboth"


def models(asked, word="DUPLICATE|A", fail=()):
    return stages.Models(extractor(asked, fail), judge(asked, word), merger, lambda: lambda texts: [[float(len(t)), 1.0] for t in texts])


def produced(tmp_path):
    return {p.name: p.read_text(encoding="utf-8") for p in (tmp_path / "out" / "topics").iterdir() if p.suffix == ".md"}


def calls(asked):
    return len(asked.read_text(encoding="utf-8").splitlines()) if asked.exists() else 0


def test_texts_to_volumes_and_only_changes_after_that(spark, tmp_path):
    asked = tmp_path / "asked"
    config, own = settings(tmp_path), models(str(asked))
    near = body("one", "a", 1).replace("one7 ", "zebra ")
    write(tmp_path, {"p.txt": body("one", "a", 0), "q.txt": near, "s/r.txt": body("two", "c", 1, 150) + "\n\n" + body("three", "c", 2, 150), "u.txt": body("odd", "zz", 2), "large.txt": "\n\n".join(body(chr(100 + k) * 5, "b", 1, 90) for k in range(9))})
    first = stages.run_pipeline(spark, config, own=own)
    text = produced(tmp_path)
    assert set(text) >= {"01-first.md", "01-first-002.md", "02-second.md", "02-second-002.md", "未分类.md", stages.INDEX}
    everything = "\n".join(text.values())
    assert body("one", "a", 0) in everything and "zebra" not in everything and body("lllll", "b", 1, 90) in everything
    assert "| 01 | 01-first | 10 条 | 1 | 9 | 0 | a、b |" in text[stages.INDEX] and "zz（1 条知识单元）" in text[stages.INDEX]
    assert first["topic_files"] == sorted(set(text) - {stages.INDEX})
    stats = first["dedup_stats"]
    assert (stats["total_before"], stats["total_after"], stats["new"], stats["duplicate"]) == (14, 13, 14, 1)
    out = tmp_path / "out"
    assert sorted((out / "_intermediate/extract/_manifest.txt").read_text().split()) == ["large.txt", "p.txt", "q.txt", "s/r.txt", "u.txt"]
    assert any(p.name.startswith("large.txt_part") for p in (out / "_intermediate/extract").iterdir())
    logs = [json.loads(p.read_text()) for p in (out / "_logs").iterdir() if p.name.startswith("concurrent_extract")]
    assert logs[0]["summary"]["error"] == 0 and logs[0]["summary"]["ok"] == logs[0]["total_units"]
    # nothing new: no call, no file written
    n, before = calls(asked), {p: p.stat().st_mtime_ns for p in out.rglob("*") if p.is_file()}
    assert stages.run_pipeline(spark, config, own=own) == first
    assert calls(asked) == n and {p: p.stat().st_mtime_ns for p in out.rglob("*") if p.is_file()} == before
    # one more text: only its topic is written, known pairs are not judged again
    write(tmp_path, {"v.txt": body("four", "c", 0)})
    untouched = (out / "topics/01-first.md").stat().st_mtime_ns
    second = stages.run_pipeline(spark, config, own=own)
    assert (out / "topics/01-first.md").stat().st_mtime_ns == untouched and second["dedup_stats"]["new"] == 1
    assert "four39" in produced(tmp_path)["02-second.md"] and calls(asked) == n + 1
    change = next((out / "_intermediate").glob("changelog_*.md")).read_text(encoding="utf-8")
    assert "## 02-second (+1)" in change and "[c][P0] four" in change and "(+1)" in change
    # a topic that is gone takes its volumes with it
    (out / "_intermediate/extract/u.txt.md").unlink(missing_ok=True)
    for p in (out / "_intermediate/extract").glob("*.md"):
        p.write_text(p.read_text(encoding="utf-8").replace("[zz]", "[a]"), encoding="utf-8")
    stages.run_pipeline(spark, config, "synthesize", own=own)
    assert "未分类.md" not in produced(tmp_path)
    # all anew
    full = stages.run_pipeline(spark, config, "synthesize", True, own)
    assert full["dedup_stats"]["new"] == full["dedup_stats"]["total_before"]


def test_failed_batches_and_merges(spark, tmp_path):
    asked = tmp_path / "asked"
    config = settings(tmp_path, method="embedding", threshold=0.99)
    write(tmp_path, {"p.txt": body("one", "a", 0), "q.txt": body("two", "a", 1), "bad.txt": "BAD " + body("no", "a", 1)})
    own = models(str(asked), "MERGE", ["BAD"])
    summary = stages.run_pipeline(spark, config, own=own)
    assert (tmp_path / "out/_intermediate/extract/_manifest.txt").read_text().split() == ["p.txt", "q.txt"]
    assert calls(asked) == 1 + 3 + 1  # a batch, its three files, one verdict
    assert summary["dedup_stats"]["merge"] == 1 and summary["dedup_stats"]["total_after"] == 1
    assert produced(tmp_path)["01-first.md"] == "## [a][P0] merged\nboth"
    own = models(str(asked), "MERGE")
    stages.run_pipeline(spark, config, own=own)
    assert sorted((tmp_path / "out/_intermediate/extract/_manifest.txt").read_text().split()) == ["bad.txt", "p.txt", "q.txt"]


def test_a_stop_leaves_the_rest_for_later(spark, tmp_path):
    config = settings(tmp_path)
    write(tmp_path, {f"{k}.txt": body(f"n{k}x", "a", 1, 300) for k in range(8)})

    def dead():
        def answer(prompt):
            raise EndpointsExhausted("none left")

        return answer

    stages.run_extract(spark, config, dead)
    assert (tmp_path / "out/_intermediate/extract/_manifest.txt").read_text() == ""
    assert any(p.name.startswith("circuit_break_extract") for p in (tmp_path / "out/_logs").iterdir())
    with pytest.raises(stages.StageError):
        stages.run_extract(spark, settings(tmp_path / "none") if (tmp_path / "none/in").mkdir(parents=True) else settings(tmp_path / "none"), dead)


def test_reports_across_topics(spark, tmp_path):
    config = settings(tmp_path)
    write(tmp_path, {"p.txt": body("one", "a", 0), "q.txt": body("one", "c", 1)})
    summary = stages.run_pipeline(spark, config, own=models(str(tmp_path / "asked")))
    assert summary["dedup_stats"]["cross_topic_pairs"] == 1
    report = (tmp_path / "out/_intermediate/cross_topic_similarity.txt").read_text(encoding="utf-8")
    assert "主题A: 01-first | 标签: a | P0" in report and "主题B: 02-second | 标签: c | P1" in report


def test_topics_are_sorted_with_the_uncategorised_last():
    assert sorted(["z", "未分类", "a", "龙"], key=stages.topic_sort) == ["a", "z", "龙", "未分类"]


def test_command_line(spark, tmp_path):
    given = parse_args(["--config", "c.yaml", "--only-stage", "extract", "--full-resync"])
    assert (given.config, given.only_stage, given.full_resync) == ("c.yaml", "extract", True)
    assert main(["--config", str(tmp_path / "none.yaml")]) == 1
    assert any(p.name.startswith("pipeline_error") for p in (tmp_path / "_logs").iterdir())
