"""The stages on small folders with the deterministic provider."""

import json
from dataclasses import replace

import pytest

from lectern.operators.export import check_inputs, input_problems
from lectern.plans import stages
from lectern.providers import Deterministic, classify
from lectern.sources import config, files
from lectern.streaming.incremental import run_available


def put(folder, **texts):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in texts.items():
        (folder / f"{name}.txt").write_bytes(text if isinstance(text, bytes) else text.encode())


def statuses(report):
    return {r["name"]: r["status"] for r in report.collect()}


def test_listing_sees_hidden_and_empty_files(spark, tmp_path):
    put(tmp_path, **{"_u": "u", ".h": "h", "a.x": "x", "e": "", "sp ace": "s"})
    (tmp_path / "c.TXT").write_text("no")
    listing = files.list_directory(spark, str(tmp_path), ".txt")
    assert [r["name"] for r in listing.collect()] == [".h.txt", "_u.txt", "a.x.txt", "e.txt", "sp ace.txt"]
    assert {r["name"]: r["text"] for r in files.read_texts(listing).collect()} == {".h.txt": "h", "_u.txt": "u", "a.x.txt": "x", "e.txt": "", "sp ace.txt": "s"}
    with pytest.raises(FileNotFoundError):
        files.require_directory(spark, str(tmp_path / "none"))


def test_transcode_and_transcribe(spark, tmp_path):
    video = tmp_path / "video"
    video.mkdir()
    (video / "a.mp4").write_bytes(b"abcdefgh" * 3)
    (video / "b.mp4").write_bytes(b"\x01\x03")
    first = config.Transcode(str(video), str(tmp_path / "audio"))
    for _ in range(2):
        assert statuses(stages.transcode(spark, first, Deterministic())) == {"a.mp4": "succeeded", "b.mp4": "succeeded"}
    assert (tmp_path / "audio/a.mp3").read_bytes() == b"q2:" + b"abcdefgh" * 3
    cfg = config.Transcribe(str(tmp_path / "audio"), str(tmp_path / "texts"), max_clip_seconds=0.05)
    assert statuses(stages.transcribe(spark, cfg, Deterministic())) == {"a.mp3": "succeeded", "b.mp3": "succeeded"}
    assert "clip" in (tmp_path / "texts/a.txt").read_text()
    assert set(statuses(stages.transcribe(spark, cfg, Deterministic())).values()) == {"skipped"}


def test_preprocess(spark, tmp_path):
    put(tmp_path / "in", a="Ну, музыка. музыка, Музыка конец", cjk="中", filler="ну", bad=b"\xff\xfe", empty="")
    cfg = config.Preprocess(str(tmp_path / "in"), str(tmp_path / "out"))
    report = stages.preprocess(spark, cfg)
    assert statuses(report) == {"a.txt": "succeeded", "cjk.txt": "succeeded", "filler.txt": "succeeded", "bad.txt": "failed", "empty.txt": "succeeded"}
    assert {p.name: p.read_text() for p in (tmp_path / "out").glob("*.txt")} == {"a.txt": "музыка. конец", "filler.txt": ""}
    assert stages.exit_code("preprocess", report) == 0 and stages.exit_code("preprocess", report, strict=True) == 1
    assert statuses(stages.preprocess(spark, cfg))["a.txt"] == "skipped"


def test_summarize_and_export(spark, tmp_path):
    put(tmp_path / "in", a="one two.", b="one two three four", c="", d=b"\xff")
    put(tmp_path / "sum", a="kept")
    cfg = config.Summarize(str(tmp_path / "in"), str(tmp_path / "sum"), str(tmp_path / "digest.txt"), str(tmp_path / "stats.json"))
    report = stages.summarize(spark, cfg, Deterministic(lambda t: "four" in t and "Transcript" in t))
    assert statuses(report) == {"a.txt": "skipped", "b.txt": "failed", "c.txt": "succeeded", "d.txt": "failed"}
    assert json.loads((tmp_path / "stats.json").read_text()) == {"num_files": 3, "avg_words": 2.0, "words_per_minute": 140.0}
    digest = (tmp_path / "digest.txt").read_text()
    stages.summarize(spark, cfg, Deterministic())
    assert (tmp_path / "digest.txt").read_text() == digest and (tmp_path / "sum/a.txt").read_text() == "kept"
    (tmp_path / "in/d.txt").unlink()
    out = config.Export(str(tmp_path / "in"), str(tmp_path / "sum"), str(tmp_path / "digest.txt"), str(tmp_path / "md"))
    assert stages.export(spark, out).count() == 7
    assert (tmp_path / "md/a/transcript.md").read_text() == "# a\n\n## Transcript\n\none two.\n"
    assert (tmp_path / "md/a/summary.md").read_text() == "# a\n\n## Summary\n\nkept\n"
    assert (tmp_path / "md/corpus_digest.md").read_text() == f"# Corpus digest\n\n{digest}\n"


def test_export_names_every_problem(spark, tmp_path):
    put(tmp_path / "t", a="x", b="x")
    put(tmp_path / "s", b="x", c="x")
    cfg = config.Export(str(tmp_path / "t"), str(tmp_path / "s"), str(tmp_path / "none"), str(tmp_path / "md"))
    with pytest.raises(ValueError, match="missing summaries: a; missing transcripts: c; corpus digest"):
        stages.export(spark, cfg)
    assert not (tmp_path / "md").exists()
    put(tmp_path / "s", a="x")
    (tmp_path / "s/c.txt").unlink()
    (tmp_path / "none").write_text("d")
    with pytest.raises(ValueError):
        stages.export(spark, replace(cfg, sentences_per_paragraph=0))


@pytest.fixture
def corpus(tmp_path):
    for c in ("a", "b"):
        (tmp_path / "md" / c).mkdir(parents=True)
        (tmp_path / "md" / c / "summary.md").write_text(f"# {c}\n\n## Summary\n\nРазбирали flow.\n")
        (tmp_path / "md" / c / "transcript.md").write_text("x")
    (tmp_path / "md/corpus_digest.md").write_text("digest")
    return config.Distribute(str(tmp_path / "md"), str(tmp_path / "md/corpus_digest.md"), str(tmp_path / "manifest.json"))


def test_distribute(spark, tmp_path, corpus):
    report = stages.distribute(spark, corpus, Deterministic(lambda t: "# b" in t and "evidence_passages" in t))
    assert statuses(report) == {"a": "succeeded", "b": "failed"} and stages.exit_code("distribute", report) == 1
    page = (tmp_path / "md/a/summary.md").read_text()
    assert page.endswith("\n\n## Затронутые темы\n\n- Тема 1\n")
    saved = json.loads((tmp_path / "manifest.json").read_text())
    assert list(saved["classes"]) == ["a"] and saved["classes"]["a"]["assignments"][0]["evidence_id"] == "p1"
    assert statuses(stages.distribute(spark, replace(corpus, failed_only=True), Deterministic())) == {"b": "succeeded"}
    assert (tmp_path / "md/a/summary.md").read_text() == page
    refuse = Deterministic(lambda t: True)
    assert set(statuses(stages.distribute(spark, corpus, refuse)).values()) == {"succeeded"}
    (tmp_path / "md/a/transcript.md").write_text("y")
    with pytest.raises(ValueError, match="another corpus"):
        stages.distribute(spark, corpus, refuse)


def test_distribute_guards(spark, tmp_path, corpus):
    before = stages.corpus_fingerprint(spark, corpus, "digest")
    (tmp_path / "md/notes.txt").write_text("beside the classes")
    page = tmp_path / "md/a/summary.md"
    page.write_text(page.read_text() + "\n## Затронутые темы\n\n- x\n")
    assert stages.corpus_fingerprint(spark, corpus, "digest") == before != stages.corpus_fingerprint(spark, corpus, "other")
    (tmp_path / "md/c").mkdir()
    with pytest.raises(ValueError, match="no summary: c"):
        stages.distribute(spark, corpus, Deterministic())
    (tmp_path / "md/c").rmdir()
    (tmp_path / "md/c").symlink_to(tmp_path)
    with pytest.raises(ValueError, match="links"):
        stages.distribute(spark, corpus, Deterministic())


class Scripted(Deterministic):
    def __init__(self, *answers):
        super().__init__()
        self.answers, self.asked = list(answers), []

    def complete(self, system, text, max_tokens):
        self.asked.append(json.loads(text))
        return "completed", json.dumps(self.answers.pop(0) if len(self.answers) > 1 else self.answers[0])


def answer(**evidence):
    return {"assignments": [{"topic_id": "topic_01", "role": "primary", "reason": "Developed"} | evidence], "unmatched_reason": ""}


def test_correction_and_retry_limit():
    ask = lambda p: classify(p, "", {"class_summary": "s"}, {"topic_01"}, "Разбирали flow", {"p1": "Разбирали flow"}, 2048)
    p = Scripted(answer(), answer(evidence_id="p1"))
    assert ask(p)["assignments"][0]["evidence"] == "Разбирали flow"
    assert len(p.asked) == 2 and "correction_request" in p.asked[1] and p.asked[1]["previous_response"] == answer()
    p = Scripted(answer())
    with pytest.raises(ValueError):
        ask(p)
    assert len(p.asked) == 3
    broken = Deterministic(lambda t: True)
    with pytest.raises(RuntimeError):
        ask(broken)


def test_settings():
    text = "src: data/x  # where\nmin_count: 4\nremove_fillers: false\nother: 1\n"
    cfg = config.load(config.Preprocess, text, ("max_ngram=5", "dst='a b'"))
    assert cfg == config.Preprocess("data/x", "a b", 5, 4, True, False)
    with pytest.raises(KeyError):
        config.load(config.Preprocess, "", ("nothing=1",))


def test_stream(spark, tmp_path):
    put(tmp_path / "in", a="Ну, идём дальше")
    paths = [str(tmp_path / x) for x in ("in", "out", "check")]
    run_available(spark, *paths).awaitTermination()
    put(tmp_path / "in", b="ещё one")
    run_available(spark, *paths).awaitTermination()
    assert sorted((r["name"], r["text"], r["words"]) for r in spark.read.parquet(paths[1]).collect()) == [("a.txt", "идём дальше", 2), ("b.txt", "ещё one", 2)]


def test_shell(spark, tmp_path, capsys):
    from lectern.cli import main

    put(tmp_path / "in", a="ну слово", bad=b"\xff")
    (tmp_path / "c.yaml").write_text(f"src: {tmp_path}/in\ndst: {tmp_path}/none\n")
    assert main(["preprocess", f"config={tmp_path}/c.yaml", f"dst={tmp_path}/out"]) == 0
    said = capsys.readouterr()
    assert "failed: 1, succeeded: 1" in said.out and "bad.txt: not valid UTF-8" in said.err
    assert main(["preprocess", f"src={tmp_path}/in", f"dst={tmp_path}/out", "strict=true"]) == 1
    assert main(["preprocess", f"src={tmp_path}/nowhere"]) == 1 and main(["none"]) == 2
    assert main(["summarize", f"src={tmp_path}/in"]) == 1
    assert main(["summarize", f"src={tmp_path}/in", f"dst={tmp_path}/s", f"digest={tmp_path}/d", f"stats={tmp_path}/j", "provider=lectern.providers:Deterministic"]) == 0
    assert main(["export", f"transcripts={tmp_path}/s", f"summaries={tmp_path}/s", f"digest={tmp_path}/d", f"dst={tmp_path}/md"]) == 0


def test_every_missing_name_is_said(spark):
    """More names than the message once held, over several ranges."""
    names = spark.range(12_000).selectExpr("CAST(id AS STRING) AS stem").repartition(5)
    some = names.where("stem LIKE '1%'")
    left = ", ".join(sorted(str(i) for i in range(12_000) if not str(i).startswith("1")))
    assert input_problems(names, some, None).first().problems == f"missing summaries: {left}; corpus digest is not a file"
    assert input_problems(some, names, "d").first().problems == f"missing transcripts: {left}"
    assert input_problems(names, names, "d").first().problems is None
    assert input_problems(names.limit(0), names.limit(0), "d").first().problems == "no preprocessed transcripts found"
    assert input_problems(spark.createDataFrame([("",)], "stem string"), names.limit(0), "d").first().problems == "missing summaries: "
    with pytest.raises(ValueError, match="8999, 9, 90, 900"):
        check_inputs(names, some, "d")
