"""Stopped runs, incomplete answers, and what counts as another corpus."""

import json
import os
from dataclasses import replace

import pytest

from lectern.operators.topics import assignment_faults, topic_faults
from lectern.plans import stages
from lectern.providers import Deterministic
from lectern.sources import config, files
from lectern.streaming.incremental import run_available
from tests.test_stages import corpus, put, statuses  # noqa: F401  a fixture


class Counting(Deterministic):
    """Leaves a line for each call, and stops the whole task at a text that ``dies`` names."""

    def __init__(self, log, dies=""):
        super().__init__()
        self.log, self.dies = str(log), dies

    def complete(self, system, text, max_tokens):
        if self.dies and self.dies in text:
            raise KeyboardInterrupt  # no failure of the record: the worker goes
        with open(self.log, "a") as f:
            f.write(f"{system[:9]}\n")
        return super().complete(system, text, max_tokens)

    def calls(self, kind):
        return open(self.log).read().count(kind) if os.path.exists(self.log) else 0


def test_a_stopped_summary_run_asks_for_the_rest_alone(spark, tmp_path):
    put(tmp_path / "in", **{f"t{k}": f"words {k} here" for k in range(6)}, z="the end")
    cfg = config.Summarize(str(tmp_path / "in"), str(tmp_path / "sum"), str(tmp_path / "digest.txt"), str(tmp_path / "stats.json"))
    with pytest.raises(Exception):  # noqa: B017
        stages.summarize(spark, cfg, Counting(tmp_path / "log", "the end"))
    done = len(list((tmp_path / "sum").glob("*.txt")))
    assert done == Counting(tmp_path / "log").calls("Summarise")
    report = statuses(stages.summarize(spark, cfg, Counting(tmp_path / "log")))
    assert Counting(tmp_path / "log").calls("Summarise") == 7 and list(report.values()).count("skipped") == done


def test_a_stopped_distribution_asks_for_the_rest_alone(spark, tmp_path, corpus):  # noqa: F811
    for c in "cdef":
        (tmp_path / "md" / c).mkdir()
        (tmp_path / "md" / c / "summary.md").write_text(f"# {c}\n\n## Summary\n\nРазбирали flow.\n")
    with pytest.raises(Exception):  # noqa: B017
        stages.distribute(spark, corpus, Counting(tmp_path / "log", "class_summary\": \"# f"))
    answers = list(tmp_path.glob("manifest.json.answers/*/*.json"))
    assert len(answers) == Counting(tmp_path / "log").calls("Choose th")
    assert set(statuses(stages.distribute(spark, corpus, Counting(tmp_path / "log"))).values()) == {"succeeded"}
    log = Counting(tmp_path / "log")
    assert (log.calls("Choose th"), log.calls("Build a t")) == (6, 1)
    assert sorted(json.loads((tmp_path / "manifest.json").read_text())["classes"]) == list("abcdef") and not (tmp_path / "manifest.json.answers").exists()
    stages.clean(spark, corpus.manifest)
    assert not (tmp_path / "manifest.json.work").exists()


class Short(Deterministic):
    """Ends the digest before its time."""

    def complete(self, system, text, max_tokens):
        return ("incomplete" if system.startswith("Write a digest") else "completed"), "x"


def test_an_incomplete_digest_is_not_written(spark, tmp_path):
    put(tmp_path / "in", a="one two.")
    cfg = config.Summarize(str(tmp_path / "in"), str(tmp_path / "sum"), str(tmp_path / "digest.txt"), str(tmp_path / "stats.json"))
    assert statuses(stages.summarize(spark, cfg, Short())) == {"a.txt": "succeeded", cfg.digest: "failed"}
    assert not (tmp_path / "digest.txt").exists() and (tmp_path / "stats.json").exists()
    assert statuses(stages.summarize(spark, cfg, Deterministic())) == {"a.txt": "skipped"} and (tmp_path / "digest.txt").exists()


def test_another_model_is_another_corpus(spark, corpus):  # noqa: F811
    assert stages.corpus_fingerprint(spark, corpus, "d") != stages.corpus_fingerprint(spark, replace(corpus, model="m"), "d")


def test_folders_are_listed_at_any_depth(spark, tmp_path):
    (tmp_path / "a b/c/d").mkdir(parents=True)
    (tmp_path / "e").mkdir()
    for name in ("x.txt", "a b/.h", "a b/c/y.txt", "a b/c/d/z.txt"):
        (tmp_path / name).write_text(name)
    (tmp_path / "a b/c/link").symlink_to(tmp_path / "e")
    rows = [(r.name, r.is_dir, r.is_link, r.size) for r in files.list_directory(spark, str(tmp_path), recursive=True).collect()]
    assert rows == [
        ("a b", True, False, 0), ("a b/.h", False, False, 6), ("a b/c", True, False, 0), ("a b/c/d", True, False, 0), ("a b/c/d/z.txt", False, False, 13),
        ("a b/c/link", True, True, 0), ("a b/c/y.txt", False, False, 11), ("e", True, False, 0), ("x.txt", False, False, 5),
    ]
    read = files.read_files(files.list_directory(spark, str(tmp_path), ".txt", recursive=True), batch_bytes=1)
    assert {r.name: bytes(r.content).decode() for r in read.collect()} == {n: n for n in ("x.txt", "a b/c/y.txt", "a b/c/d/z.txt")}


def test_the_stream_gives_what_the_batch_gives(spark, tmp_path):
    put(tmp_path / "in", a="Ну, музыка. музыка, Музыка конец", filler="ну", cjk="中", bad=b"\xff\xfe", **{"sp ace+%20": "ещё one"})
    cfg = config.Preprocess(str(tmp_path / "in"), str(tmp_path / "batch"))
    report = statuses(stages.preprocess(spark, cfg))
    run_available(spark, *(str(tmp_path / x) for x in ("in", "out", "check")), cfg).awaitTermination()
    rows = {r.name: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert {k: r.status for k, r in rows.items()} == report
    assert {k: r.text for k, r in rows.items() if r.text is not None} == {p.name: p.read_text() for p in (tmp_path / "batch").glob("*.txt")}


TOPICS = [{"id": "topic_01", "name": "Ось", "description": "x"}, {"id": "topic_02", "name": "Flow", "description": "x"}]


@pytest.mark.parametrize(
    ("change", "faults"),
    [
        ({}, []), ({"id": "topic_03"}, ["id"]), ({"id": 2}, ["id"]), ({"name": "a/b"}, ["name_characters"]), ({"name": " Flow"}, ["name_padded"]), ({"name": " "}, ["name_blank"]), ({"name": "ось"}, ["name_repeated"]),
        ({"name": "_Unmatched"}, ["name_reserved"]), ({"name": "Ж" * 91}, ["name_long"]), ({"name": "\ud800"}, []), ({"description": None}, ["description_blank"]), ({"description": "", "id": ""}, ["id", "description_blank"]),
    ],
)
def test_topic_faults(change, faults):
    got = topic_faults([TOPICS[0], TOPICS[1] | change])
    assert [f.split(": ")[1] for f in got if f.startswith("topic 2")] == faults
    assert topic_faults([]) and topic_faults("x") and topic_faults(["x"])


@pytest.mark.parametrize(
    ("change", "faults"),
    [
        ({}, []), ({"evidence": 'flow - "мягкое движение" и опору.'}, []), ({"evidence": "**"}, ["evidence_blank"]), ({"evidence": "Развивали движение"}, ["evidence_absent"]),
        ({"evidence": None}, ["evidence_blank", "evidence_absent"]), ({"role": "main"}, ["role"]), ({"reason": " "}, ["reason_blank"]), ({"topic_id": "topic_09", "reason": 1}, ["topic_unknown", "reason_blank"]),
    ],
)
def test_assignment_faults(change, faults):
    good = {"topic_id": "topic_01", "role": "primary", "reason": "r", "evidence": "Разбирали flow"}
    check = lambda found, why: assignment_faults({"assignments": found, "unmatched_reason": why}, {"topic_01"}, "Разбирали *flow* — «мягкое движение»\nи опору.")
    assert [f.split(": ")[1] for f in check([good | change], "")] == faults
    assert check([good, good], "") == ["assignment 1: topic_repeated", "assignment 2: topic_repeated"]
    assert check([], "none") == [] and check([], " ") == check([good], "x") == check([good], None) == ["unmatched_reason"] and check(["x"], "")
