"""Functions on hand-worked cases and on random ones."""

import hashlib
import json
import random
import re
import sys
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F

from lectern.functions import text as X
from lectern.functions.ngrams import collapse
from lectern.operators import clips as C
from lectern.operators import corpus as O
from lectern.operators import topics as T
from lectern.plans.stages import each


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


def clips(spark, segments, longest=10):
    got = one(spark, segments, lambda x: C.pack_clips(x, longest), "array<struct<start:bigint,end:bigint>>")
    return [tuple(c) for c in got]


@pytest.mark.parametrize(
    "segments, packed",
    [
        ([(0, 3), (5, 10), (11, 14), (20, 45), (46, 48), (50, 56)], [(0, 10), (11, 14), (20, 30), (30, 40), (40, 45), (46, 56)]),
        ([(0, 10)], [(0, 10)]),
        ([(0, 11)], [(0, 10), (10, 11)]),
        ([], []),
        ([(0, 0)], [(0, 0)]),
    ],
)
def test_clips(spark, segments, packed):
    assert clips(spark, segments) == packed


def test_clips_stay_within_bounds(spark):
    rng = random.Random(3)
    for _ in range(8):
        points = sorted(rng.sample(range(300), 30))
        made = clips(spark, list(zip(points[::2], points[1::2], strict=True)), 25)
        assert all(b - a <= 25 for a, b in made) and made == sorted(made)


def test_segments(spark):
    rows = [("f", 1, " a ", 0.6, -1.0, 2.4), ("f", 2, "  ", 0.0, 0.0, 0.0), ("f", 3, "b", 0.61, 0.0, 0.0), ("f", 4, "c", 0.0, 0.0, 0.0), ("g", 1, "x", 0.0, -1.01, 0.0), ("g", 2, "y", 0.0, 0.0, 2.41)]
    df = spark.createDataFrame(rows, "file string, seq int, text string, no_speech_prob double, avg_logprob double, compression_ratio double")
    got = {r.file: (r.text, r.kept, r.dropped) for r in C.assemble_transcripts(df, C.is_speech()).collect()}
    assert got == {"f": ("a c", 3, 1), "g": ("", 0, 2)}


def test_speech_or_all(spark):
    got = one(spark, [], lambda x: C.to_seconds(C.speech_or_all(x, F.lit(32000))), "array<struct<start:bigint,end:bigint>>")
    assert [tuple(c) for c in got] == [(0.0, 2.0)]


@pytest.mark.parametrize(
    "text, clean",
    [
        ("Привет, café (дом) 中 12%", "Привет, caf дом 12%"),
        ("Да. Редактор субтитров А.Семкин Корректор А.Егорова Нет.", "Да. Нет."),
        ("кагами, flow, vibe.", ""),
        ("ось, бедра, копчик.", "ось, бедра, копчик."),
        ("Термины, ось, текстура, импульс, амплитуда.", ""),
        ("Термины, ось, бедра.", "Термины, ось, бедра."),
        ("a b c\x1cd", "a b c d"),
        ("", ""),
    ],
)
def test_clean(spark, text, clean):
    assert one(spark, text, X.clean_text) == clean


def test_words(spark):
    assert [one(spark, w, X.normalize_word) for w in ("«Ну,»", "...")] == ["ну", ""]
    words = "ну идём Эм, нужно".split()
    assert one(spark, words, X.drop_fillers, "array<string>") == ["идём", "нужно"]
    assert one(spark, "бедраader тело flow".split(), X.drop_mixed_script, "array<string>") == ["тело", "flow"]
    assert one(spark, " a b\x1c\nc ", X.word_count) == 3 and one(spark, "", X.word_count) == 0
    assert one(spark, "　 x\x1f", X.strip) == "x"


@pytest.mark.parametrize(
    "words, kept",
    [
        ("музыка. музыка, Музыка конец", "музыка. конец"),
        ("a b a b a b c", "a b c"),
        ("a b a b c", "a b a b c"),
        ("a a a a a a", "a a"),
        (" ".join("a" * 18), "a a a a a a"),
        (". , !", "."),
    ],
)
def test_collapse(words, kept):
    assert " ".join(collapse(words.split())) == kept


def plain_collapse(words, most, least):
    key = [w.strip(X.ALLOWED_PUNCT).lower() for w in words]
    out, i = [], 0
    while i < len(words):
        for n in range(min(most, len(words) - i), 0, -1):
            times = 1
            while key[i + times * n : i + times * n + n] == key[i : i + n]:
                times += 1
            if times >= least:
                out += words[i : i + n]
                i += n * times
                break
        else:
            out.append(words[i])
            i += 1
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "A,", "b", ".", "c"]), max_size=40), st.integers(1, 6), st.integers(1, 4))
def test_collapse_as_by_hand(words, most, least):
    assert collapse(words, most, least) == plain_collapse(words, most, least)


def test_paragraphs(spark):
    f = lambda x: X.paragraphs(X.sentences(x), 2)
    assert one(spark, "A. B! C…\nD", f) == "A. B!\n\nC… D"
    assert one(spark, "", f) == ""
    assert one(spark, " x ", lambda x: X.titled(F.lit("t"), "Summary", x)) == "# t\n\n## Summary\n\nx\n"


def test_passages(spark):
    got = one(spark, "A b. C\n\nD… E! ", X.passages)
    assert [tuple(p) for p in got] == [("p1", "A b."), ("p2", "C"), ("p3", "D… E!")]


def test_topic_sections(spark):
    for names, bullet in (([], "- Нет выделенных тем."), (["x", "y"], "- x\n- y")):
        add = lambda x, n=names: X.with_topics(x, F.array(*map(F.lit, n)).cast("array<string>"))
        page = f"body\n\n## Затронутые темы\n\n{bullet}\n"
        assert one(spark, "body \n", add) == page and one(spark, page, add) == page
        assert one(spark, page, X.without_topics) == "body\n"


def test_names_and_numbers(spark):
    assert [one(spark, i, X.topic_id, "int") for i in (1, 100)] == ["topic_01", "topic_100"]
    assert [one(spark, x, X.rounded_words, "double") for x in (2.5, 3.5, 2.51)] == ["2", "4", "3"]
    assert one(spark, "a.b.mp3", lambda x: X.with_suffix(x, ".mp3", ".txt")) == "a.b.txt"
    assert one(spark, "Straße", X.casefold) == "strasse"


def test_topic_rules(spark):
    ok = {"id": "topic_01", "name": "Ось", "description": "d"}
    assert T.check_topics([ok]) == [ok]
    many = [{"id": f"topic_{i:02d}", "name": f"n{i}", "description": "d"} for i in range(1, 101)]
    assert T.check_topics(many)[-1]["id"] == "topic_100"
    bad = [[], None, [ok, dict(ok, id="topic_03", name="b")], [dict(ok, name="a/b")], [ok, dict(ok, id="topic_02", name="ось")], [dict(ok, name="_Unmatched")], [dict(ok, name="я" * 91)], [dict(ok, description=" ")], [dict(ok, name=5)]]
    for topics in bad:
        with pytest.raises(ValueError):
            T.check_topics(topics)
    rows = spark.createDataFrame([(1, "topic_01", "Ось", "d"), (2, "topic_03", "ось", "d"), (3, "topic_03", "я" * 91, None)], "pos int, id string, name string, description string")
    assert sorted(tuple(r) for r in T.topic_violations(rows).collect()) == [(1, "name_repeated"), (2, "id"), (2, "name_repeated"), (3, "description_blank"), (3, "name_long")]


def assignment(**changes):
    a = {"topic_id": "topic_01", "role": "primary", "reason": "Developed", "evidence": "flow"}
    return {"assignments": [a | changes], "unmatched_reason": ""}


def test_assignment_rules(spark):
    summary = "Разбирали *flow* — «мягкое движение»\nи опору."
    assert T.check_assignment(assignment(evidence='flow - "мягкое движение" и опору.'), {"topic_01"}, summary)
    double = assignment()
    double["assignments"] *= 2
    bad = [assignment(evidence="Развивали движение"), assignment(evidence="**"), double, assignment(role="main"), {"assignments": [], "unmatched_reason": " "}, dict(assignment(), unmatched_reason="x"), assignment(topic_id="topic_09"), assignment(reason=5), {"assignments": None}]
    for result in bad:
        with pytest.raises(ValueError):
            T.check_assignment(result, {"topic_01"}, summary)
    assert one(spark, summary, X.normalize_evidence) == T.plain_evidence(summary)


def test_modules_travel_to_workers_after_their_functions_were_used(spark):
    assert one(spark, "Stra\u00dfe e\u0301", lambda x: X.casefold(X.nfc(x))) == "strasse \u00e9"
    answer = json.dumps(assignment(evidence="**"))
    answers = spark.createDataFrame([("a", answer)], "name string, answer string")
    assert [r.body for r in each(answers, lambda r: ";".join(T.assignment_faults(json.loads(r.answer), {"topic_01"}, "flow"))).collect()] == ["assignment 1: evidence_blank"]
    for name in [n for n in sys.modules if n.split(".")[0] == "lectern"]:
        cloudpickle.dumps(sys.modules[name])


def test_statistics(spark):
    texts = spark.createDataFrame([("a b",), ("a b c d",), ("",)], "text string")
    assert tuple(O.corpus_stats(texts, 140).first()) == (3, 6, 2.0, 140.0)
    assert O.corpus_stats(texts.limit(0), 140).count() == 0


def test_digest_prompt_goes_part_by_part(spark):
    rows = [(f"n{i}", f"т{i}\n" * (i % 4)) for i in range(3000)] + [("n7", "again"), ("n8", None), (None, "x")]
    want = "\n".join(f"\n--- {n} ---\n{t}" for n, t in sorted(r for r in rows if None not in r))
    digests = spark.createDataFrame(rows, "name string, summary string").repartition(7)
    assert O.digest_prompt(digests) == (want, len(rows))
    assert tuple(O.prompt_sha256(digests).first()) == (hashlib.sha256(want.encode()).hexdigest(), len(rows))
    assert tuple(O.prompt_sha256(digests.limit(0)).first()) == (None, 0)
    plan = O.prompt_sha256(digests)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan


def test_the_alphabet_is_read_in_runs(spark):
    """As the replacement of what lies outside it; a plan with that replacement takes ten times as long."""
    texts = ["", " ", "a", " a ", "中 (é)", "a中b", "😀a😀😀b ", "\ta\n\nb c", "Привет, café (дом) 中 12%", "а́-б", "\0x\0", None]
    old = lambda x: F.trim(F.regexp_replace(x, X.OUTSIDE_ALPHABET, " "))
    assert [one(spark, t, X.keep_alphabet) for t in texts] == [one(spark, t, old) for t in texts]
    assert one(spark, "Ог ᲀытяжение, ось, импульс, бедра, flow. x", X.clean_text) == one(spark, "Ог ᲀытяжение, ось, импульс, бедра, flow. x", lambda x: X.keep_alphabet(X.replace_if(x, X.VOCABULARY_LIST, X.is_vocabulary_list, "")))
    plan = spark.range(1).select(X.clean_text(F.col("id").cast("string")))._jdf.queryExecution().optimizedPlan().toString()
    assert X.OUTSIDE_ALPHABET not in plan


def test_only_runs_that_composition_can_change_reach_python(spark):
    """Every character alone, and after and before others: outside the runs nothing changes and nothing joins."""
    chars = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    around = ["e", "\u0301", "\u1100", "\u0327", "\u30ab", "я"]
    texts = ["".join(chars[i : i + 5000]) for i in range(0, len(chars), 5000)] + ["".join(f"{a}{c}{a}" for c in chars[i : i + 5000]) for a in around for i in range(0, len(chars), 5000)]
    texts += ["e\u0301\0\u0301x\u0323\u0307", "\0", "\u0301", "", "я\u0306\0\0и\u0306", "Ось — «é»", None]
    got = spark.createDataFrame(list(enumerate(texts)), "k int, x string").repartition(4).select("k", X.nfc(F.col("x")).alias("y")).collect()
    assert {r.k: r.y for r in got} == {k: t if t is None else unicodedata.normalize("NFC", t) for k, t in enumerate(texts)}
    pairs = {(chr(int(d[0], 16)), chr(int(d[1], 16))) for c in chars if len(d := unicodedata.decomposition(c).split()) == 2 and "<" not in d[0]}
    joining = {b for a, b in pairs if unicodedata.normalize("NFC", a + b) != a + b} | {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}
    inside = re.compile("[" + re.sub(r"\\x\{(\w+)\}", lambda m: f"\\U{int(m[1], 16):08x}", X._COMPOSING) + "]")
    firsts = {unicodedata.normalize("NFD", c)[0] for c in chars if not inside.match(c)}
    assert [c for c in chars if not inside.match(c) and (unicodedata.combining(c) or unicodedata.normalize("NFC", c) != c)] == []
    assert [c for c in joining if not inside.match(c)] == [] and not [c for c in firsts if inside.match(c)]


def test_python_gets_runs_and_no_texts(spark, monkeypatch):
    monkeypatch.setattr(X, "_compose", lambda x: F.concat(F.lit("<"), x, F.lit(">")))
    cases = {"\u00e9 \u2014 \u00abя\u00bb": "\u00e9 \u2014 \u00abя\u00bb", "a long text e\u0301 and so on": "a long text <e\u0301> and so on", "e\u0301 b o\u0308c": "<e\u0301 b o\u0308>c"}
    assert {x: one(spark, x, X.nfc) for x in cases} == cases
