"""Topics, evidence passages and assignments, and the rules that they are held to.

Each rule is written once in a table, in two forms: as a Column over the rows of a DataFrame, and as a test of a value of a provider's answer."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Mapping
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import casefold, normalize_evidence, plain_evidence, strip, topic_id

ROLES = ("primary", "secondary")
UNMATCHED = "_unmatched"
LONGEST_NAME = 180
_FORBIDDEN = r'[/\\\x00<>:"|?*\x01-\x1f]'


class Rule(NamedTuple):
    """``column``: whether a row breaks the rule. ``value``: whether a string of an answer does, given the facts about its element."""

    field: str
    column: Callable[[], Column]
    value: Callable[[str, Mapping[str, Any]], bool]


def _stripped(field: str) -> Column:
    return strip(F.col(field))


TOPIC_RULES = {
    "id": Rule("id", lambda: F.col("id") != topic_id(F.col("pos").cast("int")), lambda v, facts: v != f"topic_{facts['pos']:02d}"),
    "name_blank": Rule("name", lambda: _stripped("name") == "", lambda v, _: not v.strip()),
    "name_padded": Rule("name", lambda: (_stripped("name") != F.col("name")) & (_stripped("name") != ""), lambda v, _: v.strip() not in ("", v)),
    "name_reserved": Rule("name", lambda: F.col("name").isin(".", "..") | (F.col("folded") == UNMATCHED), lambda v, _: v in (".", "..") or v.casefold() == UNMATCHED),
    "name_characters": Rule("name", lambda: F.col("name").rlike(_FORBIDDEN), lambda v, _: bool(re.search(_FORBIDDEN, v))),
    "name_long": Rule("name", lambda: F.octet_length("name") > LONGEST_NAME, lambda v, _: len(v.encode(errors="surrogatepass")) > LONGEST_NAME),
    "name_repeated": Rule("name", lambda: F.col("uses") > 1, lambda v, facts: facts["uses"] > 1),
    "description_blank": Rule("description", lambda: _stripped("description") == "", lambda v, _: not v.strip()),
}
ASSIGNMENT_RULES = {
    "topic_unknown": Rule("topic_id", lambda: F.col("known").isNull(), lambda v, facts: not facts["known"]),
    "topic_repeated": Rule("topic_id", lambda: F.col("uses") > 1, lambda v, facts: facts["uses"] > 1),
    "reason_blank": Rule("reason", lambda: F.coalesce(_stripped("reason"), F.lit("")) == "", lambda v, _: not v.strip()),
    "role": Rule("role", lambda: ~F.coalesce(F.col("role"), F.lit("")).isin(*ROLES), lambda v, _: v not in ROLES),
    "evidence_blank": Rule("evidence", lambda: F.coalesce(F.col("quote"), F.lit("")) == "", lambda v, _: not plain_evidence(v)),
    "evidence_absent": Rule("evidence", lambda: (F.col("quote") != "") & ~F.coalesce(F.contains("body", "quote"), F.lit(False)), lambda v, facts: plain_evidence(v) not in facts["body"]),
}


def _broken(rules: Mapping[str, Rule], unknown: bool) -> Column:
    """The names of the rules that a row breaks; ``unknown``: what a null test counts as."""
    return F.explode(F.array_compact(F.array(*(F.when(F.coalesce(r.column(), F.lit(unknown)), F.lit(k)) for k, r in rules.items()))))


def topic_violations(topics: DataFrame) -> DataFrame:
    """(pos, rule) for topics (pos from 1, id, name, description): every broken rule of every row."""
    folded = topics.withColumn("folded", casefold(F.col("name")))
    uses = folded.groupBy("folded").agg(F.count("*").alias("uses"))
    return folded.join(uses, "folded", "left").select("pos", _broken(TOPIC_RULES, True).alias("rule"))


def lookup_evidence(assignments: DataFrame, passages: DataFrame) -> DataFrame:
    """Assignments (class, pos, topic_id, role, evidence_id, reason) with the passage that evidence_id names; null where it names none."""
    known = passages.select("class", F.col("passage_id").alias("evidence_id"), F.col("text").alias("evidence"))
    return assignments.drop("evidence").join(known, ["class", "evidence_id"], "left")


def assignment_violations(assignments: DataFrame, topics: DataFrame, results: DataFrame) -> DataFrame:
    """(class, pos, rule) for assignments against topics (id) and results (class, summary, unmatched_reason); pos is 0 for a rule on the class.

    Evidence must stand in the class's summary, both in normal form: an equi-join on the class and a test of each pair."""
    known = topics.select(F.col("id").alias("topic_id"), F.lit(True).alias("known")).distinct()
    uses = assignments.groupBy("class", "topic_id").agg(F.count("*").alias("uses"))
    summaries = results.select("class", normalize_evidence(F.col("summary")).alias("body"))
    rows = assignments.join(known, "topic_id", "left").join(uses, ["class", "topic_id"], "left").join(summaries, "class", "left").withColumn("quote", normalize_evidence(F.col("evidence")))
    own = rows.select("class", "pos", _broken(ASSIGNMENT_RULES, False).alias("rule"))
    counts = assignments.groupBy("class").agg(F.count("*").alias("n"))
    reason = F.coalesce(F.col("unmatched_reason"), F.lit(""))
    whole = results.select("class", "unmatched_reason").join(counts, "class", "left")
    bad = F.when(F.coalesce("n", F.lit(0)) > 0, reason != "").otherwise(strip(reason) == "")
    return own.unionByName(whole.where(bad).select("class", F.lit(0).cast(dict(own.dtypes)["pos"]).alias("pos"), F.lit("unmatched_reason").alias("rule")))


def topic_names(assignments: DataFrame, topics: DataFrame) -> DataFrame:
    """(class, names) in the order of the assignments."""
    named = assignments.join(topics.select(F.col("id").alias("topic_id"), "name"), "topic_id")
    return named.groupBy("class").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "name"))), lambda x: x["name"]).alias("names"))


def _strings(element: Any, fields: set[str]) -> dict[str, str | None]:
    """The fields of an element of an answer; None for what is missing or no string."""
    found = element if isinstance(element, dict) else {}
    return {k: found[k] if isinstance(found.get(k), str) else None for k in fields}


def _faults(rules: Mapping[str, Rule], strings: Mapping[str, str | None], facts: Mapping[str, Any]) -> Iterator[str]:
    for name, rule in rules.items():
        value = strings[rule.field]
        if value is None or rule.value(value, facts):
            yield name


def topic_faults(topics: Any) -> list[str]:
    """Every broken rule of the topics of an answer, in order; none if they may be used."""
    if not isinstance(topics, list) or not topics:
        return ["topics: no list, or an empty one"]
    rows = [_strings(t, {r.field for r in TOPIC_RULES.values()}) for t in topics]
    uses = Counter(r["name"].casefold() for r in rows if r["name"] is not None)
    return [f"topic {pos}: {fault}" for pos, r in enumerate(rows, 1) for fault in _faults(TOPIC_RULES, r, {"pos": pos, "uses": uses[(r["name"] or "").casefold()]})]


def assignment_faults(answer: Any, topic_ids: set[str], summary: str) -> list[str]:
    """Every broken rule of the answer for one class, in order."""
    given = answer.get("assignments") if isinstance(answer, dict) else None
    if not isinstance(given, list):
        return ["assignments: no list"]
    rows = [_strings(a, {r.field for r in ASSIGNMENT_RULES.values()}) for a in given]
    uses, body = Counter(r["topic_id"] for r in rows), plain_evidence(summary)
    out = [f"assignment {pos}: {fault}" for pos, r in enumerate(rows, 1) for fault in _faults(ASSIGNMENT_RULES, r, {"known": r["topic_id"] in topic_ids, "uses": uses[r["topic_id"]], "body": body})]
    reason = _strings(answer, {"unmatched_reason"})["unmatched_reason"]
    return out if reason is not None and bool(reason if given else reason.strip()) is not bool(given) else [*out, "unmatched_reason"]


def accepted(value: Any, faults: list[str]) -> Any:
    """``value``, if nothing is wrong with it."""
    if faults:
        raise ValueError("; ".join(faults))
    return value


def check_topics(topics: Any) -> list[dict]:
    """The topics of an answer; ValueError with all that is wrong with them."""
    return accepted(topics, topic_faults(topics))


def check_assignment(answer: Any, topic_ids: set[str], summary: str) -> dict:
    """The answer for one class; ValueError with all that is wrong with it."""
    return accepted(answer, assignment_faults(answer, topic_ids, summary))
