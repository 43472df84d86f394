"""Line deduplication by a log-template tree: recurring templates across documents are dropped, but in one document of those that have them."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lectern.llm.common import BROADCAST_ROWS, HOT, TASK_ROWS, _arrow, bounded_batches, cut, meet, release, unused
from lectern.llm.simhash import components

#: Leading tokens that, after the token count, lead to a leaf of the tree.
DEPTH = 3
#: Tokens from which a template recurs by standing in two documents; a shorter line, down to SHORTEST tokens, needs SHORT_ROWS rows.
LONG, SHORTEST, SHORT_ROWS = 12, 3, 10
#: Parts of a line's tokens after the leading ones; lines of a leaf that differ within one part alone are of one template.
PARTS = 4
#: Tokens from which a sentence is a unit of its own.
SENTENCE = 8
#: Of so many adjacent grams of LONG tokens, the one of the least hash is an anchor; LONG + REACH - 1 tokens in a row that two documents share have one in common.
REACH = 28
#: Bytes of recurring places that are broadcast at most; more meet the texts in a shuffled join.
BROADCAST_BYTES = 32 << 20
#: Bytes of texts whose tokens are worked on at once, or one longer text.
_GROUP = 1 << 18

_SOLID = np.ones(256, np.int8)
_SOLID[[9, 10, 11, 12, 13, 32]] = 0
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C1B
_BACK = pow(_BASE, -1, 1 << 64)
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_FIELD, _LINE, _SENTENCE, _GRAM, _KEY = (np.uint64(x * 0xD6E8FEB86659FD93 & _MASK) for x in range(3, 8))


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, by in ((30, _MIX[0]), (27, _MIX[1])):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return x ^ (x >> np.uint64(31))


_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64))
_POWERS: dict[int, np.ndarray] = {}


def _powers(n: int, base: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1); kept from one group of texts to the next, up to a bound."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 2 * _GROUP), base, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if len(have) <= 4 * _GROUP:
            _POWERS[base] = have
    return have[:n]


def _sums(values: np.ndarray) -> np.ndarray:
    """Sums of the values before each place, and of all, each value times its place's power."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(len(values), _BASE), out=out[1:])
    return out


def _between(sums: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What the values of places a to b add up to, wherever they stand."""
    return (sums[b] - sums[a]) * _powers(len(sums), _BACK)[a]


def _slide(least_or_most, x: np.ndarray, width: int) -> np.ndarray:
    """least_or_most over each ``width`` adjacent values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = least_or_most(x[: len(x) - step], x[step:])
        have += step
    return x


class Bounds(NamedTuple):
    """Where tokens (runs of bytes other than ASCII white space) begin and end, and the number of the line that each stands in."""

    first: np.ndarray
    end: np.ndarray
    line: np.ndarray


def bounds_of(raw: np.ndarray) -> Bounds:
    solid = np.zeros(len(raw) + 2, np.int8)
    solid[1:-1] = _SOLID[raw]
    edge = solid[1:] - solid[:-1]
    first = np.flatnonzero(edge == 1)
    return Bounds(first, np.flatnonzero(edge == -1), np.cumsum(raw == 10, dtype=np.int32)[first] if len(first) else np.zeros(0, np.int32))


class Tokens:
    """The tokens of some texts. ``at``: each text's first token, and the number of all at the end.

    A token with a digit is a variable field; all fields have one code. A hash of tokens a to b comes from prefix sums of their codes, so its cost does not
    depend on their number."""

    def __init__(self, bodies: list[bytes]) -> None:
        raw = np.frombuffer(b"\n".join(bodies), np.uint8)
        first, end, self.line = bounds_of(raw)
        n = len(first)
        code = np.zeros(n, np.uint64)
        steps = np.unique(np.searchsorted(first, np.arange(0, len(raw), 4 * _GROUP)))
        for i, j in zip(steps.tolist(), [*steps[1:].tolist(), n], strict=True):  # long texts by parts, which begin with a token
            if i < j:
                begin = first[i]
                code[i:j] = _between(_sums(_BYTE[raw[begin : end[j - 1]]]), first[i:j] - begin, end[i:j] - begin)
        code = _mixed(code + (end - first).astype(np.uint64))
        digits = np.flatnonzero((raw - np.uint8(48)) < 10)
        if len(digits):
            code[np.searchsorted(first, digits, "right") - 1] = _FIELD
        self.at = np.searchsorted(first, np.cumsum([0, *(len(b) + 1 for b in bodies)]))
        last = raw[end - 1] if n else raw[:0]
        self.stop = (last == 46) | (last == 33) | (last == 63)
        if (last == 0xA6).any():
            self.stop |= (last == 0xA6) & (raw[end - 2] == 0x80) & (raw[end - 3] == 0xE2)
        self._sum = _sums(code)

    def hash(self, a: np.ndarray, b: np.ndarray, tag: np.uint64) -> np.ndarray:
        return _mixed(_between(self._sum, a, b) + _mixed((b - a).astype(np.uint64) + tag))

    def text_of(self, tokens: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.at, tokens, "right") - 1

    def spans(self, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first tokens, ends) of what ends at the tokens marked in ``last``."""
        ends = np.flatnonzero(last) + 1
        return np.concatenate((np.zeros(1, np.int64), ends[:-1])), ends

    def grams(self) -> np.ndarray:
        """A hash for each LONG adjacent tokens, of one text or of several."""
        a = np.arange(max(0, len(self.line) - LONG + 1))
        return self.hash(a, a + LONG, _GRAM)


def _again(text: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Whether a text has had t before."""
    order = np.lexsort((np.arange(len(t)), t, text))
    same = (t[order][1:] == t[order][:-1]) & (text[order][1:] == text[order][:-1])
    out = np.zeros(len(t), bool)
    out[order[1:][same]] = True
    return out


class Units(NamedTuple):
    """Parallel arrays of the units of some texts, and where each text's begin."""

    t: np.ndarray
    place: np.ndarray
    n: np.ndarray  # negative if the text has had t before
    more: tuple[np.ndarray, ...]
    at: np.ndarray


def _units(tokens: Tokens, a: np.ndarray, b: np.ndarray, tag: np.uint64) -> Units:
    t, text = tokens.hash(a, b, tag), tokens.text_of(a)
    n = (b - a).astype(np.int32)
    return Units(t, (a - tokens.at[text]).astype(np.int32), np.where(_again(text, t), -n, n), (), np.searchsorted(a, tokens.at))


def lines_of(tokens: Tokens) -> Units:
    """Lines of SHORTEST or more tokens. ``more``: the PARTS keys of each, of which each leaves one part out; 0 for lines under LONG tokens."""
    a, b = tokens.spans(np.append(np.diff(tokens.line) != 0, True)[: len(tokens.line)])
    a, b = a[: len(b)], b
    enough = b - a >= SHORTEST
    a, b = a[enough], b[enough]
    out = _units(tokens, a, b, _LINE)
    keys = np.zeros((len(a), PARTS), np.uint64)
    far = b - a >= LONG
    x, y = a[far], b[far]
    at = [x + DEPTH + (y - x - DEPTH) * k // PARTS for k in range(PARTS + 1)]
    parts = [tokens.hash(at[k], at[k + 1], _KEY) * np.uint64(2 * k + 3) for k in range(PARTS)]
    whole = sum(parts) + tokens.hash(x, x + DEPTH, _KEY) + _mixed((y - x).astype(np.uint64))
    for k in range(PARTS):
        keys[far, k] = _mixed(whole - parts[k] + np.uint64(k))
    return out._replace(more=(keys.reshape(-1),))


def sentences_of(tokens: Tokens) -> Units:
    """Sentences of SENTENCE or more tokens: they end at a full stop, exclamation or question mark or ellipsis, and with their line."""
    a, b = tokens.spans(np.append(np.diff(tokens.line) != 0, True)[: len(tokens.line)] | tokens.stop)
    a = a[: len(b)]
    enough = b - a >= SENTENCE
    return _units(tokens, a[enough], b[enough], _SENTENCE)


def anchors_of(tokens: Tokens) -> Units:
    """Anchors: grams of the least hash among REACH adjacent ones of a text. ``more``: the way to the next anchor of the text, at most REACH tokens, and a
    hash of all tokens to that one's end; both 0 for the last anchor. What two texts share gets the same anchors, whatever stands around it."""
    gram = tokens.grams()
    end = np.repeat(tokens.at[1:], np.diff(tokens.at))[: len(gram)]
    at = np.arange(len(gram))
    least = _slide(np.minimum, gram, REACH) if len(gram) >= REACH else gram[:0]
    least = np.where(at[: len(least)] + REACH + LONG - 1 <= end[: len(least)], least, np.uint64(0))
    pad = np.zeros(REACH - 1, np.uint64)
    a = np.flatnonzero((_slide(np.maximum, np.concatenate((pad, least, pad)), REACH) == gram) & (at + LONG <= end)) if len(least) else at[:0]
    text = tokens.text_of(a)
    way, run = np.zeros(len(a), np.int8), np.zeros(len(a), np.int32)
    on = np.flatnonzero(text[1:] == text[:-1])
    way[on] = a[on + 1] - a[on]
    run[on] = (tokens.hash(a[on], a[on + 1] + LONG, _GRAM) >> np.uint64(33)).astype(np.int32) + 1
    return Units(gram[a], (a - tokens.at[text]).astype(np.int32), way, (run,), np.searchsorted(a, tokens.at))


def grams_beside(tokens: Tokens, asked: list[list[int]]) -> Units:
    """The grams within REACH places before (1), after (2) or on both sides (3) of the asked anchors (place * 4 + side) of each text."""
    gram = tokens.grams()
    edge = np.zeros(len(gram) + 2, np.int32)
    for k, own in enumerate(asked):
        place, side = np.divmod(np.asarray(own, np.int64), 4)
        lo, hi = tokens.at[k], max(tokens.at[k], tokens.at[k + 1] - LONG + 1)
        place += lo
        np.add.at(edge, np.clip(np.where(side % 2, place - REACH, place + 1), lo, hi), 1)
        np.add.at(edge, np.clip(np.where(side >= 2, place + REACH + 1, place), lo, hi), -1)
    a = np.flatnonzero(np.cumsum(edge)[: len(gram)] > 0)
    return Units(gram[a], (a - tokens.at[tokens.text_of(a)]).astype(np.int32), np.full(len(a), LONG, np.int32), (), np.searchsorted(a, tokens.at))


def _groups(bodies: list[bytes]) -> Iterator[slice]:
    """Texts of _GROUP bytes together, or one longer text."""
    at = size = 0
    for k, body in enumerate(bodies):
        if size and size + len(body) > _GROUP:
            yield slice(at, k)
            at, size = k, 0
        size += len(body) + 1
    if bodies:
        yield slice(at, len(bodies))


def _lists(parts: list[np.ndarray], ats: list[np.ndarray], kind: pa.DataType, times: int = 1) -> pa.Array:
    """One list for each text from the arrays of its group."""
    values = np.concatenate([np.ascontiguousarray(p).view(np.int64) if p.dtype == np.uint64 else p for p in parts])
    offsets, base = [np.zeros(1, np.int64)], 0
    for at in ats:
        offsets.append(at[1:] * times + base)
        base += at[-1] * times
    return pa.ListArray.from_arrays(pa.array(np.concatenate(offsets), pa.int32()), pa.array(values, kind))


_PARSED = "h bigint, lt array<bigint>, ln array<int>, lp array<int>, lk array<bigint>, st array<bigint>, sn array<int>, sp array<int>, at array<bigint>, aw array<tinyint>, ap array<int>, ar array<int>"


def parse(source: DataFrame) -> DataFrame:
    """(doc_id, h, ...) of (doc_id, h, __text): arrays of the lines, sentences and anchors of each text, which take a third of the room of rows."""
    schema = StructType([source.schema["doc_id"], *StructType.fromDDL(_PARSED)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [b or b"" for b in batch.column(2).cast(pa.binary()).to_pylist()]
            lines, sentences, anchors = [], [], []
            for part in _groups(bodies):
                tokens = Tokens(bodies[part])
                lines.append(lines_of(tokens))
                sentences.append(sentences_of(tokens))
                anchors.append(anchors_of(tokens))
            if not bodies:
                continue
            columns = [batch.column(0), batch.column(1)]
            for units, kinds in ((lines, (pa.int32(), pa.int64())), (sentences, (pa.int32(),)), (anchors, (pa.int8(), pa.int32()))):
                ats = [u.at for u in units]
                columns += [_lists([u.t for u in units], ats, pa.int64()), _lists([u.n for u in units], ats, kinds[0]), _lists([u.place for u in units], ats, pa.int32())]
                columns += [_lists([u.more[0] for u in units], ats, kinds[1], PARTS if units is lines else 1)] if len(kinds) > 1 else []
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.select("doc_id", "h", "__text").mapInArrow(run, schema)


def parse_beside(source: DataFrame) -> DataFrame:
    """(doc_id, h, t, p): grams_beside() the places ``asked`` of (doc_id, h, __text, asked)."""
    schema = StructType([source.schema["doc_id"], *StructType.fromDDL("h bigint, t array<bigint>, p array<int>")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, asked = [b or b"" for b in batch.column(2).cast(pa.binary()).to_pylist()], batch.column(3).to_pylist()
            units = [grams_beside(Tokens(bodies[part]), asked[part]) for part in _groups(bodies)]
            if units:
                ats = [u.at for u in units]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _lists([u.t for u in units], ats, pa.int64()), _lists([u.place for u in units], ats, pa.int32())], names=schema.names)

    return source.select("doc_id", "h", "__text", "asked").mapInArrow(run, schema)


def _rows(parsed: DataFrame, t: str, **others: Column) -> DataFrame:
    """A row for each element of the array ``t``; ``others``: what else to take, at its number i."""
    return parsed.select("*", F.posexplode(t).alias("i", "unit")).select("doc_id", "h", F.col("unit").alias("t"), *(c.alias(name) for name, c in others.items()))


def _spread() -> list[Column]:
    """Numbers alone, so that these sums are hash aggregates: a template recurs if two documents have it; it stays in the one of the smallest hash."""
    return [F.count("*").alias("uses"), F.min("h").alias("kept"), F.max("h").alias("other")]


def recurring_lines(lines: DataFrame, **limits: int) -> DataFrame:
    """(t, kept, uses): line templates that recur across documents, and the smallest hash of a document that has one.

    Equal lines are one row after a map-side combined count. Distinct lines meet by key in minima, not in pairs, and the links make components."""
    keys = [f"k{k}" for k in range(PARTS)]
    distinct = cut(lines.groupBy("t").agg(*_spread(), F.count_if(F.col("n") > 0).alias("rows"), F.max("n").alias("n"), *(F.max(k).alias(k) for k in keys)), 4)
    pairs = distinct.where(F.col("n") >= LONG).select("t", F.explode(F.array(*keys)).alias("key"))
    groups = cut(pairs.groupBy("key").agg(F.min("t").alias("m"), F.max("t").alias("x"), F.count("*").alias("uses")).where("m <> x").select("key", "m", "uses"), 4)
    of = cut(components(meet(pairs, groups, "key", **limits).where("t <> m").select(F.col("t").alias("u"), F.col("m").alias("v")).distinct()).select(F.col("node").alias("t"), "root", F.lit(1).alias("uses")), 4)
    recurs = (F.col("kept") != F.col("other")) & ((F.col("n") >= LONG) | (F.col("rows") >= SHORT_ROWS))
    alone = distinct.where(recurs).select("t", "kept", "uses").join(of, "t", "left_anti")
    joined = cut(meet(distinct.drop(*keys), of, "t", **limits), 4)
    total = joined.groupBy("root").agg(F.sum("rows").alias("rows"), F.max("n").alias("n"), F.min("kept").alias("kept"), F.max("other").alias("other"), F.count("*").alias("uses"))
    often = cut(total.where(recurs).select("root", F.col("kept").alias("first"), "uses"), 4)
    members = meet(joined.select("t", "root", F.col("uses").alias("times")), often, "root", **limits)
    return alone.unionByName(members.select("t", F.col("first").alias("kept"), F.col("times").alias("uses")))


def recurring(rows: DataFrame, *more: Column) -> DataFrame:
    """(t, kept, uses) and ``more`` of templates that recur."""
    return rows.groupBy("t").agg(*_spread(), *more).where("kept <> other").drop("other")


def _lost(rows: DataFrame) -> DataFrame:
    """(doc_id, h, gone: place and number of tokens) of what is dropped: of a recurring template, all but what the kept document has first."""
    return rows.where((F.col("h") != F.col("kept")) | (F.col("n") < 0)).select("doc_id", "h", (F.col("place").cast("long") * (1 << 31) + F.abs("n")).alias("gone"))


def without(body: bytes, gone: np.ndarray) -> tuple[bytes, int, int]:
    """(text, lines dropped, cuts within lines): the text without the tokens of ``gone`` (first * 2 ** 31 + number), each with the white space before it.

    A line that loses all its tokens goes with its end."""
    raw = np.frombuffer(body, np.uint8)
    first, end, line = bounds_of(raw)
    n = len(first)
    if not n:
        return body, 0, 0
    edge = np.zeros(n + 1, np.int32)
    place = np.minimum(gone >> 31, n)
    np.add.at(edge, place, 1)
    np.add.at(edge, np.minimum(place + (gone & ((1 << 31) - 1)), n), -1)
    flag = np.cumsum(edge)[:n] > 0
    heads = np.concatenate((np.zeros(1, np.int64), np.flatnonzero(raw == 10) + 1, np.full(1, len(raw) + 1)))  # where lines begin, and one past the end
    opens = np.append(True, line[1:] != line[:-1])
    at = np.flatnonzero(opens)
    whole = np.logical_and.reduceat(flag, at)  # by line with tokens
    dropped = line[at[whole]]
    mixed = flag & ~np.repeat(whole, np.diff(np.append(at, n)))
    begin = np.where(opens, heads[line], np.append(0, end[:-1]))
    change = np.zeros(len(raw) + 2, np.int32)
    np.add.at(change, np.concatenate((begin[mixed], heads[dropped])), 1)
    np.add.at(change, np.concatenate((end[mixed], heads[dropped + 1])), -1)
    out = raw[np.cumsum(change)[: len(raw)] == 0].tobytes()
    if len(dropped) and dropped[-1] == len(heads) - 2 and len(dropped) < len(heads) - 1:
        out = out[:-1]  # the last line is gone, so the one before it needs no end
    return out, len(dropped), int((mixed & (opens | ~np.append(False, mixed[:-1]))).sum())


def dedup_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", task_rows: int = TASK_ROWS, hot: int = HOT, broadcast_rows: int = BROADCAST_ROWS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` with every recurring passage left in one document alone, and n_lines, n_dropped (lines) and n_cut (cuts within lines) added (columns of
    these names are replaced).

    The tree: a line goes by its token count and its first DEPTH tokens to a leaf; in a leaf, lines that differ in variable fields (tokens with a
    digit) or within one of PARTS parts of the other tokens are one template. Sentences of SENTENCE or more tokens, equal but for fields, are templates of
    their own. So are the grams of LONG tokens of a passage that lines do not show, as it stands within other lines or is wrapped in other ways: an anchor
    that recurs leads to them, and where what follows or goes before it is not the same in all documents that have it, all grams up to REACH places on that
    side are looked at. So LONG + REACH - 1 tokens in a row or more that two documents share are found to their last word; fewer, from LONG tokens on, if they
    are whole lines or sentences or hold an anchor.

    A template of two documents (lines under LONG tokens: of SHORT_ROWS) stays in the one of the smallest hash of id and text, there once. No document is
    exempt: exact copies are documents too, and those of a text of LONG or more tokens lose all of it without a look at its units. Rows of equal
    id and text are one document. Tokens of any length and texts of any length are taken whole, one text's tokens at a time. A null text stays null, with
    no lines; an empty one is one line. An empty table gives an empty one. The last arguments are those of meet(), and the rows and bytes that are broadcast where texts meet ids; more meet them in a shuffled join."""
    limits = {"task_rows": task_rows, "hot": hot}
    spark = docs.sparkSession
    docs = docs.drop("n_lines", "n_dropped", "n_cut")
    bounded_batches(spark)
    key = F.xxhash64(F.col(doc_id), F.col(text))
    source = docs.select(F.col(doc_id).alias("doc_id"), key.alias("h"), F.xxhash64(F.col(text)).alias("whole"), F.col(text).alias("__text"))
    narrow = cut(source.where(F.col("__text").rlike(f"(?:\\S+\\s+){{{LONG - 1}}}\\S")).select("doc_id", "h", "whole"), 4)
    texts = cut(narrow.groupBy("whole").agg(F.min("h").alias("kept"), F.max("h").alias("other"), F.count("*").alias("uses")).where("kept <> other").drop("other"), 4)
    copies = cut(meet(narrow, texts, "whole", **limits).where("h <> kept").select("doc_id", "h").distinct(), 4)
    by_row = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("h") == F.col("__h"))
    taken = copies.select(F.col("doc_id").alias("__id"), F.col("h").alias("__h"))
    source = source.join(F.broadcast(taken) if copies.count() <= broadcast_rows else taken.hint("merge"), by_row, "left_anti")
    parsed = cut(parse(source))
    long = F.abs(F.get("ln", F.col("i"))) >= LONG
    lines = _rows(parsed, "lt", n=F.get("ln", F.col("i")), place=F.get("lp", F.col("i")), **{f"k{k}": F.when(long, F.get("lk", F.col("i") * PARTS + k)) for k in range(PARTS)})
    known = cut(recurring_lines(lines, **limits), 4)
    release(spark)
    gone = _lost(meet(lines, known, "t", **limits))
    sentences = _rows(parsed, "st", n=F.get("sn", F.col("i")), place=F.get("sp", F.col("i")))
    gone = cut(gone.unionByName(_lost(meet(sentences, cut(recurring(sentences), 4), "t", **limits))))
    del lines, sentences, known
    release(spark)
    before = F.when(F.col("i") > 0, F.get("ar", F.col("i") - 1)).otherwise(0)
    anchors = _rows(parsed, "at", place=F.get("ap", F.col("i")), way=F.get("aw", F.col("i")).cast("int"), after=F.get("ar", F.col("i")), before=before)
    found = cut(meet(anchors, cut(recurring(anchors), 4), "t", **limits), 4)
    del parsed, anchors
    release(spark)
    same = [((F.min(c) == F.max(c)) & (F.min(c) != 0)).alias(f"same_{c}") for c in ("before", "after")]
    found = meet(found, cut(found.groupBy("t").agg(F.count("*").alias("uses"), *same), 4), "t", **limits)
    side = F.when(F.col("same_before"), 0).otherwise(1) + F.when(F.col("same_after"), 0).otherwise(2)
    found = found.select("doc_id", "h", "kept", "place", F.when(F.col("same_after"), F.col("way") + LONG).otherwise(LONG).alias("n"), side.alias("side"))
    asked = cut(found.where("side > 0").groupBy("doc_id", "h").agg(F.collect_set(F.col("place").cast("long") * 4 + F.col("side")).alias("asked")), 4)
    size = asked.agg(F.coalesce(F.sum(F.size("asked") * 8 + 64), F.lit(0))).first()[0]
    asked = asked.withColumnsRenamed({"doc_id": "__id", "h": "__h"})
    beside = cut(parse_beside(source.join(F.broadcast(asked) if size <= broadcast_bytes else asked, by_row)))
    grams = _rows(beside, "t", place=F.get("p", F.col("i")), n=F.lit(LONG))
    gone = gone.unionByName(_lost(found)).unionByName(_lost(meet(grams, cut(recurring(grams), 4), "t", **limits)))
    gone = gone.unionByName(copies.select("doc_id", "h", F.lit((1 << 31) - 1).cast("long").alias("gone")))
    own, hashed, lost, row = (unused(docs, x) for x in ("__id", "__h", "__gone", "__key"))
    drops = cut(gone.groupBy(F.col("doc_id").alias(own), F.col("h").alias(hashed)).agg(F.collect_list("gone").alias(lost)), 4)
    del gone, found, grams, beside, asked, source, copies, taken
    release(spark)
    named = docs.withColumn(row, key)
    here = lambda df: df.join(drops, df[doc_id].eqNullSafe(F.col(own)) & (df[row] == F.col(hashed)), "left").select(*docs.columns, lost)
    if drops.count() <= broadcast_rows:  # then texts that lose nothing stay where they are
        hashes = F.broadcast(drops.select(hashed).distinct())
        moved = here(named.join(hashes, named[row] == F.col(hashed), "left_semi"))
        joined = moved.unionByName(named.join(hashes, named[row] == F.col(hashed), "left_anti").select(*docs.columns, F.lit(None).cast("array<bigint>").alias(lost)))
    else:
        joined = here(named)
    schema = StructType([*docs.schema, *StructType.fromDDL("n_lines bigint, n_dropped bigint, n_cut bigint")])
    where, width = docs.columns.index(text), len(docs.columns)
    kind = _arrow(docs.schema[text].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for body, places in zip(batch.column(where).cast(pa.binary()).to_pylist(), batch.column(width), strict=True):
                n_lines = 0 if body is None else body.count(b"\n") + 1
                made.append((n_lines, *((body, 0, 0) if body is None or not places.is_valid else without(body, places.values.to_numpy()))))
            counts, bodies, dropped, cuts = zip(*made, strict=True) if made else [()] * 4
            arrays = [batch.column(k) for k in range(width)]
            arrays[where] = pa.array(bodies, pa.binary()).cast(kind)
            yield pa.RecordBatch.from_arrays([*arrays, *(pa.array(x, pa.int64()) for x in (counts, dropped, cuts))], names=schema.names)

    return joined.mapInArrow(run, schema)
