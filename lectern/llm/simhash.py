"""SimHash fingerprints, their links within a Hamming distance, and the groups that these make."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import HOT, TASK_ROWS, cut, map_column, meet, narrow_batches, unmet, unused

SHINGLE, BITS, SEED, DISTANCE = 4, 64, 42, 4
#: A ring of 16 segments of 4 bits. Of two fingerprints within 4 bits, some start has every chain of l segments within l * 4 / 16 bits.
SEGMENTS = 16
#: Fingerprints of one bucket that one task compares at once; larger buckets are dealt to pairs of blocks.
BLOCK = 4096
#: Rounds of star steps after which components() gives up; their number grows as the logarithm of the longest way between nodes.
ROUNDS = 200
_STEP = 1 << 14


def fingerprint(text: bytes | None, width: int = SHINGLE) -> int:
    """Signed 64-bit SimHash: the majority, bit by bit, of XXH64 over the shingles of ``width`` words, repeats included. No words: 0."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - width + 1
    if n <= 1:
        return int(np.uint64(xxhash.xxh64_intdigest(joined, SEED)).astype(np.int64))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[width - 1 :].tolist(), strict=True)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for k in range(0, n, _STEP):
        part = hashes[k : k + _STEP]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of ``text`` (a signed 64-bit integer) instead of it. A narrow map."""
    docs = docs.drop(out)
    body = unused(docs, "__text")
    return map_column(docs.withColumnRenamed(text, body), body, f"`{out}` bigint", lambda batch: {out: [fingerprint(x) for x in batch]})


def forms(bits: int) -> list[tuple[int, ...]]:
    """For keys of 20, 24 or 32 bits: the segments, counted from a start, that two fingerprints have equal in one form at least.

    With 4 bits to differ in, chains of 1 to 3 segments must be equal, so segments 0-2 are. A chain of 7 differs in one bit at most, so of segments 3-6
    one half, and three of the four, are equal. A chain of 11 differs in two bits at most, so of segments 7-10 two at least are equal."""
    if bits == 20:
        return [(0, 1, 2, 3, 4), (0, 1, 2, 5, 6)]
    three = [(0, 1, 2, *(x for x in range(3, 7) if x != out)) for out in range(3, 7)]
    return three if bits == 24 else [(*first, i, j) for first in three for i in range(7, 11) for j in range(i + 1, 11)]


def key_bits(n: int) -> int:
    """The key width for ``n`` distinct fingerprints. Every width finds every link; wider keys keep chance meetings in a bucket few."""
    return 20 if n < 1 << 25 else 24 if n < 1 << 29 else 32


#: The key widths, and what stands in front of a key: its width, start and form, as one number of 10 bits.
WIDTHS = (20, 24, 32)


def ring_keys(distinct: DataFrame, bits: int = 20) -> DataFrame:
    """(fp, key): at each of the 16 starts, a key for each of forms()."""
    return keys_at(distinct.select("fp", F.explode(F.sequence(F.lit(0), F.lit(SEGMENTS - 1))).alias("start")), bits)


def keys_at(starts: DataFrame, bits: int) -> DataFrame:
    """(fp, key) for each of forms() at the starts of (fp, start)."""
    turned = F.expr("shiftleft(fp, 4 * start) | shiftrightunsigned(fp, 64 - 4 * start)")  # a shift by 64 is one by 0
    keys = []
    for k, form in enumerate(forms(bits)):
        key = (F.lit((WIDTHS.index(bits) * SEGMENTS) << 5 | k) + F.shiftleft("start", 5)).cast("long")
        for segment in form:
            key = F.shiftleft(key, 4).bitwiseOR(F.shiftrightunsigned("turned", 60 - 4 * segment).bitwiseAND(F.lit(15).cast("long")))
        keys.append(F.shiftleft(key, 32 - bits))
    return starts.select("fp", F.col("start").cast("int").alias("start")).select("fp", "start", turned.alias("turned")).select("fp", F.explode(F.array(*keys)).alias("key"))


def pigeonring(xor: np.ndarray, start: int, distance: int = DISTANCE) -> np.ndarray:
    """Whether chains of every length from ``start`` keep within their proportional budgets; ``xor``: uint64."""
    turned = xor if start == 0 else (xor << np.uint64(4 * start)) | (xor >> np.uint64(64 - 4 * start))
    ok = np.ones(xor.shape, bool)
    for length in (3, 7, 11, 15):  # between these the budget, rounded down, does not change
        chain = turned >> np.uint64(64 - 4 * length)
        ok &= np.bitwise_count(chain) <= length * distance // SEGMENTS
    return ok


def _forest(fps: np.ndarray, start: int) -> list[tuple[int, int]]:
    """Links that join what is joined within ``fps``: a spanning forest by breadth-first search, not all pairs."""

    def near(rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        xor = rows[:, None] ^ cols[None, :]
        ok = pigeonring(xor, start)
        ok[ok] = np.bitwise_count(xor[ok]) <= DISTANCE
        return ok

    if len(fps) <= 64 and np.count_nonzero(near(fps, fps)) == len(fps):
        return []
    signed, out, rest = fps.view(np.int64), [], np.arange(1, len(fps))
    frontier = np.array([0])
    while len(rest):
        found = np.zeros(0, np.int64)
        rows = max(1, (1 << 20) // len(rest))
        for k in range(0, len(frontier), rows):
            if not len(rest):
                break
            part = frontier[k : k + rows]
            ok = near(fps[part], fps[rest])
            hit = ok.any(axis=0)
            if hit.any():
                out += zip(signed[part[ok[:, hit].argmax(axis=0)]].tolist(), signed[rest[hit]].tolist(), strict=True)
                found, rest = np.concatenate((found, rest[hit])), rest[~hit]
        if len(found):
            frontier = found
        else:
            frontier, rest = rest[:1], rest[1:]
    return out


def _links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by key, a and b (the pair of blocks) come in; one bucket or pair of blocks is held at a time."""
    held: list[pd.DataFrame] = []

    def run(g: pd.DataFrame) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        key, fp = g["key"].to_numpy(), g["fp"].to_numpy().view(np.uint64)
        change = np.flatnonzero((key[1:] != key[:-1]) | (g["a"].to_numpy()[1:] != g["a"].to_numpy()[:-1]) | (g["b"].to_numpy()[1:] != g["b"].to_numpy()[:-1])) + 1
        edges = np.concatenate(([0], change, [len(g)]))
        for i in np.flatnonzero(np.diff(edges) > 1):
            lo, hi = edges[i], edges[i + 1]
            start = int(key[lo] >> 37) % SEGMENTS
            if hi - lo > 2 or int(fp[lo] ^ fp[lo + 1]).bit_count() <= DISTANCE:
                out += _forest(fp[lo:hi], start)
        return out

    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        last = batch.iloc[-1]
        first = batch.iloc[0]
        if all(first[c] == last[c] for c in ("key", "a", "b")):
            continue
        g = pd.concat(held)
        same = (g["key"].to_numpy() == last["key"]) & (g["a"].to_numpy() == last["a"]) & (g["b"].to_numpy() == last["b"])
        held = [g[same]]
        if out := run(g[~same]):
            yield pd.DataFrame(out, columns=["u", "v"])
    if held and (out := run(pd.concat(held))):
        yield pd.DataFrame(out, columns=["u", "v"])


def links(distinct: DataFrame, block: int = BLOCK, bits: int | None = None, task_rows: int = TASK_ROWS, hot: int = HOT) -> DataFrame:
    """Links (u, v) between the distinct fingerprints in column ``fp`` that join exactly what links within 4 bits join.

    The fingerprints of a bucket of more than ``block`` get the wider keys of the same start, up to 32 bits: two that are to meet at a start are equal in one
    form of every width. What is larger still is dealt to tasks by pairs of its blocks, so no task holds more than two blocks."""
    width = bits or key_bits(distinct.count())
    keyed, dealt = ring_keys(distinct.select("fp"), width), []
    for wider in (*(w for w in WIDTHS if w > width), None):
        large = cut(keyed.groupBy("key").agg(F.count("*").alias("uses")).where(F.col("uses") > block).withColumn("blocks", F.ceil(F.col("uses") / block).cast("int")), 1)
        if large.isEmpty():
            break
        dealt.append(unmet(keyed, large, "key", task_rows, hot).select("key", F.lit(0).alias("a"), F.lit(0).alias("b"), "fp"))
        crowded = meet(keyed, large, "key", task_rows, hot)
        if wider is None:
            own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
            others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: o != own)
            pairs = F.transform(others, lambda o: F.struct(F.least(own, o).alias("a"), F.greatest(own, o).alias("b")))
            keyed = crowded.select("key", "fp", F.explode(pairs).alias("p")).select("key", "p.a", "p.b", "fp")
        else:
            keyed = cut(keys_at(crowded.select("fp", F.shiftright("key", 37).bitwiseAND(F.lit(15).cast("long")).alias("start")).distinct(), wider))
    if "a" not in keyed.columns:
        keyed = keyed.select("key", F.lit(0).alias("a"), F.lit(0).alias("b"), "fp")
    for more in dealt:
        keyed = keyed.unionByName(more)
    keyed = keyed.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b")
    return keyed.mapInPandas(_links, "u bigint, v bigint").distinct()


def components(edges: DataFrame, rounds: int = ROUNDS, task_rows: int = TASK_ROWS, hot: int = HOT) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root: the smallest node of its component. RuntimeError if it is not stable after ``rounds`` rounds.

    Alternating large-star and small-star steps, each a map-side combined minimum and an equi-join; no neighbourhood is gathered. While there are more than
    ``task_rows`` edges, a node of very many is met apart, as meet() has it."""

    def star(e: DataFrame, large: bool, many: bool) -> DataFrame:
        both = e.select(F.col("u").alias("n"), F.col("v").alias("w")).union(e.select("v", "u")) if large else e.select(F.greatest("u", "v").alias("n"), F.least("u", "v").alias("w"))
        low = both.groupBy("n").agg(F.min("w").alias("m"), F.count("*").alias("uses")).select("n", F.least("n", "m").alias("m"), "uses")
        joined = meet(both, cut(low, 4), "n", task_rows, hot) if many else both.join(low.drop("uses"), "n")
        if large:
            return joined.where("w > n").select(F.col("w").alias("u"), F.col("m").alias("v")).distinct()
        return joined.select(F.col("w").alias("u"), F.col("m").alias("v")).union(low.select(F.col("n").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()

    edges = cut(edges.where("u <> v"), 4)
    state = None
    for _ in range(rounds):
        many = edges.count() > task_rows if state is None else state[0] > task_rows
        edges = cut(star(star(edges, True, many), False, many), 4)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v"), F.col("v"))).distinct()
        state = now
    raise RuntimeError(f"the components are not stable after {rounds} rounds")


def group_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", task_rows: int = TASK_ROWS, hot: int = HOT) -> DataFrame:
    """``docs`` without ``text``, with ``fingerprint`` (bigint) and ``component_id``.

    Fingerprints within 4 bits link; a component's id is the smallest ``doc_id`` in it (null where all are null). Every row keeps its own row, equal
    rows and null texts (fingerprint 0) included; an empty table gives an empty one. Columns of ``docs`` with these two names are replaced.

    Equal fingerprints are one node from the start, so copies never meet in pairs; a fingerprint or component of very many rows meets its id apart, as meet()
    has it."""
    narrow = cut(fingerprints(docs.drop("component_id"), text))
    grouped = cut(_roots(narrow, F.min(doc_id), task_rows, hot), 4)
    smallest = cut(grouped.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("uses")), 4)
    of = cut(meet(grouped.select("root", F.col("fp").alias("fingerprint"), F.col("uses").alias("rows")), smallest, "root", task_rows, hot).select("fingerprint", "component_id", F.col("rows").alias("uses")), 4)
    return meet(narrow, of, "fingerprint", task_rows, hot).select(*narrow.columns, "component_id")


def _roots(narrow: DataFrame, first: Column, task_rows: int, hot: int) -> DataFrame:
    """(fp, first, uses, root) for each distinct fingerprint of ``narrow``; uses: its rows."""
    nodes = cut(narrow.groupBy(F.col("fingerprint").alias("fp")).agg(first.alias("first"), F.count("*").alias("uses")))
    with narrow_batches(narrow.sparkSession):
        found = cut(components(links(nodes.select("fp"), task_rows=task_rows, hot=hot), task_rows=task_rows, hot=hot), 4)
    return nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def keep_one_of_each_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near duplicates, with all its columns: that of the smallest id (nulls last), of equal ids that of the smallest text hash.

    Only ids, hashes and fingerprints are grouped; the texts meet the chosen ids in a semi-join."""
    narrow = cut(fingerprints(docs.select(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("__body")), "__body"))
    grouped = _roots(narrow, F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h")), TASK_ROWS, HOT)
    own, hashed = unused(docs, "__id"), unused(docs, "__h")
    chosen = cut(grouped.groupBy("root").agg(F.min("first").alias("c")).select(F.col("c.id").alias(own), F.col("c.h").alias(hashed)))
    same = F.col("id").eqNullSafe(F.col(own)) & (F.col("h") == F.col(hashed))
    kept = docs.join(chosen, docs[doc_id].eqNullSafe(F.col(own)) & (F.xxhash64(docs[text]) == F.col(hashed)), "left_semi")
    repeated = narrow.join(chosen, same).groupBy("id", "h").count().where("count > 1")
    return kept if repeated.isEmpty() else kept.dropDuplicates([doc_id, text])
