"""Packing of tokenised documents into sequences of a fixed length by bin completion."""

from __future__ import annotations

import base64
import bisect
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from lectern.llm.common import bounded_batches, cut

LIMIT, END_ID = 1024, 2
#: White-space characters in a row that the fast tokenizer is given at most; it fails on about 1,000,800.
LONGEST_BLANK = 100_000
_BLANK = re.compile(r"\s+")
#: Rows that share a length are numbered in shares of about so many rows, so no length is one task's work.
ROWS_A_SHARE = 1_000
#: Nodes that the branch-and-bound search may visit after its incumbent; a search that ends there keeps its best packing, which holds every piece.
EFFORT = 3000
#: Rounds of repair, and sequences of a kind that a round takes apart.
REPAIRS, DRAWN = 16, 24
#: Fillings branched on at a node, and steps of looking for them.
WIDTH, LOOKS = 3, 300


def encoder(vocabulary: str | None = None):
    """The byte-level BPE of ``vocabulary`` (ranks); its ids are those of the same vocabulary's JSON under `tokenizers`. Control strings are ordinary text.

    tiktoken's pattern fails on runs of about a million white-space characters. So a text with a run of over LONGEST_BLANK goes to `tokenizers`, which is
    slower, takes any run, and gives the same ids."""
    import public_tokenizers
    import tiktoken

    path = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    slow = []

    def encode(text: str) -> list[int]:
        if len(text) <= LONGEST_BLANK or all(m.end() - m.start() <= LONGEST_BLANK for m in _BLANK.finditer(text)):
            return fast(text)
        if not slow:
            from tokenizers import Tokenizer

            slow.append(Tokenizer.from_file(path.removesuffix(".tiktoken") + ".json"))
            slow[0].encode_special_tokens = True
        return slow[0].encode(text, add_special_tokens=False).ids

    return encode


def pieces_of(n: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of ``n`` ids: whole if it fits, else pieces of ``limit`` after a first one that holds the remainder."""
    first = n % limit if n > limit else n
    starts = [0] if first else []
    out = [(0, first)] if first else []
    out += [(s, limit) for s in range(first, n, limit)]
    return out if starts or out else [(0, 0)]


def tokenize(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT, end_id: int = END_ID, vocabulary: str | None = None, keep_ids: bool = False) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32 (of the little-endian unsigned 32-bit ids) and, with ``keep_ids``, ids.

    Whole texts, null being empty, each followed by ``end_id``. A narrow map."""
    bounded_batches(docs.sparkSession)
    fields = [docs.select(F.col(doc_id).alias("doc_id")).schema[0], *(StructField(n, t) for n, t in (("piece", IntegerType()), ("start", LongType()), ("length", LongType()), ("ids_crc32", LongType())))]
    fields += [StructField("ids", ArrayType(IntegerType()))] if keep_ids else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            rows: list[list] = [[], [], [], [], [], []]
            for at, body in enumerate(batch.column(1).to_pylist()):
                ids = encode(body) if body else []
                ids.append(end_id)
                raw = np.array(ids, "<u4").tobytes()
                for k, (start, length) in enumerate(pieces_of(len(ids), limit)):
                    part = raw[4 * start : 4 * (start + length)]
                    for column, value in zip(rows, (at, k, start, length, zlib.crc32(part)), strict=False):
                        column.append(value)
                    if keep_ids:
                        rows[5].append(ids[start : start + length])
            arrays = [batch.column(0).take(pa.array(rows[0], pa.int64())), pa.array(rows[1], pa.int32()), *(pa.array(rows[i], pa.int64()) for i in (2, 3, 4))]
            arrays += [pa.array(rows[5], pa.list_(pa.int32()))] if keep_ids else []
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text")).mapInArrow(run, StructType(fields))


Pattern = tuple[int, tuple[int, ...]]  # how many sequences, and the lengths in each


def best_fit(counts: dict[int, int], limit: int) -> list[Pattern]:
    """Best-fit decreasing on a histogram of lengths: sequences of equal contents are handled at once."""
    open_: dict[int, dict[tuple[int, ...], int]] = {}
    room: list[int] = []

    def add(free: int, content: tuple[int, ...], k: int) -> None:
        if free not in open_:
            open_[free] = {}
            bisect.insort(room, free)
        open_[free][content] = open_[free].get(content, 0) + k

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect.bisect_left(room, length)
            if at == len(room):
                each = limit // length
                if left >= each:
                    add(limit - each * length, (length,) * each, left // each)
                    left %= each
                else:
                    add(limit - left * length, (length,) * left, 1)
                    left = 0
                continue
            free = room[at]
            content, k = next(iter(open_[free].items()))
            each = min(free // length, left)
            m = min(k, left // each)
            if m == k:
                del open_[free][content]
                if not open_[free]:
                    del open_[free]
                    room.pop(at)
            else:
                open_[free][content] = k - m
            add(free - each * length, content + (length,) * each, m)
            left -= each * m
    return [(k, content) for group in open_.values() for content, k in group.items()]


def lower_bound(counts: dict[int, int], limit: int) -> int:
    """Martello and Toth's second bound: lengths above limit - k stand alone, those over half cannot share, the rest fills what they leave."""
    best = -(-sum(length * n for length, n in counts.items()) // limit)
    for k in sorted({x for x in counts if 2 * x <= limit}, reverse=True):
        alone = sum(n for x, n in counts.items() if x > limit - k)
        half = [(x, n) for x, n in counts.items() if limit - k >= x > limit / 2]
        rest = sum(x * n for x, n in counts.items() if k <= x <= limit / 2)
        free = sum((limit - x) * n for x, n in half)
        best = max(best, alone + sum(n for _, n in half) + max(0, -(-(rest - free) // limit)))
    return best


def fillings(counts: np.ndarray, present: list[int], room: int, width: int = WIDTH, looks: int = LOOKS) -> list[tuple[int, tuple[int, ...]]]:
    """(waste, lengths) of undominated fillings of ``room`` from the lengths ``present`` (ascending): least waste first, then those that can be taken most often, so that frequent lengths do
    not stay for the end, then the largest lengths."""
    found: dict[tuple[int, ...], int] = {}
    used: dict[int, int] = {}
    left, exact = looks, 0

    def look(room: int, most: int, chosen: tuple[int, ...]) -> None:
        nonlocal left, exact
        left -= 1
        at = bisect.bisect_right(present, min(room, most)) - 1
        while at >= 0 and counts[present[at]] <= used.get(present[at], 0):
            at -= 1
        if at < 0:
            if chosen:
                found.setdefault(chosen, room)
                exact += room == 0
            return
        while at >= 0 and left > 0:
            x = present[at]
            if counts[x] > used.get(x, 0):
                used[x] = used.get(x, 0) + 1
                look(room - x, x, (*chosen, x))
                used[x] -= 1
                if exact >= 4 * width:
                    return
            at -= 1

    look(room, room, ())
    ranked = sorted(((waste, chosen) for chosen, waste in found.items()), key=lambda f: (f[0], -min(int(counts[x]) // f[1].count(x) for x in f[1]), tuple(-x for x in f[1])))
    kept: list[tuple[int, tuple[int, ...]]] = []
    for waste, chosen in ranked:
        if not any(dominates(other, chosen) for _, other in kept):
            kept.append((waste, chosen))
            if len(kept) == width:
                break
    return kept


def dominates(a: tuple[int, ...], b: tuple[int, ...]) -> bool:
    """Whether the lengths of ``b`` can be put, first fit, into rooms of the sizes of ``a``: then filling with ``a`` is never worse."""
    rooms = sorted(a)
    for x in b:
        for i, r in enumerate(rooms):
            if r >= x:
                rooms[i] -= x
                rooms.sort()
                break
        else:
            return False
    return True


def search(counts: dict[int, int], limit: int, effort: int) -> list[Pattern]:
    """Sequences of a histogram of lengths: branch-and-bound over undominated fillings around the largest length left.

    A node takes a filling as often as the counts allow. It is pruned when the waste so far and the bound on the rest cannot beat the incumbent, which
    is best-fit decreasing at first. The search ends at the lower bound or after ``effort`` nodes."""
    counts = {x: n for x, n in counts.items() if n and x}
    best = best_fit(counts, limit)
    size = sum(k for k, _ in best)
    least = lower_bound(counts, limit)
    start = np.zeros(limit + 1, np.int64)
    for x, n in counts.items():
        start[x] = n
    lengths = np.arange(limit + 1)
    stack: list[tuple[np.ndarray, int, int, tuple]] = [(start, 0, 0, ())]
    while stack and effort > 0 and size > least:
        now, bins, waste, plan = stack.pop()
        effort -= 1
        present = np.flatnonzero(now).tolist()
        if not present:
            if bins < size:
                size, best = bins, []
                while plan:
                    plan, step = plan
                    best.append(step)
            continue
        rest = int((now * lengths).sum())
        if bins + -(-rest // limit) >= size or waste > (size - 1) * limit - int((start * lengths).sum()):
            continue
        largest = present[-1]
        now[largest] -= 1
        choices = fillings(now, [x for x in present if now[x]], limit - largest) or [(limit - largest, ())]
        now[largest] += 1
        for free, chosen in reversed(choices):
            need = np.bincount([largest, *chosen], minlength=limit + 1)
            times = int((now[need > 0] // need[need > 0]).min())
            stack.append((now - times * need, bins + times, waste + times * free, (plan, (times, (largest, *chosen)))))
    return best


def repair(patterns: list[Pattern], limit: int, least: int, rounds: int = REPAIRS) -> list[Pattern]:
    """Fewer sequences, where the search can make them: the ones with room and a few drawn full ones are packed anew, for ``rounds`` rounds at most."""
    rng = np.random.default_rng(0)
    held = {content: 0 for _, content in patterns}
    for k, content in patterns:
        held[content] += k
    for _ in range(rounds):
        if sum(held.values()) <= least:
            break
        loose = sorted((c for c in held if sum(c) < limit), key=lambda c: (sum(c), c))[:DRAWN]
        full = sorted(c for c in held if sum(c) == limit and len(c) > 1)
        drawn = [full[i] for i in rng.permutation(len(full))[: 2 * DRAWN]]
        taken = {c: min(held[c], DRAWN) for c in loose} | {c: 1 for c in drawn}
        counts: dict[int, int] = {}
        for c, k in taken.items():
            for x in c:
                counts[x] = counts.get(x, 0) + k
        new = search(counts, limit, 250)
        if sum(k for k, _ in new) < sum(taken.values()):
            for c, k in taken.items():
                held[c] -= k
            for k, c in new:
                held[c] = held.get(c, 0) + k
            held = {c: k for c, k in held.items() if k}
    return [(k, c) for c, k in held.items()]


def bin_completion(counts: dict[int, int], limit: int = LIMIT, effort: int = EFFORT) -> list[Pattern]:
    """Sequences of a histogram of lengths: search(), then repair() of what it leaves above the lower bound."""
    return repair(search(counts, limit, effort), limit, lower_bound(counts, limit))


def layout(patterns: list[Pattern]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length, ascending by rank: first rank, first sequence, uses a sequence, and the place of the first use, of each pattern that has the length."""
    by: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for k, content in patterns:
        place = 0
        for x in sorted(set(content), reverse=True):
            uses = content.count(x)
            by.setdefault(x, []).append((taken.get(x, 0), sequence, uses, place))
            taken[x] = taken.get(x, 0) + k * uses
            place += uses * x
        sequence += k
    return {x: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for x, rows in by.items()}


def assign(pieces: DataFrame, limit: int = LIMIT, rows_a_share: int = ROWS_A_SHARE) -> DataFrame:
    """``pieces`` (any columns, with ``doc_id``, ``piece``, ``start``, ``length`` and ``ids_crc32``) with sequence_id and offset added.

    The driver sees a histogram of at most ``limit`` lengths. Pieces are numbered within their length: by shares of a hash, about one for each
    ``rows_a_share`` of the length's rows, each share's first number being the sum of the shares before it; then the number gives the sequence. The rows move
    once, hashed by length and share. Columns that begin with two underscores are the operator's own."""
    columns = pieces.columns
    pieces = cut(pieces.withColumn("__h", F.xxhash64("doc_id", "piece", "start", "ids_crc32", F.monotonically_increasing_id())))  # equal rows have shares of their own
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    shares = pieces.sparkSession.createDataFrame([(x, -(-n // rows_a_share)) for x, n in counts.items()], "length bigint, __shares bigint")  # at most ``limit`` rows
    pieces = pieces.join(F.broadcast(shares), "length").withColumn("__share", F.pmod("__h", "__shares")).drop("__shares")
    sizes = cut(pieces.groupBy("length", "__share").agg(F.count("*").alias("__n")), 4)
    table = layout(bin_completion(counts, limit))
    before = Window.partitionBy("length").orderBy("__share").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "__share", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    own = Window.partitionBy("length", "__share").orderBy("__h", "doc_id", "piece")
    ranked = pieces.withColumn("__rank", F.row_number().over(own) - 1).join(firsts, ["length", "__share"]).select(*columns, (F.col("__rank") + F.col("__first")).cast("long").alias("__rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "__rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                if x:
                    m = length == x
                    low, first, uses, at = table[int(x)]
                    i = np.searchsorted(low, rank[m], side="right") - 1
                    k = rank[m] - low[i]
                    sequence[m] = first[i] + k // uses[i]
                    offset[m] = at[i] + k % uses[i] * x
            keep = [i for i, n in enumerate(batch.schema.names) if n != "__rank"]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [pa.array(sequence), pa.array(offset)], names=[batch.schema.names[i] for i in keep] + ["sequence_id", "offset"])

    return ranked.mapInArrow(place, StructType([*(ranked.schema[c] for c in columns), StructField("sequence_id", LongType()), StructField("offset", LongType())]))


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT, end_id: int = END_ID, vocabulary: str | None = None, keep_ids: bool = True) -> DataFrame:
    """The pieces of ``docs``, packed: the columns of tokenize(), sequence_id and offset.

    Null and empty texts are the end id alone; repeated rows and ids are packed each for itself; an empty table gives an empty one; other columns are
    not read. Sequences hold at most ``limit`` ids, without gaps."""
    return assign(tokenize(docs, doc_id, text, limit, end_id, vocabulary, keep_ids), limit)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of a packing with ids; a group holds one sequence."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return parts.select("sequence_id", F.flatten(F.col("p.ids")).alias("ids"))
