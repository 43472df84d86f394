"""Benchmark decontamination: a prefix-filtered join of item windows and documents. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import cut, lower_ascii, unused

WINDOW = 10
#: Windows of one broadcast block at most (a window is about 0.3 KB); a larger benchmark is joined block by block, each against all documents.
BLOCK_WINDOWS = 200_000


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased: runs of ASCII letters and digits and of all beyond ASCII. Null or no words: an empty array."""
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), F.lit(0))


def item_windows(benchmark: DataFrame, item_id: str, text: str, width: int = WINDOW) -> DataFrame:
    """Distinct (item, window): windows of ``width`` consecutive words; an item with fewer words is one window. A null item id is the item "null"."""
    w = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"), words_of(F.col(text)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))
    return w.select("item", F.explode(F.transform(starts, lambda s: F.slice("w", s, width))).alias("window")).distinct()


def rarity(docs: DataFrame, tokens: DataFrame, text: str) -> DataFrame:
    """(token, n): how often each of ``tokens`` occurs in all documents. Counted on the map side before the shuffle."""
    words = docs.select(F.explode(words_of(F.col(text))).alias("token"))
    return tokens.join(words.join(F.broadcast(tokens), "token", "left_semi").groupBy("token").agg(F.count("*").alias("n")), "token", "left").select("token", F.coalesce("n", F.lit(0)).alias("n"))


def prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Each window with its necessary prefix, which at full containment is one token: its rarest (ties by text), and the token's place in it."""
    tokens = windows.select("item", "window", F.posexplode("window").alias("place", "token")).join(counts, "token")
    first = tokens.groupBy("item", "window").agg(F.min(F.struct("n", "token", "place")).alias("p"))
    return first.select(F.col("p.token").alias("token"), F.col("p.place").alias("place"), "item", "window", F.size("window").alias("width"))


def _blocks(df: DataFrame, rows: int, key: Column, limit: int) -> list[DataFrame]:
    n = max(1, -(-rows // limit))
    return [df] if n == 1 else [df.where(F.pmod(F.xxhash64(key), F.lit(n)) == i) for i in range(n)]


def find_hits(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """A row for each row of ``docs``: doc_id, h (hash of the text), n_words, hits (sorted array of (start, width, item)), and the digest columns of decontaminate().

    1. Item windows, and the corpus frequency of each of their words, from all documents.
    2. A window's rarest word is its prefix. Documents' words meet the prefixes in a broadcast join of at most ``block_windows`` windows; a larger
       benchmark takes several joins.
    3. A meeting gives the window's only possible start; the length bounds are checked, then the words.
    4. Each row also sends its word count, so documents move once, as numbers, to be grouped by id and text hash. Equal rows count as one group and come
       out as many times as they came in."""
    windows = cut(item_windows(benchmark, item_id, item_text, width), 1)
    n_windows = windows.count()
    tokens = windows.select(F.explode("window").alias("token")).distinct()
    counted = [rarity(docs, block, text) for block in _blocks(tokens, n_windows * width, F.col("token"), block_windows * width)]
    counts = counted[0]
    for more in counted[1:]:
        counts = counts.unionByName(more)
    table = cut(prefixes(windows, counts), 1)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("h"), words_of(F.col(text)).alias("words"))
    found = None
    for i, block in enumerate(_blocks(table, n_windows, F.col("window"), block_windows)):
        last = F.array_append("words", F.lit(" ")) if i == 0 else F.col("words")  # a space is no word; it carries the word count
        ends = block.sparkSession.range(1).select(*(F.lit(" " if f.name == "token" else None).cast(f.dataType).alias(f.name) for f in block.schema))
        known = F.broadcast(block.unionByName(ends) if i == 0 else block)
        start = F.col("at") - F.col("place")
        same = F.slice("words", F.greatest(start + 1, F.lit(1)), F.col("width")) == F.col("window")
        met = rows.select("doc_id", "h", "words", F.posexplode_outer(last).alias("at", "word")).join(known, F.col("word") == F.col("token")).where(F.col("window").isNull() | ((start >= 0) & (start + F.col("width") <= F.size("words")) & same))
        hits = met.select("doc_id", "h", F.when(F.col("window").isNull(), F.size("words").cast("long")).alias("n_words"), F.when(F.col("window").isNotNull(), F.struct(start.alias("start"), "width", "item")).alias("hit"))
        found = hits if found is None else found.unionByName(hits)
    grouped = found.groupBy("doc_id", "h").agg(F.max("n_words").alias("n_words"), F.count("n_words").alias("times"), F.sort_array(F.collect_set("hit")).alias("hits"))
    return _digest(grouped).withColumn("__row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("__row", "times")


def _digest(df: DataFrame) -> DataFrame:
    """Words within hits are counted by one pass over the hits in order of their starts."""
    state = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    covered = F.aggregate("hits", state, lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0).cast("long"), x["start"] + x["width"] - F.greatest(s["end"], x["start"].cast("long")))).alias("n"), F.greatest(s["end"], (x["start"] + x["width"]).cast("long")).alias("end")))
    items = F.array_sort(F.array_distinct(F.col("hits.item")))
    return df.withColumns({"n_hit": covered["n"], "n_items": F.size(items).cast("long"), "items_sha256": F.sha2(F.array_join(items, ",").cast("binary"), 256)}).withColumn("contaminated", F.col("n_hit") > 0)


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each row of ``docs``. Null texts have no words; an empty benchmark hits nothing."""
    return find_hits(docs, benchmark, doc_id, text).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without an item window. Rows meet the verdicts by a hash of the text and the id, nulls being equal."""
    own, hashed = unused(docs, "__id"), unused(docs, "__h")
    bad = find_hits(docs, benchmark, doc_id, text).where("contaminated").select(F.col("doc_id").alias(own), F.col("h").alias(hashed)).distinct()
    return docs.join(bad, docs[doc_id].eqNullSafe(F.col(own)) & (F.xxhash64(docs[text]) == F.col(hashed)), "left_anti")
