"""Chat formatting into budgeted windows. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Tokens of a window, and turns of history that a window repeats at most.
BUDGET, HISTORY = 1024, 2
_END = "</turn>\n"


def escape(x: Column) -> Column:
    """Backslashes and angle brackets as \\b, \\l and \\g: what is escaped holds no mark, and unescape() gives it back."""
    return F.replace(F.replace(F.replace(x, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l")), F.lit(">"), F.lit("\\g"))


def unescape(x: Column) -> Column:
    return F.replace(F.replace(F.replace(x, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">")), F.lit("\\b"), F.lit("\\"))


def turn_text(role: Column, text: Column) -> Column:
    """A turn as a window shows it."""
    return F.concat(F.lit("<turn "), escape(role), F.lit(">"), escape(text), F.lit(_END))


def most_tokens(role: Column, text: Column) -> Column:
    """The bytes of a turn with its marks and escapes. A token of a byte-level vocabulary is a byte at least, so it has no more tokens, by whatever vocabulary."""
    return F.octet_length(turn_text(role, text)).cast("long")


def format_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", tokens: str | None = None) -> DataFrame:
    """A row for each window of each conversation: conv_id, window, n_repeated, over_budget, formatted, loss_spans (start and length in code points of
    ``formatted``).

    ``tokens``: a column with the tokens of each turn_text(); without it, most_tokens() bounds them. A conversation's turns are ordered by turn, role and text
    (nulls first; ties are equal rows). The room is the budget without the leading system turn. Prefix sums of turn tokens put a turn into the cell in which
    it starts; a cell is the room without the largest turn of at most half the room, so the turns of a cell fit the room. A turn of more than half the room
    stands alone and is never cut: a window whose turns together pass the budget, which such a turn or a system turn can do alone, is marked over_budget, and
    no other is. Each window begins with the leading system turn, then up to ``history`` earlier turns as far as the room allows; these ``n_repeated``
    turns are repetitions. Loss is on the texts of assistant turns that are not repeated, so on each exactly once.

    Null roles, texts and token counts are empty (the bound counts for a null count). A null conversation id is a conversation. An empty table gives an empty
    one. Other columns are not read. One shuffle, by conversation: the grouping into windows keeps its partitioning, and a group holds one window."""
    count = most_tokens(F.col("role"), F.col("text"))
    given = F.col(tokens).cast("long") if tokens else F.lit(None).cast("long")
    base = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"), given.alias("given"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    whole = Window.partitionBy("conv_id")
    t = base.withColumn("cost", F.coalesce("given", count)).drop("given")
    t = t.withColumn("idx", F.row_number().over(order) - 1).withColumn("leads", (F.col("role") == "system") & (F.col("idx") == 0))
    t = t.withColumn("tokens", F.when(F.col("leads"), F.lit(0)).otherwise(F.col("cost")).cast("long"))
    t = t.withColumn("system", F.max(F.when(F.col("leads"), F.struct("role", "text", "cost"))).over(whole))
    t = t.withColumn("room", F.greatest(F.lit(budget) - F.coalesce(F.col("system.cost"), F.lit(0)), F.lit(2)).cast("long"))
    t = t.withColumn("before", F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    t = t.withColumn("alone", F.col("tokens") > F.expr("room div 2"))
    t = t.withColumn("span", F.col("room") - F.coalesce(F.max(F.when(~F.col("alone"), F.col("tokens"))).over(whole), F.lit(0))).withColumn("cell", F.expr("before div span"))
    opens = (F.col("cell") != F.lag("cell").over(order)) | F.col("alone") | F.lag("alone").over(order)
    t = t.withColumn("opens", F.when(F.col("idx") == 0, F.lit(False)).otherwise(opens))
    t = t.withColumn("window", F.sum(F.col("opens").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    t = t.withColumn("needs", F.sum("tokens").over(Window.partitionBy("conv_id", "window")))
    copies = [F.struct("window", F.lit(False).alias("again"), "idx", "role", "text", "cost")]
    for h in range(1, history + 1):
        ahead = lambda c, h=h: F.lead(c, h).over(order)
        fits = ahead("opens") & ~F.col("leads") & (ahead("before") - F.col("before") <= F.col("room") - ahead("needs"))
        copies.append(F.when(fits, F.struct(ahead("window").alias("window"), F.lit(True).alias("again"), "idx", "role", "text", "cost")))
    copies.append(F.when(F.col("opens") & F.col("system").isNotNull(), F.struct("window", F.lit(True).alias("again"), F.lit(0).alias("idx"), "system.role", "system.text", "system.cost")))
    shown = t.withColumn("copies", F.array(*copies)).select("conv_id", F.explode(F.array_compact("copies")).alias("c")).select("conv_id", "c.*")
    grouped = shown.groupBy("conv_id", "window").agg(F.array_sort(F.collect_list(F.struct("idx", "again", "role", "text"))).alias("turns"), (F.sum("cost") > budget).alias("over_budget"))
    formatted = F.array_join(F.transform("turns", lambda x: turn_text(x["role"], x["text"])), "")
    none = F.array().cast("array<struct<start:int,length:int>>")
    state = F.struct(F.lit(0).alias("at"), none.alias("spans"))

    def step(s: Column, x: Column) -> Column:
        head = s["at"] + F.length(escape(x["role"])) + 7
        size = F.length(escape(x["text"]))
        taught = (x["role"] == "assistant") & ~x["again"]
        return F.struct((head + size + len(_END)).alias("at"), F.when(taught, F.array_append(s["spans"], F.struct(head.alias("start"), size.alias("length")))).otherwise(s["spans"]).alias("spans"))

    return grouped.select("conv_id", "window", F.size(F.filter("turns", lambda x: x["again"])).alias("n_repeated"), "over_budget", formatted.alias("formatted"), F.aggregate("turns", state, step)["spans"].alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """The turns, as an array of (role, text), that a formatted text holds."""
    parts = F.filter(F.split(formatted, _END), lambda x: x != "")
    return F.transform(parts, lambda x: F.struct(unescape(F.substring_index(F.substring(x, 7, 1 << 30), ">", 1)).alias("role"), unescape(F.regexp_replace(x, "^<turn [^>]*>", "")).alias("text")))


def digest(windows: DataFrame) -> DataFrame:
    """By conversation, from the formatted windows alone: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    The digests are of a conversation's whole text, so this report, unlike format_windows(), holds a conversation at a time."""
    turns = F.slice(F.col("turns"), F.col("n_repeated") + 1, F.greatest(F.size("turns") - F.col("n_repeated"), F.lit(0)))
    taught = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    w = windows.withColumn("turns", read_back(F.col("formatted"))).withColumn("turns", turns)
    w = w.select("conv_id", "window", F.size("turns").alias("n"), F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "").alias("said"), F.array_join(taught, "").alias("loss"), F.length("formatted").alias("chars"))
    g = w.groupBy("conv_id").agg(F.sum("n").cast("long").alias("n_turns"), F.sum("chars").cast("long").alias("formatted_chars"), F.array_sort(F.collect_list(F.struct("window", "said", "loss"))).alias("all"))
    said, loss = F.array_join(F.col("all.said"), ""), F.array_join(F.col("all.loss"), "")
    return g.select("conv_id", "n_turns", F.sha2(said.cast("binary"), 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
