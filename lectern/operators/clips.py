"""Speech segments to bounded clips, recognised segments to transcripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_RATE = 16_000
_SPAN = "array<struct<start:bigint,end:bigint>>"


def pack_clips(segments: Column, longest: int) -> Column:
    """Clips of at most ``longest`` samples from ordered segments (an array of start, end), by one fold.

    A segment joins the open clip while the clip's whole span stays within ``longest``. A longer segment closes the clip and is cut by itself."""
    none = F.array().cast(_SPAN)
    unset = F.lit(None).cast("bigint")
    state = F.struct(none.alias("out"), unset.alias("start"), unset.alias("end"))

    def flush(s: Column) -> Column:
        return F.when(s["start"].isNull(), s["out"]).otherwise(F.array_append(s["out"], F.struct(s["start"].alias("start"), s["end"].alias("end"))))

    def step(s: Column, x: Column) -> Column:
        start, end = x["start"].cast("bigint"), x["end"].cast("bigint")
        cuts = F.transform(F.sequence(start, F.greatest(end - 1, start), F.lit(longest).cast("bigint")), lambda a: F.struct(a.alias("start"), F.least(a + longest, end).alias("end")))
        joined = s["start"].isNotNull() & (end - s["start"] <= longest)
        return (
            F.when(end - start > longest, F.struct(F.concat(flush(s), cuts).alias("out"), unset.alias("start"), unset.alias("end")))
            .when(joined, F.struct(s["out"].alias("out"), s["start"].alias("start"), end.alias("end")))
            .otherwise(F.struct(flush(s).alias("out"), start.alias("start"), end.alias("end")))
        )

    return F.aggregate(segments, state, step, flush)


def build_clips(segments: DataFrame, longest: int, key: str = "file", order: tuple[str, ...] = ("start",)) -> DataFrame:
    """(key, clips) from rows (key, start, end): a file's segments are gathered in ``order`` and packed. A group is one file."""
    ordered = F.array_sort(F.collect_list(F.struct(*order, F.struct(F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end")).alias("segment"))))
    return segments.groupBy(key).agg(ordered.alias("s")).select(key, pack_clips(F.col("s.segment"), longest).alias("clips"))


def speech_or_all(segments: Column, n_samples: Column) -> Column:
    """Detected speech, or the whole recording where there is none."""
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), n_samples.cast("bigint").alias("end")))
    return F.when(F.size(segments) > 0, segments.cast(_SPAN)).otherwise(whole)


def to_seconds(clips: Column) -> Column:
    return F.transform(clips, lambda c: F.struct((c["start"] / SAMPLE_RATE).alias("start"), (c["end"] / SAMPLE_RATE).alias("end")))


def is_speech(max_no_speech_prob: float = 0.6, min_avg_logprob: float = -1.0, max_compression_ratio: float = 2.4) -> Column:
    """The three thresholds, each inclusive."""
    return (F.col("no_speech_prob") <= max_no_speech_prob) & (F.col("avg_logprob") >= min_avg_logprob) & (F.col("compression_ratio") <= max_compression_ratio)


def assemble_transcripts(segments: DataFrame, keep: Column, key: str = "file", seq: str = "seq") -> DataFrame:
    """(key, text, kept, dropped): kept segments' stripped texts joined by spaces in order; blank ones count as kept but add no text."""
    from lectern.functions.text import strip

    texts = F.array_sort(F.collect_list(F.when(keep, F.struct(F.col(seq).alias("seq"), strip(F.col("text")).alias("text")))))
    joined = F.array_join(F.filter(F.transform(texts, lambda s: s["text"]), lambda x: x != ""), " ")
    return segments.groupBy(key).agg(joined.alias("text"), F.count_if(keep).alias("kept"), F.count_if(~F.coalesce(keep, F.lit(False))).alias("dropped"))
