"""Preprocessing of transcripts as they arrive: a file stream that takes what is there and stops.

It gives what the batch stage gives, but for names that begin with a dot or an underscore, which Spark's file streams don't see."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lectern.functions.text import word_count
from lectern.plans.stages import cleaned_body
from lectern.sources import config

CONTENT = "path string, modificationTime timestamp, length bigint, content binary"


def transcripts(spark: SparkSession, src: str, cfg: config.Preprocess | None = None) -> DataFrame:
    """(name, text, status, error, words), a row for each new file; text is null where the file is not valid UTF-8 or cleaning leaves nothing."""
    raw = spark.readStream.format("binaryFile").schema(CONTENT).option("pathGlobFilter", "*.txt").load(src)
    named = raw.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("content").cast("string").alias("raw"))
    ok = F.is_valid_utf8("raw")
    read = named.select("name", F.when(ok, F.col("raw")).alias("text"), F.when(ok, "succeeded").otherwise("failed").alias("status"), F.when(~ok, "not valid UTF-8").alias("error"))
    return read.withColumn("text", F.when(F.col("status") == "succeeded", cleaned_body(F.coalesce("text", F.lit("")), cfg or config.Preprocess()))).withColumn("words", word_count(F.col("text")))


def run_available(spark: SparkSession, src: str, dst: str, checkpoint: str, cfg: config.Preprocess | None = None) -> StreamingQuery:
    """Append what has arrived since the last run to Parquet at ``dst``, exactly once by the checkpoint, then stop."""
    return transcripts(spark, src, cfg).writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(dst)
