"""Transcripts and summaries to a tree of Markdown files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import paragraphs, sentences, strip, titled, with_suffix
from lectern.operators.corpus import missing


def _in_order(names: DataFrame) -> DataFrame:
    """One row: all names in order, as one text; null without names. Ranges of names become texts where they are, and one task joins these."""
    ranges = names.toDF("name").where("name IS NOT NULL").repartitionByRange("name").withColumn("range", F.spark_partition_id())
    texts = ranges.groupBy("range").agg(F.min("name").alias("first"), F.array_join(F.array_sort(F.collect_list("name")), ", ").alias("names"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "names"))), lambda t: t["names"]), ", ")
    return texts.agg(F.when(F.count("*") > 0, whole).alias("said"))


def input_problems(transcripts: DataFrame, summaries: DataFrame, digest: str | None) -> DataFrame:
    """One row: every problem with every name, as one text by nature; null if there is none."""
    found = [transcripts.limit(1).agg(F.when(F.count("*") == 0, "no preprocessed transcripts found").alias("said"))]
    for title, left, right in (("missing summaries", transcripts, summaries), ("missing transcripts", summaries, transcripts)):
        found.append(_in_order(missing(left, right, "stem")).select(F.concat(F.lit(f"{title}: "), "said").alias("said")))
    if digest is None:
        found.append(transcripts.sparkSession.range(1).select(F.lit("corpus digest is not a file").alias("said")))
    placed = [f.select(F.lit(k).alias("place"), "said") for k, f in enumerate(found)]
    said = F.transform(F.array_sort(F.collect_list(F.when(F.col("said").isNotNull(), F.struct("place", "said")))), lambda p: p["said"])
    return reduce(DataFrame.unionByName, placed).agg(F.nullif(F.array_join(said, "; "), F.lit("")).alias("problems"))


def check_inputs(transcripts: DataFrame, summaries: DataFrame, digest: str | None) -> None:
    """Raise one error that names every problem, before anything is written."""
    if said := input_problems(transcripts, summaries, digest).first().problems:
        raise ValueError(said)


def with_stem(files: DataFrame) -> DataFrame:
    return files.withColumn("stem", with_suffix(F.col("name"), ".txt", ""))


def export_files(transcripts: DataFrame, summaries: DataFrame, digest: str, sentences_a_paragraph: int) -> DataFrame:
    """(rel_path, body) of the tree: a transcript and a summary for each stem, and the digest."""
    if sentences_a_paragraph < 1:
        raise ValueError("a paragraph has at least one sentence")
    both = transcripts.select("stem", "text").join(summaries.select("stem", "summary"), "stem")
    body = paragraphs(sentences(F.col("text")), sentences_a_paragraph)
    pages = F.array(
        F.struct(F.concat("stem", F.lit("/transcript.md")).alias("rel_path"), titled(F.col("stem"), "Transcript", body).alias("body")),
        F.struct(F.concat("stem", F.lit("/summary.md")).alias("rel_path"), titled(F.col("stem"), "Summary", F.col("summary")).alias("body")),
    )
    tree = both.select(F.explode(pages).alias("p")).select("p.*")
    one = both.sparkSession.range(1).select(F.lit("corpus_digest.md").alias("rel_path"), F.concat(F.lit("# Corpus digest\n\n"), strip(F.lit(digest)), F.lit("\n")).alias("body"))
    return tree.unionByName(one)
