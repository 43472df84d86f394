"""A training-corpus pipeline: quality classifier, line dedup, SimHash near-dedup, benchmark decontamination, best-fit packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept. In all of them a null text counts as an empty one, texts of any length
count whole, null ids and extra columns are kept as they are, and an empty table gives an empty one."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import packing
from lectern.llm.common import shared_dir, table
from lectern.llm.decontaminate import drop_contaminated
from lectern.llm.line_dedup import dedup_passages
from lectern.llm.quality_classifier import filter_quality, remainder
from lectern.llm.simhash import keep_one_of_each_group
from lectern.sources.files import remove


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranker, fitted on labels outside its held-out fifth, accepts. Equal texts score equal, so ties and repeated rows stay or go together;
    without labels of both kinds all stay or all go."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return filter_quality(docs, labels, remainder(F.col("doc_id"), 5) != 0)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines, sentences and passages that stand in another document; every document keeps its row, and n_chars follows its text. Of
    exact copies one keeps its text, of ties that of the smallest hash; rows of equal id and text are one document. A null text stays null."""
    out = dedup_passages(docs).drop("n_lines", "n_dropped", "n_cut")
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints: that of the smallest id (nulls last), of equal ids that of the smallest text hash, of equal rows any. Texts
    without words, null ones too, are one group."""
    return keep_one_of_each_group(docs).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item; repeated rows stay or go together, and a text without words stays."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark").select("item_id", "text")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 1024 tokens: where each piece stands, and its checksum. Repeated rows are packed each for itself; a text
    without tokens is its end token alone. packing.pack() gives the tokens too, and packing.sequences() the sequences."""
    return packing.pack(docs, keep_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", packed),
]

#: The ranker, the templates' components and the packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, on documents; each result is a Parquet table in the shared folder, which the next stage reads. A table is deleted
    once the next one is written."""
    docs = table(spark, sf_dir, "documents")
    place = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = f"{place}/{k}-{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            if k:
                remove(spark, f"{place}/{k - 1}-{STAGES[k - 1][0]}")
    return docs
