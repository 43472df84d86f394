"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import packing, quality_classifier, toxicity
from lectern.llm.common import table
from lectern.llm.chat_format import digest, format_windows
from lectern.llm.decontaminate import decontaminate
from lectern.llm.html_extract import extract_pages
from lectern.llm.license_scan import scan_licenses
from lectern.llm.line_dedup import dedup_passages
from lectern.llm.quality_rules import apply_rules
from lectern.llm.simhash import group_near_duplicates


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, keep_ids=False)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_passages(docs).select("doc_id", "n_lines", "n_dropped", "n_cut", "text")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return apply_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("\\### Assistant: </turn> ok").alias("text"))
    return digest(format_windows(turns.unionByName(planted)))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return group_near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def _scored(docs: DataFrame, held_out: Column) -> DataFrame:
    held = F.coalesce(held_out, F.lit(False)).alias("held_out")
    return docs.select("doc_id", held, "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = quality_classifier.remainder(F.col("doc_id"), 5) == 0
    ranker = quality_classifier.train(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"), ~held_out)
    return _scored(quality_classifier.score_documents(docs, ranker), held_out)


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_pages(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = quality_classifier.remainder(F.col("doc_id"), 4) == 2
    model = toxicity.train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), ~held_out)
    return _scored(toxicity.score_documents(docs, model), held_out)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_license_scan": op2_license_scan,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_line_dedup": op4_line_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_chat_format": op6_chat_format,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_html_extraction": op9_html_extraction,
    "op10_toxicity": op10_toxicity,
}
_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP1_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS win
       FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
dw AS (SELECT r, k, s, array_to_string(w[s:s + k - 1], ' ') AS win
       FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)),
hits AS (SELECT DISTINCT r, s, dw.k, item FROM dw JOIN iw ON dw.k = iw.k AND dw.win = iw.win),
n AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + k)) AS p FROM hits) GROUP BY r),
g AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN g USING (r)
"""

#: Budget 1024, two turns of history, as in chat_format: escaped lengths, the windows by prefix sums, and how many windows show a turn.
OP6_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
a AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS idx,
      length(regexp_replace(role, '[\\<>]', 'xx', 'g')) + length(regexp_replace(text, '[\\<>]', 'xx', 'g')) + 15 AS shown,
      strlen(regexp_replace(role, '[\\<>]', 'xx', 'g')) + strlen(regexp_replace(text, '[\\<>]', 'xx', 'g')) + 15 AS cost FROM t),
b AS (SELECT *, role = 'system' AND idx = 0 AS leads, CASE WHEN role = 'system' AND idx = 0 THEN 0 ELSE cost END AS tokens FROM a),
c AS (SELECT *, greatest(1024 - coalesce(max(CASE WHEN leads THEN cost END) OVER (PARTITION BY conv_id), 0), 2) AS room,
      coalesce(sum(tokens) OVER (PARTITION BY conv_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM b),
c2 AS (SELECT *, tokens > room // 2 AS alone FROM c),
d AS (SELECT *, before // (room - coalesce(max(CASE WHEN NOT alone THEN tokens END) OVER (PARTITION BY conv_id), 0)) AS cell FROM c2),
e AS (SELECT *, idx > 0 AND (cell <> lag(cell) OVER w OR alone OR lag(alone) OVER w) AS opens FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY idx)),
f AS (SELECT *, sum(opens::INT) OVER (PARTITION BY conv_id ORDER BY idx) AS win FROM e),
g AS (SELECT *, sum(tokens) OVER (PARTITION BY conv_id, win) AS needs, max(win) OVER (PARTITION BY conv_id) AS last FROM f),
h AS (SELECT *, 1 + CASE WHEN leads THEN last ELSE
      coalesce((lead(opens, 1) OVER w AND lead(before, 1) OVER w - before <= room - lead(needs, 1) OVER w)::INT, 0) +
      coalesce((lead(opens, 2) OVER w AND lead(before, 2) OVER w - before <= room - lead(needs, 2) OVER w)::INT, 0) END AS times
      FROM g WINDOW w AS (PARTITION BY conv_id ORDER BY idx))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY idx)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY idx), '')) AS loss_sha256,
       sum(shown * times)::BIGINT AS formatted_chars
FROM h GROUP BY conv_id
"""

ORACLE_SQL: dict[str, str] = {"op6_chat_format": OP6_SQL, "op1_decontamination": OP1_SQL}
