"""Resumable stages. A stage lists its source, takes out what has an output, works on the rest row by row, and reports.

Model calls run in mapInPandas and are written as a table before anything reads them twice; a record's error is a status, not a failed task."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import text as X
from lectern.functions.ngrams import collapse_repeated_ngrams
from lectern.operators import clips as C
from lectern.operators import corpus as O
from lectern.operators.export import check_inputs, export_files, with_stem
from lectern.operators.topics import check_assignment, check_topics, topic_names
from lectern.providers import Provider, classify, request_object
from lectern.sources import config
from lectern.sources import files as S

RESULT = "name string, body string, status string, error string"
MAP_PROMPT = "Summarise the transcript of one class in four labelled sections: Тема занятия, Разобранные темы, Глубина проработки, Границы."
REDUCE_PROMPT = "Write a digest of the whole corpus from the digests of its classes."
TOPICS_PROMPT = 'Build a taxonomy of specific topics. Answer with JSON: {"topics": [{"id": "topic_01", "name": "...", "description": "..."}]}.'
CLASSIFY_PROMPT = 'Choose the topics that a class develops. Answer with JSON: {"assignments": [{"topic_id", "role", "evidence_id", "reason"}], "unmatched_reason": ""}. Roles are primary and secondary.'


def _exists(spark: SparkSession, path: str) -> bool:
    place, fs = S._fs(spark, path)
    return fs.exists(place)


def _kept(spark: SparkSession, df: DataFrame, beside: str) -> DataFrame:
    """``df`` written as Parquet beside the outputs and read again, so that a provider is asked once for each record."""
    path = f"{beside.rstrip('/')}.work/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def _todo(spark: SparkSession, src: str, dst: str, suffix: str, made: str) -> tuple[DataFrame, DataFrame]:
    S.require_directory(spark, src)
    listing = S.list_directory(spark, src, suffix).where("NOT is_dir")
    out = listing.withColumn("out", X.with_suffix(F.col("name"), suffix, made))
    there = S.list_directory(spark, dst).select(F.col("name").alias("out")) if _exists(spark, dst) else spark.createDataFrame([], "out string")
    todo = O.pending(out, there, "out")
    return todo, out.join(todo.select("out"), "out", "left_anti").select(F.col("name"), F.lit(None).cast("string").alias("body"), F.lit("skipped").alias("status"), F.lit(None).cast("string").alias("error"))


def each(df: DataFrame, work: Callable[[pd.Series], str | None]) -> DataFrame:
    """A result for each row by ``work``; what it raises becomes the row's error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                try:
                    rows.append((r.name, work(r), "succeeded", None))
                except Exception as e:  # noqa: BLE001  any failure is the record's own
                    rows.append((r.name, None, "failed", f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["name", "body", "status", "error"])

    return df.mapInPandas(run, RESULT)


def _finish(results: DataFrame, skipped: DataFrame, dst: str, name: Column) -> DataFrame:
    S.write_files(results.where("body IS NOT NULL").select(name.alias("rel_path"), "body"), dst)
    return results.unionByName(skipped).select("name", "status", "error")


def transcode(spark: SparkSession, cfg: config.Transcode, provider: Provider) -> DataFrame:
    """Every video anew; outputs are always replaced."""
    S.require_directory(spark, cfg.src)
    files = S.read_files(S.list_directory(spark, cfg.src, ".mp4").where("NOT is_dir"))
    dst, quality = cfg.dst, cfg.quality

    def work(r) -> None:
        system, inner = S.open_system(dst)
        system.create_dir(inner, recursive=True)
        made = f"{inner}/{r.name.removesuffix('.mp4')}.mp3"
        with system.open_output_stream(f"{made}.tmp") as f:
            f.write(provider.transcode(r.content, quality))
        system.move(f"{made}.tmp", made)

    return _kept(spark, each(files, work), cfg.dst).select("name", "status", "error")


def transcribe(spark: SparkSession, cfg: config.Transcribe, provider: Provider) -> DataFrame:
    """Decode, detect speech, pack clips, recognise, filter and join; only the two model calls leave the JVM."""
    todo, skipped = _todo(spark, cfg.src, cfg.dst, ".mp3", ".txt")
    spans = "array<struct<start:bigint,end:bigint>>"

    def detect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                try:
                    n, wave = provider.decode(r.content)
                    rows.append((r.name, n, [{"start": a, "end": b} for a, b in provider.speech(wave)], None))
                except Exception as e:  # noqa: BLE001
                    rows.append((r.name, 0, [], f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["name", "n", "speech", "error"])

    found = S.read_files(todo.select("name", "path", "is_dir", "is_link", "size")).select("name", "content").mapInPandas(detect, f"name string, n bigint, speech {spans}, error string")
    found = _kept(spark, found, cfg.dst)
    longest = int(cfg.max_clip_seconds * C.SAMPLE_RATE)
    clips = found.where("error IS NULL").select("name", C.to_seconds(C.pack_clips(C.speech_or_all(F.col("speech"), F.col("n")), longest)).alias("clips"))
    again = S.read_files(todo.select("name", "path", "is_dir", "is_link", "size")).select("name", "content").join(clips, "name")

    def hear(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                try:
                    _, wave = provider.decode(r.content)
                    for k, s in enumerate(provider.recognise(wave, [(c["start"], c["end"]) for c in r.clips])):
                        rows.append((r.name, k, s["text"], s["no_speech_prob"], s["avg_logprob"], s["compression_ratio"], None))
                    rows.append((r.name, -1, None, None, None, None, None))
                except Exception as e:  # noqa: BLE001
                    rows.append((r.name, -1, None, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["file", "seq", "text", "no_speech_prob", "avg_logprob", "compression_ratio", "error"])

    heard = _kept(spark, again.mapInPandas(hear, "file string, seq int, text string, no_speech_prob double, avg_logprob double, compression_ratio double, error string"), cfg.dst)
    keep = C.is_speech(cfg.max_no_speech_prob, cfg.min_avg_logprob, cfg.max_compression_ratio)
    texts = C.assemble_transcripts(heard.where("seq >= 0"), keep)
    ends = heard.where("seq < 0").select(F.col("file"), "error")
    results = ends.join(texts, "file", "left").select(F.col("file").alias("name"), F.when(F.col("error").isNull(), F.coalesce("text", F.lit(""))).alias("body"), F.when(F.col("error").isNull(), "succeeded").otherwise("failed").alias("status"), "error")
    failed = found.where("error IS NOT NULL").select("name", F.lit(None).cast("string").alias("body"), F.lit("failed").alias("status"), "error")
    return _finish(results.unionByName(failed), skipped, cfg.dst, X.with_suffix(F.col("name"), ".mp3", ".txt"))


def preprocessed(text: Column, cfg: config.Preprocess) -> Column:
    """The words of a cleaned transcript, or null where cleaning leaves none."""
    words = X.tokens(X.clean_text(text))
    if cfg.remove_mixed_script:
        words = X.drop_mixed_script(words)
    words = collapse_repeated_ngrams(words, cfg.max_ngram, cfg.min_count)
    if cfg.remove_fillers:
        words = X.drop_fillers(words)
    return words


def cleaned_body(text: Column, cfg: config.Preprocess) -> Column:
    """The text of an output: null where cleaning leaves no token, and so no output; empty where only the later steps leave none."""
    return F.when(F.size(X.tokens(X.clean_text(text))) > 0, F.array_join(preprocessed(text, cfg), " "))


def preprocess(spark: SparkSession, cfg: config.Preprocess) -> DataFrame:
    todo, skipped = _todo(spark, cfg.src, cfg.dst, ".txt", ".txt")
    read = S.read_texts(todo.select("name", "path", "is_dir", "is_link", "size"))
    readable = F.col("status") == "readable"
    body = F.when(readable, cleaned_body(F.coalesce("text", F.lit("")), cfg))
    results = _kept(spark, read.select("name", body.alias("body"), F.when(readable, "succeeded").otherwise("failed").alias("status"), "error"), cfg.dst)
    return _finish(results, skipped, cfg.dst, F.col("name"))


def _completed(provider: Provider, system: str, text: str, max_tokens: int) -> str:
    status, answer = provider.complete(system, text, max_tokens)
    if status != "completed":
        raise RuntimeError(f"the answer is {status}")
    return answer


def summarize(spark: SparkSession, cfg: config.Summarize, provider: Provider) -> DataFrame:
    """Map: a summary for each text without one. Statistics over all readable texts. Reduce: one digest, if there is none.

    A summary is written as its answer comes, so a stopped run pays for no answer twice. A digest whose answer is not complete is a failed row."""
    S.require_directory(spark, cfg.src)
    listing = S.list_directory(spark, cfg.src, ".txt").where("NOT is_dir")
    there = S.list_directory(spark, cfg.dst) if _exists(spark, cfg.dst) and not cfg.refresh else spark.createDataFrame([], S.LISTING)
    counted = _kept(spark, S.read_texts(listing).select("name", "status", "error", X.word_count(F.col("text")).alias("words")), cfg.dst)
    readable = counted.where("status = 'readable'")
    dst, refresh, limit = cfg.dst.rstrip("/"), cfg.refresh, cfg.map_max_tokens

    def work(r) -> None:
        if refresh or not S.exists(f"{dst}/{r.name}"):  # a repeated task finds what its first try has written
            S.write_file(f"{dst}/{r.name}", _completed(provider, MAP_PROMPT, f"Transcript:\n\n{r.text}", limit))

    pending = O.pending(readable.select("name"), there)
    results = _kept(spark, each(S.read_texts(listing.join(pending, "name", "left_semi")), work), cfg.dst).select("name", "status", "error")
    skipped = readable.join(there.select("name"), "name", "left_semi").select("name", F.lit("skipped").alias("status"), "error")
    report = results.unionByName(counted.where("status = 'failed'").drop("words")).unionByName(skipped)
    stats = O.totals(readable, F.col("words"), cfg.words_per_minute).first()
    if stats is None:
        return report
    if cfg.refresh or not _exists(spark, cfg.digest):
        digests = S.read_texts(S.list_directory(spark, cfg.dst, ".txt").where("NOT is_dir")).where("status = 'readable'")
        prompt, n = O.digest_prompt(digests, text="text")
        about = spark.range(1).select(O.metadata_lines(F.lit(stats.num_files), F.lit(stats.avg_words), F.lit(stats.words_per_minute)).alias("about")).first().about
        try:
            S.write_file(cfg.digest, _completed(provider, REDUCE_PROMPT, f"{n} digests\n{prompt}\n\n{about}", cfg.reduce_max_tokens))
        except RuntimeError as e:
            report = report.unionByName(spark.createDataFrame([(cfg.digest, "failed", f"{type(e).__name__}: {e}")], "name string, status string, error string"))
    S.write_file(cfg.stats, json.dumps({"num_files": stats.num_files, "avg_words": stats.avg_words, "words_per_minute": stats.words_per_minute}, indent=2))
    return report


def export(spark: SparkSession, cfg: config.Export) -> DataFrame:
    """The Markdown tree; every problem is named before anything is written."""

    def side(path: str, column: str) -> DataFrame:
        if not _exists(spark, path):
            return spark.createDataFrame([], f"name string, {column} string, stem string")
        return with_stem(S.read_texts(S.list_directory(spark, path, ".txt").where("NOT is_dir")).select("name", F.col("text").alias(column)))

    transcripts, summaries = side(cfg.transcripts, "text"), side(cfg.summaries, "summary")
    try:
        digest: str | None = S.read_one(spark, cfg.digest)
    except ValueError:
        digest = None
    check_inputs(transcripts, summaries, digest)
    tree = export_files(transcripts, summaries, digest or "", cfg.sentences_per_paragraph)
    S.write_files(tree, cfg.dst)
    return tree.select("rel_path")


def corpus_fingerprint(spark: SparkSession, cfg: config.Distribute, digest: str) -> str:
    """Changes with the digest, the model, the prompts, the limits and any file of a class; not with topic sections or files beside the classes."""
    found = S.snapshot(spark, cfg.src).where(F.contains("rel_path", F.lit("/")) & F.col("is_file"))
    body = F.when(F.col("rel_path").endswith("/summary.md"), X.without_topics(F.col("content").cast("string")).cast("binary")).otherwise(F.col("content"))
    marked = found.select("rel_path", F.concat(F.sha2(F.col("rel_path").cast("binary"), 256), F.sha2(body, 256)).alias("body"))
    about = json.dumps([digest, cfg.model, TOPICS_PROMPT, CLASSIFY_PROMPT, cfg.topics_max_tokens, cfg.classify_max_tokens])
    row = O.fingerprint(marked, "rel_path", "body").select(F.sha2(F.concat(F.lit(about), "fingerprint").cast("binary"), 256).alias("f")).first()
    return row.f


def distribute(spark: SparkSession, cfg: config.Distribute, provider: Provider) -> DataFrame:
    """Topics once for the corpus, an assignment for each class without one, and a topic section in each summary.

    The manifest is written before any summary is changed. Each class's answer is a file of its own beside the manifest as soon as it comes, and is read by the
    next run, so a stopped run pays for no answer twice; the manifest gets them all at the end."""
    S.require_directory(spark, cfg.src)
    classes = S.reject_links(S.list_directory(spark, cfg.src)).where("is_dir").select(F.col("name").alias("class"))
    if classes.isEmpty():
        raise ValueError("no class folders")
    digest = S.read_one(spark, cfg.digest, blank_is_error=True)
    pages = S.snapshot(spark, cfg.src).where(F.col("is_file") & F.col("rel_path").rlike(r"\A[^/]+/summary\.md\z"))
    summaries = classes.join(pages.select(F.regexp_replace("rel_path", "/summary\\.md$", "").alias("class"), F.col("content").cast("string").alias("raw")), "class", "left").withColumn("summary", X.without_topics(F.col("raw")))
    blank = summaries.where(F.col("raw").isNull() | (X.strip(F.col("summary")) == ""))
    if bad := [r["class"] for r in blank.orderBy("class").take(20)]:
        raise ValueError(f"no summary: {', '.join(bad)}")
    mark = corpus_fingerprint(spark, cfg, digest)
    if _exists(spark, cfg.manifest):
        manifest = json.loads(S.read_one(spark, cfg.manifest))
        if manifest.get("fingerprint") != mark:
            raise ValueError("the manifest belongs to another corpus")
        topics = check_topics(manifest["topics"])
    else:
        texts = {r["class"]: r["summary"] for r in summaries.select("class", "summary").orderBy("class").toLocalIterator()}
        topics = request_object(provider, TOPICS_PROMPT, {"corpus_digest": digest, "class_summaries": texts}, cfg.topics_max_tokens).get("topics")
        topics = check_topics(topics)
        manifest = {"fingerprint": mark, "topics": topics, "classes": {}}
        S.write_file(cfg.manifest, json.dumps(manifest, ensure_ascii=False, indent=2) + "\n")
    answers = f"{cfg.manifest}.answers/{mark}"
    done = spark.createDataFrame([(k, json.dumps(v, ensure_ascii=False)) for k, v in manifest["classes"].items()], "class string, saved string")
    if _exists(spark, answers):
        own = S.read_texts(S.list_directory(spark, answers, ".json")).select(X.with_suffix(F.col("name"), ".json", "").alias("class"), F.col("text").alias("saved"))
        done = done.unionByName(O.pending(own, done, "class"))
    ids, limit = {t["id"] for t in topics}, cfg.classify_max_tokens
    asked = summaries.join(done, "class", "left").withColumn("passages", X.passages(F.col("summary")))

    def work(r) -> str:
        if r.saved is not None:
            return json.dumps(check_assignment(json.loads(r.saved), ids, r.summary), ensure_ascii=False)
        passages = {p["id"]: p["text"] for p in r.passages}
        payload = {"corpus_digest": digest, "topics": topics, "class_summary": r.summary}
        found = json.dumps(classify(provider, CLASSIFY_PROMPT, payload, ids, r.summary, passages, limit), ensure_ascii=False)
        S.write_file(f"{answers}/{r.name}.json", found)
        return found

    if cfg.failed_only:
        asked = asked.where(F.col("saved").isNull() | ~F.col("class").isin(*manifest["classes"]))
    results = _kept(spark, each(asked.select(F.col("class").alias("name"), "summary", "saved", "passages"), work), cfg.manifest)
    for r in results.where("status = 'succeeded'").orderBy("name").toLocalIterator():
        manifest["classes"].setdefault(r["name"], json.loads(r["body"]))
    S.write_file(cfg.manifest, json.dumps(manifest, ensure_ascii=False, indent=2) + "\n")
    S.remove(spark, f"{cfg.manifest}.answers")
    shape = "struct<assignments:array<struct<topic_id:string>>>"
    rows = results.where("status = 'succeeded'").select(F.col("name").alias("class"), F.posexplode_outer(F.from_json("body", shape)["assignments"]).alias("pos", "a")).select("class", "pos", "a.topic_id")
    names = topic_names(rows.where("topic_id IS NOT NULL"), spark.createDataFrame([(t["id"], t["name"]) for t in topics], "id string, name string"))
    fresh = results.where("status = 'succeeded'").select(F.col("name").alias("class")).join(summaries, "class").join(names, "class", "left")
    annotated = fresh.select(F.concat("class", F.lit("/summary.md")).alias("rel_path"), X.with_topics(F.col("summary"), F.coalesce("names", F.array().cast("array<string>"))).alias("body"))
    S.write_files(annotated, cfg.src)
    return results.select("name", "status", "error")


def clean(spark: SparkSession, dst: str) -> None:
    """Remove the tables that runs have kept beside ``dst``; their reports can't be read any more."""
    S.remove(spark, f"{dst.rstrip('/')}.work")


def exit_code(stage: str, report: DataFrame, strict: bool = False) -> int:
    """1 for failed records of the last stage, or of any stage when strict."""
    return int((strict or stage == "distribute") and not report.where("status = 'failed'").isEmpty())
