"""The registered queries over the smallest tables: SQL, rows, and the pipeline stage by stage."""

import sys
import zlib
from pathlib import Path

import pytest

from lectern.llm import queries
from tests.conftest import DATA
from tests.llm.test_operators import brute_fingerprint
from tests.oracle import assert_same, run_sql

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    assert_same(queries.QUERIES[name](spark, DATA).toPandas(), run_sql(queries.ORACLE_SQL[name], DATA))


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL) - {"op2_license_scan"}))
def test_a_row_for_each_input_row(spark, name):
    source = "pages" if name.startswith("op9") else "documents"
    got = queries.QUERIES[name](spark, DATA).toPandas()
    want = spark.read.parquet(f"{DATA}/{source}.parquet").toPandas()
    key = want.columns[0]
    assert sorted(set(got[key])) == sorted(want[key])
    if not name.startswith("op3"):
        assert len(got) == len(want)


def test_held_out_rows(spark):
    for name, modulus, r in (("op8_quality_classifier", 5, 0), ("op10_toxicity", 4, 2)):
        for row in queries.QUERIES[name](spark, DATA).collect():
            assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % modulus == r)
            assert row.predicted == int(row.score >= 0.3)


def test_simhash_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = queries.QUERIES["op7_simhash_near_dedup"](spark, DATA).collect()
    prints = {i: brute_fingerprint(t) for i, t in docs.items()}
    assert all(int(r.fingerprint, 16) == prints[r.doc_id] and len(r.fingerprint) == 16 for r in got)
    reach = {i: {j for j in prints if (prints[i] ^ prints[j]).bit_count() <= 4} for i in prints}
    for r in got:
        seen, todo = {r.doc_id}, [r.doc_id]
        while todo:
            for j in reach[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        assert r.component_id == min(seen)


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= ids
        if name != "best_fit_packing":
            assert docs.columns == columns and docs.where("n_chars <> length(text)").count() == 0
        if name in ("line_dedup", "best_fit_packing"):
            assert now == ids
        ids = now
    assert corpus_pipeline.run(spark, DATA).count() == docs.count()


def test_pipeline_stages_on_odd_rows(spark):
    import corpus_pipeline

    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint, __text string, __score string, __id string, __h string, __gone string, __key string"
    long = "slow words make a very long text " * 3000
    rows = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "x y z w v"), (None, None), (4, long), (5, "\u00e9 \u00dcn\x0b\t* # <b>"), (6, "\n\n"), (7, long)]
    odd = spark.createDataFrame([(i, t, None, None, None, "t", "s", "i", "h", "g", "k") for i, t in rows], columns)
    kept = {"quality_classifier": None, "line_dedup": 10, "simhash_near_dedup": 5, "benchmark_decontamination": 10}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, DATA)
        got = out.collect()
        assert stage(spark, odd.limit(0), DATA).count() == 0
        if name == "best_fit_packing":
            assert sum(r.piece == 0 for r in got) == 10
            continue
        assert out.columns == odd.columns and all((r["__text"], r["__score"], r["__id"], r["__h"], r["__gone"], r["__key"]) == ("t", "s", "i", "h", "g", "k") for r in got)
        assert kept[name] in (None, len(got)), (name, len(got))
    of = {(r.doc_id, r.text) for r in corpus_pipeline.lines(spark, odd, DATA).collect()}
    assert {t for i, t in of if i in (4, 7)} == {long, ""} and (1, None) in of and (3, "a b c") in of
