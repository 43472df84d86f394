"""The comparison with SQL: row counts, column names and values, whatever the order."""

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def run_sql(sql: str, data: str) -> pd.DataFrame:
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return c.sql(sql).df()


def rows(df: pd.DataFrame) -> list[tuple]:
    return sorted(tuple(str(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


def assert_same(got: pd.DataFrame, want: pd.DataFrame) -> None:
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
