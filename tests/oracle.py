"""Comparison of a query with its SQL on the smallest test tables."""

import duckdb
import pandas as pd

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        kind = str(df[c].dtype)
        if kind.startswith("datetime"):
            df[c] = df[c].astype("datetime64[us]").astype(str)
        elif kind == "object" or kind == "str":
            df[c] = df[c].map(lambda v: None if v is None or v is pd.NaT else str(v))
        elif kind != "bool":
            df[c] = df[c].astype(float).round(9) + 0.0
    return df.astype(str).sort_values(list(df.columns)).reset_index(drop=True)


def same(spark_df, sql: str) -> None:
    got, want = plain(spark_df.toPandas()), plain(connection().execute(sql).df())
    pd.testing.assert_frame_equal(got, want)
