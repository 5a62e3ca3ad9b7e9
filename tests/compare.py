"""Run registered queries beside their SQL: python tests/compare.py SF_DIR [NAME...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(df: pd.DataFrame) -> list[tuple]:
    """Rows in a fixed order, columns by name; numbers compare as doubles of 9 digits."""

    def cell(x):
        if x is None or (not isinstance(x, (list, dict)) and pd.isna(x)):
            return ""
        if hasattr(x, "item"):
            x = x.item()
        if isinstance(x, bool):
            return str(x)
        return f"{float(x) + 0.0:.9g}" if isinstance(x, int | float) else str(x)

    df = df[sorted(df.columns)]
    return sorted(tuple(map(cell, r)) for r in df.astype(object).itertuples(index=False))


def difference(spark, sf_dir: str, name: str, con=None) -> str:
    """What differs between a query and its SQL; empty if nothing does."""
    import __spark_entry__ as entry

    got = entry.queries()[name](spark, sf_dir).toPandas()
    want = (con or connection(sf_dir)).execute(entry.oracle_sql()[name]).fetch_df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} are not {sorted(want.columns)}"
    a, b = normal(got), normal(want)
    if a == b:
        return ""
    only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    return f"{len(a)} and {len(b)} rows, {len(only_a)} and {len(only_b)} only on one side\n  {only_a[:3]}\n  {only_b[:3]}"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con = connection(sys.argv[1])
    for name in sys.argv[2:] or entry.oracle_sql():
        began = time.time()
        try:
            found = difference(spark, sys.argv[1], name, con)
        except Exception as e:  # noqa: BLE001 - a report of all queries
            found = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - began:.1f} s {found}", flush=True)
