"""Run every query next to its SQL and compare row counts, columns and values.

``python tests/oracle_check.py [sf dir] [query ...]``
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_module  # noqa: E402


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        if frame[c].dtype == object or str(frame[c].dtype) in ("str", "string"):
            frame[c] = frame[c].astype(object).where(frame[c].notna(), None).map(lambda v: "NULL" if v is None else str(v))
        elif frame[c].dtype.kind == "f" and frame[c].isna().any() and (frame[c].dropna() % 1 == 0).all():
            frame[c] = frame[c].astype("Int64")  # long with nulls, which Spark's frames hold as doubles
    return frame.sort_values(list(frame.columns), na_position="first").reset_index(drop=True)


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} / {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} / {len(sql_frame)}"
    a, b = canonical(spark_frame), canonical(sql_frame)
    for c in a.columns:
        kinds = (a[c].dtype.kind, b[c].dtype.kind)
        if kinds[0] != kinds[1] and not {*kinds} <= {"O", "T", "U"}:
            return f"type of {c}: {a[c].dtype} / {b[c].dtype}"
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            at = (~same).idxmax()
            return f"{(~same).sum()} values of {c}, e.g. {a.loc[at].to_dict()} / {b.loc[at].to_dict()}"
    return ""


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name, run in entry_module.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            got = run(spark, sf_dir).toPandas()
        except Exception as error:  # report and go on with the next query
            print(f"ERROR {name}: {str(error)[:600]}", flush=True)
            failed += 1
            continue
        took = time.time() - start
        sql = entry_module.oracle_sql().get(name)
        start = time.time()
        try:
            verdict = "rows only" if sql is None else differences(got, con.execute(sql).fetchdf())
        except Exception as error:
            verdict = f"SQL {str(error)[:600]}"
        failed += verdict not in ("", "rows only")
        print(f"{verdict or 'ok':10s} {name} rows={len(got)} spark={took:.1f}s sql={time.time() - start:.1f}s", flush=True)
    print("failed:", failed)
