"""Run the registered queries on Spark and DuckDB and compare the rows.

Usage: python -m checks.compare [sf dir] [name prefix ...] [spark setting=value ...]
"""

from __future__ import annotations

import sys
import time
import traceback

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.queries import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of(columns: list[str], rows: list) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr(tuple(r[i] for i in order)) for r in rows)


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, name: str) -> str:
    mine = rows_of(df.columns, df.collect())
    result = con.execute(ORACLES[name])
    theirs = rows_of([d[0] for d in result.description], result.fetchall())
    if mine == theirs:
        return f"ok   {name}: {len(mine[1])} rows"
    only = sorted(set(mine[1]) - set(theirs[1]))[:2], sorted(set(theirs[1]) - set(mine[1]))[:2]
    return f"DIFF {name}: {len(mine[1])} / {len(theirs[1])} rows; {mine[0] == theirs[0]}; {only}"


def main() -> int:
    settings = dict(a.split("=", 1) for a in sys.argv[1:] if "=" in a)
    words = [a for a in sys.argv[1:] if "=" not in a]
    sf_dir = words[0] if words else "/root/testdata/sf0.01"
    prefixes = tuple(words[1:])
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in [n for n in QUERIES if not prefixes or n.startswith(prefixes)]:
        started = time.time()
        try:
            line = compare(QUERIES[name](spark, sf_dir), con, name)
        except Exception as error:
            line = f"FAIL {name}: {type(error).__name__} {str(error)[:600]}"
            if prefixes:
                traceback.print_exc()
        bad += not line.startswith("ok")
        print(f"{line}, {time.time() - started:.1f}s", flush=True)
    print(f"{len(QUERIES)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
