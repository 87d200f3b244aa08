"""Runs registered queries beside their SQL and compares the rows."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(map(repr, (row[i] for i in order))) for row in rows)


def difference(spark, con, sf_dir: str, make, sql: str) -> str | None:
    """None if both give the same columns and rows, else what differs."""
    ours = make(spark, sf_dir)
    theirs = con.sql(sql)
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} and {sorted(theirs.columns)}"
    left = normal([tuple(r) for r in ours.collect()], ours.columns)
    right = normal(theirs.fetchall(), theirs.columns)
    if left == right:
        return None if left else "no rows"
    only_left, only_right = sorted(set(left) - set(right)), sorted(set(right) - set(left))
    return f"{len(left)} and {len(right)} rows; ours {only_left[:3]}; theirs {only_right[:3]}"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connection(sf_dir), entry.oracle_sql()
    for name, make in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            found = difference(spark, con, sf_dir, make, sql[name])
        except Exception as failure:
            found = f"{type(failure).__name__}: {str(failure)[:600]}"
        print(f"{name:28} {time.time() - start:6.2f}s {found or 'ok'}", flush=True)
