"""Runs queries beside their SQL oracles: ``python tests/oracle_check.py SF_DIR [NAME...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canonical(rows: list[tuple]) -> list[tuple]:
    def value(x):
        if isinstance(x, float):
            return float(f"{x:.9g}")
        if hasattr(x, "isoformat"):
            return x.isoformat()
        if type(x).__name__ == "Decimal":
            return float(f"{float(x):.9g}")
        if isinstance(x, (list, tuple)):
            return tuple(map(value, x))
        return x

    return sorted((tuple(map(value, r)) for r in rows), key=repr)


def compare(spark, sf_dir: str, name: str, query, sql: str | None) -> str:
    import duckdb

    began = time.time()
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    ours = canonical([tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()])
    took = time.time() - began
    if sql is None:
        return f"rows only: {len(ours)} ({took:.1f} s)"
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    rel = con.sql(sql)
    if sorted(rel.columns) != columns:
        return f"COLUMNS {columns} {sorted(rel.columns)}"
    theirs = canonical(rel.project(", ".join(f'"{c}"' for c in columns)).fetchall())
    if ours != theirs:
        extra, missing = [r for r in ours if r not in theirs][:2], [r for r in theirs if r not in ours][:2]
        return f"DIFFERS {len(ours)} {len(theirs)} ours {extra} oracle {missing}"
    return f"equal: {len(ours)} ({took:.1f} s)"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.driver.memory", "6g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in sys.argv[2:] or queries:
        try:
            print(name, compare(spark, sys.argv[1], name, queries[name], oracles.get(name)), flush=True)
        except Exception as e:  # noqa: BLE001
            print(name, "FAILED", str(e)[:600].replace("\n", " "), flush=True)
