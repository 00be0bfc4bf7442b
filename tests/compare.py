"""Runs queries and their SQL side by side and compares the rows as multisets, types included as far as both engines share them."""

from __future__ import annotations

import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _tagged(v):
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, Decimal):
        return ("decimal", str(v))
    if isinstance(v, datetime):
        return ("time", v.isoformat())
    if isinstance(v, date):
        return ("date", v.isoformat())
    return v


def rows(names, data) -> Counter:
    order = sorted(range(len(names)), key=lambda k: names[k])
    return Counter(tuple(_tagged(r[k]) for k in order) for r in data)


def difference(df: DataFrame, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if got == want:
        return None
    extra, missing = got - want, want - got
    return f"rows {sum(got.values())} vs {sum(want.values())}; extra {list(extra.items())[:2]}; missing {list(missing.items())[:2]}"


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as e

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = duck(sf), e.oracle_sql(), 0
    for name, query in e.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                result = difference(query(spark, sf), con, oracles[name])
            else:
                result = f"no SQL; {query(spark, sf).count()} rows"
        except Exception as problem:  # noqa: BLE001
            result = f"{type(problem).__name__}: {str(problem)[:600]}"
        bad += result is not None
        print(f"{name:34s} {time.time() - start:6.2f}s {'ok' if result is None else result}", flush=True)
    print("not equal:", bad)
