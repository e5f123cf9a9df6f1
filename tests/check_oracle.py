"""Compare every registered query with its SQL twin: python tests/check_oracle.py [sf_dir] [name ...]."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v: object) -> object:
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    if hasattr(v, "as_tuple"):
        return float(v)
    return v


def table(columns: list[str], rows: list) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([_plain(r[i]) for i in order]) for r in rows)


def differences(df, con, sql: str, shown: int = 4) -> str | None:
    """What differs between the query and its twin, or None."""
    rows = df.collect()
    res = con.execute(sql)
    names = [c[0] for c in res.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    ours, theirs = table(df.columns, rows), table(names, res.fetchall())
    if ours == theirs:
        return None
    a, b = set(ours), set(theirs)
    only_a, only_b = sorted(a - b)[:shown], sorted(b - a)[:shown]
    return f"{len(ours)} vs {len(theirs)} rows\n   spark {only_a}\n   sql   {only_b}"


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    wanted, sqls, bad = argv[1:], entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        started = time.time()
        try:
            if name in sqls:
                diff = differences(fn(spark, sf_dir), con, sqls[name])
                state = "ok  " if diff is None else "DIFF"
            else:
                n = fn(spark, sf_dir).count()
                diff, state = None, f"rows {n}"
        except Exception as e:  # noqa: BLE001
            diff, state = f"{type(e).__name__}: {str(e)[:600]}", "FAIL"
        bad += state in ("DIFF", "FAIL")
        print(f"{state} {time.time() - started:6.2f}s {name}" + (f"\n   {diff}" if diff else ""), flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
