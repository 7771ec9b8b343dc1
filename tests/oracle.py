"""Compare registered queries with their DuckDB twins."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, int):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return int(v) if v == int(v) and abs(v) < 1e15 else float(repr(v))
    if isinstance(v, (datetime.datetime, datetime.date)):
        return str(v)
    if isinstance(v, (list, tuple)):
        return tuple(canonical(x) for x in v)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(canonical(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, plan, sql, sf_dir):
    """None if equal, otherwise what differs."""
    df = plan(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}; only here {[g for g in got if g not in want][:3]}; only there {[w for w in want if w not in got][:3]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ: {bad[:3]}" if bad else None


def main():
    from pyspark.sql import SparkSession

    sys.path.insert(0, ".")
    import __spark_entry__ as entry

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", os.environ.get("ORACLE_PARTITIONS", "8"))
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    plans, sqls = entry.queries(), entry.oracle_sql()
    failures = 0
    for name, plan in plans.items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, plan, sqls[name], sf_dir)
            else:
                n = len(plan(spark, sf_dir).collect())
                problem = None if n else "no rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failures += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {'sql ' if name in sqls else 'rows'} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{failures} failures")


if __name__ == "__main__":
    main()
