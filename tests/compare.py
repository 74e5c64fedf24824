"""Run queries and their SQL counterparts and compare rows as multisets."""

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.10g}")
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """What differs, or nothing. Value types count: 1 and 1.0 are told apart."""
    cur = con.execute(sql)
    want_columns = [c[0] for c in cur.description]
    if sorted(df.columns) != sorted(want_columns):
        return f"columns {sorted(df.columns)} / {sorted(want_columns)}"
    want = _rows(want_columns, cur.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    types = lambda rows: {
        tuple(type(v).__name__ for v in r) for r in rows if None not in r
    }
    if got != want:
        return (
            f"rows {sum(got.values())} / {sum(want.values())}, "
            f"only Spark {list((got - want).items())[:2]}, "
            f"only SQL {list((want - got).items())[:2]}"
        )
    if types(got) != types(want):
        return f"types {types(got) ^ types(want)}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from turnstile import registry, session

    folder, names = sys.argv[1], sys.argv[2:]
    spark = session.session("local[8]", spark_sql_shuffle_partitions="8", spark_driver_memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(folder), registry.oracle_sql()
    bad = 0
    for name, run in registry.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            why = difference(run(spark, folder), con, sql[name])
        except Exception as error:
            why = f"{type(error).__name__}: {str(error)[:600]}"
        bad += why is not None
        print(f"{name:36} {time.time() - start:6.2f}s {why or 'ok'}", flush=True)
    missing = set(sql) ^ set(registry.queries())
    print("bad:", bad, "unpaired:", missing)
