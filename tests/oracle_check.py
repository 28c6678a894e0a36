"""Compare registered queries with their SQL counterparts, exactly: ``python tests/oracle_check.py [sf] [names]``."""

from __future__ import annotations

import importlib
import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
DATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/sf{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, float) and v == 0:
        return 0.0
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, Counter(tuple(plain(r[c]) for c in cols) for r in df.collect())


def sql_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in cur.fetchall())


def compare(spark, con, query, sql, sf):
    cols, got = spark_rows(query(spark, f"{DATA}/sf{sf}"))
    names, want = sql_rows(con, sql)
    if cols != names:
        return f"columns differ: only spark {set(cols) - set(names)}, only sql {set(names) - set(cols)}"
    if got != want:
        extra, missing = list((got - want).items())[:2], list((want - got).items())[:2]
        return f"rows differ ({sum(got.values())} vs {sum(want.values())}): spark {extra} sql {missing} cols {cols}"
    kinds = [(c, {type(v) for v in vals if v is not None}) for c, vals in zip(cols, zip(*got))]
    kinds_sql = dict(zip(names, ({type(v) for v in vals if v is not None} for vals in zip(*want))))
    off = [c for c, k in kinds if k != kinds_sql.get(c, set())]
    return f"types differ: {off}" if off else None


def main() -> int:
    import __spark_entry__ as entry
    from basketry.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = set()
    for word in sys.argv[2:]:
        if word.endswith("_queries"):
            wanted |= set(importlib.import_module(f"catalog.{word}").CATALOG.queries)
        else:
            wanted.add(word)
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf), 0
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name, query in queries.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, query, oracles[name], sf)
            else:
                problem = None if query(spark, f"{DATA}/sf{sf}").count() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        mark = "ok  " if problem is None else "BAD "
        print(f"{mark}{time.time() - start:6.2f}s {name}{'' if name in oracles else ' (rows only)'} {problem or ''}",
              flush=True)
    print(f"{bad} of {len(wanted or queries)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
