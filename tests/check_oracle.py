"""Compare every named query with its SQL: ``python tests/check_oracle.py [sf_dir] [names...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

from __spark_entry__ import oracle_sql, queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(r[i] for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, con, folder: str, name: str) -> tuple[bool, str]:
    started = time.time()
    df = queries()[name](spark, folder)
    got = rows_of(df.columns, df.collect())
    took = time.time() - started
    sql = oracle_sql().get(name)
    if sql is None:
        return len(got[1]) > 0, f"{len(got[1])} rows, no oracle, {took:.1f}s"
    cur = con.execute(sql)
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got == want:
        return True, f"{len(got[1])} rows, {took:.1f}s"
    if got[0] != want[0]:
        return False, f"columns {got[0]} != {want[0]}"
    missing = [r for r in want[1] if r not in set(got[1])][:3]
    extra = [r for r in got[1] if r not in set(want[1])][:3]
    return False, f"rows {len(got[1])} != {len(want[1])}; columns {got[0]}; expected {missing}; got {extra}"


if __name__ == "__main__":
    from stayline.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(queries())
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    bad = 0
    for name in names:
        try:
            ok, note = compare(spark, con, folder, name)
        except Exception as err:
            ok, note = False, f"{type(err).__name__}: {str(err)[:1500]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print(f"{len(names) - bad}/{len(names)} agree")
