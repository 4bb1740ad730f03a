"""Runs registered queries against their DuckDB check SQL the way the driver does."""

from __future__ import annotations

import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None:
        return "null"
    if isinstance(v, float):
        return "null" if v != v else repr(v + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_cell(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_cell(x)}" for k, x in v.items()) + "}"
    if hasattr(v, "asDict"):
        return _cell(v.asDict())
    return str(v)


def differences(df, sql: str, con) -> list[str]:
    cols = sorted(df.columns)
    left = sorted(tuple(_cell(r[c]) for c in cols) for r in df.collect())
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    if sorted(names) != cols:
        return [f"columns {cols} vs {sorted(names)}"]
    order = [names.index(c) for c in cols]
    right = sorted(tuple(_cell(r[i]) for i in order) for r in rel.fetchall())
    if len(left) != len(right):
        only_l = [x for x in left if x not in set(right)][:2]
        only_r = [x for x in right if x not in set(left)][:2]
        return [f"rows {len(left)} vs {len(right)}; spark only {only_l}; sql only {only_r}"]
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        a, b = bad[0]
        cells = [(c, x, y) for c, x, y in zip(cols, a, b) if x != y][:4]
        return [f"{len(bad)} rows differ, first: {cells}"]
    return []


def main(pattern: str, sf_dir: str = "/root/testdata/sf0.01") -> int:
    import re

    from __spark_entry__ import oracle_sql, queries
    from tapeline.session import build_session, clear_work

    spark = build_session(cores=8)
    spark.sparkContext.setLogLevel("ERROR")
    zone = os.environ.get("COMPARE_TIME_ZONE")
    if zone:
        spark.conf.set("spark.sql.session.timeZone", zone)
    con = connect(sf_dir)
    checks, failed = oracle_sql(), 0
    for name, fn in queries().items():
        if not re.search(pattern, name):
            continue
        start = time.time()
        try:
            if name in checks:
                df = fn(spark, sf_dir)
                diff = differences(df, checks[name], con)
                note = diff[0] if diff else f"ok {con.execute('SELECT count(*) FROM (' + checks[name] + ')').fetchone()[0]} rows"
            else:
                note = f"no sql, {fn(spark, sf_dir).count()} rows"
        except Exception as exc:  # noqa: BLE001
            note = f"ERROR {type(exc).__name__}: {str(exc)[:700]}"
        clear_work(spark)
        failed += not note.startswith(("ok", "no sql"))
        print(f"{name:40s} {time.time() - start:6.2f}s  {note}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(*(sys.argv[1:] or ["."])) else 0)
