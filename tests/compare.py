"""Run named queries on Spark and their SQL on DuckDB, and compare the results."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
    benchmark labels conversations""".split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    clean = lambda v: repr(list(v)) if isinstance(v, (list, tuple)) else repr(v)
    return sorted(tuple(clean(r[i]) for i in order) for r in rows)


def difference(spark, con, name, queries, oracles, folder) -> tuple[str | None, int, float, float]:
    start = time.time()
    df = queries[name](spark, folder)
    got = df.collect()
    spark_time = time.time() - start
    if name not in oracles:
        return None, len(got), spark_time, 0.0
    start = time.time()
    cur = con.execute(oracles[name])
    names = [c[0] for c in cur.description]
    want = cur.fetchall()
    duck_time = time.time() - start
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got), spark_time, duck_time
    a, b = _rows(df.columns, got), _rows(names, want)
    if a == b:
        return None, len(got), spark_time, duck_time
    only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    note = f"{len(a)} vs {len(b)} rows; spark only {len(only_a)}, sql only {len(only_b)}"
    for x, y in list(zip(only_a, only_b))[:2]:
        for u, v in zip(x, y):
            if u != v:
                at = next((i for i, (p, q) in enumerate(zip(u, v)) if p != q), min(len(u), len(v)))
                note += f"\n    {u[max(0, at - 40):at + 60]}\n    {v[max(0, at - 40):at + 60]}"
    if len(only_a) != len(only_b):
        note += f"\n    {str(only_a[:1])[:300]}\n    {str(only_b[:1])[:300]}"
    return note, len(got), spark_time, duck_time


if __name__ == "__main__":
    sys.path.insert(0, str(__import__("pathlib").Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from wordloom.session import build_session

    folder = sys.argv[1]
    spark = build_session("local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="12g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    con = connect(folder)
    bad = 0
    for name in sys.argv[2:] or list(queries):
        try:
            note, n, s, q = difference(spark, con, name, queries, oracles, folder)
        except Exception as e:
            note, n, s, q = f"{type(e).__name__}: {str(e)[:700]}", -1, 0, 0
        bad += note is not None
        kind = "sql " if name in oracles else "rows"
        print(f"{'ok  ' if note is None else 'FAIL'} {kind} {name:28s} rows={n:7d} spark={s:6.2f} duck={q:6.2f} {note or ''}", flush=True)
    print("failures:", bad)
