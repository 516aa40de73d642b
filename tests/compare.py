"""Run registered queries against their SQL counterpart: names, types and values."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> str | None:
    """None when equal, otherwise what differs."""
    df = query(spark, sf_dir)
    got_names = df.columns
    got = _rows(got_names, df.collect())
    cur = con.execute(sql)
    want_names = [c[0] for c in cur.description]
    want = _rows(want_names, cur.fetchall())
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(set(got_names) ^ set(want_names))}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want, strict=True)
           if repr(g) != repr(w) or [type(x) for x in g] != [type(x) for x in w]]
    return f"{len(bad)} of {len(got)} rows, e.g.\n   {bad[0][0]}\n   {bad[0][1]}" if bad else None


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as entry
    from barloom.session import build_session

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    con, oracle = connect(sf_dir), entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in oracle:
                problem = compare(spark, con, name, query, oracle[name], sf_dir)
                rows = ""
            else:
                problem, rows = None, f" (rows only: {query(spark, sf_dir).count()})"
        except Exception as e:  # noqa: BLE001
            problem, rows = f"{type(e).__name__}: {str(e)[:400]}", ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s{rows} {problem or ''}", flush=True)
    print("failed:", failed)
