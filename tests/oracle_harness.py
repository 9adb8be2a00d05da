"""Run every registered Spark query and its DuckDB oracle on one scale factor and compare.

Usage: ``python tests/oracle_harness.py [sf_dir] [name ...]``. Values are
compared as an order-insensitive multiset of rows after sorting columns by name.
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def canon(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(v + 0.0)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "NaN"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    return str(v)


def rows_of(cols: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(canon(r[i]) for i in order) for r in rows)


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, sf_dir: str, name: str, fn, sql: str | None) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    s_cols = df.columns
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    res["duck_sec"] = round(time.time() - t1, 2)
    res["duck_rows"] = len(d_rows)
    sc, sr = rows_of(s_cols, s_rows)
    dc, dr = rows_of(d_cols, d_rows)
    if sc != dc:
        res["status"] = f"SCHEMA {sc} vs {dc}"
    elif sr != dr:
        diff = [r for r in sr if r not in set(dr)][:3]
        diff2 = [r for r in dr if r not in set(sr)][:3]
        res["status"] = f"VALUES spark-only={diff} duck-only={diff2}"
    else:
        res["status"] = "ok"
    return res


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as E

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = (SparkSession.builder.master("local[8]").appName("oracle-check")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", os.environ.get("HARNESS_TZ", "UTC")).config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, sf_dir, name, fn, sqls.get(name))
        except Exception as e:  # report and continue
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        bad += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
    print(f"{bad} failing of {len([n for n in qs if not names or n in names])}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
