"""Run registered queries next to their SQL in DuckDB and compare the values."""

from __future__ import annotations

import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _rows(names, tuples):
    order = sorted(range(len(names)), key=lambda i: names[i])
    def norm(v):
        if isinstance(v, float):
            return "nan" if v != v else repr(v + 0.0)
        if isinstance(v, bool) or v is None:
            return repr(v)
        if hasattr(v, "isoformat"):
            return v.isoformat()
        if isinstance(v, int):
            return repr(v)
        try:
            if v == int(v):
                return repr(float(v))
            return repr(float(v))
        except (TypeError, ValueError):
            return repr(v)
    return [names[i] for i in order], sorted(tuple(norm(t[i]) for i in order) for t in tuples)


def compare(spark, con, fn, sql: str, sf: str):
    df = fn(spark, sf)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want = _rows([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    if got[1] != want[1]:
        a, b = set(got[1]) - set(want[1]), set(want[1]) - set(got[1])
        return f"{len(a)} rows differ of {len(want[1])}, {got[0]}: {sorted(a)[:2]} vs {sorted(b)[:2]}"
    return None


def nan_columns(df):
    return [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tidemark.session import build_session

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(
        "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    sqls = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if argv and not any(name.startswith(a) for a in argv):
            continue
        t = time.time()
        try:
            if name in sqls:
                err = compare(spark, con, fn, sqls[name], sf)
                n = con.execute(f"SELECT count(*) FROM ({sqls[name]}) q").fetchall()[0][0]
                note = "ok" if err is None else "DIFF " + err
                note = f"{note} n={n}"
            else:
                note, err = f"rows only: {fn(spark, sf).count()}", None
        except Exception as e:  # noqa: BLE001
            err = note = "FAIL " + type(e).__name__ + " " + str(e)[:600]
        bad += err is not None
        print(f"{name:34s} {time.time() - t:6.1f}s  {note}", flush=True)
    print("bad:", bad)
    os._exit(bad > 0)


if __name__ == "__main__":
    main(sys.argv[1:])
