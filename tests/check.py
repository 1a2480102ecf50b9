"""Run every registered query beside its SQL counterpart: ``python tests/check.py [sf] [names...]``."""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402
from ridgeline.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

KINDS = {"DOUBLE": "double", "BIGINT": "bigint", "VARCHAR": "string", "BOOLEAN": "boolean", "INTEGER": "int"}


def duck(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def rows_of(names, rows):
    """Rows with columns in name order, sorted; floats exactly."""
    order = sorted(range(len(names)), key=lambda i: names[i])

    def plain(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v) if v else "0"
        return "" if v is None else str(v)
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def same(df, con, sql):
    """Whether the frame and the SQL agree, and a note."""
    got_names = df.columns
    got = rows_of(got_names, df.collect())
    res = con.execute(sql)
    described = res.description
    want_names = [d[0] for d in described]
    want = rows_of(want_names, res.fetchall())
    if sorted(got_names) != sorted(want_names):
        return False, f"columns {sorted(got_names)} / {sorted(want_names)}"
    if len(got) != len(want):
        return False, f"rows {len(got)} / {len(want)}"
    kinds = dict(df.dtypes)
    odd = {d[0]: (kinds[d[0]], str(d[1])) for d in described if KINDS.get(str(d[1])) != kinds[d[0]]}
    if odd:
        return False, f"types {odd}"
    wrong = [(a, b) for a, b in zip(got, want) if a != b]
    return not wrong, f"{len(got)} rows" + (f", {len(wrong)} differ, first {wrong[0]}" if wrong else "")


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = duck(folder), entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            if name in sql:
                good, note = same(fn(spark, folder), con, sql[name])
            else:
                good, note = True, f"{len(fn(spark, folder).collect())} rows only"
        except Exception as e:  # report and go on with the next query
            good, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not good
        print(f"{'ok ' if good else 'BAD'} {name} {time.time() - start:.1f}s {note}", flush=True)
    print("bad:", bad)
