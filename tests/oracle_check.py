"""Run registered queries on Spark and their oracle SQL on DuckDB, and
compare row count, column names/types and values (order-insensitive).

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(float(v))
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return str(v)


def rows_of(records, cols):
    out = [tuple(_norm(r[c]) for c in cols) for r in records]
    return sorted(out, key=lambda t: tuple("" if x is None else x for x in t))


def compare(spark_df, duck_rel_df):
    """spark_df: pyspark DataFrame; duck_rel_df: pandas DataFrame."""
    s_cols = sorted(spark_df.columns)
    d_cols = sorted(duck_rel_df.columns)
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    s_rows = rows_of([r.asDict() for r in spark_df.collect()], s_cols)
    d_recs = duck_rel_df.astype(object).where(duck_rel_df.notna(), None).to_dict("records")
    d_rows = rows_of(d_recs, d_cols)
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    bad = [(a, b) for a, b in zip(s_rows, d_rows) if a != b]
    if bad:
        return False, f"{len(bad)} rows differ, e.g. spark={bad[0][0]} duck={bad[0][1]}"
    return True, f"{len(s_rows)} rows"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and "/" in argv[1] else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if "/" not in a]
    from fraudlens.session import get_session
    import __spark_entry__ as E
    spark = get_session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    con = duck_connect(sf_dir)
    qs, sql = E.queries(), E.oracle_sql()
    ok_all = True
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            if name not in sql:
                n = df.count()
                print(f"ROWS  {name}: {n} rows (no oracle) {time.time()-t0:.1f}s", flush=True)
                continue
            dd = con.execute(sql[name]).df()
            ok, msg = compare(df, dd)
        except Exception as e:  # report and continue
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        ok_all &= ok
        print(f"{'OK  ' if ok else 'FAIL'}  {name}: {msg} {time.time()-t0:.1f}s", flush=True)
    return 0 if ok_all else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
