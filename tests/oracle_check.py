"""Run every registered query in Spark and its SQL in DuckDB; compare like the driver does.

Usage: ``python tests/oracle_check.py [--plain] [sf_dir] [name ...]``. Prints one line per
query and a summary; exits non-zero on any mismatch.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from tessera.plans.views import TABLES  # noqa: E402
from tessera.session import get_session  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(float(v))
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    return str(v)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def type_diff(sdf, con, sql) -> dict:
    """Columns whose Spark type and SQL result type differ."""
    st = {c: SPARK_TO_DUCK.get(t, t) for c, t in sdf.dtypes}
    dt = {r[0]: r[1] for r in con.execute(f"DESCRIBE ({sql})").fetchall()}
    return {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(str(norm(r[i])) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def main() -> int:
    args = [a for a in sys.argv[1:] if a != "--plain"]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    only = set(args[1:])
    if "--plain" in sys.argv:
        # A bare session like the driver's: none of this package's settings.
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
                 .config("spark.ui.enabled", "false").getOrCreate())
    else:
        spark = get_session("local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "8g", "spark.ui.enabled": "false"})
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            s_cols = sdf.columns
            s_rows = [tuple(r) for r in sdf.collect()]
        except Exception as exc:  # noqa: BLE001
            print(f"ERROR  {name}: spark failed: {str(exc)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS   {name}: {len(s_rows)} rows ({ts:.1f}s) [no oracle]")
            continue
        try:
            res = con.execute(sqls[name])
            d_cols = [c[0] for c in res.description]
            d_rows = res.fetchall()
        except Exception as exc:  # noqa: BLE001
            print(f"ERROR  {name}: duckdb failed: {str(exc)[:400]}")
            bad += 1
            continue
        if sorted(s_cols) != sorted(d_cols):
            print(f"SCHEMA {name}: spark {sorted(s_cols)} vs sql {sorted(d_cols)}")
            bad += 1
            continue
        tdiff = type_diff(sdf, con, sqls[name])
        if tdiff:
            print(f"TYPES  {name}: {tdiff}")
            bad += 1
            continue
        hs, ls = digest(s_cols, s_rows)
        hd, ld = digest(d_cols, d_rows)
        if len(s_rows) != len(d_rows) or hs != hd:
            diff_s = sorted(set(ls) - set(ld))[:3]
            diff_d = sorted(set(ld) - set(ls))[:3]
            print(f"DIFF   {name}: rows {len(s_rows)} vs {len(d_rows)}\n   spark-only {diff_s}\n   sql-only   {diff_d}")
            bad += 1
        else:
            print(f"OK     {name}: {len(s_rows)} rows ({ts:.1f}s)")
    print(f"mismatches: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
