"""Spark-vs-oracle comparison used by the tests and by hand:

    python tests/parity.py /root/testdata/sf0.01 [key ...]

Rows are compared order-insensitively after sorting the columns by name; numbers
are compared exactly as decimals (doubles to 9 significant digits).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

# Doubles are compared bit for bit: every double in a result is one division (or
# square root) of exact sums, so both engines must produce the same value.
EXACT_DOUBLES = os.environ.get("PARITY_EXACT_DOUBLES", "1") == "1"

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if EXACT_DOUBLES:
            return ("n", int(v)) if v.is_integer() and abs(v) < 2 ** 53 else ("f", repr(v))
        return ("n", float(f"{v:.9g}"))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, (int, decimal.Decimal)):
        d = decimal.Decimal(v)
        if d == d.to_integral_value():
            return ("n", int(d))
        return ("n", float(f"{float(d):.9g}")) if abs(d.as_tuple().exponent) > 6 else ("d", d.normalize())
    if isinstance(v, (dt.datetime, dt.date)):
        return ("t", v.isoformat())
    if hasattr(v, "item"):
        return _canon(v.item())
    if isinstance(v, (list, tuple)):
        return ("l", tuple(_canon(x) for x in v))
    return ("s", str(v))


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_canon(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def spark_type(t) -> str:
    """Spark type in DuckDB's spelling, for the schema comparison."""
    from pyspark.sql import types as T
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
        return "INTEGER"
    if isinstance(t, T.LongType):
        return "BIGINT"
    if isinstance(t, T.DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP"
    return {T.StringType: "VARCHAR", T.DoubleType: "DOUBLE", T.FloatType: "FLOAT", T.BooleanType: "BOOLEAN",
            T.DateType: "DATE"}.get(type(t), str(t))


def compare(spark, key: str, sf_dir: str, con=None) -> dict:
    from ledgerlake import catalog
    q = catalog.REGISTRY[key]
    t = time.time()
    sdf = q.run(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {f.name: spark_type(f.dataType) for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    ts = time.time() - t
    res = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(ts, 2)}
    if q.sql is None:
        res["status"] = "no-oracle"
        return res
    con = con or duck(sf_dir)
    t = time.time()
    rel = con.sql(q.sql)
    d_cols = rel.columns
    d_types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    res["oracle_rows"] = len(d_rows)
    res["oracle_sec"] = round(time.time() - t, 2)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"columns differ: spark={sorted(s_cols)} oracle={sorted(d_cols)}"
        return res
    if s_types != d_types:
        res["status"] = f"types differ: { {n: (s_types.get(n), d_types.get(n)) for n in s_types if s_types.get(n) != d_types.get(n)} }"
        return res
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a == b:
        res["status"] = "match"
    else:
        sa, sb = set(a), set(b)
        res["status"] = "values differ"
        res["only_spark"] = [r for r in a if r not in sb][:3]
        res["only_oracle"] = [r for r in b if r not in sa][:3]
        res["cols"] = sorted(s_cols)
    return res


def main(argv):
    from ledgerlake.session import local_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    from ledgerlake import catalog
    keys = argv[2:] or list(catalog.REGISTRY)
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, k, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"key": k, "status": f"error: {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("match", "no-oracle"):
            bad += 1
        print(r, flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
