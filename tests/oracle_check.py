"""Run catalogue queries in Spark and DuckDB and compare results.

Mirrors the driver's correctness gate: row count, column names/types and an
order-insensitive comparison of values (columns sorted by name).

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


SPARK_TO_DUCK = {
    "LongType": "BIGINT",
    "IntegerType": "INTEGER",
    "ShortType": "SMALLINT",
    "ByteType": "TINYINT",
    "DoubleType": "DOUBLE",
    "FloatType": "FLOAT",
    "StringType": "VARCHAR",
    "BooleanType": "BOOLEAN",
}


def compare(spark, sf_dir: str, name: str, q, sql: str | None, con) -> dict:
    t = time.time()
    df = q(spark, sf_dir)
    cols = sorted(df.columns)
    stypes = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__, type(f.dataType).__name__) for f in df.schema.fields}
    rows = [tuple(norm(r[c]) for c in cols) for r in df.collect()]
    ts = time.time() - t
    out = {"name": name, "rows": len(rows), "spark_s": round(ts, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    t = time.time()
    rel = con.sql(sql)
    dcols = rel.columns
    data = rel.fetchall()
    out["duck_s"] = round(time.time() - t, 2)
    if sorted(dcols) != cols:
        out["status"] = f"COLUMNS spark={cols} duck={sorted(dcols)}"
        return out
    dtypes = dict(zip(dcols, (str(t) for t in rel.types)))
    bad_types = {c: (stypes[c], dtypes[c]) for c in cols if stypes[c] != dtypes[c]}
    if bad_types:
        out["status"] = f"TYPES {bad_types}"
        return out
    idx = [dcols.index(c) for c in cols]
    drows = [tuple(norm(r[i]) for i in idx) for r in data]
    if len(drows) != len(rows):
        out["status"] = f"ROWCOUNT spark={len(rows)} duck={len(drows)}"
        return out
    a, b = Counter(rows), Counter(drows)
    if a != b:
        only_s = list((a - b).elements())[:3]
        only_d = list((b - a).elements())[:3]
        out["status"] = f"VALUES spark-only={only_s} duck-only={only_d}"
        return out
    out["status"] = "ok"
    return out


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    import __spark_entry__ as E
    from covisit_spark.session import get_spark

    spark = get_spark(shuffle_partitions=8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, q in qs.items():
        if only and name not in only:
            continue
        try:
            r = compare(spark, sf_dir, name, q, sqls.get(name), con)
        except Exception as e:  # noqa: BLE001
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(qs)} queries, {len(sqls)} oracles, {bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
