"""Run registered queries in Spark and their DuckDB twins on the same
parquet tables and compare row count, column names and an order-insensitive
value hash (doubles rounded to 6 digits). Usable from pytest and as a script:

    python tests/oracle_harness.py [sf_dir] [key ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{round(v, 6):.6f}"
    if isinstance(v, bool):
        return "true" if v else "false"
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


SPARK_TO_DUCK = {
    "IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE", "FloatType": "FLOAT",
    "StringType": "VARCHAR", "BooleanType": "BOOLEAN", "DateType": "DATE", "ShortType": "SMALLINT",
    "TimestampNTZType": "TIMESTAMP", "TimestampType": "TIMESTAMP WITH TIME ZONE",
}


def spark_types(df):
    return {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__, type(f.dataType).__name__) for f in df.schema.fields}


def compare(spark, con, key, sf_dir, qfn, sql):
    t0 = time.time()
    sdf = qfn(spark, sf_dir)
    scols = sdf.columns
    stypes = spark_types(sdf)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    dtypes = {d[0]: str(d[1]) for d in res.description}
    drows = res.fetchall()
    t2 = time.time()
    sh, sl = digest(scols, srows)
    dh, dl = digest(dcols, drows)
    out = {
        "key": key, "spark_rows": len(srows), "oracle_rows": len(drows),
        "cols_match": sorted(scols) == sorted(dcols), "hash_match": sh == dh,
        "types_match": stypes == dtypes,
        "spark_sec": round(t1 - t0, 2), "oracle_sec": round(t2 - t1, 2),
    }
    if stypes != dtypes:
        out["type_diff"] = {c: (stypes.get(c), dtypes.get(c)) for c in set(stypes) | set(dtypes) if stypes.get(c) != dtypes.get(c)}
    if sh != dh:
        sset, dset = set(sl), set(dl)
        out["only_spark"] = [x[:300] for x in sorted(sset - dset)[:3]]
        out["only_oracle"] = [x[:300] for x in sorted(dset - sset)[:3]]
        out["spark_cols"], out["oracle_cols"] = scols, dcols
    return out


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from talewright.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    spark = local_session(8, 8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    keys = keys or list(qs)
    bad = 0
    for k in keys:
        if k not in sqls:
            df = qs[k](spark, sf_dir)
            print({"key": k, "rows_only": df.count()})
            continue
        try:
            r = compare(spark, con, k, sf_dir, qs[k], sqls[k])
        except Exception as e:  # report and go on
            r = {"key": k, "error": repr(e)[:800]}
        ok = r.get("hash_match") and r.get("cols_match") and r.get("types_match")
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(keys) - bad}/{len(keys)} match")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
