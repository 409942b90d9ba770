"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Checks row count, column names and types, and an order-insensitive comparison
of values (doubles rounded to 6 places).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN"}


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, int(v))
    if isinstance(v, float):
        if math.isnan(v):
            return (2, "nan")
        return (1, round(v, 6) + 0.0)
    if isinstance(v, int):
        return (1, float(v))
    if hasattr(v, "toArray"):
        return (3, str([round(x, 6) for x in v.toArray()]))
    if isinstance(v, (list, tuple)):
        return (3, str([_norm(x) for x in v]))
    return (4, str(v))


def normalize(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name, fn, sql):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    if sql is None:
        return dict(name=name, rows=len(srows), oracle=None, sec=round(t1 - t0, 2))
    rel = con.sql(sql)
    ocols, otypes = rel.columns, [str(t) for t in rel.types]
    orows = rel.fetchall()
    res = dict(name=name, rows=len(srows), orows=len(orows), sec=round(t1 - t0, 2))
    res["cols_ok"] = sorted(scols) == sorted(ocols)
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in sdf.schema.fields}
    res["types_ok"] = all(stypes.get(c) == t for c, t in zip(ocols, otypes))
    if not res["cols_ok"]:
        res["cols"] = (sorted(set(scols) - set(ocols))[:8], sorted(set(ocols) - set(scols))[:8])
        res["ok"] = False
        return res
    a, b = normalize(srows, scols), normalize(orows, ocols)
    res["ok"] = a == b and res["types_ok"]
    if not res["ok"]:
        diff = [x for x in a if x not in set(b)][:2]
        res["spark_only"] = diff
        res["oracle_only"] = [x for x in b if x not in set(a)][:2]
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as entry
    from lendfeat.session import local_session

    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            res = compare(spark, con, sf_dir, name, fn, sqls.get(name))
        except Exception as e:  # report and go on
            res = dict(name=name, ok=False, error=f"{type(e).__name__}: {str(e)[:300]}")
        if res.get("ok") is False:
            bad += 1
        print(res, flush=True)
    print(f"mismatches: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
