"""Run registered Spark queries and their DuckDB oracle SQL side by side.

    python tests/oracle_check.py [sf_dir] [name-substring ...]

Compares row count, column names and an order-insensitive hash of the values
(columns sorted by name, doubles rounded), like the driver's correctness gate.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, bytes):
        return v.hex()
    if hasattr(v, "asDict"):
        return tuple(sorted((k, norm(x)) for k, x in v.asDict().items()))
    return v


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keyed = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha1("\n".join(keyed).encode()).hexdigest()[:12], keyed


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE",
                 "float": "FLOAT", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
                 "timestamp": "TIMESTAMP WITH TIME ZONE", "boolean": "BOOLEAN", "binary": "BLOB"}


def type_diffs(df, res):
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out = []
    for d in res.description:
        st = spark_types.get(d[0])
        if st is None:
            continue
        want = SPARK_TO_DUCK.get(st, st.upper())
        got = str(d[1])
        if want.replace(" ", "") != got.replace(" ", "") and not (st.startswith("decimal") and got.startswith("DECIMAL")):
            out.append(f"{d[0]}: spark {st} vs duckdb {got}")
    return out


def duck(sf_dir):
    con = duckdb.connect()
    if os.environ.get("CHECK_DUCK_TZ"):  # the oracle must not depend on DuckDB's zone either
        con.execute(f"SET TimeZone = '{os.environ['CHECK_DUCK_TZ']}'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from lakeload.session import get_session
    extra = {"spark.sql.session.timeZone": os.environ["CHECK_TZ"]} if os.environ.get("CHECK_TZ") else {}
    if os.environ.get("CHECK_DRIVER_MEM"):  # large results are collected to compare them
        extra["spark.driver.memory"] = os.environ["CHECK_DRIVER_MEM"]
    if os.environ.get("CHECK_PLAIN"):  # a session like the driver's: none of our settings
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8").getOrCreate()
    else:
        spark = get_session("local[8]", shuffle_partitions=8, extra=extra)
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in orc:
            print(f"ROWS {name}: {len(rows)} rows ({ts:.1f}s) cols={cols}")
            continue
        try:
            res = con.execute(orc[name])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:300]}")
            bad += 1
            continue
        tdiff = type_diffs(df, res)
        if tdiff:
            print(f"TYPE {name}: " + "; ".join(tdiff))
        h1, k1 = digest(cols, rows)
        h2, k2 = digest(ocols, orows)
        ok = (len(rows) == len(orows)) and sorted(cols) == sorted(ocols) and h1 == h2
        print(f"{'OK  ' if ok else 'FAIL'} {name}: spark={len(rows)} oracle={len(orows)} ({ts:.1f}s)"
              + ("" if sorted(cols) == sorted(ocols) else f" cols {sorted(cols)} vs {sorted(ocols)}"))
        if not ok:
            bad += 1
            s1, s2 = set(k1), set(k2)
            for x in list(s1 - s2)[:3]:
                print("   spark only :", x[:300])
            for x in list(s2 - s1)[:3]:
                print("   oracle only:", x[:300])
    print(f"failures: {bad}")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
