"""Run registered queries beside their SQL and compare names, types and values."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def kind(value):
    return type(value).__name__


def compare(spark_df, con, sql):
    """None when equal, else a message. Values are compared exactly, order ignored."""
    rel = con.sql(sql)
    names = list(rel.columns)
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    order = sorted(names)
    idx = [names.index(n) for n in order]
    want = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    have = [tuple(r) for r in spark_df.select(*[f"`{n}`" for n in order]).collect()]
    if len(want) != len(have):
        return f"rows {len(have)} != {len(want)}"
    key = lambda r: tuple((v is None, kind(v), v if v is not None else 0) if not isinstance(v, (dict, list)) else (False, "", str(v)) for v in r)
    want, have = sorted(want, key=key), sorted(have, key=key)
    bad = [(h, w) for h, w in zip(have, want) if h != w]
    if bad:
        return f"{len(bad)} of {len(want)} rows differ, columns {order}, e.g. spark {bad[0][0]} sql {bad[0][1]}"
    for i, n in enumerate(order):
        kinds = {kind(r[i]) for r in want + have if r[i] is not None}
        if len(kinds) > 1:
            return f"column {n} has types {kinds}"
    types = dict(spark_df.dtypes)
    duck = dict(zip(names, [str(t) for t in rel.types]))
    pairs = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}
    off = [(n, types[n], duck[n]) for n in order if pairs.get(types[n]) != duck[n]]
    if off:
        return f"TYPES {off}"
    return None


if __name__ == "__main__":
    from plumbline.session import build_session
    from registry import ORACLES, QUERIES

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
    prefixes = tuple(sys.argv[1:])
    spark = build_session("local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name, fn in QUERIES.items():
        if prefixes and not name.startswith(prefixes):
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            if name in ORACLES:
                msg = compare(df, con, ORACLES[name])
                n = ""
            else:
                n = f" rows {len(df.collect())}"
                msg = None
        except Exception as e:  # noqa: BLE001
            msg = f"ERROR {type(e).__name__}: {str(e)[:700]}"
            n = ""
        bad += msg is not None
        print(f"{'ok  ' if msg is None else 'BAD '} {name} {time.time() - t:.2f}s{n} {msg or ''}", flush=True)
    print("bad:", bad)
