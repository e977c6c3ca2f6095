"""Run every query beside its SQL and compare the rows value by value.

    python -m verification.check [SF_DIR] [NAME ...]
"""

import math
import sys
import tempfile
import time
from collections import Counter

import duckdb

from verification.catalogue import QUERIES
from verification.oracle import ORACLE
from wardstat.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def oracle_connection(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    return value


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(
        tuple(_cell(row[i]) for i in order) for row in rows)


def difference(frame, con, sql):
    """An empty text if both sides hold the same rows, else what differs."""
    names, got = _bag(frame.columns, frame.collect())
    result = con.execute(sql)
    expected_names, expected = _bag([d[0] for d in result.description], result.fetchall())
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if got != expected:
        return f"only here {list((got - expected).items())[:3]}, " \
               f"only there {list((expected - got).items())[:3]}"
    return ""


def main(sf_dir="/root/testdata/sf0.01", *names):
    spark = build_session(
        "check", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions=8,
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="wardstat-warehouse-"))
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.perf_counter()
        frame = QUERIES[name](spark, sf_dir)
        if name in ORACLE:
            problem = difference(frame, con, ORACLE[name])
        else:
            problem = "" if frame.count() else "no rows"
        verdict = problem or ("ok" if name in ORACLE else "ok (rows only)")
        failed += bool(problem)
        print(f"{name:32s} {time.perf_counter() - start:6.2f}s  {verdict}", flush=True)
    print(f"{failed} failed")
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
