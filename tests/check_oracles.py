"""Compares registered queries with their SQL: python tests/check_oracles.py [sf] [name ...]"""

import datetime
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, list):
        return tuple(map(_plain, value))
    return value


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def differences(spark, con, sf_dir, name, build, sql):
    """Empty if the query and its SQL agree, else what differs."""
    frame = build(spark, sf_dir)
    got = _bag(frame.columns, frame.collect())
    if sql is None:
        return "" if got else "no rows"
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(columns)}"
    want = _bag(columns, cursor.fetchall())
    if got == want:
        return "" if got else "no rows"
    extra, missing = got - want, want - got
    return (
        f"{sum(got.values())} rows against {sum(want.values())}; "
        f"only here {str(list(extra)[:2])[:700]}; only SQL {str(list(missing)[:2])[:700]}"
    )


if __name__ == "__main__":
    import __spark_entry__ as entry
    from threadloom.session import build_session

    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    only = sys.argv[2:]
    session = build_session(
        master="local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    database = connect(sf_dir)
    bad = 0
    for key, build in entry.queries().items():
        if only and key not in only:
            continue
        start = time.time()
        try:
            problem = differences(session, database, sf_dir, key, build, entry.oracle_sql().get(key))
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        print(f"{'BAD ' if problem else 'ok  '} {key} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{bad} bad")
