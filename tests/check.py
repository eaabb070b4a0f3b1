"""Compare registered queries with their SQL: ``python tests/check.py [names or prefixes]``."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return "null" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return f"date {value}"
    return "null" if value is None else repr(value)


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return sorted(tuple(plain(row[n]) for n in order) for row in rows)


def connect(folder: str = SF_DIR):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return connection


def difference(spark, connection, name, run, sql, folder: str = SF_DIR) -> str | None:
    """None if both sides hold the same rows, else a short account."""
    result = run(spark, folder)
    mine = bag(result.columns, [tuple(r) for r in result.collect()])
    if sql is None:
        return None if mine else "no rows"
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} against {sorted(names)}"
    theirs = bag(names, cursor.fetchall())
    if mine == theirs:
        return None if mine else "no rows on either side"
    only_mine = [r for r in mine if r not in set(theirs)][:2]
    only_theirs = [r for r in theirs if r not in set(mine)][:2]
    return f"{len(mine)} rows against {len(theirs)}\n   spark {only_mine}\n   sql   {only_theirs}"


def main(wanted: list[str]) -> int:
    from tidewell.catalogue import registered
    from tidewell.session import build_session

    spark = build_session("check", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect()
    failures = 0
    for name, q in registered().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        begun = time.time()
        try:
            problem = difference(spark, connection, name, q.run, q.sql)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failures += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - begun:.1f}s {problem or ('' if q.sql else '(no sql)')}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1:])))
