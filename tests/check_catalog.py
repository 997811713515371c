"""Compare every registered query with its SQL twin: ``python tests/check_catalog.py [sf] [names]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as contract  # noqa: E402
from lettings import session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem documents embeddings pages benchmark labels".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value if value is None or isinstance(value, int | bool) else str(value)


def _sorted(names: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def compare(connection, spark, folder: str, name: str) -> tuple[bool, str]:
    frame = contract.queries()[name](spark, folder)
    ours = [tuple(row) for row in frame.collect()]
    cursor = connection.execute(contract.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    theirs = cursor.fetchall()
    if sorted(frame.columns) != sorted(names):
        return False, f"columns {sorted(frame.columns)} != {sorted(names)}"
    left, right = _sorted(frame.columns, ours), _sorted(names, theirs)
    if left == right:
        return True, f"{len(left)} rows"
    extra = [row for row in left if row not in set(right)][:2]
    lack = [row for row in right if row not in set(left)][:2]
    return False, f"{len(left)} vs {len(right)} rows; ours {extra}; theirs {lack}"


def main() -> None:
    folder = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    wanted = sys.argv[2:] or list(contract.queries())
    spark = session.build(
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failures = 0
    for name in wanted:
        began = time.time()
        try:
            good, note = compare(connection, spark, folder, name)
        except Exception as error:  # report and go on with the next query
            good, note = False, f"{type(error).__name__}: {str(error)[:700]}"
        failures += not good
        print(f"{'ok  ' if good else 'FAIL'} {name} {time.time() - began:.1f}s {note}", flush=True)
    print(f"{len(wanted) - failures} of {len(wanted)} match")


if __name__ == "__main__":
    main()
