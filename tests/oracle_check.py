"""Runs registered queries next to their oracles: ``python tests/oracle_check.py [folder] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck(folder: str):
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return connection


def _cell(value):
    if hasattr(value, "item"):
        value = value.item()
    if pandas.isna(value):
        return "∅"
    if hasattr(value, "isoformat"):
        return str(value)[:10] if str(value).endswith("00:00:00") else str(value)
    return repr(float(value)) if isinstance(value, (int, float)) and not isinstance(value, bool) else repr(value)


def _rows(pdf):
    pdf = pdf[sorted(pdf.columns)].astype(object)
    return sorted(tuple(_cell(v) for v in row) for row in pdf.itertuples(index=False))


def compare(spark, connection, folder: str, name: str) -> str:
    """Empty if the query and its oracle agree on columns, types of values and rows."""
    from __spark_entry__ import oracle_sql, queries

    got = queries()[name](spark, folder).toPandas()
    sql = oracle_sql().get(name)
    if sql is None:
        return "" if len(got) else "no rows"
    want = connection.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(set(got.columns) ^ set(want.columns))}"
    left, right = _rows(got), _rows(want)
    if left != right:
        only, other = sorted(set(left) - set(right))[:2], sorted(set(right) - set(left))[:2]
        return f"rows {len(left)} and {len(right)}; only here {only}; only there {other}"
    return "" if left else "no rows"


if __name__ == "__main__":
    from __spark_entry__ import queries
    from slotflow.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session, database = local_session(8), duck(folder)
    bad = 0
    for query in sys.argv[2:] or queries():
        start = time.time()
        try:
            problem = compare(session, database, folder, query)
        except Exception as error:  # report and go on with the others
            problem = f"{type(error).__name__} {str(error)[:600]}"
        bad += bool(problem)
        print(f"{query:28s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    sys.exit(bool(bad))
