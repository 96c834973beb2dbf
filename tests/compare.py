"""Run registered queries beside their SQL and compare the rows exactly.

``python -m tests.compare [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(rows: list[tuple], columns: list[str]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if value is None:
            return ""
        if isinstance(value, float):
            return "nan" if value != value else repr(value + 0.0)
        return str(value)

    return [columns[i] for i in order], sorted(tuple(cell(row[i]) for i in order) for row in rows)


KINDS = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(spark, con, name: str, query, statement: str | None, sf_dir: str) -> str:
    """Empty when the results agree, else what differs."""
    df = query(spark, sf_dir)
    rows = [tuple(row) for row in df.collect()]
    if not rows:
        return "no rows"
    if statement is None:
        return ""
    relation = con.execute(statement)
    names = [d[0] for d in relation.description]
    kinds = {d[0]: str(d[1]) for d in relation.description}
    expected = relation.fetchall()
    left = canonical(rows, df.columns)
    right = canonical(expected, names)
    if left[0] != right[0]:
        return f"columns differ: {sorted(set(left[0]) ^ set(right[0]))}"
    types = [
        f"{f.name}: {f.dataType.simpleString()} / {kinds[f.name]}"
        for f in df.schema.fields
        if KINDS.get(f.dataType.simpleString()) != kinds[f.name]
    ]
    if types:
        return f"types differ: {types[:8]}"
    if len(left[1]) != len(right[1]):
        return f"row counts differ: {len(left[1])} / {len(right[1])}"
    wrong = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    if wrong:
        a, b = wrong[0]
        cells = [(n, x, y) for n, x, y in zip(left[0], a, b) if x != y]
        return f"{len(wrong)} of {len(rows)} rows differ, first in {cells[:6]}"
    return ""


def main(argv: list[str]) -> int:
    from firnspark.session import local_session

    import __spark_entry__ as contract

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark = local_session(8)
    con = connect(sf_dir)
    statements = contract.oracle_sql()
    failed = 0
    for name, query in contract.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, query, statements.get(name), sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problem)
        label = "ok" if not problem else "FAIL"
        kind = "" if name in statements else " (rows only)"
        print(f"{label:5s}{time.time() - start:7.2f}s {name}{kind} {problem}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    sys.exit(1 if main(sys.argv[1:]) else 0)
