"""Compare every registered query with its SQL: python tests/check_queries.py [folder] [name ...]"""

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rinkflow.plans.catalog import QUERIES, SQL  # noqa: E402
from rinkflow.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


KINDS = {
    "string": ["VARCHAR"],
    "bigint": ["BIGINT", "INTEGER"],
    "int": ["BIGINT", "INTEGER"],
    "double": ["DOUBLE"],
    "boolean": ["BOOLEAN"],
}


def duck(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def cell(value):
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(round(float(value), 6) + 0.0)
    return str(value)


def normalized(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(connection, spark, folder, name):
    """None if equal, else a description of the difference."""
    df = QUERIES[name](spark, folder)
    ours = normalized(df.columns, [tuple(r) for r in df.collect()])
    if name not in SQL:
        return None if ours[1] else "no rows"
    relation = connection.sql(SQL[name])
    theirs = normalized(relation.columns, relation.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} / {len(theirs[1])} rows; {ours[1][:2]} / {theirs[1][:2]}"
    if not ours[1]:
        return "no rows on either side"
    for column, dtype in dict(df.dtypes).items():
        other = str(dict(zip(relation.columns, relation.types))[column])
        if other not in KINDS[dtype]:
            return f"type of {column}: {dtype} / {other}"
    wrong = [(a, b) for a, b in zip(*[ours[1], theirs[1]]) if a != b]
    return f"{len(wrong)} of {len(ours[1])} rows differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(folder)
    failed = []
    for name in names:
        begun = time.time()
        try:
            problem = compare(connection, spark, folder, name)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - begun:.1f}s {problem or ''}", flush=True)
        failed += [name] if problem else []
    print(f"{len(names) - len(failed)} of {len(names)} equal; failed: {failed}")
