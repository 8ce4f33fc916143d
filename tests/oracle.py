"""Side-by-side comparison of a registered query with its SQL on DuckDB."""

from __future__ import annotations

import math

import duckdb

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
benchmark labels conversations""".split()


def connect(folder: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return db


def _plain(value):
    if hasattr(value, "as_integer_ratio") and isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: [(v is None, str(type(v)), str(v)) for v in row])


KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean", "FLOAT": "float", "HUGEINT": "hugeint",
}


def compare(df, db, sql: str) -> list[str]:
    """Differences between a DataFrame and a DuckDB query; empty when they agree."""
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in cursor.description}
    theirs = normal(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    ours = normal(df.columns, [tuple(r) for r in df.collect()])
    problems = []
    for f in df.schema:
        if f.dataType.simpleString() != kinds[f.name]:
            problems.append(f"type of {f.name}: {f.dataType.simpleString()} != {kinds[f.name]}")
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} != {len(theirs)}")
    elif ours != theirs:
        wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
        problems.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    elif not ours:
        problems.append("no rows")
    return problems
