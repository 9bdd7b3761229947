"""Run queries beside their DuckDB oracle and compare rows, types and values."""

from __future__ import annotations

import math
import os
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "date": "DATE", "boolean": "BOOLEAN"}


def connect(folder: str):
    connection = duckdb.connect()
    connection.execute("SET threads=1")
    for table in TABLES:
        path = os.path.join(folder, f"{table}.parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b


def compare(df, connection, sql: str) -> list[str]:
    """Differences between a Spark result and the oracle; empty when they agree."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    rows = result.fetchall()
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for field in df.schema.fields:
        if KINDS.get(field.dataType.simpleString()) != kinds[field.name]:
            problems.append(f"{field.name}: {field.dataType.simpleString()} vs {kinds[field.name]}")
    order = sorted(names)
    key = lambda row: tuple((v is None, str(v)) for v in row)
    ours = sorted((tuple(r[c] for c in order) for r in df.collect()), key=key)
    place = [names.index(c) for c in order]
    theirs = sorted((tuple(r[i] for i in place) for r in rows), key=key)
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} != {len(theirs)}")
    bad = [(a, b) for a, b in zip(ours, theirs) if not all(map(same, a, b))]
    if bad:
        problems.append(f"{len(bad)} rows differ in {order}, first: {bad[0]}")
    return problems


def run(spark, folder: str, names: list[str], queries, oracles) -> dict[str, list[str]]:
    connection = connect(folder)
    failures = {}
    for name in names:
        start = time.time()
        df = queries[name](spark, folder)
        if name in oracles:
            problems = compare(df, connection, oracles[name])
        else:
            problems = [] if df.count() else ["no rows"]
        print(f"{name:32s} {time.time() - start:6.2f}s {'ok' if not problems else problems}",
              flush=True)
        if problems:
            failures[name] = problems
    return failures
