"""Compare a Spark frame with DuckDB's answer to the reference SQL."""

import glob
import os

import duckdb

TYPES = {
    "TINYINT": "int", "SMALLINT": "int", "INTEGER": "int", "BIGINT": "bigint",
    "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz", "TIMESTAMP_NS": "timestamp_ntz", "FLOAT": "float",
}


def connect(folder):
    connection = duckdb.connect()
    for path in glob.glob(os.path.join(folder, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in values), key=repr)


def differences(frame, connection, sql):
    """Empty when names, types, row count and every value agree."""
    relation = connection.sql(sql)
    found = []
    ours = {name.lower(): kind for name, kind in frame.dtypes}
    theirs = {
        name.lower(): TYPES.get(str(kind), str(kind))
        for name, kind in zip(relation.columns, relation.types)
    }
    if ours != theirs:
        names = set(ours) | set(theirs)
        found.append({n: (ours.get(n), theirs.get(n)) for n in names if ours.get(n) != theirs.get(n)})
    mine = _rows([c.lower() for c in frame.columns], [tuple(r) for r in frame.collect()])
    yours = _rows([c.lower() for c in relation.columns], relation.fetchall())
    if len(mine) != len(yours):
        found.append(f"rows {len(mine)} vs {len(yours)}")
    if mine != yours:
        bad = [(a, b) for a, b in zip(mine, yours) if a != b]
        found.append(f"{len(bad)} differing rows, first {bad[:2]}")
    return found
