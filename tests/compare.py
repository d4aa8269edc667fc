"""Run queries against their SQL on the same tables and compare rows, columns and values."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def plain(value):
    if value is None:
        return None
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return f"{type(value).__name__}:{value}"


SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "smallint": "SMALLINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def bag(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(df, db, sql: str) -> str:
    """Empty when equal, else what differs."""
    rows = df.collect()
    cursor = db.execute(sql)
    theirs = cursor.fetchall()
    names, ours = bag(df.columns, rows)
    wanted_names, wanted = bag([d[0] for d in cursor.description], theirs)
    if names != wanted_names:
        return f"columns {names} against {wanted_names}"
    types = {name: SQL_TYPES.get(kind, kind) for name, kind in df.dtypes}
    wanted_types = {d[0]: str(d[1]) for d in cursor.description}
    if types != wanted_types:
        return f"types {sorted(set(types.items()) ^ set(wanted_types.items()))}"
    if ours != wanted:
        only_ours, only_theirs = ours - wanted, wanted - ours
        return (
            f"rows {sum(ours.values())} against {sum(wanted.values())}; "
            f"only here {list(only_ours)[:3]}, only there {list(only_theirs)[:3]}"
        )
    return ""


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as entry
    from trendloom.session import local_session

    folder = sys.argv[1]
    chosen = sys.argv[2:]
    spark = local_session("compare", 8)
    db = connect(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in chosen or queries:
        started = time.time()
        try:
            df = queries[name](spark, folder)
            problem = difference(df, db, oracle[name]) if name in oracle else "no SQL"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{name:45s} {time.time() - started:6.2f}s {problem or 'ok'}", flush=True)
    print("differences:", bad)
