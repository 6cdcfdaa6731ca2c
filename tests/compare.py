"""Compare a Spark result with the SQL counterpart, as sorted rows of plain values."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _sorted(rows: list[tuple], names: list[str]) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), _sorted([tuple(row) for row in df.collect()], df.columns)


def sql_rows(connection, statement: str) -> tuple[list[str], list[tuple]]:
    cursor = connection.execute(statement)
    names = [column[0] for column in cursor.description]
    return sorted(names), _sorted(cursor.fetchall(), names)
