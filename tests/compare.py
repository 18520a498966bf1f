"""Order-insensitive comparison of a Spark result with DuckDB's."""

from __future__ import annotations

from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

KINDS = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    names = sorted(df.columns)
    select = ", ".join(f'"{n}"' for n in names)
    described = con.execute(f"describe {sql}").fetchall()
    found = []
    if sorted(row[0] for row in described) != names:
        return [f"columns {names} against {sorted(row[0] for row in described)}"]
    kinds = {row[0]: row[1] for row in described}
    for field in df.schema:
        if KINDS.get(field.dataType.simpleString()) != kinds[field.name]:
            found.append(f"{field.name}: {field.dataType.simpleString()} against {kinds[field.name]}")
    ours = _sorted(tuple(row) for row in df.select(*names).collect())
    theirs = _sorted(con.execute(f"select {select} from ({sql})").fetchall())
    if len(ours) != len(theirs):
        found.append(f"{len(ours)} rows against {len(theirs)}")
    found += [f"{a} against {b}" for a, b in zip(ours, theirs) if a != b][:3]
    return found
