"""Compare a query's rows, columns and types with those of its SQL."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    """A connection with one view per Parquet file of the folder."""
    duck = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return duck


def _cell(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(cells, key=lambda row: [(v is None, str(v)) for v in row])


def _kind(name: str) -> str:
    name = name.lower()
    for kind, words in {
        "int": ("int", "integer"),
        "long": ("bigint",),
        "text": ("string", "varchar"),
        "real": ("double",),
        "flag": ("boolean",),
        "time": ("timestamp", "timestamp_ntz"),
    }.items():
        if name in words:
            return kind
    return name.split("(")[0]


def differences(df, duck, sql: str) -> tuple[int, list[str]]:
    """The row count of the query and what differs from the SQL."""
    got = _rows(df.columns, [tuple(row) for row in df.collect()])
    result = duck.execute(sql)
    types = {d[0]: _kind(str(d[1])) for d in result.description}
    want = _rows([d[0] for d in result.description], result.fetchall())
    mine = {name: _kind(kind) for name, kind in df.dtypes}
    notes = []
    if got[0] != want[0]:
        notes.append(f"columns {got[0]} / {want[0]}")
    if types != mine:
        notes.append(f"types {[(n, mine.get(n), k) for n, k in types.items() if mine.get(n) != k]}")
    if got[1] != want[1]:
        differ = [(a, b) for a, b in zip(got[1], want[1], strict=False) if a != b][:2]
        notes.append(f"rows {len(got[1])}/{len(want[1])} {differ}")
    return len(got[1]), notes
