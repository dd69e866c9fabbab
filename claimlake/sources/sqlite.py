"""Tables of SQLite files, read only: row-id ranges as partitions, conditions handed to the file.

Conditions are an argument of scan(), not pushed down by the planner: in Spark 4.1 filters that a Python source has
taken stay with the DataFrame, and its next query would lose rows.
"""

from __future__ import annotations

import json
import sqlite3
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Fixed value: seconds that a locked store is waited for.
PATIENCE = 2.0
#: Rows of a partition, and of a batch.
ROWS, BATCH = 1_000_000, 10_000
_TYPES = {"INT": ("long", pa.int64()), "CHAR": ("string", pa.string()), "TEXT": ("string", pa.string()), "CLOB": ("string", pa.string()), "BLOB": ("binary", pa.binary()), "REAL": ("double", pa.float64()), "FLOA": ("double", pa.float64()), "DOUB": ("double", pa.float64())}
_COMPARED = ("=", "<>", "<", "<=", ">", ">=", "LIKE")


def opened(path: str) -> sqlite3.Connection:
    """A connection that cannot write and waits PATIENCE for a lock."""
    con = sqlite3.connect(f"file:{quote(path)}?mode=ro", uri=True, timeout=PATIENCE)
    con.execute("PRAGMA query_only = 1")
    return con


def absence(path: str) -> str | None:
    """Why a store cannot be read: missing, locked or unreadable; None if it can."""
    if not Path(path).is_file():
        return "missing"
    try:
        con = opened(path)
        try:
            con.execute("SELECT count(*) FROM sqlite_master").fetchone()
        finally:
            con.close()
    except sqlite3.OperationalError as e:
        return "locked" if "locked" in str(e) or "busy" in str(e) else "unreadable"
    except sqlite3.DatabaseError:
        return "unreadable"
    return None


def _name(s: str) -> str:
    return '"' + s.replace('"', '""') + '"'


def columns_of(path: str, table: str) -> list[tuple[str, str, pa.DataType]]:
    """Name, Spark type and Arrow type of a table's columns, by SQLite's rules of affinity; a column without a type is text."""
    con = opened(path)
    try:
        rows = con.execute(f"PRAGMA table_info({_name(table)})").fetchall()
    finally:
        con.close()
    if not rows:
        raise ValueError(f"no table {table} in {path}")
    out = []
    for _, name, kind, *_ in rows:
        found = next((v for k, v in _TYPES.items() if k in (kind or "").upper()), ("double", pa.float64()) if kind else ("string", pa.string()))
        out.append((name, *found))
    return out


@dataclass
class RowIds(InputPartition):
    low: int
    high: int


def condition(columns: list[str], where: tuple) -> tuple[str, list]:
    """The SQL of one condition (column, operator, value) and its values: a comparison, IN with a list, IS with None, IS NOT with None."""
    column, operator, value = where
    operator = operator.upper()
    if column not in columns:
        raise ValueError(f"no column {column}")
    if operator in ("IS", "IS NOT") and value is None:
        return f"{_name(column)} {operator} NULL", []
    if operator == "IN":
        return f"{_name(column)} IN ({', '.join('?' * len(value))})", list(value)
    if operator in _COMPARED:
        return f"{_name(column)} {operator} ?", [value]
    raise ValueError(f"no condition {operator} {value!r}")


class _Reader(DataSourceReader):
    def __init__(self, path: str, table: str, rows: int, where: list[tuple]):
        self.path, self.table, self.rows = path, table, rows
        self.columns = columns_of(path, table)
        own = [condition([n for n, _, _ in self.columns], w) for w in where]
        self.where, self.values = [c for c, _ in own], [v for _, vs in own for v in vs]

    def statement(self, part: RowIds) -> tuple[str, list]:
        """The SQL of a partition and its values."""
        names = ", ".join(_name(n) for n, _, _ in self.columns)
        where = " AND ".join(["rowid >= ?", "rowid < ?", *self.where])
        return f"SELECT {names} FROM {_name(self.table)} WHERE {where}", [part.low, part.high, *self.values]

    def partitions(self) -> list[RowIds]:
        con = opened(self.path)
        try:
            low, high = con.execute(f"SELECT min(rowid), max(rowid) FROM {_name(self.table)}").fetchone()
        finally:
            con.close()
        if low is None:
            return [RowIds(0, 0)]
        return [RowIds(a, min(a + self.rows, high + 1)) for a in range(low, high + 1, self.rows)]

    def read(self, part: RowIds) -> Iterator[pa.RecordBatch]:
        con = opened(self.path)
        try:
            rows = con.execute(*self.statement(part))
            while some := rows.fetchmany(BATCH):
                yield pa.RecordBatch.from_arrays([pa.array([_cell(r[i], kind) for r in some], kind) for i, (_, _, kind) in enumerate(self.columns)], names=[n for n, _, _ in self.columns])
        finally:
            con.close()


def _cell(v, kind: pa.DataType):
    """A cell as its column's type; SQLite keeps what it cannot convert, and that is null here."""
    if v is None:
        return None
    if pa.types.is_string(kind):
        return v if isinstance(v, str) else v.decode("utf-8", "replace") if isinstance(v, bytes) else str(v)
    if pa.types.is_binary(kind):
        return v if isinstance(v, bytes) else str(v).encode()
    try:
        return int(v) if pa.types.is_integer(kind) else float(v)
    except (TypeError, ValueError):
        return None


class SqliteTable(DataSource):
    """Format "sqlite_table": a table (option table) of the file at path, which every executor must be able to open."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def schema(self) -> str:
        return ", ".join(f"`{n}` {k}" for n, k, _ in columns_of(self.options["path"], self.options["table"]))

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], self.options["table"], int(self.options.get("rowsPerPartition", ROWS)), json.loads(self.options.get("where", "[]")))


def scan(spark: SparkSession, path: str, table: str, where: list[tuple] | None = None, rows: int = ROWS) -> DataFrame:
    """A table of a SQLite file, of which only rows that meet all conditions (column, operator, value) leave the file. A store that is missing, locked or unreadable is an error that says which."""
    if why := absence(path):
        raise ValueError(f"store {path} is {why}")
    spark.dataSource.register(SqliteTable)
    return spark.read.format("sqlite_table").option("table", table).option("rowsPerPartition", rows).option("where", json.dumps(where or [])).load(path)
