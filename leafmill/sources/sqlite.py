"""Tables of SQLite files as a data source, opened read-only, and SQL over Parquet with such tables beside it."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

KINDS = {"INTEGER": "long", "REAL": "double", "TEXT": "string", "BLOB": "binary"}


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


class _Range(InputPartition):
    def __init__(self, low: int, high: int):
        super().__init__((low, high))
        self.low, self.high = low, high


class _Reader(DataSourceReader):
    def __init__(self, path: str, table: str, columns: list[str], parts: int):
        self.path, self.table, self.columns, self.parts = path, table, columns, parts

    def partitions(self) -> list[InputPartition]:
        with _open(self.path) as con:
            low, high = con.execute(f'select min(rowid), max(rowid) from "{self.table}"').fetchone()
        if low is None:
            return [_Range(0, -1)]
        step = -(-(high - low + 1) // self.parts)
        return [_Range(a, min(a + step - 1, high)) for a in range(low, high + 1, step)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        names = ", ".join(f'"{c}"' for c in self.columns)
        with _open(self.path) as con:
            yield from con.execute(f'select {names} from "{self.table}" where rowid between ? and ?', (partition.low, partition.high))


class SqliteSource(DataSource):
    """spark.read.format("sqlite").option("path", ...).option("dbtable", ...).load(), in ranges of rowid. The file must be
    readable on every machine; a column's declared type (INTEGER, REAL, TEXT, BLOB) gives its kind, other types are text."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> str:
        with _open(self.options["path"]) as con:
            found = con.execute(f'pragma table_info("{self.options["dbtable"]}")').fetchall()
        return ", ".join(f"`{c[1]}` {KINDS.get(c[2].upper(), 'string')}" for c in found)

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], self.options["dbtable"], schema.names, int(self.options.get("parts", "8")))


def read_sqlite(spark: SparkSession, path: str, table: str, parts: int = 8) -> DataFrame:
    spark.dataSource.register(SqliteSource)
    return spark.read.format("sqlite").option("path", path).option("dbtable", table).option("parts", str(parts)).load()


def sql_over(spark: SparkSession, text: str, views: dict[str, DataFrame | str]) -> DataFrame:
    """Runs SQL text over named views; a string is a Parquet glob, a table of a SQLite file is given as read_sqlite(...)."""
    for name, view in views.items():
        (spark.read.parquet(view) if isinstance(view, str) else view).createOrReplaceTempView(name)
    return spark.sql(text)
