"""Tables of a SQLite profile database as a Spark data source, read in row-id ranges.

Register once per session with `spark.dataSource.register(SqliteTable)`, then
`spark.read.format("sqlite_table").schema(...).option("path", file).option("table", name).load()`.
The file must be readable from every executor.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from lendspark import schemas

_BATCH_ROWS = 10_000
_ROWS_PER_PARTITION = 1_000_000


@dataclass
class RowIdRange(InputPartition):
    low: int
    high: int


def _quoted(identifier: str) -> str:
    return '"' + identifier.replace('"', '""') + '"'


class SqliteTableReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.path = options["path"]
        self.table = options["table"]
        self.rows_per_partition = int(options.get("rowsPerPartition", _ROWS_PER_PARTITION))
        self.columns = schema.fieldNames()

    def _connect(self) -> sqlite3.Connection:
        return sqlite3.connect(f"file:{self.path}?mode=ro&immutable=1", uri=True)

    def partitions(self) -> list[InputPartition]:
        connection = self._connect()
        try:
            low, high = connection.execute(
                f"SELECT min(rowid), max(rowid) FROM {_quoted(self.table)}"
            ).fetchone()
        finally:
            connection.close()
        if low is None:
            return [RowIdRange(0, 0)]
        step = self.rows_per_partition
        return [RowIdRange(start, min(start + step, high + 1)) for start in range(low, high + 1, step)]

    def read(self, partition: RowIdRange) -> Iterator[tuple]:
        names = ", ".join(_quoted(c) for c in self.columns)
        connection = self._connect()
        try:
            cursor = connection.execute(
                f"SELECT {names} FROM {_quoted(self.table)} WHERE rowid >= ? AND rowid < ?",
                (partition.low, partition.high),
            )
            while rows := cursor.fetchmany(_BATCH_ROWS):
                yield from rows
        finally:
            connection.close()


class SqliteTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def reader(self, schema: StructType) -> SqliteTableReader:
        return SqliteTableReader(schema, self.options)


PROFILE_TABLES = {
    "users": schemas.USERS,
    "applications": schemas.APPLICATIONS,
    "instalments": schemas.INSTALMENTS,
}


def read_profile_tables(spark: SparkSession, db_path: str) -> dict[str, DataFrame]:
    """The three profile tables of one database file."""
    spark.dataSource.register(SqliteTable)
    reader = spark.read.format("sqlite_table").option("path", db_path)
    return {
        table: reader.schema(schema).option("table", table).load()
        for table, schema in PROFILE_TABLES.items()
    }
