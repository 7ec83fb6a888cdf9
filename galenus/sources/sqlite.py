"""A Spark data source over SQLite files: row-id ranges are partitions, rows stream as Arrow batches."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BATCH_ROWS, MAX_PARTITIONS = 10_000, 10_000
TYPES = {"INT": ("bigint", pa.int64()), "REA": ("double", pa.float64()), "FLO": ("double", pa.float64()), "DOU": ("double", pa.float64()), "NUM": ("double", pa.float64())}


def _name(text: str) -> str:
    return '"' + text.replace('"', '""') + '"'


@dataclass
class RowRange(InputPartition):
    first: int
    last: int


class TableReader(DataSourceReader):
    def __init__(self, path: str, table: str, rows: int):
        self.path, self.table, self.rows = path, table, rows

    def _open(self) -> sqlite3.Connection:
        return sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)

    def columns(self) -> list[tuple[str, str, pa.DataType]]:
        with self._open() as con:
            info = con.execute(f"pragma table_info({_name(self.table)})").fetchall()
        return [(c[1], *TYPES.get((c[2] or "")[:3].upper(), ("string", pa.string()))) for c in info]

    def partitions(self) -> list[RowRange]:
        with self._open() as con:
            low, high = con.execute(f"select min(rowid), max(rowid) from {_name(self.table)}").fetchone()
        if low is None:
            return []
        step = max(self.rows, -(-(high - low + 1) // MAX_PARTITIONS))  # sparse row ids make wider ranges, not more
        return [RowRange(a, a + step - 1) for a in range(low, high + 1, step)]

    def read(self, partition: RowRange) -> Iterator[pa.RecordBatch]:
        columns = self.columns()
        with self._open() as con:
            found = con.execute(f"select {', '.join(_name(c[0]) for c in columns)} from {_name(self.table)} where rowid between ? and ?", (partition.first, partition.last))
            while rows := found.fetchmany(BATCH_ROWS):
                cells = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([str(v) if k == "string" and v is not None else v for v in c], t) for c, (_, k, t) in zip(cells, columns, strict=True)], names=[c[0] for c in columns])


class SqliteTables(DataSource):
    """``format("sqlite_table")`` with options path, table and rows (of a partition)."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def _reader(self) -> TableReader:
        return TableReader(self.options["path"], self.options["table"], int(self.options.get("rows", 100_000)))

    def schema(self) -> str:
        return ", ".join(f"`{n}` {k}" for n, k, _ in self._reader().columns())

    def reader(self, schema) -> TableReader:
        return self._reader()


def read_sqlite(spark: SparkSession, path: str, table: str, rows: int = 100_000) -> DataFrame:
    """A table of a SQLite file that every executor can reach under ``path``."""
    spark.dataSource.register(SqliteTables)
    return spark.read.format("sqlite_table").options(path=path, table=table, rows=str(rows)).load()


def read_warehouse(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A query of a database server by JDBC; needs its driver on the class path."""
    return spark.read.format("jdbc").option("url", url).option("query", query).options(**options).load()
