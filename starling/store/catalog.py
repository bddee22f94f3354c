"""Declared tables in Spark's own catalog: create or replace, insert by position or by name, truncate.

The tables are managed tables of a database whose folder lies below the shared
folder, so executors and driver see the same files. Inserts follow Spark's ANSI
store assignment: a value that doesn't fit its column raises, nothing is cut or
turned into NULL silently.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starling.session import shared_path


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


class Catalog:
    """A database of declared tables."""

    def __init__(self, spark: SparkSession, database: str | None = None, location: str | None = None):
        self.spark = spark
        self.database = database or f"starling_{uuid.uuid4().hex[:12]}"
        location = location or shared_path(spark, "catalog")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(self.database)} LOCATION '{location}'")

    def name(self, table: str) -> str:
        return f"{_quoted(self.database)}.{_quoted(table)}"

    def create_or_replace(self, table: str, schema: T.StructType) -> None:
        """An empty table with declared columns; one of that name is dropped with its rows."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
        cols = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema)
        self.spark.sql(f"CREATE TABLE {self.name(table)} ({cols}) USING parquet")

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def insert_positional(self, table: str, rows: DataFrame) -> None:
        """``INSERT INTO t SELECT ...``: the first column goes to the first one, whatever their names."""
        self._insert(table, rows, "")

    def insert_by_name(self, table: str, rows: DataFrame, overwrite: bool = False) -> None:
        """A10: ``INSERT INTO t BY NAME SELECT ...``: columns are found by their names; unknown ones raise, missing ones
        are NULL."""
        self._insert(table, rows, "BY NAME", overwrite)

    def _insert(self, table: str, rows: DataFrame, how: str, overwrite: bool = False) -> None:
        verb = "INSERT OVERWRITE" if overwrite else "INSERT INTO"
        self.spark.sql(f"{verb} {self.name(table)} {how} SELECT * FROM {{rows}}", rows=rows)

    def append_values(self, table: str, rows: list[tuple]) -> None:
        """``INSERT INTO t VALUES ...`` of a few literal rows."""
        self.insert_positional(table, self.spark.createDataFrame(rows, self.read(table).schema))

    def truncate(self, table: str) -> None:
        """No rows stay, the declared columns do."""
        self.spark.sql(f"TRUNCATE TABLE {self.name(table)}")

    def drop(self) -> None:
        self.spark.sql(f"DROP DATABASE IF EXISTS {_quoted(self.database)} CASCADE")
