"""Readers for source tables: partitioned JDBC, or files."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A reader turns a source table name into a DataFrame; loaders and the run take one of these.
Reader = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Split:
    """How to divide one JDBC table among tasks.

    Either a numeric, date or timestamp column with bounds, or a list of predicates that together
    cover every row once (the way for text keys, e.g. one hash remainder per predicate).

    Each part is a query of its own, so the parts need not see the same state of the source. The
    column must be one that never changes for a row: a row that moves to another range while the
    parts are read is lost or read twice, and the vault then records a closing that was none. Where
    the database can pin a state (a snapshot or a time in the table expression or the predicates),
    give predicates that name it; with one partition the load is a single query.
    """

    column: str | None = None
    lower: str | int | None = None
    upper: str | int | None = None
    partitions: int = 1
    predicates: Sequence[str] = ()

    def __post_init__(self) -> None:
        if self.column and self.predicates:
            raise ValueError("give a column with bounds or predicates, not both")
        if self.column and (self.lower is None or self.upper is None or self.partitions < 1):
            raise ValueError("a split column needs lower, upper and at least one partition")


@dataclass(frozen=True)
class JdbcSource:
    """Source tables in a relational database; credentials default to PGUSER and PGPASSWORD."""

    url: str
    driver: str = "org.postgresql.Driver"
    schema: str = "source"
    user: str | None = None
    password: str | None = None
    fetch_size: int = 10_000
    splits: Mapping[str, Split] = field(default_factory=dict)

    def options(self, table: str) -> dict[str, str]:
        """Reader options for one table (without predicates, which are no option)."""
        options = {
            "url": self.url,
            "dbtable": f"{self.schema}.{table}" if self.schema else table,
            "driver": self.driver,
            "user": self.user if self.user is not None else os.environ["PGUSER"],
            "password": self.password if self.password is not None else os.environ["PGPASSWORD"],
            "fetchsize": str(self.fetch_size),
            # Wall-clock columns stay wall-clock: no shift by the session zone.
            "preferTimestampNTZ": "true",
        }
        split = self.splits.get(table)
        if split and split.column:
            options |= {
                "partitionColumn": split.column,
                "lowerBound": str(split.lower),
                "upperBound": str(split.upper),
                "numPartitions": str(split.partitions),
            }
        return options

    def reader(self, spark: SparkSession) -> Reader:
        def read(table: str) -> DataFrame:
            options = self.options(table)
            split = self.splits.get(table)
            if split and split.predicates:
                url, name = options.pop("url"), options.pop("dbtable")
                return spark.read.jdbc(
                    url, name, predicates=list(split.predicates), properties=options
                )
            return spark.read.format("jdbc").options(**options).load()

        return read


def file_reader(
    spark: SparkSession, root: str, file_format: str = "parquet", suffix: str = ""
) -> Reader:
    """Source tables as ``<root>/<table><suffix>`` in any file format Spark reads."""

    def read(table: str) -> DataFrame:
        return spark.read.format(file_format).load(f"{root}/{table}{suffix}")

    return read


def frame_reader(frames: Mapping[str, DataFrame]) -> Reader:
    """Source tables that are DataFrames already."""
    return frames.__getitem__


def row_counts(reader: Reader, tables: Sequence[str]) -> DataFrame:
    """Rows per source table, counted by the executors in one plan."""
    counts = [
        reader(table).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(table).alias("table_name"), "row_count"
        )
        for table in tables
    ]
    return reduce(DataFrame.unionByName, counts)
