"""Relational databases over JDBC: scans, remote queries, publishing.

Connection values come from the caller; this module stores none.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tallymart.session import together

PLACEHOLDERS = ("", "placeholder")


@dataclass(frozen=True)
class Connection:
    """Where a database is and how to log in."""

    url: str
    user: str
    password: str = field(repr=False)
    driver: str | None = None

    def options(self) -> dict[str, str]:
        unset = [
            name for name in ("url", "user", "password")
            if (getattr(self, name) or "").strip().lower() in PLACEHOLDERS
        ]
        if unset:
            raise ValueError(f"connection values are not set: {', '.join(unset)}")
        options = {"url": self.url, "user": self.user, "password": self.password}
        if self.driver:
            options["driver"] = self.driver
        return options


@dataclass(frozen=True)
class Split:
    """How to cut a table scan into parallel range queries over one column."""

    column: str
    lower: int
    upper: int
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


def read_table(
    spark: SparkSession,
    connection: Connection,
    table: str,
    split: Split | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A remote table. Without ``split`` one task reads all of it."""
    options = {"dbtable": table, "fetchsize": str(fetch_size), **connection.options()}
    options.update(split.options() if split else {})
    return spark.read.format("jdbc").options(**options).load()


def read_query(spark: SparkSession, connection: Connection, sql: str) -> DataFrame:
    """The result of a query that the database runs; filters on it go along."""
    return spark.read.format("jdbc").options(query=sql, **connection.options()).load()


def remote_count(spark: SparkSession, connection: Connection, table: str) -> DataFrame:
    """One row, ``row_count``, counted by the database."""
    return read_query(spark, connection, f"SELECT COUNT(*) AS row_count FROM {table}")


def write_table(
    df: DataFrame,
    connection: Connection,
    table: str,
    mode: str = "overwrite",
    batch_size: int = 5000,
    writers: int = 16,
) -> None:
    """Publish a frame; overwriting empties the table and keeps its definition.

    ``writers`` bounds the number of open connections, whatever the number of
    partitions. Batches are not one transaction: after a failure publish again
    with ``overwrite``.
    """
    if writers < 1:
        raise ValueError("at least one writer is needed")
    options = {
        "dbtable": table,
        "batchsize": str(batch_size),
        "truncate": "true",
        "numPartitions": str(writers),
        **connection.options(),
    }
    df.write.format("jdbc").options(**options).mode(mode).save()


@dataclass
class Published:
    """What became of a publication: rows per table, message per failed table."""

    rows: dict[str, int] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)

    @property
    def total(self) -> int:
        return sum(self.rows.values())


def publish(
    tables: Mapping[str, DataFrame],
    write: Callable[[DataFrame, str], None],
    report: Callable[[str, int, datetime, Exception | None], None] = lambda *_: None,
    at_once: int = 1,
) -> Published:
    """Write every table, ``at_once`` of them at a time; a failure is recorded
    and the others go on. ``report`` gets name, rows, start and error.

    ``tables`` should read stored tables, whose count costs next to nothing.
    """
    done = Published()

    def one(name: str, df: DataFrame) -> None:
        started_at = datetime.now(timezone.utc)
        try:
            write(df, name)
            rows = df.count()
        except Exception as error:
            done.errors[name] = str(error)
            report(name, 0, started_at, error)
            return
        done.rows[name] = rows
        report(name, rows, started_at, None)

    if tables:
        spark = next(iter(tables.values())).sparkSession
        together(spark, [partial(one, name, df) for name, df in tables.items()], at_once)
    return done
