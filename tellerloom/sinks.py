"""Where results go: files, catalog tables, relational databases."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame

from tellerloom.counting import counted
from tellerloom.sources.jdbc import Database

log = logging.getLogger(__name__)


class Sink(Protocol):
    """Anything that can save a frame under a table name."""

    def arranged(self, df: DataFrame) -> DataFrame:
        """The frame in the partitions it is to be written from."""
        return df

    def save(self, df: DataFrame, table: str, mode: str) -> None: ...


@dataclass(frozen=True)
class FileSink(Sink):
    """One folder per table under a base URI."""

    base_uri: str
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)

    def uri(self, table: str) -> str:
        return f"{self.base_uri.rstrip('/')}/{table}"

    def save(self, df: DataFrame, table: str, mode: str) -> None:
        df.write.format(self.format).options(**self.options).mode(mode).save(self.uri(table))


@dataclass(frozen=True)
class CatalogSink(Sink):
    """Tables of the session's catalog."""

    database: str | None = None
    format: str = "parquet"

    def save(self, df: DataFrame, table: str, mode: str) -> None:
        name = f"{self.database}.{table}" if self.database else table
        df.write.format(self.format).mode(mode).saveAsTable(name)


@dataclass(frozen=True)
class JdbcSink(Sink):
    """Tables of a relational database, over at most ``connections`` connections per table.

    The rows are brought to that many partitions by a shuffle, so that the work before it keeps its
    own parallelism.
    """

    database: Database
    batchsize: int = 10_000
    connections: int = 8

    def arranged(self, df: DataFrame) -> DataFrame:
        return df.repartition(self.connections)

    def save(self, df: DataFrame, table: str, mode: str) -> None:
        properties = {**self.database.properties(), "batchsize": str(self.batchsize)}
        df.write.jdbc(self.database.url, table, mode, properties)


def write_table(df: DataFrame, sink: Sink, table: str, mode: str = "overwrite") -> int:
    """Save ``df`` and return how many rows were written, counted by the write itself.

    The count is taken in the tasks that write, after any shuffle, so that tasks repeated on the way
    there do not count twice. A failure is logged and raised again.
    """
    observed, written = counted(sink.arranged(df), f"rows of {table}")
    try:
        sink.save(observed, table, mode)
    except Exception:
        log.exception("writing %s failed", table)
        raise
    rows = written.get["rows"]
    log.info("wrote %s: %d rows", table, rows)
    return rows
