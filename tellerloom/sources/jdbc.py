"""Relational databases: connection settings and table scans."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

FETCH_ROWS = 10_000


@dataclass(frozen=True)
class Database:
    """Where a database is and how to connect. Never prints its password."""

    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    options: dict[str, str] = field(default_factory=dict, repr=False)

    def properties(self) -> dict[str, str]:
        """Connection properties for the JDBC reader and writer."""
        named = {"user": self.user, "password": self.password, "driver": self.driver}
        return {**{k: v for k, v in named.items() if v is not None}, **self.options}


def postgres(
    host: str, database: str, user: str, password: str, port: int | str = 5432
) -> Database:
    """A PostgreSQL database; its driver jar comes with the deployment."""
    url = f"jdbc:postgresql://{host}:{port}/{database}"
    return Database(url, user, password, "org.postgresql.Driver")


def read_table(
    spark: SparkSession,
    database: Database,
    table: str,
    column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int | None = None,
    predicates: list[str] | None = None,
) -> DataFrame:
    """Scan a table, or a parenthesised query with an alias.

    Without bounds it is one partition on one connection. A numeric, date or timestamp ``column``
    with ``lower``, ``upper`` and ``partitions`` reads in parallel; rows outside the bounds are in
    the first and last partition. ``predicates`` gives one partition per condition instead.

    Rows are fetched ``FETCH_ROWS`` at a time unless the database's options say otherwise: some
    drivers would else hold a partition's whole result in one task.
    """
    properties = {"fetchsize": str(FETCH_ROWS), **database.properties()}
    if predicates is not None:
        if column is not None:
            raise ValueError("give a partition column or predicates, not both")
        return spark.read.jdbc(database.url, table, predicates=predicates, properties=properties)
    bounds = (column, lower, upper, partitions)
    if all(bound is None for bound in bounds):
        return spark.read.jdbc(database.url, table, properties=properties)
    if any(bound is None for bound in bounds):
        raise ValueError("a parallel read needs column, lower, upper and partitions")
    return spark.read.jdbc(
        database.url, table,
        column=column, lowerBound=lower, upperBound=upper, numPartitions=partitions,
        properties=properties,
    )
