"""The batch job: three sources to three mart tables, in one run or in stages.

Stages hand over stored tables, so each can be repeated or scheduled by itself.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerloom.functions.names import ref
from tellerloom.operators.distribution import distribution
from tellerloom.operators.enrich import enrich
from tellerloom.operators.factored import Rollups, distribution_of, mart_of, rollups
from tellerloom.operators.marts import COUNTRY_DEPARTMENT_PAYMENT, COUNTRY_GENDER_ACCOUNT
from tellerloom.operators.quality import LOST, quality_report, typed_with_losses
from tellerloom.plans.prepare import cleaned, prepare, side_by_side
from tellerloom.sinks import FileSink, Sink, write_table
from tellerloom.sources import read_stored
from tellerloom.specs import ACCOUNTS, JOINED_COLUMNS, MASTER, SPECS, TRANSACTIONS
from tellerloom.staging import Staging

# The names of the result tables.
COUNTRY_GENDER_ACCOUNT_TABLE = "df_agg_country_gender_account"
COUNTRY_DEPARTMENT_PAYMENT_TABLE = "df_agg_country_department_payment"
DISTRIBUTION_TABLE = "df_stats_transact"

# The columns the marts read; nothing else is carried past deduplication.
MART_DIMS = tuple(dict.fromkeys(COUNTRY_GENDER_ACCOUNT + COUNTRY_DEPARTMENT_PAYMENT))
MART_COLUMNS = {
    TRANSACTIONS.name: ("CustomerID", "Montant", "MoyenPaiement"),
    ACCOUNTS.name: ("customerid", "account_type"),
    MASTER.name: ("Number", "Country", "State", "Gender"),
}


_printing = Lock()


def preview(df: DataFrame, rows: int = 5, truncate: bool = True) -> None:
    """Print a frame's schema and first rows. Runs a job; meant for a person at a console."""
    with _printing:
        df.printSchema()
        df.show(rows, truncate=truncate)


def described(df: DataFrame) -> DataFrame:
    """A frame's schema as a table: a row a column, with how many values it holds and lacks; one pass."""
    rows = F.col("rows")
    counts = [F.count(ref(f.name)).alias(f"n{i}") for i, f in enumerate(df.schema.fields)]
    columns = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.col(f"n{i}").alias("filled"),
            (rows - F.col(f"n{i}")).alias("empty"),
        )
        for i, field in enumerate(df.schema.fields)
    ]
    return df.agg(F.count(F.lit(1)).alias("rows"), *counts).select(F.inline(F.array(*columns)))


def marts(
    prepared: Mapping[str, DataFrame],
    staging: Staging,
    exact_money: bool = False,
    as_array: bool = True,
    exact: bool = True,
    accuracy: int = 10_000,
) -> dict[str, Callable[[], DataFrame]]:
    """How to build each mart of the prepared datasets, by table name.

    They share one set of staged rollups. The distribution runs jobs while it is built, which is why
    the marts are handed over unbuilt: the caller can build and write all of them side by side.
    ``exact=False`` estimates the quantiles on the joined table, with rank error ``1/accuracy``.
    """
    transactions, accounts, master = (
        prepared[spec.name] for spec in (TRANSACTIONS, ACCOUNTS, MASTER)
    )
    lazy = rollups(transactions, accounts, master, MART_DIMS, exact_money=exact_money)
    frames = lazy.frames().items()
    writes = [lambda df=df, name=name: staging.table(df, f"rollup-{name}") for name, df in frames]
    rolled = Rollups(*side_by_side(staging.spark, writes))

    def amounts() -> DataFrame:
        if exact:
            return distribution_of(
                rolled, transactions, as_array=as_array, exact_money=exact_money, staging=staging
            )
        joined = enrich(transactions, accounts, master, ("Country", "Montant"), staging=staging)
        return distribution(
            joined, accuracy=accuracy, as_array=as_array, exact_money=exact_money
        )

    return {
        DISTRIBUTION_TABLE: amounts,
        COUNTRY_GENDER_ACCOUNT_TABLE: lambda: mart_of(rolled, COUNTRY_GENDER_ACCOUNT, exact_money),
        COUNTRY_DEPARTMENT_PAYMENT_TABLE: lambda: mart_of(
            rolled, COUNTRY_DEPARTMENT_PAYMENT, exact_money
        ),
    }


def _write_all(
    spark: SparkSession,
    tables: Mapping[str, Callable[[], DataFrame]],
    sink: Sink,
    mode: str,
    previews: int = 0,
) -> dict[str, int]:
    def write(name: str, build: Callable[[], DataFrame]) -> int:
        df = build()
        if previews:
            preview(df, previews)
        return write_table(df, sink, name, mode)

    writes = [lambda name=name, build=build: write(name, build) for name, build in tables.items()]
    return dict(zip(tables, side_by_side(spark, writes)))


def run_pipeline(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    sink: Sink,
    as_of: datetime.date | None = None,
    store: str | None = None,
    mode: str = "overwrite",
    exact_money: bool = False,
    as_array: bool = True,
    previews: int = 0,
    exact: bool = True,
    accuracy: int = 10_000,
) -> dict[str, int]:
    """Prepare the three raw ``sources``, compute the marts, write them; rows written per table.

    Each source is read and deduplicated once. With ``store``, the prepared datasets are kept there
    in full, with hash keys and validity. Without, only the mart columns are staged for the run.
    ``previews`` prints that many rows of every input and result, at the price of a job each.
    Quantiles are exact, or estimated with rank error ``1/accuracy``.
    """
    with Staging(spark) as staging:
        if store is not None:
            stage_prepare(spark, sources, store, as_of)
            prepared = prepared_tables(spark, store)
        else:
            writes = []
            for name, spec in SPECS.items():
                narrow = cleaned(sources[name], spec).select(*[ref(c) for c in MART_COLUMNS[name]])
                writes.append(lambda df=narrow, name=name: staging.table(df, f"prepared-{name}"))
            prepared = dict(zip(SPECS, side_by_side(spark, writes)))
        if previews:
            for df in prepared.values():
                preview(df, previews)
        tables = marts(prepared, staging, exact_money, as_array, exact, accuracy)
        return _write_all(spark, tables, sink, mode, previews)


def stage_prepare(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    store: str,
    as_of: datetime.date | None = None,
) -> dict[str, int]:
    """First stage: the prepared datasets as tables under ``store``, all of the same day."""
    if as_of is None:
        as_of = spark.range(1).select(F.current_date()).first()[0]
    prepared = {
        name: lambda name=name, spec=spec: prepare(sources[name], spec, as_of)
        for name, spec in SPECS.items()
    }
    return _write_all(spark, prepared, FileSink(f"{store}/prepared"), "overwrite")


def prepared_tables(spark: SparkSession, store: str) -> dict[str, DataFrame]:
    """What the first stage stored."""
    return read_stored(spark, f"{store}/prepared")


def stage_enrich(
    spark: SparkSession, store: str, columns: list[str] = JOINED_COLUMNS
) -> int:
    """Second stage, for those who want the detail: the joined table under ``store``.

    Leave out of ``columns`` whatever personal data the reader of the table should not have.
    """
    prepared = prepared_tables(spark, store)
    inputs = [prepared[spec.name] for spec in (TRANSACTIONS, ACCOUNTS, MASTER)]
    with Staging(spark) as staging:
        joined = enrich(*inputs, columns, staging=staging)
        return write_table(joined, FileSink(store), "joined")


def stage_marts(
    spark: SparkSession,
    store: str,
    sink: Sink,
    mode: str = "overwrite",
    exact_money: bool = False,
    as_array: bool = True,
    exact: bool = True,
    accuracy: int = 10_000,
) -> dict[str, int]:
    """Last stage: the marts of the stored datasets, to ``sink``."""
    with Staging(spark) as staging:
        prepared = prepared_tables(spark, store)
        tables = marts(prepared, staging, exact_money, as_array, exact, accuracy)
        return _write_all(spark, tables, sink, mode)


def stage_prepare_checked(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    store: str,
    as_of: datetime.date | None = None,
    staging: Staging | None = None,
) -> DataFrame:
    """First stage and its quality report, from one parse of every raw source.

    The typed rows are staged, and stay for the lazy report.
    """
    staging = staging or Staging(spark)
    writes = [
        lambda name=name, spec=spec: staging.table(
            typed_with_losses(sources[name], spec), f"typed-{name}"
        )
        for name, spec in SPECS.items()
    ]
    typed = dict(zip(SPECS, side_by_side(spark, writes)))
    stage_prepare(spark, {name: df.drop(LOST) for name, df in typed.items()}, store, as_of)
    return quality_report(typed, prepared_tables(spark, store))


def stage_quality(
    spark: SparkSession, sources: Mapping[str, DataFrame], store: str
) -> DataFrame:
    """The quality report of the raw sources against what the first stage stored."""
    return quality_report(sources, prepared_tables(spark, store))
