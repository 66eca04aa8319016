"""Every operator as a query over a folder of tables. ``oracle.py`` holds the same in SQL."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerloom import operators as ops
from tellerloom import plans, standin
from tellerloom.functions import hash_key, with_hash_key, with_validity
from tellerloom.plans import batch
from tellerloom.sinks import FileSink, write_table
from tellerloom.sources import read_datasets, read_delimited, read_stored
from tellerloom.specs import ACCOUNTS, MASTER, SPECS, TRANSACTIONS
from tellerloom.staging import Staging

Query = Callable[[SparkSession, str], DataFrame]

# Queries never depend on the day they run.
AS_OF = datetime.date(2025, 8, 28)
DEFAULT_ACCURACY = 10_000

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        standin.transactions(spark, folder),
        standin.accounts(spark, folder),
        standin.master(spark, folder),
    )


# Marts from the inputs, without the joined table


@query
def mart_country_gender_account(spark: SparkSession, folder: str) -> DataFrame:
    return ops.factored_mart(*inputs(spark, folder), ops.COUNTRY_GENDER_ACCOUNT, exact_money=True)


@query
def mart_country_department_payment(spark: SparkSession, folder: str) -> DataFrame:
    dims = ops.COUNTRY_DEPARTMENT_PAYMENT
    return ops.factored_mart(*inputs(spark, folder), dims, exact_money=True)


@query
def distribution_by_country(spark: SparkSession, folder: str) -> DataFrame:
    return ops.factored_distribution(*inputs(spark, folder), as_array=False, exact_money=True)


def _of_array(stats: DataFrame, *first: str) -> DataFrame:
    """The measures as a user gets them by default, the array's elements in columns."""
    quantiles = F.col("quantiles")
    return stats.select(
        *first,
        F.round("moyenne", 2).alias("moyenne"),
        "mediane",
        F.size(quantiles).alias("n_quantiles"),
        *[quantiles[i].alias(name) for i, name in enumerate(("p25", "p50", "p75"))],
    )


def _rounded_total(mart: DataFrame) -> DataFrame:
    """A mart in floating point, to the cent: its last digits depend on the order of the rows."""
    return mart.withColumn("total_montant", F.round("total_montant", 2))


@query
def mart_country_gender_account_default(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded_total(ops.factored_mart(*inputs(spark, folder), ops.COUNTRY_GENDER_ACCOUNT))


@query
def mart_country_department_payment_default(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded_total(ops.factored_mart(*inputs(spark, folder), ops.COUNTRY_DEPARTMENT_PAYMENT))


@query
def distribution_by_country_default(spark: SparkSession, folder: str) -> DataFrame:
    return _of_array(ops.factored_distribution(*inputs(spark, folder)), "Country")


@query
def distribution_of_country_totals_default(spark: SparkSession, folder: str) -> DataFrame:
    stats = _of_array(ops.factored_totals_distribution(*inputs(spark, folder)))
    cents = [F.round(name, 2).alias(name) for name in ("moyenne", "mediane", "p25", "p50", "p75")]
    return stats.select("n_quantiles", *cents)


@query
def distribution_by_country_in_passes(spark: SparkSession, folder: str) -> DataFrame:
    """The same with little to rank at once, so that the amounts are narrowed down first."""
    return ops.factored_distribution(
        *inputs(spark, folder), as_array=False, exact_money=True, window_rows=20
    )


@query
def distribution_of_country_totals(spark: SparkSession, folder: str) -> DataFrame:
    return ops.factored_totals_distribution(
        *inputs(spark, folder), as_array=False, exact_money=True
    )


# The joined table and the operators on it


@query
def joined_detail(spark: SparkSession, folder: str) -> DataFrame:
    return ops.enrich(*inputs(spark, folder))


def _joined(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return ops.enrich(*inputs(spark, folder), columns=columns)


@query
def joined_country_gender_account(spark: SparkSession, folder: str) -> DataFrame:
    columns = (*ops.COUNTRY_GENDER_ACCOUNT, "CustomerID", "Montant")
    return ops.country_gender_account(_joined(spark, folder, *columns), exact_money=True)


@query
def joined_country_department_payment(spark: SparkSession, folder: str) -> DataFrame:
    columns = (*ops.COUNTRY_DEPARTMENT_PAYMENT, "CustomerID", "Montant")
    return ops.country_department_payment(_joined(spark, folder, *columns), exact_money=True)


@query
def joined_country_gender_account_default(spark: SparkSession, folder: str) -> DataFrame:
    columns = (*ops.COUNTRY_GENDER_ACCOUNT, "CustomerID", "Montant")
    return _rounded_total(ops.country_gender_account(_joined(spark, folder, *columns)))


@query
def joined_country_department_payment_default(spark: SparkSession, folder: str) -> DataFrame:
    columns = (*ops.COUNTRY_DEPARTMENT_PAYMENT, "CustomerID", "Montant")
    return _rounded_total(ops.country_department_payment(_joined(spark, folder, *columns)))


@query
def joined_distribution(spark: SparkSession, folder: str) -> DataFrame:
    """The estimates a user gets by default; up to ``ops.sketch_size`` rows a group they are exact."""
    return _of_array(ops.distribution(_joined(spark, folder, "Country", "Montant")), "Country")


@query
def joined_distribution_by_segment(spark: SparkSession, folder: str) -> DataFrame:
    """Estimates of many small groups, merged from few slices."""
    dims = ops.COUNTRY_DEPARTMENT_PAYMENT
    joined = _joined(spark, folder, *dims, "Montant")
    return _of_array(ops.distribution(joined, dims, slices=3), *dims)


def _ranks(joined: DataFrame, estimated: DataFrame) -> DataFrame:
    """Rows of a group, and for each estimate those below it and those up to it, counted on every row."""
    estimated = Staging(joined.sparkSession).table(estimated, "estimated")
    estimated = estimated.withColumnRenamed("Country", "group")
    counts = []
    for name in ("mediane", "p25", "p50", "p75"):
        counts.append(F.count_if(F.col("Montant") < F.col(name)).alias(f"below_{name}"))
        counts.append(F.count_if(F.col("Montant") <= F.col(name)).alias(f"upto_{name}"))
    same = F.col("Country").eqNullSafe(F.col("group"))
    rows = F.count(F.lit(1)).alias("rows_counted")
    return joined.join(estimated, same).groupBy("Country").agg(rows, *counts)


@query
def joined_distribution_error(spark: SparkSession, folder: str) -> DataFrame:
    """The ranks that estimates have, and whether they are within the stated error."""
    joined = Staging(spark).table(_joined(spark, folder, "Country", "Montant"), "joined")
    found = _ranks(joined, ops.distribution(joined, accuracy=DEFAULT_ACCURACY, as_array=False))
    allowed = F.col("rows_counted") / DEFAULT_ACCURACY + 1
    checks = []
    for name, share in (("mediane", 0.5), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        asked = share * F.col("rows_counted")
        below, upto = F.col(f"below_{name}"), F.col(f"upto_{name}")
        checks.append(((below <= asked + allowed) & (upto >= asked - allowed)).alias(f"{name}_is_close"))
    return found.select("*", *checks)


@query
def joined_distribution_exact(spark: SparkSession, folder: str) -> DataFrame:
    joined = _joined(spark, folder, "Country", "Montant")
    return ops.distribution(joined, exact=True, as_array=False, exact_money=True)


@query
def joined_distribution_overall(spark: SparkSession, folder: str) -> DataFrame:
    joined = _joined(spark, folder, "Montant")
    return ops.distribution(joined, by=(), exact=True, as_array=False, exact_money=True)


@query
def joined_totals_distribution(spark: SparkSession, folder: str) -> DataFrame:
    joined = _joined(spark, folder, "Country", "Montant")
    return ops.totals_distribution(joined, as_array=False, exact_money=True)


@query
def joined_text_keys(spark: SparkSession, folder: str) -> DataFrame:
    """A key with a leading zero is another customer, or none."""
    transactions, accounts, master = inputs(spark, folder)
    padded = F.concat(F.lit("0"), "CustomerID")
    key = F.when(F.col("MoyenPaiement") == "5-LOW", padded).otherwise(F.col("CustomerID"))
    columns = ["TransactionID", "CustomerID", "account_number", "Country"]
    return ops.enrich(transactions.withColumn("CustomerID", key), accounts, master, columns)


def _moved_inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Inputs whose male customers have a second master row, in another country."""
    transactions, accounts, master = inputs(spark, folder)
    second = master.where("Gender = 'male'").withColumn("Country", F.lit("OCEANIA"))
    return transactions, accounts, master.unionByName(second)


@query
def moved_country_gender_account(spark: SparkSession, folder: str) -> DataFrame:
    moved = _moved_inputs(spark, folder)
    return ops.factored_mart(*moved, ops.COUNTRY_GENDER_ACCOUNT, exact_money=True)


@query
def moved_distribution(spark: SparkSession, folder: str) -> DataFrame:
    moved = _moved_inputs(spark, folder)
    return ops.factored_distribution(*moved, by=["Gender"], as_array=False, exact_money=True)


@query
def unmatched_transactions(spark: SparkSession, folder: str) -> DataFrame:
    transactions, accounts, master = inputs(spark, folder)
    return ops.unmatched(transactions, accounts, master.where("Country <> 'ASIA'"))


@query
def fan_out(spark: SparkSession, folder: str) -> DataFrame:
    transactions, accounts, master = inputs(spark, folder)
    rolled = ops.rollups(transactions, accounts, master.where("Country <> 'ASIA'"), dims=())
    counts = ops.fan_out(rolled)
    return counts.withColumn("joined_rows", F.col("joined_rows").cast("bigint"))


# One customer with two fifths of the transactions and a third of the accounts


def _hot_inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    transactions, accounts, master = inputs(spark, folder)
    urgent = F.col("MoyenPaiement").isin("1-URGENT", "2-HIGH")
    hot = {"CustomerID": F.when(urgent, "7").otherwise(F.col("CustomerID"))}
    final = F.col("account_type") == "F"
    held = {"customerid": F.when(final, "7").otherwise(F.col("customerid"))}
    return transactions.withColumns(hot), accounts.withColumns(held), master


@query
def hot_customer_country_gender_account(spark: SparkSession, folder: str) -> DataFrame:
    dims = ops.COUNTRY_GENDER_ACCOUNT
    return ops.factored_mart(*_hot_inputs(spark, folder), dims, exact_money=True)


@query
def hot_customer_country_department_payment(spark: SparkSession, folder: str) -> DataFrame:
    dims = ops.COUNTRY_DEPARTMENT_PAYMENT
    return ops.factored_mart(*_hot_inputs(spark, folder), dims, exact_money=True)


@query
def hot_customer_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return ops.factored_distribution(*_hot_inputs(spark, folder), as_array=False, exact_money=True)


@query
def hot_customer_detail(spark: SparkSession, folder: str) -> DataFrame:
    hot_transactions, _, master = _hot_inputs(spark, folder)
    columns = ["TransactionID", "CustomerID", "Montant", "account_number", "Country"]
    return ops.enrich(hot_transactions, standin.accounts(spark, folder), master, columns)


# Typing


def _written(spark: SparkSession, datasets: dict[str, DataFrame]) -> str:
    """The datasets as delimited files with their declared names and separators."""
    root = Staging(spark).root
    for name, df in datasets.items():
        spec = SPECS[name]
        sink = FileSink(root, "csv", {"header": "true", "sep": spec.sep})
        write_table(df, sink, spec.path)
    return root


def _ingested(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A dataset written as text, read back and typed."""
    spec = SPECS[name]
    uri = _written(spark, {name: standin.datasets(spark, folder)[name]})
    return ops.conform(read_delimited(spark, f"{uri}/{spec.path}", spec.sep), spec)


@query
def typed_ingest_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return _ingested(spark, folder, TRANSACTIONS.name)


@query
def typed_ingest_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return _ingested(spark, folder, ACCOUNTS.name)


@query
def typed_ingest_master(spark: SparkSession, folder: str) -> DataFrame:
    return _ingested(spark, folder, MASTER.name)


@query
def typed_ingest_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions from a folder of several files."""
    root = Staging(spark).root
    several = standin.transactions(spark, folder).repartition(3, "TransactionID")
    write_table(several, FileSink(root, "csv", {"header": "true", "sep": ";"}), "several")
    return ops.conform(read_delimited(spark, f"{root}/several", ";"), TRANSACTIONS)


@query
def described_datasets(spark: SparkSession, folder: str) -> DataFrame:
    """Columns, types and gaps of the typed datasets."""
    parts = [
        plans.described(_ingested(spark, folder, name)).select(F.lit(name).alias("dataset"), "*")
        for name in SPECS
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def typed_stored_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions stored with other types than the declared ones."""
    transactions = standin.transactions(spark, folder).withColumns({
        "TransactionID": F.col("TransactionID").cast("bigint"),
        "Montant": F.col("Montant").cast("decimal(12,2)"),
        "DateTransaction": F.col("DateTransaction").cast("date"),
    })
    root = Staging(spark).root
    write_table(transactions, FileSink(root, "orc"), TRANSACTIONS.name)
    raw = read_stored(spark, root, [TRANSACTIONS.name], "orc")
    return ops.conform(raw[TRANSACTIONS.name], TRANSACTIONS)


@query
def typed_stored_master(spark: SparkSession, folder: str) -> DataFrame:
    """Master rows stored with a longer number, out of range in some rows."""
    number = F.col("Number").cast("bigint")
    far = F.when(F.col("Country") == "ASIA", number + 2**31).otherwise(number)
    root = Staging(spark).root
    write_table(
        standin.master(spark, folder).withColumn("Number", far), FileSink(root), MASTER.name
    )
    raw = read_stored(spark, root, [MASTER.name])
    return ops.conform(raw[MASTER.name], MASTER)


@query
def cast_malformed_transactions(spark: SparkSession, folder: str) -> DataFrame:
    payment = F.col("MoyenPaiement")
    amount = F.col("Montant").cast("string")
    date = F.date_format("DateTransaction", "yyyy-MM-dd")
    texts = {
        "Montant": F.when(payment == "1-URGENT", F.concat(amount, F.lit("x")))
        .when(payment == "2-HIGH", F.lit("1,5"))
        .otherwise(amount),
        "DateTransaction": F.when(
            payment == "3-MEDIUM", F.date_format("DateTransaction", "dd/MM/yyyy")
        ).when(payment == "4-NOT SPECIFIED", F.lit("2024-13-01"))
        .otherwise(date),
    }
    raw = standin.transactions(spark, folder).withColumns(texts)
    return ops.conform(raw, TRANSACTIONS)


@query
def cast_malformed_master(spark: SparkSession, folder: str) -> DataFrame:
    country = F.col("Country")
    number = F.col("Number").cast("string")
    texts = {
        "Number": F.when(country == "AFRICA", F.concat(number, F.lit(".7")))
        .when(country == "AMERICA", F.concat(F.lit(" -"), number, F.lit(". ")))
        .when(country == "ASIA", F.concat(number, F.lit("x")))
        .when(country == "EUROPE", F.concat(F.lit("."), number))
        .otherwise(F.concat(number, F.lit("e3"))),
        "Birthday": F.when(country == "AFRICA", F.lit("8/3/1970"))
        .when(country == "ASIA", F.lit("28/08/2025"))
        .otherwise(F.lit("2025-8-3")),
    }
    raw = standin.master(spark, folder).withColumns(texts)
    return ops.conform(raw, MASTER).select("NationalID", "Country", "Number", "Birthday")


# Cleaning


def _gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions with gaps: no payment for some, no amount (NaN) for others."""
    amount = F.col("Montant")
    return standin.transactions(spark, folder).withColumns({
        "MoyenPaiement": F.nullif(F.col("MoyenPaiement"), F.lit("5-LOW")),
        "Montant": F.when(amount < 50000, F.lit(float("nan"))).otherwise(amount),
    })


@query
def drop_any_null(spark: SparkSession, folder: str) -> DataFrame:
    return ops.drop_incomplete(_gaps(spark, folder))


@query
def drop_required_null(spark: SparkSession, folder: str) -> DataFrame:
    kept = ops.drop_incomplete(_gaps(spark, folder), ["TransactionID", "MoyenPaiement"])
    return kept.withColumn("Montant", F.nanvl("Montant", F.lit(-1.0)))


@query
def dedup_rows(spark: SparkSession, folder: str) -> DataFrame:
    orders = standin.table(spark, folder, "orders")
    status = F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus")
    return ops.dedup(orders.select("o_custkey", status))


@query
def dedup_subset(spark: SparkSession, folder: str) -> DataFrame:
    """Per key its rows, those chosen, and how many of the chosen are rows of the input."""
    orders = standin.table(spark, folder, "orders")
    subset = ["o_custkey", "o_orderpriority"]
    chosen = ops.dedup(orders, subset).withColumn("_chosen", F.lit(True))
    # Orders are unique, so an input row meets at most one chosen row; what was never read stays alone.
    both = orders.withColumn("_input", F.lit(True)).join(chosen, orders.columns, "full")
    return both.groupBy(subset).agg(
        F.count("_input").alias("rows_of_key"),
        F.count("_chosen").alias("rows_chosen"),
        F.count_if(F.col("_input") & F.col("_chosen")).alias("chosen_from_input"),
    )


@query
def dedup_latest(spark: SparkSession, folder: str) -> DataFrame:
    transactions = standin.transactions(spark, folder)
    return ops.dedup(transactions, ["CustomerID"], [F.col("DateTransaction").desc()])


# Keys, validity, prepared datasets


def _hashes(spark: SparkSession, folder: str, null_safe: bool) -> DataFrame:
    datasets = standin.datasets(spark, folder)
    parts = []
    for name, spec in SPECS.items():
        # The second key part is missing in some rows of every dataset.
        texts = [F.col(column).cast("string") for column in spec.key]
        key = [texts[0], F.when(~texts[0].endswith("7"), texts[1])]
        frame = datasets[name].select(*[k.alias(f"key_{i}") for i, k in enumerate(key)])
        hashed = hash_key(["key_0", "key_1"], null_safe).alias("pk_hash")
        parts.append(frame.select(F.lit(name).alias("dataset"), "key_0", "key_1", hashed))
    return reduce(DataFrame.unionByName, parts)


@query
def hash_keys(spark: SparkSession, folder: str) -> DataFrame:
    return _hashes(spark, folder, null_safe=False)


@query
def hash_keys_null_safe(spark: SparkSession, folder: str) -> DataFrame:
    return _hashes(spark, folder, null_safe=True)


@query
def hash_key_of_numbers(spark: SparkSession, folder: str) -> DataFrame:
    master = standin.master(spark, folder).select("NationalID", "Number")
    return with_hash_key(master, MASTER.key, MASTER.key_column)


@query
def validity(spark: SparkSession, folder: str) -> DataFrame:
    return with_validity(standin.accounts(spark, folder), AS_OF)


def _repeated(df: DataFrame) -> DataFrame:
    """Every row twice, so that deduplication has work to do."""
    return df.unionByName(df)


@query
def prepared_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return plans.prepare(_repeated(_gaps(spark, folder)), TRANSACTIONS, AS_OF)


@query
def prepared_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return plans.prepare(_repeated(standin.accounts(spark, folder)), ACCOUNTS, AS_OF)


@query
def prepared_master(spark: SparkSession, folder: str) -> DataFrame:
    known = F.when(F.col("State") != "NATION_0", F.col("NationalID"))
    gaps = standin.master(spark, folder).withColumn("NationalID", known)
    return plans.prepare(_repeated(gaps), MASTER, AS_OF)


@query
def prepared_master_any_null(spark: SparkSession, folder: str) -> DataFrame:
    full = standin.master(spark, folder).fillna("-", [
        field.name for field in MASTER.schema
        if field.dataType.simpleString() == "string" and field.name != "Gender"
    ]).withColumn("Birthday", F.lit(AS_OF))
    return plans.prepare(full, MASTER.requiring(), AS_OF)


# Whole jobs


def _mart_rows(spark: SparkSession, sink: FileSink) -> DataFrame:
    """The stored marts as one table."""
    def dims(*names: str) -> list[Column]:
        return [F.col(n).alias(a) for n, a in zip(names, ("first", "second", "third"))]

    measures = [F.col("nb_clients"), F.round("total_montant", 2).alias("total_montant")]
    stats = ("moyenne", "mediane", "p25", "p50", "p75")
    measures += [F.lit(None).cast("double").alias(name) for name in stats]
    none = F.lit(None).cast("string")
    quantiles = [F.col("quantiles")[i].alias(name) for i, name in enumerate(stats[2:])]
    tables = {
        batch.COUNTRY_GENDER_ACCOUNT_TABLE: [*dims(*ops.COUNTRY_GENDER_ACCOUNT), *measures],
        batch.COUNTRY_DEPARTMENT_PAYMENT_TABLE: [*dims(*ops.COUNTRY_DEPARTMENT_PAYMENT), *measures],
        batch.DISTRIBUTION_TABLE: [
            *dims("Country"), none.alias("second"), none.alias("third"),
            F.lit(None).cast("bigint").alias("nb_clients"),
            F.lit(None).cast("double").alias("total_montant"),
            F.round("moyenne", 2).alias("moyenne"), F.col("mediane"), *quantiles,
        ],
    }
    parts = [
        spark.read.parquet(sink.uri(name)).select(F.lit(name).alias("mart"), *columns)
        for name, columns in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def batch_marts(spark: SparkSession, folder: str) -> DataFrame:
    sources = read_datasets(spark, _written(spark, standin.datasets(spark, folder)))
    sink = FileSink(Staging(spark).root)
    plans.run_pipeline(spark, sources, sink, AS_OF, exact_money=True)
    return _mart_rows(spark, sink)


@query
def batch_marts_default(spark: SparkSession, folder: str) -> DataFrame:
    """The whole job with the money a user gets by default."""
    sources = read_datasets(spark, _written(spark, standin.datasets(spark, folder)))
    sink = FileSink(Staging(spark).root)
    plans.run_pipeline(spark, sources, sink, AS_OF)
    return _mart_rows(spark, sink)


@query
def batch_distribution_estimated(spark: SparkSession, folder: str) -> DataFrame:
    """The estimates that the whole job stores, and the ranks they have."""
    sources = standin.datasets(spark, folder)
    store = Staging(spark).root
    sink = FileSink(f"{store}/marts")
    plans.run_pipeline(spark, sources, sink, AS_OF, store=store, exact=False)
    plans.stage_enrich(spark, store, ["Country", "Montant"])
    joined = spark.read.parquet(f"{store}/joined")
    stored = _of_array(spark.read.parquet(sink.uri(batch.DISTRIBUTION_TABLE)), "Country")
    ranks = _ranks(joined, stored).withColumnRenamed("Country", "group")
    same = F.col("Country").eqNullSafe(F.col("group"))
    return stored.join(ranks, same).drop("group")


@query
def staged_marts(spark: SparkSession, folder: str) -> DataFrame:
    store = Staging(spark).root
    sink = FileSink(f"{store}/marts")
    plans.stage_prepare(spark, standin.datasets(spark, folder), store, AS_OF)
    plans.stage_marts(spark, store, sink, exact_money=True)
    return _mart_rows(spark, sink)


@query
def staged_joined(spark: SparkSession, folder: str) -> DataFrame:
    store = Staging(spark).root
    plans.stage_prepare(spark, standin.datasets(spark, folder), store, AS_OF)
    plans.stage_enrich(spark, store, ["TransactionID", "account_number", "Country", "State"])
    return spark.read.parquet(f"{store}/joined")


@query
def written_rows(spark: SparkSession, folder: str) -> DataFrame:
    sink = FileSink(Staging(spark).root)
    datasets = standin.datasets(spark, folder)
    counts = []
    for name, df in datasets.items():
        write_table(df, sink, name)
        counts.append((name, write_table(df, sink, name) + write_table(df, sink, name, "append")))
    stored = [
        spark.read.parquet(sink.uri(name)).agg(
            F.lit(name).alias("dataset"),
            F.lit(reported).cast("bigint").alias("rows_reported"),
            F.count(F.lit(1)).alias("rows_stored"),
        )
        for name, reported in counts
    ]
    return reduce(DataFrame.unionByName, stored)


def _damaged(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Sources with repeated rows and keys, amounts that don't parse, and customers without a master row."""
    transactions, accounts, master = inputs(spark, folder)
    payment = F.col("MoyenPaiement")
    amount = F.when(payment == "1-URGENT", F.lit("n/a")).otherwise(F.col("Montant").cast("string"))
    # Rows that differ from others of the same key.
    others = transactions.where(payment == "2-HIGH").withColumn("MoyenPaiement", F.lit("0-OTHER"))
    texts = transactions.unionByName(others).withColumn("Montant", amount)
    return {
        TRANSACTIONS.name: _repeated(texts),
        ACCOUNTS.name: accounts,
        MASTER.name: master.where("Country <> 'ASIA'"),
    }


@query
def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    """The report from the parse that the preparation makes."""
    return plans.stage_prepare_checked(
        spark, _damaged(spark, folder), Staging(spark).root, AS_OF
    )


@query
def quality_report_of_raw(spark: SparkSession, folder: str) -> DataFrame:
    """The report of sources as they are, after the preparation."""
    raw = _damaged(spark, folder)
    store = Staging(spark).root
    plans.stage_prepare(spark, raw, store, AS_OF)
    return plans.stage_quality(spark, raw, store)
