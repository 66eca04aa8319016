"""The three datasets, made from a TPC-H-like folder of Parquet tables.

Customers have one to three accounts, so the join fans out, and a third of them has no gender.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerloom.specs import ACCOUNTS, MASTER, TRANSACTIONS


# The tables' columns. Declaring them saves a job per table that would infer them.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """One per order."""
    customer = F.col("o_custkey").cast("string")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("TransactionID"),
        customer.alias("CustomerID"),
        F.col("o_totalprice").alias("Montant"),
        F.col("o_orderdate").cast("timestamp").alias("DateTransaction"),
        F.col("o_orderpriority").alias("MoyenPaiement"),
        F.concat(F.lit("BS"), customer).alias("BICsender"),
        F.concat(F.lit("BR"), customer).alias("BICreceiver"),
    )


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    """One per customer and order status."""
    orders = table(spark, folder, "orders").groupBy("o_custkey", "o_orderstatus")
    customer = F.col("o_custkey").cast("string")
    return orders.agg(F.min("o_orderdate").cast("date").alias("creation_date")).select(
        customer.alias("customerid"),
        F.concat_ws("-", customer, "o_orderstatus").alias("account_number"),
        F.col("o_orderstatus").alias("account_type"),
        "creation_date",
    )


def master(spark: SparkSession, folder: str) -> DataFrame:
    """One per customer, with its nation as state and region as country; other texts are NULL."""
    kind = F.col("c_custkey") % 3
    values = {
        "Number": F.col("c_custkey").cast("int"),
        "NationalID": F.col("c_name"),
        "Country": F.col("r_name"),
        "State": F.col("n_name"),
        "Gender": F.when(kind == 0, "female").when(kind == 1, "male"),
    }
    located = (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return located.select(*[
        values.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
        for field in MASTER.schema
    ])


def datasets(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All three, by dataset name."""
    return {
        TRANSACTIONS.name: transactions(spark, folder),
        ACCOUNTS.name: accounts(spark, folder),
        MASTER.name: master(spark, folder),
    }
