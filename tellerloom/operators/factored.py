"""The marts without the joined table.

The joined table repeats a transaction once per account and master row of its customer, and the
marts only count and add up those repetitions. So each input is first reduced to one row per
customer and dimension value, with how many rows it stands for; the joins then run on the reduced
inputs and the counts multiply. A customer holding a third of all transactions, accounts or master
rows is a handful of rows after the first, map-side combined aggregation, and the fan-out is never
produced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerloom.functions.casts import money
from tellerloom.functions.names import owners, ref
from tellerloom.operators.distribution import (
    _VALUE,
    _WEIGHT,
    QUARTILES,
    WINDOW_ROWS,
    distribution,
    weighted_distribution,
)
from tellerloom.operators.enrich import CUSTOMER, TRANSACTION_CUSTOMER, keyed
from tellerloom.staging import Staging

ROWS, TOTAL = "_rows", "_total"

# Repetitions up to this add up as longs, which hold nine million million such rows. Both types hold
# whole numbers and add them exactly, and both become the same doubles where amounts are weighed, so
# the type is a matter of speed alone.
SMALL_WEIGHT = 1_000_000


@dataclass(frozen=True)
class Rollups:
    """The inputs per customer and dimension: ``_rows`` each, and ``_total`` of the amounts."""

    transactions: DataFrame
    accounts: DataFrame
    master: DataFrame

    def frames(self) -> dict[str, DataFrame]:
        return {
            "transactions": self.transactions, "accounts": self.accounts, "master": self.master
        }

    def staged(self, staging: Staging) -> Rollups:
        """The same rollups as stored tables, to be shared by several marts."""
        return Rollups(*[staging.table(df, f"rollup-{name}") for name, df in self.frames().items()])


def rollups(
    transactions: DataFrame,
    accounts: DataFrame,
    master: DataFrame,
    dims: Sequence[str],
    amount: str = "Montant",
    exact_money: bool = False,
) -> Rollups:
    """Reduce the three inputs to one row per customer and value of their part of ``dims``."""
    frames = keyed(transactions, accounts, master)
    owner = owners({label: frame.drop(CUSTOMER) for label, frame in frames.items()}, dims)

    def reduce(label: str, *measures: Column) -> DataFrame:
        own = [ref(name).alias(name) for name in dims if owner[name] == label]
        counted = F.count(F.lit(1)).alias(ROWS)
        return frames[label].groupBy(CUSTOMER, *own).agg(counted, *measures)

    total = F.sum(money(ref(amount), exact_money)).alias(TOTAL)
    return Rollups(reduce("transactions", total), reduce("accounts"), reduce("master"))


def _narrow(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """The rollup on fewer dimensions."""
    held = [name for name in df.columns if name not in (CUSTOMER, ROWS, TOTAL)]
    kept = [name for name in held if name in dims]
    if kept == held:
        return df
    measures = [F.sum(name).alias(name) for name in (ROWS, TOTAL) if name in df.columns]
    return df.groupBy(CUSTOMER, *[ref(name) for name in kept]).agg(*measures)


def _times(counts: Sequence[str]) -> Column:
    """How often a row repeats: a product of counts that may pass the range of a long."""
    whole = [F.col(name).cast("decimal(20,0)") for name in counts]
    return reduce(mul, whole).cast("decimal(38,0)")


def _segments(rolled: Rollups, dims: Sequence[str], exact_money: bool) -> DataFrame:
    """Customers and total per segment; the total is in cents or floating point."""
    accounts = _narrow(rolled.accounts, dims).withColumnRenamed(ROWS, "_accounts")
    master = _narrow(rolled.master, dims).withColumnRenamed(ROWS, "_master")
    transactions = _narrow(rolled.transactions, dims)
    per_customer = transactions.join(accounts, CUSTOMER).join(master, CUSTOMER)
    if exact_money:
        total = F.col(TOTAL) * _times(["_accounts", "_master"])
    else:
        total = F.col(TOTAL) * F.col("_accounts").cast("double") * F.col("_master").cast("double")
    return per_customer.groupBy(*[ref(name) for name in dims]).agg(
        F.count(F.lit(1)).alias("nb_clients"), F.sum(total).alias("total_montant")
    )


def mart_of(rolled: Rollups, dims: Sequence[str], exact_money: bool = False) -> DataFrame:
    """The segment mart by ``dims``, from rollups that hold at least those dimensions.

    The joined rollups have one row per customer and segment, so the distinct customers of a segment
    are its rows.
    """
    segments = _segments(rolled, dims, exact_money)
    return segments.withColumn("total_montant", F.col("total_montant").cast("double"))


def factored_mart(
    transactions: DataFrame,
    accounts: DataFrame,
    master: DataFrame,
    dims: Sequence[str],
    amount: str = "Montant",
    exact_money: bool = False,
) -> DataFrame:
    """What ``segment_mart`` gives on the joined table, from the three inputs."""
    rolled = rollups(transactions, accounts, master, dims, amount, exact_money)
    return mart_of(rolled, dims, exact_money)


def repetitions(rolled: Rollups, by: Sequence[str]) -> DataFrame:
    """How often a customer's transactions repeat, per value of the account and master columns."""
    accounts = _narrow(rolled.accounts, by).withColumnRenamed(ROWS, "_accounts")
    master = _narrow(rolled.master, by).withColumnRenamed(ROWS, "_master")
    both = accounts.join(master, CUSTOMER)
    own = [ref(name) for name in by if name in both.columns]
    return both.select(CUSTOMER, *own, _times(["_accounts", "_master"]).alias(_WEIGHT))


def distribution_of(
    rolled: Rollups,
    transactions: DataFrame,
    by: Sequence[str] = ("Country",),
    amount: str = "Montant",
    probabilities: Sequence[float] = QUARTILES,
    as_array: bool = True,
    exact_money: bool = False,
    window_rows: int = WINDOW_ROWS,
    staging: Staging | None = None,
) -> DataFrame:
    """The exact distribution of the joined table's amounts, from its parts.

    The repetitions are staged, so the join with the transactions reads both sides straight from a
    shuffle and adaptive execution can split a customer that holds a large part of them.
    """
    staging = staging or Staging(transactions.sparkSession)
    with Staging(transactions.sparkSession) as scratch:
        weights, most = scratch.measured(
            repetitions(rolled, by), "repetitions", F.max(_WEIGHT).alias("most")
        )
        if (most["most"] or 0) <= SMALL_WEIGHT:
            weights = weights.withColumn(_WEIGHT, F.col(_WEIGHT).cast("bigint"))
        own = [ref(name).alias(name) for name in by if name not in weights.columns]
        customer = ref(TRANSACTION_CUSTOMER).cast("string").alias(CUSTOMER)
        amounts = transactions.select(customer, *own, ref(amount).alias(_VALUE))
        return weighted_distribution(
            amounts.join(weights, CUSTOMER).drop(CUSTOMER),
            by, probabilities, as_array, exact_money, window_rows, staging,
        )


def factored_distribution(
    transactions: DataFrame,
    accounts: DataFrame,
    master: DataFrame,
    by: Sequence[str] = ("Country",),
    amount: str = "Montant",
    probabilities: Sequence[float] = QUARTILES,
    as_array: bool = True,
    exact_money: bool = False,
    window_rows: int = WINDOW_ROWS,
    staging: Staging | None = None,
) -> DataFrame:
    """What ``distribution(exact=True)`` gives on the joined table, from the three inputs."""
    rolled = rollups(transactions, accounts, master, by, amount, exact_money)
    return distribution_of(
        rolled, transactions, by, amount, probabilities, as_array, exact_money,
        window_rows, staging,
    )


def factored_totals_distribution(
    transactions: DataFrame,
    accounts: DataFrame,
    master: DataFrame,
    by: Sequence[str] = ("Country",),
    amount: str = "Montant",
    probabilities: Sequence[float] = QUARTILES,
    accuracy: int = 10_000,
    as_array: bool = True,
    exact_money: bool = False,
) -> DataFrame:
    """What ``totals_distribution`` gives on the joined table, from the three inputs."""
    rolled = rollups(transactions, accounts, master, by, amount, exact_money)
    totals = _segments(rolled, by, exact_money)
    return distribution(
        totals, (), "total_montant", probabilities, accuracy,
        as_array=as_array, exact_money=exact_money,
    )


def fan_out(rolled: Rollups) -> DataFrame:
    """One row: transactions, those without a match, joined rows, and joined rows per match."""
    bare = Rollups(*[_narrow(df, ()) for df in rolled.frames().values()])
    accounts = bare.accounts.withColumnRenamed(ROWS, "_accounts")
    master = bare.master.withColumnRenamed(ROWS, "_master")
    per_customer = bare.transactions.join(accounts, CUSTOMER, "left").join(master, CUSTOMER, "left")
    rows = F.col(ROWS)
    matched = F.col("_accounts").isNotNull() & F.col("_master").isNotNull()
    joined = _times([ROWS, "_accounts", "_master"])
    counts = per_customer.agg(
        F.coalesce(F.sum(rows), F.lit(0)).alias("transactions"),
        F.coalesce(F.sum(F.when(~matched, rows)), F.lit(0)).alias("unmatched"),
        F.coalesce(F.sum(F.when(matched, joined)), F.lit(0)).alias("joined_rows"),
    )
    kept = F.col("transactions") - F.col("unmatched")
    ratio = F.when(kept > 0, F.col("joined_rows").cast("double") / kept.cast("double"))
    return counts.withColumn("fan_out", ratio)
