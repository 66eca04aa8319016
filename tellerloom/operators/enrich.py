"""The joined table: every transaction with each account and master row of its customer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerloom.functions.names import folding, owners, ref
from tellerloom.specs import JOINED_COLUMNS
from tellerloom.staging import Staging

CUSTOMER = "_customer"

# The customer's column in transactions, accounts and master.
TRANSACTION_CUSTOMER, ACCOUNT_CUSTOMER, MASTER_CUSTOMER = "CustomerID", "customerid", "Number"


def keyed(transactions: DataFrame, accounts: DataFrame, master: DataFrame) -> dict[str, DataFrame]:
    """The three inputs with their customer, as text, in one common column.

    Keys are compared as text, so ``07`` is not customer 7. Only the transactions keep their own
    column as well, as it was.
    """
    keys = {
        "transactions": (transactions, TRANSACTION_CUSTOMER),
        "accounts": (accounts, ACCOUNT_CUSTOMER),
        "master": (master, MASTER_CUSTOMER),
    }
    frames = {
        label: frame.withColumn(CUSTOMER, ref(key).cast("string"))
        for label, (frame, key) in keys.items()
    }
    for label in ("accounts", "master"):
        frames[label] = frames[label].drop(keys[label][1])
    return frames


def enrich(
    transactions: DataFrame,
    accounts: DataFrame,
    master: DataFrame,
    columns: Sequence[str] = JOINED_COLUMNS,
    staged: bool = True,
    staging: Staging | None = None,
) -> DataFrame:
    """Inner-join transactions with accounts and customer master, on the customer.

    A transaction repeats once per account and master row of its customer; one without either
    vanishes. Only ``columns`` are carried, and they are chosen before the joins.

    Accounts and master are joined first and, with ``staged``, written. The large join then reads
    both its sides straight from a shuffle, which is the shape in which adaptive execution can
    split a customer that holds a large part of the rows, and its size decides on a broadcast.
    The result's customer column is not the one joined on: an aggregation by customer would else
    build on the join's partitioning, which forbids the split. Its own shuffle is small, as it
    comes after combining.
    """
    frames = keyed(transactions, accounts, master)
    fold = folding(transactions.sparkSession)
    if len({fold(name) for name in columns}) != len(columns):
        raise ValueError(f"a column is asked for twice in {list(columns)}")
    owner = owners({label: frame.drop(CUSTOMER) for label, frame in frames.items()}, columns)

    def part(label: str) -> DataFrame:
        own = [ref(name).alias(name) for name in columns if owner[name] == label]
        return frames[label].select(CUSTOMER, *own)

    holders = part("accounts").join(part("master"), CUSTOMER)
    if staged:
        holders = (staging or Staging(holders.sparkSession)).table(holders, "holders")
    joined = part("transactions").join(holders, CUSTOMER)
    return joined.select(*[ref(name) for name in columns])


def unmatched(
    transactions: DataFrame,
    accounts: DataFrame,
    master: DataFrame,
    staging: Staging | None = None,
) -> DataFrame:
    """The transactions the joined table loses: no account, or no master row, for the customer."""
    frames = keyed(transactions, accounts, master)
    holders = (
        frames["accounts"].select(CUSTOMER).distinct()
        .join(frames["master"].select(CUSTOMER).distinct(), CUSTOMER)
    )
    holders = (staging or Staging(holders.sparkSession)).table(holders, "holder-keys")
    same = ref(TRANSACTION_CUSTOMER).cast("string") == F.col(CUSTOMER)
    return transactions.join(holders, same, "left_anti")
