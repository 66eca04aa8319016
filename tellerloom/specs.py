"""Declared datasets: columns and types, key, null rule and file layout of each input.

One registry serves every entry point, so a dataset's schema, key and separator cannot drift apart.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Column names and types of the three inputs, in file order.
TRANSACTION_SCHEMA = StructType([
    StructField("TransactionID", StringType()),
    StructField("CustomerID", StringType()),
    StructField("Montant", DoubleType()),
    StructField("DateTransaction", TimestampType()),
    StructField("MoyenPaiement", StringType()),
    StructField("BICsender", StringType()),
    StructField("BICreceiver", StringType()),
])

ACCOUNT_SCHEMA = StructType([
    StructField("customerid", StringType()),
    StructField("account_number", StringType()),
    StructField("account_type", StringType()),
    StructField("creation_date", DateType()),
])

MASTER_SCHEMA = StructType([
    StructField("Number", IntegerType()),
    StructField("NameSet", StringType()),
    StructField("GivenName", StringType()),
    StructField("Surname", StringType()),
    StructField("Title", StringType()),
    StructField("Gender", StringType()),
    StructField("Birthday", DateType()),
    StructField("EmailAddress", StringType()),
    StructField("TelephoneNumber", StringType()),
    StructField("StreetAddress", StringType()),
    StructField("City", StringType()),
    StructField("ZipCode", StringType()),
    StructField("StateFull", StringType()),
    StructField("State", StringType()),
    StructField("Country", StringType()),
    StructField("CountryFull", StringType()),
    StructField("TelephoneCountryCode", StringType()),
    StructField("CCType", StringType()),
    StructField("CCNumber", StringType()),
    StructField("CCExpires", StringType()),
    StructField("Company", StringType()),
    StructField("Occupation", StringType()),
    StructField("NationalID", StringType()),
])

# The columns of the joined table: all of the transactions, then what the others add to them.
JOINED_COLUMNS = [
    *TRANSACTION_SCHEMA.names,
    *(name for name in ACCOUNT_SCHEMA.names if name != "customerid"),
    *(name for name in MASTER_SCHEMA.names if name != "Number"),
]


class UnknownDataset(ValueError, KeyError):
    """The dataset name is not in the registry."""

    def __str__(self) -> str:
        return str(self.args[0])


@dataclass(frozen=True)
class DatasetSpec:
    """What the engine needs to know about one input.

    ``required`` lists the columns that may not be NULL; ``None`` means every column.
    """

    name: str
    schema: StructType
    key: tuple[str, ...]
    key_column: str
    path: str
    sep: str = ","
    required: tuple[str, ...] | None = None

    def requiring(self, *columns: str) -> DatasetSpec:
        """The same dataset with another null rule; no column named means every column."""
        return replace(self, required=columns or None)


TRANSACTIONS = DatasetSpec(
    name="transactions",
    schema=TRANSACTION_SCHEMA,
    key=("TransactionID", "CustomerID"),
    key_column="transaction_pk",
    path="transactions.csv",
    sep=";",
)

ACCOUNTS = DatasetSpec(
    name="comptes_bancaires",
    schema=ACCOUNT_SCHEMA,
    key=("customerid", "account_number"),
    key_column="account_pk",
    path="comptes_bancaires.csv",
)

MASTER = DatasetSpec(
    name="info_global",
    schema=MASTER_SCHEMA,
    key=("NationalID", "Number"),
    key_column="global_pk",
    path="info_global.csv",
    required=("NationalID", "Number"),
)

SPECS: dict[str, DatasetSpec] = {spec.name: spec for spec in (TRANSACTIONS, ACCOUNTS, MASTER)}


def dataset_spec(name: str) -> DatasetSpec:
    """Look a dataset up by name."""
    if name not in SPECS:
        raise UnknownDataset(f"no dataset named {name!r}; known: {', '.join(SPECS)}")
    return SPECS[name]
