"""Segment marts: distinct customers and amount totals per combination of dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerloom.functions.casts import money
from tellerloom.functions.names import ref

COUNTRY_GENDER_ACCOUNT = ("Country", "Gender", "account_type")
COUNTRY_DEPARTMENT_PAYMENT = ("Country", "State", "MoyenPaiement")


def segment_mart(
    df: DataFrame,
    dims: Sequence[str],
    customer: str = "CustomerID",
    amount: str = "Montant",
    exact_money: bool = False,
) -> DataFrame:
    """Distinct customers and amount total per combination of ``dims`` of a joined table.

    NULL dimension values form a group. ``exact_money`` adds in cents: the total then does not
    depend on the order of the rows.
    """
    total = F.sum(money(ref(amount), exact_money)).cast("double")
    return df.groupBy(*[ref(name) for name in dims]).agg(
        F.count_distinct(ref(customer)).alias("nb_clients"), total.alias("total_montant")
    )


def country_gender_account(
    df: DataFrame,
    country: str = "Country",
    gender: str = "Gender",
    account_type: str = "account_type",
    customer: str = "CustomerID",
    amount: str = "Montant",
    exact_money: bool = False,
) -> DataFrame:
    """The segment mart by country, gender and account type."""
    return segment_mart(df, (country, gender, account_type), customer, amount, exact_money)


def country_department_payment(
    df: DataFrame,
    country: str = "Country",
    department: str = "State",
    payment: str = "MoyenPaiement",
    customer: str = "CustomerID",
    amount: str = "Montant",
    exact_money: bool = False,
) -> DataFrame:
    """The segment mart by country, department and means of payment."""
    return segment_mart(df, (country, department, payment), customer, amount, exact_money)
