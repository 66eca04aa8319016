import random

import pytest
from pyspark.sql import functions as F

from tellerloom.operators import (
    COUNTRY_DEPARTMENT_PAYMENT, COUNTRY_GENDER_ACCOUNT, country_department_payment,
    country_gender_account, distribution, enrich, factored_distribution, factored_mart,
    factored_totals_distribution, fan_out, rollups, segment_mart, totals_distribution, unmatched,
)
from tellerloom.operators.factored import Rollups, mart_of
from tellerloom.specs import ACCOUNTS, JOINED_COLUMNS, MASTER, TRANSACTIONS
from tests.samples import collected, three_inputs, typed

BY_ACCOUNT = {
    ("FR", "F", "checking", 1, 30.0), ("FR", "F", "savings", 1, 30.0), ("US", None, "checking", 1, 5.0)
}
BY_PAYMENT = {
    ("FR", "IDF", "card", 1, 20.0), ("FR", "IDF", "cash", 1, 40.0), ("US", "CA", "card", 1, 5.0)
}
BY_COUNTRY = {("FR", 15.0, 10.0, (10.0, 10.0, 20.0)), ("US", 5.0, 5.0, (5.0, 5.0, 5.0))}
TOTALS = {(32.5, 5.0, (5.0, 5.0, 60.0))}


@pytest.mark.parametrize("staged", [True, False])
def test_joined(spark, staged):
    joined = enrich(*three_inputs(spark), staged=staged)
    assert joined.columns == JOINED_COLUMNS and len(JOINED_COLUMNS) == 32
    assert collected(joined, "TransactionID", "account_number", "NationalID") == {
        ("T1", "A1", "N7"), ("T1", "A2", "N7"), ("T2", "A1", "N7"), ("T2", "A2", "N7"),
        ("T3", "A3", "N8"),
    }


def test_joined_columns_are_chosen_and_checked(spark):
    inputs = three_inputs(spark)
    assert enrich(*inputs, columns=["Country", "CustomerID"]).columns == ["Country", "CustomerID"]
    with pytest.raises(ValueError, match="'Ville' is in none"):
        enrich(*inputs, columns=["Ville"])
    both = [df.withColumn("valid_flag", F.lit(True)) for df in inputs]
    with pytest.raises(ValueError, match="transactions and accounts and master"):
        enrich(*both, columns=["valid_flag"])
    with pytest.raises(ValueError, match="twice"):
        enrich(*inputs, columns=["Country", "country"])


@pytest.mark.parametrize("exact_money", [False, True])
def test_marts_of_the_joined_table(spark, exact_money):
    joined = enrich(*three_inputs(spark))
    assert collected(country_gender_account(joined, exact_money=exact_money)) == BY_ACCOUNT
    assert collected(country_department_payment(joined, exact_money=exact_money)) == BY_PAYMENT


@pytest.mark.parametrize("exact", [False, True])
@pytest.mark.parametrize("exact_money", [False, True])
def test_distributions_of_the_joined_table(spark, exact, exact_money):
    joined = enrich(*three_inputs(spark))
    options = {"exact": exact, "exact_money": exact_money}
    assert collected(distribution(joined, **options)) == BY_COUNTRY
    assert collected(totals_distribution(joined, **options)) == TOTALS


@pytest.mark.parametrize("exact_money", [False, True])
def test_marts_of_the_inputs(spark, exact_money):
    inputs = three_inputs(spark)
    assert collected(factored_mart(*inputs, COUNTRY_GENDER_ACCOUNT, exact_money=exact_money)) == BY_ACCOUNT
    assert collected(factored_mart(*inputs, COUNTRY_DEPARTMENT_PAYMENT, exact_money=exact_money)) == BY_PAYMENT
    assert collected(factored_distribution(*inputs, exact_money=exact_money)) == BY_COUNTRY
    assert collected(factored_totals_distribution(*inputs, exact_money=exact_money)) == TOTALS


def test_output_types(spark):
    joined = enrich(*three_inputs(spark))
    for exact_money in (False, True):
        mart = country_gender_account(joined, exact_money=exact_money)
        assert mart.dtypes[3:] == [("nb_clients", "bigint"), ("total_montant", "double")]
        for exact in (False, True):
            stats = distribution(joined, exact=exact, exact_money=exact_money)
            assert stats.dtypes == [
                ("Country", "string"), ("moyenne", "double"), ("mediane", "double"),
                ("quantiles", "array<double>"),
            ]


def test_column_names_can_be_chosen(spark):
    joined = enrich(*three_inputs(spark)).withColumnsRenamed({
        "Country": "the country", "Gender": "g.x", "account_type": "kind", "CustomerID": "who",
        "Montant": "how much",
    })
    mart = country_gender_account(joined, "the country", "g.x", "kind", "who", "how much")
    assert {tuple(r) for r in mart.collect()} == BY_ACCOUNT
    for exact in (False, True):
        stats = distribution(joined, ["the country"], "how much", exact=exact)
        assert {(r[0], r[2]) for r in stats.collect()} == {("FR", 10.0), ("US", 5.0)}
    assert totals_distribution(joined, ["the country"], "how much").first()["moyenne"] == 32.5
    assert segment_mart(joined, ["kind"], "who", "how much").count() == 2


def test_factored_dimensions_may_hold_dots(spark):
    transactions, accounts, master = three_inputs(spark)
    renamed = (transactions, accounts, master.withColumnRenamed("Country", "the.pays"))
    assert {tuple(r) for r in factored_mart(*renamed, ["the.pays"]).collect()} == {
        ("FR", 1, 60.0), ("US", 1, 5.0)
    }
    stats = factored_distribution(*renamed, by=["the.pays"])
    assert {tuple(r)[:3] for r in stats.collect()} == {("FR", 15.0, 10.0), ("US", 5.0, 5.0)}


def test_repeated_master_rows_and_accounts_multiply(spark):
    transactions, accounts, master = three_inputs(spark)
    twice = master.unionByName(master)
    joined = enrich(transactions, accounts, twice)
    assert joined.count() == 10
    for dims in (COUNTRY_GENDER_ACCOUNT, COUNTRY_DEPARTMENT_PAYMENT, ["Country"]):
        expected = collected(segment_mart(joined, dims))
        assert collected(factored_mart(transactions, accounts, twice, dims)) == expected
    assert collected(factored_distribution(transactions, accounts, twice)) == collected(
        distribution(joined, exact=True)
    )


def test_distribution_by_any_input_column(spark):
    inputs = three_inputs(spark)
    joined = enrich(*inputs)
    for by in (["MoyenPaiement"], ["account_type", "Country"], ["MoyenPaiement", "Gender"], []):
        assert collected(factored_distribution(*inputs, by=by)) == collected(
            distribution(joined, by=by, exact=True)
        )


def test_empty_inputs(spark):
    transactions, accounts, master = three_inputs(spark)
    none = transactions.limit(0)
    joined = enrich(none, accounts, master)
    for exact in (False, True):
        assert distribution(joined, exact=exact).count() == 0
        assert collected(totals_distribution(joined, exact=exact)) == {(None, None, None)}
        assert collected(distribution(joined, by=[], exact=exact)) == {(None, None, None)}
    assert factored_mart(none, accounts, master, COUNTRY_GENDER_ACCOUNT).count() == 0
    assert collected(factored_totals_distribution(none, accounts, master)) == {(None, None, None)}


def test_unmatched_and_fan_out(spark):
    inputs = three_inputs(spark)
    keyless = inputs[0].withColumn("CustomerID", F.lit(None).cast("string")).limit(1)
    inputs = (inputs[0].unionByName(keyless), *inputs[1:])
    assert unmatched(*inputs).count() == 3
    counts = fan_out(rollups(*inputs, dims=())).first().asDict()
    assert {k: float(v) for k, v in counts.items()} == {
        "transactions": 6, "unmatched": 3, "joined_rows": 5, "fan_out": 5 / 3
    }


def test_counts_beyond_a_long(spark):
    """A customer's repetitions may multiply past the range of a 64-bit number."""
    many = 9_000_000_000
    rolled = Rollups(
        spark.createDataFrame([("7", many, 2.0)], "_customer string, _rows long, _total double"),
        spark.createDataFrame([("7", many)], "_customer string, _rows long"),
        spark.createDataFrame([("7", "FR", many)], "_customer string, Country string, _rows long"),
    )
    assert fan_out(rolled).first()["joined_rows"] == many**3
    assert mart_of(rolled, ["Country"]).first()["total_montant"] == pytest.approx(2.0 * many**2)


def random_inputs(spark, seed):
    """Keys that are missing, repeated or padded; dimensions that are missing."""
    rng = random.Random(seed)
    keys = ["1", "2", "3", "03", "4", "7", None]
    pick = lambda *values: rng.choice(values)
    transactions = [
        {"TransactionID": str(i), "CustomerID": pick(*keys, "7", "7", "7"),
         "Montant": pick(None, round(rng.uniform(-50, 500), 2)), "MoyenPaiement": pick("card", None)}
        for i in range(120)
    ]
    accounts = [
        {"customerid": pick(*keys), "account_number": str(i), "account_type": pick("a", "b", None)}
        for i in range(25)
    ]
    master = [
        {"Number": pick(1, 2, 3, 7, 8, None), "Country": pick("FR", "US", None),
         "Gender": pick("F", None), "State": pick("X", "Y"), "NationalID": str(i)}
        for i in range(12)
    ]
    return (
        typed(spark, TRANSACTIONS, transactions), typed(spark, ACCOUNTS, accounts),
        typed(spark, MASTER, master),
    )


@pytest.mark.parametrize("seed", range(4))
def test_both_ways_agree_on_random_inputs(spark, seed):
    inputs = random_inputs(spark, seed)
    joined = enrich(*inputs).persist()
    for dims in (COUNTRY_GENDER_ACCOUNT, COUNTRY_DEPARTMENT_PAYMENT):
        expected = collected(segment_mart(joined, dims, exact_money=True))
        assert collected(factored_mart(*inputs, dims, exact_money=True)) == expected
    for by in (["Country"], ["account_type", "MoyenPaiement"]):
        expected = collected(distribution(joined, by, exact=True, exact_money=True))
        assert collected(factored_distribution(*inputs, by=by, exact_money=True)) == expected
        assert collected(distribution(joined, by, exact_money=True)) == expected
    rolled = rollups(*inputs, dims=())
    counts = fan_out(rolled).first()
    assert counts["transactions"] == 120 and counts["joined_rows"] == joined.count()
    assert counts["unmatched"] == unmatched(*inputs).count()
    joined.unpersist()
