"""Plans: what is read, what is shuffled, and what happens to a customer with most of the rows."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tellerloom import standin
from tellerloom.operators import (
    COUNTRY_GENDER_ACCOUNT, country_gender_account, dedup, distribution, enrich,
    factored_distribution, factored_mart, fan_out, rollups, segment_mart,
    unmatched,
)
from tellerloom.plans import prepare_all
from tellerloom.session import scale_options
from tellerloom.staging import Staging
from tests.samples import collected

FOLDER = "/root/testdata/sf0.01"

# Small enough that the test tables count as large: no broadcast, and a hot key counts as skew.
LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
}


@contextmanager
def conf(spark, settings):
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def executed(df):
    """The plan as it ran, and the rows."""
    rows = [tuple(r) for r in df.collect()]
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0], rows


@pytest.fixture(scope="module")
def hot(spark):
    """Two fifths of the transactions belong to one customer; they lie in several files."""
    transactions = standin.transactions(spark, FOLDER)
    urgent = F.col("MoyenPaiement").isin("1-URGENT", "2-HIGH")
    moved = transactions.withColumn("CustomerID", F.when(urgent, "7").otherwise(F.col("CustomerID")))
    return (
        Staging(spark).table(moved.repartition(16, "TransactionID"), "hot"),
        standin.accounts(spark, FOLDER),
        standin.master(spark, FOLDER),
    )


@pytest.fixture
def scaled(spark, hot, tmp_path):
    """What the session settings are for an input of this size, cut to the size of the test."""
    options = scale_options(320_000, cores=8, checkpoint_dir=str(tmp_path), partition_bytes=20_000)
    runtime = {k: v for k, v in options.items() if k.startswith("spark.sql.")}
    return {**runtime, **{k: LARGE[k] for k in LARGE if "Broadcast" in k or "Factor" in k}}


def test_hot_customer_is_split_under_the_session_settings(spark, hot, scaled):
    columns = ["TransactionID", "account_number", "Country"]
    expected = collected(enrich(*hot, columns))
    with conf(spark, scaled):
        plan, rows = executed(enrich(*hot, columns))
    assert "SortMergeJoin(skew=true)" in plan
    assert len(rows) == len(expected) and set(rows) == expected


def test_hot_customer_is_split_in_the_joined_table(spark, hot):
    columns = ["TransactionID", "account_number", "Country"]
    expected = collected(enrich(*hot, columns))
    with conf(spark, LARGE):
        plan, rows = executed(enrich(*hot, columns))
    assert "SortMergeJoin(skew=true)" in plan
    assert len(rows) == len(expected) and set(rows) == expected


def test_hot_customer_is_split_under_a_mart_of_the_joined_table(spark, hot):
    """Counting distinct customers must not tie the join to whole customers."""
    columns = [*COUNTRY_GENDER_ACCOUNT, "CustomerID", "Montant"]
    mart = country_gender_account(enrich(*hot, columns), exact_money=True)
    expected = collected(mart)
    with conf(spark, LARGE):
        plan, rows = executed(country_gender_account(enrich(*hot, columns), exact_money=True))
    assert "SortMergeJoin(skew=true)" in plan
    assert set(rows) == expected


def test_hot_customer_is_split_among_the_unmatched(spark, hot):
    transactions, accounts, master = hot
    inputs = (transactions, accounts, master.where("Number <> 7"))
    expected = unmatched(*inputs).count()
    with conf(spark, LARGE):
        plan, rows = executed(unmatched(*inputs))
    assert "SortMergeJoin(skew=true)" in plan
    assert len(rows) == expected > 5_000


def test_hot_customer_is_split_under_its_amounts(spark, hot, monkeypatch):
    plans = []

    from tellerloom.operators import factored
    kept = factored.weighted_distribution

    def spy(values, *args, **kwargs):
        plans.append(executed(values)[0])
        return kept(values, *args, **kwargs)

    expected = collected(distribution(enrich(*hot), exact=True, exact_money=True))
    monkeypatch.setattr(factored, "weighted_distribution", spy)
    with conf(spark, LARGE):
        got = collected(factored_distribution(*hot, exact_money=True))
    assert "SortMergeJoin(skew=true)" in plans[0]
    assert got == expected


def test_marts_never_produce_the_fan_out(spark, hot):
    """With two fifths of the transactions and a third of the accounts the join has millions of rows."""
    transactions, accounts, master = hot
    final = F.col("account_type") == "F"
    held = accounts.withColumn("customerid", F.when(final, "7").otherwise(F.col("customerid")))
    mart = factored_mart(transactions, held, master, COUNTRY_GENDER_ACCOUNT, exact_money=True)
    plan, rows = executed(mart)
    joined_rows = (
        transactions.groupBy("CustomerID").count()
        .join(held.groupBy("customerid").count().withColumnsRenamed({"customerid": "c", "count": "n"}),
              F.col("CustomerID") == F.col("c"))
        .agg(F.sum(F.col("count") * F.col("n"))).first()[0]
    )
    assert joined_rows > 5_000_000
    assert "Expand" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    # Both large inputs are aggregated before their rows are first shuffled by customer.
    for line in ("partial_sum(", "partial_count("):
        assert line in plan
    assert len(rows) > 30


def test_factored_marts_equal_the_joined_ones(spark, hot):
    joined = enrich(*hot)
    for dims in (COUNTRY_GENDER_ACCOUNT, ("Country", "State", "MoyenPaiement"), ("Gender",)):
        assert collected(factored_mart(*hot, dims, exact_money=True)) == collected(
            segment_mart(joined, dims, exact_money=True)
        )


def test_mart_plans_read_only_their_columns(spark):
    prepared = prepare_all(standin.datasets(spark, FOLDER))
    mart = country_gender_account(
        enrich(*prepared.values(), columns=[*COUNTRY_GENDER_ACCOUNT, "CustomerID", "Montant"], staged=False)
    )
    plan = mart._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2" not in plan and "valid_flag" not in plan

    inputs = standin.datasets(spark, FOLDER).values()
    plan = factored_mart(*inputs, COUNTRY_GENDER_ACCOUNT)._jdf.queryExecution().executedPlan().toString()
    reads = sorted(line.split("FileScan parquet ")[1].split(" ")[0] for line in plan.splitlines() if "FileScan" in line)
    columns = [sorted(c.split("#")[0] for c in read.strip("[]").split(",")) for read in reads]
    assert ["o_custkey", "o_totalprice"] in columns
    assert all("o_orderdate" not in read for read in columns)


def test_distinct_customers_need_no_expansion(spark):
    joined = enrich(*standin.datasets(spark, FOLDER).values())
    plan = country_gender_account(joined)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "partial_sum" in plan


def test_copies_are_dropped_before_the_shuffle(spark):
    """A row that is there many times crosses the network once per map task."""
    transactions = standin.transactions(spark, FOLDER)
    third = transactions.where("MoyenPaiement IN ('1-URGENT', '2-HIGH')").limit(1)
    copies = transactions.unionByName(
        third.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(7500)))).drop("n")
    )
    plan = dedup(copies)._jdf.queryExecution().executedPlan().toString()
    shuffle = next(i for i, line in enumerate(plan.splitlines()) if "Exchange hashpartitioning" in line)
    assert "HashAggregate" in plan.splitlines()[shuffle + 1]
    assert dedup(copies).count() == 15_000


def test_quality_counts_do_not_join_rows(spark, hot):
    plan, rows = executed(fan_out(rollups(*hot, dims=())))
    assert "partial_count" in plan and "Expand" not in plan
    assert rows[0][0] == 15_000
