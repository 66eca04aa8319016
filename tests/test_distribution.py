"""Exact quantiles, narrowed pass by pass, against brute force."""

import importlib
import math
import os
import random
import re
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tellerloom.operators import (
    distribution, flatten_quantiles, segment_mart, sketch_size, totals_distribution, weighted_distribution,
)
from tellerloom.operators.distribution import quantile_name
from tellerloom.staging import Staging
from tests.samples import collected
from tests.test_scale import conf

PERCENTS = (0.01, 0.25, 0.5, 0.75, 0.9, 1.0)


def brute_force(weighted, probability):
    """The smallest amount that at least the share of the rows do not exceed."""
    ordered = sorted(weighted, key=lambda p: (math.isnan(p[0]), p[0]))
    total = sum(w for _, w in ordered)
    rank = max(1, math.ceil(Fraction(str(probability)) * total))
    seen = 0
    for value, weight in ordered:
        seen += weight
        if seen >= rank:
            return value
    return None


def values_of(spark, groups):
    data = [(g, v, Decimal(w)) for g, pairs in groups.items() for v, w in pairs]
    return spark.createDataFrame(data, "Country string, _value double, _weight decimal(28,0)")


module = importlib.import_module("tellerloom.operators.distribution")

# No broadcast, as with very many targets.
SHUFFLED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def narrow(monkeypatch, intervals=7):
    """Few intervals per pass, so that small inputs take several passes."""
    monkeypatch.setattr(module, "INTERVALS", intervals)


def sample_groups(seed):
    rng = random.Random(seed)
    groups = {}
    for group, size in (("FR", 400), ("US", 150), (None, 60), ("LU", 1)):
        amounts = {round(rng.lognormvariate(4, 3), 2) * rng.choice([1, 1, -1]) for _ in range(size)}
        groups[group] = [(a, rng.choice([1, 1, 2, 50, 10**12])) for a in amounts]
    groups["EXTREME"] = [(x, 1) for x in (0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, math.inf, -math.inf)]
    groups["CLOSE"] = [(1e9 + i * 2**-22, 3) for i in range(40)]
    return groups


@pytest.mark.parametrize("window_rows", [1_000_000, 5])
@pytest.mark.parametrize("broadcast", [True, False])
def test_weighted_quantiles_match_brute_force(spark, monkeypatch, window_rows, broadcast):
    narrow(monkeypatch)
    groups = sample_groups(1)
    with conf(spark, {} if broadcast else SHUFFLED):
        stats = weighted_distribution(
            values_of(spark, groups), ["Country"], PERCENTS, window_rows=window_rows
        )
    got = {r["Country"]: r for r in stats.collect()}
    assert set(got) == set(groups)
    for group, pairs in groups.items():
        expected = [brute_force(pairs, p) for p in PERCENTS]
        assert got[group]["quantiles"] == expected, group
        assert got[group]["mediane"] == brute_force(pairs, 0.5)
        if group != "EXTREME":
            total = sum(w for _, w in pairs)
            assert got[group]["moyenne"] == pytest.approx(sum(v * w for v, w in pairs) / total)


@pytest.mark.parametrize("window_rows", [1_000_000, 3])
def test_nan_is_the_largest_and_nulls_do_not_count(spark, monkeypatch, window_rows):
    narrow(monkeypatch)
    nan = float("nan")
    groups = {"FR": [(float(i), 1) for i in range(10)] + [(nan, 10)], "NONE": [(None, 4)]}
    groups["SOME"] = [(None, 100), (1.0, 1), (9.0, 1)]
    values = values_of(spark, groups)
    got = {
        r["Country"]: r
        for r in weighted_distribution(values, ["Country"], (0.25, 1.0), window_rows=window_rows).collect()
    }
    assert got["FR"]["quantiles"][0] == 4.0 and math.isnan(got["FR"]["quantiles"][1])
    assert got["SOME"]["quantiles"] == [1.0, 9.0] and got["SOME"]["moyenne"] == 5.0
    assert tuple(got["NONE"])[1:] == (None, None, None)


@pytest.mark.parametrize("window_rows", [1_000_000, 3])
def test_overall_without_groups(spark, monkeypatch, window_rows):
    narrow(monkeypatch)
    values = values_of(spark, {"x": [(float(i), i + 1) for i in range(50)]}).drop("Country")
    row = weighted_distribution(values, [], PERCENTS, window_rows=window_rows).collect()
    assert len(row) == 1
    assert row[0]["quantiles"] == [brute_force([(float(i), i + 1) for i in range(50)], p) for p in PERCENTS]


def test_group_names_may_hold_dots_and_blanks(spark, monkeypatch):
    narrow(monkeypatch)
    groups = {"FR": [(float(i), 1) for i in range(30)], None: [(float(i), 2) for i in range(9)]}
    values = values_of(spark, groups).withColumnRenamed("Country", "the.pays `x`")
    for window_rows in (3, 1000):
        stats = weighted_distribution(values, ["the.pays `x`"], window_rows=window_rows)
        assert {(r[0], r["mediane"]) for r in stats.collect()} == {("FR", 14.0), (None, 4.0)}


@pytest.mark.parametrize("exact", [False, True])
def test_percentile_rule(spark, exact):
    cases = {
        "a": ([1, 2, 3, 4], 2, [1, 2, 3]), "b": ([1, 2, 3, 4, 5], 3, [2, 3, 4]), "c": ([1, 2], 1, [1, 1, 2]),
        "d": ([1, None, 9], 1, [1, 1, 9]), "e": ([None], None, None),
    }
    data = [(k, None if v is None else float(v)) for k, (vs, _, _) in cases.items() for v in vs]
    df = spark.createDataFrame(data, "Country string, Montant double")
    got = {r["Country"]: (r["mediane"], r["quantiles"]) for r in distribution(df, exact=exact).collect()}
    assert got == {k: (median, quartiles) for k, (_, median, quartiles) in cases.items()}


def plans_of(monkeypatch, build):
    """The plans of the tables that are staged meanwhile, by label."""
    found = []
    kept = Staging.table

    def spy(self, df, label):
        found.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return kept(self, df, label)

    monkeypatch.setattr(Staging, "table", spy)
    result = build()
    monkeypatch.setattr(Staging, "table", kept)
    return result, found


def below(plan):
    """Each line of a plan with the lines of its subtree."""
    lines = plan.split("== Initial Plan ==")[-1].splitlines()
    depth = [len(line) - len(line.lstrip(" :+-*")) for line in lines]
    for at, line in enumerate(lines):
        end = next((i for i in range(at + 1, len(lines)) if depth[i] <= depth[at]), len(lines))
        yield line, lines[at + 1 : end]


def test_one_distribution_at_every_size(spark, monkeypatch):
    """How many amounts are ranked at once changes neither results nor where the means come from."""
    rng = random.Random(8)
    groups = {g: [(round(rng.uniform(0, 900), 2), rng.randint(1, 9)) for _ in range(300)] for g in "ABC"}
    results, fragments = [], []
    for window_rows in (1_000_000, 20, 1):
        values = values_of(spark, groups)
        stats, plans = plans_of(
            monkeypatch,
            lambda v=values, w=window_rows: weighted_distribution(
                v, ["Country"], PERCENTS, exact_money=True, window_rows=w
            ),
        )
        results.append(collected(stats.withColumn("quantiles", F.col("quantiles").cast("string"))))
        floats, float_plans = plans_of(
            monkeypatch,
            lambda v=values, w=window_rows: weighted_distribution(
                v, ["Country"], PERCENTS, window_rows=w
            ),
        )
        assert {r["Country"]: r["quantiles"] for r in floats.collect()} == {
            r["Country"]: r["quantiles"] for r in stats.collect()
        }
        cells = [plan for label, plan in float_plans if label == "cells"]
        assert len(cells) == 1
        fragments.append(re.sub(r"#[0-9]+L?|plan_id=[0-9]+|file:[^ ,\]]*", "", cells[0]))
    assert results[0] == results[1] == results[2]
    assert fragments[0] == fragments[1] == fragments[2]


@pytest.mark.parametrize("window_rows", [1_000_000, 3])
def test_amounts_are_never_shuffled_by_group_alone(spark, monkeypatch, window_rows):
    narrow(monkeypatch)
    values = values_of(spark, sample_groups(2))
    with conf(spark, SHUFFLED):
        _, plans = plans_of(
            monkeypatch,
            lambda: weighted_distribution(values, ["Country"], PERCENTS, window_rows=window_rows),
        )
    joined = 0
    for _, plan in plans:
        for line, subtree in below(plan):
            # An aggregate below has combined the amounts to a row per cell or range already.
            raw = [x for x in subtree if "FileScan" in x and "_weight" in x]
            combined = any("HashAggregate" in x or "SortAggregate" in x for x in subtree)
            if "Exchange hashpartitioning" in line and raw and not combined:
                joined += 1
                assert "_cell" in line, line
    assert joined > 0


def test_one_sketch_for_all_that_is_asked(spark):
    df = spark.createDataFrame([("FR", 1.0)], "Country string, Montant double")
    plan = distribution(df, probabilities=(0.1, 0.5, 0.9))._jdf.queryExecution().optimizedPlan()
    assert plan.toString().lower().count("kll_sketch_agg_double(") == 1
    assert plan.toString().lower().count("kll_merge_agg_double(") == 1


def test_no_task_meets_the_sketches_of_all_tasks(spark):
    """96 tasks of two groups: sketches meet in 8 slices a group, and those in one row a group."""
    df = spark.range(0, 96_000, 1, 96).selectExpr(
        "if(id % 3 = 0, 'FR', 'US') AS Country", "id * 7919 % 96000 AS Montant", "id % 5 AS _slice"
    )
    with conf(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        stats = distribution(df, slices=8)
        got = {r["Country"]: (r["mediane"], r["quantiles"]) for r in stats.collect()}
    amounts = {"FR": [], "US": []}
    for i in range(96_000):
        amounts["FR" if i % 3 == 0 else "US"].append(i * 7919 % 96000)
    for country, values in amounts.items():
        values.sort()
        quartiles = [values[math.ceil(p * len(values)) - 1] for p in (0.25, 0.5, 0.75)]
        # Fewer rows than the sketch: exact, FR; more: within the stated error, US.
        assert got[country][0] == got[country][1][1]
        for estimate, exact in zip(got[country][1], quartiles):
            assert abs(estimate - exact) <= 1.5 * len(values) / 10_000 + 2


@pytest.mark.parametrize(("accuracy", "rows"), [(20, 30_000), (200, 60_000), (2_000, 200_000)])
def test_merged_sketches_keep_the_rank_error(spark, accuracy, rows):
    """Sorted input, the worst for tasks that see a part of it each, with many repeated amounts."""
    df = spark.range(0, rows, 1, 40).selectExpr("'x' AS Country", "id div 3 AS Montant")
    percents = tuple(i / 20 for i in range(1, 20))
    row = distribution(df, probabilities=percents, accuracy=accuracy, slices=6).first()
    for p, estimate in zip(percents, row["quantiles"]):
        below, upto = estimate * 3, estimate * 3 + 3
        assert below <= p * rows + rows / accuracy + 1
        assert upto >= p * rows - rows / accuracy - 1


def test_estimates_leave_nan_out_and_take_any_number(spark):
    nan, inf = math.nan, math.inf
    df = spark.createDataFrame(
        [("a", nan), ("a", 1.0), ("a", 2.0), ("b", nan), ("c", -inf), ("c", inf), (None, 5.0)],
        "Country string, Montant double",
    )
    got = {r["Country"]: r["quantiles"] for r in distribution(df).collect()}
    assert got == {"a": [1.0, 1.0, 2.0], "b": None, "c": [-inf, -inf, inf], None: [5.0, 5.0, 5.0]}
    for kind in ("decimal(20,2)", "int", "float"):
        numbers = df.where("Country = 'a' AND NOT isnan(Montant)").selectExpr(
            "Country", f"cast(Montant AS {kind}) AS Montant"
        )
        row = distribution(numbers, exact_money=kind.startswith("decimal")).first()
        assert (row["moyenne"], row["mediane"], row["quantiles"]) == (1.5, 1.0, [1.0, 1.0, 2.0])
    assert distribution(df.limit(0)).count() == 0
    overall = distribution(df.limit(0), by=()).collect()
    assert [tuple(r) for r in overall] == [(None, None, None)]


def test_sizes_of_sketches():
    sizes = [sketch_size(a) for a in (1, 100, 10_000, 21_000)]
    assert sizes == sorted(sizes) and 8 <= sizes[0] and sizes[-1] == 65_535
    for accuracy in (10, 1_000, 10_000):
        assert 2.296 / sketch_size(accuracy) ** 0.9723 <= 0.5 / accuracy
    for accuracy in (0, 21_001):
        with pytest.raises(ValueError):
            sketch_size(accuracy)


def test_only_the_result_stays(spark):
    staging = Staging(spark)
    before = set(os.listdir(os.path.dirname(staging.root)))
    amounts = values_of(spark, sample_groups(3))
    stats = weighted_distribution(amounts, ["Country"], PERCENTS, staging=staging)
    assert set(os.listdir(os.path.dirname(staging.root))) == before
    assert [name.rpartition("-")[0] for name in os.listdir(staging.root)] == ["distribution"]
    assert stats.count() == 6
    staging.drop()


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("amount", [float("nan"), 1e17, 0.004, math.inf])
def test_what_is_no_cents_fails(spark, ansi, amount):
    df = spark.createDataFrame(
        [("FR", "c", 1.0), ("FR", "c", amount)], "Country string, CustomerID string, Montant double"
    )
    with conf(spark, {"spark.sql.ansi.enabled": ansi}):
        for build in (
            lambda: segment_mart(df, ["Country"], exact_money=True),
            lambda: distribution(df, exact_money=True),
            lambda: distribution(df, exact=True, exact_money=True),
            lambda: totals_distribution(df, exact_money=True),
        ):
            with pytest.raises(Exception, match="not an amount in whole cents"):
                build().collect()


def test_what_floating_point_makes_of_cents_passes(spark):
    amounts = [0.1 + 0.2, 1e15 / 3 // 0.01 / 100, -4.35, 123456789012.34, None]
    df = spark.createDataFrame([("FR", "c", x) for x in amounts], "Country string, CustomerID string, Montant double")
    total = segment_mart(df, ["Country"], exact_money=True).first()["total_montant"]
    assert total == pytest.approx(sum(x for x in amounts if x is not None))


def test_estimates_stay_within_their_accuracy(spark):
    df = spark.range(200_000).select(
        F.lit("FR").alias("Country"), (F.xxhash64("id") % 1_000_000).cast("double").alias("Montant")
    )
    for accuracy in (100, 10_000):
        for p, value in zip((0.1, 0.9), distribution(df, probabilities=(0.1, 0.9), accuracy=accuracy).first()["quantiles"]):
            rank = df.where(F.col("Montant") <= value).count() / 200_000
            assert abs(rank - p) <= 1.5 / accuracy


def test_exact_equals_percentile_disc(spark):
    df = spark.range(50_000).select(
        (F.col("id") % 3).cast("string").alias("Country"),
        (F.xxhash64("id") % 10_000).cast("double").alias("Montant"),
    )
    df.createOrReplaceTempView("amounts")
    expected = spark.sql(
        "SELECT Country, percentile_disc(0.25) WITHIN GROUP (ORDER BY Montant) p25, "
        "percentile_disc(0.5) WITHIN GROUP (ORDER BY Montant) p50, "
        "percentile_disc(0.75) WITHIN GROUP (ORDER BY Montant) p75 FROM amounts GROUP BY Country"
    )
    got = distribution(df, exact=True, as_array=False)
    assert collected(got, "Country", "p25", "p50", "p75") == collected(expected)


def test_flat_columns(spark):
    df = spark.createDataFrame([("FR", 1.0), ("FR", 2.0)], "Country string, Montant double")
    flat = distribution(df, probabilities=(0.05, 0.125, 1.0), as_array=False)
    assert flat.columns == ["Country", "moyenne", "mediane", "p5", "p12_5", "p100"]
    assert flatten_quantiles(distribution(df)).columns[-3:] == ["p25", "p50", "p75"]
    assert quantile_name(0.5) == "p50"
