"""Mean, median and quantiles of amounts, per group or overall.

A quantile is always one of the amounts: the smallest that at least the given share of the rows do
not exceed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tellerloom.functions.casts import money
from tellerloom.functions.names import ref
from tellerloom.staging import Staging

QUARTILES = (0.25, 0.5, 0.75)
MEDIAN = 0.5

# Sketches of map tasks meet in this many slices a group before the slices meet.
SLICES = 256
# Size parameters a sketch can have, and the accuracy up to which they give the better confidence.
_LEAST_K, _MOST_K = 8, 65_535
MOST_ACCURACY = 10_500

# At most this many amounts of one range are ranked by one sort in one task.
WINDOW_ROWS = 1_000_000
# Into how many intervals each further pass cuts a range that has more.
INTERVALS = 1_000

_VALUE, _WEIGHT, _TARGET, _RANK = "_value", "_weight", "_target", "_rank"
_SLICE = "_slice"


def distribution(
    df: DataFrame,
    by: Sequence[str] = ("Country",),
    amount: str = "Montant",
    probabilities: Sequence[float] = QUARTILES,
    accuracy: int = 10_000,
    exact: bool = False,
    as_array: bool = True,
    exact_money: bool = False,
    staging: Staging | None = None,
    slices: int = SLICES,
) -> DataFrame:
    """Mean, median and quantiles of ``amount`` per group of ``by``; no ``by`` is one overall row.

    The default estimates quantiles in one pass and bounded memory: every map task makes a sketch per
    group, those of some tasks are merged to one of ``slices`` sketches a group, and these to one. So no
    task reads a sketch from every map task. The rank of an estimate is off by at most ``1/accuracy`` of
    the rows, but for a chance below one in a million at the default accuracy; groups of fewer rows than
    ``sketch_size(accuracy)`` have their true quantiles. ``exact`` finds the true ones of any group and
    spreads its work over many tasks. Of a joined table it first writes the amounts, repetitions and
    all; ``factored_distribution`` gives the same from the three inputs without them and is the better
    choice where they are at hand. NaN amounts count as the largest when exact; estimates leave them out.
    ``as_array=False`` gives one column per quantile, for databases without arrays.
    """
    groups = [ref(name) for name in by]
    if exact:
        once = F.lit(1).cast("bigint").alias(_WEIGHT)
        own = [ref(name).alias(name) for name in by]
        amounts = df.select(*own, ref(amount).alias(_VALUE), once)
        return weighted_distribution(
            amounts, by, probabilities, as_array, exact_money, staging=staging
        )

    size = sketch_size(accuracy)
    value = ref(amount)
    # The task a row is read by, so a task has one sketch a group, and a repeated task the same.
    slice_of = F.pmod(F.spark_partition_id(), F.lit(slices)).alias(_SLICE)
    narrow = df.select(*groups, value.alias(_VALUE), slice_of)
    value = F.col(_VALUE)
    total = F.sum(value.cast("double"))
    if exact_money:
        # Totals added up in cents are cents already, and may have more digits than one amount.
        cents = isinstance(narrow.schema[_VALUE].dataType, DecimalType)
        total = F.sum(money(value, not cents))
    parts = narrow.groupBy(*groups, _SLICE).agg(
        total.alias("_sum"),
        F.count(value).alias("_all"),
        F.kll_sketch_agg_double(value.cast("double"), size).alias("_sketch"),
    )
    # One sketch for all that is asked, the median included.
    asked = list(dict.fromkeys(float(p) for p in (MEDIAN, *probabilities)))
    merged = parts.groupBy(*groups).agg(
        (F.sum("_sum").cast("double") / F.sum("_all").cast("double")).alias("moyenne"),
        F.kll_merge_agg_double("_sketch", size).alias("_sketch"),
    )
    # A sketch of nothing has no quantiles to ask for.
    filled = F.kll_sketch_get_n_double("_sketch") > 0
    ranks = F.array(*[F.lit(p) for p in asked])
    found = merged.withColumn(
        "_asked", F.when(filled, F.kll_sketch_get_quantile_double("_sketch", ranks))
    )
    picked = {p: F.col("_asked")[i] for i, p in enumerate(asked)}
    quantiles = F.array(*[picked[float(p)] for p in probabilities])
    stats = found.select(
        *groups,
        "moyenne",
        picked[MEDIAN].alias("mediane"),
        F.when(F.col("_asked").isNotNull(), quantiles).alias("quantiles"),
    )
    return stats if as_array else flatten_quantiles(stats, probabilities)


def sketch_size(accuracy: int) -> int:
    """The size parameter of a sketch whose rank error, at 99 %, is half of ``1/accuracy``.

    The error of a KLL sketch of size k is 2.296 / k ** 0.9723 of the rows at 99 %, and twice that at
    more than 99.9999 %. Sizes end at 65535, which leaves 99 % at an accuracy of 21,000.
    """
    if not 1 <= accuracy <= 2 * MOST_ACCURACY:
        raise ValueError(f"accuracy {accuracy}: an estimate has 1 to {2 * MOST_ACCURACY}; use exact")
    size = math.ceil((2 * accuracy * 2.296) ** (1 / 0.9723))
    return max(_LEAST_K, min(_MOST_K, size))


def totals_distribution(
    df: DataFrame,
    by: Sequence[str] = ("Country",),
    amount: str = "Montant",
    probabilities: Sequence[float] = QUARTILES,
    accuracy: int = 10_000,
    exact: bool = False,
    as_array: bool = True,
    exact_money: bool = False,
) -> DataFrame:
    """The distribution, over all groups, of each group's amount total. Exactly one row."""
    total = F.sum(money(ref(amount), exact_money)).alias("total_montants")
    totals = df.groupBy(*[ref(name) for name in by]).agg(total)
    return distribution(
        totals, (), "total_montants", probabilities, accuracy, exact, as_array, exact_money
    )


def quantile_name(probability: float) -> str:
    """Column name of a quantile: ``p25`` for 0.25."""
    return "p" + f"{Decimal(str(probability)) * 100:f}".rstrip("0").rstrip(".").replace(".", "_")


def flatten_quantiles(stats: DataFrame, probabilities: Sequence[float] = QUARTILES) -> DataFrame:
    """One column per quantile instead of the array."""
    columns = {
        quantile_name(p): F.col("quantiles")[position] for position, p in enumerate(probabilities)
    }
    return stats.withColumns(columns).drop("quantiles")


def weighted_distribution(
    amounts: DataFrame,
    by: Sequence[str],
    probabilities: Sequence[float] = QUARTILES,
    as_array: bool = True,
    exact_money: bool = False,
    window_rows: int = WINDOW_ROWS,
    staging: Staging | None = None,
) -> DataFrame:
    """Exact distribution of amounts that each stand for a number of rows.

    ``amounts`` has the columns ``by``, ``_value`` and ``_weight``. Repetition is a number here, so
    no fan-out is ever written out, and the amounts are shuffled neither by group nor by value.

    The amounts are counted in intervals: that is one small row per group and interval, summed
    before the shuffle, and gives the means. Each quantile falls into one interval; one with more
    than ``window_rows`` amounts is cut again by the next pass, until what it holds is few enough
    to rank. No task ever sorts or holds a whole group, and nothing depends on how many rows there
    are in all.

    The result is staged, one row per group; what it was made from is removed.
    """
    staging = staging or Staging(amounts.sparkSession)
    asked = [Decimal(str(p)) for p in dict.fromkeys((MEDIAN, *probabilities))]
    with Staging(amounts.sparkSession) as scratch:
        table = scratch.table(amounts, "amounts")
        stats = _narrowed(scratch, table, by, asked, exact_money, window_rows)
        picked = {p: F.col(f"_q{i}").cast("double") for i, p in enumerate(asked)}
        median = picked[Decimal(str(MEDIAN))]
        # A group without a single amount has no quantiles, rather than an array of NULLs.
        array = F.array(*[picked[Decimal(str(p))] for p in probabilities])
        stats = stats.select(
            *[ref(name) for name in by],
            (F.col("_sum").cast("double") / F.col("_all").cast("double")).alias("moyenne"),
            median.alias("mediane"),
            F.when(median.isNotNull(), array).alias("quantiles"),
        )
        stats = stats if as_array else flatten_quantiles(stats, probabilities)
        return staging.table(stats, "distribution")


def _sum(amounts: DataFrame, exact_money: bool) -> Column:
    """The sum of the amounts over the rows they stand for."""
    value, weight = F.col(_VALUE), F.col(_WEIGHT)
    if exact_money:
        cents = isinstance(amounts.schema[_VALUE].dataType, DecimalType)
        return F.sum(money(value, not cents) * weight).alias("_sum")
    return F.sum(value.cast("double") * weight.cast("double")).alias("_sum")


def _rank(rows: Column, probability: Decimal) -> Column:
    """Position, from 1, of a quantile among so many rows."""
    position = F.ceil(rows.cast("decimal(28,0)") * F.lit(probability))
    return F.greatest(position, F.lit(1)).cast("decimal(28,0)")


def _running(order: str, *keys: Column | str) -> Window:
    window = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(order)
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _scale(value: Column) -> Column:
    """A number that grows with the amount over its whole range; infinity and NaN share the end."""
    value = value.cast("double")
    damped = F.signum(value) * F.log1p(F.abs(value))
    return F.greatest(F.lit(-1000.0), F.least(F.lit(1000.0), damped))


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    """Equal columns, pair by pair; NULL equals NULL."""
    pairs = [ref(a).eqNullSafe(ref(b)) for a, b in zip(left, right)]
    return reduce(and_, pairs, F.lit(True))


def _narrowed(
    staging: Staging,
    amounts: DataFrame,
    by: Sequence[str],
    asked: Sequence[Decimal],
    exact_money: bool,
    window_rows: int,
) -> DataFrame:
    group = [ref(name) for name in by]
    value, weight = F.col(_VALUE), F.col(_WEIGHT)
    low, high = F.col("_low"), F.col("_high")
    bounds = [F.min(value).alias("_low"), F.max(value).alias("_high")]
    held = [F.sum(weight).alias("_rows"), F.count(value).alias("_amounts"), *bounds]
    found = [*by, _TARGET, _RANK, "_low", "_high", "_amounts"]

    def hit(cells: DataFrame) -> DataFrame:
        """The cells that hold their target's rank, which then counts from the cell's start."""
        before = F.col("_upto") - F.col("_rows")
        inside = (before < F.col(_RANK)) & (F.col(_RANK) <= F.col("_upto"))
        left = (F.col(_RANK) - before).cast("decimal(28,0)")
        return cells.where(inside).withColumn(_RANK, left).select(*[ref(name) for name in found])

    def within(targets: DataFrame) -> DataFrame:
        """The amounts in the targets' ranges; a range that several targets share comes once.

        A range lies in one cell of the first pass, so the join is on group and cell: where Spark
        does not broadcast the ranges, that spreads the amounts of a group.
        """
        ranges = targets.select(*group, low.alias("_from"), high.alias("_to")).distinct()
        ranges = ranges.withColumn("_cell", percent(F.col("_from")))
        key = [*by, "_cell"]
        ranges = ranges.withColumnsRenamed({name: f"_of_{name}" for name in key})
        inside = (value >= F.col("_from")) & (value <= F.col("_to"))
        inside &= _same(key, [f"_of_{name}" for name in key])
        cut = amounts.withColumn("_cell", percent(value)).join(ranges, inside)
        return cut.drop("_cell", *[f"_of_{name}" for name in key])

    def shared_out(cells: DataFrame, targets: DataFrame) -> DataFrame:
        """Each target with the cells of its range."""
        key = [*by, "_from", "_to"]
        asked_of = [*group, low.alias("_from"), high.alias("_to"), _TARGET, _RANK]
        renamed = {name: f"_of_{name}" for name in key}
        own = targets.select(*asked_of).withColumnsRenamed(renamed)
        return cells.join(own, _same(key, list(renamed.values()))).drop(*renamed.values())

    def percent(amount: Column) -> Column:
        """The cell of an amount: one percent wide, the same for every group."""
        return F.when(amount.isNotNull(), F.floor(_scale(amount) * 100))

    first = amounts.groupBy(*group, percent(value).alias("_cell"))
    cells, largest = staging.measured(
        first.agg(*held, _sum(amounts, exact_money)), "cells", F.max("_amounts").alias("amounts")
    )
    counted = F.when(F.col("_cell").isNotNull(), F.col("_rows"))
    totals = cells.groupBy(*group).agg(F.sum(counted).alias("_all"), F.sum("_sum").alias("_sum"))
    everything = Window.partitionBy(*(group or [F.lit(0)]))
    upto = cells.where("_cell IS NOT NULL").withColumns({
        "_upto": F.sum("_rows").over(_running("_cell", *group)),
        "_every": F.sum("_rows").over(everything),
    })
    ranks = F.array(*[_rank(F.col("_every"), p) for p in asked])
    # Amounts of equal scale are neighbours, a few thousand at most; cutting stops there.
    too_wide = (F.col("_amounts") > window_rows) & (_scale(low) < _scale(high))
    counts = [F.count_if(too_wide).alias("wide")]
    targets = hit(upto.select("*", F.posexplode(ranks).alias(_TARGET, _RANK)))
    # Where a pass follows it reads the targets again and again; else they are a few rows of the cells.
    count = {"wide": 0}
    if (largest["amounts"] or 0) > window_rows:
        targets, count = staging.measured(targets, "targets", *counts)
    while count["wide"]:
        wide = targets.where(too_wide)
        cell = F.width_bucket(
            _scale(value), _scale(F.col("_from")), _scale(F.col("_to")), F.lit(INTERVALS)
        )
        counted = within(wide).groupBy(*group, "_from", "_to", cell.alias("_cell")).agg(*held)
        upto = F.sum("_rows").over(_running("_cell", *group, _TARGET))
        upto = shared_out(counted, wide).withColumn("_upto", upto)
        targets = targets.where(~too_wide).unionByName(hit(upto))
        targets, count = staging.measured(targets, "targets", *counts)

    # A range of one amount is the answer; the others are ranked.
    single = targets.where(low == high).select(*group, _TARGET, low.alias(_VALUE))
    several = targets.where(low < high)
    distinct = within(several).groupBy(*group, "_from", "_to", _VALUE)
    ranked = shared_out(distinct.agg(F.sum(weight).alias("_rows")), several)
    ranked = ranked.withColumn("_upto", F.sum("_rows").over(_running(_VALUE, *group, _TARGET)))
    reached = ranked.where(F.col("_upto") >= F.col(_RANK))
    quantiles = single.unionByName(
        reached.groupBy(*group, _TARGET).agg(F.min(value).alias(_VALUE))
    )

    # The totals bring in every group, also one without amounts.
    nothing = F.lit(None)
    total_types = {field.name: field.dataType for field in totals.schema}
    rows = quantiles.withColumns({
        name: nothing.cast(total_types[name]) for name in ("_all", "_sum")
    }).unionByName(totals.withColumns({
        _TARGET: F.lit(-1), _VALUE: nothing.cast(amounts.schema[_VALUE].dataType)
    }))
    picks = [F.max(F.when(F.col(_TARGET) == i, value)).alias(f"_q{i}") for i in range(len(asked))]
    measures = [F.max(name).alias(name) for name in ("_all", "_sum")]
    return rows.groupBy(*group).agg(*measures, *picks)
