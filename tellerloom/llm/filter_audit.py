"""Audit of filters that overlap, through the Hart-Mas-Colell potential of their removal game.

The value v(S) of a set S of filters is the number of documents that at least one of them rejects. The
potential is defined over all sets by P(empty) = 0 and

    P(S) = (v(S) + sum of P(S without i) over i in S) / |S|,

and the Shapley value of filter i, its share of all removals, is P(all) - P(all without i). What a filter
removes at its place in an order is v(S with it) - v(S) for the set S before it. So one row a part, with
how many documents fail which combination of filters, gives the report of every order without applying
any of them; documents are read once.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerloom.staging import Staging

# Words end at ASCII white space, as in the other operators of this folder.
WORD = r"[^\x20\x09-\x0D]+"
TEXT_FILTERS = ("A", "B", "C", "D")
FILTERS = (*TEXT_FILTERS, "E")
# All orders of a part are rows of the result, so their number has a limit.
MOST_FILTERS = 6
MEASURES = ("documents", "good", "toxic")


def text_failures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the bits of the failed text filters in ``failed``: 1 for A, 2 for B, 4 for C, 8 for D.

    A: under 50 words. B: under 65 % of the words differ. C: over 5 % of the code points are A-Z. D: holds
    one of ``#$%&*|``. An empty text fails A alone.
    """
    text = F.col(text_col)
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    fails = (
        n < 50,
        100 * distinct.cast("long") < 65 * n.cast("long"),
        100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 5 * F.length(text).cast("long"),
        text.rlike(r"[#$%&*|]"),
    )
    bits = [F.when(fail, 1 << i).otherwise(0) for i, fail in enumerate(fails)]
    return docs.withColumn("failed", sum(bits[1:], bits[0]))


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with ``good`` and ``toxic`` of their id; false where a label is null or there is none.

    Rows without an id meet no label; a hash of the text spreads them over all tasks.
    """
    marks = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("key"))
        .agg(
            F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
            F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
        )
        .withColumn("spread", F.lit(0).cast("long"))
    )
    spread = F.when(F.col("id").isNull(), F.xxhash64("same").bitwiseOR(F.lit(1))).otherwise(0)
    keyed = rows.withColumns({"key": F.coalesce("id", F.lit(0)), "spread": spread})
    return keyed.join(marks, ["key", "spread"], "left").fillna(False, ["good", "toxic"])


def failure_counts(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
    staging: Staging | None = None,
) -> DataFrame:
    """``part``, ``failed`` and the counts MEASURES: how many documents fail which of the five filters.

    Filters A to D are those of ``text_failures``, on the text, a null one taken as empty; bit 16 is E: a
    row of a smaller id, in any part, has the same text. Rows of the smallest id of a text don't fail E,
    however often they repeat; rows without an id neither fail it nor make others fail. A null part is the
    empty string. A document is good or toxic if any row of ``labels`` with its id says 1. Columns beyond
    those named are not looked at; an empty table gives no rows.

    A text is known by its SHA-256. Rows are summed per text, part and label before texts meet, and the
    first row of a text is found by text and id, so copies of one text are a few rows and a part of any
    size is spread by texts.
    """
    staging = staging or Staging(docs.sparkSession)
    plain = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
    )
    rows = text_failures(plain).select(
        "id", "part", "failed", F.unhex(F.sha2("text", 256)).alias("same")
    )
    kind = ["same", "part", "failed", "good", "toxic"]
    # The join has dealt the rows by id, so counting repeated rows needs no further shuffle.
    per_id = (
        _labelled(rows, labels)
        .groupBy("key", "spread", "id", *kind)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    classes = staging.table(
        per_id.groupBy(*kind, F.col("id").isNull().alias("idless")).agg(
            F.sum("n").alias("n"), F.min(F.struct("id", "n")).alias("first")
        ),
        "classes",
    )
    with_id = classes.where(~F.col("idless"))
    first_ids = with_id.groupBy("same").agg(F.min("first.id").alias("id"))
    # By text and id, a text that is in very many parts is not one key.
    firsts = with_id.select(*kind, F.col("first.id").alias("id"), F.col("first.n").alias("n")).join(
        first_ids, ["same", "id"]
    )
    columns = ["part", "failed", "good", "toxic", "n"]
    repeated = F.col("failed") + F.when(F.col("idless"), 0).otherwise(16)
    every = classes.withColumn("failed", repeated).select(columns)
    # The first rows were counted as repeated.
    moved = firsts.select(
        "part",
        "good",
        "toxic",
        F.inline(
            F.array(
                F.struct("failed", "n"),
                F.struct((F.col("failed") + 16).alias("failed"), (-F.col("n")).alias("n")),
            )
        ),
    )
    return (
        every.unionByName(moved)
        .groupBy("part", "failed")
        .agg(
            F.sum("n").alias("documents"),
            F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
        )
    )


def coalition_values(counts: DataFrame, filters: int) -> DataFrame:
    """One row a part: ``total``, and for each measure an array of v(S), S being the index's bits.

    ``counts`` has at most 2 ** ``filters`` rows a part, so a part is a bounded list.
    """
    cells = F.collect_list(F.struct("failed", *MEASURES))
    parts = counts.groupBy("part").agg(cells.alias("cells"), F.sum("documents").alias("total"))
    zero = F.lit(0).cast("long")

    def value(measure: str) -> Column:
        def of(coalition: Column) -> Column:
            def added(total: Column, cell: Column) -> Column:
                hit = cell["failed"].bitwiseAND(coalition) != 0
                return total + F.when(hit, cell[measure]).otherwise(zero)

            return F.aggregate("cells", zero, added)

        return F.transform(F.sequence(F.lit(0), F.lit((1 << filters) - 1)), of)

    return parts.select("part", "total", *[value(m).alias(m) for m in MEASURES])


def potentials(values: Column, filters: int) -> Column:
    """P(S) times ``filters`` factorial for every set S, which makes all of them whole numbers.

    The sets are met in the order of their bits, so those with one filter less come before.
    """
    scale = factorial(filters)

    def with_next(found: Column, coalition: Column) -> Column:
        members = [coalition.bitwiseAND(F.lit(1 << i)) != 0 for i in range(filters)]
        zero = F.lit(0).cast("long")
        without = [
            F.when(member, F.get(found, coalition.bitwiseXOR(F.lit(1 << i)))).otherwise(zero)
            for i, member in enumerate(members)
        ]
        size = sum((member.cast("long") for member in members[1:]), members[0].cast("long"))
        total = sum(without, F.get(values, coalition) * scale)
        # Divides without remainder: P(S) has the factorial of |S| below it at most.
        return F.concat(found, F.array(F.call_function("div", total, size)))

    start = F.array(F.lit(0).cast("long"))
    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << filters) - 1)), start, with_next)


def report(counts: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step: what happens there, and the filter's share.

    ``counts`` has ``part``, ``failed`` (bit i is filter i), and the counts MEASURES, one row per part and
    ``failed`` at most, as ``failure_counts`` gives them. ``filter_order`` is the names in their order,
    ``step`` counts from 1 and ``filter`` is the one applied there. ``kept`` documents are left after it,
    ``removed`` go there, ``redundant`` fail it but went before, ``unique_fails`` fail no other filter;
    ``good_lost`` and ``toxic_lost`` of the removed are good and toxic. ``shapley`` is the filter's
    removals summed over all orders. A part without rows in ``counts`` has none here.
    """
    n = len(filters)
    if n > MOST_FILTERS:
        raise ValueError(f"{n} filters have too many orders for a report; at most {MOST_FILTERS}")
    everything = (1 << n) - 1
    games = coalition_values(counts, n).withColumn("potential", potentials(F.col("documents"), n))
    orders = ["".join(map(str, order)) for order in permutations(range(n))]
    places = games.withColumn("places", F.explode(F.lit(orders))).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(n)))
    )

    def bit_at(place: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1), F.substring("places", place, F.lit(1)).cast("int"))

    names = F.lit(list(filters))
    earlier = F.aggregate(
        F.sequence(F.lit(1), F.lit(n)),
        F.lit(0),
        lambda found, place: found + F.when(place < F.col("step"), bit_at(place)).otherwise(0),
    )
    own = F.substring("places", F.col("step"), F.lit(1)).cast("int")
    placed = places.withColumns({"before": earlier, "own": own, "bit": bit_at(F.col("step"))})
    after = F.col("before") + F.col("bit")

    def step_of(measure: str) -> Column:
        return F.get(measure, after) - F.get(measure, F.col("before"))

    def lost_without(column: str) -> Column:
        return F.get(column, F.lit(everything)) - F.get(column, F.lit(everything) - F.col("bit"))

    letters = F.transform(F.split("places", ""), lambda place: F.get(names, place.cast("int")))
    return placed.select(
        "part",
        F.array_join(letters, "").alias("filter_order"),
        "step",
        F.get(names, F.col("own")).alias("filter"),
        (F.col("total") - F.get("documents", after)).alias("kept"),
        step_of("documents").alias("removed"),
        (F.get("documents", F.col("bit")) - step_of("documents")).alias("redundant"),
        lost_without("documents").alias("unique_fails"),
        step_of("good").alias("good_lost"),
        step_of("toxic").alias("toxic_lost"),
        lost_without("potential").alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, staging: Staging | None = None) -> DataFrame:
    """The report of the five filters over whole ``docs``; see ``failure_counts`` and ``report``."""
    return report(failure_counts(docs, labels, staging=staging))
