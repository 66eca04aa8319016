"""Connected components of a graph given as an edge table, by repeated joins.

Every round replaces edges by edges to smaller neighbours (the alternating large-star and small-star
steps of Kiveris et al., 2014) and writes them to the shared folder, so lineage stays one round long
and a lost executor costs a re-read. Nothing about the graph reaches the driver but two sums.

A node with very many edges is not one key of a shuffle: minima are formed where the edges are read and
merged, and those of such hubs, whose number is bounded, go to the edges instead of the edges to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerloom.staging import Staging

# Keys that are sent to the rows are those with more than a HUBS-th of all rows, so there are fewer.
HUBS = 50_000
# Fewer rows of a key are no burden to a task.
HUB_ROWS = 200


def with_summary(
    rows: DataFrame, key: str, summary: Column, name: str, total: int, hub_rows: int = HUB_ROWS
) -> DataFrame:
    """``rows`` with ``summary``, an aggregate over all rows of the same ``key``, as column ``name``.

    ``total`` is the number of rows. A key with more than ``total`` / HUBS rows is a hub: there can't be
    HUBS of them, and their summaries are broadcast. The other keys are met in a join. ``rows`` is read
    three times, so it should be a table; no key is null.
    """
    found = rows.groupBy(key).agg(summary.alias(name), F.count(F.lit(1)).alias("_n"))
    most = max(hub_rows, -(-total // HUBS))
    hubs = found.where(F.col("_n") > most).select(key, F.col(name).alias("_of_hub"))
    marked = rows.join(F.broadcast(hubs), key, "left")
    at_hubs = marked.where(F.col("_of_hub").isNotNull()).withColumnRenamed("_of_hub", name)
    others = marked.where(F.col("_of_hub").isNull()).drop("_of_hub")
    return at_hubs.unionByName(others.join(found.where(F.col("_n") <= most).drop("_n"), key))


def _least_neighbour(edges: DataFrame, total: int) -> DataFrame:
    """Edges (u, v) with the least of u and all its neighbours."""
    starred = with_summary(edges, "u", F.min("v"), "least", total)
    return starred.withColumn("least", F.least("u", "least"))


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    starred = _least_neighbour(both, 2 * total).where("v > u")
    return starred.select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    # Edges point from the larger to the smaller end.
    starred = _least_neighbour(edges, total)
    links = starred.select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = starred.select("u", F.col("least").alias("v"))
    return links.unionByName(own).where("u > v").distinct()


def components(edges: DataFrame, staging: Staging) -> DataFrame:
    """``u`` and the smallest node ``v`` of its component, for every node but the smallest itself.

    ``edges`` has two columns of one orderable type, ``u`` and ``v``, in any direction; loops, repeats
    and edges to null are harmless. An empty table gives an empty result.
    """
    signature = (
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0)).alias("sum"),
    )
    current, before = staging.measured(
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
        *signature,
    )
    while before["rows"]:
        # Both ends of the step are tables, so nothing is computed twice.
        large, count = staging.counted(_large_star(current, before["rows"]), "large")
        current, after = staging.measured(_small_star(large, count), "small", *signature)
        if after == before:
            break
        before = after
    return current
