"""Approximate nearest neighbours by NN-descent and greedy graph search.

Equal vectors are one node. A graph of each node's nearest known nodes starts from blocks of nodes that
lie together under random projections, and is improved round by round: the neighbours of a node, and some
of those that have it as neighbour, are introduced to one another, and every node keeps the nearest it
has met (Dong, Moses and Li, 2011). Only pairs that have not met before are compared. A query starts at its own
node and follows the graph, always from its nearest nodes not yet visited, until they are all visited.

The graph lies in blocks of a fixed number of nodes that lie together, and a neighbour is listed with its
block, so whatever nodes have for one another goes from block to block in packed rows. A vector goes once to
every block that needs it.

A node may be near to very many others, so a block may hear from any number of blocks and queries. What is
said to it is therefore chosen from in a tree, each step taking some of it, and those who ask it are dealt
into slices that each get the vectors of the block. So a group holds the nodes of one block and, on
average, at most a fixed size of what others send, whatever the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tellerloom.llm.common import thinned
from tellerloom.llm.components import with_summary
from tellerloom.staging import Staging

# Neighbours a node keeps, and how many nodes that have it as neighbour it meets in a round.
DEGREE = 48
REVERSE = 48
# Random orders of the nodes to begin with, the nodes of a block, and the neighbours taken from it.
ORDERS = 6
BLOCK = 2048
FIRST = 24
# Rounds end when less than this share of the neighbours is new.
SETTLED = 0.02
ROUNDS = 12
# Nodes a search keeps and follows.
BEAM = 64
SAMPLE = 2048
# What meets in one group of a block: bytes of messages that are chosen from, and nodes that are asked for.
MESSAGE_BYTES = 1 << 26
ASKED = 1 << 18

#: Another node, its block, the squared distance, and whether it was no neighbour in the round before.
NEAR = np.dtype([("id", "<i8"), ("home", "<i8"), ("d", "<f8"), ("new", "u1")])
#: A node, with its block, that meets others at the owner.
MEMBER = np.dtype([("owner", "<i8"), ("id", "<i8"), ("home", "<i8"), ("new", "u1")])
#: What an owner has learned.
LEARNED = np.dtype([("owner", "<i8"), *NEAR.descr])
FOUND = np.dtype([("id", "<i8"), ("d", "<f8"), ("seen", "u1")])


def unpacked(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The entries of all rows one after the other, and the number of the row of each."""
    values = [value or b"" for value in column.to_pylist()]
    lengths = np.array([len(value) for value in values], np.int64) // kind.itemsize
    return np.frombuffer(b"".join(values), kind), np.repeat(np.arange(len(values)), lengths)


def packed(owners: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Each owner, and its entries as bytes; ``owners`` must be grouped."""
    starts = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]]) if len(owners) else []
    ends = [*starts[1:], len(owners)]
    return owners[starts], [entries[s:e].tobytes() for s, e in zip(starts, ends, strict=False)]


def places(owners: np.ndarray) -> np.ndarray:
    """The place of each row among those of its owner; ``owners`` must be grouped."""
    if not len(owners):
        return np.zeros(0, np.int64)
    starts = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]])
    return np.arange(len(owners)) - np.repeat(starts, np.diff(np.r_[starts, len(owners)]))


def nearest(
    owners: np.ndarray, entries: np.ndarray, limit: int, mark: str
) -> tuple[np.ndarray, np.ndarray]:
    """The nearest different entries of each owner, ties to the smaller id.

    Of entries with one id stays the one that is not new, or that has been seen.
    """
    first = entries[mark] if mark == "new" else 1 - entries[mark]
    order = np.lexsort((first, entries["id"], owners))
    owners, entries = owners[order], entries[order]
    again = (owners[1:] == owners[:-1]) & (entries["id"][1:] == entries["id"][:-1])
    kept = np.r_[True, ~again][: len(owners)]
    owners, entries = owners[kept], entries[kept]
    order = np.lexsort((entries["id"], entries["d"], owners))
    owners, entries = owners[order], entries[order]
    kept = places(owners) < limit
    return owners[kept], entries[kept]


def by_block(blocks: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The different blocks, and the entries of each."""
    order = np.argsort(blocks, kind="stable")
    different, starts = np.unique(blocks[order], return_index=True)
    return different, np.split(entries[order], starts[1:])[: len(different)]


def matrix(column: pa.Array, kind: str) -> np.ndarray:
    values = column.to_pylist()
    joined = np.frombuffer(b"".join(values), kind).astype(np.float64)
    return joined.reshape(len(values), -1) if values else joined.reshape(0, 0)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    found = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.maximum(found, 0.0)


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null or empty, all components finite, not all zero."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(
        (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False)
    )


def classes(rows: DataFrame, id_col: str, vector_col: str, wanted: int) -> DataFrame:
    """``vector``, ``vec_id`` and ``node``, the smallest id with that vector; the first ids of each vector.

    Vectors that are not ``usable``, or have another length than most (the shorter, if as many), take no
    part, nor do rows without an id. A row that repeats counts once.
    """
    valid = rows.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector")
    ).where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    lengths = valid.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), "size").first()
    valid = valid.where(F.size("vector") == (most["size"] if most else 0)).distinct()
    order = Window.partitionBy("vector").orderBy("vec_id")
    # The rank is bounded before the shuffle too, so a common vector is a few rows.
    ranked = valid.withColumn("place", F.row_number().over(order)).where(F.col("place") <= wanted)
    return ranked.withColumn("node", F.first("vec_id").over(order)).drop("place")


def _ordered(nodes: DataFrame, tours: range, kind: str, staging: Staging) -> DataFrame:
    """Every row of ``nodes`` once for each of the random orders ``tours``, with its ``place`` there.

    In an order nodes stand by the signs of some projections against their medians, then by one more
    projection; a place is a block of neighbouring ranks. Ranks come from the sizes of the sorted
    partitions, of which there are few.
    """
    spark = nodes.sparkSession
    count = nodes.count()
    bits = max(0, int(np.ceil(np.log2(max(1, count) / BLOCK))))
    sample = nodes.where(thinned(F.xxhash64("node"), SAMPLE, count)).limit(4 * SAMPLE)
    known = matrix(sample.select("vec").toArrow()["vec"].combine_chunks(), kind)
    directions = [
        np.random.default_rng(17 + i).normal(size=(known.shape[1], bits + 1)) for i in tours
    ]
    medians = [np.median(known @ d, axis=0) if len(known) else np.zeros(bits + 1) for d in directions]
    shared = spark.sparkContext.broadcast((directions, medians))
    carried = [name for name in nodes.columns if name not in ("node", "vec")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions, medians = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = matrix(batch.column("vec"), kind)
            for tour, direction, median in zip(tours, directions, medians, strict=True):
                projected = vectors @ direction
                signs = projected[:, :bits] > median[:bits]
                code = (signs * (1 << np.arange(bits))).sum(axis=1).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(code), tour), pa.int32()),
                        pa.array(code),
                        pa.array(projected[:, bits]),
                        *[batch.column(name) for name in ("node", "vec", *carried)],
                    ],
                    ["tour", "code", "along", "node", "vec", *carried],
                )

    schema = "tour int, code long, along double, node long, vec binary"
    placed = nodes.select("node", "vec", *carried).mapInArrow(
        rows, schema + "".join(f", {name} long" for name in carried)
    )
    key = ["tour", "code", "along", "node"]
    sorted_rows = staging.table(
        placed.repartitionByRange(*key)
        .sortWithinPartitions(*key)
        .select("tour", "node", "vec", *carried, F.monotonically_increasing_id().alias("at")),
        "orders",
    )
    # The upper bits of an id name its partition, the lower 33 the row in it.
    part = F.shiftright("at", 33)
    sizes = sorted_rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    start, before = 0, []
    for row in sorted(sizes, key=lambda row: row["part"]):
        before.append((row["part"], start))
        start += row["n"]
    offsets = spark.createDataFrame(before, "part long, start long")
    ranked = sorted_rows.withColumn("part", part).join(F.broadcast(offsets), "part")
    rank = F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return ranked.select("tour", "node", "vec", *carried, F.floor(rank / BLOCK).alias("place"))


def _first_graph(nodes: DataFrame, kind: str, staging: Staging) -> tuple[DataFrame, dict]:
    """The nearest nodes of the same place in any order. A node's place in the first order is its block."""
    first = _ordered(nodes, range(1), kind, staging).withColumn("block", F.col("place"))
    blocks = staging.table(first, "blocks")
    others = _ordered(blocks.select("node", "vec", "block"), range(1, ORDERS), kind, staging)

    def within(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        node, home = table["node"].to_numpy(), table["block"].to_numpy()
        vectors = matrix(pa.concat_arrays(table["vec"].chunks), kind)
        count = min(FIRST, len(node) - 1)
        lists = []
        for at in range(0, len(node), 256):
            d = squared(vectors[at : at + 256], vectors)
            d[np.arange(len(d)), at + np.arange(len(d))] = np.inf
            entries = np.zeros((len(d), max(0, count)), NEAR)
            if count > 0:
                near = np.argpartition(d, count - 1, axis=1)[:, :count]
                entries["id"], entries["home"] = node[near], home[near]
                entries["d"], entries["new"] = np.take_along_axis(d, near, 1), 1
            lists += [e.tobytes() for e in entries]
        # One order gives the vector of a node.
        own = table["tour"][0].as_py() == 0
        return pa.table(
            {
                "node": table["node"],
                "block": table["block"],
                "vec": table["vec"] if own else pa.nulls(len(node), pa.binary()),
                "near": pa.array(lists, pa.binary()),
            }
        )

    lists = (
        blocks.unionByName(others)
        .groupBy("tour", "place")
        .applyInArrow(within, "node long, block long, vec binary, near binary")
    )
    # The row with the vector first.
    dealt = lists.repartition("node").sortWithinPartitions("node", F.col("vec").isNull())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.concat_batches([*kept, batch])
            node = table.column("node").to_numpy()
            # The last node may go on in the next batch.
            cut = int(np.searchsorted(node, node[-1], side="left"))
            kept = [table.slice(cut)]
            if cut:
                yield whole(table.slice(0, cut))
        for rest in kept:
            yield whole(rest)

    def whole(table: pa.RecordBatch) -> pa.RecordBatch:
        node = table.column("node").to_numpy()
        entries, row = unpacked(table.column("near"), NEAR)
        new_node = np.r_[True, node[1:] != node[:-1]]
        chosen = table.take(pa.array(np.flatnonzero(new_node)))
        return _graph_rows(chosen, (np.cumsum(new_node) - 1)[row], entries)

    graph = dealt.mapInArrow(merge, GRAPH)
    return staging.measured(graph, "graph", *_measures())


GRAPH = "node long, block long, vec binary, near binary, changed long"


def _graph_rows(nodes: pa.RecordBatch, owners: np.ndarray, entries: np.ndarray) -> pa.RecordBatch:
    """Rows of the graph from nodes and all entries of each, its owner the number of its row."""
    owners, entries = nearest(owners, entries, DEGREE, "new")
    lists: list[bytes] = [b""] * nodes.num_rows
    for owner, value in zip(*packed(owners, entries), strict=True):
        lists[owner] = value
    changed = np.bincount(owners, weights=entries["new"], minlength=nodes.num_rows)
    return pa.RecordBatch.from_arrays(
        [
            *[nodes.column(name) for name in ("node", "block", "vec")],
            pa.array(lists, pa.binary()),
            pa.array(changed.astype(np.int64)),
        ],
        ["node", "block", "vec", "near", "changed"],
    )


def _measures() -> tuple[Column, Column]:
    """Neighbours that are new, and all."""
    edges = F.sum((F.length("near") / NEAR.itemsize).cast("long"))
    return (
        F.coalesce(F.sum("changed"), F.lit(0)).alias("changed"),
        F.coalesce(edges, F.lit(0)).alias("edges"),
    )


def _whole(table: pa.Table) -> pa.RecordBatch:
    """A table as one batch."""
    return table.combine_chunks().to_batches()[0] if table.num_rows else pa.RecordBatch.from_pylist(
        [], table.schema
    )


def _with_tickets(
    rows: DataFrame, load: Column, staging: Staging
) -> tuple[DataFrame, int, int]:
    """``rows`` as a table with their ``load`` and a ``ticket`` each; their number, the most for a block."""
    ticket = F.monotonically_increasing_id().alias("ticket")
    rows, total = staging.counted(rows.select("*", load.alias("load"), ticket), "rows")
    most = rows.groupBy("block").agg(F.sum("load").alias("load")).agg(F.max("load")).first()[0]
    return rows, total, most or 0


def _dealt(rows: DataFrame, total: int, limit: int) -> DataFrame:
    """``rows`` of crowded blocks in so many slices that each has at most the limit, on average."""
    loaded = with_summary(rows, "block", F.sum("load"), "held", total)
    slices = F.ceil(F.col("held") / F.lit(limit)).cast("int")
    slice_of = F.pmod(F.xxhash64("ticket"), slices).cast("int")
    return loaded.withColumns({"slice": slice_of, "slices": slices}).drop("held", "load", "ticket")


def _gathered(rows: DataFrame, kind: np.dtype, choose, staging: Staging) -> DataFrame:
    """The messages to each ``block``, entries of ``kind`` in one packed column, as few enough bytes.

    ``choose`` says which of some entries stay; choosing from what was chosen gives what choosing from all
    gives. Blocks with more than MESSAGE_BYTES choose within slices of them, again and again until what is
    left is no more than that, or in one row.
    """
    column = next(name for name in rows.columns if name != "block")

    def chosen(key: tuple, table: pa.Table) -> pa.Table:
        entries, _ = unpacked(_whole(table).column(column), kind)
        kept = choose(entries).tobytes()
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), column: [kept]})

    before = None
    while True:
        rows, total, most = _with_tickets(rows, F.length(column).cast("long"), staging)
        if most <= MESSAGE_BYTES or total == before:
            return rows.select("block", column)
        before = total
        # Twice as many slices as needed, so that those of unequal size are small enough.
        dealt = _dealt(rows, total, max(1, MESSAGE_BYTES // 2))
        few = dealt.where("slices <= 2").select("block", column)
        rows = few.unionByName(
            dealt.where("slices > 2")
            .select("block", "slice", column)
            .groupBy("block", "slice")
            .applyInArrow(chosen, f"block long, {column} binary")
        )


def _sliced(
    asking: DataFrame, vectors: DataFrame, staging: Staging
) -> tuple[DataFrame, DataFrame]:
    """Both with a ``slice``: the rows that ask a block dealt to some, and the block's vectors in each.

    What a row asks for are the packed ids in ``nodes``.
    """
    asking, total, most = _with_tickets(asking, (F.length("nodes") / 8).cast("long"), staging)
    if most <= ASKED:
        only = F.lit(0).alias("slice")
        return asking.drop("load", "ticket").select("*", only), vectors.select("*", only)
    dealt = _dealt(asking, total, ASKED)
    crowded = (
        dealt.where("slices > 1").groupBy("block").agg(F.max("slices").alias("slices"))
    )
    last = F.coalesce("slices", F.lit(1)) - 1
    copied = (
        vectors.join(crowded, "block", "left")
        .withColumn("slice", F.explode(F.sequence(F.lit(0), last)))
        .drop("slices")
    )
    return dealt.drop("slices"), copied


def _meetings(graph: DataFrame, number: int, staging: Staging) -> DataFrame:
    """For each ``block`` the packed ``members`` that meet at its nodes.

    At a node meet its neighbours and a hashed choice of ``REVERSE`` nodes that have it as neighbour,
    new ones first; so many are chosen within each batch already, and of the batches in ``_gathered``.
    """
    salt = np.uint64(0x9E3779B97F4A7C15 * (2 * number + 1) % (1 << 64))

    def chosen(members: np.ndarray) -> np.ndarray:
        ids, owners = members["id"].astype(np.uint64), members["owner"].astype(np.uint64)
        with np.errstate(over="ignore"):
            mixed = (owners ^ ids << np.uint64(21)) * salt >> np.uint64(7)
        order = np.lexsort((members["id"], mixed, 1 - members["new"], members["owner"]))
        members = members[order]
        return members[places(members["owner"]) < REVERSE]

    def backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries, row = unpacked(batch.column("near"), NEAR)
            members = np.zeros(len(entries), MEMBER)
            members["owner"], members["new"] = entries["id"], entries["new"]
            members["id"] = batch.column("node").to_numpy()[row]
            members["home"] = batch.column("block").to_numpy()[row]
            blocks, parts = by_block(entries["home"], members)
            lists = [chosen(part).tobytes() for part in parts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int64()), pa.array(lists, pa.binary())], ["block", "members"]
            )

    def meet(nodes: pa.Table, others: pa.Table) -> pa.Table:
        nodes = _whole(nodes)
        entries, row = unpacked(nodes.column("near"), NEAR)
        own = np.zeros(len(entries), MEMBER)
        own["owner"] = nodes.column("node").to_numpy()[row]
        for name in ("id", "home", "new"):
            own[name] = entries[name]
        back, _ = unpacked(_whole(others).column("members"), MEMBER)
        members = np.concatenate([own, chosen(back)])
        # A member that is both counts as new only if it is so in both.
        order = np.lexsort((members["new"], members["id"], members["owner"]))
        members = members[order]
        again = (members["owner"][1:] == members["owner"][:-1]) & (
            members["id"][1:] == members["id"][:-1]
        )
        members = members[np.r_[True, ~again][: len(members)]]
        block = nodes.column("block")[:1]
        return pa.table({"block": block, "members": pa.array([members.tobytes()] * len(block))})

    sent = graph.select("node", "block", "near").mapInArrow(backward, "block long, members binary")
    sent = _gathered(sent, MEMBER, chosen, staging)
    return (
        graph.select("block", "node", "near")
        .groupBy("block")
        .cogroup(sent.groupBy("block"))
        .applyInArrow(meet, "block long, members binary")
    )


def _introduced(graph: DataFrame, meetings: DataFrame, kind: str, staging: Staging) -> DataFrame:
    """What the nodes of each ``block`` learn at the meetings of another, packed as ``learned``.

    A block sends the vectors of its nodes once to every block where they are members, with the distance
    beyond which a node has no use for others. Of what is learned in many blocks a node keeps the nearest.
    """

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, value in zip(
                batch.column("block").to_pylist(), batch.column("members").to_pylist(), strict=True
            ):
                members = np.frombuffer(value, MEMBER)
                ids, first = np.unique(members["id"], return_index=True)
                homes, parts = by_block(members["home"][first], ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(homes, pa.int64()),
                        pa.array(np.full(len(homes), block), pa.int64()),
                        pa.array([part.astype("<i8").tobytes() for part in parts], pa.binary()),
                    ],
                    ["block", "at", "nodes"],
                )

    def with_limit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            limits = []
            for value in batch.column("near").to_pylist():
                entries = np.frombuffer(value, NEAR)
                limits.append(entries["d"][-1] if len(entries) >= DEGREE else np.inf)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(name) for name in ("node", "block", "vec")],
                    pa.array(limits, pa.float64()),
                ],
                ["node", "block", "vec", "limit"],
            )

    def send(nodes: pa.Table, wants: pa.Table) -> pa.Table:
        nodes = _whole(nodes)
        node = nodes.column("node").to_numpy()
        order = np.argsort(node)
        node, limit = node[order], nodes.column("limit").to_numpy()[order]
        vectors = np.array(nodes.column("vec").to_pylist(), object)[order]
        limits, vecs = [], []
        for value in wants["nodes"].to_pylist():
            at = np.searchsorted(node, np.frombuffer(value, "<i8"))
            limits.append(limit[at].astype("<f8").tobytes())
            vecs.append(b"".join(vectors[at]))
        return pa.table(
            {
                "block": wants["at"],
                "home": wants["block"],
                "nodes": wants["nodes"],
                "limits": pa.array(limits, pa.binary()),
                "vecs": pa.array(vecs, pa.binary()),
            }
        )

    needs = meetings.mapInArrow(wanted, "block long, at long, nodes binary")
    vectors = graph.select("node", "block", "vec", "near").mapInArrow(
        with_limit, "node long, block long, vec binary, limit double"
    )
    needs, vectors = _sliced(needs, vectors, staging)
    sent = (
        vectors.groupBy("block", "slice")
        .cogroup(needs.groupBy("block", "slice"))
        .applyInArrow(send, "block long, home long, nodes binary, limits binary, vecs binary")
    )

    def meet(lists: pa.Table, known: pa.Table) -> pa.Table:
        known = _whole(known)
        node, row = unpacked(known.column("nodes"), np.dtype("<i8"))
        order = np.argsort(node)
        node, home = node[order], known.column("home").to_numpy()[row][order]
        limit = np.frombuffer(b"".join(known.column("limits").to_pylist()), "<f8")[order]
        joined = np.frombuffer(b"".join(known.column("vecs").to_pylist()), kind)
        vectors = joined.astype(np.float64).reshape(len(node), -1)[order]
        members, _ = unpacked(_whole(lists).column("members"), MEMBER)
        starts = np.flatnonzero(np.r_[True, members["owner"][1:] != members["owner"][:-1]])
        starts = starts[: len(members)]
        at_all = np.searchsorted(node, members["id"])
        new_all = members["new"].astype(bool)
        met: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        owners, entries, held = np.zeros(0, np.int64), np.zeros(0, NEAR), 0

        def shrunk() -> tuple[np.ndarray, np.ndarray]:
            a, b, d = (np.concatenate([m[i] for m in met]) for i in range(3))
            found = np.zeros(len(a), NEAR)
            found["id"], found["home"], found["d"], found["new"] = node[b], home[b], d, 1
            return nearest(
                np.concatenate([owners, a]), np.concatenate([entries, found]), DEGREE, "new"
            )

        for start, end in zip(starts, [*starts[1:], len(members)], strict=False):
            at, new = at_all[start:end], new_all[start:end]
            if not new.any():
                continue
            # New ones meet all, the others have met one another before.
            d = squared(vectors[at[new]], vectors[at])
            for a, b, found in ((at[new], at, d), (at[~new], at[new], d[:, ~new].T)):
                useful = found < limit[a][:, None]
                useful &= a[:, None] != b[None, :]
                i, j = np.nonzero(useful)
                met.append((a[i], b[j], found[i, j]))
                held += len(i)
            if held > 1 << 20:
                owners, entries = shrunk()
                met, held = [], 0
        if met:
            owners, entries = shrunk()
        learned = np.zeros(len(owners), LEARNED)
        learned["owner"] = node[owners]
        for name in NEAR.names:
            learned[name] = entries[name]
        blocks, parts = by_block(home[owners], learned)
        return pa.table(
            {
                "block": pa.array(blocks, pa.int64()),
                "learned": pa.array([part.tobytes() for part in parts], pa.binary()),
            }
        )

    def nearest_learned(entries: np.ndarray) -> np.ndarray:
        near = np.zeros(len(entries), NEAR)
        for name in NEAR.names:
            near[name] = entries[name]
        owners, near = nearest(entries["owner"], near, DEGREE, "new")
        kept = np.zeros(len(owners), LEARNED)
        kept["owner"] = owners
        for name in NEAR.names:
            kept[name] = near[name]
        return kept

    learned = (
        meetings.groupBy("block")
        .cogroup(sent.groupBy("block"))
        .applyInArrow(meet, "block long, learned binary")
    )
    return _gathered(learned, LEARNED, nearest_learned, staging)


def _improved(graph: DataFrame, learned: DataFrame) -> DataFrame:
    """The graph after a round; ``changed`` counts the neighbours that are new."""

    def merge(nodes: pa.Table, news: pa.Table) -> pa.Table:
        nodes = _whole(nodes)
        order = np.argsort(nodes.column("node").to_numpy())
        nodes = nodes.take(pa.array(order))
        old, row = unpacked(nodes.column("near"), NEAR)
        old = old.copy()
        old["new"] = 0
        news_of, _ = unpacked(_whole(news).column("learned"), LEARNED)
        found = np.zeros(len(news_of), NEAR)
        for name in NEAR.names:
            found[name] = news_of[name]
        owners = np.searchsorted(nodes.column("node").to_numpy(), news_of["owner"])
        rows = _graph_rows(nodes, np.concatenate([row, owners]), np.concatenate([old, found]))
        return pa.Table.from_batches([rows])

    return (
        graph.select("node", "block", "vec", "near")
        .groupBy("block")
        .cogroup(learned.groupBy("block"))
        .applyInArrow(merge, GRAPH)
    )


def build(nodes: DataFrame, kind: str, staging: Staging) -> DataFrame:
    """The neighbour graph: ``node``, ``block``, ``vec`` and the packed list ``near``, nearest first.

    ``nodes`` has different ``node`` ids with different vectors ``vec`` (bytes of numbers of ``kind``, all
    of one length) and must be a table.
    """
    graph, state = _first_graph(nodes, kind, staging)
    for number in range(ROUNDS):
        if state["changed"] <= SETTLED * state["edges"]:
            break
        with Staging(graph.sparkSession) as scratch:
            meetings = scratch.table(_meetings(graph, number, scratch), "meetings")
            learned = _introduced(graph, meetings, kind, scratch)
            graph, state = staging.measured(_improved(graph, learned), "graph", *_measures())
    return graph


def search(graph: DataFrame, starts: DataFrame, kind: str, staging: Staging) -> DataFrame:
    """``node`` (a query's) and ``found``: the packed nearest nodes met on the way, its own left out.

    ``starts`` has the different nodes that are searched for, all of them in the graph.
    """
    vectors = graph.select("block", "node", "vec")

    @F.arrow_udf("binary")
    def begun(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in lists:
            out = []
            for value in column.to_pylist():
                near = np.frombuffer(value, NEAR)[:BEAM]
                entries = np.zeros(len(near), FOUND)
                entries["id"], entries["d"] = near["id"], near["d"]
                out.append(entries.tobytes())
            yield pa.array(out, pa.binary())

    def frontier(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries, row = unpacked(batch.column("found"), FOUND)
            fresh = entries["seen"] == 0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(entries["id"][fresh].astype(np.int64)),
                    *[batch.column(c).take(pa.array(row[fresh])) for c in ("query", "vec")],
                ],
                ["node", "query", "vec"],
            )

    def to_visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Neighbours of followed nodes, each once for a query within the batch, by their block."""
        for batch in batches:
            if not batch.num_rows:
                continue
            entries, row = unpacked(batch.column("near"), NEAR)
            query = batch.column("query").to_numpy()
            triples = np.stack([query[row], entries["home"], entries["id"]], axis=1)
            triples, first = np.unique(triples, axis=0, return_index=True)
            starts = np.flatnonzero(np.r_[True, (triples[1:, :2] != triples[:-1, :2]).any(axis=1)])
            starts = starts[: len(triples)]
            ends = [*starts[1:], len(triples)]
            ids = [
                triples[s:e, 2].astype("<i8").tobytes() for s, e in zip(starts, ends, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(triples[starts, 1].copy()),
                    pa.array(triples[starts, 0].copy()),
                    batch.column("vec").take(pa.array(row[first[starts]])),
                    pa.array(ids, pa.binary()),
                ],
                ["block", "query", "vec", "nodes"],
            )

    def measured(pairs: pa.Table, known: pa.Table) -> pa.Table:
        """Distances of the nodes of a block to the queries of a slice that came for them."""
        if not pairs.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "found": pa.array([], pa.binary())})
        known = _whole(known)
        node = known.column("node").to_numpy()
        order = np.argsort(node)
        node = node[order]
        own = matrix(known.column("vec"), kind)[order]
        lists = []
        for vector, wanted in zip(pairs["vec"].to_pylist(), pairs["nodes"].to_pylist(), strict=True):
            ids = np.frombuffer(wanted, "<i8")
            difference = own[np.searchsorted(node, ids)] - np.frombuffer(vector, kind)
            entries = np.zeros(len(ids), FOUND)
            entries["id"], entries["d"] = ids, (difference * difference).sum(axis=1)
            order = np.lexsort((ids, entries["d"]))[:BEAM]
            lists.append(entries[order].tobytes())
        return pa.table({"query": pairs["query"], "found": pa.array(lists, pa.binary())})

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column("found").to_pylist():
                entries = np.frombuffer(value, FOUND).copy()
                entries["seen"] = 1
                out.append(entries.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("query"), batch.column("vec"), pa.array(out, pa.binary())],
                ["query", "vec", "found"],
            )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.concat_batches([*kept, batch])
            query = table.column("query").to_numpy()
            cut = int(np.searchsorted(query, query[-1], side="left"))
            kept = [table.slice(cut)]
            if cut:
                yield best(table.slice(0, cut))
        for rest in kept:
            yield best(rest)

    def best(table: pa.RecordBatch) -> pa.RecordBatch:
        query = table.column("query").to_numpy()
        new_query = np.r_[True, query[1:] != query[:-1]]
        first, number = np.flatnonzero(new_query), np.cumsum(new_query) - 1
        entries, row = unpacked(table.column("found"), FOUND)
        owners = number[row]
        others = entries["id"] != query[first][owners]
        owners, entries = nearest(owners[others], entries[others], BEAM, "seen")
        lists: list[bytes] = [b""] * len(first)
        for owner, value in zip(*packed(owners, entries), strict=True):
            lists[owner] = value
        fresh = np.bincount(owners, weights=1 - entries["seen"], minlength=len(first))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(query[first]),
                table.column("vec").take(pa.array(first)),
                pa.array(lists, pa.binary()),
                pa.array(fresh.astype(np.int64)),
            ],
            ["query", "vec", "found", "fresh"],
        )

    open_ends = F.coalesce(F.sum("fresh"), F.lit(0)).alias("fresh")
    begin = starts.join(graph, "node").select(
        F.col("node").alias("query"), "vec", begun("near").alias("found")
    )
    state, measure = staging.measured(
        begin.withColumn("fresh", F.length("found")), "search", open_ends
    )
    while measure["fresh"]:
        with Staging(graph.sparkSession) as scratch:
            followed = state.select("query", "vec", "found").mapInArrow(
                frontier, "node long, query long, vec binary"
            )
            pairs = (
                followed.join(graph.select("node", "near"), "node")
                .select("query", "vec", "near")
                .mapInArrow(to_visit, "block long, query long, vec binary, nodes binary")
            )
            pairs, known = _sliced(pairs, vectors, scratch)
            met = (
                pairs.groupBy("block", "slice")
                .cogroup(known.groupBy("block", "slice"))
                .applyInArrow(measured, "query long, found binary")
            )
            before = state.select("query", "vec", "found").mapInArrow(
                seen, "query long, vec binary, found binary"
            )
            dealt = (
                before.unionByName(met, allowMissingColumns=True)
                .repartition("query")
                .sortWithinPartitions("query", F.col("vec").isNull())
            )
            state, measure = staging.measured(
                dealt.mapInArrow(merge, "query long, vec binary, found binary, fresh long"),
                "search",
                open_ends,
            )

    def entries_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries, row = unpacked(batch.column("found"), FOUND)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("query").take(pa.array(row)),
                    pa.array(entries["id"].astype(np.int64)),
                ],
                ["query", "node"],
            )

    return state.select("query", "found").mapInArrow(entries_of, "query long, node long")


def _distance(a: Column, b: Column) -> Column:
    """Euclidean, in double precision."""
    parts = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    total = F.aggregate(parts, F.lit(0.0), lambda total, x: total + x * x)
    return F.sqrt(total)


def neighbours(
    rows: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    staging: Staging | None = None,
) -> DataFrame:
    """The ``k`` nearest found to each row of ``rows`` for which ``is_query`` holds, among all others.

    Columns: ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``, the Euclidean distance of the
    original vectors in double precision. Nearest first, ties to the smaller id; all others, if there
    are fewer than ``k``. Vectors null, empty, zero or with null or non-finite components take no part,
    nor do rows without an id and vectors of another length than most. An id that repeats with the same
    vector counts once. An empty table gives an empty result. ``is_query`` may use all columns.
    """
    if k >= BEAM:
        raise ValueError(f"a search keeps {BEAM} nodes; ask for fewer than that")
    staging = staging or Staging(rows.sparkSession)
    kind = "<f4" if dict(rows.dtypes)[vector_col] == "array<float>" else "<f8"
    # One more, as the query's own row does not count.
    members = staging.table(classes(rows, id_col, vector_col, k + 1), "members")

    def as_bytes(vector: Column) -> Column:
        @F.arrow_udf("binary")
        def converted(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for column in columns:
                offsets = column.offsets.to_numpy()
                values = column.values.to_numpy(zero_copy_only=False).astype(kind)
                out = [
                    values[s:e].tobytes() for s, e in zip(offsets, offsets[1:], strict=False)
                ]
                yield pa.array(out, pa.binary())

        return converted(vector)

    heads = members.where(F.col("vec_id") == F.col("node"))
    nodes = staging.table(heads.select("node", as_bytes(F.col("vector")).alias("vec")), "nodes")
    graph = build(nodes, kind, staging)
    asked = rows.where(is_query).select(
        F.col(id_col).cast("long").alias("query_id"), F.col(vector_col).alias("vector")
    )
    # Queries with one vector are searched once; a row that takes no part finds no vector here.
    queries = staging.table(
        asked.distinct().join(heads.select("vector", "node"), "vector").select("query_id", "node"),
        "queries",
    )
    starts = queries.select("node").distinct()
    found = search(graph, starts, kind, staging)
    vectors = heads.select("node", "vector")
    exact = (
        found.join(vectors, "node")
        .withColumnRenamed("vector", "other")
        .join(vectors.withColumnRenamed("node", "query"), "query")
        .select("query", "node", _distance(F.col("vector"), F.col("other")).alias("score"))
        .unionByName(starts.select(F.col("node").alias("query"), "node", F.lit(0.0).alias("score")))
    )
    # Of a query's vector at most k + 1 ids can count.
    by_score = Window.partitionBy("query").orderBy("score", "vec_id")
    chosen = (
        exact.join(members.select("node", "vec_id"), "node")
        .withColumn("place", F.row_number().over(by_score))
        .where(F.col("place") <= k + 1)
        .select(F.col("query").alias("node"), "vec_id", "score")
    )
    by_query = Window.partitionBy("query_id", "node").orderBy("score", "vec_id")
    return (
        queries.join(chosen, "node")
        .where(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(by_query))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
