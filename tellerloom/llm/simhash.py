"""SimHash near-duplicates, linked exactly within a bit distance through anchors of a covering code.

The 64 bits of a fingerprint fall into blocks. Two fingerprints that differ in at most four bits differ in
few bits of some block: in at most one of the three blocks of 21, 21 and 22 bits, in at most two of the two
blocks of 32 bits. Each block has a covering code of radius 1: a perfect Hamming code on its first 15 (or
31) bits, all words on the others. So every block value has an anchor within distance 1, its home, and
whatever differs from that value in t bits lies within distance 1 + t of the same anchor. A fingerprint
therefore goes to every anchor within that distance of each block, and at each anchor those at home are
compared with all that came, by their whole 64 bits. No link is lost under either code.

The codes differ in cost alone. With three blocks a fingerprint has about 44 copies at 2**19 anchors, with
two about 343 at 2**28. An anchor with more rows than a cell takes is dealt into cells, every pair of
slices meeting in one, which multiplies the copies by the slices; so three blocks cost less up to some
hundred million different fingerprints, and with two the copies stay the same up to some ten thousand
million. ``code_for`` takes the cheaper for a counted number.

Equal fingerprints are one class before any of this, and a cell gives the edges of a spanning forest and
not all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerloom.llm.common import byte_strings, keyed_texts
from tellerloom.llm.components import components, with_summary
from tellerloom.staging import Staging

SEED = 42
MAX_BITS = 4
# Shingles whose hashes are counted at once.
CHUNK = 1 << 16
# Pairs of a cell that are compared at once.
PAIRS = 1 << 20
# Crowded anchors up to this number are known to every task; with more, their copies meet them in a join.
KNOWN_ANCHORS = 1 << 19


@dataclass(frozen=True)
class Code:
    """A covering code for each block of a fingerprint.

    ``blocks`` are (lowest bit, bits). The code of a block is the Hamming code on ``hamming_bits`` bits
    times all words on the others; its radius is 1. ``reach`` is that plus the bits in which linked
    fingerprints differ at most in their closest block. ``cell_rows`` rows of an anchor meet in one task.
    """

    blocks: tuple[tuple[int, int], ...]
    hamming_bits: int
    reach: int
    cell_rows: int

    @property
    def anchors(self) -> int:
        return sum(1 << bits for _, bits in self.blocks) // (self.hamming_bits + 1)

    @property
    def copies(self) -> float:
        """How many anchors a fingerprint goes to, on average."""
        return sum(
            sum(1 for size in range(self.reach + 1) for _ in combinations(range(bits), size))
            for _, bits in self.blocks
        ) / (self.hamming_bits + 1)

    def cost(self, prints: int) -> float:
        """Copies of a fingerprint where so many are spread evenly."""
        rows = prints * self.copies / self.anchors
        return self.copies * max(1.0, rows / self.cell_rows)


THREE_BLOCKS = Code(((0, 21), (21, 21), (42, 22)), 15, 2, 1 << 12)
TWO_BLOCKS = Code(((0, 32), (32, 32)), 31, 3, 1 << 15)


def code_for(prints: int) -> Code:
    """The code with fewer copies for so many different fingerprints; both give the same links."""
    return min((THREE_BLOCKS, TWO_BLOCKS), key=lambda code: code.cost(prints))


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """XXH64 of each run of ``width`` words joined by spaces; of the whole if there are fewer."""
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: 1 - width].tolist(), ends[width - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[s:e], SEED) for s, e in spans), np.uint64)


def fingerprint(text: bytes, width: int) -> int:
    """Bit i is 1 if more than half of the shingle hashes have it; zero for a text without words."""
    hashes = shingle_hashes(text.lower().split(), width)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4
) -> DataFrame:
    """``doc_id`` and the SimHash of the text as a signed long, one row for each of ``docs``.

    Only A-Z are lower-cased; words end at ASCII white space. A null text has no words, like an empty
    one.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(text, width) for text in byte_strings(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(values, pa.int64())], ["doc_id", "fingerprint"]
            )

    return keyed_texts(docs, id_col, text_col).mapInArrow(rows, "doc_id long, fingerprint long")


def _ball_masks(bits: int, hamming_bits: int, reach: int) -> list[np.ndarray]:
    """By syndrome, what to add to a block value to get each codeword within ``reach``, nearest first."""
    masks: list[list[int]] = [[] for _ in range(hamming_bits + 1)]
    for size in range(reach + 1):
        for chosen in combinations(range(bits), size):
            syndrome = 0
            for bit in chosen:
                # Position i of the Hamming part has the parity column i + 1.
                syndrome ^= bit + 1 if bit < hamming_bits else 0
            masks[syndrome].append(sum(1 << bit for bit in chosen))
    return [np.array(m, np.int64) for m in masks]


def _syndromes(values: np.ndarray, hamming_bits: int) -> np.ndarray:
    found = np.zeros(len(values), np.int64)
    for i in range(hamming_bits):
        found ^= np.where(values >> i & 1, i + 1, 0)
    return found


class Anchors:
    """The anchors that fingerprints go to under a code."""

    def __init__(self, code: Code) -> None:
        self.code = code
        self.masks = {
            bits: _ball_masks(bits, code.hamming_bits, code.reach) for _, bits in code.blocks
        }

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row of ``prints``, anchor, and whether it is the home, for all anchors within reach."""
        rows, anchors, homes = [], [], []
        for number, (shift, bits) in enumerate(self.code.blocks):
            values = (prints.view(np.uint64) >> np.uint64(shift)).astype(np.int64) & (1 << bits) - 1
            syndromes = _syndromes(values, self.code.hamming_bits)
            for syndrome, masks in enumerate(self.masks[bits]):
                at = np.flatnonzero(syndromes == syndrome)
                reached = values[at][:, None] ^ masks[None, :]
                home = np.zeros(reached.shape, bool)
                home[:, 0] = True
                rows.append(np.repeat(at, len(masks)))
                anchors.append(reached.ravel() | number << 32)
                homes.append(home.ravel())
        return np.concatenate(rows), np.concatenate(anchors), np.concatenate(homes)


def _crowded(classes: DataFrame, code: Code, staging: Staging) -> tuple[DataFrame, int]:
    """``anchor`` and number of ``slices`` of each anchor with more rows than a cell, and their number."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = Anchors(code).near
        for batch in _small(batches, code):
            _, anchors, _ = near(batch)
            found, counts = np.unique(anchors, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts)], ["anchor", "n"])

    counted = classes.select("fingerprint").mapInArrow(rows, "anchor long, n long")
    slices = F.ceil(F.sum("n") / F.lit(code.cell_rows)).alias("slices")
    return staging.counted(
        counted.groupBy("anchor").agg(slices).where(F.col("slices") > 1), "crowded"
    )


def _small(batches: Iterator[pa.RecordBatch], code: Code) -> Iterator[np.ndarray]:
    """The fingerprints of batches, so many at once that their copies are about a million rows."""
    size = max(1, int((1 << 20) / code.copies))
    for batch in batches:
        prints = batch.column("fingerprint").to_numpy()
        for at in range(0, len(prints), size):
            yield prints[at : at + size]


def _dealt(
    anchors: np.ndarray, home: np.ndarray, prints: np.ndarray, slices: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """The copies in their cells: every row meets the homes of all slices, every home all rows."""
    own = (prints.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
    own %= slices
    for side in (False, True):
        chosen = np.flatnonzero(home) if side else np.arange(len(anchors))
        many = slices[chosen]
        index = np.repeat(chosen, many)
        other = np.arange(len(index)) - np.repeat(np.cumsum(many) - many, many)
        n = slices[index]
        cell = own[index] * n + other if side else other * n + own[index]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(anchors[index]),
                pa.array(cell),
                pa.array(np.full(len(index), side)),
                pa.array(prints[index]),
            ],
            ["anchor", "cell", "home", "fingerprint"],
        )


def _cells(classes: DataFrame, code: Code, staging: Staging) -> DataFrame:
    """Fingerprints by anchor and cell; ``home`` tells the two sides of the comparison apart.

    An anchor of s slices has s slices of either side and s * s cells.
    """
    crowded, number = _crowded(classes, code, staging)
    prints = classes.select("fingerprint")
    schema = "anchor long, cell long, home boolean, fingerprint long"
    if number <= KNOWN_ANCHORS:
        slices = {row["anchor"]: row["slices"] for row in crowded.collect()}
        full = np.array(sorted(slices), np.int64)
        counts = np.array([slices[a] for a in sorted(slices)], np.int64)

        def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            near = Anchors(code).near
            for batch in _small(batches, code):
                row, anchors, home = near(batch)
                n = np.ones(len(anchors), np.int64)
                if len(full):
                    place = np.minimum(np.searchsorted(full, anchors), len(full) - 1)
                    n = np.where(full[place] == anchors, counts[place], 1)
                yield from _dealt(anchors, home, batch[row], n)

        return prints.mapInArrow(known, schema)

    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = Anchors(code).near
        for batch in _small(batches, code):
            row, anchors, home = near(batch)
            columns = [pa.array(x) for x in (anchors, home, batch[row])]
            yield pa.RecordBatch.from_arrays(columns, ["anchor", "home", "fingerprint"])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _dealt(
                *[
                    batch.column(name).to_numpy(zero_copy_only=False)
                    for name in ("anchor", "home", "fingerprint", "slices")
                ]
            )

    copied = prints.mapInArrow(copies, "anchor long, home boolean, fingerprint long")
    met = copied.join(crowded, "anchor", "left").fillna(1, ["slices"])
    return met.mapInArrow(dealt, schema)


def _joined(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Labels that are equal where they were before or where an edge joins them, the least of all."""
    u, v = label[u], label[v]
    while True:
        least = label.copy()
        np.minimum.at(least, u, label[v])
        np.minimum.at(least, v, label[u])
        least = np.minimum(least, least[least])
        least = least[label]
        if np.array_equal(least, label):
            return label
        label = least
        u, v = label[u], label[v]


def _forest(homes: np.ndarray, others: np.ndarray, max_bits: int) -> list[np.ndarray]:
    """Edges that connect what the links between the two sides connect, at most one per member."""
    left, right = homes.view(np.uint64), others.view(np.uint64)
    step = max(1, PAIRS // len(right)) if len(right) else len(left)
    nodes = label = None
    for at in range(0, len(left), step):
        part = left[at : at + step, None]
        a, b = np.nonzero(np.bitwise_count(part ^ right[None, :]) <= max_bits)
        apart = homes[a + at] != others[b]
        a, b = a[apart] + at, b[apart]
        if step >= len(left) and len(a) <= len(left) + len(right):
            return [np.stack([homes[a], others[b]])]
        if label is None:
            nodes, place = np.unique(np.concatenate([homes, others]), return_inverse=True)
            label = np.arange(len(nodes))
            at_homes, at_others = place[: len(homes)], place[len(homes) :]
        label = _joined(label, at_homes[a], at_others[b])
    if label is None:
        return []
    linked = np.flatnonzero(label != np.arange(len(label)))
    return [np.stack([nodes[linked], nodes[label[linked]]])]


def links(
    classes: DataFrame,
    max_bits: int = MAX_BITS,
    code: Code = THREE_BLOCKS,
    staging: Staging | None = None,
) -> DataFrame:
    """Edges ``u``, ``v`` between distinct fingerprints that connect all within ``max_bits`` bits.

    ``max_bits`` may be at most 4. The edges of a cell are a spanning forest of its links. ``code`` decides
    what it costs and nothing else.
    """
    if max_bits > MAX_BITS:
        raise ValueError(f"the codes find links of at most {MAX_BITS} bits")
    cells = _cells(classes, code, staging or Staging(classes.sparkSession))
    dealt = cells.repartition("anchor", "cell").sortWithinPartitions("anchor", "cell")

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        for batch in batches:
            new = np.stack(
                [
                    batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)
                    for name in ("anchor", "cell", "home", "fingerprint")
                ]
            )
            table = np.concatenate([*kept, new], axis=1)
            # The last cell may go on in the next batch.
            last = (table[:2] == table[:2, -1:]).all(axis=0)
            kept = [table[:, last]]
            if not last.all():
                yield from compared(table[:, ~last])
        if kept:
            yield from compared(kept[0])

    def compared(table: np.ndarray) -> Iterator[pa.RecordBatch]:
        new = (np.diff(table[:2], axis=1) != 0).any(axis=0)
        bounds = np.concatenate(([0], np.flatnonzero(new) + 1, [table.shape[1]])).tolist()
        home, prints = table[2].astype(bool), table[3]
        found = []
        for start, end in zip(bounds, bounds[1:], strict=False):
            at_home = home[start:end]
            members = prints[start:end]
            if at_home.any():
                found += _forest(members[at_home], members[~at_home], max_bits)
        if found:
            u, v = np.concatenate(found, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    found = dealt.mapInArrow(edges, "u long, v long").where("u <> v")
    return found.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 4,
    max_bits: int = MAX_BITS,
    staging: Staging | None = None,
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (long) and ``component_id``, one row for each of ``docs``.

    Documents whose fingerprints differ in at most ``max_bits`` bits are linked; ``component_id`` is
    the smallest id that can be reached over links, the own id included. Texts without words, null
    ones too, have fingerprint zero and are linked like any other. Rows without an id take part and
    get the smallest id of the others in their component, null if there is none. Repeated rows stay
    repeated. An empty table gives an empty result.
    """
    staging = staging or Staging(docs.sparkSession)
    prints = staging.table(fingerprints(docs, id_col, text_col, width), "prints")
    classes, number = staging.counted(
        prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "classes"
    )
    roots = components(links(classes, max_bits, code_for(number), staging), staging)
    rooted = classes.join(roots.withColumnRenamed("u", "fingerprint"), "fingerprint", "left")
    rooted = staging.table(
        rooted.select("fingerprint", "first", F.coalesce("v", "fingerprint").alias("root")), "rooted"
    )
    named = with_summary(rooted, "root", F.min("first"), "component_id", number)
    named = named.select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")
