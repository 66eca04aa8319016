"""Lempel-Ziv phrase fingerprints.

A text is parsed into LZ78 dictionary phrases, each the shortest run not seen before in that text. The
fingerprint keeps the smallest hashes of the phrase set; two fingerprints give an estimate of the
Jaccard similarity of the sets, which follows how well one text compresses given the other (Raff and
Nicholas, 2017).
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerloom.llm.common import thinned

# Hashes a fingerprint keeps, 8 hexadecimal digits each.
KEPT = 128
# Characters up to which a text is parsed phrase by phrase, and of the pieces a longer one is parsed by.
LONG_TEXT, PIECE = 1 << 17, 64
# Rows sampled for each bucket, and the most buckets; a bucket is read as a stream. Rows of one id, or
# without one, are told apart by a beginning of the text.
SAMPLED_ROWS = 32
MAX_BUCKETS = 100_000
BEGINNING = 64


def phrases(text: str) -> set[str]:
    """The LZ78 phrases of a text; a rest that is a phrase already adds nothing.

    A phrase of a text of n characters has fewer than sqrt(2 n) + 1, as all its beginnings are phrases
    before it. So in a text of up to LONG_TEXT characters it takes little to look up a whole phrase with
    each character; a longer text is parsed piece by piece, with the same result.
    """
    if len(text) > LONG_TEXT:
        return phrases_by_pieces(text)
    seen: set[str] = set()
    parse_on(seen, "", text)
    return seen


def parse_on(seen: set[str], phrase: str, text: str) -> str:
    """Add the phrases of a text to those ``seen`` before it, of which ``phrase`` is still open.

    What is open at its end.
    """
    add = seen.add
    for character in text:
        phrase += character
        if phrase not in seen:
            add(phrase)
            phrase = ""
    return phrase


def phrases_by_pieces(text: str, size: int = PIECE) -> set[str]:
    """The LZ78 phrases of a text, in a time in proportion to it.

    The dictionary is a trie whose edges are pieces of ``size`` characters: a node is known by its number
    and holds the pieces that go on from it, so no more than a piece is looked up at once.
    """
    root: set[str] = set()
    nodes: dict[tuple[int, str], tuple[int, set[str]]] = {}
    long: list[str] = []
    node, held, piece, before = 0, root, "", ""
    for character in text:
        piece += character
        if piece not in held:
            held.add(piece)
            if before:
                long.append(before + piece)
                node, held, before = 0, root, ""
            piece = ""
        elif len(piece) == size:
            node, held = nodes.setdefault((node, piece), (len(nodes) + 1, set()))
            before += piece
            piece = ""
    root.update(long)
    return root


def hashes(found: set[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh32_intdigest, found), np.uint32, len(found))


def smallest(found: np.ndarray, kept: int = KEPT) -> np.ndarray:
    """The smallest distinct hashes, ascending."""
    if len(found) > 4 * kept:
        # Room for hashes that occur twice.
        found = np.partition(found, 2 * kept)[: 2 * kept]
    return np.unique(found)[:kept]


def signature(text: str, kept: int = KEPT) -> np.ndarray:
    """The smallest distinct 32-bit hashes of the phrases, ascending."""
    return smallest(hashes(phrases(text)), kept)


class Halves:
    """A text parsed up to its edit, from where both it and its edited text go on.

    ``own`` is the signature of the text, the same that ``signature`` gives.
    """

    def __init__(self, text: str, kept: int = KEPT):
        self.text, self.kept = text, kept
        self.long = len(text) > LONG_TEXT
        if self.long:
            self.own = signature(text, kept)
            return
        cut = len(text) - len(text) // 2
        self.seen: set[str] = set()
        self.open = parse_on(self.seen, "", text[:cut])
        self.hashes = hashes(self.seen)
        self.own = self._with(text[cut:])

    def _with(self, rest: str) -> np.ndarray:
        every = self.seen.copy()
        parse_on(every, self.open, rest)
        return smallest(np.concatenate([self.hashes, hashes(every - self.seen)]), self.kept)

    def edited(self, following: str) -> tuple[str, np.ndarray]:
        """The edited text and its signature."""
        changed = edited(self.text, following)
        half = len(self.text) // 2
        if self.long:
            return changed, signature(changed, self.kept)
        return changed, self._with(following[:half])


def likeness(a: np.ndarray, b: np.ndarray, kept: int = KEPT) -> float:
    """Share of the smallest hashes of the union that both have, 0 to 1; 1 if both are empty."""
    union = np.union1d(a, b)[:kept]
    if not len(union):
        return 1.0
    return float((np.isin(union, a) & np.isin(union, b)).sum() / len(union))


def as_text(found: np.ndarray) -> str:
    return found.astype(">u4").tobytes().hex()


def from_text(found: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(found), ">u4").astype(np.uint32)


def fingerprint(text: Column, kept: int = KEPT) -> Column:
    """The fingerprint of a text column as a string; a null text counts as empty."""

    @F.arrow_udf("string")
    def hashed(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            values = [as_text(signature(text or "", kept)) for text in column.to_pylist()]
            yield pa.array(values, pa.string())

    return hashed(text.cast("string"))


def similarity(a: Column, b: Column, kept: int = KEPT) -> Column:
    """The likeness of two fingerprint columns, 0 to 1; null where either is null."""

    @F.arrow_udf("double")
    def compared(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in columns:
            pairs = zip(left.to_pylist(), right.to_pylist(), strict=True)
            values = [
                None if x is None or y is None else likeness(from_text(x), from_text(y), kept)
                for x, y in pairs
            ]
            yield pa.array(values, pa.float64())

    return compared(a, b)


# What rows are in order of: ids from the largest, those without one last, and beginnings of texts.
Place = tuple[bool, int, str]


def _place(doc_id: int | None, beginning: str) -> Place:
    return doc_id is None, 0 if doc_id is None else ~doc_id, beginning


def _bounds(rows: DataFrame, buckets: int) -> list[Place]:
    """Places that split the table into about equal buckets, from a hashed sample of known size.

    The buckets themselves hold every row; the sample only decides how even they are.
    """
    wanted = SAMPLED_ROWS * buckets
    rows = rows.select("doc_id", "beginning")
    chosen = rows.where(thinned(F.xxhash64("doc_id", "beginning"), wanted, rows.count()))
    table = chosen.limit(2 * wanted).toArrow()
    found = sorted(map(_place, table["doc_id"].to_pylist(), table["beginning"].to_pylist()))
    if not found:
        return []
    return sorted({found[i * len(found) // buckets] for i in range(1, buckets)})


def in_turn(docs: DataFrame, id_col: str, text_col: str, buckets: int) -> DataFrame:
    """Every row in its bucket, and with each bucket the first rows of the next one.

    Columns ``bucket``, ``foreign`` (true for rows from the next bucket, or from the first after the
    last, those of its first id and beginning), ``doc_id`` and ``text``. Buckets run from the largest ids
    to the smallest; rows without an id come last. An id that very many rows have takes several buckets.
    """
    keyed = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("beginning", F.substring("text", 1, BEGINNING))
    bounds = _bounds(keyed, buckets)

    @F.arrow_udf("int")
    def bucket_of(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for ids, beginnings in columns:
            places = map(_place, ids.to_pylist(), beginnings.to_pylist())
            yield pa.array([bisect_right(bounds, place) for place in places], pa.int32())

    placed = keyed.withColumn("bucket", bucket_of("doc_id", "beginning"))
    # One row a bucket.
    place = F.struct(F.col("doc_id").isNull(), F.bitwise_not("doc_id"), "beginning", "doc_id")
    least = placed.groupBy("bucket").agg(F.min(place).alias("least"))
    heads = least.select("bucket", "least.doc_id", "least.beginning").collect()
    heads.sort(key=lambda r: r["bucket"])
    before = [(heads[i - 1]["bucket"], h["doc_id"], h["beginning"]) for i, h in enumerate(heads)]
    first = docs.sparkSession.createDataFrame(before, "to int, head long, starts string")
    same = F.col("doc_id").eqNullSafe(F.col("head")) & (F.col("beginning") == F.col("starts"))
    foreign = keyed.join(F.broadcast(first), same).select(
        F.col("to").alias("bucket"), F.lit(True).alias("foreign"), "doc_id", "text"
    )
    own = placed.select("bucket", F.lit(False).alias("foreign"), "doc_id", "text")
    return own.unionByName(foreign)


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as many first code points of ``following``, or all."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def neighbours(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    kept: int = KEPT,
    buckets: int | None = None,
) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness to one another.

    The next document is the one with the next smaller id; the first follows the last. Rows of one id
    follow in the order of their texts, rows without an id come last. A null text is empty, and the
    only document of a table follows itself. Columns: ``doc_id``, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``. Repeated rows stay repeated,
    columns beyond the two are not looked at, whatever their names, and an empty table gives an empty
    result. Two texts have to fit in a task, of any length.

    Texts are shuffled once, by buckets of ids and, within an id, of beginnings of texts; a task goes
    through its rows in order and holds two.
    """
    spark = docs.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(buckets, MAX_BUCKETS)
    rows_in_turn = (
        in_turn(docs, id_col, text_col, buckets)
        .repartition("bucket")
        .sortWithinPartitions("bucket", "foreign", F.desc_nulls_last("doc_id"), "text")
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("bucket", "foreign", "doc_id", "text")]
            out = []
            for bucket, foreign, doc_id, text in zip(*columns, strict=True):
                wanted = before is not None and before[0] == bucket
                if foreign and not wanted:
                    before = None
                    continue
                halves = Halves(text, kept)
                if wanted:
                    out.append(compared(before, text, halves.own))
                before = None if foreign else (bucket, doc_id, halves)
            if out:
                yield pa.RecordBatch.from_pylist(out, SCHEMA)

    def compared(before: tuple, following: str, after: np.ndarray) -> dict:
        _, doc_id, halves = before
        own = halves.own
        changed, other = halves.edited(following)
        return {
            "doc_id": doc_id,
            "n_chars": len(halves.text),
            "edited_sha256": hashlib.sha256(changed.encode()).hexdigest(),
            "fingerprint": as_text(own),
            "edited_fingerprint": as_text(other),
            "near_edited": likeness(own, other, kept),
            "near_next": likeness(own, after, kept),
        }

    return rows_in_turn.mapInArrow(
        rows,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )


SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
