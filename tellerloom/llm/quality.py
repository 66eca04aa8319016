"""Quality by compression: which of two zstandard dictionaries makes a text smaller.

One dictionary is trained on good, one on bad labelled texts. The normalised difference of the two
compressed sizes becomes a probability by a logistic curve, fitted to labelled texts measured with
dictionaries they are not in, those of the other half of the sample. Texts that repeat themselves shrink
to next to nothing under either dictionary, so their difference says little; how far the smaller size
lies under a usual rate is the curve's second term.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerloom.llm.common import byte_strings, thinned

# The sample a class is learned from: about so many labels, chosen by a hash of their ids, and of each text
# a block of at most so many bytes.
SAMPLE_ROWS = 2000
SAMPLE_BYTES = 1 << 15
DICTIONARY_BYTES = 1 << 17
LEVEL = 3
# Texts are compressed in blocks of this size, so that the dictionary matters all the way.
BLOCK = 1 << 13
# Added to the sum of the sizes that the difference is divided by: short texts are judged by the bytes
# they differ, so that a few weigh little, and long ones by their share.
STEADY = 2048
# Compressed share of a text's bytes under which it counts as repeating itself.
USUAL_RATE = 0.2


@dataclass(frozen=True)
class Model:
    """Dictionaries as bytes, and the weights of the curve for ``features`` and a constant."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]


@lru_cache(maxsize=4)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    content = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    if content is not None:
        content.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL,
        dict_data=content,
        write_checksum=False,
        write_content_size=False,
        write_dict_id=False,
    )


def features(text: bytes, good: bytes, bad: bytes) -> tuple[float, float]:
    """Of the whole text: the normalised difference of its compressed sizes, positive if the good
    dictionary makes it smaller, and how far the smaller size lies under the usual rate, or 0."""
    a, b = _compressor(good).compress, _compressor(bad).compress
    blocks = [text[at : at + BLOCK] for at in range(0, len(text), BLOCK)]
    with_good = sum(len(a(block)) for block in blocks)
    with_bad = sum(len(b(block)) for block in blocks)
    rate = min(with_good, with_bad) / len(text) if text else USUAL_RATE
    return (with_bad - with_good) / (with_bad + with_good + STEADY), min(rate - USUAL_RATE, 0.0)


def dictionary(texts: list[bytes]) -> bytes:
    """One trained on blocks of the texts, of at most DICTIONARY_BYTES.

    Where they have too little for training to find anything in common, the end of the texts themselves,
    which the format takes for a dictionary as well.
    """
    blocks = [t[at : at + BLOCK] for t in texts for at in range(0, len(t), BLOCK)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(blocks)[-DICTIONARY_BYTES:]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Weights by Newton steps, with a little ridge so that separable data stay finite."""
    scale = x.std(axis=0)
    scale[scale == 0] = 1.0
    design = np.column_stack([x / scale, np.ones(len(x))])
    ridge = np.append(np.full(len(scale), 1e-3), 1e-6) * weight.sum()
    beta = np.zeros(len(ridge))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - ridge * beta
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + np.diag(ridge)
        step = np.linalg.solve(curve, gradient)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple((beta / np.append(scale, 1.0)).tolist())


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Learn from ``labels`` (an id and 0 or 1) of rows of ``docs``; other labels are left out.

    The shares of the two classes are counted over all labels. The texts are a bounded sample: at most
    ``2 * sample_rows`` ids a class, which are broadcast, and of each id one text, the one with the
    smallest hash where the id repeats, or of a text of more than SAMPLE_BYTES bytes a block that starts
    somewhere in it. So neither copies, nor long texts, nor an id that repeats keep a class out, and the
    model does not depend on the order of rows. Null texts count as empty. Labels of an id in both classes
    count in both.

    With labels of one class only, or none, every score is its share, 0.5 without labels; so it is where no
    document has a label of one of the classes, as in an empty table. Columns beyond those named are not
    looked at, whatever their names.
    """
    marked = labels.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")
    ).where("doc_id is not null and label in (0, 1)")
    counted = marked.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()
    share = {row["label"]: row["n"] for row in counted}
    total = sum(share.values())
    prior = (share.get(1, 0) + 0.5) / (total + 1)
    flat = Model(b"", b"", (0.0, 0.0, float(np.log(prior / (1 - prior)))))
    if len(share) < 2:
        return flat
    chosen = [
        marked.where((F.col("label") == label) & thinned(F.xxhash64("doc_id"), sample_rows, n))
        .distinct()
        .limit(2 * sample_rows)
        for label, n in share.items()
    ]
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    spare = F.greatest(F.lit(1), F.length("text") - SAMPLE_BYTES + 1)
    first = (1 + F.pmod(F.xxhash64("doc_id"), spare)).cast("int")
    block = F.substring("text", first, F.lit(SAMPLE_BYTES))
    # At most four times sample_rows ids, and as many rows after the grouping.
    sample = (
        texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
        .select("doc_id", "label", F.xxhash64("text").alias("hash"), block.alias("text"))
        .groupBy("doc_id", "label")
        .agg(F.min(F.struct("hash", "text")).alias("least"))
    )
    table = sample.select("label", F.col("least.text").alias("text")).toArrow()
    by_label: dict[int, list[bytes]] = {0: [], 1: []}
    # Sorted, as rows come in any order.
    for label, text in sorted(
        zip(table["label"].to_pylist(), table["text"].to_pylist(), strict=True),
        key=lambda row: xxhash.xxh64_digest(row[1]),
    ):
        by_label[label].append(text)
    if not all(by_label.values()):
        return flat
    halves = {label: (found[0::2], found[1::2]) for label, found in by_label.items()}
    x, y = [], []
    for own, other in ((0, 1), (1, 0)):
        # Each half is measured with dictionaries of the other.
        bad, good = (dictionary(halves[label][other] or by_label[label]) for label in (0, 1))
        for label in (0, 1):
            x += [features(text, good, bad) for text in halves[label][own]]
            y += [float(label)] * len(halves[label][own])
    marks = np.array(y)
    weight = np.where(
        marks > 0, share[1] / len(by_label[1]), share[0] / len(by_label[0])
    ) / total * len(marks)
    weights = logistic(np.array(x), marks, weight)
    return Model(dictionary(by_label[1]), dictionary(by_label[0]), weights)


def score(spark, model: Model, text: Column) -> Column:
    """The probability that a text is good, from the whole text alone, of any length.

    Null and empty texts have a score like any other; equal texts have equal scores. An empty table gives
    an empty result.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for column in columns:
            found = [(*features(t, model.good, model.bad), 1.0) for t in byte_strings(column)]
            z = np.clip(np.array(found).reshape(-1, 3) @ model.weights, -30, 30)
            yield pa.array(1 / (1 + np.exp(-z)), pa.float64())

    return scored.asNondeterministic()(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))
