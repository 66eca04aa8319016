"""Language identification by nearest centroid over character n-grams.

A text is the TF-IDF vector of its hashed byte bigrams and trigrams, normalised. Every language has
several centroids, found by spherical k-means: seeded from a bounded sample of each language, then
moved over all its training rows. A text gets the language of the centroid with the largest cosine, and
is rejected where that cosine is far below what training texts, or beginnings of them, of its length
have.

A model is sent to all tasks, so the languages it can tell apart have a limit, however many values the
training rows have. Sums of vectors depend on the order of tasks in their last digits, and so do scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tellerloom.llm.common import thinned

SIZE_BITS = 12
FEATURES = 1 << SIZE_BITS
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
CENTROIDS = 4
# Languages a model has at most, those with the most training rows: a centroid is 16 KB.
MOST_LANGUAGES = 256
# Different training texts of a language that seed its centroids, chosen by a hash of the text.
SEED_ROWS = 32
ROUNDS = 2
# Share of the median cosine of a length band under which a text is rejected, and the texts that a
# median is taken of, from the nearest bands where the band itself has fewer.
REJECT_AT = 0.3
MEDIAN_TEXTS = 30
# Length bands, and cells that the cosines of a band are counted in.
BANDS = 64
CELLS = 512
# Texts turned into one matrix at a time, and n-grams hashed at a time.
MATRIX_ROWS = 256
CHUNK = 1 << 20

# Bytes that count: ASCII letters (the text is lower case) and all bytes of other characters.
_KEPT = np.full(256, 32, np.uint8)
_KEPT[97:123] = np.arange(97, 123)
_KEPT[128:] = np.arange(128, 256)


def counts(text: str) -> np.ndarray | None:
    """How often each hashed n-gram occurs in the whole text; None if it has no letter."""
    if not LETTER.search(text):
        return None
    raw = _KEPT[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)]
    kept = raw != 32
    kept[1:] |= raw[:-1] != 32
    kept[0] = True
    raw = raw[kept]
    total = np.zeros(FEATURES, np.int64)
    for at in range(0, max(1, len(raw) - 2), CHUNK):
        part = raw[at : at + CHUNK + 2].astype(np.uint32)
        two = part[:-1] << np.uint32(8) | part[1:]
        three = two[:-1] << np.uint32(8) | part[2:]
        for grams in (two[: CHUNK if at + CHUNK + 2 < len(raw) else None], three):
            salt = np.uint32(0x5BD1E995 if grams is three else 0)
            hashed = (grams ^ salt) * np.uint32(0x9E3779B1) >> np.uint32(32 - SIZE_BITS)
            total += np.bincount(hashed, minlength=FEATURES)
    return total


def vectors(texts: list[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit TF-IDF vectors by row, and the number of n-grams (0 where there is no letter)."""
    matrix = np.zeros((len(texts), FEATURES), np.float32)
    sizes = np.zeros(len(texts), np.int64)
    for row, text in enumerate(texts):
        found = counts(text)
        if found is not None:
            sizes[row] = found.sum()
            matrix[row] = np.log1p(found)
    matrix *= idf
    norm = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norm > 0, norm, 1), sizes


def bands(sizes: np.ndarray) -> np.ndarray:
    """Length bands: powers of two of the number of n-grams."""
    return np.log2(np.maximum(sizes, 1)).astype(np.int64)


def matrices(texts: pa.Array) -> Iterator[tuple[slice, list[str]]]:
    values = texts.to_pylist()
    for at in range(0, len(values), MATRIX_ROWS):
        part = slice(at, at + MATRIX_ROWS)
        yield part, [value or "" for value in values[part]]


@dataclass
class Model:
    """``centroids`` has a unit row for each entry of ``languages``, which repeats names."""

    idf: np.ndarray
    languages: list[str]
    centroids: np.ndarray
    # By length band.
    floors: np.ndarray

    def nearest(self, vector_rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cosines = vector_rows @ self.centroids.T
        best = cosines.argmax(axis=1)
        return best, cosines[np.arange(len(best)), best]


def _document_frequencies(training: DataFrame) -> tuple[np.ndarray, int]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for _, texts in matrices(batch.column("text")):
                for text in texts:
                    found = counts(text)
                    if found is not None:
                        total += found > 0
                        seen += 1
        feature = np.append(np.flatnonzero(total), -1)
        n = np.append(total[total > 0], seen)
        yield pa.RecordBatch.from_arrays([pa.array(feature), pa.array(n)], ["feature", "n"])

    counted = training.select("text").mapInArrow(rows, "feature long, n long")
    table = counted.groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    frequency = dict(zip(table["feature"].to_pylist(), table["n"].to_pylist(), strict=True))
    texts = frequency.pop(-1, 0)
    total = np.zeros(FEATURES)
    total[list(frequency)] = list(frequency.values())
    return total, texts


def _languages(training: DataFrame, most: int) -> list[str]:
    """The values of ``lang`` with the most rows, of equal ones those that sort first."""
    counted = training.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    return sorted(row["lang"] for row in counted.orderBy(F.desc("n"), "lang").limit(most).collect())


def _clustered(own: np.ndarray, clusters: int) -> np.ndarray:
    """Centroids of different unit vectors: seeds far from one another, then a few rounds of k-means."""
    centre = own.mean(axis=0, keepdims=True)
    chosen = [int((own @ centre.T).argmax())]
    while len(chosen) < min(clusters, len(own)):
        # Farthest first.
        chosen.append(int((own @ own[chosen].T).max(axis=1).argmin()))
    found = own[chosen]
    for _ in range(4):
        nearest = (own @ found.T).argmax(axis=1)
        found = np.stack(
            [
                own[nearest == c].mean(axis=0) if (nearest == c).any() else found[c]
                for c in range(len(found))
            ]
        )
        found /= np.linalg.norm(found, axis=1, keepdims=True)
    return found


def _seeds(training: DataFrame, idf: np.ndarray, clusters: int) -> tuple[list[str], np.ndarray]:
    """Languages and centroids from a bounded sample of each language, one task a language.

    ``training`` has MOST_LANGUAGES languages at most, which bounds what is broadcast, a row a language and
    SEED_ROWS hashes of texts, and what reaches the driver, the centroids.
    """
    # Copies of a text count once, or a language made mostly of them could end up without a seed.
    # Code points that Spark's Unicode tables do not know may be letters.
    hashed = training.where(F.col("text").rlike(r"[\p{L}\p{Cn}]")).withColumn(
        "_hash", F.xxhash64("text")
    )
    different = hashed.select("lang", "_hash").distinct()
    # One row a language. About four times what is wanted gets as far as the ranking.
    sizes = different.groupBy("lang").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_hash").alias("_least")
    )
    order = Window.partitionBy("lang").orderBy("_hash")
    wanted = (
        different.join(F.broadcast(sizes), "lang")
        .where(
            thinned(F.col("_hash"), 4 * SEED_ROWS, F.col("_n"))
            | (F.col("_hash") == F.col("_least"))
        )
        .withColumn("_place", F.row_number().over(order))
        .where(F.col("_place") <= SEED_ROWS)
        .select("lang", "_hash")
    )
    sample = (
        hashed.join(F.broadcast(wanted), ["lang", "_hash"])
        .groupBy("lang", "_hash")
        .agg(F.min("text").alias("text"))
    )

    def seeded(table: pa.Table) -> pa.Table:
        found, sizes = vectors(table["text"].to_pylist(), idf)
        different = sorted({v.tobytes() for v in found[sizes > 0]})
        centres = []
        if different:
            own = np.stack([np.frombuffer(v, np.float32) for v in different])
            centres = [c.tobytes() for c in _clustered(own, clusters)]
        return pa.table(
            {
                "lang": pa.array([table["lang"][0].as_py()] * len(centres), pa.string()),
                "number": pa.array(range(len(centres)), pa.int32()),
                "centroid": pa.array(centres, pa.binary()),
            }
        )

    table = (
        sample.select("lang", "text")
        .groupBy("lang")
        .applyInArrow(seeded, "lang string, number int, centroid binary")
        .toArrow()
    )
    rows = sorted(zip(*(table[c].to_pylist() for c in ("lang", "number", "centroid")), strict=True))
    centres = np.frombuffer(b"".join(centroid for *_, centroid in rows), np.float32)
    return [lang for lang, *_ in rows], centres.reshape(-1, FEATURES)


def _own(model: Model, lang: list[str], found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid among those of each row's own language, -1 for a language without."""
    cosines = found @ model.centroids.T
    place = {name: i for i, name in enumerate(dict.fromkeys(model.languages))}
    of_centroid = np.array([place[name] for name in model.languages], np.int64)
    of_row = np.array([place.get(name, -1) for name in lang], np.int64)
    own = of_row[:, None] == of_centroid[None, :]
    cosines = np.where(own, cosines, -1)
    best = cosines.argmax(axis=1)
    value = cosines[np.arange(len(best)), best]
    return np.where(own.any(axis=1), best, -1), value


def _moved(training: DataFrame, model: Model) -> np.ndarray:
    """Centroids after one round over all training rows."""
    shared = training.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        total = np.zeros(model.centroids.shape)
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for part, texts in matrices(batch.column("text")):
                found, _ = vectors(texts, model.idf)
                best, _ = _own(model, langs[part], found)
                for c in np.unique(best[best >= 0]):
                    total[c] += found[best == c].sum(axis=0)
        centroid, feature = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(centroid), pa.array(feature), pa.array(total[centroid, feature])],
            ["centroid", "feature", "total"],
        )

    summed = (
        training.select("lang", "text")
        .mapInArrow(rows, "centroid long, feature long, total double")
        .groupBy("centroid", "feature")
        .agg(F.sum("total").alias("total"))
        .toArrow()
    )
    moved = np.zeros(model.centroids.shape)
    moved[summed["centroid"].to_numpy(), summed["feature"].to_numpy()] = summed["total"].to_numpy()
    norm = np.linalg.norm(moved, axis=1, keepdims=True)
    return np.where(norm > 0, moved / np.where(norm > 0, norm, 1), model.centroids).astype(
        np.float32
    )


def _beginning(text: str) -> str:
    """The first 2^k letters of a text, k by its hash, all k that fit being as likely."""
    return text[: 1 << xxhash.xxh64_intdigest(text.encode()) % max(1, len(text).bit_length())]


def _cosines(training: DataFrame, model: Model) -> np.ndarray:
    """By length band and cell, how many texts have that cosine to a centroid of their own language.

    Each training text counts, and a beginning of it, so that all lengths up to the longest are met.
    """
    shared = training.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        total = np.zeros((BANDS, CELLS), np.int64)
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for part, texts in matrices(batch.column("text")):
                for measured in (texts, [_beginning(text) for text in texts]):
                    found, sizes = vectors(measured, model.idf)
                    best, cosine = _own(model, langs[part], found)
                    kept = (best >= 0) & (sizes > 0)
                    cells = np.clip(cosine[kept] * CELLS, 0, CELLS - 1).astype(np.int64)
                    np.add.at(total, (bands(sizes)[kept], cells), 1)
        band, cell = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(band), pa.array(cell), pa.array(total[band, cell])], ["band", "cell", "n"]
        )

    summed = (
        training.select("lang", "text")
        .mapInArrow(rows, "band long, cell long, n long")
        .groupBy("band", "cell")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    counted = np.zeros((BANDS, CELLS), np.int64)
    counted[summed["band"].to_numpy(), summed["cell"].to_numpy()] = summed["n"].to_numpy()
    return counted


def _floors(counted: np.ndarray) -> np.ndarray:
    """The cosine under which a text of a length band is rejected, a share of the band's median.

    Up to half of a band may be junk before it moves the median far. A band with few texts, or longer
    than any, takes in its nearest neighbours, shorter ones first, until there are enough.
    """
    floors = np.zeros(len(counted))
    for band in range(len(counted)):
        pooled = np.zeros(CELLS, np.int64)
        for near in sorted(range(len(counted)), key=lambda other: (abs(other - band), other)):
            pooled += counted[near]
            if pooled.sum() >= MEDIAN_TEXTS:
                break
        if pooled.any():
            median = int(np.searchsorted(pooled.cumsum(), (pooled.sum() + 1) // 2))
            floors[band] = REJECT_AT * median / CELLS
    return floors


def fit(
    training: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    clusters: int = CENTROIDS,
    rounds: int = ROUNDS,
    most_languages: int = MOST_LANGUAGES,
) -> Model:
    """Learn from the rows of ``training`` that have a language and a letter.

    Document frequencies come from all of them, centroids and rejection floors from all rows of the
    ``most_languages`` languages that have the most; only the seeds come from a bounded sample
    (``SEED_ROWS`` different texts a language). What is broadcast or reaches the driver is at most a few
    times the model, whose size that number bounds. Repeated rows count as often; other columns are not
    looked at, whatever their names. An empty table gives a model without languages.
    """
    rows = training.select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")
    ).where("lang is not null and text is not null")
    frequency, texts = _document_frequencies(rows)
    idf = (np.log((1 + texts) / (1 + frequency)) + 0.05).astype(np.float32)
    languages = _languages(rows, most_languages)
    learned = rows.where(F.col("lang").isin(languages))
    names, centres = _seeds(learned, idf, clusters)
    model = Model(idf, names, centres, np.zeros(BANDS))
    if names:
        for _ in range(rounds):
            model.centroids = _moved(learned, model)
        model.floors = _floors(_cosines(learned, model))
    return model


def prediction(spark, model: Model, text: Column) -> Column:
    """A struct of ``lang_pred``, ``score`` (the cosine, 0 to 1) and ``rejected`` for a text column.

    A null text, one without a letter, and any text under a model without languages is ``und`` with
    score 0 and rejected. Ties go to the language that sorts first. The whole text counts, of any length.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double, rejected: boolean>")
    def predict(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for column in columns:
            langs, scores, rejected = [], [], []
            for _, texts in matrices(column):
                found, sizes = vectors(texts, model.idf)
                if not model.languages:
                    sizes[:] = 0
                    best, cosine = np.zeros(len(texts), np.int64), np.zeros(len(texts))
                else:
                    best, cosine = model.nearest(found)
                cosine = np.where(sizes > 0, np.clip(cosine.astype(float), 0, 1), 0.0)
                names = [model.languages[b] if n else UNKNOWN for b, n in zip(best, sizes)]
                langs += names
                scores.append(cosine)
                rejected.append((sizes == 0) | (cosine < model.floors[bands(sizes)]))
            yield pa.StructArray.from_arrays(
                [
                    pa.array(langs, pa.string()),
                    pa.array(np.concatenate(scores) if scores else [], pa.float64()),
                    pa.array(np.concatenate(rejected) if rejected else [], pa.bool_()),
                ],
                ["lang_pred", "score", "rejected"],
            )

    # Not to be evaluated again where a filter uses it.
    return predict.asNondeterministic()(text.cast("string"))
