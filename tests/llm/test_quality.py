import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tellerloom.llm import quality
from tellerloom.llm.queries import QUERIES
from tests.llm.odd import TEXTS, no_documents, odd_documents


def test_query_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op8_quality"](spark, folder).toPandas()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert len(found) == docs.count()
    held = found.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)
    assert (found.held_out == held).all()
    assert found.score.between(0, 1).all()
    assert ((found.score >= 0.5) == (found.predicted == 1)).all()
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    checked = found[found.held_out].merge(labels, on="doc_id")
    good, bad = checked[checked.quality == 1], checked[checked.quality == 0]
    assert (good.predicted == 1).mean() > 0.98
    assert (bad.predicted == 0).mean() > 0.8


def test_no_label_of_a_held_out_row_is_used(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    models = [quality.fit(docs, table.where(~held)) for table in (labels, turned)]
    assert models[0] == models[1]


def test_the_curve_recovers_known_weights():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(20_000, 2))
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] + 0.5)))).astype(float)
    weights = quality.logistic(x, y, np.ones(len(y)))
    assert np.allclose(weights, (2, -1, 0.5), atol=0.15)


def test_long_texts_are_compressed_to_their_end():
    good, bad = b"the cat sat on the mat. " * 40, b"$$$ *** ### %%% &&& " * 40
    head = bytes(np.random.default_rng(1).integers(97, 123, 4 * quality.BLOCK, np.uint8))
    a = quality.features(head + good * 20, good, bad)
    b = quality.features(head + bad * 20, good, bad)
    assert a[0] > b[0]


def plain_features(text, good, bad):
    """By plain calls of the library, one frame a block."""
    sizes = []
    for content in (good, bad):
        total = 0
        for at in range(0, len(text), 8192):
            compressor = zstandard.ZstdCompressor(
                level=3,
                dict_data=zstandard.ZstdCompressionDict(content) if content else None,
                write_checksum=False,
                write_content_size=False,
                write_dict_id=False,
            )
            total += len(compressor.compress(text[at : at + 8192]))
        sizes.append(total)
    rate = min(sizes) / len(text) if text else 0.2
    return (sizes[1] - sizes[0]) / (sum(sizes) + 2048), min(rate - 0.2, 0.0)


def test_scores_are_those_of_plain_calls(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    rows = docs.select("text", quality.score(spark, model, F.col("text")).alias("p")).collect()
    for r in rows[::5]:
        x = plain_features((r.text or "").encode(), model.good, model.bad)
        z = sum(w * f for w, f in zip(model.weights, (*x, 1.0), strict=True))
        assert abs(r.p - 1 / (1 + np.exp(-np.clip(z, -30, 30)))) < 1e-9


GOOD = "the cat sat on the mat and looked at the dog that was there "
BAD = "click here !!! buy cheap pills now $$$ free free free offer "


def texts_of(words, number, size, rng):
    words = words.split()
    return [" ".join(rng.choice(words, size)) for _ in range(number)]


@pytest.mark.parametrize("long", ["good", "bad", "both"])
def test_classes_of_long_texts_are_learned(spark, long):
    rng = np.random.default_rng(5)
    sizes = {"good": 9000 if long != "bad" else 60, "bad": 9000 if long != "good" else 60}
    docs = [(i, t) for i, t in enumerate(texts_of(GOOD, 60, sizes["good"], rng))]
    docs += [(100 + i, t) for i, t in enumerate(texts_of(BAD, 60, sizes["bad"], rng))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    if long != "both":
        assert max(len(t) for _, t in docs) > quality.SAMPLE_BYTES
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in docs if i % 2], "doc_id long, quality int")
    model = quality.fit(frame, labels)
    held_out = frame.where("doc_id % 2 = 0")
    rows = held_out.select("doc_id", quality.score(spark, model, F.col("text")).alias("p")).collect()
    assert len(rows) == 60 and all((r.p >= 0.5) == (r.doc_id < 100) for r in rows)


def test_an_id_that_repeats_keeps_no_class_out_and_order_does_not_matter(spark):
    rng = np.random.default_rng(6)
    good, bad = texts_of(GOOD, 80, 60, rng), texts_of(BAD, 80, 60, rng)
    docs = [(i, t) for i, t in enumerate(good)] + [(1000 + i, t) for i, t in enumerate(bad)]
    docs += [(3, f"{good[3]} {i}") for i in range(3000)]
    labels = spark.createDataFrame([(i, int(i < 1000)) for i in {i for i, _ in docs}], "doc_id long, quality int")
    models = []
    for order in (docs, docs[::-1]):
        frame = spark.createDataFrame(order, "doc_id long, text string").repartition(7)
        models.append(quality.fit(frame, labels, sample_rows=100))
    assert models[0] == models[1]
    found = quality.score(spark, models[0], F.col("text")).alias("p")
    assert all((r.p >= 0.5) == (r.doc_id < 1000) for r in frame.select("doc_id", found).collect())


def test_classes_of_empty_texts_and_labels_without_documents(spark):
    docs = [(i, "" if i % 2 else GOOD) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(40)], "doc_id long, quality int")
    model = quality.fit(frame, labels)
    rows = frame.select("doc_id", quality.score(spark, model, F.col("text")).alias("p")).collect()
    assert all(0 <= r.p <= 1 for r in rows)
    elsewhere = spark.createDataFrame([(1, 1), (99, 0)], "doc_id long, quality int")
    rows = frame.select(quality.score(spark, quality.fit(frame, elsewhere), F.col("text")).alias("p"))
    assert {r.p for r in rows.collect()} == {0.5}


def test_odd_rows(spark):
    docs = odd_documents(spark)
    # With both classes, with one, and with none.
    for marks in ([(1, 1), (2, 1), (7, 0), (9, 0), (5, None), (None, 1), (4, 0)], [(1, 1)], []):
        labels = spark.createDataFrame(marks, "doc_id long, quality int")
        model = quality.fit(docs, labels)
        rows = docs.select(quality.score(spark, model, F.col("text")).alias("p")).collect()
        assert len(rows) == len(TEXTS)
        assert all(0 <= r.p <= 1 for r in rows)
    assert quality.score(spark, model, F.col("text")) is not None
    assert [r.p for r in rows] == [0.5] * len(TEXTS)
    nothing = quality.fit(no_documents(spark), labels)
    assert no_documents(spark).select(quality.score(spark, nothing, F.col("text"))).count() == 0
