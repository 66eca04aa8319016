import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tellerloom.llm import language
from tellerloom.llm.queries import QUERIES
from tests.llm.odd import TEXTS, no_documents, odd_documents

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_query_on_held_out_rows(spark, documents):
    found = QUERIES["op9_language"](spark, FOLDER).toPandas()
    docs = documents.toPandas()
    assert len(found) == len(docs)
    held = found.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)
    assert (found.held_out == held).all()
    assert found.score.between(0, 1).all()
    checked = found[found.held_out].merge(docs, on="doc_id")
    assert (checked.lang == checked.lang_pred).mean() > 0.98
    assert found.rejected.mean() < 0.01


def slow_counts(text):
    """Hashed n-grams one at a time."""
    kept = bytearray(b" ")
    for b in f"{text.lower()} ".encode():
        b = b if 97 <= b < 123 or b >= 128 else 32
        if b != 32 or kept[-1] != 32:
            kept.append(b)
    total = np.zeros(language.FEATURES, int)
    for n, salt in ((2, 0), (3, 0x5BD1E995)):
        for at in range(len(kept) - n + 1):
            gram = int.from_bytes(kept[at : at + n], "big")
            hashed = (gram ^ salt) * 0x9E3779B1 % (1 << 32)
            total[hashed >> (32 - language.SIZE_BITS)] += 1
    return total


@pytest.mark.parametrize("chunk", [1 << 20, 3, 16])
def test_counts_against_one_at_a_time(monkeypatch, chunk):
    monkeypatch.setattr(language, "CHUNK", chunk)
    for text in ["The cat, the hat.", "été ÇA va?  là-bas!", "x", "a b", "日本語 kana テスト"]:
        assert (language.counts(text) == slow_counts(text)).all()
    assert language.counts("12 !?") is None
    assert language.counts("") is None


def test_document_frequencies_cover_all_rows(spark, documents):
    idf_counts, texts = language._document_frequencies(documents)
    rows = [r.text for r in documents.select("text").collect()]
    found = [language.counts(t) for t in rows]
    assert texts == sum(f is not None for f in found)
    assert (idf_counts == sum((f > 0).astype(int) for f in found if f is not None)).all()


def test_a_round_moves_centroids_to_the_means_of_their_rows(spark, documents):
    frequency, texts = language._document_frequencies(documents)
    idf = np.log((1 + texts) / (1 + frequency)).astype(np.float32)
    names, centres = language._seeds(documents, idf, 2)
    model = language.Model(idf, names, centres, np.zeros(64))
    moved = language._moved(documents, model)
    rows = documents.select("lang", "text").collect()
    matrix, _ = language.vectors([r.text for r in rows], idf)
    own, _ = language._own(model, [r.lang for r in rows], matrix)
    for c in range(len(names)):
        mean = matrix[own == c].astype(float).sum(axis=0)
        assert np.allclose(moved[c], mean / np.linalg.norm(mean), atol=1e-4)


def test_a_language_of_copies_has_different_seeds(spark):
    texts = [f"{word} " * 30 for word in ("alpha", "brumo", "cenito", "dorvak", "eluxin")]
    copied = spark.range(10_000).select(
        F.concat(F.lit("xx"), (F.col("id") % 20).cast("string")).alias("lang"),
        F.element_at(
            F.array(*[F.lit(t) for t in texts]),
            F.when(F.col("id") < 9_000, 1).otherwise((F.col("id") / 20).cast("int") % 5 + 1),
        ).alias("text"),
    )
    # Each of the languages has its own texts, so each has its chance to lose all of them.
    rows = copied.select("lang", F.concat("text", F.lit(" "), F.repeat("lang", 9)).alias("text"))
    large = spark.range(10_000).select(
        F.lit("zz").alias("lang"), F.element_at(F.array(*[F.lit(t) for t in texts]), (F.col("id") % 5 + 1).cast("int")).alias("text")
    )
    idf = np.ones(language.FEATURES, np.float32)
    names, centres = language._seeds(rows.unionByName(large), idf, 4)
    assert {name: names.count(name) for name in names} == {
        **{f"xx{i}": 4 for i in range(20)},
        "zz": 4,
    }
    for name in set(names):
        own = centres[[n == name for n in names]]
        assert (own @ own.T - np.eye(4) < 0.999).all()


def test_strange_text_is_rejected(spark, documents):
    model = language.fit(documents)
    strange = "".join(chr(0x4E00 + i * 7 % 5000) for i in range(3000))
    rows = spark.createDataFrame([(strange,), ("the and attion to thanedble the " * 40,)], "t string")
    found = rows.select(language.prediction(spark, model, F.col("t")).alias("p")).collect()
    assert [r.p.rejected for r in found] == [True, False]


def strange_texts(length):
    """Texts of about a length in scripts and letters that the corpus does not have."""
    random = np.random.default_rng(length)

    def words(first, last):
        ends = random.integers(0, 7, length) == 0
        drawn = random.integers(first, last, length)
        return "".join(" " if end else chr(c) for end, c in zip(ends, drawn, strict=True))

    return [words(0x4E00, 0x8000), words(0x430, 0x450), words(0x3B1, 0x3CA), words(0x627, 0x64A)]


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_strange_texts_of_any_length_are_rejected(spark, size):
    documents = spark.read.parquet(f"/root/testdata/{size}/documents.parquet")
    model = language.fit(documents)
    longest = documents.select(F.max(F.length("text"))).first()[0]
    strange = [t for n in (30, 100, 1000, 10_000, 4 * longest) for t in strange_texts(n)]
    plain = documents.where("lang = 'en' and length(text) > 2000").orderBy("doc_id").limit(400)
    joined = " ".join(r.text for r in plain.collect())
    own = [joined[:n] for n in (100, 1000, 10_000, 100_000)] + [joined]
    assert len(joined) > 3 * longest
    both = [(t, True) for t in strange] + [(t, False) for t in own]
    predicted = language.prediction(spark, model, F.col("t")).alias("p")
    rows = spark.createDataFrame(both, "t string, strange boolean")
    found = rows.select("strange", F.length("t").alias("n"), predicted).collect()
    wrong = [(r.n, r.p.lang_pred, r.p.score) for r in found if r.p.rejected != r.strange]
    assert not wrong


def test_junk_in_the_training_rows_does_not_open_a_band(spark, documents):
    long = documents.where("lang = 'en' and length(text) > 2000")
    texts = [r.text[:2000] for r in long.collect()]
    junk = [t for n in range(1000, 1000 + len(texts) // 12) for t in strange_texts(n)[1:2]]
    rows = [("en", t) for t in texts + junk]
    model = language.fit(spark.createDataFrame(rows, "lang string, text string"), clusters=1)
    others = [(t,) for n in (500, 3000) for t in strange_texts(n)[::2]]
    strange = spark.createDataFrame(others, "t string")
    found = strange.select(language.prediction(spark, model, F.col("t")).alias("p")).collect()
    assert [r.p.rejected for r in found] == [True] * 4


def test_floors_of_thin_bands_are_those_of_their_neighbours():
    counted = np.zeros((language.BANDS, language.CELLS), np.int64)
    counted[5, 100], counted[9, 300], counted[10, 0] = 40, 50, 3
    floors = language._floors(counted)
    assert np.allclose(floors[:7], 0.3 * 100 / language.CELLS)
    # The tie goes to the shorter texts.
    assert floors[7] == floors[5] and floors[8] > floors[5]
    assert np.allclose(floors[9:], 0.3 * 300 / language.CELLS)
    assert (language._floors(counted * 0) == 0).all()


def test_any_number_of_languages_makes_a_bounded_model(spark, monkeypatch):
    """100,000 values of ``lang`` once each, beside three languages: the largest are learned."""
    sent = []
    context = type(spark.sparkContext)
    plain = context.broadcast
    monkeypatch.setattr(context, "broadcast", lambda self, value: sent.append(value) or plain(self, value))
    common = {"aa": "the cat sat on the mat", "bb": "le chat noir dort", "cc": "die katze schlaeft"}
    rows = spark.range(100_000).select(
        F.concat(F.lit("dirty"), F.col("id").cast("string")).alias("lang"),
        F.concat(F.lit("zzz qqq "), F.col("id").cast("string")).alias("text"),
    )
    for lang, text in common.items():
        rows = rows.unionByName(
            spark.range(50).select(
                F.lit(lang).alias("lang"), F.concat(F.lit(f"{text} "), F.repeat(F.lit("x"), F.col("id").cast("int"))).alias("text")
            )
        )
    model = language.fit(rows, most_languages=20)
    assert len(set(model.languages)) == 20 and set(common) < set(model.languages)
    assert model.centroids.shape == (len(model.languages), language.FEATURES)
    assert len(model.languages) <= 20 * language.CENTROIDS
    # What tasks are sent is the model, whatever the number of values.
    models = [value for value in sent if isinstance(value, language.Model)]
    assert models and all(len(m.centroids) <= 20 * language.CENTROIDS for m in models)
    texts = spark.createDataFrame([(text,) for text in common.values()], "t string")
    found = texts.select(language.prediction(spark, model, F.col("t")).alias("p")).collect()
    assert [r.p.lang_pred for r in found] == list(common)


def test_prediction_is_the_nearest_centroid_by_hand(spark, documents):
    """Whole texts against all centroids, one vector at a time."""
    model = language.fit(documents.where("doc_id % 5 <> 0"))
    rows = documents.select("text", language.prediction(spark, model, F.col("text")).alias("p")).collect()
    for r in rows[::7]:
        if not language.LETTER.search(r.text or ""):
            assert (r.p.lang_pred, r.p.score, r.p.rejected) == ("und", 0.0, True)
            continue
        found = slow_counts(r.text)
        vector = np.log1p(found) * model.idf
        vector = vector / np.sqrt((vector * vector).sum())
        cosines = [float((vector * centroid).sum()) for centroid in model.centroids]
        best = max(range(len(cosines)), key=lambda i: cosines[i])
        assert r.p.lang_pred == model.languages[best]
        assert abs(r.p.score - min(1.0, max(0.0, cosines[best]))) < 1e-5
        floor = model.floors[int(np.log2(found.sum()))]
        assert r.p.rejected == (r.p.score < floor)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    model = language.fit(docs.where("doc_id % 5 <> 0"))
    rows = docs.select("text", language.prediction(spark, model, F.col("text")).alias("p")).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        without = r.text is None or not language.LETTER.search(r.text)
        assert r.p.lang_pred == ("und" if without else "en")
        assert 0 <= r.p.score <= 1
        assert r.p.rejected or not without
    untaught = language.fit(no_documents(spark))
    assert untaught.languages == []
    found = docs.select(language.prediction(spark, untaught, F.col("text")).alias("p")).collect()
    assert {(r.p.lang_pred, r.p.score, r.p.rejected) for r in found} == {("und", 0.0, True)}
    nothing = no_documents(spark).select(language.prediction(spark, model, F.col("text")))
    assert nothing.count() == 0
