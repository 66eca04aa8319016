import hashlib
import random
import time

import numpy as np
import pytest
import xxhash

from tellerloom.llm import lempel_ziv as lz
from tellerloom.llm.queries import QUERIES
from tests.llm.odd import TEXTS, no_documents, odd_documents


def slow_phrases(text):
    found, start = set(), 0
    for end in range(1, len(text) + 1):
        if text[start:end] not in found:
            found.add(text[start:end])
            start = end
    return found


def slow_signature(text):
    return sorted({xxhash.xxh32_intdigest(p) for p in slow_phrases(text)})[: lz.KEPT]


def slow_likeness(a, b):
    union = sorted({*a, *b})[: lz.KEPT]
    return sum(h in a and h in b for h in union) / len(union) if union else 1.0


def slow_rows(rows):
    """rows: (doc_id, text) by descending id, then text, those without an id last."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    texts = [text or "" for _, text in order]
    out = []
    for at, (doc_id, _) in enumerate(order):
        text, following = texts[at], texts[(at + 1) % len(texts)]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        a, b, c = map(slow_signature, (text, changed, following))
        digits = ["".join(f"{h:08x}" for h in s) for s in (a, b)]
        digest = hashlib.sha256(changed.encode()).hexdigest()
        near = (slow_likeness(a, b), slow_likeness(a, c))
        out.append((str(doc_id), len(text), digest, *digits, *near))
    return sorted(out)


def test_phrases_are_the_shortest_new_runs():
    assert lz.phrases("aababcabcd") == {"a", "ab", "abc", "abcd"}
    assert lz.phrases("aaaa") == {"a", "aa"}
    assert lz.phrases("") == set()


def test_likeness_is_near_the_jaccard_similarity():
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    for kept in (0.2, 0.5, 0.9):
        a = " ".join(rng.choices(words, k=2000))
        b = a[: int(kept * len(a))] + " ".join(rng.choices(words, k=200))
        p, q = lz.phrases(a), lz.phrases(b)
        truth = len(p & q) / len(p | q)
        assert abs(lz.likeness(lz.signature(a), lz.signature(b)) - truth) < 0.15


def test_small_sets_are_compared_exactly():
    a, b = "the cat sat", "the cat ran"
    p, q = lz.phrases(a), lz.phrases(b)
    assert lz.likeness(lz.signature(a), lz.signature(b)) == len(p & q) / len(p | q)
    empty = np.zeros(0, np.uint32)
    assert lz.likeness(empty, empty) == 1.0
    assert lz.likeness(empty, lz.signature(a)) == 0.0


@pytest.mark.parametrize("buckets", [1, 3, 1000])
def test_neighbours_against_brute_force(spark, buckets):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = lz.neighbours(docs, buckets=buckets).collect()
    got = sorted((str(r.doc_id), *tuple(r)[1:]) for r in found)
    assert got == slow_rows([(r.doc_id, r.text) for r in docs.collect()])


def test_query_has_a_row_for_each_document(spark):
    folder = "/root/testdata/sf0.001"
    found = QUERIES["op1_lempel_ziv"](spark, folder)
    assert found.count() == spark.read.parquet(f"{folder}/documents.parquet").count()


@pytest.mark.parametrize("buckets", [1, 4])
def test_odd_rows(spark, buckets):
    found = lz.neighbours(odd_documents(spark), buckets=buckets).collect()
    assert sorted((str(r.doc_id), *tuple(r)[1:]) for r in found) == slow_rows(TEXTS)
    assert lz.neighbours(no_documents(spark)).count() == 0


@pytest.mark.parametrize("buckets", [1, 9])
def test_rows_of_one_id_or_none_take_several_buckets(spark, buckets):
    rng = random.Random(3)
    texts = ["".join(rng.choices("abcd ", k=rng.randint(0, 40))) for _ in range(120)]
    rows = [(rng.choice([None, None, 7, 7, 7, i]), t) for i, t in enumerate(texts)]
    rows += [(7, "x" * 100 + c) for c in "cab"] + [(None, "same")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = lz.neighbours(docs, buckets=buckets).collect()
    assert sorted((str(r.doc_id), *tuple(r)[1:]) for r in found) == slow_rows(rows)
    dealt = lz.in_turn(docs, "doc_id", "text", buckets).where("not foreign")
    sizes = {r["bucket"]: r["count"] for r in dealt.groupBy("bucket").count().collect()}
    assert sum(sizes.values()) == len(rows)
    if buckets > 1:
        assert len(sizes) > 5 and max(sizes.values()) < len(rows) / 3


def test_columns_of_fingerprints(spark):
    rows = spark.createDataFrame([("abcabcabc", "abcabcabd"), (None, "")], "a string, b string")
    prints = rows.select(lz.fingerprint(rows.a).alias("a"), lz.fingerprint(rows.b).alias("b"))
    near = prints.select(lz.similarity(prints.a, prints.b).alias("n")).collect()
    assert [r.n for r in near] == [
        lz.likeness(lz.signature("abcabcabc"), lz.signature("abcabcabd")),
        1.0,
    ]


@pytest.mark.parametrize("size", [1, 2, 5, 64])
def test_pieces_give_the_phrases_of_the_whole(size):
    rng = random.Random(size)
    texts = ["", "a", "a" * 5000, "ab" * 3000, "日本🙂" * 900, "the cat and the hat " * 200]
    texts += ["".join(rng.choices("ab"[: rng.randint(1, 2)] + "é日", k=3000)) for _ in range(20)]
    for text in texts:
        assert lz.phrases_by_pieces(text, size) == lz.phrases(text)


@pytest.mark.parametrize("long", [lz.LONG_TEXT, 20])
def test_halves_give_the_signatures_of_the_whole(monkeypatch, long):
    monkeypatch.setattr(lz, "LONG_TEXT", long)
    rng = random.Random(9)
    texts = ["", "a", "ab", "aaa"] + ["".join(rng.choices("aab é🙂", k=rng.randint(0, 900))) for _ in range(60)]
    for text, following in zip(texts, texts[1:] + texts[:1], strict=True):
        for kept in (lz.KEPT, 3):
            halves = lz.Halves(text, kept)
            assert (halves.own == lz.signature(text, kept)).all()
            changed, found = halves.edited(following)
            assert changed == lz.edited(text, following)
            assert (found == lz.signature(changed, kept)).all()


def test_long_texts_take_a_time_in_proportion(monkeypatch):
    taken = []
    for n in (2_000_000, 8_000_000):
        began = time.process_time()
        found = lz.phrases("a" * n)
        taken.append(time.process_time() - began)
        assert sorted(map(len, found)) == list(range(1, len(found) + 1))
    assert taken[1] < 8 * taken[0]
    text = "".join(random.Random(2).choices("abc", k=200_000)) + "z" * 300_000
    by_pieces = lz.signature(text)
    monkeypatch.setattr(lz, "LONG_TEXT", 1 << 60)
    assert (lz.signature(text) == by_pieces).all()
