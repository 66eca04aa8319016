import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tellerloom.llm import hidden_markov as hm
from tellerloom.llm.queries import QUERIES
from tellerloom.staging import Staging
from tests.llm.odd import TEXTS, no_documents, odd_documents


def words(text):
    return (text or "").encode().lower().split()


def slow_base(rows):
    """(tokens, known, training tokens, base score) of each (text, held out)."""
    counts = Counter()
    for text, held in rows:
        if not held:
            counts.update(words(text))
            counts["end"] += 1
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for text, _ in rows:
        own = [*words(text), "end"]
        score = sum(math.log10((counts[w] + 1) / (total + 1 * (distinct + 1))) for w in own)
        out.append((len(own), sum(counts[w] > 0 for w in own), total, score))
    return out


def random_chain(states, alphabet, seed=1):
    rng = np.random.default_rng(seed)
    return hm.Chain(
        rng.dirichlet(np.ones(states)),
        rng.dirichlet(np.ones(states), states),
        rng.dirichlet(np.ones(alphabet), states).T.copy(),
    )


def slow_likelihood(chain, sequence):
    """Sum over all state paths."""
    states = range(len(chain.start))
    total = 0.0
    for path in itertools.product(states, repeat=len(sequence)):
        p = chain.start[path[0]] * chain.emit[sequence[0], path[0]]
        for t in range(1, len(sequence)):
            p *= chain.move[path[t - 1], path[t]] * chain.emit[sequence[t], path[t]]
        total += p
    return total


def test_forward_recursion_sums_over_all_paths():
    chain = random_chain(3, 5)
    rng = np.random.default_rng(2)
    sequences = [rng.integers(0, 5, n) for n in (1, 4, 7, 2, 6, 7, 1)]
    got = hm.log10_likelihood(chain, sequences)
    assert np.allclose(got, [math.log10(slow_likelihood(chain, s)) for s in sequences])


def test_long_sequences_do_not_underflow():
    chain = random_chain(4, 50)
    got = hm.log10_likelihood(chain, [np.zeros(100_000, np.int64), np.arange(50)])
    assert np.isfinite(got).all()


def test_expected_counts_against_all_paths():
    chain = random_chain(2, 3)
    rng = np.random.default_rng(3)
    sequences = [rng.integers(0, 3, n) for n in (5, 1, 3, 5)]
    start, move, emit = np.zeros(2), np.zeros((2, 2)), np.zeros((2, 3))
    for s in sequences:
        whole = slow_likelihood(chain, s)
        for path in itertools.product(range(2), repeat=len(s)):
            p = chain.start[path[0]] * chain.emit[s[0], path[0]]
            for t in range(1, len(s)):
                p *= chain.move[path[t - 1], path[t]] * chain.emit[s[t], path[t]]
            p /= whole
            start[path[0]] += p
            for t, state in enumerate(path):
                emit[state, s[t]] += p
                if t:
                    move[path[t - 1], state] += p
    expected = hm.Expected(2, 3)
    expected.add(chain, sequences)
    assert np.allclose(expected.start, start)
    assert np.allclose(expected.move, move)
    assert np.allclose(expected.emit, emit)
    assert math.isclose(expected.log, hm.log10_likelihood(chain, sequences).sum())


@pytest.mark.parametrize("longest", [1, 7, 40, 41])
def test_parts_of_a_sequence_count_like_the_whole(longest):
    chain = random_chain(3, 6)
    rng = np.random.default_rng(4)
    sequences = [rng.integers(0, 6, n) for n in (120, 41, 40, 81, 3, 1)]
    whole, parts = hm.Expected(3, 6), hm.Expected(3, 6)
    whole.add(chain, sequences)
    parts.add(chain, sequences, longest)
    for name in ("start", "move", "emit"):
        assert np.allclose(getattr(parts, name), getattr(whole, name))
    assert math.isclose(parts.log, whole.log)
    assert math.isclose(parts.start.sum(), 6) and math.isclose(parts.move.sum(), 286 - 6)


def encoded_of(spark, texts, staging):
    rows = spark.createDataFrame([(i, False, t.encode()) for i, t in enumerate(texts)],
                                 "doc_id long, held_out boolean, text binary")
    vocabulary = hm._vocabulary(staging.table(hm.word_counts(rows), "words"), rows.count())
    return staging.table(hm._encode(rows, vocabulary), "encoded"), vocabulary


def test_seeds_come_from_texts_of_any_length(spark, monkeypatch):
    """Texts longer than a block and copies of one text both give a sample."""
    monkeypatch.setattr(hm, "SEED_TOKENS", 30)
    drawn = []
    plain = hm.sequences_of
    monkeypatch.setattr(hm, "sequences_of", lambda column: drawn.append(plain(column)) or drawn[-1])
    staging = Staging(spark)
    for texts, size in (
        (["a b c " * 100 + f"w{i}" for i in range(40)], 30),
        (["same text here"] * 3000, 4),
    ):
        encoded, vocabulary = encoded_of(spark, texts, staging)
        hm._seeded(encoded, hm._shares(vocabulary), 2)
        assert 40 <= len(drawn[-1]) <= 2 * hm.SEED_TEXTS
        assert {len(s) for s in drawn[-1]} == {size}
    # Blocks start at different places.
    assert len({s.tobytes() for s in drawn[0]}) > 2
    staging.drop()


def test_rounds_end_when_little_is_gained(spark):
    staging = Staging(spark)
    rng = np.random.default_rng(1)
    topics = [[f"{t}{i}" for i in range(20)] for t in "abc"]
    texts = [" ".join(rng.choice(topics[i % 3], 50)) for i in range(200)]
    encoded, vocabulary = encoded_of(spark, texts, staging)
    shares = hm._shares(vocabulary)
    _, logs = hm.train(encoded, shares, 3, vocabulary.total)
    assert 2 <= len(logs) < hm.ROUNDS
    gains = np.diff(logs) / vocabulary.total
    assert (gains[:-1] >= hm.SETTLED).all() and gains[-1] < hm.SETTLED
    assert len(hm.train(encoded, shares, 3, vocabulary.total, rounds=4, settled=-1.0)[1]) == 4
    staging.drop()


def test_a_text_longer_than_a_part_is_learned_whole(spark, monkeypatch):
    text = " ".join(f"w{i % 7}" for i in range(500))
    staging = Staging(spark)
    encoded, vocabulary = encoded_of(spark, [text, "w1 w2", text], staging)
    shares, chain = hm._shares(vocabulary), random_chain(2, vocabulary.alphabet)
    whole, log = hm._round(encoded, chain, shares)
    add = hm.Expected.add
    monkeypatch.setattr(hm.Expected, "add", lambda self, c, s: add(self, c, s, 100))
    sequences = hm.sequences_of(encoded.select("symbols").toArrow()["symbols"].combine_chunks())
    expected = hm.Expected(2, vocabulary.alphabet)
    expected.add(chain, sequences)
    assert math.isclose(expected.log, log) and math.isclose(expected.start.sum(), 3)
    parts = expected.chain(shares)
    for name in ("start", "move", "emit"):
        assert np.allclose(getattr(parts, name), getattr(whole, name))
    staging.drop()


def test_a_common_long_word_is_one_row_of_a_text(spark):
    ruler = "-" * 80
    docs = spark.createDataFrame([(i, f"{ruler} x " * 50) for i in range(20)], "doc_id long, text string")
    staging = Staging(spark)
    encoded, _ = encoded_of(spark, [r.text for r in docs.collect()], staging)
    assert {tuple((bytes(t.word), t.times) for t in r.tail) for r in encoded.collect()} == {
        ((ruler.encode(), 50),)
    }
    rows = hm.score(docs, F.col("doc_id") > 9).collect()
    want = slow_base([(f"{ruler} x " * 50, i > 9) for i in range(20)])
    assert [(r.n_tokens, r.n_known) for r in rows] == [w[:2] for w in want]
    assert np.allclose([r.base_score for r in rows], [w[3] for w in want])
    staging.drop()


def test_rounds_raise_the_likelihood(monkeypatch):
    monkeypatch.setattr(hm, "SMOOTHING", 1e-9)
    truth = random_chain(3, 12, seed=5)
    rng = np.random.default_rng(6)
    sequences = []
    for _ in range(60):
        state, own = rng.choice(3, p=truth.start), []
        for _ in range(rng.integers(5, 30)):
            own.append(rng.choice(12, p=truth.emit[:, state]))
            state = rng.choice(3, p=truth.move[state])
        sequences.append(np.array(own))
    chain, logs = random_chain(3, 12, seed=9), []
    for _ in range(8):
        expected = hm.Expected(3, 12)
        expected.add(chain, sequences)
        logs.append(expected.log)
        chain = expected.chain(np.full(12, 1 / 12))
    assert all(b > a - 1.0 for a, b in itertools.pairwise(logs))
    assert logs[-1] > logs[0] + 10


# The second has next to no head, so that all counts are joined.
@pytest.mark.parametrize("head", [1 << 18, 5])
def test_base_and_factors_against_brute_force(spark, monkeypatch, head):
    monkeypatch.setattr(hm, "HEAD_WORDS", head)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.collect()
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    got = {r.doc_id: r for r in hm.score(docs, held, rounds=1).collect()}
    is_held = [zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows]
    want = slow_base([(r.text, h) for r, h in zip(rows, is_held, strict=True)])
    assert len(got) == len(rows)
    for row, h, (n, known, total, base) in zip(rows, is_held, want, strict=True):
        r = got[row.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.score < 0


def test_one_state_and_one_class_are_the_base(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    staging = Staging(spark)
    rows = docs.select(
        "doc_id", F.lit(False).alias("held_out"), F.col("text").cast("binary").alias("text")
    )
    counts = staging.table(hm.word_counts(rows), "words")
    vocabulary = hm._vocabulary(counts, rows.count())
    # A word's probability within its class, over the words of the class and one unknown, is 1.
    totals = np.zeros(hm.CLASSES)
    for row in counts.collect():
        if row.word not in vocabulary.words[: vocabulary.symbols]:
            c = hm.word_class(bytes(row.word))
            totals[c] += (row.n + 1) / (vocabulary.class_total[c] + 1)
    assert np.allclose(totals + 1 / (vocabulary.class_total + 1), 1)
    shares = hm._shares(vocabulary)
    assert math.isclose(shares.sum(), 1)
    encoded = staging.table(hm._encode(rows, vocabulary), "encoded")
    chain = hm._seeded(encoded, shares, 3)
    for model in (chain, hm._round(encoded, chain, shares)[0]):
        assert np.allclose(model.emit.sum(axis=0), 1)
        assert np.allclose(model.move.sum(axis=1), 1)
        assert math.isclose(model.start.sum(), 1)
    staging.drop()


def test_a_round_is_what_one_task_would_get(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.repartition(5).select(
        "doc_id", F.lit(False).alias("held_out"), F.col("text").cast("binary").alias("text")
    )
    staging = Staging(spark)
    counts = staging.table(hm.word_counts(rows), "words")
    vocabulary = hm._vocabulary(counts, rows.count())
    encoded = staging.table(hm._encode(rows, vocabulary), "encoded")
    shares = hm._shares(vocabulary)
    chain = random_chain(4, vocabulary.alphabet)
    moved, log = hm._round(encoded, chain, shares)
    expected = hm.Expected(4, vocabulary.alphabet)
    expected.add(chain, hm.sequences_of(encoded.select("symbols").toArrow()["symbols"].combine_chunks()))
    alone = expected.chain(shares)
    assert math.isclose(log, expected.log)
    for name in ("start", "move", "emit"):
        assert np.allclose(getattr(moved, name), getattr(alone, name))
    staging.drop()


def test_query_beats_the_base_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op3_hidden_markov"](spark, folder).toPandas()
    docs = spark.read.parquet(f"{folder}/documents.parquet").toPandas()
    assert sorted(found.doc_id) == sorted(docs.doc_id)
    held = found[found.held_out]
    assert held.score.sum() > held.base_score.sum() + 0.2 * held.n_tokens.sum()


def test_odd_rows(spark):
    docs = odd_documents(spark)
    for held in (F.col("doc_id") % 2 == 0, F.lit(True), F.lit(False)):
        got = hm.score(docs, held, rounds=1).collect()
        is_held = [bool(r[0]) for r in docs.select(F.coalesce(held, F.lit(False))).collect()]
        want = slow_base([(t, h) for (_, t), h in zip(TEXTS, is_held, strict=True)])
        assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens) for r in got) == sorted(
            (str(i), n, known, total) for (i, _), (n, known, total, _) in zip(TEXTS, want, strict=True)
        )
        base = sorted(r.base_score for r in got)
        assert np.allclose(base, sorted(b for *_, b in want))
        assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert hm.score(no_documents(spark), F.lit(False)).count() == 0
