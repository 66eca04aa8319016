"""A hidden Markov language model over words, trained by Baum-Welch across partitions.

A text is its words and one end. Latent states emit symbols: the end, each of the most frequent words,
and for every other word the class of its ending. A word within a class has the probability
(c + 1) / (N + V + 1), with c its count, N the tokens and V the distinct words of that class in the
training texts, whatever the state. So the likelihood of a text is that of its symbols, by the scaled
forward recursion over all state paths, times a factor for each word that is no symbol of its own. Under
one state and one class this is the unigram model that gives the base score.

Counts cover all training texts, and so does each round of Baum-Welch; rounds end when the likelihood
gains little. The start values of the rounds come from a bounded sample of rows, a block of each. A text of
any length is one sequence: what its parts need of one another is kept where they meet, so a task holds
the symbols of a text and the recursion of one part. Tasks hold the counts of the head of the vocabulary, a
table of known size; the counts of all other words are joined. Everything is the same plan at any size.

Expected counts are sums of floating-point numbers over tasks, so scores may differ in their last digits
from one run to the next.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerloom.llm.common import byte_strings, thinned
from tellerloom.staging import Staging

# At most so many words, of at most so many bytes, have their counts sent to every task.
HEAD_WORDS = 1 << 18
HEAD_BYTES = 40
# Of these, so many emit as themselves.
SYMBOLS = 1 << 14
CLASSES = 512
ENDING = 3
STATES = 8
# Rounds end when a token gains less than so many digits by the last one, or at the limit.
SETTLED = 0.005
ROUNDS = 12
# Texts of the sample, the tokens of the block that is taken of each, and the rounds over it.
SEED_TEXTS = 1024
SEED_TOKENS = 1024
SEED_ROUNDS = 12
# Emissions are smoothed towards the symbols' shares with the weight of so many tokens a state.
SMOOTHING = 100.0
# Tokens, padding included, that one pass of the recursion holds.
BATCH_TOKENS = 1 << 18
BATCH_TEXTS = 512
# Distinct words a task counts before it hands them on.
COUNTED_WORDS = 1 << 18
# Steps of the ladder of counts, for each doubling.
LADDER = 16


def tokens(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, without the end."""
    return text.lower().split()


def word_class(word: bytes) -> int:
    return zlib.crc32(word[-ENDING:]) % CLASSES


class Index(dict):
    """Places of head words; for any other word its class, counted down from -1."""

    def __missing__(self, word: bytes) -> int:
        return -1 - zlib.crc32(word[-ENDING:]) % CLASSES


def word_counts(texts: DataFrame) -> DataFrame:
    """``word`` (binary) and its count ``n`` in the column ``text`` (binary)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter[bytes] = Counter()
        for batch in batches:
            for text in byte_strings(batch.column("text")):
                counter.update(tokens(text))
                if len(counter) >= COUNTED_WORDS:
                    yield counted(counter)
                    counter.clear()
        yield counted(counter)

    def counted(counter: Counter[bytes]) -> pa.RecordBatch:
        words, n = list(counter.keys()), list(counter.values())
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()), pa.array(n, pa.int64())], ["word", "n"]
        )

    return texts.select("text").mapInArrow(rows, "word binary, n long").groupBy("word").agg(
        F.sum("n").alias("n")
    )


def _step(n: Column) -> Column:
    return F.floor(F.log2(n) * LADDER)


@dataclass
class Vocabulary:
    """The head of the vocabulary, and totals of all of it."""

    words: list[bytes]
    counts: np.ndarray
    total: int
    distinct: int
    ends: int
    symbols: int
    class_total: np.ndarray
    # Words with a lower step of the ladder, or longer ones, are not in the head.
    lowest: int

    def is_tail(self, word: Column, n: Column) -> Column:
        return (F.length(word) > HEAD_BYTES) | (_step(n) < self.lowest)

    @property
    def alphabet(self) -> int:
        return 1 + SYMBOLS + CLASSES

    def index(self) -> Index:
        return Index((word, i) for i, word in enumerate(self.words))

    def symbol_of(self) -> np.ndarray:
        """The symbol of each head word."""
        own = [
            1 + i if i < self.symbols else 1 + SYMBOLS + word_class(word)
            for i, word in enumerate(self.words)
        ]
        return np.array(own, np.uint16)


def _vocabulary(counts: DataFrame, texts: int) -> Vocabulary:
    """``counts`` must be a table, as it is read several times."""
    short = counts.where(F.length("word") <= HEAD_BYTES)
    # At most 64 * LADDER rows.
    ladder = short.groupBy(_step(F.col("n")).alias("step")).agg(F.count(F.lit(1)).alias("words"))
    lowest, size = 64 * LADDER, 0
    for row in sorted(ladder.collect(), key=lambda row: -row["step"]):
        if size + row["words"] > HEAD_WORDS:
            break
        size += row["words"]
        lowest = row["step"]
    head = short.where(_step(F.col("n")) >= lowest).toArrow()
    ordered = sorted(
        zip(head["word"].to_pylist(), head["n"].to_pylist(), strict=True),
        key=lambda row: (-row[1], row[0]),
    )
    words = [word for word, _ in ordered]
    symbols = min(SYMBOLS, len(words))
    own = frozenset(words[:symbols])

    def by_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((CLASSES + 1, 2), np.int64)
        for batch in batches:
            for word, n in zip(
                batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True
            ):
                table[CLASSES] += (n, 1)
                if word not in own:
                    table[word_class(word)] += (n, 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(CLASSES + 1)), pa.array(table[:, 0]), pa.array(table[:, 1])],
            ["class", "n", "words"],
        )

    summed = (
        counts.mapInArrow(by_class, "class long, n long, words long")
        .groupBy("class")
        .agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
        .toArrow()
    )
    table = np.zeros((CLASSES + 1, 2), np.int64)
    table[summed["class"].to_numpy()] = np.stack(
        [summed["n"].to_numpy(), summed["words"].to_numpy()], axis=1
    )
    return Vocabulary(
        words=words,
        counts=np.array([n for _, n in ordered], np.int64),
        total=int(table[CLASSES, 0]) + texts,
        distinct=int(table[CLASSES, 1]) + (texts > 0),
        ends=texts,
        symbols=symbols,
        class_total=table[:CLASSES].sum(axis=1),
        lowest=lowest,
    )


# The last vocabulary a task has seen, with its index and symbols.
_prepared: list = [None, None, None]


def _encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Symbols and head sums of every text; its other words in ``tail``, each once with its count.

    ``log_count`` sums log10(c + 1) over the end and the words of the head, ``log_class`` what is known of
    the factors of words that are no symbols: all of it for head words, the denominators for others.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        if _prepared[0] is not v:
            _prepared[:] = v, v.index(), v.symbol_of()
        _, index, symbol_of = _prepared
        place = index.__getitem__
        log_count = np.log10(v.counts + 1.0)
        log_class = np.log10(v.class_total + 1.0)
        head_class = symbol_of.astype(np.int64) - 1 - SYMBOLS
        log_factor = np.where(
            head_class >= 0, log_count - log_class[np.maximum(head_class, 0)], 0.0
        )
        for batch in batches:
            names = ("n_tokens", "known", "log_count", "log_class", "symbols")
            out: dict[str, list] = {name: [] for name in names}
            tail: list[bytes] = []
            times: list[int] = []
            ends = [0]
            for text in byte_strings(batch.column("text")):
                words = tokens(text)
                at = np.fromiter(map(place, words), np.int64, len(words))
                missing = np.flatnonzero(at < 0)
                classes = -1 - at[missing]
                in_head = at[at >= 0]
                symbols = np.zeros(len(words) + 1, "<u2")
                if len(v.words):
                    symbols[:-1] = symbol_of[at * (at >= 0)]
                symbols[missing] = 1 + SYMBOLS + classes
                out["n_tokens"].append(len(words) + 1)
                out["known"].append(len(in_head) + (v.ends > 0))
                out["log_count"].append(log_count[in_head].sum() + np.log10(v.ends + 1))
                out["log_class"].append(log_factor[in_head].sum() - log_class[classes].sum())
                out["symbols"].append(symbols.tobytes())
                others = Counter(map(words.__getitem__, missing.tolist()))
                tail += others.keys()
                times += others.values()
                ends.append(len(tail))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(out["n_tokens"], pa.int64()),
                    pa.array(out["known"], pa.int64()),
                    pa.array(out["log_count"], pa.float64()),
                    pa.array(out["log_class"], pa.float64()),
                    pa.array(out["symbols"], pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(ends, pa.int32()),
                        pa.StructArray.from_arrays(
                            [pa.array(tail, pa.binary()), pa.array(times, pa.int64())],
                            ["word", "times"],
                        ),
                    ),
                ],
                ["doc_id", "held_out", *out, "tail"],
            )

    schema = """doc_id long, held_out boolean, n_tokens long, known long, log_count double,
        log_class double, symbols binary, tail array<struct<word: binary, times: long>>"""
    return docs.mapInArrow(rows, schema).withColumn("row", F.monotonically_increasing_id())


@dataclass
class Chain:
    """Probabilities: of the first state, from state to state, and of symbols in a state (by symbol)."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def batches_of(sequences: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places of sequences, longest first, their symbols by time, and how many go on at each time."""
    lengths = np.array([len(s) for s in sequences])
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while at < len(order):
        longest = lengths[order[at]]
        chosen = order[at : at + int(max(1, min(BATCH_TEXTS, BATCH_TOKENS // longest)))]
        at += len(chosen)
        symbols = np.zeros((longest, len(chosen)), np.int64)
        for column, i in enumerate(chosen):
            symbols[: lengths[i], column] = sequences[i]
        going = np.searchsorted(-lengths[chosen], -np.arange(longest), side="left")
        yield chosen, symbols, going


def log10_likelihood(chain: Chain, sequences: list[np.ndarray]) -> np.ndarray:
    """Of each sequence over all state paths, by the scaled forward recursion."""
    result = np.zeros(len(sequences))
    for chosen, symbols, going in batches_of(sequences):
        total = np.zeros(len(chosen))
        each = np.ones(len(chain.start))
        forward = chain.start * chain.emit[symbols[0]]
        for t in range(len(symbols)):
            n = going[t]
            if t:
                forward = forward[:n] @ chain.move
                forward *= chain.emit[symbols[t, :n]]
            scale = forward @ each
            forward /= scale[:, None]
            total[:n] += np.log10(scale)
        result[chosen] = total
    return result


def _forward(
    chain: Chain, part: np.ndarray, before: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward values and scales of a part of one sequence, after ``before`` if it is not the first."""
    forward = np.empty((len(part), len(chain.start)))
    scales = np.empty(len(part))
    now = before
    for t, emit in enumerate(chain.emit[part]):
        now = (chain.start if now is None else now @ chain.move) * emit
        scales[t] = now.sum()
        now = now / scales[t]
        forward[t] = now
    return forward, scales


class Expected:
    """Expected counts of the start, the moves and the emissions, and the log10 likelihood."""

    def __init__(self, states: int, alphabet: int):
        self.start = np.zeros(states)
        self.move = np.zeros((states, states))
        self.emit = np.zeros((states, alphabet))
        self.log = 0.0

    def add(self, chain: Chain, sequences: list[np.ndarray], longest: int = BATCH_TOKENS) -> None:
        """Add those of whole sequences; one of more than ``longest`` symbols is gone through in parts."""
        short = [sequence for sequence in sequences if len(sequence) <= longest]
        for _, symbols, going in batches_of(short):
            self._add(chain, symbols, going)
        for sequence in sequences:
            if len(sequence) > longest:
                self._add_long(chain, sequence, longest)

    def _add_long(self, chain: Chain, sequence: np.ndarray, size: int) -> None:
        """A forward pass that keeps its values between parts, then the parts from the last to the first."""
        before: list[np.ndarray | None] = [None]
        now = None
        for at in range(0, len(sequence) - size, size):
            now = _forward(chain, sequence[at : at + size], now)[0][-1]
            before.append(now)
        back = np.ones(len(chain.start))
        for number in range(len(before) - 1, -1, -1):
            part = sequence[number * size : (number + 1) * size]
            back = self._add_part(chain, part, before[number], back)

    def _add_part(
        self, chain: Chain, part: np.ndarray, before: np.ndarray | None, back: np.ndarray
    ) -> np.ndarray:
        """Add a part that follows the forward value ``before``; what its first symbol hands back."""
        forward, scales = _forward(chain, part, before)
        self.log += float(np.log10(scales).sum())
        real = np.empty_like(forward)
        later = np.empty_like(forward)
        for t in range(len(part) - 1, -1, -1):
            real[t] = forward[t] * back
            later[t] = chain.emit[part[t]] * back / scales[t]
            back = chain.move @ later[t]
        if before is None:
            self.start += real[0]
            moved_from, moved_to = forward[:-1], later[1:]
        else:
            moved_from, moved_to = np.concatenate([before[None], forward[:-1]]), later
        self.move += chain.move * (moved_from.T @ moved_to)
        for state, weights in enumerate(real.T):
            self.emit[state] += np.bincount(part, weights=weights, minlength=self.emit.shape[1])
        return back

    def _add(self, chain: Chain, symbols: np.ndarray, going: np.ndarray) -> None:
        length, width = symbols.shape
        states = len(chain.start)
        each = np.ones(states)
        forward = np.zeros((length, width, states))
        scales = np.ones((length, width))
        weights = chain.emit[symbols]
        now = chain.start * weights[0]
        for t in range(length):
            n = going[t]
            if t:
                now = now[:n] @ chain.move
                now *= weights[t, :n]
            scales[t, :n] = now @ each
            now /= scales[t, :n, None]
            forward[t, :n] = now
        self.log += float(np.log10(scales).sum())
        # Emission times backward value over the scale, what a move into t is weighted by.
        weights /= scales[:, :, None]
        back = np.ones((going[-1], states))
        back_move = np.ascontiguousarray(chain.move.T)
        real = np.zeros((length, width, states))
        for t in range(length - 1, -1, -1):
            n = going[t]
            if len(back) < n:
                back = np.concatenate([back, np.ones((n - len(back), states))])
            np.multiply(forward[t, :n], back, out=real[t, :n])
            weights[t, n:] = 0
            weights[t, :n] *= back
            back = weights[t, :n] @ back_move
        self.start += real[0].sum(axis=0)
        before = forward[:-1].reshape(-1, states)
        self.move += chain.move * (before.T @ weights[1:].reshape(-1, states))
        flat = symbols.ravel()
        for state in range(states):
            share = np.ascontiguousarray(real[:, :, state]).ravel()
            self.emit[state] += np.bincount(flat, weights=share, minlength=self.emit.shape[1])

    def chain(self, shares: np.ndarray) -> Chain:
        """The next model: moves and starts with one more of each, emissions smoothed to ``shares``."""
        start = self.start + 1
        move = self.move + 1
        emit = self.emit + SMOOTHING * shares
        return Chain(
            start / start.sum(),
            move / move.sum(axis=1, keepdims=True),
            (emit / emit.sum(axis=1, keepdims=True)).T.copy(),
        )


def sequences_of(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(value, "<u2").astype(np.int64) for value in column.to_pylist()]


def _shares(vocabulary: Vocabulary) -> np.ndarray:
    """Shares of the symbols in the training tokens, none zero."""
    counts = np.ones(vocabulary.alphabet)
    counts[0] += vocabulary.ends
    counts[1 : 1 + vocabulary.symbols] += vocabulary.counts[: vocabulary.symbols]
    counts[1 + SYMBOLS :] += vocabulary.class_total
    return counts / counts.sum()


def _seeded(training: DataFrame, shares: np.ndarray, states: int) -> Chain:
    """A first model from a bounded sample of rows, on the driver.

    Rows are drawn by their number, so copies are drawn as often as they occur, and of a longer text a
    block that starts somewhere in it. The states start as random tilts of the shares that seldom change,
    so that a whole text falls to the state that suits it, which is what the first rounds make of them.
    """
    key = F.xxhash64("row")
    drawn = training.where(thinned(key, SEED_TEXTS, training.count())).limit(4 * SEED_TEXTS)
    spare = F.greatest(F.lit(1).cast("long"), F.col("n_tokens") - SEED_TOKENS + 1)
    first = (1 + 2 * F.pmod(F.xxhash64("row", F.lit(1)), spare)).cast("int")
    block = F.substring("symbols", first, F.lit(2 * SEED_TOKENS)).alias("symbols")
    sequences = sequences_of(drawn.select(block).toArrow()["symbols"].combine_chunks())
    sequences.sort(key=lambda s: s.tobytes())
    rng = np.random.default_rng(11)
    tilted = shares[:, None] * rng.gamma(2.0, 0.5, (len(shares), states))
    move = np.full((states, states), 0.05 / max(1, states - 1))
    np.fill_diagonal(move, 0.95 if states > 1 else 1.0)
    chain = Chain(np.full(states, 1 / states), move, tilted / tilted.sum(axis=0))
    for _ in range(SEED_ROUNDS):
        expected = Expected(states, len(shares))
        expected.add(chain, sequences)
        chain = expected.chain(shares)
    return chain


def _round(training: DataFrame, chain: Chain, shares: np.ndarray) -> tuple[Chain, float]:
    """One round of Baum-Welch over all training texts; partitions add up their expected counts.

    The next model, and the log10 likelihood of the texts under the given one.
    """
    states = len(chain.start)
    shared = training.sparkSession.sparkContext.broadcast(chain)
    sums = [f"s{i}" for i in range(states)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expected = Expected(states, len(shares))
        for batch in batches:
            expected.add(shared.value, sequences_of(batch.column("symbols")))
        seen = np.flatnonzero(expected.emit.any(axis=0))
        log = np.zeros(states)
        log[0] = expected.log
        table = np.concatenate([expected.emit[:, seen].T, expected.move, [expected.start, log]])
        # Moves have the numbers from -1 down, then come the start and the likelihood.
        number = np.concatenate([seen, -1 - np.arange(states + 2)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(number), *map(pa.array, table.T.copy())], ["number", *sums]
        )

    schema = "number long, " + ", ".join(f"{s} double" for s in sums)
    summed = (
        training.select("symbols")
        .mapInArrow(rows, schema)
        .groupBy("number")
        .agg(*[F.sum(s).alias(s) for s in sums])
        .toArrow()
    )
    expected = Expected(states, len(shares))
    number = summed["number"].to_numpy()
    table = np.stack([summed[s].to_numpy() for s in sums], axis=1)
    emitted = number >= 0
    expected.emit[:, number[emitted]] = table[emitted].T
    others = dict(zip((-1 - number[~emitted]).tolist(), table[~emitted], strict=True))
    for state in range(states):
        if state in others:
            expected.move[state] = others[state]
    expected.start = others.get(states, expected.start)
    return expected.chain(shares), float(others[states + 1][0]) if others else 0.0


def train(
    training: DataFrame,
    shares: np.ndarray,
    states: int,
    tokens: int,
    rounds: int = ROUNDS,
    settled: float = SETTLED,
) -> tuple[Chain, list[float]]:
    """A model after rounds over all ``training`` texts, and their likelihood before each round.

    Rounds end when one has gained less than ``settled`` digits for each of the ``tokens``, or after
    ``rounds``. ``training`` must be a table.
    """
    chain = _seeded(training, shares, states)
    logs: list[float] = []
    for _ in range(rounds):
        chain, log = _round(training, chain, shares)
        logs.append(log)
        if len(logs) > 1 and logs[-1] - logs[-2] < settled * tokens:
            break
    return chain, logs


def _tail_sums(encoded: DataFrame, counts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """For each row, log10(c + 1) summed over the training words of its tail, and their number.

    A word that a text repeats is one row here, however common it is in the text.
    """
    words = encoded.select("row", F.inline("tail"))
    tail = counts.where(vocabulary.is_tail(F.col("word"), F.col("n")))
    return (
        words.join(tail, "word")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("tail_log"),
            F.sum("times").alias("tail_known"),
        )
    )


def score(
    docs: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    states: int = STATES,
    rounds: int = ROUNDS,
    staging: Staging | None = None,
) -> DataFrame:
    """Learn from the rows of ``docs`` that are not ``held_out`` and score all of them.

    Columns, one row for each of ``docs``: ``doc_id``, ``held_out``, ``n_tokens`` and ``n_known`` (the end
    included), ``train_tokens``, ``base_score`` (log10 probability under the unigram model) and ``score``
    (under the hidden Markov model). A null text is empty: its end is all there is. A row whose
    ``held_out`` is null is trained on. Without training texts every symbol is as likely as any other. A
    text of any length is learned from and scored as a whole; it has to fit in a task. Repeated rows stay
    repeated and count as often, other columns are not looked at, and an empty table gives an empty result.
    """
    staging = staging or Staging(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    training = rows.where(~F.col("held_out"))
    counts = staging.table(word_counts(training), "words")
    vocabulary = _vocabulary(counts, training.count())
    encoded = staging.table(_encode(rows, vocabulary), "encoded")
    learned_from = encoded.where(~F.col("held_out"))
    shares = _shares(vocabulary)
    chain, _ = train(learned_from, shares, states, vocabulary.total, rounds)
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    @F.arrow_udf("double")
    def likelihood(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array(log10_likelihood(shared.value, sequences_of(column)), pa.float64())

    scored = encoded.select(
        "row",
        "doc_id",
        "held_out",
        "n_tokens",
        "known",
        "log_count",
        "log_class",
        likelihood("symbols").alias("chain_log"),
    )
    joined = scored.join(_tail_sums(encoded, counts, vocabulary), "row", "left")
    tail_log = F.coalesce("tail_log", F.lit(0.0))
    denominator = float(np.log10(float(vocabulary.total + vocabulary.distinct + 1)))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        (F.col("log_count") + tail_log - F.col("n_tokens") * denominator).alias("base_score"),
        (F.col("chain_log") + F.col("log_class") + tail_log).alias("score"),
    )
