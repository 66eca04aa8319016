"""Periodic runs in the words of texts, found in a grammar of each text.

A run is a stretch of consecutive words with smallest period q and length at least max(6, 4 q) that no
neighbouring word extends keeping period q. The words of a text are compressed by Re-Pair: a pair of
symbols that occurs at least twice becomes a nonterminal, the more frequent of overlapping pairs first,
until no pair repeats. What is left of the text is halved again and again, so every run lies, within the
smallest nonterminal or half around it, across the border between its two sides. Each border is therefore
examined once, at one occurrence; what is found is translated to all places where the symbol was derived,
and stretches of one period that belong together are merged to maximal ones.

Texts are independent, so a task takes many at once into the same arrays, each with word numbers and
symbols of its own. Nothing is shuffled. What a task holds is about 200 bytes a word of one part of a
batch, at least of the longest text.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerloom.llm.common import byte_strings, keyed_texts

LEAST_WORDS = 6
LEAST_EXPONENT = 4
# Words that are searched at once; a longer text is searched by itself.
CHUNK_WORDS = 1 << 19
# Periods up to here are compared at all borders at once, longer ones from one equal word to the next.
SHORT_PERIOD = 16
# Places beside an equal pair of words that have to be equal too, on one side, in a run of a long period.
PROBES = (1, 2, 3, 5, 9, 17, 25)

WORD = r"[^\x20\x09-\x0D]+"
RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers that no two texts share, the first word of each text, next and last equal words.

    The next equal word of the last is the number of all words, the last of the first is -1.
    """
    known: dict[bytes, int] = defaultdict(count().__next__)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    total = int(sizes.sum())
    words = np.fromiter((known[w] for words in texts for w in words), np.int64, total)
    starts = np.cumsum(sizes) - sizes
    words += np.repeat(np.arange(len(texts)) * len(known), sizes)
    order = np.argsort(words, kind="stable")
    ordered = words[order]
    new = np.ones(total, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    dense = np.empty(total, np.int64)
    dense[order] = np.cumsum(new) - 1
    after, before = np.full(total, total), np.full(total, -1)
    same = ~new[1:]
    after[order[:-1][same]] = order[1:][same]
    before[order[1:][same]] = order[:-1][same]
    return dense, starts, after, before


class Grammar:
    """Re-Pair of several texts at once, none sharing a symbol with another.

    ``start``, ``middle`` and ``end`` are the words of one occurrence of each nonterminal, then of each
    half of what was left. ``symbol`` and ``place`` are all occurrences of nonterminals.
    """

    def __init__(self, words: np.ndarray, starts: np.ndarray):
        total = len(words)
        self.last = np.zeros(total, bool)
        self.last[starts[starts > 0] - 1] = True
        self.last[-1:] = True
        self.symbols = words.copy()
        self.at = np.append(np.arange(total), total)
        # A pair that was found once stays single as long as its symbols stay.
        self.open = ~self.last
        self.first_symbol = self.symbol_count = int(words.max(initial=-1)) + 1
        self.borders: list[np.ndarray] = []
        self.symbol: list[np.ndarray] = []
        self.place: list[np.ndarray] = []
        while self._replaced():
            pass
        self.nonterminals = self.symbol_count - self.first_symbol
        self._halve()
        self.start, self.middle, self.end = np.concatenate(self.borders, axis=1)
        none = [np.zeros(0, np.int64)]
        self.symbol, self.place = (np.concatenate(x or none) for x in (self.symbol, self.place))

    def _replaced(self) -> bool:
        """Replace each pair, if it repeats, where it is more frequent than those it overlaps."""
        pairs = np.flatnonzero(self.open)
        if not len(pairs):
            return False
        codes = self.symbols[pairs] * self.symbol_count + self.symbols[pairs + 1]
        kinds, kind = np.unique(codes, return_inverse=True)
        beside = np.diff(pairs) == 1
        # Within a stretch of one symbol, every other pair.
        chained = np.zeros(len(pairs), bool)
        chained[1:] = beside & (kind[1:] == kind[:-1])
        place = np.arange(len(pairs))
        since = place - np.maximum.accumulate(np.where(chained, 0, place))
        usable = since % 2 == 0
        counts = np.bincount(kind[usable], minlength=len(kinds))
        repeated = counts[kind] >= 2
        self.open[pairs[~repeated]] = False
        rank = np.where(usable & repeated, counts[kind] * len(kinds) + kind, -1)
        best = rank >= 0
        best[1:] &= ~beside | (rank[1:] > rank[:-1])
        best[:-1] &= ~beside | (rank[:-1] > rank[1:])
        # A pair of which only one place is left would gain nothing. The most frequent keeps all of its.
        kept = np.bincount(kind[best], minlength=len(kinds)) >= 2
        best &= kept[kind]
        chosen, kind = pairs[best], kind[best]
        if not len(chosen):
            return False
        number = self.symbol_count + np.cumsum(kept) - 1
        first = np.empty(len(kinds), np.int64)
        first[kind[::-1]] = chosen[::-1]
        first = first[kept]
        self.borders.append(np.stack([self.at[first], self.at[first + 1], self.at[first + 2]]))
        self.symbol.append(number[kind])
        self.place.append(self.at[chosen])
        self.symbol_count += int(kept.sum())
        self.symbols[chosen] = number[kind]
        self.last[chosen] = self.last[chosen + 1]
        self.open[chosen] = True
        self.open[np.maximum(chosen - 1, 0)] = True
        left = np.ones(len(self.symbols), bool)
        left[chosen + 1] = False
        self.symbols, self.last, self.open = self.symbols[left], self.last[left], self.open[left]
        self.open &= ~self.last
        self.at = np.append(self.at[:-1][left], self.at[-1])
        return True

    def _halve(self) -> None:
        """Borders between the symbols left in each text, as those of a balanced tree over them."""
        n = len(self.symbols)
        ends = np.flatnonzero(self.last) + 1
        starts = np.concatenate(([0], ends[:-1])).astype(np.int64)[: len(ends)]
        index = np.arange(n)
        text = np.searchsorted(ends, index, side="right")
        within = index - starts[text]
        index, within, text = index[within > 0], within[within > 0], text[within > 0]
        half = within & -within
        right = np.minimum(index + half, ends[text])
        self.borders.append(np.stack([self.at[index - half], self.at[index], self.at[right]]))


def _short_runs(words: np.ndarray, grammar: Grammar) -> tuple[np.ndarray, ...]:
    """Border, first word, last word and period of the runs of short periods across each border."""
    found = []
    size = grammar.end - grammar.start
    for period in range(1, SHORT_PERIOD + 1):
        least = max(LEAST_WORDS, LEAST_EXPONENT * period)
        border = np.flatnonzero(size >= least)
        if not len(border):
            break
        equal = words[period:] == words[:-period]
        unequal = None
        start, middle, end = grammar.start[border], grammar.middle[border], grammar.end[border]
        # Of the words of a run that equal those a period later, one of these two is the first.
        for place in (middle - 1, middle - period):
            hit = np.flatnonzero((place >= start) & (place + period < end))
            hit = hit[equal[place[hit]]]
            if not len(hit):
                continue
            if unequal is None:
                unequal = np.flatnonzero(~equal)
                unequal = np.concatenate(([-1], unequal, [len(equal)]))
            after = np.searchsorted(unequal, place[hit])
            first = np.maximum(unequal[after - 1] + 1, start[hit])
            last = np.minimum(unequal[after] - 1, end[hit] - 1 - period) + period
            long = last - first + 1 >= least
            found.append(
                np.stack(
                    [border[hit][long], first[long], last[long], np.full(long.sum(), period)]
                )
            )
    return tuple(np.concatenate(found, axis=1)) if found else (np.zeros(0, np.int64),) * 4


def _candidates(
    words: np.ndarray, after: np.ndarray, before: np.ndarray, grammar: Grammar, longest: np.ndarray
) -> np.ndarray:
    """Border and long period where a word beside the border, and others near it, are equal a period on."""
    total = len(words)
    found = []
    for chain, step in ((after, 1), (before, -1)):
        border = np.flatnonzero(longest > SHORT_PERIOD)
        origin = grammar.middle[border] - (step > 0)
        current = chain[origin]
        while len(border):
            period = (current - origin) * step
            inside = (current < grammar.end[border]) & (current >= grammar.start[border])
            going = inside & (period <= longest[border])
            border, origin, current, period = (
                x[going] for x in (border, origin, current, period)
            )
            place = np.minimum(origin, current)
            start, end = grammar.start[border], grammar.end[border]
            likely = np.zeros(len(border), bool)
            for side in (1, -1):
                held = np.flatnonzero(period > SHORT_PERIOD)
                for probe in (*PROBES, period):
                    offset = probe[held] if probe is period else probe
                    near = place[held] + side * offset
                    ok = (near >= start[held]) & (near + period[held] < end[held])
                    near = np.clip(near, 0, total - 1)
                    ok &= words[near] == words[np.minimum(near + period[held], total - 1)]
                    held = held[ok]
                likely[held] = True
            found.append(np.stack([border[likely], period[likely], place[likely]]))
            current = chain[current] if len(current) else current
    return np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)


def _equal(left: np.ndarray, right: np.ndarray) -> int:
    """Number of equal leading elements."""
    n, at, size = min(len(left), len(right)), 0, 64
    while at < n:
        to = min(at + size, n)
        differ = left[at:to] != right[at:to]
        first = int(differ.argmax())
        if differ[first]:
            return at + first
        at, size = to, 2 * size
    return n


def _long_runs(
    words: np.ndarray,
    after: np.ndarray,
    before: np.ndarray,
    grammar: Grammar,
    short: tuple[np.ndarray, ...],
) -> tuple[np.ndarray, ...]:
    """Like ``_short_runs`` for all longer periods.

    Two different runs across a border share fewer words than the sum of their periods. So after a run
    with period p is found, one of a longer period q has over 2 q words beside it.
    """
    longest = (grammar.end - grammar.start) // LEAST_EXPONENT
    border, first, last, _ = short
    rest = grammar.end[border] - grammar.start[border] - (last - first + 1)
    np.minimum.at(longest, border, (rest - 1) // 2)
    border, period, place = _candidates(words, after, before, grammar, longest)
    found = []
    for i in np.lexsort((place, period, border)).tolist():
        b, q, a = int(border[i]), int(period[i]), int(place[i])
        if q > longest[b]:
            continue
        start, end = int(grammar.start[b]), int(grammar.end[b])
        right = _equal(words[a : end - q], words[a + q : end])
        left = _equal(words[start:a][::-1], words[start + q : a + q][::-1])
        if left + right + q >= LEAST_EXPONENT * q:
            found.append((b, a - left, a + right + q - 1, q))
            longest[b] = min(longest[b], (end - start - (left + right + q) - 1) // 2)
    return tuple(np.array(found, np.int64).reshape(-1, 4).T)


def _everywhere(grammar: Grammar, found: np.ndarray) -> np.ndarray:
    """First word, last word and period of what was ``found``, at all places of its symbol."""
    border, first, last, period = found
    derived = border < grammar.nonterminals
    whole = found[1:, ~derived]
    border, first, last, period = found[:, derived]
    wanted = np.zeros(grammar.nonterminals, bool)
    wanted[border] = True
    number = grammar.symbol - grammar.first_symbol
    use = wanted[number]
    number, place = number[use], grammar.place[use]
    order = np.argsort(number, kind="stable")
    number, place = number[order], place[order]
    low, high = np.searchsorted(number, border), np.searchsorted(number, border, side="right")
    copies = high - low
    run = np.repeat(np.arange(len(border)), copies)
    at = np.arange(len(run)) - np.repeat(np.cumsum(copies) - copies, copies) + low[run]
    shift = place[at] - grammar.start[border[run]]
    return np.concatenate(
        [whole, np.stack([first[run] + shift, last[run] + shift, period[run]])], axis=1
    )


def _maximal(found: np.ndarray) -> np.ndarray:
    """Stretches of one period that share a period of words merged, each with its smallest period.

    Ordered by first word, then period.
    """
    first, last, period = found[:, np.lexsort((-found[1], found[0], found[2]))]
    if not len(first):
        return found
    # Periods one after the other, so a running maximum of last words starts anew with each.
    shift = np.cumsum(np.concatenate(([False], period[1:] != period[:-1]))) * (last.max() + 2)
    reach = np.maximum.accumulate(last + shift)
    new = np.ones(len(first), bool)
    new[1:] = first[1:] + shift[1:] + period[1:] > reach[:-1] + 1
    group = np.flatnonzero(new)
    last = np.maximum.reduceat(last, group)
    first, period = first[group], period[group]
    order = np.lexsort((period, last, first))
    first, last, period = first[order], last[order], period[order]
    new = np.ones(len(first), bool)
    new[1:] = (first[1:] != first[:-1]) | (last[1:] != last[:-1])
    first, last, period = first[new], last[new], period[new]
    return np.stack([first, last, period])[:, np.lexsort((period, first))]


def runs_of(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """First word, last word and period of all runs, over the words of all texts one after the other.

    The second array has the first word of each text.
    """
    words, starts, after, before = _numbered(texts)
    if not len(words):
        return np.zeros((3, 0), np.int64), starts
    grammar = Grammar(words, starts)
    short = _short_runs(words, grammar)
    long = _long_runs(words, after, before, grammar, short)
    found = np.concatenate([np.stack(short), np.stack(long)], axis=1)
    return _maximal(_everywhere(grammar, found)), starts


def _searched(ids: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
    (first, last, period), starts = runs_of(texts)
    total = sum(map(len, texts))
    text = np.searchsorted(starts, first, side="right") - 1
    # Texts without words start where the next one does.
    bounds = np.searchsorted(first, np.append(starts, total))
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, first + period, 1)
    np.add.at(change, last + 1, -1)
    kept = np.cumsum(change[:-1]) == 0
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    changed = np.zeros(len(texts), bool)
    changed[text] = True
    collapsed = []
    for words, start, differs in zip(texts, starts.tolist(), changed.tolist(), strict=True):
        if differs:
            words = [words[i] for i in np.flatnonzero(kept[start : start + len(words)]).tolist()]
        collapsed.append(b" ".join(words))
    entries = pa.StructArray.from_arrays(
        [pa.array(first - starts[text]), pa.array(last - first + 1), pa.array(period)],
        ["start", "length", "period"],
    )
    runs = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), entries)
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(sizes), runs, pa.array(collapsed, pa.binary())],
        ["doc_id", "n_words", "runs", "collapsed"],
    )


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` and ``collapsed`` (string), one row for each of ``docs``.

    Words end at ASCII white space and are numbered from 0. ``runs`` has ``start``, ``length`` and
    ``period`` of every run of the whole text by start, then period. ``collapsed`` is the words joined by
    one space, without those that some run has after its first period. Null texts have no words, like empty
    ones: no runs and an empty ``collapsed``. Null ids stay null, repeated rows stay repeated, other
    columns are not looked at, and an empty table gives an empty result.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[list[bytes]] = []
            size = start = 0
            for i, text in enumerate(byte_strings(batch.column("text"))):
                texts.append(text.split())
                size += len(texts[-1])
                if size >= CHUNK_WORDS or i + 1 == batch.num_rows:
                    yield _searched(batch.column("doc_id")[start : i + 1], texts)
                    texts, size, start = [], 0, i + 1

    found = keyed_texts(docs, id_col, text_col).mapInArrow(rows, RUNS)
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def repeated(
    docs: DataFrame, number: Column, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id`` and ``text``, which repeats from some word on if ``number`` is a multiple of ten.

    With g a tenth of the number, from word a = g % n on the words are those of a, a + 1, ... over and
    over, in 1 + (n - a) / (3 + g % 8) words, rounded down. Other texts, those without words, and those
    whose number is null stay.
    """
    # Words and places are columns, so that each is found once a row.
    chosen = F.when(number % 10 == 0, F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0)))
    split = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        F.floor(number / 10).alias("tenth"),
        chosen.alias("words"),
    )
    placed = split.withColumn("n", F.size("words")).withColumn(
        "start", F.when(F.col("n") > 0, F.col("tenth") % F.col("n")).cast("int")
    )
    rest = F.col("n") - F.col("start")
    placed = placed.withColumn("period", (1 + F.floor(rest / (3 + F.col("tenth") % 8))).cast("int"))
    block = F.slice("words", F.col("start") + 1, F.col("period"))
    times = F.ceil(rest / F.col("period")).cast("int")
    changed = F.concat(
        F.slice("words", F.lit(1), F.col("start")),
        F.slice(F.flatten(F.array_repeat(block, times)), F.lit(1), rest),
    )
    text = F.when(F.col("n") > 0, F.array_join(changed, " ")).otherwise(F.col("text"))
    return placed.select("doc_id", text.alias("text"))
