"""Packing token sequences into windows, best fit first, longest piece first.

Tokens are made where the texts are read and only their place and length move on. Pieces are dealt by a
hash of their row's number into shards of a fixed expected size, each packed by one task.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tellerloom.functions.names import free_name, matching, ref
from tellerloom.llm.common import byte_strings, keyed_texts
from tellerloom.staging import Staging

WINDOW = 4096
# Pieces that one task packs, on average.
SHARD_PIECES = 1 << 16
# Words and pieces of words whose ids a task remembers before it starts anew, and the longest of them.
CACHE_ENTRIES = 1 << 19
CACHE_BYTES = 64

# Words of the letters of Latin-1 and printable ASCII, whose normal form is themselves, and how the
# vocabulary splits them once they are lower case.
PLAIN_WORD = re.compile("[!-~À-ÖØ-öø-ÿ]+")
PLAIN_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


class WordIds:
    """The ids of white-space separated words as little-endian 32-bit bytes.

    The vocabulary drops white space before it merges, so a text's ids are those of its words one
    after the other, and a word's those of its pieces. Each new piece is merged by the library; the
    library also splits the words that are not plain. The strings of its special tokens may span words, so
    the library takes a text that could hold one as a whole.
    """

    def __init__(self, tokenizer: Tokenizer):
        self.encode = tokenizer.encode
        added = tokenizer.get_added_tokens_decoder().values()
        if any(token.normalized for token in added):
            raise ValueError("special tokens that are found after normalisation are not supported")
        self.special = [token.content.encode() for token in added]
        self.normalize = tokenizer.normalizer.normalize_str
        self.split = tokenizer.pre_tokenizer.pre_tokenize_str
        self.merge = tokenizer.model.tokenize
        # Of words and of lower-case pieces; a piece by itself is split into itself.
        self.known: dict[bytes, bytes] = {}
        letters = [chr(c) for c in range(0xDF, 0x100) if c != 0xF7]
        self.as_bytes = str.maketrans({c: "".join(p for p, _ in self.split(c)) for c in letters})

    def remember(self, key: bytes, ids: bytes) -> bytes:
        if len(key) <= CACHE_BYTES:
            if len(self.known) >= CACHE_ENTRIES:
                self.known.clear()
            self.known[key] = ids
        return ids

    def merged(self, piece: str) -> bytes:
        tokens = [token.id for token in self.merge(piece)]
        return struct.pack(f"<{len(tokens)}I", *tokens)

    def lower_piece(self, piece: str) -> bytes:
        key = piece.encode()
        ids = self.known.get(key)
        if ids is None:
            ids = self.merged(piece if piece.isascii() else piece.translate(self.as_bytes))
            self.remember(key, ids)
        return ids

    def word(self, word: bytes) -> bytes:
        if word.isalpha():  # of ASCII letters alone
            return self.remember(word, self.lower_piece(word.lower().decode()))
        text = word.decode()
        if PLAIN_WORD.fullmatch(text):
            ids = [self.lower_piece(piece) for piece in PLAIN_PIECE.findall(text.lower())]
        else:
            ids = [self.merged(piece) for piece, _ in self.split(self.normalize(text))]
        return self.remember(word, b"".join(ids))

    def text(self, text: bytes) -> bytes:
        for mark in self.special:
            if mark in text:
                ids = self.encode(text.decode(), add_special_tokens=False).ids
                return np.array(ids, "<u4").tobytes()
        words = text.split()
        ids = list(map(self.known.get, words))
        if None in ids:
            ids = [
                self.word(word) if value is None else value
                for word, value in zip(words, ids, strict=True)
            ]
        return b"".join(ids)


@lru_cache(maxsize=2)
def _word_ids(vocabulary: bytes) -> WordIds:
    return WordIds(Tokenizer.from_buffer(vocabulary))


def pieces(
    docs: DataFrame,
    vocabulary_file: str,
    end_id: int = 2,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The ids of whole texts, each with ``end_id`` after it, cut into full windows and a rest.

    Columns: ``doc_id``, ``start``, ``length``, ``doc_tokens`` (long), ``ids`` (binary, little-endian
    32-bit). The ids are those that the tokenizers library gives without adding special tokens; where a
    text holds the string of one, that is its id. A null or empty text has the end alone. Null ids stay
    null, repeated rows stay repeated, other columns are not looked at, and an empty table gives an empty
    result. The vocabulary must be one that lower-cases and drops white space, like
    ``word_bpe_49k.json``; it is read where the driver runs and sent to the tasks.
    """
    with open(vocabulary_file, "rb") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())
    end = np.array([end_id], "<u4").tobytes()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(vocabulary.value)
        for batch in batches:
            texts = byte_strings(batch.column("text"))
            row, start, total, ids = [], [], [], []
            for number, text in enumerate(texts):
                tokens = words.text(text) + end
                count = len(tokens) // 4
                for at in range(0, count, window):
                    row.append(number)
                    start.append(at)
                    total.append(count)
                    ids.append(tokens[4 * at : 4 * (at + window)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row, pa.int64())),
                    pa.array(start, pa.int64()),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(total, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                ["doc_id", "start", "length", "doc_tokens", "ids"],
            )

    schema = "doc_id long, start long, length long, doc_tokens long, ids binary"
    return keyed_texts(docs, id_col, text_col).mapInArrow(rows, schema)


class OpenWindows:
    """Open windows under a segment tree over the remaining capacity.

    A leaf holds the windows with exactly that much room; a node tells whether any leaf below it
    holds one.
    """

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.any = bytearray(2 * self.leaves)
        self.held: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, room: int, window: int) -> None:
        self.held[room].append(window)
        node = room + self.leaves
        while node and not self.any[node]:
            self.any[node] = 1
            node >>= 1

    def tightest(self, length: int) -> int | None:
        """The least room of at least ``length`` that some window has."""
        node = length + self.leaves
        if not self.any[node]:
            # Up to the first subtree to the right that holds a window, then down its left edge.
            while node > 1 and (node & 1 or not self.any[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node <<= 1
                if not self.any[node]:
                    node += 1
        return node - self.leaves

    def take(self, room: int) -> int:
        window = self.held[room].pop()
        node = room + self.leaves
        if not self.held[room]:
            self.any[node] = 0
            node >>= 1
            while node and not (self.any[2 * node] or self.any[2 * node + 1]):
                self.any[node] = 0
                node >>= 1
        return window


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Window number and offset of each piece; ``lengths`` must not increase."""
    open_windows = OpenWindows(window)
    numbers, offsets, opened = [], [], 0
    for length in lengths:
        room = open_windows.tightest(length)
        if room is None:
            room, number, opened = window, opened, opened + 1
        else:
            number = open_windows.take(room)
        numbers.append(number)
        offsets.append(window - room)
        if room > length:
            open_windows.put(room - length, number)
    return numbers, offsets


def pack(
    cut: DataFrame, window: int = WINDOW, staging: Staging | None = None
) -> DataFrame:
    """``cut`` with ``sequence_id`` and ``offset``: no window over ``window``, offsets without gaps.

    ``cut`` needs ``doc_id``, ``start`` and ``length`` (1 to ``window``); other columns of plain types
    are carried along, so leave the ids behind, but none may be called like the two that are added. Equal
    lengths are taken by id and start. Sequence ids are unique; they number the windows of all shards in
    turn. Repeated rows are pieces like all others, in any shard, and an empty table gives an empty result.
    """
    taken = [name for name in ("sequence_id", "offset") if matching(cut, name)]
    if taken:
        raise ValueError(f"{taken} are the names of the columns that packing adds")
    staging = staging or Staging(cut.sparkSession)
    row, shard_col = free_name(cut, "_row"), free_name(cut, "_shard")
    # The number is stored with the row, so a repeated task deals it to the same shard.
    numbered = cut.withColumn(row, F.monotonically_increasing_id())
    placed, count = staging.counted(numbered, "pieces")
    shards = max(1, -(-count // SHARD_PIECES))
    key = F.pmod(F.xxhash64(ref(row)), F.lit(shards)).cast("int")

    def packed(group: pd.DataFrame) -> pd.DataFrame:
        shard = int(group[shard_col].iloc[0])
        group = group.sort_values(
            ["length", "doc_id", "start"], ascending=[False, True, True], kind="stable"
        )
        numbers, offsets = best_fit(group["length"].tolist(), window)
        return group.drop(columns=shard_col).assign(
            sequence_id=np.array(numbers, np.int64) * shards + shard,
            offset=np.array(offsets, np.int64),
        )

    names = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in cut.schema.fields]
    return (
        placed.withColumn(shard_col, key)
        .drop(row)
        .groupBy(ref(shard_col))
        .applyInPandas(packed, ", ".join([*names, "sequence_id long", "offset long"]))
    )
