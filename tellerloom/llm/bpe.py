"""Byte-level BPE by a rank file, with the tiktoken library inside the tasks.

Long texts are cut where no match of the splitting pattern can span the cut, which is known for one
pattern. White space needs a cut of its own: that pattern takes a run of it as one match, less the last
character if a text follows, and the library's matcher, which would take back character by character,
ends in an error from about a million on. A long run is therefore cut out as the pattern would match it
and merged as one piece.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerloom.llm.common import list_slices

# Code points beyond which a text is encoded in parts, and white space is cut out of it.
LONG = 1 << 16
# Fixed value: the pattern whose cuts are known. Texts are encoded whole under any other.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Places that no match of that pattern can span: after a letter, number or symbol where another kind
# of character follows. An apostrophe may belong to the letters after it.
SAFE = regex.compile(
    r"(?<=\p{L})(?=\P{L})|(?<=\p{N})(?=\P{N})|(?<=[^\s\p{L}\p{N}'])(?=[\s\p{L}\p{N}])"
)


@lru_cache(maxsize=2)
def _encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    pairs = (line.split() for line in ranks.splitlines() if line)
    return tiktoken.Encoding(
        "ranks",
        pat_str=pattern,
        mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs},
        special_tokens={},
    )


def safe_parts(text: str, size: int = LONG) -> Iterator[str]:
    """``text`` in parts of about ``size`` code points, cut only where no match can span the cut."""
    start = 0
    while len(text) - start > size:
        found = SAFE.search(text, start + size)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text


@lru_cache(maxsize=4)
def _white_space(size: int) -> regex.Pattern:
    return regex.compile(r"\s{%d,}" % size)


def matched_parts(text: str, size: int = LONG) -> Iterator[tuple[str, bool]]:
    """``text`` in parts, each with whether it is a single match: white space of over ``size`` code points.

    The parts' matches one after the other are those of the text. A run of white space starts a match,
    since none has white space after another character. Its last character goes with what follows.
    """
    if len(text) <= size:
        yield text, False
        return
    start = 0
    for run in _white_space(size + 2).finditer(text):
        if run.start() > start:
            yield from ((part, False) for part in safe_parts(text[start : run.start()], size))
        start = run.end() if run.end() == len(text) else run.end() - 1
        yield text[run.start() : start], True
    if start < len(text):
        yield from ((part, False) for part in safe_parts(text[start:] if start else text, size))


def encode(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id`` and the token ``ids`` (array<int>) of the whole text, one row for each of ``docs``.

    Each match of ``pattern`` is merged separately and no special token is recognised. Null texts
    give no ids, like empty ones; a row without an id keeps its null, repeated rows stay repeated, an
    empty table gives an empty result and columns beyond the two are not looked at. The rank file is
    read where the driver runs and sent to the tasks; its size is that of the vocabulary.

    Under PATTERN texts of any length are encoded, white space of any length included; a text and its ids
    have to fit in a task. Any other ``pattern`` is matched against whole texts, since its cuts are not
    known; how long they may be is then the library's limit.
    """
    with open(rank_file, "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(ranks.value, pattern)
        for batch in batches:
            parts, ends = [], [0]
            for text in batch.column("text").to_pylist():
                text = text or ""
                cut = matched_parts(text) if pattern == PATTERN else [(text, False)]
                for part, single in cut:
                    if single:
                        ids = encoding._encode_single_piece(part.encode())
                    else:
                        ids = encoding.encode_ordinary(part)
                    parts.append(np.array(ids, np.int32))
                ends.append(len(parts))
            lengths = np.cumsum([0, *map(len, parts)])
            ids = pa.ListArray.from_arrays(
                pa.array(lengths[ends], pa.int32()),
                pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int32)),
            )
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return texts.mapInArrow(rows, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, rank_file: str) -> DataFrame:
    """``encoded`` (``doc_id``, ``ids``) with the ``decoded`` bytes of the ids; null ids give none.

    The bytes are those of the tokens, whether or not they are valid UTF-8. Repeated rows stay repeated,
    other columns are left out, an empty table gives an empty result.
    """
    with open(rank_file, "rb") as file:
        ranks = encoded.sparkSession.sparkContext.broadcast(file.read())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(ranks.value)
        for batch in batches:
            column = batch.column("ids")
            values, offsets = list_slices(column)
            texts = [
                b"".join(map(tokens.__getitem__, values[start:end].tolist()))
                for start, end in zip(offsets, offsets[1:], strict=False)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), column, pa.array(texts, pa.binary())],
                ["doc_id", "ids", "decoded"],
            )

    ids = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return ids.mapInArrow(rows, "doc_id long, ids array<int>, decoded binary")


@lru_cache(maxsize=2)
def _tokens(ranks: bytes) -> dict[int, bytes]:
    pairs = (line.split() for line in ranks.splitlines() if line)
    return {int(rank): base64.b64decode(token) for token, rank in pairs}
