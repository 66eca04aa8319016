import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tellerloom.llm import bpe
from tellerloom.llm.queries import QUERIES
from tests.llm.odd import TEXTS, no_documents, odd_documents

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        pairs = [line.split() for line in file]
    ranks = {base64.b64decode(a): int(b) for a, b in pairs}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_query_is_what_the_library_gives(spark, library):
    folder = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in QUERIES["op5_byte_bpe"](spark, folder).collect()}
    for doc in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = library.encode_ordinary(doc.text)
        row = found[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(doc.text.encode()).hexdigest()


@pytest.mark.parametrize(
    "text",
    [
        "it's 12's we're!'s don't'll " * 50,
        "a" * 500 + "1" * 500 + "!" * 500 + " " * 500 + "\n" * 50 + "x",
        "ab1'c!'re  été 日本語のテキスト١٢٣ 🙂🙂" * 40,
        "''''s's''s1's !'s \t\t x",
    ],
)
def test_parts_give_the_ids_of_the_whole(library, text):
    for size in (1, 2, 7, 64):
        parts = list(bpe.safe_parts(text, size))
        assert "".join(parts) == text
        assert sum(map(library.encode_ordinary, parts), []) == library.encode_ordinary(text)


def of_parts(library, parts):
    ids = []
    for part, single in parts:
        ids += library._encode_single_piece(part.encode()) if single else library.encode_ordinary(part)
    return ids


def test_white_space_of_some_length_gives_the_ids_of_the_whole(library):
    rng = random.Random(3)
    for _ in range(400):
        runs = ["".join(rng.choices(" \n\t\u3000\x1c\u0085", k=rng.randint(1, 12))) for _ in range(5)]
        words = [rng.choice(["", "a", "it's", "'s", "9", "!?", "é", "日本", "\x1c"]) for _ in range(6)]
        text = "".join(w + r for w, r in zip(words, [*runs, ""], strict=True))
        for size in (1, 2, 5, 9):
            parts = list(bpe.matched_parts(text, size))
            assert "".join(part for part, _ in parts) == text
            assert of_parts(library, parts) == library.encode_ordinary(text)


@pytest.mark.parametrize("space", [" ", "\n", "\u3000"])
def test_white_space_of_any_length(spark, library, space):
    """Runs that the library can't match, at the start, in the middle and at the end of a text."""
    n = 1_000_000
    texts = {
        1: space * n + "x",
        2: "it's" + space * n + "'s 9",
        3: "a b" + space * n,
        4: space * 10 * n,
        5: "a" + space * n + "b" + space * n + " c",
    }
    single = library._encode_single_piece
    short = library.encode_ordinary

    def run(length):
        return single((space * length).encode())

    tails = {1: short(space + "x"), 2: short(space + "'s 9"), 3: []}
    want = {
        1: run(n - 1) + tails[1],
        2: short("it's") + run(n - 1) + tails[2],
        3: short("a b") + run(n),
        4: run(10 * n),
        # The last run ends with a space that goes with the letter.
        5: short("a") + run(n - 1) + short(space + "b") + run(n) + short(" c"),
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS)
    sums = rows.selectExpr(
        "doc_id", "size(ids) AS n", "sha2(decoded, 256) AS bytes",
        "sha2(array_join(cast(ids AS array<string>), ','), 256) AS ids",
    ).collect()
    assert len(sums) == len(texts)
    for row in sums:
        ids = want[row.doc_id]
        assert row.n == len(ids)
        assert row.ids == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.bytes == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_the_known_pattern_is_the_given_one():
    assert bpe.PATTERN == public_tokenizers.PATTERN


def test_other_patterns_see_whole_texts(spark):
    pattern = r"\p{L}+\s*|\P{L}+"
    with open(RANKS, "rb") as file:
        pairs = [line.split() for line in file]
    ranks = {base64.b64decode(a): int(b) for a, b in pairs}
    plain = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    text = "abc \n\n" * 30_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert bpe.encode(docs, RANKS, pattern).first().ids == plain.encode_ordinary(text)


def test_odd_rows(spark, library):
    encoded = bpe.encode(odd_documents(spark), RANKS, public_tokenizers.PATTERN)
    rows = bpe.decode(encoded, RANKS).collect()
    got = sorted((str(r.doc_id), list(r.ids), bytes(r.decoded)) for r in rows)
    want = [(str(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t in TEXTS]
    assert got == sorted(want)
    nothing = bpe.encode(no_documents(spark), RANKS, public_tokenizers.PATTERN)
    assert bpe.decode(nothing, RANKS).count() == 0
