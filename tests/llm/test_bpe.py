import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from pledgemart.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
TRUE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
SOME = ["the ", "nttionti", "  ", "\n\n", "AAAA", "é", "漢字", "\U0001f600", "'ll", "12345", " !!", "\t", "x" * 40, "<|endoftext|>", "nti", "ering"]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.lists(st.sampled_from(SOME), max_size=12).map("".join))
def test_encodes_and_decodes_as_the_library_does(text):
    assert ENCODER.encode(text) == TRUE.encode_ordinary(text)
    assert ENCODER.decode(ENCODER.encode(text)) == text.encode()


COLUMN = bpe.Column(RANKS, public_tokenizers.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.none() | st.text(max_size=60) | st.lists(st.sampled_from([*SOME, "=" * 70, " " * 130]), max_size=12).map("".join), max_size=6))
def test_columns_are_encoded_as_the_library_does(texts):
    assert COLUMN.encode(pa.array(texts, pa.string())).to_pylist() == [TRUE.encode_ordinary(t or "") for t in texts]


def test_columns_of_ids_are_decoded():
    texts = ["", "one é漢字", None, "two " * 50]
    ids = pa.array([None if t is None else TRUE.encode_ordinary(t) for t in texts], pa.list_(pa.int32()))
    made = bpe.Bytes(RANKS)
    assert made.of(ids).to_pylist() == [None if t is None else t.encode() for t in texts]
    assert made.of(ids.slice(1, 2)).to_pylist() == [texts[1].encode(), None]
    with pytest.raises(ValueError):
        made.of(pa.array([[50256]], pa.list_(pa.int32())))


def test_a_piece_that_is_a_token_is_that_token():
    """Also where merging leads elsewhere, in short and in long pieces, but not within a piece."""
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 256, b"ab": 257, b"abc": 300, b"xy" * 50: 301, b"xy": 258, b"yx": 259}
    true = tiktoken.Encoding("odd", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    column = bpe.Column(ranks, public_tokenizers.PATTERN)
    for texts in (["abc", "abcq", "abc abc", "qabc", "xy" * 50, "xy" * 51, "xy" * 50 + "1abc"], ["abc"], ["xy" * 50]):
        assert column.encode(pa.array(texts)).to_pylist() == [true.encode_ordinary(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=40))
def test_any_bytes_of_one_piece(raw):
    assert bpe.Prefixes(ENCODER.vocabulary, raw).ids() == TRUE._core_bpe.encode_single_piece(raw) or raw in RANKS


def test_neighbours_are_those_that_merging_leaves_apart():
    rng, vocabulary = random.Random(6), ENCODER.vocabulary
    usual = [r for r, t in vocabulary.tokens.items() if t.isalpha() and len(t) < 5]
    for _ in range(60000):
        a, b = rng.choice(usual), rng.choice(usual if rng.random() < 0.8 else list(vocabulary.tokens)[:3000])
        raw = vocabulary.tokens[a] + vocabulary.tokens[b]
        assert vocabulary.pair(a, b) == (vocabulary.merges(raw)[0] == [vocabulary.tokens[a], vocabulary.tokens[b]])
    for text in ("aaaaaaa", "abababab", "      ", "\n\n\n\n\n", "========="):
        for n in range(1, 40):
            raw = (text * n)[: 3 * n].encode()
            assert ENCODER.piece(raw) == tuple(TRUE._core_bpe.encode_single_piece(raw))
            assert raw in RANKS or bpe.Prefixes(vocabulary, raw).ids() == list(ENCODER.piece(raw))


def test_every_prefix_and_every_append_is_exact():
    raw = ("transformation" * 3 + "ereringthe").encode()
    grown = bpe.Prefixes(ENCODER.vocabulary)
    for i in range(len(raw)):
        grown.append(raw[i : i + 1])
        assert grown.ids() == TRUE._core_bpe.encode_single_piece(raw[: i + 1]) or raw[: i + 1] in RANKS


def test_edits_are_exact_and_local():
    rng = random.Random(3)
    raw = "".join(rng.choice(["ab", "tion", "er", "zz", "the"]) for _ in range(400)).encode()
    for _ in range(60):
        piece = bpe.Prefixes(ENCODER.vocabulary, raw)
        a = rng.randrange(len(raw))
        b = min(len(raw), a + rng.randrange(6))
        by = rng.choice([b"", b"x", b"ations", b"qq"])
        made = piece.replace(a, b, by)
        assert piece.raw == raw[:a] + by + raw[b:]
        assert piece.last == bpe.Prefixes(ENCODER.vocabulary, piece.raw).last
    assert bpe.Prefixes(ENCODER.vocabulary, raw).replace(10, 11, b"q") <= 4 * ENCODER.vocabulary.longest


def test_text_edits_are_exact():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice(SOME) for _ in range(rng.randrange(14)))
        edited = bpe.Text(ENCODER, text)
        for _ in range(3):
            a = rng.randint(0, len(edited.text))
            b = min(len(edited.text), a + rng.randrange(5))
            edited.replace(a, b, rng.choice(["", " ", "\n", "a", "'s", "9 ", *SOME]))
            edited.append(rng.choice(SOME))
            assert edited.ids() == TRUE.encode_ordinary(edited.text)
    long = bpe.Text(ENCODER, "many plain words " * 500)
    assert long.replace(3000, 3001, "X") < 10 and long.ids() == TRUE.encode_ordinary(long.text)


def digests(text):
    ids = TRUE.encode_ordinary(text or "")
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    return len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode())


@pytest.mark.parametrize("name", ["given", "awkward"])
def test_query_matches_the_library(spark, documents, awkward, name):
    from pledgemart.llm.queries import op2_frame

    docs = documents if name == "given" else awkward
    got = sorted(tuple(r) for r in op2_frame(docs).drop("doc_id").collect())
    texts = [r[docs.columns.index("text")] for r in docs.collect()]
    assert got == sorted(map(digests, texts))
    assert op2_frame(docs.limit(0)).count() == 0
