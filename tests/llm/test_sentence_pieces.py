import hashlib
import random

import pyarrow as pa
import pytest
import public_tokenizers
import sentencepiece
from hypothesis import given, settings, strategies as st

from pledgemart.llm import queries, sentence_pieces
from pledgemart.llm.prefix_table import LONG

PATH = public_tokenizers.path("piece_bpe_32k.model")
TRUE = sentencepiece.SentencePieceProcessor(model_file=PATH)
with open(PATH, "rb") as file:
    ENCODER = sentence_pieces.Encoder(file.read())
SOME = ["the ", "nttionti", "  ", "\n\n", "AAAA", "é", "é", "漢字", "\U0001f600", "▁", "<s>", "<0x41>", "12345", " !!", "\t", "x" * 40, "\x00", " " * 17, "ering"]


def lists(ids):
    return pa.array(ids, pa.list_(pa.int32()))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=60) | st.lists(st.sampled_from(SOME), max_size=12).map("".join), max_size=6))
def test_encodes_and_decodes_as_the_library_does(texts):
    true = [TRUE.encode(t, add_eos=True) for t in texts]
    ids = ENCODER.encode(pa.array(texts, pa.string()))
    assert ids.to_pylist() == true
    assert ENCODER.decode(ids).to_pylist() == [TRUE.decode(i) for i in true]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([0, 1, 2, 3, 100, 131, 150, 200, 227, 228, 258, 259, 260, 264, 13, 35, 28705, 29000]), max_size=8), max_size=4))
def test_any_ids_decode_as_the_library_does(ids):
    assert ENCODER.decode(lists([*ids, None])).to_pylist() == [*map(TRUE.decode, ids), None]


def test_ids_the_model_lacks_are_refused():
    with pytest.raises(ValueError):
        ENCODER.decode(lists([[5, 32000]]))


def test_neighbours_are_those_that_merging_leaves_apart():
    rng, table = random.Random(6), ENCODER.pieces.table
    usual = [i for s, i in ((s, i) for i, s in table.strings.items()) if s.isalpha() and len(s) < 5]
    for _ in range(30000):
        a, b = rng.choice(usual), rng.choice(usual)
        parts = list(table.strings[a] + table.strings[b])
        while ranks := [(table.ranks[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:], strict=False)) if x + y in table.ranks]:
            at = min(ranks)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        assert table.fits(a, b) == (parts == [table.strings[a], table.strings[b]])


def test_long_texts_and_long_words(monkeypatch):
    for text in ("ab" * LONG + "c", " " * 300 + "b", "the quick " * 50 + "z" * (LONG + 1), "a" * 5000):
        assert ENCODER.encode(pa.array([text, "x"])).to_pylist() == [TRUE.encode(t, add_eos=True) for t in (text, "x")]
    monkeypatch.setattr(sentence_pieces, "CHUNK", 50)
    for text in ("an inter\nnational é\U0001f600 word " * 20, "aaaa" * 100, "日本" * 60, "a b" * 90):
        assert ENCODER.encode(pa.array([text])).to_pylist() == [TRUE.encode(text, add_eos=True)]


def digest(value: str) -> str:
    return hashlib.sha256(value.encode()).hexdigest()


@pytest.mark.parametrize("name", ["given", "awkward", "none"])
def test_query_matches_the_library(spark, documents, awkward, name):
    docs = {"given": documents, "awkward": awkward, "none": awkward.limit(0)}[name]
    place, key = docs.columns.index("text"), docs.columns.index("doc_id")
    want = []
    for row in docs.collect():
        ids = TRUE.encode(row[place] or "", add_eos=True)
        want.append((row[key], len(ids), digest(" ".join(map(str, ids))), digest(TRUE.decode(ids))))
    got = queries.op13_frame(docs)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_other_models_are_refused():
    from sentencepiece import sentencepiece_model_pb2 as proto

    with open(PATH, "rb") as model:
        spec = proto.ModelProto.FromString(model.read())
    spec.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    with pytest.raises(ValueError):
        sentence_pieces.Encoder(spec.SerializeToString())
