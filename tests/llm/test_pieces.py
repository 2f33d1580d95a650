import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewatch.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = st.text(st.sampled_from(" \n\t▁aAbeéßΣ漢字😀12_-.,<s>'\x00\x1c⁇") | st.characters(exclude_categories=["Cs"]), max_size=80)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def own():
    with open(MODEL, "rb") as file:
        return pieces.Pieces(file.read())


def as_ids(data):
    return np.frombuffer(data, np.int32).tolist()


@settings(max_examples=400, deadline=None)
@given(texts=st.lists(TEXTS, max_size=5))
def test_ids_and_texts_equal_the_library(library, own, texts):
    ids, decoded = own.block(texts)
    want = [library.encode(t) for t in texts]
    assert list(map(as_ids, ids)) == want
    assert decoded == [library.decode(w) for w in want]
    assert [own.decode(w) for w in want] == decoded


@settings(max_examples=400, deadline=None)
@given(ids=st.lists(st.integers(0, 31_999) | st.integers(0, 262) | st.sampled_from([259, 29871]), max_size=12))
def test_any_ids_decode_as_in_the_library(library, own, ids):
    assert own.decode(ids) == library.decode(ids)


def test_long_chunks_and_runs_of_spaces(library, own):
    texts = ["x" * 5000, "ab" * 4000, " " * 500, "supercalifragilistic" * 20, "漢" * 3000, "1" * 999, "▁" * 40]
    texts += [" " * k + "a" + " " * (k + 3) + "b" for k in range(40)]
    assert list(map(as_ids, own.block(texts)[0])) == library.encode(texts)


def test_short_and_long_chunks_merge_alike(own):
    for word in ("▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁the", "▁internationalisation", "aaaaaaaaaaaaaa", "▁" * 37):
        symbols = [own.symbol_of[c] for c in word]
        short = pieces.merge_short(list(symbols), own.rank_of, own.union_of)
        assert short == pieces.merge_long(list(symbols), own.rank_of, own.union_of)


def test_every_distinct_chunk_is_segmented_once(own, monkeypatch):
    seen = []
    one = pieces.Pieces.segment
    monkeypatch.setattr(own.memory, "compute", lambda chunk: seen.append(chunk) or one(own, chunk))
    own.block(["zyxq qwvk zyxq", "zyxq qwvk qwvk\nzyxq"])
    assert sorted(seen) == sorted(set(seen)) and {"▁zyxq", "▁qwvk", "zyxq"} <= set(seen)


def test_rows_with_nulls_long_texts_and_clashing_columns(make_docs, odd_rows, library, monkeypatch):
    got = sorted(map(tuple, pieces.digests(pieces.encode_decode(make_docs(odd_rows), MODEL)).collect()), key=str)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = []
    for i, text in odd_rows:
        ids = library.encode(text or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert got == sorted(want, key=str)


def test_ids_decode_to_the_text(make_docs, odd_rows):
    encoded = pieces.encode_decode(make_docs([r for r in odd_rows if r[0] is not None and r[0] != 9]), MODEL)
    texts = {r.doc_id: r.decoded for r in encoded.collect()}
    assert {r.doc_id: r.decoded for r in pieces.decode_ids(encoded, MODEL).collect()} == texts
    assert texts[5] == dict(odd_rows)[5] and texts[2] == texts[3] == ""


def test_empty_table(make_docs):
    assert pieces.digests(pieces.encode_decode(make_docs([]), MODEL)).count() == 0


def test_other_kinds_of_models_are_refused():
    with pytest.raises(ValueError, match="byte-pair"):
        pieces.Pieces(b"")
