import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewatch.llm import bpe, packing, token_counts
from tidewatch.llm.common import Bounded

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
TEXTS = st.text(st.sampled_from(" \n\t\r\x0b\x1c\u0085 aAbeéßΣσς 's'llRE1½²٣ǅ漢😀_-.,<|>") | st.characters(exclude_categories=["Cs"]), max_size=60)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def own():
    read = lambda path: open(path, encoding="utf-8").read()
    return bpe.Codec(read(BYTES)), packing.Encoder(read(BYTES)), token_counts.Counter(read(WORDS))


@settings(max_examples=300, deadline=None)
@given(text=TEXTS)
def test_ids_and_counts_equal_the_library(library, own, text):
    ids = library[0].encode(text, add_special_tokens=False).ids
    codec, encoder, counter = own
    assert np.frombuffer(codec.encode(text), "<u4").tolist() == ids
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids
    assert codec.decode(codec.encode(text)) == library[0].decode(ids, skip_special_tokens=False)
    assert counter.count(text) == len(library[1].encode(text, add_special_tokens=False).ids)


def test_letters_that_only_newer_tables_hold(library, own):
    """U+3D000 is a letter of Unicode 18 and a symbol for the library; U+A7CB and U+10D50 have small letters since Unicode 16."""
    assert bpe.pieces_of(own[0]._pieces, "aâ\U0003d000b \U000323b0 \ua7ce") == ["aâ", "\U0003d000", "b", " \U000323b0", " \ua7ce"]
    for text in ("Â\U0003d000", "x\ua7cby", "\ua7dc", "\U00010d50\U00010d70", "é\U00016ea0", "Â\U000323b0a Â\U0003fc3f1"):
        assert np.frombuffer(own[0].encode(text), "<u4").tolist() == library[0].encode(text, add_special_tokens=False).ids
        assert own[2].count(text) == len(library[1].encode(text, add_special_tokens=False).ids)


def test_special_strings_and_long_words(library, own):
    for text in ("a<|endoftext|>b <|endoftext|>", "<|startoftext|>X<|endoftext|><|STARTOFTEXT|>", "ab" * 4000, "a   b\n  c"):
        assert np.frombuffer(own[0].encode(text), "<u4").tolist() == library[0].encode(text, add_special_tokens=False).ids
        assert own[2].count(text) == len(library[1].encode(text, add_special_tokens=False).ids)


def test_bounded_keeps_values_right_beyond_its_limit():
    calls = []
    held = Bounded(lambda key: calls.append(key) or len(key), limit=4, longest=6)
    for _ in range(3):
        assert [held[k] for k in ("a", "bb", "ccc", "dddd", "eeeee", "f" * 9)] == [1, 2, 3, 4, 5, 9]
    assert len(held) <= 4 and len(held.before) <= 4


def test_encode_decode_of_odd_rows(make_docs, odd_rows, library):
    got = sorted(map(tuple, bpe.encode_decode(make_docs(odd_rows), BYTES).collect()), key=str)
    want = []
    for i, text in odd_rows:
        ids = library[0].encode(text or "", add_special_tokens=False).ids
        decoded = library[0].decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.encode_decode(make_docs([]), BYTES).count() == 0


def test_counts_of_odd_rows(make_docs, odd_rows, library):
    got = sorted(map(tuple, token_counts.count_tokens(make_docs(odd_rows), WORDS).collect()), key=str)
    size = lambda t: len(library[1].encode(t or "", add_special_tokens=False).ids)
    assert got == sorted([(i, len((t or "").encode()), size(t), size(t) > 2048) for i, t in odd_rows], key=str)
    assert token_counts.count_tokens(make_docs([]), WORDS).count() == 0


@pytest.mark.parametrize("length", [16, 2048])
def test_packing_is_a_gapless_cut_of_all_ids(make_docs, odd_rows, library, length):
    docs = make_docs(odd_rows).repartition(3)
    pieces = packing.pack_documents(docs, BYTES, length).collect()
    by_sequence = {}
    for p in pieces:
        assert len(p.piece) == 4 * p.length
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for k, own in by_sequence.items():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == length or k == len(by_sequence) - 1
    whole = b"".join(p.piece for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)))
    ends = np.flatnonzero(np.frombuffer(whole, "<u4") == 1)
    want = sorted(np.array([*library[0].encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes() for _, t in odd_rows)
    got, low = [], 0
    for p in sorted((p for p in pieces if p.start == 0), key=lambda p: (p.sequence_id, p.offset)):
        got.append(whole[low : low + 4 * p.doc_tokens])
        low += 4 * p.doc_tokens
    assert low == len(whole) and sorted(got) == want and len(ends) >= len(odd_rows)


def test_packing_nothing(make_docs):
    assert packing.pack_documents(make_docs([]), BYTES).count() == 0
