import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tidewatch.llm import attention_lm as lm

VOCABULARY = lm.read_local(public_tokenizers.path("byte_bpe_50k.json"))


def odd_texts():
    rng = random.Random(1)
    letters = "aBc1'_ \t\n\x0b\x0c\r\x1c\x85\xa0é漢　.,s😀"
    fixed = ["  Lead and  trail \t\n", "", None, "don't 'S x'll ''' it's'm", "x" * 3000, "12ab34 --- <|endoftext|> \x00z", "İI　 　i"]
    return fixed + ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(800)]


def test_words_of_blocks_equal_those_of_each_text():
    texts = odd_texts()
    got = []
    for rows, words, lengths in lm.word_pieces(iter([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]).slice(1)]), 500):
        assert rows.num_rows == len(lengths)
        got += [x.tolist() for x in np.split(np.array(words.to_pylist(), object), np.cumsum(lengths)[:-1])]
    assert got == [lm.tokens_of(t or "") for t in texts[1:]]


def test_ids_of_many_words_come_from_few_calls():
    encoded, calls = lm.WordIds(VOCABULARY), []
    words = [w for t in odd_texts() for w in lm.tokens_of(t or "")]
    want = [lm.ids_of_word(encoded.encoder, w) for w in words]
    real = encoded.encoder.bpe

    class Counted:
        def encode_ordinary(self, text):
            calls.append(text)
            return real.encode_ordinary(text)

    encoded.encoder.bpe = Counted()
    ids, lengths = encoded(words)
    assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == want
    spaced = sum(not w.isascii() and bool(lm.WHITE.search(w.decode())) for w in words)
    assert len(calls) == 1 + spaced < len(words) / 2
    assert [len(x) for x in encoded([])] == [0, 0]


def test_rows_of_numbers_come_back():
    rows = lm.binary_rows(np.arange(10), np.array([3, 0, 5, 2]))
    for cut, values, lengths in ((rows, range(10), [3, 0, 5, 2]), (rows.slice(1, 2), range(3, 8), [0, 5]), (rows.slice(4), [], [])):
        got = lm.numbers_of(cut)
        assert got[0].tolist() == list(values) and got[1].tolist() == lengths


def test_large_logits_stay_finite():
    """Weights far beyond what powers can hold; float32 against the same in float64, where none overflows."""
    shape = lm.Shape(outputs=6, group=4, width=4, hidden=6, words=(2, 3))
    net = lm.Network(shape, 17, 16)
    for name, by in (("query", 40), ("out", 400), ("tail", 400)):
        net.w[name] *= np.float32(by)
    rng = np.random.default_rng(0)
    ids, ok, want = lm.windows(np.array([4, 2, 7]), rng.integers(0, 16, 13), 2, 3, 16)
    target = rng.integers(0, 16, want.sum())
    args = ("words", 2, ids, ok, want, target)
    got, g = net.log_probability(*args), net.gradients(*args)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    assert got == pytest.approx(net.log_probability(*args), rel=1e-3, abs=1e-3) and np.isfinite(got).all()
    assert all(np.isfinite(v).all() for v in g[0].values()) and g[2] == pytest.approx(net.gradients(*args)[2], rel=1e-3)


def test_unknown_keys_are_computed_together_and_kept():
    calls = []
    recent = lm.Recent(lambda keys: calls.append(keys) or np.array([len(k) for k in keys]), limit=3, longest=5)
    assert recent([b"a", b"bb", b"longest"]).tolist() == [1, 2, 7]
    assert recent([b"bb", b"ccc", b"dddd", b"longest"]).tolist() == [2, 3, 4, 7]
    assert recent([b"a", b"ccc"]).tolist() == [1, 3]  # from the round before
    assert calls == [[b"a", b"bb", b"longest"], [b"ccc", b"dddd", b"longest"]]


def test_frequent_words_stay_in_the_scorer():
    shape = lm.Shape(outputs=6, group=4, width=4, hidden=6)
    size = 1 + max(lm.json.loads(VOCABULARY)["model"]["vocab"].values())
    classes = np.arange(size) % 13 + 3
    model = lm.Model(shape, VOCABULARY, lm.Network(shape, 17, 16), classes, np.zeros(size), np.zeros(size), {b"tea": 4, b"river": 2}, 3, 9, 4, 0.5)
    words = [[b"tea", b"x1", b"river"], [b"y2", b"tea"], [b"x1", b"river", b"z3"]]
    scorer, whole = lm.Scorer(model, limit=1), lm.Scorer(model)
    learned, real = [], scorer.learn
    scorer.learn = lambda some: learned.append(some) or real(some)
    for text in words:
        got, want = (s.score(pa.array(text, pa.binary()), np.array([len(text)])) for s in (scorer, whole))
        assert got[1] == pytest.approx(want[1], rel=1e-5) and got[2].tolist() == [len(text) + 1]
        count = np.r_[scorer.count, 3.0][got[0]]
        assert count.tolist() == [model.counts.get(w, -1) for w in text] + [3]
    assert learned == [[b"tea", b"x1", b"river"], [b"y2"], [b"x1", b"z3"]]
