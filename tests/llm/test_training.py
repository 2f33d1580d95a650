import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import attention_lm as lm

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def test_all_training_documents_fit_the_weights(make_docs, monkeypatch):
    """More documents than `sample`, in several tasks: each that is not set aside is in the rows that are trained on, in one round."""
    seen = []
    real = lm.fit
    monkeypatch.setattr(lm, "fit", lambda network, rows, shape: (seen.append((rows.collect(), shape)), real(network, rows, shape)))
    docs = make_docs([(k, f"alpha beta w{k} " * 20) for k in range(120)])
    shape = lm.Shape(sample=10, share=1500, frequent=50, outputs=16, aside=5)
    got = lm.score_documents(docs.repartition(5), VOCABULARY, shape)
    aside = F.pmod(F.xxhash64("text"), F.lit(shape.aside)) == 0
    learned = got.filter(~F.col("held_out")).join(docs.filter(~aside).select("doc_id"), "doc_id").count()
    assert got.count() == 120
    rows, used = seen[0]
    assert 60 < sum(r.c is None for r in rows) == learned < got.filter(~F.col("held_out")).count()
    assert used.rounds > 1 and {r.part for r in rows} <= set(range(used.rounds))


def test_ids_have_their_own_outputs():
    first, later = np.arange(1000.0), np.zeros(1000)
    classes, *_ = lm.classes_of(first, later)
    assert len(set(classes.tolist())) == 1000 and classes[0] == 0 and classes[999] == 3


def test_gradients_of_grouped_outputs():
    shape = lm.Shape(outputs=6, group=4, width=4, hidden=6, words=(2, 3))
    net = lm.Network(shape, 17, 16)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    net.start_at(np.arange(16.0))
    rng = np.random.default_rng(0)
    ids, ok, want = lm.windows(np.array([4, 2, 7]), rng.integers(0, 16, 13), 2, 3, 16)
    target, weight = rng.integers(0, 16, want.sum()), rng.random(want.sum()) + 0.1
    g, sparse, _ = net.gradients("words", 2, ids, ok, want, target, weight)
    for name, parts in sparse.items():
        g[name] = np.zeros_like(net.w[name])
        for at, value in parts:
            g[name][at] += value
    loss = lambda: -(net.log_probability("words", 2, ids, ok, want, target) * weight).sum() / weight.sum()
    for name in ("embed", "mix", "down", "out", "out0", "tail", "tail"):
        at = tuple(rng.integers(0, s) for s in net.w[name].shape)
        kept = net.w[name][at]
        net.w[name][at] = kept + 1e-5
        high = loss()
        net.w[name][at] = kept - 1e-5
        low = loss()
        net.w[name][at] = kept
        assert g[name][at] == pytest.approx((high - low) / 2e-5, rel=2e-3, abs=2e-6), name
    every = np.stack([net.log_probability("words", 2, ids, ok, want, np.full(len(target), k)) for k in range(16)])
    assert np.exp(every).sum(0) == pytest.approx(np.ones(len(target)), abs=1e-5)


def test_scores_token_by_token(make_docs, monkeypatch):
    """Every score is the sum over the tokens of the mixture, with each word put through the network alone and in order."""
    made = []
    real = lm.train
    monkeypatch.setattr(lm, "train", lambda *a: made.append(real(*a)) or made[0])
    rng = np.random.default_rng(4)
    rows = [(k, " ".join(rng.choice(["river", "stone", "unbelievably", f"x{k}y", "Tea."], 70))) for k in range(60)] + [(60, None), (61, "q" * 90)]
    shape = lm.Shape(frequent=3, outputs=16, group=64, batch=8)
    got = {r.doc_id: r for r in lm.score_documents(make_docs(rows), VOCABULARY, shape).collect()}
    model = made[0]
    assert 0 < model.mixed < 1
    counts = {}
    for k, text in rows:
        if not got[k].held_out:
            for word in [*lm.tokens_of(text or ""), b""]:
                counts[word] = counts.get(word, 0) + 1
    encoder, floor = lm.Encoder(model.vocabulary), model.total + 0.5 * (model.distinct + 1)

    def logs(kind, inputs, targets):
        context, new = getattr(shape, kind)
        out = 0.0
        for at, target in enumerate(targets):
            low = at // new * new
            slots = [model.begin] * (context + new)
            ok = np.zeros((1, context + new), bool)
            for k in range(max(low - context, 0), at + 1):
                slots[k - low + context], ok[0, k - low + context] = inputs[k], True
            want = np.zeros((1, new), bool)
            want[0, at - low] = True
            out = np.append(out, model.network.log_probability(kind, context, np.array([slots]), ok, want, np.array([target])))
        return out[1:] if len(targets) else np.zeros(0)

    for k, text in [rows[0], rows[1], rows[6], rows[60], rows[61]]:
        words = lm.tokens_of(text or "")
        ids = [model.classes[lm.ids_of_word(encoder, w)] for w in words]
        raw = [lm.ids_of_word(encoder, w) for w in words]
        first = [i[0] for i in ids]
        found = logs("starts", [model.begin, *first], [*first, lm.Model.END])
        for n, (own, plain) in enumerate(zip(ids, raw, strict=True)):
            found[n] += logs("words", own, [*own[1:], lm.Model.EOW]).sum()
            found[n] += model.first_rest[plain[0]] + sum(model.later_rest[i] for i in plain[1:])
        share = np.array([(counts.get(w, 0) + 0.5) / floor for w in [*words, b""]])
        want = np.log10(model.mixed * share + (1 - model.mixed) * np.exp(found)).sum()
        assert got[k].score == pytest.approx(want, rel=1e-4)
