import numpy as np

from tidewatch.llm import syncmers


def test_fingerprints_grow_with_the_text(make_docs):
    """Two long texts that share a passage of 50 words, which lies elsewhere in the second."""
    rng = np.random.default_rng(4)
    words = lambda n: [" ".join("".join(rng.choice(list("abcdefghijklmnop"), 6)) for _ in range(n))]
    passage = words(50)
    texts = [" ".join(words(3000) + passage + words(1700)), " ".join(words(900) + passage + words(3800))]
    a, b = syncmers.anchors(texts)
    assert len(a) > 3000 and len(b) > 3000
    shared = len(np.intersect1d(a[:, 0], syncmers.anchors(passage)[0][:, 0]))
    assert shared > 20
    assert syncmers.likeness(a, b) >= 20 / (len(a) + len(b))
    got = {r.doc_id: r for r in syncmers.fingerprints(make_docs(list(enumerate(texts)))).collect()}
    assert [len(got[k].fingerprint) // 16 for k in (0, 1)] == [len(a), len(b)]
    assert got[0].near_next == syncmers.likeness(a, b) > 0
