"""Phrases are counted by looking symbols up, without sorting the text's symbols."""
import numpy as np

from fraudlens.llm import langid as L


def test_phrases_by_lookup_equal_a_plain_parse(monkeypatch):
    rng = np.random.default_rng(1)
    letters = {c: L._FIRST + i for i, c in enumerate("abcdef")}
    seqs = [rng.integers(0, n, 200).tolist() for n in (5, 7, 8)]
    model = {"letters": letters, "langs": ["x", "y", "z"], "automata": [L._sparse(s) for s in seqs]}
    texts = [rng.integers(0, 8, n).astype(np.int32) for n in (0, 1, 90, 200)]

    def plain(text, seq):
        inside = {tuple(seq[i:j]) for i in range(len(seq)) for j in range(i + 1, min(len(seq), i + 12) + 1)}
        n = at = 0
        while at < len(text):
            end = at + 1
            while end < len(text) and tuple(text[at:end + 1].tolist()) in inside:
                end += 1
            n, at = n + 1, end
        return n
    want = [[plain(t, s) for s in seqs] for t in texts]

    def no(*a, **k):
        raise AssertionError("sorted the symbols of the texts")
    monkeypatch.setattr(L.np, "unique", no)
    assert L.phrase_counts(texts, model).tolist() == want
