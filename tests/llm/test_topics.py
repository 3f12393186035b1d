"""Expected counts of topics: many documents are one piece of work, however they are cut."""

import random

import numpy as np

from loomline.llm import topics


def test_documents_are_worked_on_together(monkeypatch):
    rng = random.Random(3)
    kinds = {"en": ["loan bank rate", "stew oven salt"], "fi": ["laina pankki korko", "pata uuni suola"]}
    langs = [rng.choice(["en", "fi"]) for _ in range(600)]
    labels = [rng.randrange(2) for _ in langs]
    pages = [[" ".join(rng.choices((kinds[x][k] + " the of and" * 2).split(), k=9)) for _ in range(4)] for x, k in zip(langs, labels, strict=True)]
    subjects = ["money", "food"]
    words = sorted({w for page in pages for unit in page for w in unit.split()})
    model = topics.start(words, pages, [{subjects[k]} for k in labels], langs, subjects, rounds=3)
    docs = model.coded(pages)
    few, bits = model.expected(docs, chunk=50)
    pieces, infer = [], topics.Topics.infer
    monkeypatch.setattr(topics.Topics, "infer", lambda self, some, *a: pieces.append(len(some)) or infer(self, some, *a))
    many, same = model.expected(docs)
    assert pieces == [600]
    assert np.allclose(few, many, rtol=1e-4, atol=1e-3) and np.isclose(bits, same, rtol=1e-6)
    assert np.isclose(many.sum(), len(docs.word), rtol=1e-4)
    theta, found, _ = infer(model, docs)
    assert np.allclose(theta.sum(axis=1), 1, atol=1e-4) and all(r.shape == (len(t), len(w)) for w, t, r in found)


def test_words_are_ordered_by_digits():
    """Expected counts need words by place; places that fit 16 bits are sorted by their digits, in the same order as by comparing."""
    rng = np.random.default_rng(6)
    for width in (34_096, 1 << 16, 1 << 17):
        word = rng.integers(0, width, size=5000)
        word[::7] = width - 1
        assert (topics.by_word(word, width) == np.argsort(word, kind="stable")).all()
