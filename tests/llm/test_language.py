from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from reelmill.llm import lang_id

WORDS = {"aa": "the of and with house green", "bb": "der und die mit haus gruen schoen", "cc": "le de et avec maison vert être"}


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(3)
    out = []
    for i in range(360):
        lang = sorted(WORDS)[i % 3]
        out.append((i, " ".join(rng.choice(WORDS[lang].split(), rng.integers(3, 80))), lang, "s"))
    return out


def test_gradients():
    model = lang_id.new_model(["a", "b", "c"], hidden=4, seed=1)
    rng = np.random.default_rng(0)
    runs, labels = rng.integers(0, 256, (6, 5)), rng.integers(0, 3, 5)
    _, found = lang_id.gradients(model, runs, labels)
    for weights, gradient in zip(model.parameters(), found, strict=True):
        at = tuple(np.unravel_index(np.abs(gradient).argmax(), gradient.shape))
        before = weights[at]
        weights[at] = before + 1e-2
        above, _ = lang_id.gradients(model, runs, labels)
        weights[at] = before - 1e-2
        below, _ = lang_id.gradients(model, runs, labels)
        weights[at] = before
        assert (above - below) / 2e-2 == pytest.approx(float(gradient[at]), rel=0.03)


def test_held_out_accuracy(documents, corpus):
    docs = documents(corpus)
    model = lang_id.fit(docs.where(lang_id.remainder(F.col("doc_id"), lang_id.FOLDS) != 0), steps=150)
    assert model.languages == sorted(WORDS)
    found = {r.doc_id: r for r in lang_id.identify(docs, model).collect()}
    held = [i for i, *_ in corpus if __import__("zlib").crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 40 and sum(found[i].lang_pred == corpus[i][2] for i in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in found.values())


def test_positions_are_pooled(corpus):
    """A document's probabilities are the mean of those of all its bytes, however it is packed with others."""
    model = lang_id.new_model(["a", "b"], seed=5)
    texts = [t.encode() for _, t, *_ in corpus[:7]] + [b"x", b""]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = lang_id.predict(model, data, offsets)
    for k, text in enumerate(texts):
        total = np.zeros(2)
        for at in range(0, len(text), lang_id.RUN):
            part = np.frombuffer(text[at:at + lang_id.RUN], np.uint8)
            total += lang_id.position_probabilities(model, part[:, None].astype(np.intp), np.array([len(part)]))[:, :, 0].sum(axis=0)
        assert np.allclose(found[k], total / max(len(text), 1), atol=1e-5)


def test_undecided(documents):
    docs = documents([(1, None), (2, ""), (3, "123 !? _"), (4, "x")])
    found = {r.doc_id: (r.lang_pred, r.score) for r in lang_id.identify(docs, lang_id.new_model(["en"])).collect()}
    assert found == {1: ("und", 0.0), 2: ("und", 0.0), 3: ("und", 0.0), 4: ("en", 1.0)}
    assert {r.lang_pred for r in lang_id.identify(docs, lang_id.new_model([])).collect()} == {"und"}


def test_characters_that_were_not_learned_add_nothing(documents, corpus):
    """The network's word on a script that it never read is chance; with ``learned`` it doesn't count."""
    docs = documents(corpus)
    model = lang_id.fit(docs, steps=20)
    texts = ["Быстрая лиса бежит в лес " * 9, "γρήγορη αλεπού " * 9, "速い茶色の狐 " * 9, "être vert maison", "the of and", "etre øre"]
    rows = documents([(k, t) for k, t in enumerate(texts)])
    plain = {r.doc_id: r for r in lang_id.identify(rows, model).collect()}
    found = {r.doc_id: r for r in lang_id.identify(rows, model, learned=True).collect()}
    for k, text in enumerate(texts):
        if k in (3, 4):
            assert found[k] == plain[k]
        else:
            spared = sum(c < 128 for c in text.encode()) / len(text.encode())
            assert found[k].score < plain[k].score and found[k].score <= spared
    data = np.frombuffer("aéø日é".encode(), np.uint8)
    model.pairs[:] = False
    model.pairs[[0xC3 << 8 | 0xA9]] = True
    assert lang_id.strange(model, data).tolist() == [False] * 3 + [True] * 5 + [False] * 2
    assert not lang_id.strange(lang_id.new_model(["a"]), data).any()
