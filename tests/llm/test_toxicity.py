"""The recurrent network, its training and its scores."""

import random
import zlib

import numpy as np
import pytest

from dossierlake.llm import gru, toxicity
from tests.llm.data import TEXTS, documents, labels, prose

BAD = ["grubnik", "zorplet", "vashmok"]


def corpus(n=240, seed=1):
    r, texts, marks = random.Random(seed), [], []
    for i in range(n):
        words = prose(i, 20 + r.randrange(90), 300).split()
        toxic = int(i % 4 == 0)
        for _ in range(3 * toxic):
            words.insert(r.randrange(len(words)), r.choice(BAD) + r.choice(["", "s", ","]))
        texts.append(" ".join(words))
        marks.append(toxic)
    return texts, np.array(marks, np.float32)


def one_batch(texts):
    raw = [t.encode() for t in texts]
    ends = np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64)
    return np.frombuffer(b"".join(raw), np.uint8), ends


def test_gradients_equal_differences():
    batch = gru.Batch(*one_batch(["the quick brown grubnik jumps over lazy dogs " * 9, "other words", ""]))
    part = batch.part(np.arange(len(batch.windows)))
    net = gru.Network()
    net.p = {k: v.astype(float) for k, v in net.p.items()}
    target = (np.arange(len(part.windows)) % 2).astype(float)

    def loss():
        x = net.run(net.gates(net.inputs(part)), part.windows)
        return np.mean(np.log1p(np.exp(x)) - target * x)

    g = net.gradients(part, target)
    for k, p in net.p.items():
        flat = p.reshape(-1)
        at = int(np.abs(g[k]).argmax())
        kept, sides = flat[at], []
        for step in (1e-3, -1e-3):
            flat[at] = kept + step
            sides.append(loss())
        flat[at] = kept
        assert g[k].reshape(-1)[at] == pytest.approx((sides[0] - sides[1]) / 2e-3, rel=1e-3, abs=1e-6), k


def test_forward_pass_equals_a_plain_one():
    texts = ["The quick brown grubnik " * 20, "other, words", "x", "", "é à " * 40 + "ends"]
    net = gru.Network(3)
    batch = gru.Batch(*one_batch(texts))
    got = net.logits(batch)
    p = {k: v.astype(float) for k, v in net.p.items()}
    h = gru.HIDDEN

    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    def inputs(word):
        alone = gru.Batch(*one_batch([word]))
        return np.concatenate([p["word"][alone.bins[0]], p["gram"][alone.grams].mean(0)])

    def states(xs, w, u, b):
        now, out = np.zeros(h), []
        for x in xs:
            a, c = x @ w + b, now @ u
            z, r = sigmoid(a[:h] + c[:h]), sigmoid(a[h : 2 * h] + c[h : 2 * h])
            fresh = np.tanh(a[2 * h :] + r * c[2 * h :])
            now = z * now + (1 - z) * fresh
            out.append(now)
        return out

    want, rows = [], []
    for row, text in enumerate(texts):
        words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
        starts = range(0, max(len(words) - gru.WINDOW, 0) + gru.STRIDE, gru.STRIDE) if words else []
        for start in starts:
            xs = [inputs(w) for w in words[start : start + gru.WINDOW]]
            there = states(xs, p["wf"], p["uf"], p["bf"])
            back = states(xs[::-1], p["wb"], p["ub"], p["bb"])[::-1]
            both = np.array([np.concatenate(s) for s in zip(there, back, strict=True)])
            weight = np.exp(both @ p["attend"])
            want.append(weight @ both / weight.sum() @ p["out"] + p["bias"][0])
            rows.append(row)
    assert rows == list(batch.window_rows)
    assert got == pytest.approx(want, abs=1e-4)


def test_thirty_toxic_examples_are_enough():
    texts, marks = corpus(120)
    net = toxicity.train(texts, marks)
    others, theirs = corpus(400, seed=9)
    found = toxicity.scores(net, *one_batch(others[120:])) >= toxicity.THRESHOLD
    assert (found == (theirs[120:] > 0)).mean() >= 0.98


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 48, 49, 200):
        windows, rows = gru._windows(np.zeros(n, np.int64), 2)
        assert set(windows[windows >= 0]) == set(range(n)) and (rows == 0).all()
        starts = windows[:, 0]
        assert all(b - a == gru.STRIDE for a, b in zip(starts, starts[1:]))


def test_held_out_accuracy():
    texts, marks = corpus()
    net = toxicity.train(texts[:160], marks[:160])
    score = toxicity.scores(net, *one_batch(texts[160:]))
    assert ((score >= toxicity.THRESHOLD) == (marks[160:] > 0)).mean() >= 0.95
    # One word far inside a long text is found: all of it is scored.
    long = prose(7, 4000, 300) + " grubnik zorplet vashmok " + prose(8, 4000, 300)
    clean, bad = toxicity.scores(net, *one_batch([prose(7, 8000, 300), long]))
    assert bad >= toxicity.THRESHOLD and bad > clean


def test_scores_do_not_depend_on_neighbours():
    texts, marks = corpus(60)
    net = toxicity.train(texts, marks)
    together = toxicity.scores(net, *one_batch(texts + ["", " .. "]))
    alone = [toxicity.scores(net, *one_batch([t]))[0] for t in texts]
    assert together[:-2] == pytest.approx(alone, abs=1e-5) and list(together[-2:]) == [0.0, 0.0]


def test_rows_and_folds(spark):
    texts, marks = corpus(120)
    docs = list(enumerate(texts)) + [(i + 1000 if i is not None else None, t) for i, t in TEXTS]
    frame, known = documents(spark, docs), labels(spark, [(i, 1, int(m)) for i, m in enumerate(marks)])
    rows = toxicity.score_documents(frame, known).collect()
    assert sorted((r["doc_id"] for r in rows), key=repr) == sorted((i for i, _ in docs), key=repr)
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        held = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2
        assert r["held_out"] == held
    sample, _ = toxicity.training_sample(frame, known, "doc_id", "text")
    held_texts = {t for i, t in docs if i is not None and zlib.crc32(str(i).encode()) % 4 == 2}
    assert sample and not held_texts & set(sample)
    assert toxicity.score_documents(documents(spark, []), known).count() == 0
    none = toxicity.score_documents(documents(spark), labels(spark, [])).collect()
    assert len(none) == len(TEXTS) and all(r["score"] == 0 for r in none)
