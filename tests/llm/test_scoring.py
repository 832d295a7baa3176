"""Quality rules, toxicity and LM scoring against brute force and held-out rows."""

import collections
import math
import random
import zlib

import numpy as np

from ledgerline.llm import lm_scoring as M
from ledgerline.llm.quality_rules import IsolationForest, quality_rules
from ledgerline.llm.toxicity import score_toxicity, windows

from . import fixtures as X


def statistics(text):
    words = text.encode().split()
    runs = collections.Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    repeat = [False] * len(words)
    for k in range(len(words) - 7):
        if runs[tuple(words[k : k + 8])] > 1:
            repeat[k : k + 8] = [True] * 8
    lines = [x for x in text.split("\n") if x.encode().split()]
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), sum(repeat)


def labels_of(spark, columns="doc_id long, quality int, toxic int"):
    return spark.createDataFrame([(i * 3, i % 5 > 0, i % 2) for i in range(40)], "doc_id long, quality boolean, toxic int").selectExpr("doc_id", "int(quality) quality", "toxic")


def test_quality_rules(spark):
    found = X.by_id(quality_rules(X.docs(spark), labels_of(spark)))
    for r in X.rows():
        n, chars, symbols, dup, repeat = statistics(r[1] or "")
        f = found[r[0]]
        assert (f["n_words"], f["word_chars"], f["n_symbols"], f["n_dup_lines"], f["n_repeat_words"]) == (n, chars, symbols, dup, repeat)
        assert f["base_failed"] == (n < 20 or 100 * repeat > 30 * n)
        assert not (f["base_failed"] and f["kept"])
    assert quality_rules(X.empty(spark), labels_of(spark)).count() == 0
    none = quality_rules(X.docs(spark), labels_of(spark).where("false"))
    assert none.where("kept = base_failed").count() == 0


def test_forest_isolates_what_is_odd():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 0.05, (400, 3)), rng.normal(1, 0.05, (20, 3))])
    score = IsolationForest().fit(x).score(x)
    assert score[400:].min() > np.quantile(score[:400], 0.95)


def test_toxicity(spark):
    rng = random.Random(5)
    bad = ["vileword", "nastyone", "rudeterm", "crudesay"]
    rows, labels = [], []
    for i in range(600):
        w = X.words(rng, 90)
        toxic = i % 3 == 0
        if toxic:
            for _ in range(6):
                w[rng.randrange(90)] = rng.choice(bad)
        rows.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    rows += [(1000, None, None, None, None), (1001, "", "en", None, 0), (None, "some text", None, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    known = spark.createDataFrame([*labels, (None, 1, 1), (5000, 1, None)], "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r for r in score_toxicity(docs, known).collect()}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(found[i]["held_out"] == (i in held) for i in range(600))
    right = sum(found[i]["predicted"] == int(i % 3 == 0) for i in held)
    assert right >= 0.9 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found.values())
    assert {1000, 1001, None} <= set(found)
    assert score_toxicity(docs, known.where("toxic = 0")).where("score > 0").count() == 0
    assert score_toxicity(docs.where("false"), known).count() == 0


def test_toxicity_of_equal_texts(spark):
    docs = spark.createDataFrame([(i, "the same text for both labels", "en", "s", 0) for i in range(60)], "doc_id long, text string, lang string, source string, n_chars long")
    known = spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    found = score_toxicity(docs, known).collect()
    assert len({r["score"] for r in found}) == 1 and 0.2 < found[0]["score"] < 0.8


def test_windows_cover_the_text():
    rng = random.Random(3)
    for n in (0, 5, 400, 3000):
        text = " ".join(X.words(rng, n)).encode()
        assert b"".join(windows(text)) == text
    assert b"".join(windows(b"x" * 2000)) == b"x" * 2000


def base_scores():
    rows = [(r[0], (r[1] or "").encode().lower().split()) for r in X.rows()]
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    counts, n = collections.Counter(), 0
    for i, w in rows:
        if not held[i]:
            counts.update(w)
            n += 1
    total, distinct = sum(counts.values()) + n, len(counts) + 1
    log = lambda c: math.log10((c + 1) / (total + distinct + 1))
    return {i: (held[i], len(w) + 1, sum(x in counts for x in w) + 1, total, sum(log(counts.get(x, 0)) for x in w) + log(n)) for i, w in rows}


def test_lm_base_scores(spark):
    want = base_scores()
    for head in (500_000, 20):  # with and without words beyond the head
        found = X.by_id(M.lm_scores(X.docs(spark), head_words=head))
        for i, (held, n, known, total, score) in want.items():
            f = found[i]
            assert (f["held_out"], f["n_tokens"], f["n_known"], f["train_tokens"]) == (held, n, known, total)
            assert math.isclose(f["base_score"], score, rel_tol=1e-9)
            assert f["score"] < 0
    assert M.lm_scores(X.empty(spark)).count() == 0


def test_model_is_causal_and_normal():
    rng = np.random.default_rng(1)
    model = M.Model.start(rng.integers(0, 50, M.CLASSES).astype(float))
    model.pairs = M.pair_logs(rng.integers(0, 50, (M.CLASSES + 1, M.CLASSES)).astype(float), np.ones(M.CLASSES))
    model.weights["out"] = rng.normal(0, 0.3, model.weights["out"].shape).astype(np.float32)
    x = rng.integers(0, M.CLASSES, (2, M.WINDOW))
    groups = np.stack([np.ones(M.CLASSES), np.arange(M.CLASSES) < 9], 1).astype(np.float32)
    every = np.stack([model.log_probabilities(x, np.full_like(x, c), groups)[0] for c in range(M.CLASSES)], -1)
    assert np.allclose(np.exp(every).sum(-1), 1, atol=1e-4)
    assert np.allclose(np.exp(every[..., :9]).sum(-1), np.exp(model.log_probabilities(x, x, groups)[1]), atol=1e-4)
    other = x.copy()
    other[:, 20:] = (other[:, 20:] + 7) % M.CLASSES
    y = rng.integers(0, M.CLASSES, x.shape)
    assert np.allclose(model.log_probabilities(x, y, groups)[0][:, :20], model.log_probabilities(other, y, groups)[0][:, :20], atol=1e-5)


def test_gradients():
    rng = np.random.default_rng(2)
    model = M.Model.start(rng.integers(0, 50, M.CLASSES).astype(float))
    model.pairs = M.pair_logs(rng.integers(0, 50, (M.CLASSES + 1, M.CLASSES)).astype(float), np.ones(M.CLASSES))
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    model.weights["out"] = rng.normal(0, 0.3, model.weights["out"].shape)
    x, y = rng.integers(0, M.CLASSES, (3, M.WINDOW)), rng.integers(0, M.CLASSES, (3, M.WINDOW))
    live = rng.random(x.shape) < 0.7
    groups = np.ones((M.CLASSES, 2))
    loss = lambda: -model.log_probabilities(x, y, groups)[0][live].mean()
    grads = model.gradients(x, y, live)
    for name, w in model.weights.items():
        k = np.unravel_index(np.abs(grads[name]).argmax(), w.shape)
        old = w[k]
        w[k] = old + 1e-3
        up = loss()
        w[k] = old - 1e-3
        down = loss()
        w[k] = old
        assert np.isclose((up - down) / 2e-3, grads[name][k], rtol=0.02, atol=1e-5), name


def test_windows_score_each_id_once():
    classes, offsets = np.arange(300) % M.CLASSES, np.array([0, 1, 33, 120, 300])
    x, y, live, row = M.windows(classes.astype(np.int16), offsets)
    assert live.sum() == 300
    assert y[live].tolist() == classes.tolist()
    assert (x[live][[0, 1, 33, 120]] == M.START).all()
    assert np.bincount(row[np.nonzero(live)[0]]).tolist() == np.diff(offsets).tolist()
