"""LM scoring does no work twice: arrays of batches, spelled words, and ids that are only context."""

import tracemalloc

import numpy as np

from ledgerline.llm import lm_scoring as M


def some_model(rng):
    model = M.Model.start(rng.integers(1, 50, M.CLASSES).astype(float), np.append(rng.integers(0, M.CLASSES, M.IDS), M.START))
    model.weights["out"] = rng.normal(0, 0.3, model.weights["out"].shape).astype(np.float32)
    return model


def test_later_batches_take_up_the_arrays_of_the_first():
    rng = np.random.default_rng(3)
    model, work = some_model(rng), M.Work()
    model.weights["embed"], model.of = model.weights["embed"][:60], model.of[:60]
    x, y, live = rng.integers(0, 60, (128, M.WINDOW)), rng.integers(0, M.CLASSES, (128, M.WINDOW)), np.ones((128, M.WINDOW), bool)
    groups, tables = np.ones((M.CLASSES, 2), np.float32), model.tables()
    for step in (lambda: model.gradients(x, y, live, work), lambda: model.log_probabilities(x, y, groups, work, 0, tables)):
        step()
        tracemalloc.start()
        step()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < x.size * M.CLASSES * 4  # less than logits alone


def test_a_worker_spells_a_word_once(monkeypatch):
    ranks = M.read_ranks(M.VOCABULARY)
    opens, spelled = M.opening(ranks), []
    monkeypatch.setattr(M, "_spellers", {})
    real = M.Speller.learn
    monkeypatch.setattr(M.Speller, "learn", lambda self, words, hashes: (spelled.extend(words), real(self, words, hashes))[1])
    found = []
    for text in (b"One two three two", b"three ONE four"):  # a task each, with its own copy of the vocabulary
        *_, ids, offsets = M.sequences(M.speller(dict(ranks), opens.copy()), np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        found.append(ids.tolist())
    assert sorted(spelled) == [b"four", b"one", b"three", b"two"]
    encode = M.encoder(ranks)
    assert found == [[*encode(" one two three two"), M.END], [*encode(" three one four"), M.END]]


def test_context_is_not_scored_and_scores_are_the_same_to_the_bit(monkeypatch):
    rng = np.random.default_rng(5)
    model = some_model(rng)
    offsets = np.cumsum([0, 1, 500, 33, 7, 32, 2000])
    ids = rng.integers(0, M.IDS, offsets[-1]).astype(np.int32)
    x, y, live, row = M.windows(ids, offsets, M.IDS)
    y, groups, rows, real = model.of[y], np.ones((M.CLASSES, 2), np.float32), [], M.Model.forward
    groups[::3, 1] = 0

    def forward(*given):
        out = real(*given)
        rows.append(out[-1][..., 0].size)
        return out

    monkeypatch.setattr(M.Model, "forward", forward)
    found = [[m[live] for m in M.score_windows(model, x, y, live, groups, M.Work(), model.tables(), most)] for most in (1, 3, 128)]
    first = np.append(True, row[1:] != row[:-1])
    assert sum(rows) == 3 * (first.sum() * M.WINDOW + (~first).sum() * (M.WINDOW - M.OVERLAP))
    whole = [m[live] for m in model.log_probabilities(x, y, groups)]
    for parts in found:
        assert all((a == b).all() for a, b in zip(parts, found[0], strict=True))
        assert all(np.allclose(a, b, rtol=1e-5, atol=1e-5) for a, b in zip(parts, whole, strict=True))
