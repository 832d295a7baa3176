"""Hard negatives and whitening, against brute force on vectors with every odd case."""

import math
import random

import numpy as np
import pytest

from ledgerline.llm import hard_negatives as H
from ledgerline.llm.hard_negatives import hard_negatives
from ledgerline.llm.whitening import components, whiten

SCHEMA = "vec_id long, embedding array<float>, label int, id string, x string, n int, component string, list int, found int"


def rows(n=220, width=12, seed=3):
    rng = random.Random(seed)
    out = [[i * 5, [rng.gauss(0, 0.3) for _ in range(width)], rng.randrange(4)] for i in range(n)]
    hot = out[0][1]
    out += [[i * 5 + 1, hot, rng.randrange(4)] for i in range(n // 3)]  # a third are copies
    out += [list(out[10]), list(out[0])]  # repeated rows
    out += [[3, [0.5] * 5, 1], [4, [], 2], [50_000, [0.25] * 7, 0]]  # short and empty vectors
    out += [[6, None, 1], [7, [1.0, None] + hot[2:], 1], [8, [math.nan] + hot[1:], 1], [9, hot[:-1] + [math.inf], 1], [100_000, [1e30] + hot[1:], 1], [150_000, hot, None], [None, hot, 1]]
    out += [[200_000, [-v for v in hot], 9]]  # an anchor without positives
    return out


def frame(spark, data):
    return spark.createDataFrame([(i, v, y, "i", "x", 1, "c", 2, 3) for i, v, y in data], SCHEMA).repartition(3)


def floors(v, scale):
    return [math.floor(scale * float(np.float32(x))) for x in v]


def fine(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def expected(data):
    kept = {}
    for i, v, y in data:
        if i is not None and y is not None and fine(v):
            q = floors(v, 256)
            if sum(x * x for x in q) < 2**56:
                kept[i, y, tuple(q)] = None
    out = set()
    for i, y, q in kept:
        if i % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(q, r, strict=False)), j, z) for j, z, r in kept if j != i]
        for fall, j in sorted({(s, j) for s, j, z in scored if z == y})[:5]:
            p = -fall
            other = sorted({(s, k) for s, k, z in scored if z != y and 50 * p <= -100 * s <= 95 * p})[:3]
            out |= {(i, j, rank, k, p, -s) for rank, (s, k) in enumerate(other, 1)}
    return out


@pytest.mark.parametrize("sample", [4096, 40, 1])
def test_hard_negatives(spark, sample):
    data = rows()
    got = [tuple(r) for r in hard_negatives(frame(spark, data), sample=sample).collect()]
    assert len(got) == len(set(got))
    assert set(got) == expected(data)


def test_hard_negatives_in_many_blocks_and_cuts(spark, monkeypatch):
    data = rows(150, 20, 5)
    monkeypatch.setattr(H, "BLOCK_BYTES", 20 * 8 * 6)
    got = {tuple(r) for r in hard_negatives(frame(spark, data)).collect()}
    assert got == expected(data)


def test_index_leaves_out_covered_dimensions_and_loses_no_pair():
    rng = np.random.default_rng(1)
    x, rows = (np.round(rng.standard_normal((n, 40)) * np.geomspace(300, 2, 40)).astype(np.int64) for n in (60, 900))
    whole = rows @ x.T
    least = np.quantile(whole, 0.99, axis=0)
    index = H.Index(x, least, float(np.sqrt((rows**2).sum(1)).max()))
    assert sum(len(ids) for ids, _ in index.postings) < len(x) * len(index.postings)
    r, a, score = index.pairs(rows)
    assert set(zip(r.tolist(), a.tolist(), score.tolist(), strict=True)) == {(i, j, int(whole[i, j])) for i, j in zip(*np.nonzero(whole >= least), strict=True)}


def test_best_cuts_and_keeps_ties_by_id(monkeypatch):
    monkeypatch.setattr(H, "HELD", 10)
    rng = random.Random(2)
    pairs = [(rng.randrange(3), rng.randrange(4), rng.randrange(50)) for _ in range(400)]
    best = H.Best(3, 4)
    for k in range(0, 400, 7):
        best.add(*(np.array(c) for c in zip(*pairs[k : k + 7], strict=True)))
    got = list(zip(*(c.tolist() for c in best.cut()), strict=True))
    assert got == [p for at in range(3) for p in sorted({p for p in pairs if p[0] == at}, key=lambda p: (-p[1], p[2]))[:4]]


@pytest.mark.parametrize("width", [1, 2, 7, 64])
def test_components_equal_eigenvectors(width):
    rng = np.random.default_rng(width)
    for shape in (np.ones(width), np.geomspace(1, 1e-5, width)):
        m = rng.standard_normal((4 * width + 2, width)) * shape
        a = np.cov(m.T, bias=True).reshape(width, width)
        values, axes = components(a, 8)
        e, u = np.linalg.eigh(a)
        np.testing.assert_allclose(values, e[::-1][:8], atol=1e-13 * e.max())
        np.testing.assert_allclose(np.abs((axes * u[:, ::-1][:, :8]).sum(0)), 1, atol=1e-8)


def test_whitening(spark):
    data = rows(120, 10)
    got = whiten(frame(spark, data)).collect()
    kept = [(i, floors(v + [0.0] * (10 - len(v)), 1024)) for i, v, _ in data if fine(v) and max(map(abs, v), default=0) < 1e20]
    n = len(kept)
    x = np.array([[q + 100_000 for q in v] for _, v in kept], object)
    sums = x.sum(0)
    y = x.astype(float) - sums.astype(float) / n
    covariance = y.T @ y / n
    e, u = np.linalg.eigh(covariance)
    e, u = e[::-1][:8], u[:, ::-1][:, :8]
    want = sorted(((i if i is not None else -1), int(((n * r - sums) ** 2).sum())) for (i, _), r in zip(kept, x, strict=True))
    assert sorted((r["vec_id"] if r["vec_id"] is not None else -1, r["deviation"]) for r in got if r["component"] == 1) == want
    assert len(got) == 8 * n and {r["n"] for r in got} == {n}
    assert {r["identity_error"] < 1e-9 for r in got} == {True} and len({r["identity_error"] for r in got}) == 1
    mine = {}
    for r in got:
        mine.setdefault((r["vec_id"], r["deviation"]), {})[r["component"]] = r["whitened"]
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / covariance.trace(), rel=1e-9)
    white = y @ u / np.sqrt(e)
    signs = None
    for (i, _), r, w in zip(kept, x, white, strict=True):
        own = np.array([mine[i, int(((n * r - sums) ** 2).sum())][k] for k in range(1, 9)])
        signs = np.sign(own * w) if signs is None else signs
        np.testing.assert_allclose(own * signs, w, atol=1e-7)


def test_whitening_of_what_has_no_variance(spark):
    got = whiten(frame(spark, [[1, [0.5, 0.25], 0], [2, [0.5, 0.25], 0]])).collect()
    assert [(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in got] == [(0, None, 0.0, 0.0)] * 4
    flat = whiten(frame(spark, [[1, [0.5, 0.25], 0], [2, [0.25, 0.25], 0]])).collect()
    assert sorted((r["component"], r["whitened"] is None) for r in flat) == [(1, False), (1, False), (2, True), (2, True)]


def test_a_deviation_beyond_a_long_is_null(spark):
    got = whiten(frame(spark, [[1, [2.0**29], 0], [2, [-(2.0**29)], 0]])).collect()
    assert [r["deviation"] for r in got] == [None, None]


def test_empty(spark):
    none = frame(spark, [[1, None, 1]]).where("false")
    assert hard_negatives(none).collect() == [] and whiten(none).collect() == []
    assert whiten(frame(spark, [[1, [], 1], [2, None, 1]])).collect() == []
    assert hard_negatives(frame(spark, [[50, [], 1], [51, [], 1], [52, [], 2]])).count() == 1
