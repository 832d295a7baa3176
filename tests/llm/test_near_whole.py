"""Near duplicates that hide behind other rows of their buckets, against brute force."""

import numpy as np
import pytest

from ledgerline.llm import minhash as M

SCHEMA = "doc_id long, text string"


def brute(rows, words, percent=80):
    """Least id reachable by links from each id; the texts of one id count together."""
    sets = []
    for i, t in rows:
        w = t.encode().lower().split()
        sets.append((i, {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())))
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (i, p) in enumerate(sets):
        for j, q in sets[:x]:
            both = len(p & q)
            if both and 100 * both >= percent * (len(p) + len(q) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in root}


def corpus(seed):
    """Two long texts at about 0.8, many shorter ones of the same words around them, a large group of edits, repeated ids."""
    rng = np.random.default_rng(seed)
    fresh = iter(range(10**6))
    new = lambda n: [f"w{next(fresh)}" for _ in range(n)]
    base = new(300)
    other = list(base)
    other[20:48] = new(28)
    rows = [(500, base), (900, other)]
    for k in range(70):
        rows.append((int(k if k % 2 else 501 + k), base[: int(rng.integers(150, 232))] + new(int(rng.integers(0, 3)))))
    core = new(120)
    for k in range(60):
        w = list(core)
        for at in rng.integers(0, 120, int(rng.integers(0, 9))):
            w[at] = next(iter(new(1)))
        rows.append((2000 + k, w))
    rows += [(3000, new(40)), (3000, core[:119]), (3001, new(1)), (3002, [])]
    rows = [(i, " ".join(w)) for i, w in rows]
    return [rows[k] for k in rng.permutation(len(rows))]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_no_link_is_lost(spark, seed):
    rows = corpus(seed)
    want = brute(rows, 2)
    found = M.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5), words=2).collect()
    assert len(found) == len(rows)
    assert {r["doc_id"]: r["component_id"] for r in found} == want
    assert want[900] == want[500] and len(set(want.values())) < len(want) - 60


@pytest.mark.parametrize("crowd,batch", [(16_384, 100), (16_384, 7), (9, 10)])
def test_groups_meet_in_every_bucket(crowd, batch, monkeypatch):
    """All pairs of groups with close rows in a bucket, however the stream is cut; with few rows kept, at least those."""
    import pyarrow as pa

    monkeypatch.setattr(M, "CROWD", crowd)
    rng = np.random.default_rng(4)
    rows = []
    for key, size in enumerate(rng.integers(1, 90, 25)):
        marks = rng.integers(0, 1 << 16, M.POSITIONS, dtype=np.uint16)
        for _ in range(size):
            own = marks.copy()
            own[rng.choice(M.POSITIONS, int(rng.integers(0, 40)), replace=False)] ^= 5
            four = (own & 15).astype(np.uint64).reshape(M.PACKED, 16)
            rows.append((key, int(rng.integers(0, 12)), 100, (four << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(1, dtype=np.uint64)))
    rows.sort(key=lambda r: r[:2])
    want = set()
    for i, (k, g, _, p) in enumerate(rows):
        for l, h, _, q in rows[:i]:
            if k == l and g != h and M.differing(p, q) <= M.DISTANCE:
                want.add((min(g, h), max(g, h)))
    def batches():
        for lo in range(0, len(rows), batch):
            part = rows[lo : lo + batch]
            packed = np.stack([p for *_, p in part]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in ([r[0] for r in part], [r[1] for r in part], [r[2] for r in part], *packed.T)], ["key", "label", "n", *M._WORDS])
    found = {pair for b in M._apart(80)(batches()) for pair in zip(b.column("a").to_pylist(), b.column("b").to_pylist())}
    assert found == want if crowd > 1000 else found >= want
