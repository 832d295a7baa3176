"""Chunks by rolling hash find what repeats as a whole; only first places are looked at pair by pair."""

import random

from ledgerline.llm import line_dedup as L

from . import fixtures as X
from .test_line_runs import brute


def fresh(rng, n):
    return [" ".join(X.words(rng, 9)) for _ in range(n)]


def light_of(spark, rows):
    import pyarrow as pa

    found = L._hashed(iter([pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in rows], "part": [0] * len(rows), "text": [t for _, t in rows]})]), True)
    return spark.createDataFrame([tuple(r.values()) for b in found for r in b.to_pylist()], L.LIGHT).repartition(3)


def test_chunks_cover_all_pairs():
    rng = random.Random(4)
    for n in (0, 1, 2, 3, 40, 200):
        text = "\n\n ".join(fresh(rng, n)).encode()
        at = 0
        for first, _, pairs in L.pair_chunks(text):
            assert first == at and 0 < len(pairs) <= L.MOST
            at += len(pairs)
        assert at == len(L.line_pairs(text)) == max(n - 1, 0)
    text = ("same\n" * 100).encode()
    assert sum(len(p) for _, _, p in L.pair_chunks(text)) == 99
    # the same lines are cut alike wherever they stand
    shared = fresh(rng, 60)
    one, two = ({h for _, h, _ in L.pair_chunks("\n".join(fresh(rng, 5) + shared + fresh(rng, 4)).encode())} for _ in range(2))
    assert len(one & two) > 10


def test_whole_chunks_go_first(spark):
    rng = random.Random(5)
    block = fresh(rng, 40)
    rows = [(i, "\n".join(block)) for i in range(20)] + [(50, "\n".join(fresh(rng, 3) + block[7:30] + fresh(rng, 3)))]
    light = light_of(spark, rows)
    whole = L.repeated_units(light.drop("pairs"))
    assert whole.where("doc_id between 1 and 19").selectExpr("sum(size)").first()[0] == 19 * 39
    pairs = L.first_pairs(light)
    assert {r["doc_id"] for r in pairs.select("doc_id").distinct().collect()} == {0, 50}  # copies send no pairs
    assert pairs.count() < 39 + 29
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: (r["text"], r["n_removed"]) for r in L.line_dedup(docs, runs=True).collect()}
    assert found == brute(rows) and found[50][1] == 23
