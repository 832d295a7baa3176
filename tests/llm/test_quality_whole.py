"""Forest and threshold come from all labelled rows, however many, and equal a fit in one place."""

import numpy as np

from ledgerline.llm import quality_rules as Q


def many(spark, n):
    """Statistics of n documents; the last of them by hash are as odd as no other."""
    rng = np.random.default_rng(3)
    counts = {c: rng.integers(1, 60, n) for c in [*Q.COUNTS, *Q.EXTRA]}
    counts["n_words"] = rng.integers(200, 900, n)
    counts["word_chars"] = counts["n_words"] * 6
    counts["n_distinct"] = counts["n_words"] * 2 // 3
    rows = list(zip(range(n), *(c.tolist() for c in counts.values())))
    return spark.createDataFrame(rows, Q.SCHEMA).repartition(5)


def test_all_labelled_rows_teach(spark):
    n = 24_000
    stats = many(spark, n).cache()
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(n)], "doc_id long, quality int")
    rows = Q.placed(Q.labelled(stats, labels))
    found = rows.toPandas().sort_values("place")
    assert found["place"].tolist() == list(range(n))
    order = [r["doc_id"] for r in Q.labelled_sample(stats, labels, n).select("doc_id").collect()]
    assert found["doc_id"].tolist() == order
    x = Q.features({c: found[c].to_numpy() for c in [*Q.COUNTS, *Q.EXTRA]})
    forest, plain = Q.fit_forest(rows), Q.IsolationForest().fit(x)
    assert forest.norm == plain.norm and all((getattr(forest, k) == getattr(plain, k)).all() for k in ("feature", "split", "path"))
    first, _, _ = plain.extents(x.astype(np.float32), np.arange(n), 0)
    assert first.sum() == n and first.min() > 100  # each row in one tree, far more than the trees' least

    good = found["quality"].to_numpy() == 1
    scores = Q.scored(rows.where("quality = 1").select(*stats.columns), forest, Q.SCHEMA).select("anomaly")
    want = float(np.quantile(plain.score(x)[good], 0.998, method="higher")) + 1e-6
    assert Q.calibrate(scores, 0.002) == want


def test_values_by_rank(spark):
    values = [0.5] * 40 + [0.25, 0.25 + 2**-50, 0.9, 0.1, 1.0] + list(np.random.default_rng(1).random(500))
    table = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(3)
    for rank in (0, 1, 100, len(values) // 2, len(values) - 1):
        assert Q.value_at(table, rank) == sorted(values)[rank]


def test_few_rows_teach_several_trees():
    x = np.random.default_rng(2).random((3, 5))
    forest = Q.IsolationForest().fit(x)
    counts, _, _ = forest.extents(x.astype(np.float32), np.arange(3), 0)
    assert counts.sum() == 3 * forest.trees and set(counts.ravel()) == {3}
    assert np.isfinite(forest.score(x)).all()
