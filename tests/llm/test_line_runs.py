"""Repeated runs of lines against a search that compares all earlier lines one by one."""

import random

from ledgerline.llm.line_dedup import line_dedup
from ledgerline.llm.queries import op7_line_dedup

from . import fixtures as X


def brute(rows):
    """Kept text and lines removed by id: lines in a run of two or more that stands earlier in reading order."""
    before, out = [], {}
    for doc, text in rows:
        lines = text.split("\n")
        lines = [x + "\n" for x in lines[:-1]] + ([lines[-1]] if lines[-1] else [])
        own = [(k, x.encode().strip()) for k, x in enumerate(lines) if x.encode().strip()]
        gone = set()
        for n in range(len(own) - 1):
            a, b = own[n], own[n + 1]
            earlier = any(x[i : i + 2] == [a[1], b[1]] for x in before for i in range(len(x) - 1)) or any([own[i][1], own[i + 1][1]] == [a[1], b[1]] for i in range(n))
            if earlier:
                gone |= set(range(a[0], b[0] + 1))
        before.append([x for _, x in own])
        out[doc] = ("".join(x for k, x in enumerate(lines) if k not in gone), len(gone))
    return out


def corpus():
    rng = random.Random(8)
    fresh = lambda n: [" ".join(X.words(rng, 9)) for _ in range(n)]
    rows, shared = [], 0
    for length in (1, 2, 3, 5, 8, 10):
        for _ in range(10):
            block = fresh(length)
            for side in range(2):
                text = "\n".join(fresh(4) + block + fresh(3))
                rows.append((len(rows), text.replace("\n", "\n\n  ", 3) if side else text))
            shared += length if length > 1 else 0
    rows += [(len(rows), "same\n" * 5 + "other"), (len(rows) + 1, ""), (len(rows) + 2, "\n \n")]
    return rows, shared


def test_all_repeated_runs_go(spark, tmp_path):
    rows, shared = corpus()
    want = brute(rows)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup(table, runs=True).collect()}
    assert found == want
    assert sum(n for doc, (_, n) in found.items() if doc < 120) >= shared  # blank lines between go too
    table.write.parquet(str(tmp_path / "documents.parquet"))
    assert {r["doc_id"]: r["n_removed"] for r in op7_line_dedup(spark, str(tmp_path)).collect()} == {doc: n for doc, (_, n) in want.items()}


def test_columns_with_our_names_stay(spark):
    rows, _ = corpus()
    names = ["doc_id", "text", "gone", "n_lines", "others", "n_removed", "bytes", "listed"]
    table = spark.createDataFrame([(i, t, "a", 33, "b", 44, "c", "d") for i, t in rows], names).repartition(3)
    want = {i: t for i, (t, _) in brute(rows).items()}
    found = line_dedup(table, runs=True, counts=False)
    assert found.columns == names
    assert {r["doc_id"]: r["text"] for r in found.collect()} == want
    assert {tuple(r)[2:] for r in found.collect()} == {("a", 33, "b", 44, "c", "d")}
    (one,) = line_dedup(table.where("doc_id = 0"), runs=True).collect()
    assert one["n_removed"] == 0 and one["n_lines"] > 5 and one["gone"] == "a"


def test_texts_of_one_id_are_apart(spark):
    rows = [(1, "a b\nc d\ne f"), (2, "a b\nc d\nother"), (2, "x\ny\nz\nu\nv"), (2, "x\ny\nz\nu\nv"), (3, "v\nz\nu\nv")]
    found = sorted((r["doc_id"], r["text"]) for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), runs=True).collect())
    assert found == [(1, rows[0][1]), (2, "other"), (2, rows[2][1]), (2, rows[2][1]), (3, "v\n")]


def test_equal_hashes_of_other_bytes_stay():
    from ledgerline.llm import line_dedup as L

    text = lambda a: f"one line {a}\nanother line {a}\n"
    import pyarrow as pa

    listed = [[{"at": 0, "size": 1, "bytes": b"one line x\nanother line x"}], [{"at": 0, "size": 1, "bytes": b"one line x\nanother line x"}]]
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "part": [8, 9], "text": [text("x"), text("y")], "listed": listed})
    (out,) = L._same_bytes(iter([batch]), True)
    assert out.column("gone").to_pylist() == [[0], []]
