"""Edited test items are found, and in-order overlap agrees with brute force."""

import random

import numpy as np

from ledgerline.llm import decontamination as D


def edited(rng, words, at, kind):
    out = list(words)
    if kind == "comma":
        out[at] = out[at].rstrip(".?") + ","
    elif kind == "new":
        out.insert(at, "inserted")
    elif kind == "lost":
        del out[at]
    else:
        out[at] = "changed"
    return out


def test_every_single_edit_is_found(spark):
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(3000)]
    items, docs, want = [], [], set()
    for i in range(20):
        question, answer = rng.sample(vocabulary, rng.randint(8, 20)), rng.sample(vocabulary, rng.randint(4, 12))
        question[-1] += "?"
        answer[-1] += "."
        words = question + answer
        items.append((i, " ".join(words)))
        for at in range(len(words)):
            for kind in ("changed", "new", "lost", "comma"):
                doc = len(docs)
                around = [" ".join(rng.sample(vocabulary, 60)) for _ in range(2)]
                docs.append((doc, f"{around[0]} {' '.join(edited(rng, words, at, kind))} {around[1]}"))
                want.add((doc, i))
    clean = len(docs)
    docs += [(clean + k, " ".join(rng.sample(vocabulary, 300))) for k in range(200)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = {(r["doc_id"], r["item_id"]) for r in D.contaminated(table, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert found == want


def test_three_edits_anywhere(spark):
    """Random words of real items are replaced, and other texts stand around: nearly all are found, and no clean text."""
    rng = random.Random(5)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    rest = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) > 400").orderBy("doc_id").collect()]
    docs, want = [], {}
    for edits in (0, 1, 2, 3):
        for i, text in items:
            for _ in range(3):
                words = text.split()
                for at in rng.sample(range(len(words)), min(edits, len(words))):
                    words[at] = "edit" + "".join(rng.choices("abcdef", k=5))
                want[len(docs)] = (edits, i)
                docs.append((len(docs), " ".join(["lead in", *words, "and out"])))
    clean = len(docs)
    docs += [(clean + k, " ".join(rng.sample(t.split(), len(t.split())))) for k, t in enumerate(rest)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = {(r["doc_id"], r["item_id"]) for r in D.contaminated(table, spark.createDataFrame(items, "item_id long, text string")).collect()}
    recall = [np.mean([(d, i) in found for d, (e, i) in want.items() if e == edits]) for edits in range(4)]
    assert recall[0] == 1 and recall[1] >= 0.98 and recall[2] >= 0.95 and recall[3] >= 0.9, recall
    assert not [d for d, _ in found if d >= clean]


def brute(part, weights, words):
    best = 0.0
    size = len(part) + len(part) // 4 + 2
    for s in range(len(words)):
        piece = words[s : s + size]
        table = [[0.0] * (len(piece) + 1) for _ in range(len(part) + 1)]
        for i, p in enumerate(part):
            for j, w in enumerate(piece):
                table[i + 1][j + 1] = max(table[i][j + 1], table[i + 1][j], table[i][j] + weights[i] if p == w else 0.0)
        best = max(best, table[-1][-1])
    return best


def test_overlap_in_order():
    rng = random.Random(2)
    for _ in range(150):
        part = [rng.randrange(12) for _ in range(rng.randint(1, 14))]
        weight = [0.1 + rng.random() for _ in range(12)]
        words = [rng.randrange(20) for _ in range(rng.randint(0, 20))]
        for _ in range(rng.randint(0, 3)):
            words[len(words) // 2 : len(words) // 2] = [w for w in part if rng.random() < 0.8]
        weights = np.array([weight[p] for p in part])
        found = D.in_order(np.array(part, np.uint64), weights, np.array(words, np.uint64), 0.0)
        assert np.isclose(found, brute(part, weights, words))


def test_punctuation_is_no_part_of_a_word():
    text = b"a, (b) -- c-d 'e'... ?"
    buf = np.frombuffer(text, np.uint8)
    starts, ends, rows = D.strip_spans(buf, *D.K.word_spans(buf, np.array([0, len(text)])))
    assert [text[s:e] for s, e in zip(starts, ends, strict=True)] == D.stripped(text.split()) == [b"a", b"b", b"c-d", b"e"]
    assert len(rows) == 4
