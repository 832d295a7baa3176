"""LM scoring over the whole corpus: order of words, ids of their own, context and rare words."""

import collections
import math

import numpy as np

from ledgerline.llm import lm_scoring as M

from . import fixtures as X


def test_order_of_words_is_learned_from_all_documents(spark):
    rows = [(i, "red blue green gold " * 6, "en", "s", 0) for i in range(30)] + [(100, "red blue green gold " * 6, "en", "s", 0), (101, "gold green blue red " * 6, "en", "s", 0)]
    found = X.by_id(M.lm_scores(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(2)))
    assert found[100]["base_score"] == found[101]["base_score"]
    assert found[100]["score"] > found[101]["score"] + 3


def tools():
    ranks = M.read_ranks(M.VOCABULARY)
    return ranks, M.encoder(ranks), M.opening(ranks)


def test_class_pairs_are_those_of_the_texts():
    ranks, encode, opens = tools()
    classes, _ = M.id_classes(np.random.default_rng(4).integers(0, 9, M.IDS).astype(float), opens)
    want, texts = collections.Counter(), [(r[1] or "").encode() for r in X.rows()]
    for raw in texts:
        low = bytes(M.K.LOWER[np.frombuffer(raw, np.uint8)])
        ids = [i for w in low.split() for i in encode(" " + w.decode())] + [M.END]
        own = [M.START, *(int(classes[i]) for i in ids)]
        want.update(zip(own[:-1], own[1:], strict=True))
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    *_, ids, offsets = M.sequences(M.Speller(ranks, opens), np.frombuffer(b"".join(texts), np.uint8), at)
    x, y, live, _ = M.windows(ids, offsets, M.IDS, 0)
    single = np.ones(M.CLASSES)
    model = M.Model.start(single, np.append(classes, M.START))
    seen, times, pairs = model.train(iter([(x, classes[y], live)]), single)
    found = pairs.reshape(M.CLASSES + 1, M.CLASSES)
    assert {(i, j): int(found[i, j]) for i, j in zip(*np.nonzero(found), strict=True)} == want
    assert seen == len(ids) == sum(want.values())


def test_spelling_is_kept_from_text_to_text():
    ranks, encode, opens = tools()
    speller = M.Speller(ranks, opens, most=4)
    for text in ("", "one two", "two three one two", "a b c d e f", "one", "\u00e9t\u00e9 two"):
        low = np.frombuffer(text.encode(), np.uint8)
        starts, ends, _ = M.K.word_spans(low, np.array([0, len(low)]))
        lengths, ids = speller.spell(low, starts, ends, M.K.span_hashes(low, starts, ends))
        assert ids.tolist() == [i for w in text.split() for i in encode(" " + w)]
        assert lengths.tolist() == [len(encode(" " + w)) for w in text.split()]


def test_ids_of_one_class_learn_apart():
    of = np.append(np.arange(M.CLASSES) % 7, M.START)
    single = np.ones(M.CLASSES)
    model = M.Model.start(single, of)
    assert (model.weights["embed"][3] == model.weights["embed"][10]).all()
    x = np.where(np.random.default_rng(1).random((200, M.WINDOW)) < 0.5, 3, 10)
    y = np.where(x == 3, 1, 2)
    live = np.ones(x.shape, bool)
    seen, times, _ = model.train(((x[k : k + 20], y[k : k + 20], live[k : k + 20]) for _ in range(40) for k in range(0, 200, 20)), single)
    assert seen == 40 * x.size and set(np.flatnonzero(times)) == {3, 10}
    groups = np.ones((M.CLASSES, 2), np.float32)
    assert model.log_probabilities(x, y, groups)[0].mean() > math.log(0.9)  # a model of classes only gets log 0.5 at most


def test_later_windows_start_with_eight_ids_of_context():
    _, _, live, row = M.windows(np.arange(300) % M.CLASSES, np.array([0, 300]))
    assert len(row) > 1 and (live[1:].argmax(1) >= 8).all()


def test_rare_words_get_their_share(spark):
    whole, few = (X.by_id(M.lm_scores(X.docs(spark), head_words=head)) for head in (500_000, 20))
    for i, r in whole.items():
        assert math.isclose(r["score"], few[i]["score"], rel_tol=1e-5), i


def plain_scores(model, given, escape, counts, n_docs):
    """Each row's score by loops: a softmax for each id, then the words one by one."""
    encode = M.encoder(given.ranks)
    class_words = np.bincount(given.classes, minlength=M.CLASSES) * 0.0
    for w, c in counts.items():
        class_words[given.classes[encode(" " + w.decode())[0]]] += c
    starting, w = given.starting(), {k: v.astype(float) for k, v in model.weights.items()}

    def log_classes(context):
        h = w["embed"][context] + w["place"][: len(context)]
        s = (h @ w["key"]) @ (h[-1] @ w["query"]) / math.sqrt(M.WIDTH)
        a = np.exp(s - s.max())
        z = h[-1] + (a / a.sum()) @ (h @ w["value"])
        logits = z @ w["out"] + model.pairs[model.of[context[-1]]]
        return logits - logits.max() - math.log(np.exp(logits - logits.max()).sum())

    out = {}
    for doc, text in [(r[0], (r[1] or "")) for r in X.rows()]:
        words = bytes(M.K.LOWER[np.frombuffer(text.encode(), np.uint8)]).split()
        spelled = [encode(" " + x.decode()) for x in words]
        ids = [i for x in spelled for i in x] + [M.END]
        logs = []
        for k in range(len(ids)):
            first = 0 if k < M.WINDOW else ((k - M.OVERLAP) // (M.WINDOW - M.OVERLAP)) * (M.WINDOW - M.OVERLAP)
            logs.append(log_classes(np.array(([M.IDS] + ids)[first : k + 1])))
        opening = [math.log(np.exp(v[starting]).sum()) for v in logs]
        total, at = 0.0, 0
        for x, part in zip(words, spelled, strict=True):
            c = given.classes[part[0]]
            spell = sum(given.within[i] for i in part) + sum(logs[at + k][given.classes[i]] for k, i in enumerate(part) if k) + opening[at + len(part)]
            share = counts[x] / class_words[c] if counts[x] else 0.0
            total += logs[at][c] - opening[at] + math.log((1 - escape) * share + escape * math.exp(spell))
            at += len(part)
        out[doc] = (total + logs[at][M.CLASSES - 1] - opening[at]) / math.log(10)
    return out


def test_scores_are_those_of_plain_loops(spark, monkeypatch):
    caught = {}
    real = M.train_attention

    def train(docs, tools, *rest):
        caught["tools"], caught["model"] = tools.value, real(docs, tools, *rest)
        return caught["model"]

    monkeypatch.setattr(M, "train_attention", train)
    found = X.by_id(M.lm_scores(X.docs(spark)))
    counts = collections.Counter()
    for r in X.rows():
        if not found[r[0]]["held_out"]:
            counts.update((r[1] or "").encode().lower().split())
    escape = sum(c == 1 for c in counts.values()) / sum(counts.values())
    want = plain_scores(caught["model"], caught["tools"], escape, counts, None)
    for i, r in found.items():
        assert math.isclose(r["score"], want[i], rel_tol=1e-4, abs_tol=1e-3), i


def test_scores_do_not_depend_on_partitions_and_beat_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one, two = ({r["doc_id"]: r for r in M.lm_scores(docs.repartition(n)).collect()} for n in (1, 5))
    assert all(math.isclose(r["score"], two[i]["score"], rel_tol=1e-4) for i, r in one.items())
    # the base gives any new word one constant, so they compare where all words are known
    known = [r for r in one.values() if r["n_known"] == r["n_tokens"]]
    assert sum(r["score"] for r in known) > sum(r["base_score"] for r in known)
