"""Near, substring, suffix and line dedup against brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import repeats as R
from ledgerline.llm import suffix_dedup as S
from ledgerline.llm.line_dedup import LEAST, chunks, line_dedup
from ledgerline.llm.minhash import near_duplicates
from ledgerline.llm.substring_dedup import FingerprintIndex, _stored_order, repeated_ranges, substring_dedup

from . import fixtures as X


def ordered():
    """Texts in order of occurrence: the null id is first; repeated rows once."""
    seen = {(r[0], r[1] or "") for r in X.rows()}
    return sorted(seen, key=lambda r: (-(1 << 63) if r[0] is None else r[0]))


def components(words):
    sets = {}
    for i, t in ordered():
        if i is not None:
            w = t.encode().lower().split()
            sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                n = len(sets[a] & sets[b])
                if a < b and n and 100 * n >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return sets, label


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates(spark, words):
    sets, label = components(words)
    found = X.by_id(near_duplicates(X.docs(spark), words=words))
    assert set(found) == set(label) | {None}
    for i, c in label.items():
        assert (found[i]["n_shingles"], found[i]["component_id"], found[i]["kept"]) == (len(sets[i]), c, c == i)
    assert found[None]["component_id"] is None and found[None]["kept"]


def windows_removed(units, size):
    seen, out = set(), {}
    for i, u in units:
        mask = np.zeros(len(u), bool)
        for k in range(len(u) - size + 1):
            key = tuple(u[k : k + size])
            if key in seen:
                mask[k : k + size] = True
            seen.add(key)
        out[i] = mask
    return out


def test_substring_dedup(spark):
    units = [(i, t.encode().split()) for i, t in ordered()]
    removed = windows_removed(units, 20)
    for batches in (1, 7):
        found = X.by_id(substring_dedup(X.docs(spark), batches=batches))
        for i, w in units:
            kept = b" ".join(x for x, gone in zip(w, removed[i]) if not gone)
            assert (found[i]["n_words"], found[i]["n_removed"], found[i]["kept_sha256"]) == (len(w), removed[i].sum(), hashlib.sha256(kept).hexdigest()), i
    assert sum(m.sum() for m in removed.values()) > 200


def test_index_is_incremental_and_compacts(spark):
    docs = R.numbered(X.docs(spark).where("doc_id is not null"))
    index = FingerprintIndex(spark, fan_in=2)
    found = []
    for lo, hi in ((0, 40), (40, 100), (100, 140), (140, 10**6)):
        batch = docs.where(f"doc_id >= {lo} and doc_id < {hi}")
        found.append({tuple(r) for r in repeated_ranges(batch, docs, index, lo).collect()})
        index.compact()
        assert len(index.runs) <= 2
    rows = index.rows()
    assert rows.count() == rows.select("gram", "around").distinct().count()
    whole = FingerprintIndex(spark)
    spread = lambda ranges: {(d, s) for d, a, b in ranges for s in range(a, b + 1)}
    assert spread(set().union(*found)) == spread({tuple(r) for r in repeated_ranges(docs, docs, whole, 0).collect()})


def test_an_index_is_opened_again(spark, tmp_path):
    """A second session has the folder alone: it goes on, and equals one run over all."""
    docs, folder = X.docs(spark).where("doc_id is not null"), f"file://{tmp_path}/index"
    early, late = docs.where("doc_id < 70"), docs.where("doc_id >= 70")
    first = substring_dedup(early, batches=2, index=FingerprintIndex(spark, folder, fan_in=1, buckets=3)).collect()
    again = FingerprintIndex(spark, folder, fan_in=1)
    assert again.buckets == 3 and len(again.runs) == 1 and again.rows().count() > 0
    second = substring_dedup(late, batches=3, index=again, archive=early).collect()
    assert len(again.runs) == 1
    whole = {tuple(r) for r in substring_dedup(docs, batches=1).collect()}
    assert {tuple(r) for r in first + second} == whole


def test_runs_are_merge_joined_where_they_lie(spark):
    """A batch's grams move; the runs do not, and are not sorted again."""
    docs = R.numbered(X.docs(spark).where("doc_id is not null"))
    index = FingerprintIndex(spark, fan_in=9, buckets=4)
    for lo, hi in ((0, 60), (60, 120)):
        repeated_ranges(docs.where(f"doc_id >= {lo} and doc_id < {hi}"), docs, index, lo)
    assert len(index.runs) == 2
    grams = spark.range(5).selectExpr("id as gram")
    with _stored_order(spark):
        plan = index.known(grams)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and plan.count("Bucketed: true") == 2
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Sort [") == 2  # both for the grams
    some = index.rows().select("gram").limit(7)
    assert index.known(some).select("gram").distinct().count() == some.distinct().count()


@pytest.mark.parametrize("group_rows", [5000, 1])
def test_suffix_dedup(spark, group_rows):
    units = [(i, t.encode()) for i, t in ordered()]
    removed = windows_removed(units, 100)
    found = X.by_id(suffix_dedup_of(spark, group_rows))
    for i, raw in units:
        mask = removed[i]
        kept = np.frombuffer(raw, np.uint8)[~mask].tobytes()
        spans = int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum())
        assert (found[i]["n_bytes"], found[i]["n_removed"], found[i]["n_spans"], found[i]["kept_sha256"]) == (len(raw), mask.sum(), spans, hashlib.sha256(kept).hexdigest()), i


def suffix_dedup_of(spark, group_rows):
    return S.suffix_dedup(X.docs(spark), group_rows=group_rows)


def test_suffix_order():
    rng = np.random.default_rng(1)
    buf = rng.integers(97, 99, 4000).astype(np.uint8)
    buf[2000:2600] = buf[:600]
    at, segment = rng.integers(0, 3900, 500), np.sort(rng.integers(0, 20, 500))
    order = S.Suffixes(buf, 100).sort(at, segment)
    want = sorted(range(500), key=lambda k: (segment[k], buf[at[k] : at[k] + 100].tobytes(), k))
    assert order.tolist() == want


def test_anchors_do_not_depend_on_place():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 1 << 60, 400).astype(np.uint64)
    units = R.Units("words", 20, 8)
    alone = R.anchors(values[100:300], np.array([0, 200]), units)
    inside = R.anchors(np.concatenate([values, values[100:300]]), np.array([0, 400, 600]), units)
    second = inside[2] == 1
    for a, b in zip(alone[:2] + alone[3:], inside[:2] + inside[3:], strict=True):
        assert a.tolist() == b[second].tolist()


def test_line_dedup(spark):
    seen, want = set(), {}
    for i, t in sorted((r for r in ordered() if r[0] is not None)):
        raw, kept = t.encode(), b""
        own = []
        for s, e, n in chunks(raw):
            piece = raw[s:e].strip()
            gone = n >= LEAST and piece and piece in seen
            own.append(piece if n >= LEAST else b"")
            kept += b"" if gone else raw[s:e]
            seen.add(piece if n >= LEAST else b"")
        want[i] = kept.decode()
    docs = X.docs(spark)
    found = X.by_id(line_dedup(docs))
    assert found[7]["text"] is None and len(found) == len(want) + 1
    assert {i: found[i]["text"] or "" for i in want} == want
    assert any(len(want[i]) < len(t) for i, t in ordered() if i is not None)
    assert docs.columns == ["doc_id", *docs.columns[1:]] and "n_removed" in line_dedup(docs).columns


def test_empty_tables(spark):
    for op in (near_duplicates, substring_dedup, S.suffix_dedup, line_dedup):
        assert op(X.empty(spark)).count() == 0


def test_texts_of_one_id_are_apart(spark):
    """Repeated ids and missing ones: each text keeps its own ranges."""
    rng = np.random.default_rng(3)
    fresh = lambda n: " ".join(map(str, rng.integers(10**6, 10**7, n)))
    w, v, u, t = (fresh(n) for n in (40, 45, 50, 60))
    rows = [(1, w), (2, w), (2, v), (2, v), (3, v + " " + u), (None, t), (None, u), (5, t)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in substring_dedup(docs).collect())
    assert got == [(0, 50, 0), (0, 60, 0), (1, 40, 0), (2, 40, 40), (2, 45, 0), (2, 45, 0), (3, 95, 95), (5, 60, 60)]
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"]) for r in S.suffix_dedup(docs).collect())
    size = lambda x: len(x.encode())
    both = size(v + " " + u)
    assert got == [(0, size(u), 0), (0, size(t), 0), (1, size(w), 0), (2, size(w), size(w)), (2, size(v), 0), (2, size(v), 0), (3, both, both - 1), (5, size(t), size(t))]


def test_tasks_tell_what_they_have_met():
    rng = np.random.default_rng(5)
    met, seen = R.Met(), {}
    for _ in range(6):
        gram, around, doc, at = (rng.integers(0, k, 300) for k in (6, 3, 50, 20))
        later, lead_doc, lead_at = met.later(gram, around, doc, at)
        for g, a, d, p, gone in zip(*(x.tolist() for x in (gram, around, doc, at, later)), strict=True):
            seen.setdefault((g, a), []).append(((d, p), gone))
    for places in seen.values():
        least = min(p for p, _ in places)
        assert all(p >= least for p, gone in places if gone) and not all(gone for p, gone in places if p == least)
        assert sum(gone for _, gone in places) >= len(places) - 6


@pytest.mark.parametrize("op,schema", [(substring_dedup, "n_words"), (S.suffix_dedup, "n_bytes")])
def test_very_long_texts(spark, op, schema):
    """A text over several slices, whose second half repeats a part of the first."""
    rng = np.random.default_rng(9)
    words = [str(x) for x in rng.integers(10**7, 10**8, 150_000)]
    text = " ".join(words[:140_000] + words[20_000:120_000] + words[140_000:])
    found = {r["doc_id"]: r for r in op(spark.createDataFrame([(1, text), (2, "short one")], "doc_id long, text string")).collect()}
    assert found[1]["n_removed"] == (100_000 if schema == "n_words" else 9 * 100_000 + 1) and found[2]["n_removed"] == 0


def test_bytes_decide(spark):
    """Hashes that lie: what an earlier place doesn't have stays, and stretches join touching places alone."""
    rng = np.random.default_rng(8)
    text = "".join(map(chr, rng.integers(97, 123, 900)))
    rows = [(1, text), (2, "x" * 50 + text[:600]), (3, text[300:] + "y" * 200), (4, "z" * 300)]
    texts = R.numbered(spark.createDataFrame(rows, "doc_id long, text string"))
    window = S.UNITS.window
    true = [(2, 50, 300, 1, 0), (2, 301, 550, 1, 251), (3, 0, 100, 1, 300), (3, 90, 500, 1, 390)]
    false = [(4, 0, 100, 1, 0), (2, 0, 20, 1, 7)]
    links = spark.createDataFrame(true + false, "doc_id long, first long, last long, lead long, lead_first long")
    assert sorted(map(tuple, R.stretches(links).collect())) == [(2, 0, 20, 1, 7), (2, 50, 550, 1, 0), (3, 0, 500, 1, 300), (4, 0, 100, 1, 0)]
    gone = R.proven(links, texts, window)
    found = {r["doc_id"]: r["n_removed"] for r in R.rebuilt(texts, gone, S._digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", ["n_bytes", "n_removed", "n_spans", "kept_sha256"], window).collect()}
    assert found == {1: 0, 2: 600, 3: 600, 4: 0}


def test_nothing_goes_by_hashes_alone(spark, monkeypatch):
    """Half of the links point a byte beside the earlier place, as false hashes would: those remove nothing, and the others what they did."""
    docs, real = X.docs(spark), R.as_links
    whole = X.by_id(S.suffix_dedup(docs))
    monkeypatch.setattr(R, "as_links", lambda places: real(places).withColumn("lead_first", F.col("lead_first") + (F.col("first") % 2)))
    found = X.by_id(S.suffix_dedup(docs))
    kept = {i: r for i, r in found.items() if r["kept_sha256"] != whole[i]["kept_sha256"]}
    assert kept and all(r["n_removed"] <= whole[i]["n_removed"] for i, r in kept.items())
