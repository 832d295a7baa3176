"""The pipeline's stages, one by one and in a row."""

import corpus_pipeline as P

from ledgerline.llm.decontamination import contaminated
from ledgerline.llm.line_dedup import line_dedup
from ledgerline.llm.minhash import near_duplicates
from ledgerline.llm.mixing import mix
from ledgerline.llm.quality_rules import quality_rules

FOLDER = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    bench, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("benchmark", "labels"))
    assert [n for n, _ in P.STAGES] == ["quality rules", "line dedup", "MinHash near-dedup", "benchmark decontamination", "mixing"]
    checks = [
        lambda a, b: ids(b) == ids(quality_rules(a, labels).where("kept")),
        lambda a, b: sorted((r["doc_id"], r["text"]) for r in b.collect()) == sorted((r["doc_id"], r["text"]) for r in line_dedup(a, runs=True).collect()),
        lambda a, b: ids(b) == ids(near_duplicates(a).where("kept")),
        lambda a, b: ids(b) == sorted(set(ids(a)) - set(ids(contaminated(a, bench)))),
        lambda a, b: sorted(map(tuple, b.collect()), key=repr) == sorted(map(tuple, mix(a).collect()), key=repr),
    ]
    for k, ((name, stage), check) in enumerate(zip(P.STAGES, checks, strict=True)):
        path = str(tmp_path / str(k))
        stage(spark, docs, FOLDER).write.parquet(path)
        out = spark.read.parquet(path)
        assert check(docs, out), name
        if k < 4:
            assert out.columns == docs.columns, name
        docs = out
    assert sorted(map(tuple, P.run(spark, FOLDER).collect()), key=repr) == sorted(map(tuple, docs.collect()), key=repr)


def test_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()}
    assert "pipeline" in names


def plain_lines(rows):
    """Texts without the lines of pairs of lines that stand earlier."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        lines = t.split("\n")
        lines = [x + "\n" for x in lines[:-1]] + ([lines[-1]] if lines[-1] else [])
        own, gone = [(k, x.encode().strip()) for k, x in enumerate(lines) if x.encode().strip()], set()
        for (a, x), (b, y) in zip(own[:-1], own[1:]):
            if (x, y) in seen:
                gone |= set(range(a, b + 1))
            seen.add((x, y))
        out[i] = "".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def test_line_near_and_mixing_stages_against_plain_loops(spark):
    """Stages over the whole small table, each against loops of its own."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(10**9)
    rows = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    cut = plain_lines(rows.items())
    lined = P.lines(spark, docs, FOLDER)
    assert {r["doc_id"]: r["text"] or "" for r in lined.collect()} == cut

    sets = {i: (lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()))(t.encode().lower().split()) for i, t in rows.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b]) if a < b else 0
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert set(ids(P.near(spark, docs, FOLDER))) == {i for i in sets if find(i) == i}

    mixed = P.mixture(spark, docs, FOLDER).collect()
    size = {i: len(t.encode().split()) for i, t in rows.items()}
    assert {r["doc_id"]: r["size"] for r in mixed} == size
    for source in {r["source"] for r in mixed}:
        own = [r for r in mixed if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 1 and all(r["taken"] <= 2 * r["size"] for r in own)


def test_clashing_columns_pass_the_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").selectExpr("*", "'a' gone", "33 n_lines", "'b' kept", "1.5d score", "'c' signature", "'d' others")
    for _, stage in P.STAGES[:-1]:
        docs_out = stage(spark, docs, FOLDER)
        assert docs_out.columns == docs.columns
        assert {(r["gone"], r["n_lines"], r["kept"]) for r in docs_out.collect()} == {("a", 33, "b")}


def test_whole_pipeline_against_plain_loops(spark):
    """All five stages in a row, by loops alone, over the whole small tables."""
    from ledgerline.llm import quality_rules as Q

    from .test_search import shares
    from .test_verdicts import measured, walked

    t = lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")
    rows = {r["doc_id"]: (r["text"] or "", r["source"]) for r in t("documents").collect()}
    quality = {r["doc_id"]: r["quality"] for r in t("labels").collect()}

    by_loop = {i: measured(text) for i, (text, _) in rows.items()}
    order = Q.labelled_sample(Q.statistics(t("documents")), t("labels"), 20_000).toPandas()["doc_id"]
    forest = Q.IsolationForest().fit(Q.np.array([by_loop[i][0] for i in order]))
    good = sorted(walked(forest, by_loop[i][0]) for i in order if quality[i] == 1 and not by_loop[i][1])
    threshold = good[-(-(len(good) - 1) * 998 // 1000)] + 1e-6
    kept = {i: rows[i] for i, (f, failed) in by_loop.items() if not failed and walked(forest, f) < threshold}
    assert len(kept) < len(rows)

    cut = plain_lines((i, text) for i, (text, _) in kept.items())
    assert any(cut[i] != kept[i][0] for i in kept)

    words = {i: text.encode().lower().split() for i, text in cut.items()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()) for i, w in words.items()}
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and (n := len(sets[a] & sets[b])) and 100 * n >= 80 * len(sets[a] | sets[b])]
    while any(label[a] != label[b] for a, b in links):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    apart = {i for i in sets if label[i] == i}
    assert len(apart) < len(sets)

    plain = lambda ws: b" " + b" ".join(x for x in (w.strip(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") for w in ws) if x) + b" "
    items = [plain(r["text"].encode().lower().split()) for r in t("benchmark").collect() if r["text"]]
    clean = {i for i in apart if not any(x in plain(words[i]) for x in items)}
    assert len(clean) < len(apart)

    found = {r["doc_id"]: r for r in P.run(spark, FOLDER).collect()}
    assert set(found) == clean and {i: r["size"] for i, r in found.items()} == {i: len(words[i]) for i in clean}
    sizes = {}
    for i in clean:
        sizes[rows[i][1]] = sizes.get(rows[i][1], 0) + len(words[i])
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    want = shares(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, 1.5 * sum(sizes.values()))
    for s in sizes:
        own = [r for i, r in found.items() if rows[i][1] == s]
        assert abs(own[0]["target"] - want[s]) < 1e-6 * max(want[s], 1) and abs(sum(r["taken"] for r in own) - want[s]) <= 1
        assert all(r["taken"] <= 2 * r["size"] for r in own)
