"""Search layouts, contracts, deliveries, the dead-letter stream, samples and composed text."""

import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import normalize as N
from ledgerline.functions.identity import canonical_name
from ledgerline.operators import contracts as K
from ledgerline.operators import lookups as L
from ledgerline.operators import quality as Q
from ledgerline.operators import search as R
from ledgerline.operators import versions as V
from ledgerline.sources import landing as S
from ledgerline.streaming import ingest as I


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(df):
    """Rows that the scans of a query gave on."""
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        if node.nodeName().startswith("Scan"):
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return found


# Searches


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    rows = spark.range(20_000).selectExpr("id", "concat(case when id % 2 = 0 then 'Comércio ' else 'LOJA ' end, hex(id * 7919), ' do Zé%_') as name").unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, "ab"), (-4, "İstanbul ŞİŞ")], "id long, name string"))
    R.write_trigram_index(rows, "id", "name", path, 4, block=1 << 14)
    return path, rows


@pytest.mark.parametrize("wanted", ["comércio", "3F7", "a3F7B", "é", "zé%_", "LOJA 1", "ab", "", "nobody", "İST", "şiş", "i̇ş"])
@pytest.mark.parametrize("few", [1000, 3])
def test_substring_search_equals_a_scan(spark, index, wanted, few):
    path, rows = index
    got = R.substring_search(spark, path, "id", "name", wanted, few)
    want = rows.where(F.contains(F.lower("name"), F.lower(F.lit(wanted))))
    assert sorted(r[0] for r in got.collect()) == sorted(r[0] for r in want.collect())


def test_substring_search_reads_postings_and_few_rows(spark, index):
    path, rows = index
    wanted = f"{777 * 7919:x}"
    keys = R.candidates(spark, path, "id", wanted)
    assert "In(gram, [" in plan(keys) and scanned(keys) < 40_000 < spark.read.parquet(f"{path}/postings").count() / 5
    found = R.substring_search(spark, path, "id", "name", wanted)
    assert "PushedFilters: [IsNotNull(name), In(id, [" in plan(found)
    assert 0 < found.count() and scanned(found) < 5_000 < rows.count()


def test_bloom_filters_skip_row_groups(spark, tmp_path):
    rows = spark.range(40_000).selectExpr("id", "lpad(cast((id * 7919) % 40000 as string), 8, '0') as cnpj_basico", "repeat(hex(id), 8) as filler")
    with_filter, without = str(tmp_path / "a"), str(tmp_path / "b")
    R.write_point_layout(rows, with_filter, ["cnpj_basico"], 2, ndv=2_000, block=1 << 17)
    rows.repartition(2).write.option("parquet.block.size", 1 << 17).parquet(without)
    find = lambda path: spark.read.parquet(path).where("cnpj_basico = '00012345'")
    assert find(with_filter).collect() == find(without).collect() and len(find(without).collect()) == 1
    assert scanned(find(with_filter)) * 3 < scanned(find(without))


def test_bucketed_tables_join_where_they_lie(spark, tmp_path):
    left = spark.range(2_000).selectExpr("lpad(cast(id % 700 as string), 8, '0') as cnpj_basico", "id as ordem")
    right = spark.range(600).selectExpr("lpad(cast(id as string), 8, '0') as cnpj_basico", "id as razao")
    for name, df in (("left_t", left), ("right_t", right)):
        R.save_bucketed(df, name, str(tmp_path / name), ["cnpj_basico"], 4)
    joined = R.join_in_place(spark.table("left_t"), spark.table("right_t"), ["cnpj_basico"])
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, left.join(right, "cnpj_basico").collect()))
    assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
    assert len(list((tmp_path / "left_t").glob("*.parquet"))) == 4
    for name in ("left_t", "right_t"):
        spark.sql(f"drop table {name}")


# Contracts


def test_a_join_that_doubles_rows_is_refused(spark, tmp_path):
    path, rows = str(tmp_path / "t"), spark.range(100).selectExpr("id", "cast(id % 4 as string) as code")
    codes = [(str(k), f"label {k}") for k in range(3)]
    dim, doubled = (spark.createDataFrame(c, "codigo string, descricao string") for c in (codes, codes + [("1", "again")]))
    build = lambda d: lambda x: L.with_lookup(x, d, "code", "label")
    version, came, went = K.write_kept(rows, build(dim), path)
    assert (version.number, came, went) == (0, 100, 100)
    with pytest.raises(K.CardinalityError, match="100 rows became 125"):
        K.write_kept(rows, build(doubled), path)
    assert V.current(spark, path).number == 0 and V.read(spark, path).count() == 100
    assert K.write_kept(rows, build(doubled), path, rule="no fewer")[2] == 125
    with pytest.raises(K.CardinalityError):
        K.write_kept(rows, lambda d: d.join(dim, d["code"] == dim["codigo"]), path)
    assert K.write_kept(rows, lambda d: d.join(dim, d["code"] == dim["codigo"]), path, rule="no more")[1:] == (100, 75)
    assert K.write_kept(rows.where("false"), build(dim), path)[1:] == (0, 0)
    assert [tuple(r) for r in K.repeated_keys(doubled, ["codigo"]).collect()] == [("1", 2)]


def test_a_code_table_is_looked_at_once(spark):
    """Its hint lasts through selections; static dictionaries need no look; a hint on a part of a plan is not one on the whole."""
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("looks"))
    spark.sparkContext.setJobGroup("looks", "looks")
    fixed = L.static_dictionary(spark, [("1", "a"), (None, None)], "codigo string, descricao string")
    assert fixed.count() == 2 and L.static_dictionary(spark, [], "codigo string, n int").count() == 0
    before = jobs()
    L.small(fixed)
    assert jobs() == before
    once = L.looked_at({"d": spark.range(5).selectExpr("string(id) as codigo", "'x' as descricao")}, ["d", "d"])["d"]
    after = jobs()
    assert after > before
    L.with_lookup(L.with_lookup(spark.range(3).selectExpr("string(id) as c"), once, "c", "one"), once, "c", "two")
    L.lookup_missing_flag(spark.range(3).selectExpr("string(id) as c"), once, "c", "gone")
    assert jobs() == after
    part = L.enrich_domain(once, L.static_dictionary(spark, [("7", "b", "high", None)], "codigo string, descricao string, confidence string, notes string"), "k", "u")
    L.small(part)
    assert jobs() > after
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_counts_that_ran_twice_are_counted_again(spark, tmp_path, monkeypatch):
    """A task that runs again may be observed twice: that alone refuses nothing."""

    class Twice:
        def __init__(self):
            self.get = {"n": 7}

    rows = spark.range(5)
    monkeypatch.setattr(type(rows), "observe", lambda self, *_: self)
    seen = iter([Twice(), Twice()])
    monkeypatch.setattr(K, "Observation", lambda: next(seen))
    monkeypatch.setitem(K.RULES, "five", lambda came, went: came == went == 5)
    assert K.write_kept(rows, lambda d: d, str(tmp_path / "t"), rule="five")[1:] == (5, 5)


# Landing


def test_dead_letters(spark, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_bytes('1;"á;b"\n2\n'.encode("latin-1"))
    (folder / "b.csv").write_bytes(b"")
    good, bad, checkpoint = (str(tmp_path / n) for n in ("good", "bad", "c"))
    go = lambda: I.land_once(spark, str(folder), ("k", "v"), good, bad, checkpoint)
    read = lambda path: sorted(tuple(r) for r in V.read(spark, path).collect())
    go()
    assert read(good) == [("1", "á;b", "a.csv")] and read(bad) == [("a.csv", "2")]
    (folder / "c.csv").write_text("3;c\n4;d;e\n5;\n")
    real, calls = I.append, []

    def lost(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost between the sinks")
        return real(*args)

    with monkeypatch.context() as m:
        m.setattr(I, "append", lost)
        with pytest.raises(Exception, match="lost between"):
            go()
    for _ in range(2):
        go()
        assert read(good) == [("1", "á;b", "a.csv"), ("3", "c", "c.csv"), ("5", None, "c.csv")]
        assert read(bad) == [("a.csv", "2"), ("c.csv", "4;d;e")]


def test_a_delivery_replaces_its_month_alone(spark, tmp_path):
    path = str(tmp_path / "d")
    for month in ("2026-01", "2026-02"):
        S.write_delivery(spark.range(5).withColumn("month", F.lit(month)), path, month)
    files = lambda month: sorted(p.name for p in (tmp_path / "d" / f"source_month={month}").glob("*.parquet"))
    before = files("2026-01"), files("2026-02")
    S.write_delivery(spark.range(2).withColumn("month", F.lit("again")), path, "2026-02")
    assert files("2026-01") == before[0] and not set(files("2026-02")) & set(before[1])
    rows = spark.read.schema("id long, month string, source_month string").parquet(path)
    assert {(r["source_month"], r["month"]): r["n"] for r in rows.groupBy("source_month", "month").agg(F.count("*").alias("n")).collect()} == {("2026-01", "2026-01"): 5, ("2026-02", "again"): 2}
    assert S.latest_delivery(rows) == "2026-02"


# Samples


def test_hash_sample(spark):
    rows = spark.range(50_000).selectExpr("id", "cast(id % 9000 as string) as key")
    small, large = ({r[0] for r in Q.hash_sample(rows, ["key"], p).collect()} for p in (5, 20))
    assert small < large and 0.04 * 50_000 < len(small) < 0.06 * 50_000
    assert small == {r[0] for r in Q.hash_sample(rows.repartition(7), ["key"], 5).collect()}
    assert all(k % 9000 in {i % 9000 for i in small} for k in small) and Q.hash_sample(rows, ["key"], 100).count() == 50_000
    for bad in (0, -1, 101, float("nan")):
        with pytest.raises(ValueError):
            Q.hash_sample(rows, ["key"], bad)


# Composed text


def test_all_of_unicode_is_composed(spark):
    """Every assigned character, every decomposition of one, and marks in both orders."""
    there = [chr(k) for k in range(1, sys.maxunicode + 1) if not 0xD800 <= k < 0xE000 and unicodedata.category(chr(k)) not in ("Cn", "Co")]
    cases = {c for c in there if ord(c) < 0x3400 or ord(c) > 0xF8FF}
    cases |= {unicodedata.normalize("NFD", c) for c in there if unicodedata.normalize("NFD", c) != c}
    marks = [c for c in there if unicodedata.combining(c)]
    cases |= {base + a + b for base in "aeoAz" for a, b in zip(marks, marks[7:] + marks[:7], strict=True)}
    cases |= {"각", "각", "é", "ạ́", "q̣̇", "שּׁ", "K", "が"}
    cases = sorted(cases)
    got = spark.createDataFrame([(k, c) for k, c in enumerate(cases)], "k long, c string").select("k", N.composed(F.col("c")).alias("c")).collect()
    wrong = [(cases[r["k"]], r["c"]) for r in got if r["c"] != unicodedata.normalize("NFC", cases[r["k"]])]
    assert not wrong and len(got) == len(cases) > 20_000


def test_canonical_text_equals_python(spark):
    texts = ["  JOSÉ\x1f SILVA x ", "ΣΑΣ", "İ", "", None, "\t\n", "ﬁ Ⅷ", "Å Å", " a  b"]
    got = [r[0] for r in spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").orderBy("k").select(N.canonical_text(F.col("t"))).collect()]
    assert got == [canonical_name(t) for t in texts]
    assert N.composed(F.lit(None).cast("string")) is not None and spark.range(1).select(N.composed(F.lit(None).cast("string"))).first()[0] is None
