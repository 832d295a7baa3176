"""Versioned tables: readers, lost writers and second writers at every step."""

import threading

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import merge as M
from ledgerline.operators import versions as V
from ledgerline.streaming.ingest import stream_files, upsert_once

STEPS = ["_written", "publish", "name_once"]


class Lost(Exception):
    pass


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "k long, v string")


def put(spark, pairs, path, how):
    df = frame(spark, pairs)
    return V.overwrite(df, path) if how == "overwrite" else V.merge(df, path, ["k"], ["v"], buckets=4)


def break_at(monkeypatch, step, after):
    """The writer is lost before or after a step."""
    owner = V.Store if step == "name_once" else V
    real = getattr(owner, step)

    def lost(*args, **named):
        if after:
            real(*args, **named)
        raise Lost

    monkeypatch.setattr(owner, step, lost)


@pytest.mark.parametrize("how", ["overwrite", "merge"])
@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("step", STEPS)
def test_a_lost_writer_leaves_one_whole_version(spark, tmp_path, monkeypatch, step, after, how):
    path = str(tmp_path / "t")
    old = [(k, "old") for k in range(20)]
    put(spark, old, path, how)
    reader = V.read(spark, path)
    new = [(3, "pew"), (40, "pew")]
    want = sorted(new, key=repr) if how == "overwrite" else sorted([(k, v) for k, v in old if k != 3] + new, key=repr)
    with monkeypatch.context() as m:
        break_at(m, step, after)
        with pytest.raises(Lost):
            put(spark, new, path, how)
    done = after and step != "_written"  # the version has its name: the batch is in
    old = sorted(old, key=repr)
    assert rows(V.read(spark, path)) == (want if done else old)
    assert rows(reader) == old
    put(spark, new, path, how)
    assert rows(V.read(spark, path)) == want and rows(reader) == old
    V.expire(spark, path, keep=1, grace=0)
    assert rows(V.read(spark, path)) == want and len(V.versions(spark, path)) == 1
    assert len(list((tmp_path / "t" / "data").iterdir())) == len({f.split("/")[1] for fs in V.current(spark, path).folders.values() for f in fs})
    assert not [p for p in (tmp_path / "t" / "_versions").iterdir() if p.suffix != ".json"]


def test_two_writers_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    V.merge(frame(spark, [(0, "a")]), path, ["k"], ["v"], buckets=4)
    failed = []

    def write(who):
        try:
            for k in range(3):
                V.merge(frame(spark, [(100 * who + k, "w"), (7, f"{who}{k}")]), path, ["k"], ["v"])
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=write, args=(w,)) for w in (1, 2, 3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and V.current(spark, path).number == 9
    assert {r[0] for r in rows(V.read(spark, path))} == {0, 7} | {100 * w + k for w in (1, 2, 3) for k in range(3)}


def test_a_number_is_given_once(spark, tmp_path):
    path = str(tmp_path / "t")
    first = V.overwrite(spark.range(3), path)
    with pytest.raises(V.Conflict):
        V.publish(spark, path, first)
    assert V.current(spark, path) == first and len(list((tmp_path / "t" / "_versions").glob(".*"))) == 0


def test_a_number_is_given_once_by_rename(spark, tmp_path, monkeypatch):
    init = V.Store.__init__

    def remote(self, *args):
        init(self, *args)
        self.local = False

    monkeypatch.setattr(V.Store, "__init__", remote)
    path = str(tmp_path / "t")
    first = V.overwrite(spark.range(3), path)
    with pytest.raises(V.Conflict):
        V.publish(spark, path, first)
    assert V.overwrite(spark.range(4), path).number == 1 and V.read(spark, path).count() == 4


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    V.merge(frame(spark, [(k, "a") for k in range(200)]), path, ["k"], ["v"], buckets=8)
    before = V.current(spark, path)
    assert len(before.folders) == 8
    files = {b: sorted(p.name for p in (tmp_path / "t" / f[0]).glob("*.parquet")) for b, f in before.folders.items()}
    after = V.merge(frame(spark, [(5, "b")]), path, ["k"], ["v"])
    touched = [b for b in before.folders if after.folders[b] != before.folders[b]]
    assert len(touched) == 1
    assert all(files[b] == sorted(p.name for p in (tmp_path / "t" / f[0]).glob("*.parquet")) for b, f in after.folders.items() if b not in touched)
    assert dict(rows(V.read(spark, path))) == {k: "b" if k == 5 else "a" for k in range(200)}


def test_batches_are_applied_once(spark, tmp_path):
    path = str(tmp_path / "t")
    batches = [[(1, "a"), (None, "a"), (None, "b")], [(1, "b"), (None, "c"), (2, "a")]]
    for _ in range(3):  # any batch may come again, null keys included
        for n, batch in enumerate(batches):
            V.merge(frame(spark, batch), path, ["k"], ["v"], source="s", batch=n, buckets=4)
    assert rows(V.read(spark, path)) == [(1, "b"), (2, "a"), (None, "c")]
    assert V.current(spark, path).number == 1 and V.current(spark, path).batches == {"s": 1}
    V.merge(frame(spark, [(None, "c")]), path, ["k"], ["v"])  # without a number: merged again, and nothing grows
    assert V.read(spark, path).count() == 3
    V.overwrite(frame(spark, [(9, "z")]), path, ["k"], 4, source="s", batch=2)
    V.overwrite(frame(spark, [(8, "z")]), path, ["k"], 4, source="s", batch=2)
    assert rows(V.read(spark, path)) == [(9, "z")]


def test_types_columns_and_audit_times(spark, tmp_path):
    path = str(tmp_path / "t")
    V.merge(frame(spark, [(1, "a"), (2, "a")]), path, ["k"], ["v"], now=F.lit("t0"), buckets=4)
    wider = spark.createDataFrame([(2, "b", 7), (3, "b", 8)], "k int, v string, extra int")
    V.merge(wider, path, ["k"], ["v"], now=F.lit("t1"))
    got = {r["k"]: r.asDict() for r in V.read(spark, path).collect()}
    assert got[1] == {"k": 1, "v": "a", "data_criacao": "t0", "data_atualizacao": "t0", "extra": None}
    assert got[2] == {"k": 2, "v": "b", "data_criacao": "t0", "data_atualizacao": "t1", "extra": 7}
    assert got[3] == {"k": 3, "v": "b", "data_criacao": "t1", "data_atualizacao": "t1", "extra": 8}
    with pytest.raises(ValueError, match="lies by"):
        V.merge(wider, path, ["v"], ["k"])


def test_replacement_reads_what_it_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    V.overwrite(spark.range(10), path)
    V.overwrite(V.read(spark, path).where("id > 6"), path)
    assert V.read(spark, path).count() == 3
    V.restore(spark, path, 0)
    assert V.read(spark, path).count() == 10 and V.versions(spark, path) == [0, 1, 2]
    reader = V.read(spark, path, V.current(spark, path, 1))
    assert V.expire(spark, path, keep=1) == []  # within the grace, versions stay for those who still read
    assert reader.count() == 3
    V.expire(spark, path, keep=2, grace=0)
    assert V.versions(spark, path) == [1, 2] and len(list((tmp_path / "t" / "data").iterdir())) == 2
    assert reader.count() == 3
    with pytest.raises(ValueError):
        V.current(spark, path, 0)


def test_empty_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    assert V.current(spark, path) is None
    with pytest.raises(ValueError):
        V.read(spark, path)
    V.merge(frame(spark, []), path, ["k"], ["v"], buckets=4)
    assert V.read(spark, path).columns == ["k", "v"] and V.read(spark, path).count() == 0
    V.merge(frame(spark, [(1, "a")]), path, ["k"], ["v"])
    V.merge(frame(spark, []), path, ["k"], ["v"])
    assert rows(V.read(spark, path)) == [(1, "a")]


def test_a_check_refuses_a_version(spark, tmp_path):
    path = str(tmp_path / "t")
    V.overwrite(spark.range(3), path)

    def refuse():
        raise Lost

    with pytest.raises(Lost):
        V.overwrite(spark.range(9), path, check=refuse)
    assert V.read(spark, path).count() == 3


def test_a_stream_goes_on_after_a_lost_writer(spark, tmp_path, monkeypatch):
    path, source, checkpoint = (str(tmp_path / n) for n in ("t", "in", "c"))
    frame(spark, [(1, "a"), (2, "a"), (None, "a")]).write.parquet(source)
    go = lambda: upsert_once(stream_files(spark, source, frame(spark, []).schema, files_per_batch=9), path, ["k"], ["v"], checkpoint, buckets=4)
    go()
    frame(spark, [(1, "b"), (None, "b")]).coalesce(1).write.mode("append").parquet(source)
    with monkeypatch.context() as m:
        break_at(m, "publish", True)  # the version is there, the checkpoint doesn't know
        with pytest.raises(Exception, match="Lost"):
            go()
    assert V.current(spark, path).number == 1
    go()
    assert V.current(spark, path).number == 1 and rows(V.read(spark, path)) == [(1, "b"), (2, "a"), (None, "b")]


def test_upsert_matches_null_keys(spark):
    old, new = spark.createDataFrame([(None, 1, "a"), (1, None, "a")], "k int, l int, v string"), spark.createDataFrame([(None, 1, "b"), (None, None, "b")], "k int, l int, v string")
    assert rows(M.upsert(old, new, ["k", "l"], ["v"])) == sorted([(None, 1, "b"), (1, None, "a"), (None, None, "b")], key=repr)
    assert M.upsert(old.select("k", "l"), new.select("k", "l"), ["k", "l"], []).count() == 3


@pytest.mark.parametrize("order", [["v DESC", "n DESC"], ["v", "n"], ["v DESC", "n"]])
def test_dedup_keeps_the_first_of_any_order(spark, order):
    data = [(k % 7 if k % 7 else None, None if k % 5 == 0 else f"v{k % 4}", k * 37 % 101, float(k)) for k in range(200)]
    df = spark.createDataFrame(data, "k int, v string, n int, x double").repartition(3)
    got = M.dedup_by_key(df, ["k"], order)
    low = lambda v: (v is not None, v or "")
    sign = -1 if order[1].endswith("DESC") else 1
    want = {}
    for k in {r[0] for r in data}:
        own = sorted((r for r in data if r[0] == k), key=lambda r: sign * r[2])
        want[k] = sorted(own, key=lambda r: low(r[1]), reverse=order[0].endswith("DESC"))[0]
    assert {r["k"]: tuple(r) for r in got.collect()} == want
    assert ("Window" in got._jdf.queryExecution().executedPlan().toString()) == (len({o.endswith("DESC") for o in order}) == 2)
