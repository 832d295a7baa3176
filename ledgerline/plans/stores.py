"""Registered queries of stored tables: versions, merges, layouts, contracts, deliveries, streams, exports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import normalize as N
from ..operators import contracts as K
from ..operators import export as X
from ..operators import lookups as L
from ..operators import quality as Q
from ..operators import search as R
from ..operators import versions as V
from ..sources import landing as S
from ..sources.tables import scratch, table
from ..streaming.ingest import land_once
from .registry import CHECKED_SQL, FLAGS_SQL, PARTNER_SQL, SEARCH_SQL, _checked, _flags, _partners, _search, cents, query
from .specs import FAMILIES

# Versions


@query("""
    SELECT 'first' AS version, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'last', o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL SELECT 'back', o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'""")
def table_versions(spark, sf_dir):
    """A reader of the first version goes on while the table is replaced and put back."""
    orders, path = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), scratch(spark, "versions")
    V.overwrite(orders.where("o_orderstatus = 'F'"), path)
    first = V.read(spark, path)
    V.overwrite(orders.where("o_orderstatus <> 'F'"), path)
    last = V.read(spark, path)
    V.restore(spark, path, 0)
    parts = [d.select(F.lit(name).alias("version"), "o_orderkey", "o_totalprice") for name, d in (("first", first), ("last", last), ("back", V.read(spark, path)))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""
    SELECT CASE WHEN user_id % 40 <> 0 THEN user_id END AS user_id, arg_max(event_id, event_id % 3 * 1000000000 + event_id) AS event_id, arg_max(value, event_id % 3 * 1000000000 + event_id) AS value,
      CAST(2 AS INTEGER) AS last_version FROM events GROUP BY 1""")
def bucketed_merge(spark, sf_dir):
    """Three batches, each of which comes twice, keys of null among them."""
    events, path = table(spark, sf_dir, "events"), scratch(spark, "merged")
    rows = events.select(F.when(F.col("user_id") % 40 != 0, F.col("user_id")).alias("user_id"), "event_id", "value")
    for n in (0, 0, 1, 0, 2, 1, 2):
        V.merge(rows.where(F.col("event_id") % 3 == n), path, ["user_id"], ["event_id"], source="events", batch=n, buckets=16)
    return V.read(spark, path).withColumn("last_version", F.lit(V.current(spark, path).number))


@query("""
    SELECT c_custkey, c_acctbal + CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS c_acctbal, 'first' AS data_criacao, CASE WHEN c_custkey % 3 = 0 THEN 'second' ELSE 'first' END AS data_atualizacao FROM customer WHERE c_custkey % 5 <> 0
    UNION ALL SELECT c_custkey, c_acctbal + 1, 'second', 'second' FROM customer WHERE c_custkey % 5 = 0 AND c_custkey % 3 = 0""")
def audit_columns(spark, sf_dir):
    """Times of insertion stay, times of change move; the second load changes a third of the rows and brings new ones."""
    rows, path = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), scratch(spark, "audited")
    V.merge(rows.where("c_custkey % 5 <> 0"), path, ["c_custkey"], ["c_acctbal"], now=F.lit("first"), buckets=8)
    V.merge(rows.where("c_custkey % 3 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1), path, ["c_custkey"], ["c_acctbal"], now=F.lit("second"))
    return V.read(spark, path)


# Searches

WANTED = ("00123", "MACHINERY", "3 h", "r#", "%", "no such name")
NAMED_SQL = "SELECT c_custkey, c_name || ' ' || c_mktsegment AS name FROM customer"


@query(" UNION ALL ".join(f"SELECT '{w}' AS wanted, c_custkey, name FROM ({NAMED_SQL}) WHERE name ILIKE '%{w.replace('%', '!%')}%' ESCAPE '!'" for w in WANTED))
def trigram_search(spark, sf_dir):
    """Few and very many hits, a wanted text that has no trigram, one with a wildcard, one that nobody has."""
    path = scratch(spark, "trigrams")
    named = table(spark, sf_dir, "customer").select("c_custkey", F.concat_ws(" ", "c_name", "c_mktsegment").alias("name"))
    R.write_trigram_index(named, "c_custkey", "name", path, 8)
    out = None
    for wanted in WANTED:
        one = R.substring_search(spark, path, "c_custkey", "name", wanted).select(F.lit(wanted).alias("wanted"), "c_custkey", "name")
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_custkey IN (7, 42)")
def point_lookup(spark, sf_dir):
    """Orders lie by chance; bloom filters leave the row groups that may hold two customers."""
    path = scratch(spark, "points")
    R.write_point_layout(table(spark, sf_dir, "orders"), path, ["o_custkey"], 8)
    return spark.read.parquet(path).where(F.col("o_custkey").isin(7, 42)).select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, o_custkey, o_orderstatus FROM lineitem JOIN orders ON o_orderkey = l_orderkey")
def bucketed_join(spark, sf_dir):
    """Both sides lie in the same buckets of the order, and no row moves."""
    run = uuid.uuid4().hex
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus")
    for name, df in (("lines", lines), ("orders", orders)):
        R.save_bucketed(df, f"{name}_{run}", scratch(spark, name), ["l_orderkey"], 8)
    return R.join_in_place(spark.table(f"lines_{run}"), spark.table(f"orders_{run}"), ["l_orderkey"])


@query("SELECT uf, name, c_custkey FROM (SELECT c_mktsegment AS uf, c_name AS name, c_custkey FROM customer) WHERE uf = 'MACHINERY' AND name LIKE 'Customer#0000000%' ORDER BY name, c_custkey LIMIT 20")
def search_layout(spark, sf_dir):
    """Partitions by region and order by name, so that a prefix search in a region reads few row groups."""
    path = scratch(spark, "layout")
    rows = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("uf"), F.col("c_name").alias("name"), "c_custkey")
    X.write_search_layout(rows, path, "uf", "name", ["c_custkey"], 8)
    return L.prefix_search(spark.read.parquet(path), "name", "Customer#0000000", ["c_custkey"], 20, lambda d: d.where("uf = 'MACHINERY'")).select("uf", "name", "c_custkey")


# Contracts


@query("""
    SELECT (SELECT count(*) FROM orders) AS rows_in, (SELECT count(*) FROM orders LEFT JOIN nation ON n_nationkey = o_custkey % 30) AS rows_out,
      (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)) AS repeated_lines, (SELECT count(*) FROM (SELECT n_nationkey FROM nation GROUP BY 1 HAVING count(*) > 1)) AS repeated_codes""")
def cardinality_contract(spark, sf_dir):
    """A lookup keeps the number of rows, counted in the job that writes."""
    t = lambda name: table(spark, sf_dir, name)
    orders = t("orders").select("o_orderkey", (F.col("o_custkey") % 30).alias("code"))
    build = lambda d: L.with_lookup(d, t("nation"), "code", "label", key="n_nationkey", label="n_name")
    _, came, went = K.write_kept(orders, build, scratch(spark, "contract"))
    lines = K.repeated_keys(t("lineitem"), ["l_orderkey", "l_linenumber"]).agg(F.count("*").alias("repeated_lines"))
    codes = K.repeated_keys(t("nation"), ["n_nationkey"]).count()
    return lines.select(F.lit(came).cast("long").alias("rows_in"), F.lit(went).cast("long").alias("rows_out"), "repeated_lines", F.lit(codes).cast("long").alias("repeated_codes"))


# Deliveries and landing

LINES_SQL = """
    SELECT c_custkey % 4 AS f, CASE c_custkey % 10 WHEN 3 THEN CAST(c_custkey AS VARCHAR) || ';' || c_name WHEN 7 THEN CAST(c_custkey AS VARCHAR) || ';' || c_name || ';' || c_mktsegment || ';x'
      ELSE CAST(c_custkey AS VARCHAR) || ';' || c_name || ';' || c_mktsegment END AS line FROM customer"""
COLUMNS = ("codigo", "nome", "segmento")


def _landing_lines(spark, sf_dir):
    key = F.col("c_custkey").cast("string")
    line = F.when(F.col("c_custkey") % 10 == 3, F.concat_ws(";", key, "c_name")).when(F.col("c_custkey") % 10 == 7, F.concat_ws(";", key, "c_name", "c_mktsegment", F.lit("x")))
    return table(spark, sf_dir, "customer").select((F.col("c_custkey") % 4).alias("f"), line.otherwise(F.concat_ws(";", key, "c_name", "c_mktsegment")).alias("line"))


@query(f"""
    SELECT 'good' AS sink, split_part(line, ';', 1) AS codigo, split_part(line, ';', 2) AS nome, split_part(line, ';', 3) AS segmento, NULL AS raw FROM ({LINES_SQL}) WHERE len(string_split(line, ';')) = 3
    UNION ALL SELECT 'bad', NULL, NULL, NULL, line FROM ({LINES_SQL}) WHERE len(string_split(line, ';')) <> 3""")
def dead_letter_stream(spark, sf_dir):
    """Half of the files, then the others, then nothing new: each record is in one sink, once."""
    folder, good, bad, checkpoint = (scratch(spark, n) for n in ("landed", "good", "bad", "checkpoint"))
    lines = _landing_lines(spark, sf_dir)
    for some in ("f < 2", "f >= 2", None):
        if some:
            lines.where(some).repartition(2, "f").select("line").write.mode("append").text(folder)
        land_once(spark, folder, COLUMNS, good, bad, checkpoint, files_per_batch=1)
    fine = V.read(spark, good).select(F.lit("good").alias("sink"), *COLUMNS, F.lit(None).cast("string").alias("raw"))
    return fine.unionByName(V.read(spark, bad).select(F.lit("bad").alias("sink"), *[F.lit(None).cast("string").alias(c) for c in COLUMNS], "raw"))


@query(f"SELECT line AS raw FROM ({LINES_SQL}) WHERE len(string_split(line, ';')) <> 3")
def quarantine(spark, sf_dir):
    path = scratch(spark, "quarantine")
    _landing_lines(spark, sf_dir).select("line").write.text(path)
    rows = S.read_strings(spark, path, COLUMNS)
    return rows.where(F.col(S.CORRUPT).isNotNull()).select(F.col(S.CORRUPT).alias("raw"))


def _packed(lines, folder: str):
    """Lines of each part in an archive of its own, with a member that no family has."""

    def run(rows):
        import io
        import zipfile

        import pandas as pd
        from pyarrow.fs import FileSystem

        store, base = FileSystem.from_uri(folder)
        store.create_dir(base)
        part, held = int(rows["f"].iloc[0]), io.BytesIO()
        with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr(f"in/K{part}.EMPRECSV", "".join(line + "\n" for line in sorted(rows["line"])).encode("latin-1"))
            archive.writestr("readme.txt", "of no family")
        with store.open_output_stream(f"{base}/Empresas{part}.zip") as sink:
            sink.write(held.getvalue())
        return pd.DataFrame({"path": [f"{folder}/Empresas{part}.zip"]})

    return lines.groupBy("f").applyInPandas(run, "path string")


@query(f"""
    SELECT split_part(line, ';', 1) AS codigo, split_part(line, ';', 2) AS nome, split_part(line, ';', 3) AS segmento, 'K' || f || '.EMPRECSV' AS member, true AS crc_ok
    FROM ({LINES_SQL}) WHERE len(string_split(line, ';')) = 3""")
def archive_landing(spark, sf_dir):
    """Archives are extracted, a task for each member, and their good records read."""
    paths = spark.createDataFrame([(r["path"],) for r in _packed(_landing_lines(spark, sf_dir), scratch(spark, "archives")).collect()], "path string")
    files = S.extract_archives(paths, scratch(spark, "extracted")).collect()  # one row for each archive
    rows = S.read_strings(spark, [r["file"] for r in files if r["crc_ok"]], COLUMNS).where(F.col(S.CORRUPT).isNull())
    name = F.regexp_extract("file_name", "(K[0-9]+[.]EMPRECSV)$", 1)
    return rows.select(*COLUMNS, name.alias("member"), F.lit(all(r["crc_ok"] for r in files)).alias("crc_ok"))


MONTHS_SQL = "SELECT event_id, user_id, value, strftime(ts, '%Y-%d') AS source_month FROM events"


@query(f"""
    WITH m AS ({MONTHS_SQL}), last AS (SELECT max(source_month) AS month FROM m)
    SELECT event_id, user_id, CASE WHEN source_month = month THEN value * 2 ELSE value END AS value, source_month FROM m, last WHERE source_month <> month OR event_id % 2 = 0""")
def delivery_partitions(spark, sf_dir):
    """All deliveries are loaded, then the last comes again, corrected: it alone is replaced."""
    path = scratch(spark, "deliveries")
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "value", F.date_format("ts", "yyyy-dd").alias("source_month"))
    last = S.latest_delivery(rows)
    rows.write.partitionBy("source_month").parquet(path)
    again = rows.where((F.col("source_month") == last) & (F.col("event_id") % 2 == 0)).withColumn("value", F.col("value") * 2)
    S.write_delivery(again.drop("source_month"), path, last)
    return spark.read.schema("event_id long, user_id long, value double, source_month string").parquet(path)


@query("SELECT count(*) AS n_rows, 0 AS n_bad, 'codigo,nome,segmento' AS columns FROM customer WHERE c_custkey < 0")
def empty_delivery(spark, sf_dir):
    """A file without a record is read as no rows, of the right columns, and no drift."""
    path = scratch(spark, "empty")
    _landing_lines(spark, sf_dir).where("f < 0").select("line").coalesce(1).write.text(path)
    rows = S.read_strings(spark, path, COLUMNS)
    S.check_layout(rows)
    kept = rows.drop(S.CORRUPT, "file_name")
    return rows.agg(F.count("*").alias("n_rows"), F.count_if(F.col(S.CORRUPT).isNotNull()).cast("int").alias("n_bad")).withColumn("columns", F.lit(",".join(kept.columns)))


# Exports


@query("SELECT 'customer' AS table_name, count(*) AS n_rows, true AS made_again FROM customer UNION ALL SELECT 'nation', count(*), false FROM nation")
def export_resume(spark, sf_dir):
    """An export that broke off before a table was whole goes on with that table alone."""
    folder = scratch(spark, "resume")
    tables = {t: table(spark, sf_dir, t) for t in ("customer", "nation")}
    X.export_all(tables, folder)
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/customer.parquet/_SUCCESS")
    mark.getFileSystem(spark._jsc.hadoopConfiguration()).delete(mark, False)
    again = X.export_all(tables, folder)
    return X.table_counts({t: spark.read.parquet(f"{folder}/{t}.parquet") for t in tables}).withColumn("made_again", F.col("table_name").isin(again))


@query("""
    SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cnpj_basico, c_name AS razao_social, CASE WHEN c_acctbal >= 0 THEN round(c_acctbal, 2) END AS capital_social, 'string' AS as_text, 'double' AS as_number FROM customer""")
def typed_export(spark, sf_dir):
    """A family's file as text and with types."""
    path, family = scratch(spark, "companies"), FAMILIES["EMPRECSV"]
    amount = F.concat(F.when(cents("c_acctbal") < 0, "-").otherwise(""), F.translate(F.format_number(F.abs(cents("c_acctbal")) / 100.0, 2), ",.", ".,"))
    rows = table(spark, sf_dir, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 8, "0"), "c_name", F.lit("2062"), F.lit("05"), amount, F.lit("01"), F.lit(""))
    rows.toDF(*family.columns).write.option("sep", ";").option("encoding", "ISO-8859-1").csv(path)
    typed, text = (S.load(spark, path, "EMPRECSV", "2026-01-01", cast=c) for c in (True, False))
    kind = lambda d: F.lit(d.schema["capital_social"].dataType.simpleString())
    return typed.select("cnpj_basico", "razao_social", "capital_social", kind(text).alias("as_text"), kind(typed).alias("as_number"))


@query("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")
def mart_rebuild(spark, sf_dir):
    """A mart is dropped and made again, and nothing of the old one stays."""
    name, orders = f"mart_{uuid.uuid4().hex}", table(spark, sf_dir, "orders")
    X.save_mart(orders.where("o_orderstatus <> 'F'"), name)
    X.save_mart(orders.where("o_orderstatus <> 'P'").select("o_orderkey", "o_orderstatus"), name)
    return spark.table(name).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("""
    SELECT 'c_custkey' AS column_name, CAST(min(c_custkey) AS VARCHAR) AS low, CAST(max(c_custkey) AS VARCHAR) AS high, 0 AS nulls FROM customer
    UNION ALL SELECT 'segment', NULL, NULL, count(*) FILTER (c_mktsegment = 'BUILDING') FROM customer""")
def mart_statistics(spark, sf_dir):
    """Statistics that the optimiser reads, collected when a mart is made."""
    name = f"mart_{uuid.uuid4().hex}"
    X.save_mart(table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment")), name)
    return X.column_statistics(spark, name, ["c_custkey", "segment"]).select("column_name", "low", "high", "nulls")


@query("""
    SELECT 'customer' AS "table", count(*) AS "rows", 'customer.parquet' AS file, true AS has_bytes, (SELECT count(*) FROM customer) + (SELECT count(*) FROM nation) AS totalRows, 2 AS totalTables, '2' AS schemaVersion, '2026-01' AS sourceMonth FROM customer
    UNION ALL SELECT 'nation', count(*), 'nation.parquet', true, (SELECT count(*) FROM customer) + (SELECT count(*) FROM nation), 2, '2', '2026-01' FROM nation""")
def manifest_file(spark, sf_dir):
    """The manifest as it is written, with sizes that add up to the total."""
    folder = scratch(spark, "manifest")
    X.export_all({t: table(spark, sf_dir, t) for t in ("customer", "nation")}, folder)
    X.write_manifest(["customer", "nation"], folder, spark, "2026-01", "1.0")
    rows = spark.read.json(f"{folder}/manifest").select("*", F.explode("tables").alias("t"))
    adds = F.aggregate("tables", F.lit(0).cast("long"), lambda a, x: a + x["sizeBytes"]) == F.col("totalBytes")
    fine = (F.col("t.sizeBytes") > 0) & adds
    return rows.select("t.table", "t.rows", "t.file", fine.alias("has_bytes"), "totalRows", F.col("totalTables").cast("int").alias("totalTables"), "schemaVersion", "sourceMonth")


# Samples


def _taken(key: str, percent: float) -> str:
    return f"CAST('0x' || substr(md5('sample:' || coalesce(CAST({key} AS VARCHAR), '')), 1, 8) AS BIGINT) < {int(percent / 100 * 2**32)}"


@query(f"SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE {_taken('l_orderkey', 5)}")
def hash_sample(spark, sf_dir):
    return Q.hash_sample(table(spark, sf_dir, "lineitem"), ["l_orderkey"], 5).select("l_orderkey", "l_linenumber", "l_partkey")


@query(f"SELECT count(*) AS total, count(*) FILTER (dv_valid) AS valid, count(*) FILTER (NOT dv_valid) AS invalid FROM ({CHECKED_SQL}) WHERE {_taken('o_orderkey', 20)}")
def sampled_tally(spark, sf_dir):
    """Check digits of a sample that is the same at every run."""
    from ..functions.checkdigits import digit_tally

    return digit_tally(Q.hash_sample(_checked(spark, sf_dir), ["o_orderkey"], 20))


# Composed text

MARKED_SQL = """
    SELECT c_custkey, c_name || CASE c_custkey % 6 WHEN 0 THEN 'e' || chr(769) || chr(803) WHEN 1 THEN chr(4352) || chr(4449) || chr(4520) WHEN 2 THEN chr(8490) || 'a' || chr(808) || chr(769)
      WHEN 3 THEN 'O' || chr(771) || chr(772) WHEN 4 THEN chr(233) ELSE 'x' END AS name FROM customer"""


@query(f"SELECT c_custkey, lower(nfc_normalize(name)) AS name FROM ({MARKED_SQL})")
def composed_names(spark, sf_dir):
    """Two marks on a letter in any order, syllables from their letters, characters that stand for others."""
    k = F.col("c_custkey") % 6
    tails = ["ẹ́", "각", "Ką́", "Ȭ", "é"]
    tail = F.lit("x")
    for n, text in reversed(list(enumerate(tails))):
        tail = F.when(k == n, text).otherwise(tail)
    return table(spark, sf_dir, "customer").select("c_custkey", N.canonical_text(F.concat(F.lit(" "), "c_name", tail)).alias("name"))


# Counts of the report


@query(f"""
    SELECT 'orders' AS section, 'balance_null' AS metric, count(*) FILTER (balance IS NULL OR c_custkey % 9 = 0) AS value, count(*) AS total FROM ({FLAGS_SQL})
    UNION ALL SELECT 'orders', 'balance_sentinel', count(*) FILTER (balance_is_sentinel AND c_custkey % 9 <> 0), count(*) FROM ({FLAGS_SQL})
    UNION ALL SELECT 'partners', 'agent_placeholder', count(*) FILTER (agent_is_placeholder), count(*) FROM ({PARTNER_SQL})
    UNION ALL SELECT 'partners', 'agent_null', count(*) FILTER (agent IS NULL), count(*) FROM ({PARTNER_SQL})""")
def null_and_placeholder_counts(spark, sf_dir):
    flags = _flags(spark, sf_dir).withColumn("balance", F.when(F.col("c_custkey") % 9 != 0, F.col("balance")))
    first = Q.fused_counts(flags, "orders", {"balance_null": F.col("balance").isNull(), "balance_sentinel": L.sentinel_flag(F.col("balance"), 999999999999.0)})
    return first.unionByName(Q.fused_counts(_partners(spark, sf_dir), "partners", {"agent_placeholder": F.col("agent_is_placeholder"), "agent_null": F.col("agent").isNull()}))


@query("""
    SELECT 'amount' AS "column", count(*) FILTER (round(c_acctbal * 100) < 0) AS cleared FROM customer
    UNION ALL SELECT 'since', count(*) FILTER (c_custkey % 7 < 2) FROM customer""")
def normalisation_counts(spark, sf_dir):
    """How many negative amounts and placeholder dates a load clears, in one pass."""
    k = F.col("c_custkey") % 7
    amount = F.concat(F.when(cents("c_acctbal") < 0, "-").otherwise(""), F.abs(cents("c_acctbal")).cast("string"))
    since = F.when(k == 0, "0").when(k == 1, "00000000").when(k == 2, F.lit(None)).otherwise("20230101")
    rows = table(spark, sf_dir, "customer").select(amount.alias("amount"), since.alias("since"))
    return Q.cleared(rows, {"amount": N.negative_to_null(F.col("amount")), "since": N.placeholder_date_to_null(F.col("since"))})


# The four lookups of the rollup


@query(f"""
    WITH m AS ({SEARCH_SQL})
    SELECT 'segment' AS kind, count(*) AS total FROM m WHERE c_mktsegment = 'MACHINERY'
    UNION ALL SELECT 'segment_nation', count(*) FROM m WHERE c_mktsegment = 'MACHINERY' AND nation_name = 'NATION_03' HAVING count(*) > 0
    UNION ALL SELECT 'segment_nation_null', count(*) FROM m WHERE c_mktsegment = 'MACHINERY' AND nation_name IS NULL
    UNION ALL SELECT 'segment_activity', count(*) FROM m WHERE c_mktsegment = 'MACHINERY' AND activity = 'MACHINERY'""")
def rollup_lookups(spark, sf_dir):
    """A total of each kind, the bucket of nulls, and a bucket that may not be there."""
    from .registry import _rollup

    rollup, seg = _rollup(spark, sf_dir), {"c_mktsegment": "MACHINERY"}
    found = {
        "segment": L.count_of(rollup, "segment", **seg), "segment_nation": L.count_of(rollup, "segment_nation", **seg, nation_name="NATION_03"),
        "segment_nation_null": L.count_of(rollup, "segment_nation", **seg, nation_name=None), "segment_activity": L.count_of(rollup, "segment_activity", **seg, activity="MACHINERY"),
    }
    out = None
    for kind, df in found.items():
        one = df.select(F.lit(kind).alias("kind"), "total")
        out = one if out is None else out.unionByName(one)
    return out


@query(f"""
    SELECT grain, CAST(total AS BIGINT) AS total, CAST(total = base AS BOOLEAN) AS agrees FROM (
      SELECT 'segment' AS grain, sum(n) AS total, (SELECT count(*) FROM ({SEARCH_SQL})) AS base FROM (SELECT count(*) AS n FROM ({SEARCH_SQL}) GROUP BY c_mktsegment)
      UNION ALL SELECT 'segment_activity', sum(n), (SELECT count(*) FROM ({SEARCH_SQL})) FROM (SELECT count(*) AS n FROM ({SEARCH_SQL}) GROUP BY c_mktsegment, activity)
      UNION ALL SELECT 'segment_nation', sum(n), (SELECT count(*) FROM ({SEARCH_SQL})) FROM (SELECT count(*) AS n FROM ({SEARCH_SQL}) GROUP BY c_mktsegment, nation_name))""")
def rollup_agreement(spark, sf_dir):
    from .registry import _rollup

    return Q.reconciled(_rollup(spark, sf_dir), _search(spark, sf_dir)).withColumnRenamed("kind", "grain")
