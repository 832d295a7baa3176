"""Registered queries over the given tables, each beside its SQL.

Every query applies library operators to whole tables.  Codes that are missing,
placeholders and odd formats come from the tables' own keys, so that both sides
derive them alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import checkdigits as C
from ..functions import normalize as N
from ..functions import validate as V
from ..functions.identity import row_id, row_id_parity
from ..operators import export as X
from ..operators import lookups as L
from ..operators import merge as M
from ..operators import quality as Q
from ..operators.versions import read as read_version
from ..operators.versions import replace_load as replace_version
from ..sources import landing as S
from ..sources.tables import scratch, table
from ..streaming.ingest import ingest_once, stream_files, upsert_once
from . import marts
from .specs import CAPITAL_SENTINEL, FAMILIES, section_rows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def cents(c: str) -> F.Column:
    return F.round(F.col(c) * 100).cast("bigint")


# Landing files


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS codigo, c_name || ' ção; "x"' AS descricao, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segmento
    FROM customer""")
def landing_scan(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.concat("c_name", F.lit(' ção; "x"')), F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")))
    path = scratch(spark, "landing")
    rows.write.option("sep", ";").option("escape", '"').option("encoding", "ISO-8859-1").csv(path)
    return S.read_strings(spark, path, ("codigo", "descricao", "segmento")).select("codigo", "descricao", "segmento")


FILE_NAMES = ["K.EMPRECSV", "k.estabele", "K.SOCIOCSV.D1", "F.K.SIMPLES.CSV", "K.CNAECSV", "README", "K.MUNICCSV", "simples.PAISCSV"]


@query("""
    SELECT family, count(*) AS n FROM (
      SELECT CASE event_id % 8 WHEN 0 THEN 'EMPRECSV' WHEN 1 THEN 'ESTABELE' WHEN 2 THEN 'SOCIOCSV' WHEN 3 THEN 'SIMPLESCSV' WHEN 4 THEN 'CNAECSV' WHEN 6 THEN 'MUNICCSV' WHEN 7 THEN 'SIMPLESCSV' END AS family
      FROM events) GROUP BY family""")
def family_routing(spark, sf_dir):
    names = F.array(*[F.lit(n) for n in FILE_NAMES])
    files = table(spark, sf_dir, "events").select(F.element_at(names, (F.col("event_id") % 8 + 1).cast("int")).alias("name"))
    return files.groupBy(S.family_of_file(F.col("name")).alias("family")).agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n_rows, count(*) FILTER (c_custkey % 10 IN (3, 7)) AS n_bad FROM customer")
def layout_drift(spark, sf_dir):
    key = F.col("c_custkey").cast("string")
    line = F.when(F.col("c_custkey") % 10 == 3, F.concat_ws(";", key, "c_name")).when(F.col("c_custkey") % 10 == 7, F.concat_ws(";", key, "c_name", "c_mktsegment", "c_name"))
    path = scratch(spark, "drift")
    table(spark, sf_dir, "customer").select(line.otherwise(F.concat_ws(";", key, "c_name", "c_mktsegment"))).write.text(path)
    report = S.width_report(S.read_strings(spark, path, ("codigo", "nome", "segmento")))
    return report.agg(F.sum("n_rows").alias("n_rows"), F.sum("n_bad").alias("n_bad"))


def _files(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM").alias("directory"), F.col("event_type").alias("filename")).distinct()


FILES_SQL = "SELECT DISTINCT strftime(ts, '%Y-%m') AS directory, event_type AS filename FROM events"


@query(f"SELECT * FROM ({FILES_SQL}) WHERE NOT filename < 'm'")
def pending_files(spark, sf_dir):
    files = _files(spark, sf_dir)
    return S.pending_files(files, files.where("filename < 'm'"))


@query("SELECT DISTINCT strftime(ts, '%Y-%d') AS directory, event_type AS filename FROM events WHERE strftime(ts, '%Y-%d') <> (SELECT max(strftime(ts, '%Y-%d')) FROM events)")
def force_reprocess(spark, sf_dir):
    files = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-dd").alias("directory"), F.col("event_type").alias("filename")).distinct()
    return S.force_reprocess(files, S.latest_delivery(files.withColumnRenamed("directory", "source_month")))


@query("SELECT max(strftime(ts, '%Y-%m')) AS source_month, count(DISTINCT strftime(ts, '%Y-%m')) AS n_months FROM events")
def latest_delivery(spark, sf_dir):
    months = _files(spark, sf_dir).select(F.col("directory").alias("source_month")).distinct()
    return months.agg(F.lit(S.latest_delivery(months)).alias("source_month"), F.count("*").alias("n_months"))


@query(f"SELECT directory, filename FROM ({FILES_SQL})")
def ledger_append(spark, sf_dir):
    files = _files(spark, sf_dir)
    ledger = files.where("filename < 'm'").withColumn("processed_at", F.current_timestamp())
    return S.ledger_append(ledger, files).select("directory", "filename")


@query("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 100000 AND o_orderpriority LIKE '1%' GROUP BY 1")
def parquet_filter(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where((F.col("o_totalprice") > 100000) & F.col("o_orderpriority").startswith("1"))
    return orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"))


# Normalisation


@query("""
    SELECT c_custkey, CASE WHEN cents >= 0 THEN cents / 100.0::DOUBLE END AS amount
    FROM (SELECT c_custkey, CAST(round(c_acctbal * 100) AS BIGINT) AS cents FROM customer)""")
def locale_decimal(spark, sf_dir):
    text = F.translate(F.format_number(F.abs(cents("c_acctbal")) / 100.0, 2), ",.", ".,")
    signed = F.concat(F.when(cents("c_acctbal") < 0, "-").otherwise(""), text)
    amount = N.to_double_or_null(N.negative_to_null(N.locale_decimal(signed)))
    return table(spark, sf_dir, "customer").select("c_custkey", amount.alias("amount"))


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey,
      CASE WHEN l_partkey % 11 IN (0, 1, 2, 3, 4) THEN NULL WHEN l_shipdate::DATE BETWEEN DATE '1900-01-01' AND DATE '1998-06-30' THEN l_shipdate::DATE END AS ship_date
    FROM lineitem""")
def date_cleanup(spark, sf_dir):
    k = F.col("l_partkey") % 11
    text = F.when(k == 0, "0").when(k == 1, "00000000").when(k == 2, "20230230").when(k == 3, "18991231").when(k == 4, "29991231").otherwise(F.date_format("l_shipdate", "yyyyMMdd"))
    date = N.date_in_range(N.to_date_or_null(N.placeholder_date_to_null(text)), "1998-06-30")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", date.alias("ship_date"))


@query("""
    SELECT c_custkey, CASE WHEN length(code) < 3 THEN lpad(code, 3, '0') ELSE code END AS country,
      CASE WHEN regexp_full_match(zip, '[0-9]{7}') THEN lpad(zip, 8, '0') ELSE zip END AS zip,
      coalesce(CASE WHEN c_custkey % 5 <> 0 THEN c_name END, '00000000000000') AS document, try_cast(CASE WHEN c_custkey % 7 = 0 THEN 'x' ELSE code END AS INTEGER) AS number
    FROM (SELECT *, CAST(c_custkey % 1500 AS VARCHAR) AS code, CASE WHEN c_custkey % 3 = 0 THEN CAST(1000000 + c_custkey AS VARCHAR) ELSE CAST(c_custkey AS VARCHAR) END AS zip FROM customer)""")
def code_padding(spark, sf_dir):
    key = F.col("c_custkey")
    code = (key % 1500).cast("string")
    zip_ = F.when(key % 3 == 0, (key + 1000000).cast("string")).otherwise(key.cast("string"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", N.pad_code(code, 3).alias("country"), N.pad_exact(zip_, 7, 8).alias("zip"), N.backfill(F.when(key % 5 != 0, F.col("c_name")), "00000000000000").alias("document"),
        N.to_int_or_null(F.when(key % 7 == 0, "x").otherwise(code)).alias("number"),
    )


def _jittered():
    return F.when(F.col("c_custkey") % 2 == 0, F.upper(F.concat(F.lit("  "), F.replace("c_name", F.lit("#"), F.lit("  "))))).otherwise(F.concat(F.replace("c_name", F.lit("#"), F.lit(" ")), F.lit(" ")))


@query("""
    SELECT c_custkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21) AS row_id
    FROM (SELECT c_custkey, md5(CAST(c_nationkey AS VARCHAR) || chr(31) || coalesce(CASE WHEN c_custkey % 9 <> 0 THEN c_mktsegment END, '') || chr(31) || lower(trim(replace(c_name, '#', ' ')))) AS h FROM customer)""")
def row_id_native(spark, sf_dir):
    parts = [F.col("c_nationkey"), F.when(F.col("c_custkey") % 9 != 0, F.col("c_mktsegment")), N.canonical_text(_jittered())]
    return table(spark, sf_dir, "customer").select("c_custkey", row_id(*parts).alias("row_id"))


@query()
def row_id_blake2(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", row_id_parity(F.col("c_nationkey"), _jittered(), name=1).alias("row_id"))


@query("SELECT c_custkey, c_name AS name, CAST(c_custkey AS VARCHAR) || CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS composite FROM customer")
def text_hygiene(spark, sf_dir):
    dirty = F.concat(F.substring("c_name", 1, 3), F.lit("\u0000"), F.expr("substring(c_name, 4)"))
    key = N.composite_key(F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")))
    return table(spark, sf_dir, "customer").select("c_custkey", N.strip_nul(dirty).alias("name"), key.alias("composite"))


# Rules and contracts


@query("""
    SELECT 'p_brand:format' AS rule, count(p_brand) AS checked, count(*) FILTER (NOT regexp_full_match(p_brand, 'Brand#[1-3][0-9]')) AS invalid FROM part
    UNION ALL SELECT 'p_name:format', count(p_name), count(*) FILTER (NOT regexp_matches(p_name, '^[a-m]')) FROM part
    UNION ALL SELECT 'p_type:domain', count(t), count(*) FILTER (t NOT IN ('PROMO', 'ECONOMY', 'STANDARD')) FROM (SELECT CASE WHEN p_partkey % 10 <> 0 THEN split_part(p_type, ' ', 1) END AS t FROM part)""")
def format_rules(spark, sf_dir):
    df = table(spark, sf_dir, "part").withColumn("p_type", F.when(F.col("p_partkey") % 10 != 0, F.split_part("p_type", F.lit(" "), F.lit(1))))
    return V.count_rules(df, [V.format_rule("p_brand", r"^Brand#[1-3][0-9]\z"), V.format_rule("p_name", "^[a-m]"), V.domain_rule("p_type", ["PROMO", "ECONOMY", "STANDARD"])])


@query("""
    SELECT 'o_orderpriority:length' AS rule, count(o_orderpriority) AS checked, count(*) FILTER (length(o_orderpriority) > 6) AS invalid FROM orders
    UNION ALL SELECT 'o_clerk:required', count(*), count(*) FILTER (o_custkey % 13 = 0) FROM orders""")
def contract_metrics(spark, sf_dir):
    df = table(spark, sf_dir, "orders").withColumn("o_clerk", F.when(F.col("o_custkey") % 13 != 0, F.col("o_custkey")))
    return V.count_rules(df, [V.length_rule("o_orderpriority", 6), V.required_rule("o_clerk")])


@query("SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, count(*) FILTER (n > 1) AS n_repeated FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)")
def key_uniqueness(spark, sf_dir):
    return V.key_uniqueness(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# Keys and merging

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC"
LINE_DEDUP = f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) AS rn FROM lineitem %s) WHERE rn = 1"


@query(LINE_DEDUP % "")
def dedup_by_key(spark, sf_dir):
    return M.dedup_by_key(table(spark, sf_dir, "lineitem"), LINE_KEY, LINE_ORDER.split(", "))


@query(LINE_DEDUP % "")
def replace_load(spark, sf_dir):
    path = scratch(spark, "replaced")
    for lines in (table(spark, sf_dir, "lineitem").where("l_partkey % 2 = 1"), table(spark, sf_dir, "lineitem")):  # the second replaces the first
        replace_version(lines, path, LINE_KEY, ["l_shipdate"])
    return read_version(spark, path)


@query(f"""
    WITH incoming AS ({LINE_DEDUP % 'WHERE l_partkey % 2 = 0'}), target AS ({LINE_DEDUP % 'WHERE l_partkey % 2 = 1'})
    SELECT * FROM incoming UNION ALL
    SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.l_orderkey = t.l_orderkey AND i.l_linenumber = t.l_linenumber)""")
def upsert(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    target = M.latest_by_key(lines.where("l_partkey % 2 = 1"), LINE_KEY, ["l_shipdate"])
    return M.upsert(target, lines.where("l_partkey % 2 = 0"), LINE_KEY, ["l_shipdate"])


EXPORTED = ["customer", "nation", "orders", "part"]


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in EXPORTED))
def export_manifest(spark, sf_dir):
    folder = scratch(spark, "export")
    X.export_all({t: table(spark, sf_dir, t) for t in EXPORTED}, folder)
    return X.table_counts({t: spark.read.parquet(f"{folder}/{t}.parquet") for t in EXPORTED})


@query("SELECT 4 AS n_tables, CAST(sum(n) AS BIGINT) AS n_rows FROM (" + " UNION ALL ".join(f"SELECT count(*) AS n FROM {t}" for t in EXPORTED) + ")")
def manifest_totals(spark, sf_dir):
    return X.manifest_totals(X.table_counts({t: table(spark, sf_dir, t) for t in EXPORTED})).select(F.col("n_tables").cast("int").alias("n_tables"), "n_rows")


# Lookups


def _monthly(spark, sf_dir):
    return table(spark, sf_dir, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").cast("string").alias("codigo"), F.col("n_name").alias("descricao"))


def _enriched(spark, sf_dir):
    extra = table(spark, sf_dir, "nation").where("n_nationkey between 18 and 22").select(
        F.col("n_nationkey").cast("string").alias("codigo"), F.concat(F.upper("n_name"), F.lit("*")).alias("descricao"),
        F.when(F.col("n_nationkey") % 2 == 0, "high").otherwise("medium").alias("confidence"), F.lit(None).cast("string").alias("notes"),
    )
    return L.enrich_domain(_monthly(spark, sf_dir), extra, "official", "https://example.org/codes")


@query("""
    SELECT CAST(p_partkey AS VARCHAR) AS codigo, p_name AS descricao, 'receita_monthly' AS source_kind, NULL AS source_url, false AS is_supplemental, 'high' AS confidence, NULL AS notes FROM part WHERE p_size <= 40
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), upper(p_name) || '*', 'official', 'https://example.org/codes', true, CASE WHEN p_size > 45 THEN 'high' ELSE 'medium' END, p_brand FROM part WHERE p_size > 40""")
def enrich_domain(spark, sf_dir):
    parts = table(spark, sf_dir, "part").withColumn("codigo", F.col("p_partkey").cast("string"))
    extra = parts.where("p_size > 30").select(
        "codigo", F.concat(F.upper("p_name"), F.lit("*")).alias("descricao"), F.when(F.col("p_size") > 45, "high").otherwise("medium").alias("confidence"), F.col("p_brand").alias("notes")
    )
    return L.enrich_domain(parts.where("p_size <= 40").select("codigo", F.col("p_name").alias("descricao")), extra, "official", "https://example.org/codes")


SUPERSET_SQL = "(SELECT o_custkey AS k, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS p FROM orders WHERE o_orderstatus {})"


@query(f"""
    SELECT count(*) AS gaps, count(*) FILTER (p IS NULL) AS null_gaps FROM {SUPERSET_SQL.format("= 'O'")} s
    WHERE NOT EXISTS (SELECT 1 FROM {SUPERSET_SQL.format("<> 'O'")} l WHERE l.k = s.k AND l.p IS NOT DISTINCT FROM s.p)""")
def superset_check(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderstatus", "o_custkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("p"))
    larger, smaller = (rows.where(where).drop("o_orderstatus") for where in ("o_orderstatus <> 'O'", "o_orderstatus = 'O'"))
    return L.superset_gaps(larger, smaller).agg(F.count("*").alias("gaps"), F.count_if(F.col("p").isNull()).alias("null_gaps"))


@query("""
    SELECT label, count(*) AS n FROM orders LEFT JOIN (VALUES ('F', 'Finished'), ('O', 'Open')) v(code, label) ON code = o_orderstatus GROUP BY label""")
def dictionary_labels(spark, sf_dir):
    labels = L.static_dictionary(spark, [("F", "Finished"), ("O", "Open")], "codigo string, descricao string")
    return L.with_lookup(table(spark, sf_dir, "orders"), labels, "o_orderstatus", "label").groupBy("label").agg(F.count("*").alias("n"))


@query(f"""
    SELECT codigo, s.section AS secao, substr(codigo, 1, 2) AS divisao, substr(codigo, 1, 3) AS grupo, substr(codigo, 1, 4) || '-' || substr(codigo, 5, 1) AS classe
    FROM (SELECT lpad(CAST((p_partkey * 7919) % 10000000 AS VARCHAR), 7, '0') AS codigo FROM part)
    LEFT JOIN (VALUES {", ".join(f"('{d}', '{s}')" for d, s in section_rows())}) s(division, section) ON division = substr(codigo, 1, 2)""")
def prefix_hierarchy(spark, sf_dir):
    codes = table(spark, sf_dir, "part").select(F.lpad(((F.col("p_partkey") * 7919) % 10000000).cast("string"), 7, "0").alias("codigo"))
    sections = L.static_dictionary(spark, section_rows(), "divisao_code string, secao_name string")
    return L.prefix_hierarchy(codes, "codigo", sections).select("codigo", "secao", "divisao", "grupo", "classe")


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, o_orderstatus, v.label AS status_label, o_orderpriority, c_custkey, c_name, n_name AS nation_name, r_name AS region_name
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
    LEFT JOIN (VALUES ('F', 'Finished'), ('O', 'Open')) v(code, label) ON v.code = o_orderstatus""")
def denorm_mart(spark, sf_dir):
    t = lambda name: table(spark, sf_dir, name)
    orders = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"), "o_orderstatus", "o_orderpriority")
    out = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").join(orders, "l_orderkey")
    out = out.join(t("customer").select("c_custkey", "c_name", "c_nationkey"), "c_custkey")
    nations = t("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation_name"), "n_regionkey")
    out = out.join(L.small(nations), "c_nationkey", "left")
    out = L.with_lookup(out, t("region"), "n_regionkey", "region_name", key="r_regionkey", label="r_name")
    labels = L.static_dictionary(spark, [("F", "Finished"), ("O", "Open")], "codigo string, descricao string")
    out = L.with_lookup(out, labels, "o_orderstatus", "status_label")
    return out.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "o_orderstatus", "status_label", "o_orderpriority", "c_custkey", "c_name", "nation_name", "region_name"
    )


@query("""
    SELECT cn.n_name AS customer_nation, sn.n_name AS supplier_nation, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
    JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation cn ON cn.n_nationkey = c_nationkey LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) sn ON sn.n_nationkey = s_nationkey GROUP BY 1, 2""")
def role_playing(spark, sf_dir):
    t = lambda name: table(spark, sf_dir, name)
    lines = t("lineitem").select("l_orderkey", "l_suppkey").join(t("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey")), "l_orderkey")
    lines = lines.join(t("customer").select("c_custkey", "c_nationkey"), "c_custkey").join(t("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
    counts = lines.groupBy("c_nationkey", "s_nationkey").agg(F.count("*").alias("n"))  # few rows take the labels
    out = L.with_lookup(counts, t("nation"), "c_nationkey", "customer_nation", key="n_nationkey", label="n_name")
    out = L.with_lookup(out, t("nation").where("n_nationkey < 20"), "s_nationkey", "supplier_nation", key="n_nationkey", label="n_name")
    return out.groupBy("customer_nation", "supplier_nation").agg(F.sum("n").alias("n"))


FLAGS_SQL = """
    SELECT o_orderkey, c_custkey, CASE WHEN zip IS NULL THEN 'missing' WHEN zip = '00000000' THEN 'zero_sentinel' WHEN regexp_full_match(zip, '[0-9]{8}') THEN 'valid_shape' ELSE 'malformed' END AS zip_status,
      zip, c_nationkey = 24 AS is_abroad, c_nationkey IS NOT NULL AND c_nationkey >= 20 AS nation_lookup_missing, o_orderstatus NOT IN ('F', 'O') AS status_lookup_missing, c_custkey % 50 = 0 AS balance_is_sentinel,
      CASE WHEN c_custkey % 50 = 0 THEN 999999999999.0::DOUBLE ELSE c_acctbal END AS balance
    FROM (SELECT *, CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '00000000' WHEN 2 THEN CAST(o_orderkey AS VARCHAR) || 'A' ELSE lpad(CAST(o_orderkey AS VARCHAR), 8, '0') END AS zip
          FROM orders JOIN customer ON c_custkey = o_custkey)"""


def _flags(spark, sf_dir):
    t = lambda name: table(spark, sf_dir, name)
    key = F.col("o_orderkey")
    zip_ = F.when(key % 7 == 0, None).when(key % 7 == 1, "00000000").when(key % 7 == 2, F.concat(key.cast("string"), F.lit("A"))).otherwise(N.pad_code(key.cast("string"), 8))
    balance = F.when(F.col("c_custkey") % 50 == 0, 999999999999.0).otherwise(F.col("c_acctbal"))
    rows = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).withColumns({"zip": zip_, "balance": balance})
    rows = L.lookup_missing_flag(rows, t("nation").where("n_nationkey < 20"), "c_nationkey", "nation_lookup_missing", key="n_nationkey")
    rows = L.lookup_missing_flag(rows, L.static_dictionary(spark, [("F",), ("O",)], "codigo string"), "o_orderstatus", "status_lookup_missing")
    c = F.col("zip")
    status = L.shape_status(c, [(c == "00000000", "zero_sentinel"), (c.rlike(r"^[0-9]{8}\z"), "valid_shape")], "malformed")
    return rows.select(
        "o_orderkey", "c_custkey", status.alias("zip_status"), "zip", (F.col("c_nationkey") == 24).alias("is_abroad"), "nation_lookup_missing", "status_lookup_missing",
        L.sentinel_flag(F.col("balance"), 999999999999.0).alias("balance_is_sentinel"), "balance",
    )


@query(FLAGS_SQL)
def quality_flags(spark, sf_dir):
    return _flags(spark, sf_dir)


@query(f"""
    SELECT o_orderkey, zip AS zip_raw, CASE WHEN zip_status = 'valid_shape' THEN zip END AS zip_clean, balance AS balance_raw, CASE WHEN NOT balance_is_sentinel THEN balance END AS balance_clean, zip_status, is_abroad
    FROM ({FLAGS_SQL})""")
def clean_layer(spark, sf_dir):
    f = _flags(spark, sf_dir)
    return f.select(
        "o_orderkey", *L.raw_clean_pair(F.col("zip"), "zip", F.col("zip_status") != "valid_shape"), *L.raw_clean_pair(F.col("balance"), "balance", F.col("balance_is_sentinel")), "zip_status", "is_abroad"
    )


PARTNER_SQL = """
    SELECT c_custkey, agent = '***000000**' AND role = '00' AS agent_is_placeholder, role IS NOT NULL AND role <> '00' AND role NOT IN ('1', '2') AS role_lookup_missing, band = '0' AS band_does_not_apply, agent, role, band
    FROM (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN c_name ELSE '***000000**' END AS agent, CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '1' WHEN 2 THEN '00' ELSE '9' END AS role,
          CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_nationkey % 10 AS VARCHAR) END AS band FROM customer)"""


def _partners(spark, sf_dir):
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(k % 5 == 0, None).when(k % 5 == 1, F.col("c_name")).otherwise("***000000**").alias("agent"),
        F.when(k % 4 == 0, None).when(k % 4 == 1, "1").when(k % 4 == 2, "00").otherwise("9").alias("role"), F.when(k % 3 != 0, (F.col("c_nationkey") % 10).cast("string")).alias("band"),
    )
    rows = L.lookup_missing_flag(rows, L.static_dictionary(spark, [("1",), ("2",)], "codigo string"), "role", "role_lookup_missing", ignore=("00",))
    masked = (F.col("agent") == "***000000**") & (F.col("role") == "00")
    return rows.select("c_custkey", masked.alias("agent_is_placeholder"), "role_lookup_missing", (F.col("band") == "0").alias("band_does_not_apply"), "agent", "role", "band")


@query(PARTNER_SQL)
def partner_flags(spark, sf_dir):
    return _partners(spark, sf_dir)


@query(f"""
    SELECT c_custkey, agent AS agent_raw, CASE WHEN agent_is_placeholder THEN NULL ELSE agent END AS agent_clean, role AS role_raw, CASE WHEN agent_is_placeholder THEN NULL ELSE role END AS role_clean,
      band AS band_raw, CASE WHEN band_does_not_apply THEN NULL ELSE band END AS band_clean FROM ({PARTNER_SQL})""")
def partner_clean(spark, sf_dir):
    bad = {"agent": "agent_is_placeholder", "role": "agent_is_placeholder", "band": "band_does_not_apply"}
    return _partners(spark, sf_dir).select("c_custkey", *[x for c, b in bad.items() for x in L.raw_clean_pair(F.col(c), c, F.col(b))])


@query("""
    SELECT p_partkey, trim(part) AS word FROM (SELECT p_partkey, unnest(string_split(' ,' || replace(p_name, ' ', ' , ') || ',,', ',')) AS part FROM part) WHERE trim(part) <> ''""")
def exploded_list(spark, sf_dir):
    listed = F.concat(F.lit(" ,"), F.replace("p_name", F.lit(" "), F.lit(" , ")), F.lit(",,"))
    return L.explode_delimited(table(spark, sf_dir, "part").withColumn("listed", listed), ["p_partkey"], "listed", "word")


@query("""
    SELECT doc_id, trim(line) AS line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE trim(line) <> ''""")
def exploded_lines(spark, sf_dir):
    return L.explode_delimited(table(spark, sf_dir, "documents"), ["doc_id"], "text", "line", separator="\n")


# Search mart and rollups

SEARCH_SQL = """
    SELECT o_orderkey, o_orderpriority, c_custkey, c_name, c_mktsegment, c_nationkey, CASE WHEN c_nationkey < 20 THEN n_name END AS nation_name, CASE WHEN c_custkey % 6 <> 0 THEN c_mktsegment END AS activity
    FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey WHERE o_orderstatus = 'O' AND o_orderpriority <> '5-LOW'"""


def _search(spark, sf_dir):
    t = lambda name: table(spark, sf_dir, name)
    active = t("orders").where("o_orderstatus = 'O' and o_orderpriority <> '5-LOW'").select("o_orderkey", "o_orderpriority", F.col("o_custkey").alias("c_custkey"))
    out = active.join(t("customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey"), "c_custkey")
    out = L.with_lookup(out, t("nation").where("n_nationkey < 20"), "c_nationkey", "nation_name", key="n_nationkey", label="n_name")
    return out.withColumn("activity", F.when(F.col("c_custkey") % 6 != 0, F.col("c_mktsegment"))).select(
        "o_orderkey", "o_orderpriority", "c_custkey", "c_name", "c_mktsegment", "c_nationkey", "nation_name", "activity"
    )


@query(SEARCH_SQL)
def search_mart(spark, sf_dir):
    return _search(spark, sf_dir)


@query("SELECT p_name, p_partkey, p_brand FROM part WHERE p_name LIKE 's%' AND p_size > 10 ORDER BY p_name, p_partkey LIMIT 25")
def prefix_search(spark, sf_dir):
    return L.prefix_search(table(spark, sf_dir, "part"), "p_name", "s", ["p_partkey"], 25, where=lambda d: d.where("p_size > 10")).select("p_name", "p_partkey", "p_brand")


@query("SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%RE%'")
def substring_search(spark, sf_dir):
    return table(spark, sf_dir, "part").where(F.col("p_name").ilike("%RE%")).select("p_partkey", "p_name")


ROLLUP_SQL = f"""
    WITH m AS ({SEARCH_SQL})
    SELECT 'segment' AS kind, c_mktsegment, NULL AS nation_name, NULL AS activity, NULL AS nation_code, count(*) AS total FROM m GROUP BY c_mktsegment
    UNION ALL SELECT 'segment_nation', c_mktsegment, nation_name, NULL, min(c_nationkey), count(*) FROM m GROUP BY c_mktsegment, nation_name
    UNION ALL SELECT 'segment_activity', c_mktsegment, NULL, activity, NULL, count(*) FROM m GROUP BY c_mktsegment, activity"""


def _rollup(spark, sf_dir):
    kinds = {"segment": ["c_mktsegment"], "segment_nation": ["c_mktsegment", "nation_name"], "segment_activity": ["c_mktsegment", "activity"]}
    return L.count_rollups(_search(spark, sf_dir), kinds, {"segment_nation": {"nation_code": "c_nationkey"}})


@query(ROLLUP_SQL)
def count_rollups(spark, sf_dir):
    return _rollup(spark, sf_dir)


@query(f"SELECT total FROM ({ROLLUP_SQL}) WHERE kind = 'segment_activity' AND c_mktsegment = 'MACHINERY' AND activity = 'MACHINERY'")
def rollup_lookup(spark, sf_dir):
    return L.count_of(_rollup(spark, sf_dir), "segment_activity", c_mktsegment="MACHINERY", activity="MACHINERY")


@query(f"SELECT kind, CAST(sum(total) AS BIGINT) AS total FROM ({ROLLUP_SQL}) GROUP BY kind UNION ALL SELECT 'base', count(*) FROM ({SEARCH_SQL})")
def rollup_reconcile(spark, sf_dir):
    base = _search(spark, sf_dir).agg(F.count("*").alias("total")).select(F.lit("base").alias("kind"), "total")
    return _rollup(spark, sf_dir).groupBy("kind").agg(F.sum("total").alias("total")).unionByName(base)


@query(f"SELECT c_mktsegment, nation_name, total FROM ({ROLLUP_SQL}) WHERE kind = 'segment_nation' AND nation_name IS NOT NULL ORDER BY total DESC, c_mktsegment, nation_name LIMIT 5")
def top_buckets(spark, sf_dir):
    rows = _rollup(spark, sf_dir).where("kind = 'segment_nation' and nation_name is not null")
    return rows.orderBy(F.desc("total"), "c_mktsegment", "nation_name").limit(5).select("c_mktsegment", "nation_name", "total")


# Check digits

STEM_SQL = """
    SELECT o_orderkey, CASE o_orderkey % 5 WHEN 1 THEN 'AB' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') WHEN 2 THEN 'ab' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') ELSE lpad(CAST(o_orderkey * 37 AS VARCHAR), 12, '0') END AS stem,
      lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0') AS stored FROM orders"""
_dv = lambda weights: " + ".join(f"(ascii(substr(stem, {k}, 1)) - 48) * {w}" for k, w in enumerate(weights[:12], 1))
DIGITS_SQL = f"""
    SELECT o_orderkey, stem, stored, CASE WHEN regexp_full_match(stem, '[0-9A-Z]{{12}}') THEN CAST(d1 AS VARCHAR) || CAST(CASE WHEN 11 - s2 % 11 >= 10 THEN 0 ELSE 11 - s2 % 11 END AS VARCHAR) ELSE '<malformed-input>' END AS expected_dv
    FROM (SELECT *, {_dv(C.SECOND)} + d1 * 2 AS s2 FROM (SELECT *, CASE WHEN 11 - s1 % 11 >= 10 THEN 0 ELSE 11 - s1 % 11 END AS d1 FROM (SELECT *, {_dv(C.FIRST)} AS s1 FROM ({STEM_SQL}))))"""
CHECKED_SQL = f"SELECT *, expected_dv = stored AS dv_valid FROM ({DIGITS_SQL})"


def _checked(spark, sf_dir):
    k = F.col("o_orderkey")
    tail = F.lpad(k.cast("string"), 10, "0")
    stem = F.when(k % 5 == 1, F.concat(F.lit("AB"), tail)).when(k % 5 == 2, F.concat(F.lit("ab"), tail)).otherwise(F.lpad((k * 37).cast("string"), 12, "0"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", stem.alias("stem"), F.lpad((F.col("o_custkey") % 100).cast("string"), 2, "0").alias("stored"))
    return C.with_digit_check(rows, "stem", "stored")


@query(CHECKED_SQL)
def check_digits(spark, sf_dir):
    return _checked(spark, sf_dir)


@query(f"SELECT count(*) AS total, count(*) FILTER (dv_valid) AS valid, count(*) FILTER (NOT dv_valid) AS invalid FROM ({CHECKED_SQL})")
def check_digit_tally(spark, sf_dir):
    return C.digit_tally(_checked(spark, sf_dir))


@query(f"SELECT * FROM ({CHECKED_SQL}) WHERE NOT dv_valid ORDER BY o_orderkey LIMIT 10")
def invalid_examples(spark, sf_dir):
    return C.invalid_examples(_checked(spark, sf_dir), ["o_orderkey"])


# Quality report

ORPHANS_SQL = """
    SELECT 'customer.c_nationkey' AS label, count(*) FILTER (code IS NOT NULL AND code NOT IN (SELECT CAST(n_nationkey AS VARCHAR) FROM nation WHERE n_nationkey < 20)) AS orphans FROM (SELECT CASE WHEN c_custkey % 8 <> 0 THEN CAST(c_nationkey AS VARCHAR) END AS code FROM customer)
    UNION ALL SELECT 'supplier.s_nationkey', count(*) FILTER (s_nationkey >= 20 AND s_nationkey <> 24) FROM supplier"""


def _references(spark, sf_dir):
    tables = {
        "customer": table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 8 != 0, F.col("c_nationkey").cast("string")).alias("c_nationkey")),
        "supplier": table(spark, sf_dir, "supplier").select(F.col("s_nationkey").cast("string").alias("s_nationkey")),
        "nations": _monthly(spark, sf_dir), "nations_enriched": _enriched(spark, sf_dir),
    }
    checks = [
        Q.Reference("customer.c_nationkey", "customer", "c_nationkey", "nations", "nations_enriched"), Q.Reference("supplier.s_nationkey", "supplier", "s_nationkey", "nations", "nations_enriched", ("24",)),
    ]
    return tables, checks


@query(ORPHANS_SQL)
def orphan_report(spark, sf_dir):
    return Q.orphan_report(*_references(spark, sf_dir))


@query(f"""
    SELECT label, orphans AS monthly_orphans, CASE label WHEN 'supplier.s_nationkey' THEN (SELECT count(*) FROM supplier WHERE s_nationkey = 23) ELSE (SELECT count(*) FROM customer WHERE c_custkey % 8 <> 0 AND c_nationkey > 22) END AS enriched_orphans, true AS available
    FROM ({ORPHANS_SQL})""")
def enriched_coverage(spark, sf_dir):
    return Q.enriched_coverage(*_references(spark, sf_dir))


def _counters(spark, sf_dir):
    f = _flags(spark, sf_dir)
    status = F.col("zip_status")
    return Q.fused_counts(
        f, "orders",
        {
            "abroad": F.col("is_abroad"), "balance_sentinel": F.col("balance_is_sentinel"), "zip_null": status == "missing", "zip_zero": status == "zero_sentinel", "zip_malformed": status == "malformed",
            "nation_missing": F.col("nation_lookup_missing"),
        },
    )


COUNTERS_SQL = " UNION ALL ".join(
    f"SELECT 'orders' AS section, '{m}' AS metric, count(*) FILTER ({p}) AS value, count(*) AS total FROM ({FLAGS_SQL})"
    for m, p in (
        ("abroad", "is_abroad"), ("balance_sentinel", "balance_is_sentinel"), ("zip_null", "zip_status = 'missing'"), ("zip_zero", "zip_status = 'zero_sentinel'"), ("zip_malformed", "zip_status = 'malformed'"),
        ("nation_missing", "nation_lookup_missing"),
    )
)


@query(COUNTERS_SQL)
def sentinel_counts(spark, sf_dir):
    return _counters(spark, sf_dir)


@query(f"SELECT zip_status, count(*) AS n FROM ({FLAGS_SQL}) GROUP BY 1")
def shape_validity(spark, sf_dir):
    return _flags(spark, sf_dir).groupBy("zip_status").agg(F.count("*").alias("n"))


@query(f"SELECT section, metric, value, CASE WHEN total = 0 THEN 'n/a' ELSE printf('%.4f%%', value * 100.0::DOUBLE / total) END AS pct FROM ({COUNTERS_SQL})")
def quality_report(spark, sf_dir):
    return _counters(spark, sf_dir).select("section", "metric", "value", Q.percent(F.col("value"), F.col("total")).alias("pct"))


@query()
def bernoulli_sample(spark, sf_dir):
    return Q.sample_rows(table(spark, sf_dir, "lineitem"), 5.0, 42)


# Incremental ingest


def _landed(spark, sf_dir) -> tuple[str, DataFrame]:
    """Events as a folder of files, one for each of their types."""
    path = scratch(spark, "events")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    events.repartition(4, "event_type").write.parquet(path)
    return path, events


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_ingest(spark, sf_dir):
    path, events = _landed(spark, sf_dir)
    out, checkpoint = scratch(spark, "ingested"), scratch(spark, "checkpoint")
    for _ in range(2):  # the second run finds nothing new
        ingest_once(stream_files(spark, path, events.schema), out, checkpoint)
    return spark.read.schema(events.schema).parquet(out)


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def batch_latest(spark, sf_dir):
    return M.latest_by_key(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value"), ["user_id"], ["event_id"])


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def stream_upsert(spark, sf_dir):
    """Later events of a user come in later files and change the user's row; all batches run twice."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    path, out = scratch(spark, "events"), scratch(spark, "merged")
    edges = [None, *events.agg(F.percentile_approx("event_id", [0.33, 0.67])).first()[0], None]
    for low, high in zip(edges[:-1], edges[1:]):
        part = events.where((F.col("event_id") > low if low is not None else F.lit(True)) & (F.col("event_id") <= high if high is not None else F.lit(True)))
        part.repartition("user_id").write.mode("append").parquet(path)
    for _ in range(2):
        upsert_once(stream_files(spark, path, events.schema, files_per_batch=8), out, ["user_id"], ["event_id"], scratch(spark, "checkpoint"), buckets=16)
    return read_version(spark, out)


# The registry's own marts, over registry tables that stand on the given ones

REGISTRY_SQL = """
    WITH empresas AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cnpj_basico, c_name AS razao_social, CASE WHEN c_custkey % 20 = 0 THEN 999999999999.0 ELSE c_acctbal END AS capital_social FROM customer),
    estabelecimentos AS (
      SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS cnpj_basico, CAST(o_orderkey AS VARCHAR) AS cnpj_ordem, lpad(CAST(o_orderkey % 97 AS VARCHAR), 2, '0') AS cnpj_dv,
        CASE WHEN o_orderkey % 11 = 0 THEN '00000000' WHEN o_orderkey % 13 = 0 THEN '12A' WHEN o_orderkey % 17 <> 0 THEN lpad(CAST((o_orderkey * 7919) % 100000000 AS VARCHAR), 8, '0') END AS cep,
        CASE WHEN o_orderpriority LIKE '1%' THEN 'EX' ELSE 'SP' END AS uf, CASE WHEN o_orderkey % 7 > 0 THEN lpad(CAST(o_custkey % 40 AS VARCHAR), 3, '0') END AS pais, lpad(CAST(o_orderkey % 30 AS VARCHAR), 2, '0') AS motivo FROM orders),
    simples AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cnpj_basico, CASE WHEN c_nationkey < 12 THEN 'S' ELSE 'N' END AS opcao_pelo_simples FROM customer WHERE c_mktsegment <> 'BUILDING'),
    codes AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS codigo, n_name AS descricao FROM nation),
    reasons AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS codigo FROM nation)"""


def _registry_tables(spark, sf_dir):
    t = lambda name: table(spark, sf_dir, name)
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    key, customer, codes = F.col("o_orderkey"), pad(F.col("c_custkey"), 8).alias("cnpj_basico"), t("nation")
    cep = F.when(key % 11 == 0, "00000000").when(key % 13 == 0, "12A").when(key % 17 != 0, pad((key * 7919) % 100000000, 8))
    places = t("orders").select(
        pad(F.col("o_custkey"), 8).alias("cnpj_basico"), key.cast("string").alias("cnpj_ordem"), pad(key % 97, 2).alias("cnpj_dv"), cep.alias("cep"),
        F.when(F.col("o_orderpriority").like("1%"), "EX").otherwise("SP").alias("uf"), F.when(key % 7 > 0, pad(F.col("o_custkey") % 40, 3)).alias("pais"), pad(key % 30, 2).alias("motivo_situacao_cadastral"),
        F.lit("02").alias("situacao_cadastral"), F.lit(1).alias("identificador_matriz_filial"),
    )
    for c in FAMILIES["ESTABELE"].columns:
        if c not in places.columns:
            places = places.withColumn(c, F.lit(None).cast("string"))
    companies = t("customer").select(
        customer, F.col("c_name").alias("razao_social"), F.when(F.col("c_custkey") % 20 == 0, F.lit(CAPITAL_SENTINEL)).otherwise(F.col("c_acctbal")).alias("capital_social"),
        *[F.lit(None).cast("string").alias(c) for c in ("natureza_juridica", "qualificacao_responsavel", "porte", "ente_federativo_responsavel")],
    )
    simples = t("customer").where("c_mktsegment <> 'BUILDING'").select(customer, F.when(F.col("c_nationkey") < 12, "S").otherwise("N").alias("opcao_pelo_simples"))
    for c in FAMILIES["SIMPLESCSV"].columns:
        if c not in simples.columns:
            simples = simples.withColumn(c, F.lit(None).cast("string"))
    countries, reasons = (codes.select(pad(F.col("n_nationkey"), n).alias("codigo"), F.col("n_name").alias("descricao")) for n in (3, 2))
    some = {"paises": countries, "paises_enriched": countries, "motivos": reasons, "motivos_enriched": reasons}
    rest = dict.fromkeys(("cnaes", "municipios", "qualificacoes_socios_enriched", "naturezas_juridicas", "portes_empresa", "situacoes_cadastrais", "indicadores_matriz_filial"), reasons)
    return some | rest | {"empresas": companies, "estabelecimentos": places, "dados_simples": simples}


@query(REGISTRY_SQL + """
    SELECT cnpj_basico, cnpj_ordem, cnpj_basico || cnpj_ordem || cnpj_dv AS cnpj, razao_social, pais, codes.descricao AS pais_descricao, opcao_pelo_simples
    FROM empresas JOIN estabelecimentos USING (cnpj_basico) LEFT JOIN codes ON codigo = pais LEFT JOIN simples USING (cnpj_basico)""")
def company_detail_mart(spark, sf_dir):
    """All 52 columns are made; the ones that the given tables fill are compared."""
    mart = marts.empresa_detalhe(_registry_tables(spark, sf_dir))
    return mart.select("cnpj_basico", "cnpj_ordem", "cnpj", "razao_social", "pais", "pais_descricao", "opcao_pelo_simples")


MART_FLAGS_SQL = REGISTRY_SQL + """,
    flags AS (SELECT cnpj_basico, cnpj_ordem, cnpj_dv, cnpj_basico || cnpj_ordem || cnpj_dv AS cnpj, cep, capital_social,
        CASE WHEN cep IS NULL THEN 'missing' WHEN cep = '00000000' THEN 'zero_sentinel' WHEN regexp_full_match(cep, '[0-9]{8}') THEN 'valid_shape' ELSE 'malformed' END AS cep_status, uf = 'EX' AS is_exterior,
        pais IS NOT NULL AND pais NOT IN (SELECT codigo FROM codes) AS pais_lookup_missing, motivo NOT IN (SELECT codigo FROM reasons) AS motivo_lookup_missing, capital_social = 999999999999.0 AS capital_social_is_suspicious_sentinel
      FROM estabelecimentos JOIN empresas USING (cnpj_basico))"""


@query(MART_FLAGS_SQL + " SELECT cnpj, cep_status, is_exterior, pais_lookup_missing, motivo_lookup_missing, capital_social_is_suspicious_sentinel FROM flags")
def company_flags_mart(spark, sf_dir):
    flags = marts.data_quality_flags(_registry_tables(spark, sf_dir))
    return flags.select("cnpj", "cep_status", "is_exterior", "pais_lookup_missing", "motivo_lookup_missing", "capital_social_is_suspicious_sentinel")


@query(MART_FLAGS_SQL + """
    SELECT cnpj, cep_status, cep AS cep_raw, CASE WHEN cep_status = 'valid_shape' THEN cep END AS cep_clean, CASE WHEN NOT capital_social_is_suspicious_sentinel THEN capital_social END AS capital_social_clean FROM flags""")
def company_clean_mart(spark, sf_dir):
    """The flags meet the establishments by their three keys."""
    t = _registry_tables(spark, sf_dir)
    return marts.estabelecimentos_clean(t, marts.data_quality_flags(t)).select("cnpj", "cep_status", "cep_raw", "cep_clean", "capital_social_clean")
