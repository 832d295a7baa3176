"""The registered queries of this subpackage, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .decontamination import contaminated
from .hard_negatives import hard_negatives
from .html_extract import extract
from .line_dedup import line_dedup
from .lm_scoring import lm_scores
from .minhash import near_duplicates
from .mixing import JUNK, mix
from .quality_rules import quality_rules
from .secrets import scan_secrets
from .substring_dedup import substring_dedup
from .suffix_dedup import suffix_dedup
from .toxicity import score_toxicity
from .whitening import whiten


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=2)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents"), runs=True)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a seventh of the labels are shifted, so that labels and vectors disagree
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label))


def op12_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash, op2_toxicity, op3_mixing, op4_decontamination, op5_lm_scoring, op6_substring_dedup, op7_line_dedup, op8_quality_rules, op9_secrets, op10_suffix_dedup,
        op11_hard_negatives, op12_html, op13_whitening,
    )
}

WORDS_SQL = r"list_filter(string_split_regex({0}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op1_minhash": f"""
        WITH RECURSIVE w AS (SELECT doc_id, {WORDS_SQL.format(LOWER_SQL)} AS w FROM documents),
        n AS (SELECT doc_id, CASE WHEN len(w) > 1 THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) ELSE w END AS sh FROM w),
        s AS (SELECT doc_id, unnest(sh) AS g FROM n),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
        l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (len(nx.sh) + len(ny.sh) - c)),
        r(x, y) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
        SELECT doc_id, len(sh) AS n_shingles, component_id, component_id = doc_id AS kept FROM n JOIN (SELECT x, min(y) AS component_id FROM r GROUP BY x) ON x = doc_id""",
    "op3_mixing": f"""
        WITH d AS (
          SELECT doc_id, source, text, len({WORDS_SQL.format("coalesce(text, '')")}) AS size, strlen(coalesce(text, '')) AS bytes,
            length(coalesce(text, '')) - length(translate(coalesce(text, ''), '{JUNK}', '')) AS junk FROM documents),
        k AS (
          SELECT *, -ln((CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), ':' || md5(coalesce(text, '')))), 1, 12) AS BIGINT) + 1)::DOUBLE / 281474976710657::DOUBLE) / (1::DOUBLE - 0.9::DOUBLE * junk / greatest(bytes, 1)) AS key FROM d),
        b AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
        w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS weight FROM b),
        t AS (
          SELECT *, row_number() OVER o AS place, (1.5::DOUBLE * sum(source_size) OVER () - 2::DOUBLE * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w WINDOW o AS (ORDER BY source_size / weight, source NULLS LAST)),
        f AS (SELECT *, min(CASE WHEN level * weight <= 2 * source_size THEN place END) OVER () AS first FROM t),
        g AS (SELECT source, source_size, CASE WHEN first IS NULL OR place < first THEN 2::DOUBLE * source_size ELSE (SELECT level FROM t WHERE t.place = f.first) * weight END AS target FROM f),
        e AS (SELECT *, CAST(round(target) AS BIGINT) AS budget, CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM g)
        SELECT doc_id, size, source_size, target, CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - ahead)) AS BIGINT) AS taken
        FROM (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM k) k
        JOIN e ON e.source IS NOT DISTINCT FROM k.source""",
    "op6_substring_dedup": f"""
        WITH d AS (SELECT doc_id, {WORDS_SQL.format("coalesce(text, '')")} AS w FROM documents),
        u AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, w FROM d),
        x AS (SELECT doc_id, i, w[i] AS word, CASE WHEN i + 19 <= len(w) THEN md5(array_to_string(w[i:i + 19], ' ')) END AS g FROM u),
        f AS (SELECT *, g IS NOT NULL AND row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1 AS again FROM x),
        c AS (SELECT *, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM f),
        k AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM c GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)""",
    "op11_hard_negatives": """
        WITH q AS (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
          WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT a.vec_id AS anchor, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
          FROM q a JOIN q b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
        p AS (SELECT anchor, id, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5),
        c AS (
          SELECT p.anchor AS anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
            s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
          FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
        SELECT * FROM c WHERE rank <= 3""",
}
