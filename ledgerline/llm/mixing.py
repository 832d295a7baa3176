"""Mixing sources to target weights: weighted reservoir keys, epochs, token budgets.

Each source gets a share of a token budget by weight, at most `most` times its
own size; what it can't hold goes to the others by weight.  A source takes whole
epochs first.  The rest of its budget goes to documents in the order of their
exponential keys -ln(u) / quality weight (Efraimidis and Spirakis), u from a hash
of the id, until the prefix sum of sizes reaches it; the last document is cut.

A source is never sorted as a whole: sizes are summed by key bin, the bin at
which a source's budget ends is found on those sums, and only its documents are
sorted.

Defined results: null or empty texts have size 0 and take 0; a null source is a
source of its own, last in order; a source with no words has target 0; a null id
takes its key from the text; repeated rows count each; extra columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .common import documents, written

BINS = 4096
JUNK = r"0123456789#*$%&|<>@{}[]=_/~"
_junk = np.isin(np.arange(256), list(JUNK.encode()))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, at = K.text_column(batch.column("text"))
        parts = [(K.count_words(b, a), K.row_counts(_junk[b], a)) for _, _, b, a in K.slices(buf, at)]
        size, junk = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 2
        weight = 1.0 - 0.9 * junk / np.maximum(at[1:] - at[:-1], 1)
        kept = ["doc_id", "source", "salt"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(size), pa.array(weight)], [*kept, "size", "weight"])


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words, quality weight, key and key bin of each row.

    The quality weight is 1, less nine tenths of the part of the bytes that are in JUNK.
    Where there is no id, the text's hash stands for it, so such rows are dealt over the bins too.
    """
    salt = F.when(F.col("doc_id").isNull(), F.concat(F.lit(":"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))).alias("salt")
    out = documents(docs, F.col("source").cast("string").alias("source"), salt).mapInArrow(_measured, "doc_id long, source string, salt string, size long, weight double")
    unit = (F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.col("salt")))), 1, 12), 16, 10).cast("double") + 1.0) / F.lit(2.0**48 + 1)
    out = out.withColumn("key", -F.log(unit) / F.col("weight"))
    # exp(-key) is spread almost evenly over 0..1, so bins hold about as many rows each
    return out.withColumn("bin", F.floor((1 - F.exp(-F.col("key"))) * BINS).cast("int"))


def weighted_sources(sizes: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """source, source_size and weight by order of code point, null last; one small row per source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    return by_source.withColumn("weight", F.element_at(cycle, ((F.row_number().over(order) - 1) % len(weights)).cast("int") + 1))


def targets(by_source: DataFrame, share: float, most: float) -> DataFrame:
    """Adds target: the share of all sizes by weight, at most `most` times a source's size.

    With sources in order of how soon they are full, the full ones are a prefix;
    each later one gets its weight's part of what those leave.
    """
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    out = by_source.select(
        "*", F.sum("source_size").over(Window.partitionBy()).alias("all"),
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("held"), F.sum("weight").over(after).alias("open"), F.row_number().over(order).alias("place"),
    )
    level = (share * F.col("all") - most * F.col("held")) / F.col("open")
    out = out.withColumn("level", level).withColumn("fits", level * F.col("weight") <= most * F.col("source_size"))
    at = F.min(F.when(F.col("fits"), F.struct("place", "level"))).over(Window.partitionBy())
    out = out.withColumn("at", at)
    full = F.col("at").isNull() | (F.col("place") < F.col("at.place"))
    return out.select("source", "source_size", "weight", F.when(full, most * F.col("source_size")).otherwise(F.col("at.level") * F.col("weight")).cast("double").alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every document row."""
    rows = written(sized(docs), "mix-sizes")
    sums = rows.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    plan = targets(weighted_sources(sums.withColumnRenamed("bin_size", "size"), weights), share, most)
    plan = plan.withColumn("budget", F.round("target").cast("long"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("epochs", epochs.cast("long")).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
    by_bin = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = sums.withColumn("before", F.coalesce(F.sum("bin_size").over(by_bin), F.lit(0)))
    bins = bins.alias("b").join(plan.alias("p"), F.col("b.source").eqNullSafe(F.col("p.source")))
    bins = bins.select(F.col("b.source").alias("bin_source"), F.col("bin").alias("bin_of"), "before", "bin_size", "source_size", "target", "epochs", "rest")
    edge = (F.col("before") < F.col("rest")) & (F.col("before") + F.col("bin_size") > F.col("rest"))
    bins = bins.withColumn("state", F.when(edge, 1).when(F.col("before") < F.col("rest"), 2).otherwise(0))
    # a bin has one row here, and a source's rows are dealt over its bins
    placed = rows.join(bins, rows["source"].eqNullSafe(bins["bin_source"]) & (rows["bin"] == bins["bin_of"]))
    inner = Window.partitionBy("source", "bin").orderBy("key", "doc_id", "size", "weight").rowsBetween(Window.unboundedPreceding, -1)
    columns = ["doc_id", "source", "size", "source_size", "target"]
    cut = placed.where("state = 1").withColumn("ahead", F.col("before") + F.coalesce(F.sum("size").over(inner), F.lit(0)))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("ahead")))
    cut = cut.select(*columns, (F.col("epochs") * F.col("size") + part).alias("taken"))
    whole = placed.where("state <> 1").select(*columns, ((F.col("epochs") + F.when(F.col("state") == 2, 1).otherwise(0)) * F.col("size")).alias("taken"))
    return whole.unionByName(cut)
