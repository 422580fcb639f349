"""Exact deduplication against a persistent digest index.

The index is a catalog table of one row per distinct normalised text,
bucketed and sorted by digest. A batch is digested by built-in functions, its
own copies are counted with map-side aggregation, the survivors are
anti-joined (sort-merge, the index side needs no exchange) with the index and
appended to it.

Defined results: a null text counts as empty; equal texts are equal after the
deletion of all of space and U+0009-U+000D; of equal texts the one with the
most code points in the original stays, then the smallest id (a null id comes
last), then one of fully repeated rows. Other columns of the input are not
read. An empty batch appends nothing and returns no rows. A batch that is run
again under its id, after an append that was cut short or whose answer was
lost, gets the decisions of its first run and appends only what is missing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxcover.llm.common import SPACE, free_names, stored
from rxcover.session import scratch_path
from rxcover.sinks.writers import remove

INDEX_SCHEMA = "text_sha256 string, keep_id long, batch string"
#: Buckets of a new index; a parameter of ``new_index`` sized to the corpus.
BUCKETS = 32


def normalised(text: Column) -> Column:
    """Text without white space (null: empty). One byte-wise replace per
    character; a regular expression costs several times as much."""
    out = F.coalesce(text, F.lit(""))
    for c in SPACE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def new_index(spark: SparkSession, buckets: int = BUCKETS, name: str | None = None) -> str:
    """Create an empty index table and return its name."""
    name = name or f"digest_index_{uuid.uuid4().hex}"
    (spark.createDataFrame([], INDEX_SCHEMA).write
     .bucketBy(buckets, "text_sha256").sortBy("text_sha256")
     .option("path", scratch_path(spark, "llm", name)).saveAsTable(name))
    return name


def drop_index(spark: SparkSession, index: str) -> None:
    """Remove an index table and its files."""
    spark.sql(f"DROP TABLE IF EXISTS `{index}`")
    remove(spark, scratch_path(spark, "llm", index))


def dedup_batch(spark: SparkSession, docs: DataFrame, index: str, buckets: int = BUCKETS,
                id_col: str = "doc_id", text_col: str = "text", batch: str | None = None) -> DataFrame:
    """Decide every row of ``docs`` against ``index`` and append the new
    digests to it. One row per input row: ``doc_id, keep_id, group_size``
    (rows of this batch with the digest), ``kept, text_sha256``. A digest
    that the index already holds keeps none of the batch's rows; its
    ``keep_id`` is the indexed row's. ``batch`` names these rows: digests that
    the index holds from the same batch are this batch's own, so a job that
    died after the append can be run again. Without a name every call is a
    batch of its own. The decisions are written before they are returned and
    no longer depend on the index."""
    batch = uuid.uuid4().hex if batch is None else batch
    rows = stored(docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.sha2(normalised(F.col(text_col)).cast("binary"), 256).alias("text_sha256"),
        F.coalesce(F.length(text_col), F.lit(0)).alias("n"),
        F.monotonically_increasing_id().alias("rid")), "digests")
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("doc_id").isNull().alias("nul"), "doc_id", "rid"))
    groups = rows.groupBy("text_sha256").agg(best.alias("w"), F.count(F.lit(1)).alias("group_size"))
    groups = stored(groups.select("text_sha256", "group_size", F.col("w.doc_id").alias("keep_id"),
                                  F.col("w.rid").alias("keep_rid")), "digest-groups")
    held = spark.table(index)
    fresh = groups.join(held.hint("merge"), "text_sha256", "left_anti")
    (fresh.select("text_sha256", "keep_id", F.lit(batch).alias("batch"))
     .write.mode("append").bucketBy(buckets, "text_sha256").sortBy("text_sha256")
     .option("path", scratch_path(spark, "llm", index)).saveAsTable(index))
    now = spark.table(index).select("text_sha256", F.col("keep_id").alias("held_id"),
                                    (F.col("batch") == batch).alias("mine"))
    decided = stored(groups.join(now.hint("merge"), "text_sha256").select(
        "text_sha256", "group_size", F.col("held_id").alias("keep_id"), "keep_rid", "mine"), "digest-decided")
    # copies per digest are skewed: an equi-join, whose hot side can be split
    return rows.join(decided, "text_sha256").select(
        "doc_id", "keep_id", "group_size",
        (F.col("mine") & (F.col("rid") == F.col("keep_rid"))).alias("kept"), "text_sha256")


def exact_dedup(spark: SparkSession, docs: DataFrame, **kw) -> DataFrame:
    """Decisions for a whole table against a new index, which goes again."""
    index = new_index(spark)
    try:
        return dedup_batch(spark, docs, index, **kw)
    finally:
        drop_index(spark, index)


def keep_first_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    keep_id, keep_sha, sha = free_names(docs, "__keep_id", "__keep_sha", "__sha")
    kept = exact_dedup(spark, docs).where("kept").select(
        F.col("doc_id").alias(keep_id), F.col("text_sha256").alias(keep_sha))
    out = docs.withColumn(sha, F.sha2(normalised(F.col("text")).cast("binary"), 256)).join(
        kept, F.col("doc_id").cast("long").eqNullSafe(F.col(keep_id)) & (F.col(sha) == F.col(keep_sha)))
    # fully repeated rows share id and text: the join's own key, no exchange
    out = out.dropDuplicates([keep_id, keep_sha])
    return out.select(*docs.columns)
