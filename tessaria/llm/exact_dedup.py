"""Exact dedup by a heavy-hitter split, in DataFrame functions only.

A Misra-Gries summary (Spark's mergeable frequent-items sketch, ``approx_top_k``) names the
digests that may be frequent; an exact count over all rows verifies them. The winners, fewer
than ``1 / heavy_share`` by arithmetic, are broadcast, and their copies are decided on the map
side without a shuffle. What is left has no group above ``heavy_share`` of the rows, so an
ordinary shuffle on the digest is even enough.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessaria.llm.common import ascii_lower, stored, table, text_of

#: A digest is heavy when it has more than this share of the rows: fewer than 1,000 can be.
HEAVY_SHARE = 1 / 1000
#: Counters of the summary. Its error is below rows * 3.5 / TRACKED, so that all heavy digests are among the first CANDIDATES.
TRACKED, CANDIDATES = 10_000, 2_000
#: Summaries that one task merges.
FAN_IN = 64
#: Up to so many rows that lose are broadcast, and no text is shuffled; with more that is a join.
BROADCAST_ROWS = 1_000_000


def digest(text_col: str):
    """SHA-256 of the text with A-Z lower-cased, in hex."""
    return F.sha2(ascii_lower(text_of(text_col)), 256)


def heavy_digests(keys: DataFrame, digest_col: str, id_col: str, heavy_share: float = HEAVY_SHARE) -> DataFrame:
    """(h_digest, h_keep, h_size) of every digest with more than ``heavy_share`` of the rows of ``keys``.

    The candidates come from the Misra-Gries summary, over 64-bit hashes of the digests; counts are
    exact, over all rows. Tasks' summaries are merged ``FAN_IN`` at a time, never all in one task.
    """
    part, n = F.spark_partition_id(), FAN_IN
    own = keys.select(F.xxhash64(digest_col).alias("x"), (part % (n * n)).alias("p2"))
    level = own.groupBy("p2").agg(F.expr(f"approx_top_k_accumulate(x, {TRACKED})").alias("s"), F.count("*").alias("n"))
    level = level.groupBy((F.col("p2") % n).alias("p1")).agg(F.expr("approx_top_k_combine(s)").alias("s"), F.sum("n").alias("n"))
    # a group of its own, not a global aggregate: without rows there is nothing to estimate from
    sketch = level.groupBy((F.col("p1") % 1).alias("p0")).agg(F.expr("approx_top_k_combine(s)").alias("s"), F.sum("n").alias("n"))
    named = sketch.select("n", F.explode(F.expr(f"approx_top_k_estimate(s, {CANDIDATES})")).alias("t")).select(F.col("t.item").alias("x"), F.col("n").alias("h_rows"))
    return (
        keys.select(F.col(digest_col).alias("h_digest"), F.col(id_col).alias("h_id"), F.xxhash64(digest_col).alias("h_x"))
        .join(F.broadcast(named), F.col("h_x") == F.col("x"))  # at most CANDIDATES rows
        .groupBy("h_digest")
        .agg(F.max("h_id").alias("h_keep"), F.count("*").alias("h_size"), F.max("h_rows").alias("h_rows"))
        .filter(F.col("h_size") > F.greatest(F.lit(1.0), F.col("h_rows") * heavy_share))
        .select("h_digest", "h_keep", "h_size")
    )


def mark_duplicates(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", heavy_share: float = HEAVY_SHARE) -> DataFrame:
    """One row per row of ``df``: the id, keep_id, group_size, kept and text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal texts
    the largest id stays (null ids are smaller than any other). Rows that repeat both id and text
    are the same document: each is marked like the first. An empty table gives an empty result.
    """
    keys = stored(df.select(F.col(id_col).alias("doc_id"), digest(text_col).alias("text_sha256")), "digests")
    heavy = F.broadcast(heavy_digests(keys, "text_sha256", "doc_id", heavy_share))  # under 1 / heavy_share rows
    tried = keys.join(heavy, F.col("text_sha256") == F.col("h_digest"), "left")
    done = tried.filter(F.col("h_digest").isNotNull()).select("doc_id", "text_sha256", F.col("h_keep").alias("keep_id"), F.col("h_size").alias("group_size"))
    group = W.partitionBy("text_sha256")
    rest = tried.filter(F.col("h_digest").isNull()).select("doc_id", "text_sha256", F.max("doc_id").over(group).alias("keep_id"), F.count("*").over(group).alias("group_size"))
    return done.unionByName(rest).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_duplicates(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", heavy_share: float = HEAVY_SHARE) -> DataFrame:
    """``df`` with one row of each group of equal texts: the largest id, and of repeated rows one.

    Texts are equal as in ``mark_duplicates``: null and empty ones are one group, null ids stay only
    where a group has no other. Of rows that repeat both id and text any one stays. Texts of any
    length are compared by digest. Columns of ``df`` may have any names; an empty table stays empty.
    """
    keys = stored(df.select(F.col(id_col).alias("k_id"), digest(text_col).alias("k_digest")), "digests")
    heavy = F.broadcast(heavy_digests(keys, "k_digest", "k_id", heavy_share))
    light = keys.join(heavy, F.col("k_digest") == F.col("h_digest"), "left_anti")
    each = light.groupBy("k_digest", "k_id").agg(F.count("*").alias("n"))
    last = F.max(F.struct("k_id")).over(W.partitionBy("k_digest"))  # null is smaller than any id
    decided = stored(each.withColumn("keep", last).filter(~F.col("k_id").eqNullSafe(F.col("keep.k_id")) | (F.col("n") > 1)), "decided")
    losers, repeats = decided.filter(~F.col("k_id").eqNullSafe(F.col("keep.k_id"))).select("k_digest", "k_id"), decided.filter(F.col("k_id").eqNullSafe(F.col("keep.k_id"))).select("k_digest")
    small = lambda x: F.broadcast(x) if x.count() <= BROADCAST_ROWS else x
    wide = df.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), digest(text_col).alias("digest"))
    tried = wide.join(heavy, F.col("digest") == F.col("h_digest"), "left").filter(F.col("h_digest").isNull() | F.col("id").eqNullSafe(F.col("h_keep")))
    tried = tried.join(small(losers), (F.col("digest") == F.col("k_digest")) & F.col("id").eqNullSafe(F.col("k_id")), "left_anti")
    # of what stays, only rows that repeat both id and text still have to meet
    again = repeats.unionByName(heavy.select(F.col("h_digest").alias("k_digest")))
    marked = tried.join(small(again.withColumn("again", F.lit(True))), F.col("digest") == F.col("k_digest"), "left")
    alone, several = marked.filter(F.col("again").isNull()), marked.filter(F.col("again").isNotNull()).dropDuplicates(["digest"])
    return alone.select("row").unionByName(several.select("row")).select(*[F.col("row")[c].alias(c) for c in df.columns])


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of ``documents``: a row for each document, dropped ones too."""
    return mark_duplicates(table(spark, sf_dir, "documents"))


SQL = """
WITH k AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, text_sha256
FROM k WINDOW g AS (PARTITION BY text_sha256)
"""
