"""Shared files: one owner for each content, and error rows for files that are missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def own_by_content(df: DataFrame, hash_col: str, key: str, path_col: str) -> DataFrame:
    """``df`` with owner and shared: of rows with one content the smallest key owns it, others lose their path.

    Rows without a hash are untouched. Owners come from a grouped minimum, which combines before
    the shuffle, so a content that many rows share is no hot spot there.
    """
    owners = df.filter(F.col(hash_col).isNotNull()).groupBy(F.col(hash_col).alias("o_hash")).agg(F.min(key).alias("owner"), F.count("*").alias("shared"))
    joined = df.join(owners, F.col(hash_col) == F.col("o_hash"), "left").drop("o_hash")
    mine = F.col("owner").isNull() | (F.col(key) == F.col("owner"))
    return joined.withColumn(path_col, F.when(mine, F.col(path_col)))


def missing(expected: DataFrame, present: DataFrame, key: str, stage: str, error_type: str, message: str) -> DataFrame:
    """Error rows for keys of ``expected`` that ``present`` lacks."""
    gone = expected.join(present.select(key), key, "left_anti")
    return gone.select(key, F.lit(stage).alias("stage"), F.lit(error_type).alias("error_type"), F.lit(message).alias("error_message"))


def drop_fetched(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """One row for each address, so that nothing is fetched twice."""
    return urls.dropDuplicates([url_col])
