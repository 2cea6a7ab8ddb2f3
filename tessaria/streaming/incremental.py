"""Resuming a batch: a store of processed keys with a fingerprint of the input that they belong to."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, path: str, fingerprint: str) -> DataFrame | None:
    """The results stored under the same fingerprint, else null."""
    try:
        stored = spark.read.parquet(path)
    except AnalysisException:
        return None
    return stored.drop("fingerprint") if stored.filter(F.col("fingerprint") != fingerprint).isEmpty() else None


def save(df: DataFrame, path: str, fingerprint: str, append: bool = False) -> None:
    df.withColumn("fingerprint", F.lit(fingerprint)).write.mode("append" if append else "overwrite").parquet(path)


def pending(inputs: DataFrame, done: DataFrame | None, key: str) -> DataFrame:
    """``inputs`` whose key has no result yet."""
    return inputs if done is None else inputs.join(done.select(key).distinct(), key, "left_anti")


def run_new(inputs: DataFrame, work, path: str, key: str, fingerprint: str) -> DataFrame:
    """``work`` over what is pending, appended to the store; all results so far. Running it again does nothing new."""
    spark = inputs.sparkSession
    done = load(spark, path, fingerprint)
    save(work(pending(inputs, done, key)), path, fingerprint, append=done is not None)
    return load(spark, path, fingerprint)


def stream_new(stream: DataFrame, work, path: str, key: str, checkpoint: str):
    """The same over a stream: each micro-batch's new keys are worked on and appended, once."""

    def batch(df: DataFrame, number: int) -> None:
        run_new(df.dropDuplicates([key]), work, path, key, "stream")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
