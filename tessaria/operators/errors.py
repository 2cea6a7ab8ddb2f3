"""Rows and typed errors of one scan: what can be used goes on, what is wrong goes into one table of errors.

Every stage says what is wrong as a check. All checks of a row are found where the row is read; the
input is scanned once, and kept rows and errors are two views of what that scan wrote.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tessaria.sources.files import cut

#: The columns of an error, whatever its stage.
COLUMNS = ["orgao_sigla", "document_type", "stage", "error_type", "error_message", "timestamp", "url"]


@dataclass(frozen=True)
class Check:
    """What a stage calls an error: where ``failed`` is true (null is not). A ``fatal`` one ends the row's way: later checks don't count."""

    stage: str
    error_type: str
    failed: Column
    message: Column
    fatal: bool = True


def channel(df: DataFrame, checks: list[Check], key: Column, document_type: Column, timestamp: Column, url: Column | None = None) -> tuple[DataFrame, DataFrame, Observation]:
    """(kept, errors, counts): the rows of ``df`` without a fatal error, the errors of all rows, and how many there are.

    ``errors`` has ``COLUMNS``; a row has one for each check that failed, in the order of the checks, up
    to the first fatal one. ``counts`` has ``rows``, ``kept`` and a number for each ``stage.error_type``.
    Null keys are kept as such; a check's message is null where it can't be made.
    """
    item = lambda c: F.struct(F.lit(c.stage).alias("stage"), F.lit(c.error_type).alias("error_type"), c.message.cast("string").alias("error_message"), F.lit(c.fatal).alias("fatal"))
    found = F.array_compact(F.array(*[F.when(F.coalesce(c.failed, F.lit(False)), item(c)) for c in checks]))
    end = F.array_position(F.transform("all", lambda e: e["fatal"]), F.lit(True))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), found.alias("all"), key.alias("key"), document_type.alias("document_type"), timestamp.cast("string").alias("timestamp"), (F.lit(None) if url is None else url).cast("string").alias("url"))
    rows = rows.withColumn("errors", F.when(end > 0, F.slice("all", F.lit(1), F.greatest(end, F.lit(1)).cast("int"))).otherwise(F.col("all"))).withColumn("kept", end == 0).drop("all")
    counts = Observation()
    has = lambda c: F.exists("errors", lambda e: (e["stage"] == c.stage) & (e["error_type"] == c.error_type))
    each = [F.count_if(has(c)).alias(f"{c.stage}.{c.error_type}") for c in checks]
    held = cut(rows.observe(counts, F.count(F.lit(1)).alias("rows"), F.count_if("kept").alias("kept"), *each))
    kept = held.filter("kept").select(*[F.col("row")[c].alias(c) for c in df.columns])
    errors = held.select(F.col("key").alias("orgao_sigla"), "document_type", F.explode("errors").alias("e"), "timestamp", "url")
    return kept, errors.select("orgao_sigla", "document_type", "e.stage", "e.error_type", "e.error_message", "timestamp", "url"), counts


def together(*stages: DataFrame) -> DataFrame:
    """The errors of several channels as one table; columns that one lacks are null."""
    out = None
    for s in stages:
        s = s.select(*[(F.col(c) if c in s.columns else F.lit(None)).cast("string").alias(c) for c in COLUMNS])
        out = s if out is None else out.unionByName(s)
    return out
