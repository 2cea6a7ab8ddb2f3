"""Helpers that the training-data operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Spark's setting by which a query that has ended leaves no shuffle files.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The tables, with their paths, that go at the end of the innermost ``passing``.
_going: ContextVar[dict[DataFrame, str] | None] = ContextVar("going", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, read by Spark from wherever ``sf_dir`` points."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text column with null read as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else.

    ``lower`` does the same on texts of ASCII characters only, and is many times
    faster than ``translate``; only texts with other characters take the latter.
    """
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds`` (null ids: fold of the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the one the cluster names.

    Where none is set, a local session gets a folder of the machine; on a cluster that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tessaria-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written in here leaves no shuffle files behind; else they stay until the driver collects garbage."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` as Parquet into the shared folder and reads it back, which cuts the lineage.

    Any executor can read the files again, so a lost executor costs nothing that is in them, and
    nothing needs the shuffle files that led to them. They stay, unless that is within ``passing``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    if (going := _going.get()) is not None:
        going[out] = path
    return out


@contextmanager
def passing(*given: DataFrame) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """The tables that ``stored`` writes in here are deleted at the end, also after an error.

    So are ``given`` ones of the ``passing`` around this one. Gives a function for tables that are
    still read later: such a table stays, or goes at the end of the ``passing`` around this one.
    Nothing that reads another one lazily may leave.
    """
    around = _going.get()
    own = {table: around.pop(table) for table in given}

    def stays(table: DataFrame) -> DataFrame:
        path = own.pop(table)
        if around is not None:
            around[table] = path
        return table

    token = _going.set(own)
    try:
        yield stays
    finally:
        _going.reset(token)
        for table, path in own.items():
            spark = table.sparkSession
            file = spark._jvm.org.apache.hadoop.fs.Path(path)
            file.getFileSystem(spark._jsc.hadoopConfiguration()).delete(file, True)


def numbered_columns(df: DataFrame) -> list[Column]:
    """The columns of ``df`` as r0, r1 and so on, so that helper columns may have any other names."""
    return [F.col("`" + c.replace("`", "``") + "`").alias(f"r{i}") for i, c in enumerate(df.columns)]


def named_columns(df: DataFrame) -> list[Column]:
    """What ``numbered_columns`` made, under their own names."""
    return [F.col(f"r{i}").alias(c) for i, c in enumerate(df.columns)]


def no_clash(df: DataFrame, *names: str) -> dict[str, str]:
    """A name for each helper column that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = {}
    for name in names:
        own = f"_{name}"
        while own.lower() in taken:
            own = f"_{own}"
        taken.add(own.lower())
        out[name] = own
    return out
