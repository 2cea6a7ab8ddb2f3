"""Files in and out: CSV, JSON, binary inventories, nested JSON, checksums, diffs, archives."""

from __future__ import annotations

import json
import re
import tempfile
import time
import urllib.error
import urllib.request
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessaria.functions import text as tx

#: Politeness and patience of downloads: seconds before each try, tries, seconds to wait for an answer.
DELAY, TRIES, TIMEOUT = 2, 4, 90
#: Rows of a fingerprint that are hashed together.
BLOCK = 10_000


def fetch(url: str, opener: Callable | None = None, sleep: Callable[[float], None] = time.sleep, tries: int = TRIES, delay: float = DELAY) -> bytes | None:
    """The body of an address, or null after ``tries``; every try waits first, a failed one twice as long as the last."""
    opener = opener or (lambda u: urllib.request.urlopen(u, timeout=TIMEOUT))
    for attempt in range(tries):
        sleep(delay)
        try:
            answer = opener(url)
            if answer.status == 200:
                return answer.read()
            if answer.status < 400:
                continue
        except (OSError, urllib.error.URLError):
            pass
        sleep(delay * 2**attempt)
    return None


def preflight(url: str, opener: Callable | None = None) -> bool:
    """Whether an address answers with a status under 400."""
    try:
        return (opener or (lambda u: urllib.request.urlopen(u, timeout=TIMEOUT)))(url).status < 400
    except (OSError, urllib.error.URLError):
        return False


def read_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A CSV with header, quoted line ends and an optional byte order mark; empty cells are empty texts."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8")
    df = (reader.schema(schema) if schema is not None else reader).csv(path)
    return df.select(*[F.coalesce(c, F.lit("")).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def csv_header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.option("header", True).csv(path).columns


def read_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def write_csv(df: DataFrame, path: str, *order: str) -> None:
    """One CSV file, sorted: for exports that people read; data goes to Parquet."""
    (df.orderBy(*order) if order else df).coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').option("lineSep", "\n").option("emptyValue", "").csv(path)


def inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, name, length, modified, content) of the files of a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), "length", F.col("modificationTime").alias("modified"), "content")


def checksums(files: DataFrame) -> DataFrame:
    """(name, linhas, bytes, md5, sha256) of an inventory of files of any kind; line ends are counted byte by byte."""
    text = F.decode("content", "ISO-8859-1")
    return files.select("name", tx.line_count(text).alias("linhas"), F.col("length").alias("bytes"), F.md5("content").alias("md5"), F.sha2("content", 256).alias("sha256"))


def document_metadata(files: DataFrame) -> DataFrame:
    """(name, created, modified, tamanho_kb) of documents; dates from their information marks, empty without one."""
    head = F.decode(F.col("content"), "ISO-8859-1")
    mark = lambda k: tx.parse_document_date(F.regexp_extract(head, rf"/{k}\s*\((D:\d{{8}})", 1))
    return files.select("name", mark("CreationDate").alias("data_criacao_pdf"), mark("ModDate").alias("data_modificacao_pdf"), F.lit("").alias("vigencia"), F.round(F.col("length") / 1024).cast("long").alias("tamanho_kb"))


def document_checks(files: DataFrame, least: int = 10_240) -> DataFrame:
    """(name, error_type): invalid_pdf without the magic bytes, small_pdf under ``least``, else null."""
    magic = F.col("content").substr(1, 4) == F.lit(b"%PDF")
    return files.select("name", F.when(~magic, "invalid_pdf").when(F.col("length") < least, "small_pdf").alias("error_type"))


def nested_json(df: DataFrame, key: str, seq: str, fields: list[str], extra: dict[str, str] | None = None) -> DataFrame:
    """One row (metadata, data) as JSON: rows by key in the order they were read; a missing key is UNKNOWN.

    Each key's rows meet in one task; this is an export format for entries of one group.
    """
    name = F.when(F.coalesce(key, F.lit("")) == "", "UNKNOWN").otherwise(F.col(key))
    grouped = df.groupBy(name.alias("k")).agg(F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), F.struct(*fields).alias("row")))).alias("rows"))
    rows = grouped.select("k", F.transform("rows", lambda x: x.row).alias("rows"))
    data = rows.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "rows")))).alias("data"), F.sum(F.size("rows")).alias("total"), F.count("*").alias("groups"))
    more = [F.lit(v).alias(k) for k, v in (extra or {}).items() if k not in ("total", "groups")]
    kept = [F.col(k) if k not in (extra or {}) else F.lit(extra[k]).alias(k) for k in ("total", "groups")]
    return data.select(F.to_json(F.struct(*kept, *more)).alias("metadata"), F.to_json("data").alias("data"))


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the folder that executors share and read back: long plans end here, and lost executors cost nothing."""
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tessaria-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def differences(fresh: DataFrame, committed: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """(columns, side): rows that only one of two tables has, as often as it has more of them; none means up to date.

    Both tables are read once: equal rows meet and cancel out.
    """
    cols = [c for c in fresh.columns if c not in ignore]
    both = fresh.select(*cols, F.lit(1).alias("n")).unionByName(committed.select(*cols, F.lit(-1).alias("n")))
    left = both.groupBy(*cols).agg(F.sum("n").alias("n")).filter("n != 0")
    return left.select(*cols, F.when(F.col("n") > 0, "fresh").otherwise("committed").alias("side"), F.explode(F.array_repeat(F.lit(1), F.abs("n").cast("int"))).alias("one")).drop("one")


def missing_files(present: DataFrame, expected: list[str]) -> DataFrame:
    """Names that a bundle must have and lacks."""
    names = present.sparkSession.createDataFrame([(n,) for n in expected], "name string")
    return names.join(present.select("name"), "name", "left_anti")


def fingerprint(df: DataFrame, columns: list[str], order: str) -> DataFrame:
    """One row: twelve hex digits of the SHA-1 of the SHA-1 of every ``BLOCK`` rows in order, each of their rows' SHA-1.

    A task holds the hashes of one block, or one hash for each block.
    """
    from tessaria.operators.standardize import numbered

    row = F.sha1(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))
    hashes = numbered(df.select(F.col(order).alias("o"), row.alias("h")), "o", "h")
    joined = lambda at: F.sha1(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at, "h"))), lambda x: x.h), ""))
    blocks = hashes.groupBy(F.floor(F.col("seq") / BLOCK).alias("block")).agg(joined("seq").alias("h"))
    return blocks.agg(F.substring(joined("block"), 1, 12).alias("fingerprint"))


def archive(path: str, members: dict[str, bytes]) -> None:
    """A zip that is the same, bit for bit, for the same members: sorted, with a fixed time."""
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name in sorted(members):
            info = zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0))
            info.compress_type = zipfile.ZIP_DEFLATED
            z.writestr(info, members[name])


def dump(value) -> str:
    """Descriptors as they are published: indented, readable, with a last line end."""
    return json.dumps(value, ensure_ascii=False, indent=2) + "\n"
