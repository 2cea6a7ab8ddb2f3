"""Media columns: content-addressed payloads in tar shards.

A payload becomes a grey 8-bit PNG, whose samples are its bytes. Every task writes the media of
its rows into tar shards in the shared folder, each content once a shard, named by its digest;
rows carry digest, shard, offset and length. Of equal payloads in several shards all rows point
to the first: only rows whose own shard does not hold that one are joined, by digest and shard, so
the copies of one content are never gathered in a task. Metadata columns come from range reads of a medium's header alone; features come
from the stored bytes, decoded and checked against the digest.

A shard is written under a temporary name and renamed when complete; a task that is run again
writes shards of its own, and rows only ever name the shards of the attempt that counted.
"""

from __future__ import annotations

import hashlib
import io
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessaria.llm.common import no_clash, shared_dir, stored, table, text_of

BLOCK = 64
#: A new shard begins beyond this many bytes.
SHARD_BYTES = 256 << 20
#: Bytes of a PNG up to the end of its header chunk.
HEADER = 33
#: Contents that lie in further shards: so many may be broadcast; with more that is a join.
BROADCAST_ROWS = 200_000
SIGNATURE = b"\x89PNG\r\n\x1a\n"
LEVEL = 3


def payload(raw: bytes) -> bytes:
    """Zero bytes are appended up to a positive multiple of ``BLOCK``."""
    return raw + bytes(-len(raw) % BLOCK if raw else BLOCK)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode(data: bytes) -> bytes:
    """A grey 8-bit PNG of ``BLOCK`` rows whose samples are ``data``; every row unfiltered."""
    width = len(data) // BLOCK
    rows = np.zeros((BLOCK, width + 1), dtype=np.uint8)
    rows[:, 1:] = np.frombuffer(data, dtype=np.uint8).reshape(BLOCK, width)
    head = struct.pack(">IIBBBBB", width, BLOCK, 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), LEVEL)) + _chunk(b"IEND", b"")


def header(first: bytes) -> dict[str, int | str]:
    """What the first ``HEADER`` bytes of a medium say: format, width, height, bits."""
    if first[:8] != SIGNATURE or first[12:16] != b"IHDR":
        raise ValueError("not a PNG")
    width, height, bits = struct.unpack(">IIB", first[16:25])
    return {"format": "png", "width": width, "height": height, "bits": bits}


def decode(medium: bytes) -> bytes:
    """The samples of a medium that ``encode`` made."""
    head, at, packed = header(medium[:HEADER]), 8, b""
    while at < len(medium):
        n, kind = struct.unpack(">I4s", medium[at : at + 8])
        if kind == b"IDAT":
            packed += medium[at + 8 : at + 8 + n]
        at += 12 + n
    rows = np.frombuffer(zlib.decompress(packed), dtype=np.uint8).reshape(head["height"], head["width"] + 1)
    return rows[:, 1:].tobytes()


def features(data: bytes) -> str:
    """Mean, deviation and entropy of the samples, and their largest, as text."""
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    n, values = len(data), np.arange(256)
    mean = int(counts @ values) / n
    share = counts[counts > 0] / n
    return f"mean={mean:.4f};std={max(0.0, int(counts @ values**2) / n - mean * mean) ** 0.5:.4f};entropy={-(share * np.log2(share)).sum():.4f};max={int(np.flatnonzero(counts)[-1])}"


def filesystem(root: str):
    """(file system, path) of a URI; local paths, HDFS and object stores alike."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")


class Shards:
    """Writes media into tar shards below ``root``."""

    def __init__(self, root: str):
        self.fs, self.path = filesystem(root)
        self.sink = self.tar = None
        self.name, self.at, self.places = "", 0, {}

    def add(self, digest: str, full: bytes) -> tuple[str, int, int]:
        """(shard, offset, length) of the payload's medium; a content that the shard has is not written again."""
        if digest in self.places:
            return self.places[digest]
        medium = encode(full)
        if self.tar is None or self.at > SHARD_BYTES:
            self.close()
            self.name = f"shard-{uuid.uuid4().hex}.tar"
            self.sink = self.fs.open_output_stream(f"{self.path}/{self.name}.part")
            self.tar, self.at, self.places = tarfile.open(fileobj=self.sink, mode="w|", format=tarfile.GNU_FORMAT), 0, {}
        info = tarfile.TarInfo(f"{digest}.png")
        info.size = len(medium)
        self.tar.addfile(info, io.BytesIO(medium))
        place = self.places[digest] = (self.name, self.at + tarfile.BLOCKSIZE, len(medium))
        self.at += tarfile.BLOCKSIZE * (1 + -(-len(medium) // tarfile.BLOCKSIZE))
        return place

    def close(self) -> None:
        if self.tar is not None:
            self.tar.close()
            self.sink.close()
            self.fs.move(f"{self.path}/{self.name}.part", f"{self.path}/{self.name}")
            self.tar = None


def store(df: DataFrame, text_col: str = "text", root: str | None = None) -> DataFrame:
    """``df`` without its text, with n_bytes, digest (of the payload), shard, offset and length.

    Null texts are empty; an empty text has a payload of ``BLOCK`` zero bytes. Rows that repeat, and
    all rows with equal texts, name the same place. A very long text is one payload, held in memory
    by the task that writes it. An empty table gives an empty result and no shard. Columns of ``df``
    with one of these names are replaced, others may have any names. ``root`` is a folder that all
    executors share.
    """
    spark = df.sparkSession
    root = root or f"{shared_dir(spark)}/media-{uuid.uuid4().hex}"
    files, path = filesystem(root)
    files.create_dir(path, recursive=True)
    own = ("n_bytes", "digest", "shard", "offset", "length")
    rest = [c for c in df.columns if c != text_col and c not in own]
    raw = no_clash(df, "raw")["raw"]
    rows = df.select(*rest, F.encode(text_of(text_col), "UTF-8").alias(raw))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shards = Shards(root)
        for batch in batches:
            out: dict[str, list] = {k: [] for k in own}
            for data in batch[raw]:
                full = payload(bytes(data))
                digest = hashlib.sha256(full).hexdigest()
                for k, v in zip(own, (len(data), digest, *shards.add(digest, full)), strict=True):
                    out[k].append(v)
            yield batch.drop(columns=[raw]).assign(**out)
        shards.close()

    schema = rows.drop(raw).schema.add("n_bytes", "long").add("digest", "string").add("shard", "string").add("offset", "long").add("length", "long")
    placed = stored(rows.mapInPandas(run, schema), "media-rows").withColumn("shard", F.concat(F.lit(f"{root}/"), F.col("shard")))
    # one row for each content of a shard, however many rows have it
    spots = placed.select(F.col("digest").alias("d"), F.struct("shard", "offset", "length").alias("at")).distinct()
    first = spots.groupBy("d").agg(F.min("at").alias("f"), F.count("*").alias("spots")).filter("spots > 1").select(F.col("d").alias("f_d"), "f")
    moved = stored(spots.join(first, F.col("d") == F.col("f_d")).filter("at != f").select("d", F.col("at.shard").alias("s"), "f"), "moved")
    if moved.count() <= BROADCAST_ROWS:
        moved = F.broadcast(moved)
    whole = placed.select(F.struct(*[c for c in placed.columns if c not in own[2:]]).alias("r"), F.struct(*own[2:]).alias("p"))
    to = whole.join(moved, (F.col("r.digest") == F.col("d")) & (F.col("p.shard") == F.col("s")), "left")
    return to.select("r.*", F.coalesce("f", "p").alias("p")).select(*[c for c in placed.columns if c not in own[2:]], "p.*")


class Reader:
    """Range reads of stored media; one open shard at a time."""

    def __init__(self):
        self.open, self.file = "", None

    def read(self, shard: str, offset: int, length: int) -> bytes:
        if shard != self.open:
            if self.file is not None:
                self.file.close()
            files, path = filesystem(shard)
            self.open, self.file = shard, files.open_input_file(path)
        self.file.seek(offset)
        return self.file.read(length)


def _read(what, fields: str):
    """A pandas UDF over (shard, offset, length, digest) that reads each medium of a batch once, in order of place."""

    def run(shard: pd.Series, offset: pd.Series, length: pd.Series, digest: pd.Series) -> pd.DataFrame:
        places = pd.DataFrame({"shard": shard, "offset": offset, "length": length, "digest": digest})
        reader, got = Reader(), {}
        for p in places.drop_duplicates(["shard", "offset"]).sort_values(["shard", "offset"]).itertuples():
            got[p.shard, p.offset] = what(reader, p)
        return pd.DataFrame([got[k] for k in zip(shard, offset, strict=True)])

    return F.pandas_udf(run, fields)


def _header_of(reader: Reader, p) -> dict:
    return header(reader.read(p.shard, p.offset, HEADER))


def _content_of(reader: Reader, p) -> dict:
    medium = reader.read(p.shard, p.offset, p.length)
    data = decode(medium)
    if hashlib.sha256(data).hexdigest() != p.digest:
        raise OSError(f"{p.shard} at {p.offset} does not hold {p.digest}")
    return {"payload_bytes": len(data), "payload_sha256": hashlib.sha256(data).hexdigest(), "tail_crc32": zlib.crc32(data[-BLOCK:]), "media_bytes": len(medium), "media_sha256": hashlib.sha256(medium).hexdigest(), "features": features(data)}


def _place() -> list[Column]:
    return [F.col("shard"), F.col("offset"), F.col("length"), F.col("digest")]


def with_metadata(rows: DataFrame) -> DataFrame:
    """``rows`` of ``store`` with the struct media_header, read from headers alone."""
    return rows.withColumn("media_header", _read(_header_of, "format string, width long, height long, bits long")(*_place()))


def with_content(rows: DataFrame) -> DataFrame:
    """``rows`` of ``store`` with the struct media_content: sizes, digests and features of what is stored."""
    fields = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, features string"
    return rows.withColumn("media_content", _read(_content_of, fields)(*_place()))


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text as a stored medium, read back."""
    rows = store(table(spark, sf_dir, "documents").select("doc_id", "text"))
    read = with_content(with_metadata(rows))
    c = "media_content"
    feature = F.concat_ws(";", "media_header.format", F.concat_ws("x", "media_header.width", "media_header.height", "media_header.bits"), f"{c}.features")
    return read.select("doc_id", "n_bytes", f"{c}.payload_bytes", f"{c}.payload_sha256", f"{c}.tail_crc32", f"{c}.media_bytes", f"{c}.media_sha256", feature.alias("feature"), "shard", "offset", "length")
