"""Ordered CSV exports in parts, written by all executors and published at once.

``write`` sorts by ranges; every task writes the part of its range below the run's own folder. Only
when all are there is the manifest put in place, which names the run's parts in order: readers see
the old export or the new one, and parts of tasks that were repeated or lost belong to neither. The
first part is the header with the byte order mark, so that the parts one after another are the
file that a single writer would have made, byte for byte.
"""

from __future__ import annotations

import csv
import hashlib
import io
import json
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

MARK = "﻿"
MANIFEST = "_manifest.json"
#: Digests that one digest of the next level is made of.
FAN_IN = 64


def place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    return fs.FileSystem.from_uri(path) if urlparse(path).scheme else (fs.LocalFileSystem(), path)


def digest_tree(digests: list[str], fan_in: int = FAN_IN) -> str:
    """One digest of many: each ``fan_in`` consecutive ones become the SHA-256 of their texts, until one is left."""
    level = digests or [hashlib.sha256().hexdigest()]
    while len(level) > 1:
        level = [hashlib.sha256("".join(level[i : i + fan_in]).encode()).hexdigest() for i in range(0, len(level), fan_in)]
    return level[0]


def cell(value) -> str:
    """A value as the export has it: null and not-a-number are empty."""
    return "" if value is None or isinstance(value, float) and math.isnan(value) else str(value)


def lines(columns: list[list]) -> bytes:
    """Rows, given by column, as CSV in UTF-8: quoted where needed, ``\\n`` at the ends."""
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerows([cell(v) for v in row] for row in zip(*columns, strict=True))
    return out.getvalue().encode("utf-8", "surrogatepass")


@dataclass
class Part(WriterCommitMessage):
    """What a task wrote: its place in the order, the file's name, its rows, bytes and SHA-256."""

    number: int
    name: str
    rows: int
    bytes: int
    sha256: str


class _PartsWriter(DataSourceArrowWriter):
    def __init__(self, path: str, names: list[str], mark: bool):
        self.path, self.names, self.mark, self.run = path.rstrip("/"), names, mark, f"run-{uuid.uuid4().hex}"

    def _put(self, name: str, pieces: Iterator[bytes]) -> tuple[int, str]:
        system, root = place(f"{self.path}/{self.run}")
        system.create_dir(root)
        size, digest = 0, hashlib.sha256()
        with system.open_output_stream(f"{root}/{name}") as out:
            for piece in pieces:
                out.write(piece)
                size += len(piece)
                digest.update(piece)
        return size, digest.hexdigest()

    def write(self, batches: Iterator[pa.RecordBatch]) -> Part:
        rows, number = 0, TaskContext.get().partitionId()

        def pieces() -> Iterator[bytes]:
            nonlocal rows
            for b in batches:
                rows += b.num_rows
                yield lines([b.column(i).to_pylist() for i in range(b.num_columns)])

        name = f"part-{number + 1:06d}-{uuid.uuid4().hex}.csv"  # a repeated task has a file of its own
        size, digest = self._put(name, pieces())
        return Part(number, name, rows, size, digest)

    def commit(self, messages: list[Part | None]) -> None:
        parts = sorted((m for m in messages if m is not None), key=lambda m: m.number)
        head = (MARK if self.mark else "").encode() + lines([[n] for n in self.names])
        size, digest = self._put("part-000000.csv", iter([head]))
        listed = [{"name": "part-000000.csv", "rows": 0, "bytes": size, "sha256": digest}] + [{"name": p.name, "rows": p.rows, "bytes": p.bytes, "sha256": p.sha256} for p in parts if p.rows]
        manifest = {"run": self.run, "columns": self.names, "rows": sum(p["rows"] for p in listed), "bytes": sum(p["bytes"] for p in listed), "digest": digest_tree([p["sha256"] for p in listed]), "parts": listed}
        system, root = place(self.path)
        with system.open_output_stream(f"{root}/{self.run}/{MANIFEST}") as out:
            out.write(json.dumps(manifest, ensure_ascii=False, indent=2).encode())
        system.move(f"{root}/{self.run}/{MANIFEST}", f"{root}/{MANIFEST}")
        for old in system.get_file_info(fs.FileSelector(root)):
            if old.type == fs.FileType.Directory and old.base_name.startswith("run-") and old.base_name != self.run:
                system.delete_dir(old.path)

    def abort(self, messages: list[Part | None]) -> None:
        system, root = place(f"{self.path}/{self.run}")
        if system.get_file_info(root).type == fs.FileType.Directory:
            system.delete_dir(root)


class OrderedCsv(DataSource):
    """The format ``ordered_csv``: options ``path`` and ``mark`` (whether the byte order mark is written)."""

    @classmethod
    def name(cls) -> str:
        return "ordered_csv"

    def writer(self, schema: T.StructType, overwrite: bool) -> _PartsWriter:
        if not overwrite:
            raise ValueError("an export replaces the one before: use mode overwrite")
        return _PartsWriter(self.options["path"], schema.fieldNames(), self.options.get("mark", "true") == "true")


def write(df: DataFrame, path: str, *order: str, blank_first: bool = True, mark: bool = True, parts: int | None = None) -> dict:
    """Writes ``df`` as an ordered export below ``path`` and returns its manifest.

    Rows are sorted by ``order`` (with ``blank_first`` null as the empty text), and those equal in
    it by all their columns, so the same rows always make the same bytes. Without ``order`` rows stay
    in the partitions they are in. ``parts`` is how many ranges are written, else Spark joins small
    ones. Columns are atomic; the table may be empty.
    """
    df.sparkSession.dataSource.register(OrderedCsv)
    if order:
        kinds = dict(df.dtypes)
        keys = [F.coalesce(F.col(c), F.lit("")) if blank_first and kinds[c] == "string" else F.col(c).asc_nulls_first() for c in order]
        rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in order]
        df = df.repartitionByRange(*([parts] if parts else []), *keys, *rest).sortWithinPartitions(*keys, *rest)
    df.write.format("ordered_csv").mode("overwrite").option("mark", str(mark).lower()).save(path)
    return manifest(path)


def manifest(path: str) -> dict:
    system, root = place(path.rstrip("/"))
    with system.open_input_stream(f"{root}/{MANIFEST}") as f:
        return json.loads(f.read())


def chunks(path: str, size: int = 1 << 20) -> Iterator[bytes]:
    """The export's bytes in order, a bounded piece at a time."""
    system, root = place(path.rstrip("/"))
    found = manifest(path)
    for part in found["parts"]:
        with system.open_input_stream(f"{root}/{found['run']}/{part['name']}") as f:
            while piece := f.read(size):
                yield piece


def damaged(path: str) -> list[str]:
    """Names of the export's parts that are missing or whose bytes are not those that were written."""
    system, root = place(path.rstrip("/"))
    found, bad = manifest(path), []
    for part in found["parts"]:
        digest = hashlib.sha256()
        try:
            with system.open_input_stream(f"{root}/{found['run']}/{part['name']}") as f:
                while piece := f.read(1 << 20):
                    digest.update(piece)
        except OSError:
            bad.append(part["name"])
            continue
        if digest.hexdigest() != part["sha256"]:
            bad.append(part["name"])
    return bad if bad or digest_tree([p["sha256"] for p in found["parts"]]) == found["digest"] else [MANIFEST]
