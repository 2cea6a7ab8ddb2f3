"""Derived tables that are made again only when what they are made from has changed.

A derivation is a graph: each table names its inputs, which are sources or other tables. Beside every
table stands its state: the digests of the inputs it was made from, and its own. A table whose inputs
have the digests of its state is left alone; one that was made again but came out the same leaves
those below it alone too. A check reads each table once and compares digests.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessaria.sources.export import digest_tree, place

#: Buckets that a table's rows are digested in, hexadecimal digits that are summed at a time, and such sums of a digest.
BUCKETS, DIGITS, LANES = 64, 15, 4
STATE = "_state"


def bucket_digests(df: DataFrame) -> DataFrame:
    """(bucket, n, lane0 to lane3) of a table's rows in any order: sums of the pieces of their SHA-256, rows that repeat count.

    The sums combine before they are shuffled, so that a row for each task and bucket is.
    """
    row = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]), {"ignoreNullFields": "false"}), 256)
    lanes = [F.conv(F.substring("h", 1 + i * DIGITS, DIGITS), 16, 10).cast("decimal(20,0)") for i in range(LANES)]
    return df.select(row.alias("h")).groupBy(F.pmod(F.xxhash64("h"), F.lit(BUCKETS)).alias("bucket")).agg(F.count("*").alias("n"), *[F.sum(x).cast("decimal(38,0)").alias(f"lane{i}") for i, x in enumerate(lanes)])


def digest(df: DataFrame) -> str:
    """One digest of a table: of its columns' names and types, and of its rows as a multiset."""
    head = json.dumps(sorted(df.dtypes), ensure_ascii=False)
    rows = {r["bucket"]: json.dumps([str(v) for v in r]) for r in bucket_digests(df).collect()}  # BUCKETS rows at most
    return digest_tree([head, *[rows.get(b, "") for b in range(BUCKETS)]], BUCKETS)


def differing_buckets(a: DataFrame, b: DataFrame) -> list[int]:
    """The buckets in which two tables' rows differ: none if they are the same."""
    both = bucket_digests(a).unionByName(bucket_digests(b)).groupBy("bucket", "n", *[f"lane{i}" for i in range(LANES)]).count()
    return sorted({r["bucket"] for r in both.filter("count != 2").select("bucket").collect()})


@dataclass(frozen=True)
class Table:
    """A derived table: its name, the names of its inputs, what makes it of them, and the columns that sort it."""

    name: str
    inputs: tuple[str, ...]
    make: Callable[..., DataFrame]
    order: tuple[str, ...] = ()


class Derivation:
    """Tables below ``out``, in an order in which each stands after its inputs, over ``sources`` by name.

    ``version`` is what the tables' definitions are called: tables of another version are made again.
    """

    def __init__(self, spark: SparkSession, tables: list[Table], sources: Mapping[str, Callable[[], DataFrame]], out: str, version: str = ""):
        self.spark, self.tables, self.sources, self.out, self.version = spark, tables, sources, out.rstrip("/"), version
        known = set(sources)
        for t in tables:
            if missing := set(t.inputs) - known:
                raise ValueError(f"{t.name} stands before its inputs {sorted(missing)}")
            if t.name in known:
                raise ValueError(f"{t.name} is defined twice")
            known.add(t.name)
        self._digests: dict[str, str] = {}

    def state(self, name: str) -> dict:
        """What is known of a table; nothing if it was never made or its making was not ended."""
        system, root = place(f"{self.out}/{STATE}/{name}.json")
        if system.get_file_info(root).type != fs.FileType.File:
            return {}
        with system.open_input_stream(root) as f:
            return json.loads(f.read())

    def _keep(self, name: str, state: dict | None) -> None:
        system, root = place(f"{self.out}/{STATE}")
        system.create_dir(root)
        path = f"{root}/{name}.json"
        if state is None:
            if system.get_file_info(path).type == fs.FileType.File:
                system.delete_file(path)
            return
        with system.open_output_stream(f"{path}.new") as f:
            f.write(json.dumps(state, ensure_ascii=False, indent=2).encode())
        system.move(f"{path}.new", path)

    def read(self, name: str) -> DataFrame:
        return self.sources[name]() if name in self.sources else self.spark.read.parquet(f"{self.out}/{name}")

    def known_digest(self, name: str) -> str:
        """A source's digest as it is now, a table's as it was made."""
        if name not in self.sources:
            return self.state(name).get("digest", "")
        if name not in self._digests:
            self._digests[name] = digest(self.read(name))
        return self._digests[name]

    def _expected(self, table: Table) -> dict:
        return {"version": self.version, "inputs": {i: self.known_digest(i) for i in table.inputs}}

    def _current(self, table: Table) -> bool:
        found, wanted = self.state(table.name), self._expected(table)
        return bool(found) and {k: found.get(k) for k in wanted} == wanted

    def _intact(self, table: Table) -> bool:
        """Whether a table is there and has the digest it was made with."""
        try:
            return digest(self.read(table.name)) == self.state(table.name).get("digest")
        except AnalysisException:
            return False

    def update(self, verify: bool = False) -> list[str]:
        """Makes what has to be made, and returns its names; with ``verify`` also what is damaged or gone."""
        self._digests.clear()
        made = []
        for t in self.tables:
            if self._current(t) and (not verify or self._intact(t)):
                continue
            self._keep(t.name, None)  # whatever happens from here on, the table is not current
            df = t.make(*[self.read(i) for i in t.inputs])
            (df.orderBy(*t.order) if t.order else df).write.mode("overwrite").parquet(f"{self.out}/{t.name}")
            self._keep(t.name, self._expected(t) | {"digest": digest(self.read(t.name))})
            made.append(t.name)
        return made

    def stale(self) -> list[str]:
        """Names of the tables that have to be made again: those not made from their inputs as they are, all below these, and those damaged or gone."""
        self._digests.clear()
        changed, bad = set(), []
        for t in self.tables:
            if changed & set(t.inputs) or not self._current(t):
                changed.add(t.name)
                bad.append(t.name)
            elif not self._intact(t):
                bad.append(t.name)
        return bad

    def lineage(self) -> DataFrame:
        """(table, input, digest) of what each table was made from, as its state has it."""
        rows = [(t.name, i, d) for t in self.tables for i, d in self.state(t.name).get("inputs", {}).items()]
        return self.spark.createDataFrame(rows, "table string, input string, digest string")
