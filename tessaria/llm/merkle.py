"""A Merkle manifest of a dataset: a tree of digests for each group of rows, and one over the groups.

Leaves of a group are numbered by a range sort. Parents are then made by combining children as they
come: a partial parent holds the indexed digests it has, and once it has as many as the size of its
group says, it is emitted, which is an event for its own parent. Each task first combines the run of
nodes it reads; only what it can't complete, the frontier at the two ends of its run, is shuffled by
block and combined there. A round goes up ``SPAN`` levels, so no block has more than ``arity ** SPAN``
nodes, however large a group is.

Each completed parent leaves reverse links: every child with the digests that stand before and after
it. Proofs go down the same blocks from the root, and each leaf gets its siblings level by level.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessaria.llm.common import stored, table

#: Children of a parent, and levels of a round: blocks of 256 nodes.
ARITY, SPAN = 2, 8
#: Offsets of runs are broadcast up to so many rows, and joined by a shuffle beyond.
BROADCAST_RUNS = 200_000
#: What a leaf of ``documents`` is made of, in this order.
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
#: One id in so many is tampered with in the query.
TAMPERED = 7


def leaf_digest(*values: Column) -> Column:
    """SHA-256, in hex, of the values one after another: ``-`` for null, else byte count, colon, value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def fold(digest: Column, before: Column, after: Column) -> Column:
    """The root that a leaf's digest leads to by its proof: arrays of the digests before and after it, from leaf to root."""
    return F.aggregate(F.arrays_zip(before.alias("b"), after.alias("a")), digest, lambda d, s: F.sha2(F.concat(s["b"], d, s["a"]), 256))


def proof_digest(before: Column, after: Column) -> Column:
    """SHA-256, in hex, of a proof's digests level by level, left to right."""
    return F.sha2(F.array_join(F.zip_with(before, after, lambda b, a: F.concat(b, a)), ""), 256)


class Partials:
    """Partial parents of any groups: children come in any order, and complete parents rise up to level ``limit``.

    ``rows`` gets a row for each child of a completed parent, with what stands before and after it,
    and one without that for each node that has risen as far as it can; ``rest`` gives the frontier.
    """

    def __init__(self, arity: int, limit: int):
        self.arity, self.limit, self.rows = arity, limit, []
        self.open: dict[tuple, dict[int, tuple]] = defaultdict(dict)

    def add(self, group, size: int, level: int, at: int, digest: str, carried: tuple) -> None:
        while True:
            # a level has so many nodes as the sizes of its group and of a parent leave
            nodes = -(-size // self.arity**level)
            if level == self.limit or nodes == 1:
                self.rows.append((group, size, level, at, digest, None, None, *carried))
                return
            parent = at // self.arity
            key = group, size, level, parent
            children = self.open[key]
            children[at] = (digest, carried)
            if len(children) < min(self.arity, nodes - parent * self.arity):
                return
            del self.open[key]
            run = [(i, *children[i]) for i in sorted(children)]
            digests = [d for _, d, _ in run]
            self.rows += [(group, size, level, i, d, "".join(digests[:k]), "".join(digests[k + 1 :]), *c) for k, (i, d, c) in enumerate(run)]
            level, at, digest, carried = level + 1, parent, hashlib.sha256("".join(digests).encode()).hexdigest(), (None,) * len(carried)

    def rest(self) -> list[tuple]:
        return [(g, size, level, i, d, None, None, *c) for (g, size, level, _), children in self.open.items() for i, (d, c) in children.items()]

    def taken(self) -> list[tuple]:
        out, self.rows = self.rows, []
        return out


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _rows(batches: Iterable[pa.RecordBatch], schema: pa.Schema) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(f.name).to_pylist() for f in schema if f.name not in ("before", "after")), strict=True)


def _combiner(arity: int, limit: int, schema: pa.Schema) -> Callable:
    """What a task does with the nodes it reads, and with those of a block: parents as far as it can, then the frontier."""

    def combine(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partials = Partials(arity, limit)
        for b in batches:
            for group, size, level, at, digest, *carried in _rows([b], schema):
                partials.add(group, size, level, at, digest, tuple(carried))
            yield _arrow(partials.taken(), schema)
        yield _arrow(partials.rest(), schema)

    return combine


def _whole(combine: Callable, schema: pa.Schema) -> Callable:
    """``combine`` for the rows of a block."""

    def run(rows: pa.Table) -> pa.Table:
        return pa.Table.from_batches(combine(rows.select(schema.names).cast(schema).to_batches()), schema=schema)

    return run


def _schemas(leaves: DataFrame, carry: list[str]) -> tuple[T.StructType, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = {f.name: f.dataType for f in leaves.schema}
    out = T.StructType().add("g", kinds["g"]).add("size", "long").add("level", "integer").add("at", "long").add("digest", "string").add("before", "string").add("after", "string")
    for c in carry:
        out.add(c, kinds[c])
    return out, to_arrow_schema(out)


def numbered_leaves(leaves: DataFrame, order: list[Column]) -> DataFrame:
    """``leaves`` with ``at`` (from 0 in the order given within each ``g``) and ``size`` (leaves of that ``g``).

    One range sort; runs of a group in a partition then need an offset each, which are as many as
    partitions and groups together.
    """
    keys = [F.col("g").asc_nulls_first(), *order]
    # of rows that are equal in all of these either may come first
    dealt = leaves.withColumn("tie", F.monotonically_increasing_id())
    placed = dealt.repartitionByRange(*keys, "tie").sortWithinPartitions(*keys, "tie").drop("tie").withColumn("place", F.monotonically_increasing_id())
    placed = stored(placed, "leaves")
    part = F.shiftright("place", 33)
    runs = placed.groupBy("g", part.alias("part")).agg(F.min("place").alias("first"), F.count("*").alias("n"))
    group = W.partitionBy("g")
    before = F.coalesce(F.sum("n").over(group.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    runs = stored(runs.select(F.col("g").alias("r_g"), F.col("part").alias("r_part"), (F.col("first") - before).alias("zero"), F.sum("n").over(group).alias("size")), "runs")
    runs = F.broadcast(runs) if runs.count() <= BROADCAST_RUNS else runs
    return placed.join(runs, F.col("g").eqNullSafe(F.col("r_g")) & (part == F.col("r_part"))).withColumn("at", F.col("place") - F.col("zero")).drop("r_g", "r_part", "zero", "place")


def grow(leaves: DataFrame, carry: list[str], arity: int = ARITY) -> tuple[list[DataFrame], DataFrame, int]:
    """The trees over numbered ``leaves`` (g, size, at, digest and the columns ``carry``): reverse links by round,
    the roots, and the levels below the highest root. Links of a leaf keep its ``carry`` columns.
    """
    kind, schema = _schemas(leaves, carry)
    most = leaves.agg(F.max("size")).first()[0] or 0
    height = next(h for h in range(64) if arity**h >= most)
    nodes = leaves.select("g", "size", F.lit(0).alias("level"), "at", "digest", F.lit(None).cast("string").alias("before"), F.lit(None).cast("string").alias("after"), *carry)
    links, roots = [], []
    for limit in range(SPAN, max(height, 1) + SPAN, SPAN):
        combine = _combiner(arity, limit, schema)
        own = stored(nodes.mapInArrow(combine, kind), "own")
        risen = (F.col("level") == limit) | (F.pow(F.lit(float(arity)), F.col("level")) >= F.col("size"))
        block = F.floor(F.col("at") / F.pow(F.lit(float(arity)), limit - F.col("level"))).cast("long")
        frontier = own.filter(F.col("before").isNull() & ~risen)

        late = stored(frontier.withColumn("block", block).groupBy("g", "block").applyInArrow(_whole(combine, schema), kind), "met")
        both = own.filter(F.col("before").isNotNull() | risen).unionByName(late)
        links.append(both.filter(F.col("before").isNotNull()))
        over = both.filter(F.col("before").isNull())
        done = F.pow(F.lit(float(arity)), F.col("level")) >= F.col("size")
        roots.append(over.filter(done))
        nodes = over.filter(~done)
    out = roots[0]
    for r in roots[1:]:
        out = out.unionByName(r)
    return links, out, height


def _descent(arity: int, low: int, schema: pa.Schema, own: list[str]) -> Callable:
    """What a block does with its links and the path of its root: the paths of its nodes at level ``low``."""
    names = schema.names
    level, at, before, after = (names.index(c) for c in ("level", "at", "before", "after"))
    shared = [names.index(c) for c in own]

    def run(rows: pa.Table) -> pa.Table:
        known, steps, out = {}, [], []
        for *r, is_step in zip(*(rows.column(c).to_pylist() for c in (*names, "step")), strict=True):
            if is_step:
                steps.append(r)
            else:
                known[r[level], r[at]] = r[before], r[after], [r[i] for i in shared]
        for r in sorted(steps, key=lambda r: -r[level]):
            b, a, rest = known[r[level] + 1, r[at] // arity]
            r[before], r[after] = r[before] + b, r[after] + a
            known[r[level], r[at]] = r[before], r[after], rest
            if r[level] == low:
                for i, v in zip(shared, rest, strict=True):
                    r[i] = v
                out.append(tuple(r))
        return pa.Table.from_batches([_arrow(out, schema)], schema=schema)

    return run


def prove(links: list[DataFrame], tops: DataFrame, carry: list[str], arity: int = ARITY) -> DataFrame:
    """Leaves with their proofs, by the links of ``grow``: (g, digest, before, after, the columns ``carry`` and those of ``tops``).

    ``tops`` has the roots of the trees: (g, level, at, digest, before, after as arrays, ``carry``)
    and further columns, which every leaf of the tree gets.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = tops.schema
    schema = to_arrow_schema(kind)
    own = [c for c in tops.columns if c not in ("g", "level", "at", "digest", "before", "after", *carry)]
    paths = tops
    for k in reversed(range(len(links))):
        low, limit = k * SPAN, (k + 1) * SPAN
        block = F.floor(F.col("at") / F.pow(F.lit(float(arity)), limit - F.col("level"))).cast("long")
        steps = links[k].select("g", "level", "at", "digest", F.array("before").alias("before"), F.array("after").alias("after"), *carry, *[F.lit(None).cast(kind[c].dataType).alias(c) for c in own], F.lit(True).alias("step"))
        above = paths.filter(F.col("level") > low).withColumn("step", F.lit(False))

        both = steps.unionByName(above).withColumn("block", block)
        found = both.groupBy("g", "block").applyInArrow(_descent(arity, low, schema, own), kind)
        paths = paths.filter(F.col("level") <= low).unionByName(found if k == 0 else stored(found, "paths"))
    return paths.drop("level", "at")


def manifest(df: DataFrame, fields: list[str], group_col: str, id_col: str, arity: int = ARITY, **carried: Column) -> DataFrame:
    """A row for each row of ``df``: doc_id, group, leaf, before and after (its proof, from leaf to root), subroot, root, and ``carried``.

    A leaf is ``leaf_digest`` of ``fields``. Leaves of a group ascend by id (null first; repeated ids
    by digest; rows that are equal in all fields are interchangeable); every ``arity`` consecutive
    nodes make the next level, its last parent of what is left, even one. Roots of the groups, ordered
    by group (null first, by bytes), make the last tree alike. A group of one row has its leaf as
    root. Texts of any length count whole; null and empty differ. An empty table has no rows.
    Other columns of ``df`` may have any names: none is kept but those ``carried``.
    """
    carry = ["i", *[f"c{k}" for k in range(len(carried))]]
    of = [F.col("`" + c.replace("`", "``") + "`") for c in (*fields, group_col, id_col)]
    leaves = df.select(of[-2].alias("g"), of[-1].alias("i"), leaf_digest(*of[:-2]).alias("digest"), *[v.alias(c) for c, v in zip(carry[1:], carried.values(), strict=True)])
    leaves = numbered_leaves(leaves, [F.col("i").asc_nulls_first(), F.col("digest")])
    links, roots, _ = grow(leaves, carry, arity)
    # the tree over the groups: its leaves are the groups' roots, which carry what they need below
    names = [c for c in roots.columns if c not in ("before", "after", "g")]
    upper = roots.select(F.lit(0).alias("g"), F.col("g").alias("key"), "digest", F.struct(*names).alias("below"))
    upper = numbered_leaves(upper, [F.col("key").asc_nulls_first()])
    up = ["key", "b_size", "b_level", "b_at", *carry]
    upper = stored(upper.select("g", "size", "at", "digest", "key", *[F.col("below")[c].alias(f"b_{c}") for c in ("size", "level", "at")], *[F.col("below")[c].alias(c) for c in carry]), "roots")
    up_links, root, _ = grow(upper, up, arity)
    none = F.array().cast("array<string>")
    root = root.select("g", "level", "at", "digest", none.alias("before"), none.alias("after"), *up, F.col("digest").alias("root"))
    proved = prove(up_links, root, up, arity)
    tops = proved.select(F.col("key").alias("g"), F.col("b_level").alias("level"), F.col("b_at").alias("at"), "digest", "before", "after", *carry, F.col("digest").alias("subroot"), "root")
    out = prove(links, stored(tops, "tops"), carry, arity)
    return out.select(F.col("i").alias("doc_id"), F.col("g").alias("group"), F.col("digest").alias("leaf"), "before", "after", "subroot", "root", *[F.col(c).alias(n) for c, n in zip(carry[1:], carried, strict=True)])


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, proofs and roots of ``documents`` by language, and what the proofs say of rows that were tampered with."""
    return tampered(table(spark, sf_dir, "documents"))


def tampered(docs: DataFrame) -> DataFrame:
    """The query's columns: where ``TAMPERED`` divides the id's checksum, one is added to n_chars before folding.

    Null n_chars stay null, and rows with a null id are left as they are: both verify.
    """
    forged = leaf_digest(*[F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS])
    hit = F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0
    rows = manifest(docs, FIELDS, "lang", "doc_id", forged=F.when(hit, forged))
    rows = rows.withColumn("folded_root", fold(F.coalesce("forged", "leaf"), F.col("before"), F.col("after")))
    return rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("before"), F.col("after")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql_leaf(n_chars: str) -> str:
    parts = [n_chars if c == "n_chars" else c for c in FIELDS]
    return "sha256(" + " || ".join(f"CASE WHEN {p} IS NULL THEN '-' ELSE strlen(CAST({p} AS VARCHAR)) || ':' || CAST({p} AS VARCHAR) END" for p in parts) + ")"


SQL = f"""
WITH RECURSIVE bits AS (
  SELECT range AS b, range AS c, 0 AS k FROM range(256)
  UNION ALL SELECT b, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8
), crc AS (
  SELECT doc_id AS crc_id, CAST(doc_id AS VARCHAR) AS s, 4294967295 AS c, 1 AS k FROM documents
  UNION ALL
  SELECT crc_id, s, xor(crc.c // 256, t.c), crc.k + 1
  FROM crc JOIN bits t ON t.k = 8 AND t.b = xor(crc.c, ascii(substr(s, crc.k, 1))) % 256
  WHERE crc.k <= length(s)
), leaf AS (
  SELECT d.doc_id, d.lang, row_number() OVER (PARTITION BY d.lang ORDER BY d.doc_id) - 1 AS pos, count(*) OVER (PARTITION BY d.lang) AS n,
         {_sql_leaf("n_chars")} AS leaf, CASE WHEN xor(crc.c, 4294967295) % {TAMPERED} = 0 THEN {_sql_leaf("n_chars + 1")} END AS forged
  FROM documents d JOIN crc ON crc.crc_id = d.doc_id AND crc.k = length(crc.s) + 1
), node AS (
  SELECT 0 AS level, lang, pos, n, leaf AS digest FROM leaf
  UNION ALL
  SELECT level + 1, lang, pos // {ARITY}, (n + {ARITY - 1}) // {ARITY}, sha256(string_agg(digest, '' ORDER BY pos)) FROM node WHERE n > 1
  GROUP BY level + 1, lang, pos // {ARITY}, (n + {ARITY - 1}) // {ARITY}
), sub AS (
  SELECT lang, digest, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM node WHERE n = 1
), upper_node AS (
  SELECT 0 AS level, pos, n, digest FROM sub
  UNION ALL
  SELECT level + 1, pos // {ARITY}, (n + {ARITY - 1}) // {ARITY}, sha256(string_agg(digest, '' ORDER BY pos)) FROM upper_node WHERE n > 1
  GROUP BY level + 1, pos // {ARITY}, (n + {ARITY - 1}) // {ARITY}
), step AS (
  SELECT l.doc_id, v.level AS k,
         string_agg(CASE WHEN s.pos < v.pos THEN s.digest ELSE '' END, '' ORDER BY s.pos) AS b, string_agg(CASE WHEN s.pos > v.pos THEN s.digest ELSE '' END, '' ORDER BY s.pos) AS a
  FROM leaf l
  JOIN node v ON v.lang IS NOT DISTINCT FROM l.lang AND v.pos = l.pos // CAST(pow({ARITY}, v.level) AS BIGINT) AND v.n > 1
  JOIN node s ON s.lang IS NOT DISTINCT FROM v.lang AND s.level = v.level AND s.pos // {ARITY} = v.pos // {ARITY}
  GROUP BY l.doc_id, v.level
  UNION ALL
  SELECT l.doc_id, sub.height + v.level,
         string_agg(CASE WHEN s.pos < v.pos THEN s.digest ELSE '' END, '' ORDER BY s.pos), string_agg(CASE WHEN s.pos > v.pos THEN s.digest ELSE '' END, '' ORDER BY s.pos)
  FROM leaf l JOIN sub ON sub.lang IS NOT DISTINCT FROM l.lang
  JOIN upper_node v ON v.pos = sub.pos // CAST(pow({ARITY}, v.level) AS BIGINT) AND v.n > 1
  JOIN upper_node s ON s.level = v.level AND s.pos // {ARITY} = v.pos // {ARITY}
  GROUP BY l.doc_id, sub.height + v.level
), folded AS (
  SELECT doc_id, 0 AS k, coalesce(forged, leaf) AS digest FROM leaf
  UNION ALL
  SELECT f.doc_id, f.k + 1, sha256(s.b || f.digest || s.a) FROM folded f JOIN step s ON s.doc_id = f.doc_id AND s.k = f.k
), proof AS (SELECT doc_id, sha256(string_agg(b || a, '' ORDER BY k)) AS p, max(k) + 1 AS steps FROM step GROUP BY doc_id),
root AS (SELECT digest FROM upper_node WHERE n = 1)
SELECT l.doc_id, l.leaf, sub.digest AS subroot, root.digest AS root, coalesce(proof.p, sha256('')) AS proof_sha256, f.digest AS folded_root, f.digest = root.digest AS verified
FROM leaf l JOIN sub ON sub.lang IS NOT DISTINCT FROM l.lang CROSS JOIN root
LEFT JOIN proof ON proof.doc_id = l.doc_id JOIN folded f ON f.doc_id = l.doc_id AND f.k = coalesce(proof.steps, 0)
"""
