"""SimHash near-dedup with covering locality-sensitive hashing.

A fingerprint bit is 1 if set in over half the hashes of a text's shingles. Every bit
position carries a vector of r + 1 bits; the mask of each non-zero vector v keeps the positions
whose vector has an odd inner product with v. For any r positions in which two fingerprints
differ some v is orthogonal to all their vectors, so that mask drops every difference and the
two collide: 2 ** (r + 1) - 1 tables find every pair within radius r (15 for r = 3, each
keeping more than half of the bits).

Equal fingerprints are first made one. A bucket with more than ``limit`` different fingerprints
is covered again on the bits its mask dropped, in further tables, until no bucket is larger: all
members agree on the kept bits, so once k bits are free there are at most 2 ** k members. No
bucket lists all its pairs either: each yields a spanning forest of its links.

The pipeline's stage needs a similarity of 0.8 of five-word shingles, which is about ten differing
bits and beyond any small radius. Covering tables find the pairs within the radius; what these
leave apart goes on to an exact prefix join, so that no pair is lost.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessaria.llm.common import no_clash, passing, shared_dir, stored, table, text_of
from tessaria.llm.components import components
from tessaria.llm.linking import Likeness, connect, few, parity, shared_keys, shingles

BITS, RADIUS, SEED = 64, 3, 42
#: The largest bucket whose members are compared; larger ones are covered again.
LIMIT = 128
#: In the pipeline's stage: the least similarity of two sets of shingles, and the rule it makes with five words a shingle.
NEAR_SIMILARITY = 0.8
RULE = Likeness(4, 5, 5)
#: Shingles that are put last in the stage's order, the most frequent first to go; any number gives the same result.
LATE = 100_000


def covering_masks(free: int, radius: int) -> list[int]:
    """Masks over the set bits of ``free``: for any ``radius`` of them, some mask keeps none of these.

    Position i of the free bits carries the vector i % (2 ** (radius + 1) - 1) + 1.
    """
    size = 2 ** (radius + 1)
    positions = [p for p in range(BITS) if free >> p & 1]
    masks = []
    for v in range(1, size):
        masks.append(sum(1 << p for i, p in enumerate(positions) if ((i % (size - 1) + 1) & v).bit_count() % 2))
    return list(dict.fromkeys(masks))


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >= 1 << (BITS - 1) else x


def fingerprint(text: str | None, shingle: int = 3, seed: int = SEED) -> int:
    """The fingerprint as an unsigned number; words are what ASCII white space leaves, A-Z lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    h = xxhash.xxh64_intdigest
    return _majority(np.fromiter((h(p, seed) for p in parts), dtype="<u8"))


def _majority(hashes: np.ndarray) -> int:
    """The number of the bits that are set in over half the hashes; long texts are counted in pieces."""
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 15):
        piece = hashes[at : at + (1 << 15)].view("u1").reshape(-1, 8)
        counts += np.unpackbits(piece, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


@F.pandas_udf(T.LongType())
def _fingerprint3(texts: pd.Series) -> pd.Series:
    return pd.Series([_signed(fingerprint(t)) for t in texts], dtype="int64")


def _distances_forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links (index, index) that connect what is within ``radius`` of each other, at most one per member."""
    n = len(values)
    x = values.view(np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= radius
    seen, links = np.zeros(n, dtype=bool), []
    for start in range(n):
        if seen[start]:
            continue
        seen[start], todo = True, [start]
        while todo:
            at = todo.pop()
            new = np.flatnonzero(near[at] & ~seen)
            seen[new] = True
            links += [(start, int(i)) for i in new]
            todo += new.tolist()
    return links


@F.pandas_udf(T.ArrayType(T.StructType().add("a", "long").add("b", "long")))
def _bucket_links(buckets: pd.Series) -> pd.Series:
    out = []
    for b in buckets:
        v = np.unique(np.asarray(b, dtype=np.int64))
        out.append([{"a": int(v[i]), "b": int(v[j])} for i, j in _distances_forest(v, RADIUS)])
    return pd.Series(out, dtype=object)


def radius_links(fps: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Links (a, b) between different values of the column ``fp`` that connect exactly what radius 3 connects.

    The values of ``fps`` are distinct. ``limit`` is at least 2 ** 7: a bucket with 7 free bits is never larger.
    """
    limit = max(limit, LIMIT)
    first = F.array(*[F.lit(_signed(m)) for m in covering_masks((1 << BITS) - 1, RADIUS)])
    rows = fps.select("fp", F.lit(0).cast("bigint").alias("kept"), F.explode(first).alias("mask"))
    out, depth = None, 0
    while True:
        # the bits that all members of a bucket share: those kept by this mask and by the ones before it
        rows = rows.select("fp", (F.col("kept").bitwiseOR(F.col("mask"))).alias("kept"), F.col("fp").bitwiseAND(F.col("kept").bitwiseOR(F.col("mask"))).alias("key"))
        rows = rows.distinct() if depth else rows
        sizes = rows.groupBy("kept", "key").agg(F.count("*").alias("n")).filter("n > 1")
        shared = stored(rows.join(sizes, ["kept", "key"]), f"buckets{depth}")
        small = shared.filter(F.col("n") <= limit).groupBy("kept", "key").agg(F.collect_list("fp").alias("bucket"))
        links = small.select(F.explode(_bucket_links("bucket")).alias("l")).select("l.a", "l.b")
        out = links if out is None else out.unionByName(links)
        large = shared.filter(F.col("n") > limit)
        kept = [r[0] for r in large.select("kept").distinct().collect()]  # masks of this depth, at most 15 ** (depth + 1)
        if not kept:
            return out.distinct()
        again = {k: covering_masks(~k & ((1 << BITS) - 1), RADIUS) for k in kept}
        masks = fps.sparkSession.createDataFrame([(k, [_signed(m) for m in ms]) for k, ms in again.items()], "kept bigint, masks array<bigint>")
        rows = large.join(F.broadcast(masks), "kept").select("fp", "kept", F.explode("masks").alias("mask"))
        depth += 1


def near_groups(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, fingerprint, component_id) for each row: shingles of three words, links at 3 or fewer differing bits.

    component_id is the smallest id reachable. Null and empty texts, and any without a word, have
    fingerprint zero and are linked like any other. Rows that repeat an id are one node with
    several rows. Null ids never name a component unless all of its ids are null.
    """
    shared_dir(df.sparkSession)
    prints = stored(df.select(F.col(id_col).alias("doc_id"), _fingerprint3(text_of(text_col)).alias("fp")), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    distinct = stored(distinct, "distinct")
    roots = stored(components(radius_links(distinct.select("fp")), "a", "b"), "roots")
    named = stored(distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "named")
    # written, like the minima in components: a large component's fingerprints can then be split
    least = stored(named.groupBy("root").agg(F.min("least").alias("component_id")), "minima")
    by_fp = stored(named.join(least, "root").select(F.col("fp").alias("f"), "component_id"), "found")
    return prints.join(by_fp, F.col("fp") == F.col("f")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return near_groups(table(spark, sf_dir, "documents"))


def similarity(a: str | None, b: str | None) -> float:
    """Jaccard similarity of two texts' sets of shingles in the pipeline's stage."""
    both, all_of = RULE.similarity(a, b)
    return both / all_of


def _prefixes(text: Column, late: np.ndarray) -> Column:
    """struct<n,tokens,fp,parity>: the number of a text's different shingles, the first of them in the stage's order,
    the fingerprint of all, and the parity of how many fall into each of ``CELLS`` cells.

    The order is by hash, but for ``late``, which come last and in the order given. Of n shingles an
    alike text has ceil(0.8 n) at least, so the first that both have is among each one's first
    n - ceil(0.8 n) + 1, whatever the order.
    """
    at = np.argsort(late, kind="stable")
    known = late[at]

    def run(texts: pd.Series) -> pd.DataFrame:
        sizes, out, prints, cells = [], [], [], []
        for t in texts:
            own = shingles(t, RULE.words)
            h = np.fromiter(own, dtype="<u8", count=len(own))
            prints.append(_signed(_majority(h)))
            cells.append(parity(h))
            h = np.sort(h.view("<i8"))
            if len(known):
                spot = np.minimum(np.searchsorted(known, h), len(known) - 1)
                h = h[np.argsort(np.where(known[spot] == h, at[spot] + 1, 0), kind="stable")]
            sizes.append(len(h))
            out.append(h[: len(h) + (-len(h) * RULE.share) // RULE.of + 1])
        return pd.DataFrame({"n": pd.Series(sizes, dtype="int32"), "tokens": pd.Series(out, dtype=object), "fp": pd.Series(prints, dtype="int64"), "parity": pd.Series(cells, dtype=object)})

    return F.pandas_udf(run, T.StructType().add("n", "integer").add("tokens", T.ArrayType(T.LongType())).add("fp", "long").add("parity", T.ArrayType(T.LongType())))(text)


def _has_any(tokens: str, wanted: np.ndarray) -> Column:
    """Whether a row's tokens hold any of the wanted ones, of which there is one at least."""
    known = np.sort(wanted)

    def run(tokens: pd.Series) -> pd.Series:
        return pd.Series([bool((known[np.minimum(np.searchsorted(known, t), len(known) - 1)] == t).any()) for t in tokens], dtype=bool)

    return F.pandas_udf(run, T.BooleanType())(tokens)


def near_links(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) that connect the nodes exactly as all pairs alike to 0.8 do.

    ``nodes`` has (node, n, tokens, fp, parity), their prefixes in the order of hashes; ``texts``
    (t_row, t) the text of each node. Nodes that covering tables bring together are compared first.
    For the others, shingles in the prefixes of many nodes are put last in the order, and the shingles
    of prefixes are the keys by which alike texts meet (``linking.connect``).
    """
    prints = nodes.groupBy("fp").agg(F.min("node").alias("first"))
    equal = nodes.join(prints.withColumnRenamed("fp", "p_fp"), F.col("fp") == F.col("p_fp")).filter("node != first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    within = radius_links(prints.select("fp"))
    named = within.join(prints, F.col("a") == F.col("fp")).select(F.col("first").alias("x"), "b").join(prints, F.col("b") == F.col("fp")).select(F.col("x").alias("a"), F.col("first").alias("b"))
    seeds = equal.unionByName(named)
    with passing() as stays:
        prefixes, sizes = nodes.select("node", "n", "tokens"), shared_keys(nodes)
        heavy = stored(sizes.filter(F.col("size") > LIMIT).orderBy(F.desc("size"), "token").limit(LATE), "late")  # LATE rows at most
        order = np.array([r[0] for r in heavy.orderBy("size", F.desc("token")).select("token").toLocalIterator()], dtype=np.int64)
        if len(order):
            # prefixes without any of these are the same in the new order, and aren't written again
            touched = stored(nodes.filter(_has_any("tokens", order)).select("node"), "touched")
            again = texts.join(few(touched), F.col("t_row") == F.col("node"), "left_semi").select(F.col("t_row").alias("node"), _prefixes(F.col("t"), order).alias("p"))
            again = stored(again.select("node", "p.n", "p.tokens"), "again")
            prefixes = nodes.filter(~_has_any("tokens", order)).select("node", "n", "tokens").unionByName(again)
            sizes = shared_keys(prefixes)
        held = stored(prefixes.select("node", "n", F.posexplode("tokens").alias("pos", "token")).join(few(sizes), "token"), "held")
        return stays(stored(connect(held, nodes.select("node", "n", "parity"), texts, RULE, seeds), "links"))


def drop_near_duplicates(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``df`` with one row of each group of near duplicates, the one with the smallest id.

    Rows are linked if their sets of five-word shingles have a similarity of 0.8 or more, and
    every such pair is found, whatever was edited: candidates are the texts whose fingerprints
    covering tables bring together, then those with a common shingle in their prefixes
    (``near_links``), and each is compared on its whole text, unless the two are linked already.
    Null and empty texts, and others without a word, are alike. Of rows that repeat an id and a text
    one stays; null ids come after all others. An empty table stays empty. Columns of ``df`` may
    have any names.
    """
    n = no_clash(df, "row", "keep")
    rows = stored(df.withColumn(n["row"], F.monotonically_increasing_id()), "rows")
    # rows of equal texts are one node, named by its smallest row number
    own_id = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).cast("bigint").alias("id"), F.col(n["row"]).alias("row"))
    prefixes = _prefixes(text_of(text_col), np.zeros(0, dtype=np.int64))
    keyed = stored(rows.select(own_id.alias("own"), F.unhex(F.sha2(text_of(text_col), 256)).alias("same"), prefixes.alias("p")).select("own", "same", "p.*"), "prefixes")
    same = keyed.select("same", F.col("own.row").alias("repeat"))
    repeats = same.join(same.groupBy("same").agg(F.min("repeat").alias("rep")), "same").filter("repeat != rep").select("repeat", "rep")
    repeats = few(stored(repeats, "repeats"))
    # the others are the nodes: they stay where their prefixes were written
    nodes = keyed.join(repeats, F.col("own.row") == F.col("repeat"), "left_anti").select(F.col("own.row").alias("node"), "n", "tokens", "fp", "parity")
    links = near_links(nodes, rows.select(F.col(n["row"]).alias("t_row"), text_of(text_col).alias("t")))
    roots = components(links, "a", "b")
    grouped = keyed.select("own").join(repeats, F.col("own.row") == F.col("repeat"), "left").select("own", F.coalesce("rep", "own.row").alias("rep")).join(roots, F.col("rep") == F.col("node"), "left")
    least = grouped.groupBy(F.coalesce("root", "rep").alias("group")).agg(F.min("own").alias("own")).select(F.col("own.row").alias(n["keep"]))
    return rows.join(least, F.col(n["row"]) == F.col(n["keep"]), "left_semi").select(*df.columns)
