"""Links between texts whose sets of shingles are alike, from keys that alike texts share.

What a key is (a shingle of a prefix, a chunk of a signature) is the caller's; that two texts that
are alike share one is too. Here they are compared, on their whole sets, and never all with all:
each text first with one other, so that a large group of copies meets in about as many pairs as it
has members; from then on only texts of different groups are, first with a few by chance, then with
the most promising ones, last with all that can't be ruled out. Sizes and the parity of shingles in
``CELLS`` cells rule pairs out; both never rule out texts that are alike.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessaria.llm.common import passing, stored
from tessaria.llm.components import components

SEED = 42
#: Cells of shingles whose parity is kept for each text: a power of two.
CELLS = 1024
#: About how many of a key's members make a part: two parts at most are compared in one piece, so it bounds a task's memory (some 200 bytes a member, some 50 MB for the pairs); rows of large keys are copied once for each such number.
LIMIT = 512
#: The rounds in which texts are compared with a few others by chance: each number is an order by hash, and in a round a text meets the first of all its keys' members in each order.
ROUNDS = ((0,), (1, 2, 3))
#: How many of its most promising partners in a piece a text that is still apart is compared with, before all.
PARTNERS = 4
#: Of a text's keys, how many it looks for these partners in: the first in the order of a hash, which texts that share many keys tend to share too.
LOOKED_IN = 4
#: With at most so many buckets, or pairs, to look up, their numbers are broadcast; with more that is a join.
BROADCAST_PAIRS = 1_000_000


def shingles(text: str | None, k: int) -> set[int]:
    """Hashes of the runs of ``k`` words, A-Z lower-cased; fewer words, even none, are one run."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    h = xxhash.xxh64_intdigest
    if len(words) <= k:
        return {h(b" ".join(words), SEED)}
    return {h(b" ".join(words[i : i + k]), SEED) for i in range(len(words) - k + 1)}


_recent = lru_cache(maxsize=8)(shingles)


def parity(hashes: np.ndarray) -> np.ndarray:
    """Whether an odd number of the hashes falls into each of ``CELLS`` cells, as bits of 64-bit numbers."""
    odd = np.bincount((hashes & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


@dataclass(frozen=True)
class Likeness:
    """Sets are alike if what they share is at least ``share / of`` of all they have; shingles have ``words`` words."""

    share: int
    of: int
    words: int

    def similarity(self, a: str | None, b: str | None) -> tuple[int, int]:
        """How many shingles two texts share, and how many they have together."""
        x, y = _recent(a, self.words), _recent(b, self.words)
        both = len(x & y)
        return both, len(x) + len(y) - both

    def alike(self, a: str | None, b: str | None) -> bool:
        both, all_of = self.similarity(a, b)
        return both * self.of >= self.share * all_of

    def possible(self, a_n, a_pos, b_n, b_pos):
        """Whether sets of these sizes whose first common element has these positions can be alike: columns or arrays."""
        rest = a_n - a_pos, b_n - b_pos
        both = self.share * (a_n + b_n)
        return (rest[0] * (self.share + self.of) >= both) & (rest[1] * (self.share + self.of) >= both)

    def near(self, only, both_n):
        """Whether sets can be alike of which ``only`` shingles at least are in one of them: columns or arrays."""
        return only * (self.of + self.share) <= both_n * (self.of - self.share)


def few(df: DataFrame) -> DataFrame:
    """``df``, broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_PAIRS else df


def _alike(rule: Likeness, a: Column, b: Column) -> Column:
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([rule.alike(x, y) for x, y in zip(a, b, strict=True)], dtype=bool)

    return F.pandas_udf(run, T.BooleanType())(a, b)


def _best(i: np.ndarray, only: np.ndarray, most: int) -> np.ndarray:
    """Which pairs are among the ``most`` of their member ``i`` with the smallest ``only``."""
    order = np.lexsort((only, i))
    first = np.r_[True, i[order][1:] != i[order][:-1]] if len(i) else np.zeros(0, dtype=bool)
    starts = np.maximum.accumulate(np.where(first, np.arange(len(i)), 0))
    out = np.zeros(len(i), dtype=bool)
    out[order] = np.arange(len(i)) - starts < most
    return out


def _open_pairs(rule: Likeness, members: str, across: Column, most: int | None) -> Column:
    """The possible pairs of a key's members of different groups; ``across``: of different parts only.

    Cells of different parity are no more than the shingles that only one of two texts has, and
    alike texts have few of these: most pairs of a large family end here, and are never listed. With
    ``most``, of the others each member's most alike ones by that count.
    """

    def run(nodes: pd.Series, sizes: pd.Series, places: pd.Series, groups: pd.Series, parts: pd.Series, parities: pd.Series, across: pd.Series) -> pd.Series:
        out = []
        for node, n, pos, group, part, cells, cross in zip(nodes, sizes, places, groups, parts, parities, across, strict=True):
            n, pos = n.astype("i8"), pos.astype("i8")
            ok = rule.possible(n[:, None], pos[:, None], n[None, :], pos[None, :]) & (group[:, None] != group[None, :]) & (node[:, None] < node[None, :])
            if cross:
                ok &= part[:, None] != part[None, :]
            bits, (i, j) = np.stack(cells).view(np.uint64), np.nonzero(ok)
            only = np.zeros(len(i), dtype=np.int64)
            for at in range(0, len(i), 1 << 14):
                only[at : at + (1 << 14)] = np.bitwise_count(bits[i[at : at + (1 << 14)]] ^ bits[j[at : at + (1 << 14)]]).sum(axis=1)
            near = rule.near(only, n[i] + n[j])
            i, j, only = i[near], j[near], only[near]
            if most is not None:
                kept = _best(i, only, most) | _best(j, only, most)
                i, j = i[kept], j[kept]
            out.append([{"a": int(node[a]), "b": int(node[k])} for a, k in zip(i, j, strict=True)])
        return pd.Series(out, dtype=object)

    kind = T.ArrayType(T.StructType().add("a", "long").add("b", "long"))
    return F.pandas_udf(run, kind)(*[F.col(f"{members}.{k}") for k in ("node", "n", "pos", "group", "part", "parity")], across)


def shared_keys(nodes: DataFrame, keys: str = "tokens") -> DataFrame:
    """(token, size) of the keys that several nodes have; most have one, and only the others leave this count."""
    return stored(nodes.select(F.explode(keys).alias("token")).groupBy("token").agg(F.count("*").alias("size")).filter("size > 1"), "shared")


def verified(pairs: DataFrame, cells: DataFrame, texts: DataFrame, rule: Likeness) -> DataFrame:
    """The pairs (a, b) of nodes that are alike, compared on their whole texts.

    ``cells`` has (node, n, parity), ``texts`` (t_row, t). Only texts of pairs that sizes and
    parity leave are shuffled.
    """
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    own = cells.select(F.col("node").alias("p_node"), F.col("n").alias("p_n"), F.col("parity").alias("p_cells"))
    one = pairs.join(own, F.col("a") == F.col("p_node")).select("a", "b", F.col("p_n").alias("a_n"), F.col("p_cells").alias("a_cells"))
    differ = F.aggregate(F.zip_with("a_cells", "p_cells", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    sized = rule.possible(F.col("a_n"), F.lit(0), F.col("p_n"), F.lit(0))
    with passing() as stays:
        close = stored(one.join(own, F.col("b") == F.col("p_node")).filter(sized & rule.near(differ, F.col("a_n") + F.col("p_n"))).select("a", "b"), "close")
        wanted = few(stored(close.select(F.explode(F.array("a", "b")).alias("w_row")).distinct(), "wanted"))
        own = texts.join(wanted, F.col("t_row") == F.col("w_row"), "left_semi")
        left = close.join(own, F.col("a") == F.col("t_row")).select("a", "b", F.col("t").alias("ta"))
        return stays(stored(left.join(own, F.col("b") == F.col("t_row")).select("a", "b", _alike(rule, F.col("ta"), F.col("t")).alias("alike")).filter("alike").select("a", "b"), "links"))


def _dealt(state: DataFrame) -> DataFrame:
    """The rows of ``state`` dealt to cells of keys, so that members of different groups meet once.

    A key with at most ``LIMIT`` members is one cell. In a larger one the members of its largest group
    never meet each other: they are cut into parts, and so are the others; every part of the group
    meets every part of the others, and the others' parts meet among themselves. So a key with
    members of one large group and a few others deals only these few to many cells. Gives
    (token, node, n, pos, group, part, cell), the cell as (across, i, j); keys of one group are dropped.
    """
    counts = state.groupBy("token", "group").agg(F.count("*").alias("k")).groupBy("token")
    tops = counts.agg(F.max(F.struct("k", "group")).alias("top"), F.sum("k").alias("all")).filter(F.col("all") > F.col("top.k"))
    main_parts, other_parts = F.ceil(F.col("top.k") / LIMIT), F.ceil((F.col("all") - F.col("top.k")) / LIMIT)
    tops = stored(tops.select(F.col("token").alias("m_token"), F.col("top.group").alias("main"), "all", main_parts.cast("int").alias("mains"), other_parts.cast("int").alias("others")), "tops")
    cut = state.join(few(tops), F.col("token") == F.col("m_token")).withColumn("in_main", F.col("group") == F.col("main"))
    at = F.pmod(F.xxhash64("node"), F.when(F.col("in_main"), F.col("mains")).otherwise(F.col("others"))).cast("int")
    cut = cut.withColumn("at", at)

    def cell(across: Column, i: Column, j: Column) -> Column:
        return F.struct(across.alias("across"), i.alias("i"), j.alias("j"))

    def numbers(of: str) -> Column:
        return F.sequence(F.lit(0), F.col(of) - 1)

    alone = F.array(cell(F.lit(False), F.lit(0), F.lit(0)))
    mains = F.transform(numbers("others"), lambda k: cell(F.lit(True), F.col("at"), k))
    meet = F.transform(numbers("mains"), lambda k: cell(F.lit(True), k, F.col("at")))
    # the others' own cells have negative numbers
    among = F.transform(numbers("others"), lambda k: cell(k != F.col("at"), -1 - F.least(k, "at"), F.greatest(k, "at")))
    cells = F.when(F.col("all") <= LIMIT, alone).when(F.col("in_main"), mains).otherwise(F.concat(meet, among))
    part = F.when(F.col("in_main"), -1).otherwise(F.col("at"))
    return cut.select("token", "node", "n", "pos", "group", part.alias("part"), F.explode(cells).alias("cell"))


def connect(held: DataFrame, cells: DataFrame, texts: DataFrame, rule: Likeness, seeds: DataFrame | None = None) -> DataFrame:
    """Links (a, b) that connect the nodes exactly as all alike pairs with a common key do.

    ``held`` has (token, node, n, pos, size): a row for each node's key that several have, the size
    of the node's set, the key's position in it (0 where keys have none), how many nodes have the
    key. ``cells`` has (node, n, parity), ``texts`` (t_row, t). ``seeds`` are pairs to compare first.
    In each round of ``ROUNDS`` a node meets the first member of all its keys in the order of a hash,
    as long as that is of another group. Then members of different groups meet within a key, a large
    key's in parts of about ``LIMIT`` (``_dealt``): first the most promising pairs in a few keys of each, then all
    that are possible.
    """
    names = [F.col(c) for c in ("token", "node", "n", "pos", "size")]
    links = None if seeds is None else verified(seeds, cells, texts, rule)
    own = cells.select(F.col("node").alias("c_node"), "parity")

    def grouped(links: DataFrame | None) -> DataFrame:
        """All rows with each one's group."""
        if links is None:
            return held.select(*names, F.col("node").alias("group"))
        groups = components(links, "a", "b").withColumnRenamed("node", "g_node")
        return stored(held.join(few(groups), F.col("node") == F.col("g_node"), "left").select(*names, F.coalesce("root", "node").alias("group")), "grouped")

    def still_apart(state: DataFrame) -> DataFrame:
        """The rows of keys whose members are in several groups."""
        several = stored(state.groupBy("token").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).filter("lo < hi").select("token"), "several")
        return state.join(few(several), "token", "left_semi")

    def joined(links: DataFrame | None, found: DataFrame) -> DataFrame:
        return found if links is None else links.unionByName(found)

    for orders in ROUNDS:
        with passing() as stays:
            state = grouped(links)
            firsts = [F.min(F.struct(F.xxhash64("node", F.lit(k)).alias("h"), "node", "group")).alias(f"f{k}") for k in orders]
            first = state.groupBy("token").agg(*firsts, F.min("group").alias("lo"), F.max("group").alias("hi")).filter("lo < hi")  # members in several groups
            first = stored(first.drop("lo", "hi").withColumnRenamed("token", "f_token"), "first")
            other = [F.min(F.when(F.col("group") != F.col(f"f{k}.group"), F.col(f"f{k}"))).alias(f"f{k}") for k in orders]
            met = state.join(first, F.col("token") == F.col("f_token")).groupBy("node").agg(*other)
            pairs = met.select(F.col("node").alias("a"), F.explode(F.array_compact(F.array(*[f"f{k}.node" for k in orders]))).alias("b"))
            links = joined(links, stays(verified(pairs, cells, texts, rule)))
    for most in (PARTNERS, None):
        with passing() as stays:
            state = grouped(links)
            if most is not None:
                state = still_apart(state)
                ordered = F.array_sort(F.collect_list(F.struct(F.xxhash64("token").alias("h"), *names, "group")))  # one text's keys
                state = state.groupBy("node").agg(F.slice(ordered, 1, LOOKED_IN).alias("r")).select(F.explode("r").alias("r")).select(*[F.col(f"r.{c}") for c in ("token", "node", "n", "pos", "size", "group")])
                state = stored(state, "open")
            pieces = _dealt(state).join(own, F.col("node") == F.col("c_node"))
            cut = pieces.groupBy("token", "cell").agg(F.collect_list(F.struct("node", "n", "pos", "group", "part", "parity")).alias("members"))
            rest = cut.filter(F.size("members") > 1).select(F.explode(_open_pairs(rule, "members", F.col("cell.across"), most)).alias("l"))
            links = joined(links, stays(verified(rest.select("l.a", "l.b"), cells, texts, rule)))
    return links
