"""Exact joins by the Ratcliff-Obershelp ratio, both sides data frames.

The ratio is twice the matched characters over all, and two texts can't match more characters than
they share, however these are arranged. So a text becomes the set of its characters, each with the
number of its occurrence; two sets share as many as the texts do, and their overlap bounds the ratio
from above. That bound is an ordinary set similarity and is joined by prefixes: in one order of all
tokens, the rarest first, sets that share enough have one of their first tokens in common. Lengths and
the whole sets rule further pairs out, and the ratio itself is computed for what is left.

The best candidate needs no threshold: values look for one at 0.7 first, those without at 0.4, and
only the rest meet all that share a character with them. Whoever finds a candidate in a round has
met all that could be better.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessaria.functions import text as tx
from tessaria.sources.files import cut

#: Least ratios of the rounds, as fractions; the last one takes any.
ROUNDS = ((7, 10), (4, 10), (0, 1))
#: The most kinds of tokens whose frequencies are broadcast; with more that is a join.
BROADCAST_TOKENS = 200_000


def folded(c: Column) -> Column:
    """What texts are compared by: normalised, lower case, without accents; null is empty."""
    return tx.strip_accents(F.lower(tx.normalize_text(c)))


def characters(c: Column) -> Column:
    """A text's characters as a set: each with the number of its occurrence, so that sets share what texts do."""
    every = F.filter(F.array_sort(F.split(c, "")), lambda x: x != "")
    return tx.let(every, lambda s: F.transform(s, lambda x, i: F.concat(x, (i - F.array_position(s, x) + 2).cast("string"))))


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    matcher, out = SequenceMatcher(None), []
    for x, y in zip(a, b, strict=True):
        matcher.set_seqs(x, y)
        out.append(matcher.ratio())
    return pd.Series(out, dtype="float64")


def _in_order(sides: list[DataFrame]) -> list[DataFrame]:
    """(text, tokens) of distinct texts, the tokens in one order of all sides, the rarest first."""
    exploded = [s.select("text", F.explode(characters(F.col("text"))).alias("token")) for s in sides]
    both = exploded[0]
    for e in exploded[1:]:
        both = both.unionByName(e)
    counts = cut(both.groupBy("token").agg(F.count("*").alias("n"))).withColumnRenamed("token", "c_token")
    counts = F.broadcast(counts) if counts.count() <= BROADCAST_TOKENS else counts
    order = F.array_sort(F.collect_list(F.struct("n", "token")))
    return [cut(e.join(counts, F.col("token") == F.col("c_token")).groupBy("text").agg(F.transform(order, lambda x: x["token"]).alias("tokens"))) for e in exploded]


def _prefix(tokens: Column, share: int, of: int) -> Column:
    """The first tokens, one of which is in any set that can reach the ratio: all but what both must share, and one."""
    n = F.size(tokens)
    return F.slice(tokens, 1, n - F.ceil(n * share / (2 * of - share)).cast("int") + 1)


def _bounded(left: DataFrame, right: DataFrame, share: int, of: int) -> DataFrame:
    """(a, b, bound) of the pairs whose bound reaches ``share / of``, each once; sides as ``_in_order`` gives them."""
    prefix = lambda s: _prefix(F.col("tokens"), share, of)
    l_side = left.select(F.col("text").alias("a"), F.col("tokens").alias("a_tokens"), prefix(left).alias("a_first")).withColumn("token", F.explode("a_first"))
    r_side = right.select(F.col("text").alias("b"), F.col("tokens").alias("b_tokens"), prefix(right).alias("b_first")).withColumn("b_token", F.explode("b_first"))
    na, nb = F.size("a_tokens"), F.size("b_tokens")
    sized = (na * share <= nb * (2 * of - share)) & (nb * share <= na * (2 * of - share))
    # of several common tokens only the first one's meeting counts, so no pair comes twice
    met = l_side.join(r_side, (F.col("token") == F.col("b_token")) & sized & (F.get(F.array_intersect("a_first", "b_first"), F.lit(0)) == F.col("token")))
    met = met.withColumn("both", F.size(F.array_intersect("a_tokens", "b_tokens")))
    return met.filter(F.col("both") * (2 * of) >= (na + nb) * share).select("a", "b", (F.col("both") * 2 / (na + nb)).alias("bound"))


def _texts(df: DataFrame, col: str) -> DataFrame:
    return df.select(folded(F.col(col)).alias("text")).filter("text != ''").distinct()


def similar(values: DataFrame, value_col: str, candidates: DataFrame, candidate_col: str, share: int = 7, of: int = 10) -> DataFrame:
    """(a, b, bound, ratio) of all pairs of folded texts whose ratio is at least ``share / of``, which is above zero.

    Texts that are empty once folded are in no pair; repeated ones count once.
    """
    if share <= 0:
        raise ValueError("every pair reaches a ratio of zero")
    left, right = _in_order([_texts(values, value_col), _texts(candidates, candidate_col)])
    return _bounded(left, right, share, of).withColumn("ratio", ratio("a", "b")).filter(F.col("ratio") * of >= share)


def best_matches(values: DataFrame, value_col: str, candidates: DataFrame, candidate_col: str, order_col: str | None = None) -> DataFrame:
    """(value, canonical, score, compared) for the distinct values of a column.

    ``canonical`` is the candidate whose folded form is most similar to the value's, of ties the one
    with the smallest ``order_col`` (its text, if not given); ``compared`` is for how many candidates
    the ratio was computed. Values that are empty once folded, and those that share no character with
    any candidate, have an empty canonical and score 0. Null counts as empty, for candidates too.
    """
    order_col = order_col or candidate_col
    wanted = cut(values.select(F.col(value_col).alias("value")).distinct().withColumn("a_text", folded(F.col("value"))))
    named = candidates.select(folded(F.col(candidate_col)).alias("b_text"), F.coalesce(F.col(candidate_col), F.lit("")).alias("name"), F.col(order_col).alias("rank"))
    # of candidates that fold to the same text the first
    named = cut(named.filter("b_text != ''").groupBy("b_text").agg(F.min(F.struct("rank", "name")).alias("first")))
    texts = wanted.select(F.col("a_text").alias("text")).filter("text != ''").distinct()
    equal = texts.join(named.select(F.col("b_text").alias("text")), "text", "left_semi")
    found = [cut(equal.select(F.col("text").alias("f_text"), F.col("text").alias("f_name"), F.lit(1.0).alias("f_ratio"), F.lit(0).cast("long").alias("f_n")))]
    left, right = _in_order([texts.join(equal, "text", "left_anti"), named.select(F.col("b_text").alias("text"))])
    for share, of in ROUNDS:
        pairs = cut(_bounded(left, right, share, of))
        # the ratio of the pair with the largest bound is a bound from below
        least = pairs.groupBy("a").agg(F.max(F.struct("bound", "b")).alias("top")).select(F.col("a").alias("l_a"), ratio("a", F.col("top.b")).alias("low"))
        close = pairs.join(cut(least), F.col("a") == F.col("l_a")).filter("bound >= low").select("a", "b")
        scored = close.withColumn("ratio", ratio("a", "b")).filter(F.col("ratio") * of >= share).filter("ratio > 0")
        ranked = scored.join(named, F.col("b") == F.col("b_text")).withColumn("order", F.struct((-F.col("ratio")).alias("r"), "first", "b"))
        best = cut(ranked.groupBy("a").agg(F.min("order").alias("top"), F.count("*").alias("n")).select(F.col("a").alias("f_text"), F.col("top.b").alias("f_name"), (-F.col("top.r")).alias("f_ratio"), F.col("n").alias("f_n")))
        found.append(best)
        left = cut(left.join(best, F.col("text") == F.col("f_text"), "left_anti"))
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    out = wanted.join(every, F.col("a_text") == F.col("f_text"), "left").join(named, F.col("f_name") == F.col("b_text"), "left")
    return out.select("value", F.coalesce("first.name", F.lit("")).alias("canonical"), F.coalesce("f_ratio", F.lit(0.0)).alias("score"), F.coalesce("f_n", F.lit(0)).cast("long").alias("compared"))
