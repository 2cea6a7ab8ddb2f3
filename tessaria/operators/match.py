"""Canonicalisation against ordered vocabularies: alias, exact and similarity tiers.

The shape of every query here is: distinct values, each matched once, joined back. Aliases and
exact values are equi-joins; only what both leave meets the similarity kernel, one Arrow batch
of values at a time against a vocabulary, which is small and goes with the function.
"""

from __future__ import annotations

import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessaria.functions import text as tx

#: Values of a vocabulary that go with one similarity function; larger vocabularies are compared block by block.
LARGEST = 20_000
_MATCH = T.StructType().add("canonical", "string").add("score", "double")


def similarity(value: str, candidate: str) -> float:
    """Ratcliff-Obershelp ratio: twice the matched characters over all; not symmetric."""
    return SequenceMatcher(None, value, candidate).ratio()


def folded(s: str) -> str:
    """Without accents, lower case, no white space at the ends (for the small side, in plain Python)."""
    return "".join(c for c in unicodedata.normalize("NFKD", s.lower().strip()) if not unicodedata.combining(c))


def best_by_ratio(value: Column, candidates: list[str]) -> Column:
    """struct<canonical, score>: the candidate whose folded form is most similar to ``value``, folded too; of ties the earliest."""
    if len(candidates) > LARGEST:
        first, rest = best_by_ratio(value, candidates[:LARGEST]), best_by_ratio(value, candidates[LARGEST:])
        return F.when(rest["score"] > first["score"], rest).otherwise(first)
    names = [(c, folded(c)) for c in candidates]

    def run(values: pd.Series) -> pd.DataFrame:
        out = []
        for v in values:
            best, score = "", 0.0
            matcher = SequenceMatcher(None)
            for c, plain in names if v else ():
                matcher.set_seqs(v, plain)
                if matcher.real_quick_ratio() > score and matcher.quick_ratio() > score and matcher.ratio() > score:
                    best, score = c, matcher.ratio()
            out.append((best, score))
        return pd.DataFrame(out, columns=["canonical", "score"])

    return F.pandas_udf(run, _MATCH)(value)


def match_values(values: DataFrame, value_col: str, candidates: list[str], alias_map: dict[str, str] | None = None, alias_scores: tuple[float, float] = (0.95, 0.95), by_key: bool = True) -> DataFrame:
    """(value, canonical, score) for the distinct values of a column.

    Aliases come first: with ``by_key`` they are met by key alone at the first score (scales);
    else in table order, equal but for case at the first score, but for accents at the second.
    Then a candidate equal but for case or accents scores 1.0, the earliest of several. The rest
    takes the most similar candidate. Empty values match nothing, with score 0.
    """
    spark = values.sparkSession
    v = values.select(F.col(value_col).alias("value")).distinct()
    v = v.withColumn("m_text", tx.normalize_text(F.col("value"))).withColumn("m_low", F.lower("m_text"))
    v = v.withColumn("m_plain", tx.strip_accents(F.col("m_low"))).withColumn("m_key", tx.key(F.col("value")))
    cand = spark.createDataFrame([(c, i) for i, c in enumerate(candidates)], "c_value string, c_ordinal int")
    cand = cand.withColumn("c_low", F.lower(tx.stripped(F.col("c_value")))).withColumn("c_plain", tx.strip_accents(F.col("c_low")))
    # one row per spelling: the earliest candidate that has it
    exact = cand.groupBy("c_plain").agg(F.min_by("c_value", "c_ordinal").alias("e_value"))
    out = v.join(F.broadcast(exact), F.col("m_plain") == F.col("c_plain"), "left")
    if alias_map:
        al = spark.createDataFrame([(a, c, i) for i, (a, c) in enumerate(alias_map.items())], "a_text string, a_value string, a_ordinal int")
        al = al.withColumn("a_low", F.lower(tx.stripped(F.col("a_text")))).withColumn("a_plain", tx.strip_accents(F.col("a_low")))
        probe = "m_key" if by_key else "m_plain"
        # the table is walked in order: its first row equal but for accents wins, at the score of how it is equal
        first = al.groupBy("a_plain").agg(F.min_by(F.struct("a_value", "a_low"), "a_ordinal").alias("a"))
        out = out.join(F.broadcast(first), F.col(probe) == F.col("a_plain"), "left")
        a_score = F.lit(alias_scores[0]) if by_key else F.when(F.col("a.a_low") == F.col("m_low"), F.lit(alias_scores[0])).otherwise(F.lit(alias_scores[1]))
        out = out.withColumn("a_hit", F.when(F.col("m_text") != "", F.col("a.a_value"))).withColumn("a_score", a_score)
    else:
        out = out.withColumn("a_hit", F.lit(None).cast("string")).withColumn("a_score", F.lit(None).cast("double"))
    known = F.col("a_hit").isNotNull() | F.col("e_value").isNotNull() | (F.col("m_text") == "")
    # one pass: values that are known go through the similarity function as null, which costs nothing
    out = out.withColumn("b", best_by_ratio(F.when(~known, F.col("m_plain")), candidates))
    return out.select(
        "value",
        F.when(F.col("m_text") == "", "").otherwise(F.coalesce("a_hit", "e_value", "b.canonical")).alias("canonical"),
        F.when(F.col("m_text") == "", 0.0).when(F.col("a_hit").isNotNull(), F.col("a_score")).when(F.col("e_value").isNotNull(), 1.0).otherwise(F.col("b.score")).alias("score"),
    )


def match_method(value: Column, score: Column, is_alias: Column | None = None, high: float = 0.85, low: float = 0.70) -> Column:
    """exact, alias, fuzzy_high, fuzzy_low or unmatched."""
    out = F.when((tx.blank_as_empty(value) == "") | (score <= 0), "unmatched").when(score >= 0.999, "exact")
    if is_alias is not None:
        out = out.when(is_alias, "alias")
    return out.when(score >= high, "fuzzy_high").when(score >= low, "fuzzy_low").otherwise("unmatched")


def alias_keys(alias_map: dict[str, str]) -> list[str]:
    """Every alias as ``key`` has it (plain Python, for tables that ship)."""
    import re
    import unicodedata

    def plain(s: str) -> str:
        s = re.sub(r"^[A-Za-z0-9]{1,3}\s*[).\-]\s+", "", " ".join(unicodedata.normalize("NFC", s).split()))
        return "".join(c for c in unicodedata.normalize("NFKD", s.lower()) if not unicodedata.combining(c)).strip()

    return sorted({plain(a) for a in alias_map})


def half_even(c: Column, digits: int = 3) -> Column:
    """Scores from 0 to under 2 rounded half to even by their exact binary value (0.8625 is a little more: 0.863)."""
    unit = 1 << 62
    parts = (c * F.lit(float(unit))).cast("bigint").cast("decimal(19,0)") * F.lit(10**digits).cast("decimal(6,0)")
    rest = parts % F.lit(unit).cast("decimal(19,0)")
    whole = ((parts - rest) / F.lit(unit).cast("decimal(19,0)")).cast("bigint")
    up = F.when((rest * 2 > unit) | ((rest * 2 == unit) & (whole % 2 == 1)), 1).otherwise(0)
    return (whole + up) / F.lit(float(10**digits))


def first_seen(df: DataFrame, key_col: str, seq_col: str) -> DataFrame:
    """``df`` with is_first: whether a row is the first with its key, by ``seq_col``, whose values differ.

    Minima combine before they are shuffled; no task sorts all rows of a frequent key.
    """
    first = df.groupBy(F.col(key_col).alias("f_key")).agg(F.min(seq_col).alias("f_seq"))
    return df.join(first, F.col(key_col).eqNullSafe(F.col("f_key"))).withColumn("is_first", F.col(seq_col) == F.col("f_seq")).drop("f_key", "f_seq")


def match_stats(df: DataFrame, score_col: str = "score") -> DataFrame:
    """(bucket, n): rows whose score is exact (1), fuzzy (0.70 on) or unmatched."""
    bucket = F.when(F.col(score_col) == 1.0, "exact").when(F.col(score_col) >= 0.70, "fuzzy").otherwise("unmatched")
    return df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


def vocabulary_report(df: DataFrame, key_col: str, canonical_col: str, score_col: str, seq_col: str) -> DataFrame:
    """(original, normalized, score, count) of every key, with the first row's match."""
    first = F.min_by(F.struct(F.col(canonical_col).alias("n"), F.col(score_col).alias("s")), seq_col)
    return df.groupBy(F.col(key_col).alias("original")).agg(first.alias("f"), F.count("*").alias("count")).select("original", F.col("f.n").alias("normalized"), F.col("f.s").alias("score"), "count")


def read_vocabulary(mapping: DataFrame) -> DataFrame:
    """(type, normalized, variants, count) of a vocabulary mapping; blanks are skipped, counts that are no numbers ignored."""
    rows = mapping.filter(~tx.is_blank(F.col("normalized")))
    variant = F.when((F.col("original") != F.col("normalized")) & ~tx.is_blank(F.col("original")), F.col("original"))
    return rows.groupBy("type", "normalized").agg(F.array_sort(F.collect_set(variant)).alias("variants"), F.coalesce(F.sum(F.expr("try_cast(count AS bigint)")), F.lit(0)).alias("count"))
