"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

Target weights are whole parts: a source with n parts of Q in all is due n of every Q slots. Each
source's documents, in a pseudo-random order, are cut into blocks of ``block_chars`` characters,
and its block k gets the window from floor(k * Q / n) (release) to ceil((k + 1) * Q / n)
(deadline). Earliest deadline first among released blocks meets every deadline, so after any
number of slots each source is less than one block from its target. The schedule repeats after Q
slots: only one period is planned, and every block finds its slot by a division. Nothing is
dropped: when a source has no blocks left its slots stay empty and the others keep their order,
and sources whose weight is zero have no slot and come last.

Sources with the same number of parts have the same windows and take turns by name, so a plan
only tells numbers of parts apart: at most sqrt(2 Q) of them, however many sources there are.
"""

from __future__ import annotations

from fractions import Fraction
from math import gcd, lcm

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessaria.llm.common import named_columns, numbered_columns, table, text_of

#: Characters in a block, parts that tempered weights are rounded to, and hex digits that split a source for its running sum.
BLOCK_CHARS, SLOTS, SPLIT_DIGITS = 20_000, 1000, 3
#: The most slots in the period of given weights (and one more for each source at most); weights that need more are rounded to it.
PERIOD = 100_000
#: Target weight of a source: its characters to this power, so small sources are raised.
TEMPER = 0.5
#: Slots planned at a stretch.
STRETCH = 500
#: Under this name a mixed table's source column carries the weights that it was mixed by.
TARGETS = "mix_targets"


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s:"), source), F.lit("none"))


def queue_order(id_col: str = "doc_id") -> Column:
    """The digest that orders a source's documents."""
    return F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))


def whole_parts(weights: dict, period: int = PERIOD) -> dict:
    """Weights as whole parts in the same proportions, exactly, if these sum up to at most ``period``.

    Otherwise they are rounded to ``period`` parts by largest remainders, each positive weight to
    one at least. Numbers count as they are written: 0.3 is three tenths. Zero stays zero.
    """
    exact = {k: Fraction(str(v)) for k, v in weights.items()}
    if any(v < 0 for v in exact.values()):
        raise ValueError("weights must not be negative")
    unit = lcm(*(v.denominator for v in exact.values()), 1)
    parts = {k: int(v * unit) for k, v in exact.items()}
    parts = {k: v // max(1, gcd(*parts.values())) for k, v in parts.items()}
    total = sum(parts.values())
    if total <= period:
        return parts
    out = {k: max(1, v * period // total) if v else 0 for k, v in parts.items()}
    order = sorted((k for k, v in parts.items() if v), key=lambda k: (-(parts[k] * period % total), str(k)))
    for k in order[: max(0, period - sum(out.values()))]:
        out[k] += 1
    return out


def target_slots(sizes: DataFrame, slots: int = SLOTS, temper: float = TEMPER, weights: dict[str | None, float] | None = None) -> DataFrame:
    """(m_key, due): each source's parts, from given weights (unnamed sources: zero) or its tempered size (at least one)."""
    if weights is None:
        weighted = sizes.select("m_key", F.pow(F.greatest(F.col("m_chars"), F.lit(1)).cast("double"), F.lit(temper)).alias("w"))
        total = weighted.agg(F.sum("w").alias("w_sum"))  # one row
        return weighted.join(F.broadcast(total)).select("m_key", F.greatest(F.lit(1), F.round(F.lit(slots) * F.col("w") / F.col("w_sum"))).cast("long").alias("due"))
    rows = [(k, v) for k, v in whole_parts(weights).items()]
    given = sizes.sparkSession.createDataFrame(rows, "m_name string, due long").select(_key(F.col("m_name")).alias("g_key"), F.col("due").alias("g_due"))
    return sizes.join(F.broadcast(given), F.col("m_key") == F.col("g_key"), "left").select("m_key", F.coalesce("g_due", F.lit(0)).alias("due"))


def target_weights(df: DataFrame, source_col: str = "source", text_col: str = "text", temper: float = TEMPER) -> dict[str | None, int]:
    """Each source's tempered parts of the mix, as ``mix`` takes them; a row for each source comes to the driver."""
    sizes = df.groupBy(F.col(source_col).alias("source")).agg(F.sum(F.length(text_of(text_col)).cast("long")).alias("m_chars"))
    due = {r.m_key: r.due for r in target_slots(sizes.select(_key(F.col("source")).alias("m_key"), "m_chars"), temper=temper).collect()}
    return {None if k == "none" else k[2:]: v for k, v in due.items()}


def with_targets(df: DataFrame, weights: dict[str | None, int], source_col: str = "source") -> DataFrame:
    """``df`` whose source column carries ``weights`` in its metadata, which Parquet files keep."""
    named = {"none" if k is None else f"s:{k}": v for k, v in weights.items()}
    return df.withMetadata(source_col, df.schema[source_col].metadata | {TARGETS: named})


def targets(df: DataFrame, source_col: str = "source") -> dict[str | None, int] | None:
    """The weights that ``with_targets`` left, None if there are none."""
    named = df.schema[source_col].metadata.get(TARGETS)
    return None if named is None else {None if k == "none" else k[2:]: v for k, v in named.items()}


def period(due: DataFrame) -> DataFrame:
    """(m_key, m_no, m_slot, m_due, m_period): the slots of one period, by earliest deadline first.

    Ties go to the smaller number of parts, then by name. Sources without parts have no row. One
    row with an entry for each number of parts goes through the plan.
    """
    due = due.filter("due > 0").select("m_key", "due", (F.row_number().over(W.partitionBy("due").orderBy("m_key")) - 1).alias("member"))
    kinds = due.groupBy("due").agg(F.count("*").alias("many"))
    state = F.transform(F.array_sort(F.collect_list(F.struct("due", "many"))), lambda x: F.struct(x.due.alias("n"), x.many.alias("many"), F.lit(0).cast("long").alias("s")))
    one = kinds.agg(state.alias("s"), F.sum(F.col("due") * F.col("many")).alias("q")).filter(F.col("q") > 0)
    q = F.col("q")

    def turn(x: Column) -> Column:
        return F.floor(x.s / x.many)  # the block that is next; products stay far below 2 ** 53, so quotients are exact enough

    def step(acc: Column, t: Column) -> Column:
        open_now = F.filter(acc.s, lambda x: (turn(x) < x.n) & (F.floor(turn(x) * q / x.n) <= t))
        pick = F.array_min(F.transform(open_now, lambda x: F.struct(F.ceil((turn(x) + 1) * q / x.n).alias("d"), x.n.alias("n")))).n
        return F.struct(
            F.transform(acc.s, lambda x: F.struct(x.n.alias("n"), x.many.alias("many"), (x.s + F.when(x.n == pick, 1).otherwise(0)).cast("long").alias("s"))).alias("s"),
            F.concat(acc.out, F.array(pick)).alias("out"),
        )

    def stretch(acc: Column, start: Column) -> Column:
        slots = F.sequence(start, F.least(start + STRETCH, q) - 1)
        done = F.aggregate(slots, F.struct(acc.s.alias("s"), F.array().cast("array<bigint>").alias("out")), step)
        return F.struct(done.s.alias("s"), F.concat(acc.out, F.array(done.out)).alias("out"))

    starts = F.sequence(F.lit(0).cast("long"), q - 1, F.lit(STRETCH).cast("long"))
    plan = F.aggregate(starts, F.struct(F.col("s"), F.array().cast("array<array<bigint>>").alias("out")), stretch, lambda acc: F.flatten(acc.out))
    slots = one.select("q", F.posexplode(plan).alias("m_slot", "n"))
    nth = slots.select("q", "m_slot", "n", (F.row_number().over(W.partitionBy("n").orderBy("m_slot")) - 1).alias("nth"))
    many = kinds.select(F.col("due").alias("k_due"), "many")
    turns = nth.join(many, F.col("n") == F.col("k_due")).select("q", "m_slot", "n", (F.col("nth") % F.col("many")).alias("at"), F.floor(F.col("nth") / F.col("many")).alias("m_no"))
    named = turns.join(due, (F.col("n") == F.col("due")) & (F.col("at") == F.col("member")))
    return named.select("m_key", F.col("m_no").cast("long"), F.col("m_slot").cast("long"), F.col("n").alias("m_due"), F.col("q").alias("m_period"))


RESULT = ("m_block", "m_release", "m_deadline", "m_slot", "m_start")


def _placed(df: DataFrame, source_col: str, text_col: str, id_col: str, weights: dict | None, block_chars: int, slots: int, temper: float) -> DataFrame:
    """The ``numbered_columns`` of ``df``, id, and those of ``RESULT``."""
    own = [f"r{i}" for i in range(len(df.columns))]
    rows = df.select(*numbered_columns(df), F.col(id_col).alias("id"), _key(F.col(source_col)).alias("key"), queue_order(id_col).alias("order"), F.length(text_of(text_col)).cast("long").alias("chars"))
    rows = rows.withColumn("part", F.substring("order", 1, SPLIT_DIGITS))
    parts = rows.groupBy(F.col("key").alias("m_key"), F.col("part").alias("m_part")).agg(F.sum("chars").alias("m_chars"))
    before = parts.select("m_key", "m_part", (F.sum("m_chars").over(W.partitionBy("m_key").orderBy("m_part")) - F.col("m_chars")).alias("m_before"))
    plan = period(target_slots(parts.groupBy("m_key").agg(F.sum("m_chars").alias("m_chars")), slots, temper, weights))
    due = plan.filter("m_no = 0").select(F.col("m_key").alias("d_key"), F.col("m_due").alias("d_due"))
    run = W.partitionBy("key", "part").orderBy("order", "id", "chars").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = (
        rows.withColumn("within", F.sum("chars").over(run) - F.col("chars"))
        .join(before, (F.col("key") == F.col("m_key")) & (F.col("part") == F.col("m_part")))
        .select(*own, "id", "key", (F.col("m_before") + F.col("within")).alias("m_start"))
        .withColumn("m_block", F.floor(F.col("m_start") / block_chars).cast("long"))
    )
    placed = placed.join(F.broadcast(due), F.col("key") == F.col("d_key"), "left").withColumn("m_in", F.col("m_block") % F.col("d_due"))
    placed = placed.join(F.broadcast(plan), (F.col("key") == F.col("m_key")) & (F.col("m_in") == F.col("m_no")), "left")  # at most PERIOD + sources rows
    base = F.expr("m_block div m_due") * F.col("m_period")
    return placed.select(
        *own,
        "id",
        "m_block",
        (base + F.floor(F.col("m_no") * F.col("m_period") / F.col("m_due"))).alias("m_release"),
        (base + F.ceil((F.col("m_no") + 1) * F.col("m_period") / F.col("m_due"))).alias("m_deadline"),
        (base + F.col("m_slot")).alias("m_slot"),
        "m_start",
    )


def mix(
    df: DataFrame,
    source_col: str = "source",
    text_col: str = "text",
    id_col: str = "doc_id",
    weights: dict[str | None, float] | None = None,
    block_chars: int = BLOCK_CHARS,
    slots: int = SLOTS,
    temper: float = TEMPER,
) -> DataFrame:
    """``df`` with m_block, m_release, m_deadline, m_slot and m_start (characters of its source before it).

    Ordering by (m_slot, m_start), nulls last, gives the mix. Null sources are a source of their
    own, null and empty texts have no characters, null ids come by the digest of the empty text,
    ties in the order are broken by id and length, and rows that repeat follow one another. A text
    longer than a block lies in the block in which it begins. Rows of sources without weight have
    no release, deadline or slot. Columns of ``df`` with one of the result's names are replaced,
    all others stay; an empty table gives an empty result. A running sum over a hot source is
    split by digest prefix, so that no task holds more than 16 ** -SPLIT_DIGITS of a source.
    """
    placed = _placed(df, source_col, text_col, id_col, weights, block_chars, slots, temper)
    return placed.select(*[c for c, name in zip(named_columns(df), df.columns, strict=True) if name.lower() not in RESULT], *RESULT)


def mixed_order(
    df: DataFrame,
    source_col: str = "source",
    text_col: str = "text",
    id_col: str = "doc_id",
    weights: dict[str | None, float] | None = None,
    block_chars: int = BLOCK_CHARS,
    slots: int = SLOTS,
    temper: float = TEMPER,
) -> DataFrame:
    """``df`` in the order of the mix, with its own columns only: rows and files follow the slots, as ``mix`` defines them.

    Rows without a slot come last; nulls, empty texts, ties, repeated rows and empty tables are as in ``mix``.
    """
    placed = _placed(df, source_col, text_col, id_col, weights, block_chars, slots, temper)
    return placed.orderBy(F.asc_nulls_last("m_slot"), "m_start", "id").select(*named_columns(df))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's block, window and slot in the mix of all sources of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select(
        "doc_id", "source", F.col("m_block").alias("block"), F.col("m_release").alias("release"), F.col("m_deadline").alias("deadline"), F.col("m_slot").alias("slot"), F.col("m_start").alias("source_offset")
    )


SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce('s:' || source, 'none') AS k, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS o,
         length(coalesce(text, '')) AS chars
  FROM documents
), w AS (
  SELECT k, pow(CAST(greatest(sum(chars), 1) AS DOUBLE), {TEMPER}) AS w FROM d GROUP BY k
), due AS (
  SELECT k, CAST(greatest(1, round({SLOTS} * w / (SELECT sum(w) FROM w))) AS BIGINT) AS n FROM w
), tot AS (
  SELECT CAST(sum(n) AS BIGINT) AS q FROM due
), edf AS (
  SELECT CAST(0 AS BIGINT) AS t, CAST(NULL AS VARCHAR) AS pick, (SELECT q FROM tot) AS q,
         (SELECT list({{'key': k, 'n': n, 'k': CAST(0 AS BIGINT)}} ORDER BY k) FROM due) AS s
  UNION ALL
  SELECT t + 1, p.key, q,
         list_transform(s, lambda x: {{'key': x.key, 'n': x.n, 'k': CAST(x.k + (CASE WHEN x.key = p.key THEN 1 ELSE 0 END) AS BIGINT)}})
  FROM (
    SELECT t, q, s, list_sort(list_transform(
        list_filter(s, lambda x: x.k < x.n AND (x.k * q) // x.n <= t),
        lambda x: {{'d': ((x.k + 1) * q + x.n - 1) // x.n, 'n': x.n, 'key': x.key}}))[1] AS p
    FROM edf WHERE t < q)
), plan AS (
  SELECT pick AS k, t - 1 AS slot, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS no FROM edf WHERE pick IS NOT NULL
), b AS (
  SELECT doc_id, source, k, CAST(sum(chars) OVER (PARTITION BY k ORDER BY o, doc_id, chars ROWS UNBOUNDED PRECEDING) - chars AS BIGINT) AS source_offset
  FROM d
), c AS (
  SELECT b.doc_id, b.source, b.k, b.source_offset, source_offset // {BLOCK_CHARS} AS block, n, q FROM b JOIN due ON b.k = due.k, tot
)
SELECT doc_id, source, block,
       block // n * q + (block % n) * q // n AS release,
       block // n * q + ((block % n + 1) * q + n - 1) // n AS deadline,
       block // n * q + slot AS slot, source_offset
FROM c JOIN plan ON c.k = plan.k AND c.block % c.n = plan.no
"""
