"""Quality classifier: a byte-level convolutional network in numpy.

A text is UTF-8 bytes. Filters of ``WIDTH`` bytes slide over all of it; their responses are
max-pooled in overlapping chunks (two cells of ``CELL`` bytes, one cell apart, to the end of the
document). One more channel is fixed, not learned: it marks bytes that continue a period (the same
12 bytes stood at most ``LAGS`` bytes before), which no filter of a few bytes can see; it is pooled
alike, and what it counts for is learned. The mean and the maximum of the chunks' pooled responses
make one probability. One-hot bytes make a filter a table of weights by byte, so a convolution is a
sum of look-ups.

Training is on the driver, on a bounded sample of labelled rows: ``SAMPLE`` documents, of each at
most ``CHUNKS`` chunks, spread evenly over all of it and cut out before they leave the executors.
Scoring is on all bytes of all documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessaria.llm.common import fold, no_clash, table, text_of

WIDTH, FILTERS, CELL = 6, 16, 512
#: Bounds of the training sample, passes over it, documents in a step, step size (four times it for the output).
SAMPLE, CHUNKS, EPOCHS, STEP, RATE = 2000, 5, 6, 32, 0.01
#: Steps that small samples are repeated for.
LEAST_STEPS = 300
FOLDS, THRESHOLD = 5, 0.3
#: Bytes convolved at once, and the longest period that the second channel sees.
PIECE, LAGS = 128 * CELL, 40


def periodic(data: np.ndarray) -> np.ndarray:
    """Along the last axis: 1 where the next 12 bytes equal those at a distance of up to LAGS before, and are not all zero."""
    n = data.shape[-1]
    out = np.zeros(data.shape, dtype=bool)
    for lag in range(1, min(LAGS, n - 12) + 1):
        e = data[..., lag:] == data[..., :-lag]
        e = e[..., 1:] & e[..., :-1]
        e = e[..., 2:] & e[..., :-2]
        e = e[..., 8:] & e[..., 4:-4] & e[..., :-8]
        out[..., lag : lag + e.shape[-1]] |= e
    return (out & (data != 0)).astype(np.float32)


@dataclass
class Model:
    """filters (WIDTH, 256, FILTERS), their bias, and the weights of mean and maximum with their bias."""

    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float

    def scorer(self):
        """A function from text to probability; filters are joined to tables by byte pair."""
        pairs = [(self.filters[k][:, None, :] + self.filters[k + 1][None, :, :]).reshape(65536, -1).astype(np.float32) for k in range(0, WIDTH, 2)]
        bias, out, out_bias = self.bias.astype(np.float32), self.out, self.out_bias

        def cells(data: np.ndarray) -> np.ndarray:
            """The maximum response of each filter in each cell of positions."""
            got = []
            for at in range(0, len(data) - WIDTH + 1, PIECE):
                part = data[at : at + PIECE + WIDTH - 1].astype(np.uint16)
                pair = part[:-1] * np.uint16(256) + part[1:]
                n = len(part) - WIDTH + 1
                response = pairs[0][pair[:n]]
                for k in range(1, len(pairs)):
                    response += pairs[k][pair[2 * k : 2 * k + n]]
                response = np.concatenate([response + bias, periodic(data[max(0, at - LAGS) : at + n + 11])[min(at, LAGS) :][:n, None]], axis=1)
                got.append(np.maximum.reduceat(response, np.arange(0, n, CELL), axis=0))
            return np.maximum(np.concatenate(got), 0)

        def score(text: str | None) -> float:
            raw = (text or "").encode("utf-8", "surrogatepass")
            data = np.frombuffer(raw + bytes(max(0, WIDTH - len(raw))), dtype=np.uint8)
            pooled = cells(data)
            if len(pooled) > 1:
                pooled = np.maximum(pooled[:-1], pooled[1:])
            z = float(np.concatenate([pooled.mean(0), pooled.max(0)]) @ out + out_bias)
            return 1 / (1 + np.exp(-np.clip(z, -50, 50)))

        return score


def _chunks(text: str | None, most: int = CHUNKS) -> np.ndarray:
    """Up to ``most`` chunks of a training text, spread evenly over all of it, padded with zeros."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = max(1, -(-len(raw) // CELL) - 1)
    picks = range(n) if n <= most else np.unique(np.linspace(0, n - 1, most).astype(int))
    out = np.zeros((len(picks), 2 * CELL), dtype=np.uint8)
    for row, j in enumerate(picks):
        part = raw[j * CELL : (j + 2) * CELL]
        out[row, : len(part)] = np.frombuffer(part, dtype=np.uint8)
    return out


def train(docs: list[np.ndarray], labels: list[int], seed: int = 7) -> Model:
    """A network fitted by Adam on documents' chunks; without rows of both labels a constant: their share, or one half."""
    rng = np.random.default_rng(seed)
    filters = rng.normal(0, 0.1, (WIDTH, 256, FILTERS)).astype(np.float32)
    model = Model(filters, np.zeros(FILTERS, np.float32), rng.normal(0, 0.1, 2 * FILTERS + 2).astype(np.float32), 0.0)
    if len(set(labels)) < 2:
        share = (sum(labels) + 0.5) / (len(labels) + 1)
        return Model(filters * 0, model.bias, model.out * 0, float(np.log(share / (1 - share))))
    y = np.asarray(labels, dtype=np.float32)
    model.out_bias = float(np.log(y.mean() / (1 - y.mean())))
    state = {k: [0.0, 0.0] for k in ("filters", "bias", "out", "out_bias")}
    step, each = 0, -(-len(docs) // STEP)
    for _ in range(max(EPOCHS, -(-LEAST_STEPS // each))):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), STEP):
            step += 1
            for name, grad in _gradients(model, [docs[i] for i in order[at : at + STEP]], y[order[at : at + STEP]]).items():
                m = state[name]
                m[0], m[1] = 0.9 * m[0] + 0.1 * grad, 0.99 * m[1] + 0.01 * grad * grad
                move = RATE * (4 if name.startswith("out") else 1) * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-6)
                setattr(model, name, getattr(model, name) - move)
    return model


def _gradients(model: Model, docs: list[np.ndarray], y: np.ndarray) -> dict[str, np.ndarray]:
    data = np.concatenate(docs)
    ends = np.cumsum([len(d) for d in docs])
    starts = ends - [len(d) for d in docs]
    n = data.shape[1] - WIDTH + 1
    response = model.filters[0][data[:, :n]]
    for k in range(1, WIDTH):
        response = response + model.filters[k][data[:, k : k + n]]
    inside = data[:, WIDTH - 1 :] != 0  # what lies beyond a text's end is no part of it
    inside[:, 0] = True
    response = np.where(inside[:, :, None], response, np.float32(-1e9))
    best = response.argmax(axis=1)  # (chunk, filter)
    pooled = np.maximum(np.take_along_axis(response, best[:, None, :], axis=1)[:, 0, :] + model.bias, 0)
    pooled = np.concatenate([pooled, periodic(data).max(axis=1)[:, None]], axis=1)
    lengths = (ends - starts)[:, None]
    mean, top = np.add.reduceat(pooled, starts, axis=0) / lengths, np.maximum.reduceat(pooled, starts, axis=0)
    z = np.concatenate([mean, top], axis=1) @ model.out + model.out_bias
    delta = (1 / (1 + np.exp(-z)) - y) / len(y)
    each = np.repeat(np.arange(len(docs)), lengths[:, 0])
    back = delta[each, None] * (model.out[: FILTERS + 1] / lengths[each] + model.out[FILTERS + 1 :] * (pooled == top[each]))
    back = (back * (pooled > 0))[:, :FILTERS]
    grad = np.zeros_like(model.filters)
    rows, cols = np.nonzero(back)
    for k in range(WIDTH):
        np.add.at(grad[k], (data[rows, best[rows, cols] + k], cols), back[rows, cols])
    return {"filters": grad, "bias": back.sum(0), "out": np.concatenate([mean, top], axis=1).T @ delta, "out_bias": delta.sum()}


@F.pandas_udf(T.BinaryType())
def _chunk_bytes(texts: pd.Series) -> pd.Series:
    return pd.Series([_chunks(t).tobytes() for t in texts], dtype=object)


def training_rows(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> list:
    """At most ``SAMPLE`` labelled rows (chunks, quality) outside the held-out fold, picked by a hash of the id, in a fixed order.

    An id whose labels differ has none, and of rows that repeat an id the one whose chunks come
    first counts. Labels without id or with another quality than 0 or 1 are left out.
    """
    named = labels.select(F.col("doc_id").alias("l_id"), F.col("quality").cast("int").alias("q")).filter(F.col("q").isin(0, 1) & F.col("l_id").isNotNull() & (fold("l_id", FOLDS) != 0))
    sure = named.groupBy("l_id").agg(F.min("q").alias("l_quality"), F.max("q").alias("most")).filter("l_quality = most")
    picked = sure.select("l_id", "l_quality").orderBy(F.xxhash64("l_id"), "l_id").limit(SAMPLE)
    texts = docs.select(F.col(id_col).alias("t_id"), text_of(text_col).alias("t"))
    rows = texts.join(F.broadcast(picked), F.col("t_id") == F.col("l_id")).select("l_id", "l_quality", _chunk_bytes("t").alias("chunks"))
    one = rows.groupBy("l_id").agg(F.min(F.struct("chunks", "l_quality")).alias("r")).select(F.xxhash64("l_id").alias("h"), "l_id", "r.*")
    return sorted(one.collect(), key=lambda r: (r.h, r.l_id))


def fitted(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> Model:
    """The network of the labelled rows of ``docs``.

    Null and empty texts are one chunk of zeros; repeated rows and labels count once. Empty tables,
    or labels of one kind only, give a constant.
    """
    rows = training_rows(docs, labels, text_col, id_col)
    return train([np.frombuffer(r.chunks, dtype=np.uint8).reshape(-1, 2 * CELL) for r in rows], [r.l_quality for r in rows])


def quality_score(model: Model, text: Column) -> Column:
    """The probability of label 1 for each text; null counts as empty, which has a score too."""
    scorers: list = []

    def score(texts: pd.Series) -> pd.Series:
        if not scorers:
            scorers.append(model.scorer())
        return pd.Series([scorers[0](t) for t in texts], dtype="float64")

    return F.pandas_udf(score, T.DoubleType())(text)


def keep_good(df: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``df`` without the rows that the classifier, fitted on ``labels``, rejects.

    Every row is judged by its whole text alone: rows that repeat stay or go together, null and
    empty texts are scored like any other, and an empty table stays empty. Columns of ``df`` may
    have any names; all of them stay.
    """
    n = no_clash(df, "score")
    model = fitted(df, labels, text_col, id_col)
    return df.withColumn(n["score"], quality_score(model, F.col(text_col))).filter(F.col(n["score"]) >= THRESHOLD).select(*df.columns)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document, from its bytes alone."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fitted(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", (fold("doc_id", FOLDS) == 0).alias("held_out"), quality_score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
