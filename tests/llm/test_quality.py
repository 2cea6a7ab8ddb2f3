"""The quality classifier: held-out accuracy, whole documents, gradients, odd rows."""

import numpy as np
from pyspark.sql import functions as F
from tests.llm.conftest import ODD

from tessaria.llm import quality as q


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    model = q.Model(rng.normal(0, 0.3, (q.WIDTH, 256, q.FILTERS)), rng.normal(0, 0.1, q.FILTERS), rng.normal(0, 0.3, 2 * q.FILTERS + 2), 0.1)
    texts = ("abc def " * 60, "zyx!! " * 40)
    docs, y = [q._chunks(t) for t in texts], np.array([1.0, 0.0])

    def loss():
        p = np.array([q.Model(model.filters, model.bias, model.out, model.out_bias).scorer()(t) for t in texts])
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    grads = q._gradients(model, docs, y)
    for name, at in (("bias", (3,)), ("out", (5,)), ("out", (q.FILTERS + 1 + 4,))):
        old = getattr(model, name)[at]
        ends = []
        for step in (1e-4, -1e-4):
            getattr(model, name)[at] = old + step
            ends.append(loss())
        getattr(model, name)[at] = old
        assert abs((ends[0] - ends[1]) / 2e-4 - grads[name][at]) < 2e-3


def test_every_byte_counts():
    model = q.Model(np.zeros((q.WIDTH, 256, q.FILTERS), np.float32), np.zeros(q.FILTERS, np.float32), np.zeros(2 * q.FILTERS + 2, np.float32), 0.0)
    model.filters[0, ord("!"), 0] = 1.0
    model.out[q.FILTERS + 1] = 5.0  # the maximum of that filter
    score = model.scorer()
    for n in (0, 5, q.CELL - 1, q.CELL, 3 * q.CELL, q.PIECE - 1, q.PIECE, q.PIECE + 1, 2 * q.PIECE + 77):
        plain = "a" * n
        assert score(plain) == 0.5
        for at in {0, n // 2, max(0, n - 1)} if n else ():
            assert score(plain[:at] + "!" + plain[at:] + "bbbbbb") > 0.9


def test_periodic():
    data = np.frombuffer(b"abcdefghijklmnopqrstuvw" + b"The The The The The The " + b"\0" * 30, dtype=np.uint8)
    got = q.periodic(data)
    assert got[:23].sum() == 0 and got[27:34].all() and got[-30:].sum() == 0


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    out = q.op6_quality(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert len(out) > 50 and np.mean([r.predicted == r.quality for r in out]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= q.THRESHOLD) for r in out)


def test_odd_rows_and_no_labels(spark, documents):
    rows = documents(ODD)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = q.fitted(rows, none)
    scores = [r[0] for r in rows.select(q.quality_score(model, F.col("text"))).collect()]
    assert scores == [0.5] * len(ODD)
    assert q.keep_good(rows, none).count() == len(ODD) and q.keep_good(rows, none).columns == rows.columns
    odd = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (None, 0, 0), (2, None, 1), (3, 7, 0)], "doc_id long, quality int, toxic int")
    assert q.keep_good(rows, odd).count() == len(ODD)
    assert q.keep_good(rows.limit(0), odd).count() == 0


def test_conflicting_labels_and_repeated_ids(spark, documents):
    """An id with two labels has none; of a repeated id's texts the one whose chunks come first counts, wherever the rows lie."""
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, 0), (4, 1)], "doc_id long, quality int")
    rows = documents(["b", "a", "z", "c", "d"], [2, 2, 1, 3, 4])
    for parts in (1, 5):
        got = q.training_rows(rows.repartition(parts), labels)
        assert {r.l_id: (r.chunks[:1], r.l_quality) for r in got} == {2: (b"a", 1), 3: (b"c", 0), 4: (b"d", 1)}


def test_scores_against_a_plain_version():
    """The scorer against the definition, one position, chunk and filter at a time."""
    rng = np.random.default_rng(3)
    model = q.Model(rng.normal(0, 0.3, (q.WIDTH, 256, q.FILTERS)).astype(np.float32), rng.normal(0, 0.1, q.FILTERS).astype(np.float32), rng.normal(0, 0.3, 2 * q.FILTERS + 2), 0.1)
    for text in ("", "ab", "plain words, of some length " * 7, "é漢字 " * 90 + "The " * 60, "x" * (q.CELL + 3) + "y" * (2 * q.CELL), "q" * (3 * q.CELL + q.WIDTH - 1)):
        raw = text.encode().ljust(q.WIDTH, b"\0")
        n = len(raw) - q.WIDTH + 1
        rows = []
        for at in range(n):
            same = at + 12 <= len(raw) and any(raw[at : at + 12] == raw[at - lag : at - lag + 12] for lag in range(1, q.LAGS + 1) if at >= lag)
            rows.append([*(sum(model.filters[k][raw[at + k]] for k in range(q.WIDTH)) + model.bias), float(same and raw[at] != 0)])
        cells = [np.maximum(np.max(rows[c : c + q.CELL], axis=0), 0) for c in range(0, n, q.CELL)]
        chunks = [np.maximum(a, b) for a, b in zip(cells, cells[1:])] or cells
        z = np.concatenate([np.mean(chunks, axis=0), np.max(chunks, axis=0)]) @ model.out + model.out_bias
        assert abs(model.scorer()(text) - 1 / (1 + np.exp(-z))) < 1e-5
