"""Whitening against plain numpy and exact integers, with odd vectors and tables without variance."""

import math

import numpy as np
import pytest

from tessaria.llm import whitening as w

SCHEMA = "vec_id long, embedding array<float>, label int, vec string, id string, component int, n long"


def vectors(spark, rows, ids=None):
    """The vectors, in three partitions, with extra columns that the operator's own might clash with."""
    return spark.createDataFrame([(i if ids is None else ids[i], None if v is None else [None if c is None else float(c) for c in v], 0, "v", "i", 1, 2) for i, v in enumerate(rows)], SCHEMA).repartition(3)


def plain(rows, components=32):
    """By id: (n, deviation), the eigenvalues, and centred vectors along the eigenvectors."""
    x = np.floor(64 * np.array(rows, dtype=np.float32).astype(np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), [sum(map(int, c)) for c in x.T]
    deviation = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    centred = x - np.array(sums) / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    return n, deviation, values[order], (centred @ basis)[:, order] / np.sqrt(values[order]), values.sum()


@pytest.mark.parametrize(("n", "dims"), [(400, 40), (60, 5)])
def test_against_numpy(spark, n, dims):
    rnd = np.random.default_rng(n)
    rows = (rnd.normal(size=(n, dims)) @ rnd.normal(size=(dims, dims)) + 3).astype(np.float32).tolist()
    got = w.whiten(vectors(spark, rows)).collect()
    count, deviation, values, white, trace = plain(rows)
    width = min(32, dims)
    assert len(got) == n * width and {r.component for r in got} == set(range(1, width + 1))
    signs = {}
    for r in got:
        assert r.n == count and int(r.deviation) == deviation[r.vec_id] and 0 <= r.identity_error < 1e-8
        assert math.isclose(r.explained, values[r.component - 1] / trace, rel_tol=1e-9)
        want = white[r.vec_id, r.component - 1]
        assert math.isclose(abs(r.whitened), abs(want), rel_tol=1e-6, abs_tol=1e-7)
        if abs(want) > 1e-3:
            signs.setdefault(r.component, set()).add(r.whitened * want > 0)
    assert all(len(s) == 1 for s in signs.values())


def test_unusable_vectors_are_left_out(spark):
    rnd = np.random.default_rng(1)
    good = rnd.normal(size=(50, 3)).astype(np.float32).tolist()
    odd = [None, [], [1, None, 2], [1, float("nan"), 2], [1, float("inf"), 2], [1, -math.inf, 2], [1, 2], [1, 2, 3, 4], [1e30, 0, 0]]
    got = w.whiten(vectors(spark, good + odd)).collect()
    assert {r.vec_id for r in got} == set(range(50)) and {r.n for r in got} == {50}
    count, deviation, *_ = plain(good)
    assert {r.vec_id: int(r.deviation) for r in got} == dict(enumerate(deviation))


def test_repeated_and_null_ids(spark):
    rows = [[1, 2], [1, 2], [3, 5], [4, 4], [4, 4]]
    got = w.whiten(vectors(spark, rows, [1, 1, None, 2, 1])).collect()
    assert len(got) == 10 and sum(r.vec_id is None for r in got) == 2 and sum(r.vec_id == 1 for r in got) == 6


def test_without_variance(spark):
    flat = w.whiten(vectors(spark, [[1, 2, 3]] * 5))
    assert flat.count() == 0 and flat.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert w.whiten(vectors(spark, [[1, 2, 3]])).count() == 0
    assert w.whiten(vectors(spark, [None, []])).count() == 0
    assert w.whiten(vectors(spark, [[0, 0]]).filter("false")).count() == 0
    # one direction only: the second dimension follows the first, the third is constant
    got = w.whiten(vectors(spark, [[i, 2 * i, 7] for i in range(10)])).collect()
    assert {r.component for r in got} == {1} and all(abs(r.explained - 1) < 1e-12 for r in got)


def test_large_numbers_stay_exact(spark):
    rows = [[2.0**40 * i, -(2.0**45), i] for i in range(1, 30)]
    got = w.whiten(vectors(spark, rows)).select("vec_id", "deviation").distinct().collect()
    _, deviation, *_ = plain(rows)
    assert {r.vec_id: int(r.deviation) for r in got} == dict(enumerate(deviation))


def test_the_whole_query(spark):
    got = w.op12_whitening(spark, "/root/testdata/sf0.001")
    table = {r.vec_id: r.embedding for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()}
    ids = sorted(table)
    count, deviation, values, white, trace = plain([table[i] for i in ids])
    rows = got.collect()
    assert dict(got.dtypes)["deviation"] == "bigint" and len(rows) == len(ids) * len({r.component for r in rows})
    for r in rows:
        at = ids.index(r.vec_id)
        assert r.deviation == deviation[at] and math.isclose(r.explained, values[r.component - 1] / trace, rel_tol=1e-6)
        assert math.isclose(abs(r.whitened), abs(white[at, r.component - 1]), rel_tol=1e-4, abs_tol=1e-4)
