"""Exact dedup against a dictionary, with groups that are heavy and groups that are not."""

import hashlib

import pytest
from tests.llm.conftest import ODD

from tessaria.llm import exact_dedup as x


def lowered(t):
    return (t or "").translate(str.maketrans(x_upper, x_upper.lower()))


x_upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(lowered(t), []).append(i)
    return {t: (max((i for i in g if i is not None), default=None), len(g)) for t, g in groups.items()}


def test_marks_every_row(documents):
    texts = ODD + ["hot"] * 300 + [f"t{i}" for i in range(500)] + ["İ", "i̇", "É", "é"]
    want = expected(list(enumerate(texts)))
    for share in (1 / 1000, 0.5):  # with and without heavy groups
        got = x.mark_duplicates(documents(texts), heavy_share=share).collect()
        assert len(got) == len(texts)
        for r in got:
            t = lowered(texts[r.doc_id])
            assert (r.keep_id, r.group_size) == want[t] and r.kept == (r.doc_id == r.keep_id)
            assert r.text_sha256 == hashlib.sha256(t.encode()).hexdigest()


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_drop_keeps_one_of_each(documents, monkeypatch, broadcast):
    monkeypatch.setattr(x, "BROADCAST_ROWS", broadcast)
    texts = ODD + ["hot"] * 300
    ids = [*range(len(texts) - 2), 5, None]  # a repeated id, a null id
    out = x.drop_duplicates(documents(texts, ids), heavy_share=0.2)
    assert out.columns == documents(texts).columns
    rows = out.collect()
    assert sorted(lowered(r.text) for r in rows) == sorted({lowered(t) for t in texts})
    want = expected(list(zip(ids, texts, strict=True)))
    assert all(r.doc_id == want[lowered(r.text)][0] for r in rows)


def test_repeated_rows_leave_one(documents):
    rows = documents(["a", "a", "a", "b"], [1, 1, 1, 2])
    assert sorted(r.doc_id for r in x.drop_duplicates(rows, heavy_share=0.3).collect()) == [1, 2]
    assert sorted(r.doc_id for r in x.drop_duplicates(rows, heavy_share=0.9).collect()) == [1, 2]
    assert [r.kept for r in x.mark_duplicates(rows).collect()] == [True] * 4


def test_heavy_digests_through_every_level(spark, monkeypatch):
    """Summaries of many tasks, merged two at a time, still name every heavy digest."""
    monkeypatch.setattr(x, "FAN_IN", 2)
    keys = spark.createDataFrame([(i, f"hot{i % 3}" if i % 2 else f"d{i}") for i in range(4000)], "id long, d string").repartition(13)
    got = {r.h_digest: (r.h_keep, r.h_size) for r in x.heavy_digests(keys, "d", "id", 0.05).collect()}
    want = {f"hot{k}": [i for i in range(4000) if i % 2 and i % 3 == k] for k in range(3)}
    assert got == {k: (max(v), len(v)) for k, v in want.items()}


def test_empty(documents):
    empty = documents(["a"]).limit(0)
    assert x.mark_duplicates(empty).count() == 0 and x.drop_duplicates(empty).count() == 0
