"""The mix: windows, deviation, and nothing lost."""

from collections import Counter

import duckdb
import pytest
from tests.llm.conftest import ODD

from tessaria.llm import mixing


def test_every_slot_is_less_than_a_block_off(spark):
    due = spark.createDataFrame([("a", 501), ("b", 300), ("c", 150), ("d", 48), ("e", 1)], "m_key string, due long")
    plan = sorted(mixing.period(due).collect(), key=lambda r: r.m_slot)
    want, had = {r.m_key: r.m_due for r in plan}, Counter()
    q = sum(want.values())
    assert [r.m_slot for r in plan] == list(range(q)) and plan[0].m_period == q
    for t, r in enumerate(plan, 1):
        k = had[r.m_key]
        assert k * q // want[r.m_key] <= r.m_slot < -(-(k + 1) * q // want[r.m_key])  # released, and before its deadline
        had[r.m_key] += 1
        assert all(abs(had[s] - t * n / q) < 1 for s, n in want.items())


def held(plan, targets):
    """Every block of the plan lies in the window that its source's target alone gives it."""
    total = sum(targets.values())
    assert len({r.m_slot for r in plan}) == len(plan) == sum(v * plan[0].m_period // total for v in targets.values())
    for r in plan:
        w = targets[r.m_key]
        assert r.m_no * total // w <= r.m_slot < -(-(r.m_no + 1) * total // w)


def test_ten_thousand_sources(spark):
    targets = {f"k{i:05d}": 1 + (i % 97 == 0) * (i % 40) for i in range(10_000)}
    held(mixing.period(spark.createDataFrame(list(targets.items()), "m_key string, due long")).collect(), targets)


def test_weights_are_kept_as_given():
    assert mixing.whole_parts({"a": 0.5, "b": 0.3, "c": 0.2}) == {"a": 5, "b": 3, "c": 2}
    assert mixing.whole_parts({"a": 999, "b": 1, "c": 0}) == {"a": 999, "b": 1, "c": 0}
    assert mixing.whole_parts({"a": 0, None: 0}) == {"a": 0, None: 0} and mixing.whole_parts({}) == {}
    many = mixing.whole_parts({"a": 0.123456789, "b": 0.876543210, "c": 1e-12, "d": 0})
    assert sum(many.values()) == mixing.PERIOD and many["c"] == 1 and many["d"] == 0
    assert abs(many["a"] - 12345.6789) < 1 and abs(many["b"] - 87654.3210) < 1
    with pytest.raises(ValueError, match="negative"):
        mixing.whole_parts({"a": -1})


def test_deviation_from_the_given_weights(documents):
    """After any number of slots each source has had its given share of them, to less than one block."""
    weights = {"s0": 0.999, "s1": 0.001, "s2": 0}
    rows = documents(["x" * 10] * 3003, sources=[f"s{int(i % 100 == 0) if i < 2900 else 2}" for i in range(3003)])
    out = mixing.mix(rows, weights=weights, block_chars=10).collect()
    assert len(out) == 3003 and all(r.m_slot is None and r.m_release is None for r in out if r.source == "s2")
    by_slot = {r.m_slot: r.source for r in out if r.source != "s2"}
    had = Counter()
    for t in range(max(s for s in by_slot if by_slot[s] == "s0") + 1):
        had[by_slot.get(t)] += 1
        assert abs(had["s0"] - (t + 1) * 0.999) < 1 and abs(had["s1"] - (t + 1) * 0.001) < 1
    last = mixing.mixed_order(rows, weights=weights, block_chars=10).collect()[-103:]
    assert {r.source for r in last} == {"s2"}


def test_all_rows_stay_and_prefixes_hold_the_weights(documents):
    texts = ["x" * 100] * 900
    rows = documents(texts, sources=["big" if i % 3 else "small" for i in range(900)])
    out = mixing.mix(rows, weights={"big": 1, "small": 1}, block_chars=1000).orderBy("m_slot", "m_start").collect()
    assert sorted(r.doc_id for r in out) == list(range(900)) and out[0].score == "kept"
    first = Counter(r.source for r in out[:400])
    assert abs(first["small"] - 200) <= 20
    by_source = {}
    for r in out:
        by_source.setdefault(r.source, []).append(r.m_start)
    assert all(v == sorted(v) for v in by_source.values())


def test_odd_rows(documents):
    rows = documents(ODD, [None, None, 2, 2, 2, 5, 6, 7, 8], [None, "a", None, "a", "a", "b", "b", "c", "c"])
    assert sorted(r.text or "" for r in mixing.mix(rows).collect()) == sorted(t or "" for t in ODD)
    assert mixing.mixed_order(rows).columns == rows.columns and mixing.mixed_order(rows).count() == len(ODD)
    assert mixing.mix(rows.limit(0)).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_against_sql(spark, sf):
    d = f"/root/testdata/{sf}"
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    got = mixing.op3_mix_sources(spark, d)
    want = duckdb.sql(mixing.SQL).project(", ".join(got.columns)).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
