"""Tables that only lead to others: they leave the shared folder as soon as nothing reads them."""

import os
import re

import numpy as np
import pytest

from tessaria.llm import common, simhash
from tessaria.llm.common import passing, stored
from tessaria.llm.components import components


@pytest.fixture
def shared(tmp_path, monkeypatch):
    """What lies in the shared folder just now: labels of tables."""
    monkeypatch.setattr(common, "shared_dir", lambda _: f"file://{tmp_path}")
    return lambda: sorted(x.split("-")[0] for x in os.listdir(tmp_path))


def test_only_what_stays_is_left(spark, shared):
    with passing() as stays:
        stored(spark.range(3), "a")
        with passing() as on:
            b, c = on(stored(spark.range(4), "b")), stored(spark.range(5), "c")
            assert c.count() == 5 and shared() == ["a", "b", "c"]
        assert shared() == ["a", "b"]
        d = stored(spark.range(6), "d")
        with passing(d):
            assert d.count() == 6
        assert shared() == ["a", "b"]
        stays(b)
    assert shared() == ["b"] and b.count() == 4
    with pytest.raises(ZeroDivisionError), passing():
        stored(spark.range(3), "e")
        raise ZeroDivisionError
    assert shared() == ["b"]
    stored(spark.range(3), "f")
    assert shared() == ["b", "f"]


@pytest.mark.parametrize("seed", range(3))
def test_components_leave_their_last_table(spark, shared, monkeypatch, seed):
    most, kept = [], common.stored

    def watched(df, label):
        out = kept(df, label)
        most.append(len(shared()))
        return out

    monkeypatch.setattr("tessaria.llm.components.stored", watched)
    rnd = np.random.default_rng(seed)
    path = rnd.permutation(90).tolist()
    pairs = list(zip(path, path[1:], strict=False)) + [(200, 201), (201, 200), (205, 205), (210, 200)] + [(300, 301 + i) for i in range(40)] + [(400 + i, 499) for i in range(40)]
    pairs += [(600 + int(a), 600 + int(b)) for a, b in rnd.integers(0, 60, (50, 2))]
    root = {x: x for p in pairs if p[0] != p[1] for x in p}
    for _ in range(len(root)):
        for a, b in pairs:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    found = components(spark.createDataFrame(pairs, "x long, y long").repartition(3), "x", "y")
    assert shared() == ["least"] and max(most) <= 5
    rows = found.collect()
    assert len(rows) == len(root) and {r.node: r.root for r in rows} == root
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").collect() == []


def test_near_stage_leaves_what_its_result_reads(documents, shared):
    texts = [" ".join(f"w{(i * 7919 + k * k) % 100_003}" for k in range(60)) for i in range(40)]
    near = [re.sub(r"\w+$", "end", t) for t in texts[:20]]
    out = simhash.drop_near_duplicates(documents(texts + near + texts[:5]))
    assert shared() == ["buckets0", "least", "links", "prefixes", "repeats", "rows"]
    assert sorted(r.doc_id for r in out.collect()) == list(range(40))
