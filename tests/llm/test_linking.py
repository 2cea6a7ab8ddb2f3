"""Keys dealt to cells: members of different groups meet once, and a large group isn't copied."""

from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from tessaria.llm import linking


@pytest.mark.parametrize("pairs", [1_000_000, 0])
def test_pairs_of_different_groups_meet_once(spark, monkeypatch, pairs):
    monkeypatch.setattr(linking, "LIMIT", 8)
    monkeypatch.setattr(linking, "BROADCAST_PAIRS", pairs)
    rnd = np.random.default_rng(2)
    keys = {1: [5] * 200 + [6, 7, 7], 2: list(range(60)), 3: [5, 6], 4: [9] * 50, 5: [1] * 30 + [2] * 30 + [3] * 5, 6: [4] * 8, 7: [4] * 7 + [8]}
    rows = [(token, token * 1000 + i, 10, 0, len(groups), group) for token, groups in keys.items() for i, group in enumerate(groups)]
    rows = [rows[i] for i in rnd.permutation(len(rows))]
    group = {node: g for _, node, _, _, _, g in rows}
    state = spark.createDataFrame(rows, "token long, node long, n long, pos long, size long, group long").repartition(5)
    cells = defaultdict(list)
    for r in linking._dealt(state).collect():
        cells[r.token, r.cell].append((r.node, r.part))
    met = Counter()
    for (_, cell), members in cells.items():
        for (a, p), (b, q) in combinations(sorted(members), 2):
            if group[a] != group[b] and (p != q or not cell.across):
                met[a, b] += 1
    want = {(a, b) for groups, at in ((g, k) for k, g in keys.items()) for a, b in combinations(range(at * 1000, at * 1000 + len(groups)), 2) if group[a] != group[b]}
    assert set(met) == want and set(met.values()) == {1}
    assert not any(token in (4, 6) for token, _ in cells)
    # the large group's members are in one cell each, only the three others are in all of its parts
    assert sum(len(m) for (token, _), m in cells.items() if token == 1) == 200 + 3 * 25 + 3


def test_no_rows(spark):
    state = spark.createDataFrame([], "token long, node long, n long, pos long, size long, group long")
    assert linking._dealt(state).collect() == []
