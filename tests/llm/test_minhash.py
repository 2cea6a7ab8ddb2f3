"""MinHash near-dedup: every pair within the radius shares a bucket, and the table's answer is that of all pairs."""

from itertools import combinations

import numpy as np
import pytest
from tests.llm.conftest import ODD

from tessaria.llm import linking
from tessaria.llm import minhash as m


def plain_set(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words)} if 0 < len(words) < 5 else {b" ".join(words[i : i + 5]) for i in range(len(words) - 4)}


def plain_groups(texts):
    sets, names, links = [plain_set(t) for t in texts], list(range(len(texts))), 0

    def find(i):
        while names[i] != i:
            i = names[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
            links += 1
            a, b = find(i), find(j)
            names[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))], [len(s) for s in sets], links


def test_pairs_within_the_radius_share_a_bucket():
    rnd = np.random.default_rng(3)
    width = m.CHUNKS * m.CHUNK
    for differ in (0, 1, 12, m.RADIUS):
        a = rnd.integers(0, 1 << m.BITS, (300, width), dtype=np.uint16)
        b = a.copy()
        for row in b:
            at = rnd.choice(width, differ, replace=False)
            row[at] ^= rnd.integers(1, 1 << m.BITS, differ, dtype=np.uint16)
        assert all(m.distance(x, y) == differ for x, y in zip(a, b, strict=True))
        assert all(len(set(x) & set(y)) for x, y in zip(m.bucket_keys(a), m.bucket_keys(b), strict=True))
    # the worst case: every chunk has as many wrong positions as its share, and one has one less
    b = a.copy().reshape(-1, m.CHUNKS, m.CHUNK)
    b[:, :, : m.ERRORS + 1] ^= 1
    b[:, 4, 0] ^= 1
    assert all(len(set(x) & set(y)) for x, y in zip(m.bucket_keys(a), m.bucket_keys(b.reshape(-1, width)), strict=True))
    far = rnd.integers(0, 1 << m.BITS, (300, width), dtype=np.uint16)
    assert not any(set(x) & set(y) for x, y in zip(m.bucket_keys(a), m.bucket_keys(far), strict=True))


def test_positions_agree_as_often_as_sets_do():
    rnd = np.random.default_rng(4)
    agreed = []
    for _ in range(60):
        h = rnd.integers(0, 2**64, 1000, dtype=np.uint64)
        a, b = h[:900], h[100:]  # 800 of 1000 are shared
        agreed.append(1 - m.distance(m.signature(a), m.signature(b)) / (m.CHUNKS * m.CHUNK))
    assert abs(np.mean(agreed) - 0.8) < 0.02
    assert (m.signature(h) == m.signature(rnd.permutation(h))).all() and len(m.signature(h[:0])) == m.CHUNKS * m.CHUNK


def edited(n, seed):
    """Texts with edits of every kind to a similarity on either side of 0.85."""
    rnd = np.random.default_rng(seed)
    words = [f"v{i}" for i in range(4000)]
    pick = lambda k: rnd.choice(words, k).tolist()
    texts = []
    for i in range(n):
        t = pick(int(rnd.integers(30, 300)))
        k = len(t)
        texts.append(t)
        for part in (0.13, 0.15, 0.19):
            more = max(1, round(k * part))
            if i % 3 == 0:
                texts.append(t + pick(more))
            elif i % 3 == 1:
                texts.append(t[: k - more])
            else:
                u = list(t)
                for at in rnd.choice(k, max(1, round(k * part / 10)), replace=False):
                    u[at] = f"c{rnd.integers(1e6)}"
                texts.append(u)
    return [" ".join(t) for t in texts]


def test_the_table_against_all_pairs(documents):
    texts = ODD + edited(60, 1) + ["a b c", "A  B\tc", "a b c d", " ", "a b c d e", "a b c d e a b c d e"]
    want, sizes, links = plain_groups(texts)
    assert links > 60
    table = documents(texts).withColumnsRenamed({"score": "token"}).selectExpr("*", "1 AS n", "2 AS row", "3 AS same", "4 AS component_id", "5 AS group", "6 AS node")
    got = {r.doc_id: r for r in m.near_groups(table).collect()}
    assert len(got) == len(texts)
    assert [got[i].component_id for i in range(len(texts))] == want
    assert [got[i].n_shingles for i in range(len(texts))] == sizes
    assert all(got[i].kept == (want[i] == i) for i in got)


@pytest.mark.parametrize("pairs", [1_000_000, 0])
def test_a_large_family_and_a_common_passage(documents, monkeypatch, pairs):
    monkeypatch.setattr(linking, "LIMIT", 8)
    monkeypatch.setattr(linking, "PARTNERS", 1)
    monkeypatch.setattr(linking, "BROADCAST_PAIRS", pairs)
    rnd = np.random.default_rng(12)
    words, line = [f"u{i}" for i in range(4000)], [f"common{i}" for i in range(60)]
    texts = []
    for i in range(60):
        own = rnd.choice(words, 12).tolist()
        texts.append(" ".join(line + own))
        if i % 3 == 0:
            texts += [" ".join(line + own[:-2]), " ".join(line[3:] + own)]
    texts += [texts[0]] * 40
    texts = [texts[i] for i in rnd.permutation(len(texts))]
    want, _, _ = plain_groups(texts)
    assert 20 < len(set(want)) < len(texts) - 45
    got = {r.doc_id: r.component_id for r in m.near_groups(documents(texts)).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_odd_ids_and_no_rows(documents):
    texts, ids = ["a b c d e f"] * 3 + [None, "", "x"], [None, 7, 7, None, 3, 3]
    got = m.near_groups(documents(texts, ids)).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in got), key=repr) == sorted([(None, 7, False), (7, 7, True), (7, 7, True), (None, None, False), (3, 3, True), (3, 3, True)], key=repr)
    assert m.near_groups(documents(texts).limit(0)).count() == 0
