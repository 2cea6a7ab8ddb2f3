"""SimHash: fingerprints, the covering property, components and the near-duplicate stage against brute force."""

import random
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import functions as F
from tests.llm.conftest import ODD

from tessaria.llm import linking
from tessaria.llm import simhash as s


def brute_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    parts = [words[i : i + k] for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(b" ".join(p), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_fingerprints(spark):
    for t in [*ODD, "A b C d", "a b", "a  b\x0bc", "a\x1fb c d"]:
        assert s.fingerprint(t) == brute_fingerprint(t)
    h = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]  # the same hash as Spark's
    assert h % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", 42)


def test_masks_cover_every_set_of_positions():
    for free in ((1 << 64) - 1, 0xFFFF0000FF00F00F, 0xFF):
        masks = s.covering_masks(free, 3)
        bits = [1 << p for p in range(64) if free >> p & 1][:24]
        for group in combinations(bits, 3):
            flips = sum(group)
            assert any(m & flips == 0 for m in masks)
    assert min(m.bit_count() for m in s.covering_masks((1 << 64) - 1, 3)) >= 32


def components(values):
    names = list(range(len(values)))

    def find(i):
        while names[i] != i:
            i = names[i]
        return i

    for i, j in combinations(range(len(values)), 2):
        if (values[i] ^ values[j]).bit_count() <= 3:
            a, b = find(i), find(j)
            names[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_links_connect_what_the_radius_connects_even_in_hot_buckets(spark):
    rng = random.Random(3)
    seed = rng.getrandbits(64)
    values = {rng.getrandbits(64) for _ in range(200)}
    for _ in range(700):  # a dense cluster: many fingerprints around one, in few positions
        v = seed
        for p in rng.sample(range(20), rng.randint(0, 6)):
            v ^= 1 << p
        values.add(v)
    values = sorted(values)
    df = spark.createDataFrame([(s._signed(v),) for v in values], "fp long")
    links = [(a % (1 << 64), b % (1 << 64)) for a, b in s.radius_links(df).collect()]
    assert all((a ^ b).bit_count() <= 64 for a, b in links) and len(links) < 40 * len(values)
    at = {v: i for i, v in enumerate(values)}
    names = list(range(len(values)))

    def find(i):
        while names[i] != i:
            i = names[i]
        return i

    for a, b in links:
        x, y = find(at[a]), find(at[b])
        names[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(values))] == components(values)


def texts_with_copies(n=120):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(3000)]
    texts = []
    for i in range(n):
        t = rng.choice(words, rng.integers(60, 300)).tolist()
        texts.append(" ".join(t))
        if i % 4 == 0:
            for _ in range(int(rng.integers(1, 5))):
                u = list(t)
                for at in rng.choice(len(u), max(1, len(u) // 100), replace=False):
                    u[at] = f"changed{rng.integers(1e6)}"
                texts.append(" ".join(u))
    return texts


def test_components_of_a_table(documents):
    texts = ODD + texts_with_copies(40)
    ids = list(range(len(texts)))
    prints = [brute_fingerprint(t) for t in texts]
    want = components(prints)
    got = {r.doc_id: r for r in s.near_groups(documents(texts)).collect()}
    assert len(got) == len(texts)
    assert [got[i].component_id for i in ids] == want
    assert [got[i].fingerprint for i in ids] == [f"{p:016x}" for p in prints]


def test_stage_keeps_one_of_each_group_and_all_others(documents):
    texts = texts_with_copies()
    out = s.drop_near_duplicates(documents(texts))
    assert out.columns == documents(texts).columns
    kept = {r.doc_id for r in out.collect()}
    names = list(range(len(texts)))

    def find(i):
        while names[i] != i:
            i = names[i]
        return i

    links = 0
    for i, j in combinations(range(len(texts)), 2):
        if s.similarity(texts[i], texts[j]) >= s.NEAR_SIMILARITY:
            links += 1
            a, b = find(i), find(j)
            names[max(a, b)] = min(a, b)
    groups = {find(i) for i in range(len(texts))}
    assert links > 20 and groups == kept  # no group is lost, whatever is alone stays, and no link is missed


def test_components_with_a_heavy_root(spark):
    """A star, a long chain and small groups: the root with most links goes the broadcast way, the rest the other."""
    from tessaria.llm.components import components as connected

    star = [(5, 1000 + i) for i in range(3000)]
    chain = [(10_000 + i, 10_001 + i) for i in range(40)]
    rows = star + [(b, a) for a, b in chain] + [(9, 9), (20_000, 20_001), (20_001, 20_000), (1000, 4)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(rows, "a long, b long").repartition(5), "a", "b").collect()}
    want = {4: 4, 5: 4, 20_000: 20_000, 20_001: 20_000} | {1000 + i: 4 for i in range(3000)} | {10_000 + i: 10_000 for i in range(41)}
    assert got == want
    assert connected(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_covering_tables_seed_the_stage(documents, monkeypatch):
    """Pairs within the radius are linked before the prefix join, which only meets texts that are still apart."""
    seen = []
    real = s.radius_links
    monkeypatch.setattr(s, "radius_links", lambda fps, **k: seen.append(out := real(fps, **k)) or out)
    texts = [" ".join(f"w{i}x{j}" for j in range(600)) for i in range(4)]
    copies = [t.replace("x17 ", "x17b ") for t in texts]
    kept = {r.doc_id for r in s.drop_near_duplicates(documents(texts + copies)).collect()}
    assert kept == {0, 1, 2, 3} and seen[0].count() >= 1


def test_stage_on_odd_rows(documents):
    rows = documents(ODD + ["only here"], [None, None, 3, 4, 4, 5, 6, 7, 8, 9])
    clashing = rows.withColumns({"keep_row": rows.doc_id, "row": rows.text, "node": rows.source})
    out = s.drop_near_duplicates(clashing).collect()
    assert len(out) == 6  # blanks are alike, three spellings are alike
    assert s.drop_near_duplicates(rows.limit(0)).count() == 0 and s.near_groups(rows.limit(0)).count() == 0


def edited_texts(n=60):
    """Texts with one contiguous edit each, to a similarity just above 0.8, and others just below."""
    rng = np.random.default_rng(11)
    words = [f"v{i}" for i in range(4000)]
    pick = lambda k: rng.choice(words, k).tolist()
    texts = []
    for i in range(n):
        t = pick(int(rng.integers(100, 400)))
        m = len(t)
        appended, cut = t + pick(int(m * 0.22)), t[: int(m * 0.83)]
        block = t[: m // 3] + pick(int(m * 0.085)) + t[m // 3 + int(m * 0.085) :]
        below = t + pick(int(m * 0.3))
        texts += [" ".join(x) for x in (t, (appended, cut, block)[i % 3], below)]
    return texts


def test_stage_finds_contiguous_edits(documents):
    texts = edited_texts()
    alike = [(i, i + 1) for i in range(0, len(texts), 3) if 0.8 <= s.similarity(texts[i], texts[i + 1]) < 0.85]
    assert len(alike) > 50
    kept = {r.doc_id for r in s.drop_near_duplicates(documents(texts)).collect()}
    assert not [b for _, b in alike if b in kept]  # each is linked to the text before it, which has a smaller id
    assert all(i in kept for i in range(len(texts)) if i % 3 != 1)


def test_stage_is_exact_where_a_shingle_is_common(documents, monkeypatch):
    monkeypatch.setattr(s, "LIMIT", 8)
    monkeypatch.setattr(linking, "LIMIT", 8)
    rng = np.random.default_rng(12)
    line, words = [f"common{i}" for i in range(60)], [f"u{i}" for i in range(4000)]
    texts = []
    for i in range(150):  # pairs that share most with all others and are alike only to each other or to a few
        own = rng.choice(words, 22).tolist()
        texts.append(" ".join(line + own))
        if i % 3 == 0:
            texts.append(" ".join(line + own[:-2]))
            texts.append(" ".join(line[3:] + own))
    order = rng.permutation(len(texts))
    texts = [texts[i] for i in order]
    names = list(range(len(texts)))

    def find(i):
        while names[i] != i:
            i = names[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        if s.similarity(texts[i], texts[j]) >= s.NEAR_SIMILARITY:
            a, b = find(i), find(j)
            names[max(a, b)] = min(a, b)
    want = {find(i) for i in range(len(texts))}
    assert 100 < len(want) < len(texts)
    assert {r.doc_id for r in s.drop_near_duplicates(documents(texts)).collect()} == want
