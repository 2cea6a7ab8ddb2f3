"""The pipeline: each stage on its own input, and all of them in a row."""

from collections import Counter

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from tessaria.llm import mixing, simhash  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    from tessaria.llm.common import stored, table

    out = [table(spark, SF, "documents")]
    for name, f in corpus_pipeline.STAGES:
        out.append(stored(f(spark, out[-1], SF), name.split()[0]))
    return out


def test_stages(spark, stages):
    docs, good, exact, near, mixed, packed = stages
    assert all(s.columns == docs.columns for s in stages[:-1])
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in stages]
    assert ids[0] >= ids[1] >= ids[2] >= ids[3] == ids[4] == ids[5]
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    wrong = sum((i in ids[1]) != bool(q) for i, q in quality.items())
    assert wrong <= 0.1 * len(quality)
    texts = {r.doc_id: r.text for r in good.collect()}
    lowered = Counter(t.translate({c: c + 32 for c in range(65, 91)}) for t in texts.values())
    assert len(ids[2]) == len(lowered)
    left = [texts[i] for i in sorted(ids[3])]
    assert not any(simhash.similarity(left[i], left[j]) >= 0.8 for i in range(len(left)) for j in range(i))
    for i in ids[2] - ids[3]:
        assert any(simhash.similarity(texts[i], texts[j]) >= 0.8 for j in ids[2] if j != i)


def test_run(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == stages[-1].columns
    assert sum(r.length for r in got.collect()) == sum(r.length for r in stages[-1].collect())


def test_windows_hold_the_target_weights_in_the_order_of_the_mix(spark, documents):
    rows = documents(["word " * 600] * 240, sources=["big" if i % 8 else "small" for i in range(240)])
    targets = mixing.target_weights(rows)
    shares = {k: v / sum(targets.values()) for k, v in targets.items()}
    assert abs(shares["small"] - 1 / (1 + 7**0.5)) < 1e-3  # whole thousandths
    out = corpus_pipeline.pack_stage(spark, corpus_pipeline.mix_stage(spark, rows, ""), "").collect()
    windows = int(30 * 601 / 4096 / shares["small"]) - 1  # until the small source runs low
    assert windows > 5
    small = {r.doc_id for r in rows.filter("source = 'small'").collect()}
    for w in range(windows):
        here = [r for r in out if r.sequence_id == w]
        assert sum(r.length for r in here) == 4096
        assert abs(sum(r.length for r in here if r.doc_id in small) - 4096 * shares["small"]) < 2
    for ids in (small, set(range(240)) - small):
        packed = [r.doc_id for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)) if r.doc_id in ids and r.start == 0]
        assert packed == [r.doc_id for r in mixing.mix(rows).orderBy("m_slot", "m_start").collect() if r.doc_id in ids]
