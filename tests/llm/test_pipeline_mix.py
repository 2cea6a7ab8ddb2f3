"""What the mix decides, packing follows: weights and the order of rows."""

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from tessaria.llm import mixing, packing  # noqa: E402


def queues(out, sources):
    """The ids of each source's documents in the order of its queue."""
    got = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        if r.start == 0:
            got.setdefault(sources[r.doc_id], []).append(r.doc_id)
    return got


@pytest.mark.parametrize("kind", ["files", "split files", "frame"])
def test_queues_follow_the_rows_that_the_mix_leaves(spark, documents, tmp_path, kind):
    # later files are larger, and a scan takes the largest first
    rows = documents([f"a b c {i} " * (1 + i) for i in range(120)], sources=[None if i % 5 == 0 else f"s{i % 2}" for i in range(120)])
    sources = {r.doc_id: r.source for r in rows.select("doc_id", "source").collect()}
    mixed = mixing.with_targets(rows.repartitionByRange(4, "doc_id").sortWithinPartitions("doc_id"), {None: 1, "s0": 2, "s1": 2})
    if kind != "frame":
        mixed.write.option("parquet.block.size", "4096").option("parquet.page.size", "1024").parquet(f"{tmp_path}/mixed")
        mixed = spark.read.parquet(f"{tmp_path}/mixed")
        assert len(mixed.inputFiles()) == 4
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    if kind == "split files":
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        out = corpus_pipeline.pack_stage(spark, mixed, "").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert queues(out, sources) == {s: [i for i in range(120) if sources[i] == s] for s in (None, "s0", "s1")}


def test_windows_hold_the_weights_that_the_mix_leaves(spark, documents, tmp_path):
    rows = documents(["word " * 600] * 120, sources=[None if i % 2 else "none" for i in range(120)])
    mixing.with_targets(mixing.mixed_order(rows, weights={None: 3, "none": 1}), {None: 3, "none": 1}).write.parquet(f"{tmp_path}/mixed")
    mixed = spark.read.parquet(f"{tmp_path}/mixed")
    assert mixed.columns == rows.columns and mixing.targets(mixed) == {None: 3, "none": 1} and mixing.targets(rows) is None
    out = corpus_pipeline.pack_stage(spark, mixed, "").collect()
    for w in range(60 * 601 * 4 // 3 // 4096 - 1):
        assert sum(r.length for r in out if r.sequence_id == w and r.doc_id % 2) == 3072


def test_empty_table_in_order(spark, documents):
    rows = documents(["x"]).limit(0)
    assert packing.pack(rows, packing.tokenizer_path(), in_order=True).collect() == []
    assert corpus_pipeline.pack_stage(spark, corpus_pipeline.mix_stage(spark, rows, ""), "").collect() == []


def test_mix_that_is_not_written_first(spark, documents, tmp_path):
    documents(["a b c " * (1 + i) for i in range(60)], sources=["x"] * 60).write.parquet(f"{tmp_path}/docs")
    mixed = corpus_pipeline.mix_stage(spark, spark.read.parquet(f"{tmp_path}/docs"), "")
    out = corpus_pipeline.pack_stage(spark, mixed, "").collect()
    assert queues(out, dict.fromkeys(range(60), "x")) == {"x": [r.doc_id for r in mixed.collect()]}
