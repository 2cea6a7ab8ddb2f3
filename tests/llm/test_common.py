"""Tables in the shared folder: what writing them leaves on local disks."""

import time

import pytest
from pyspark.sql import functions as F

from tessaria.llm import common, simhash
from tessaria.llm.common import FREED, shuffles_freed, stored


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getPath() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_stored_tables_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    df = spark.range(100_000).groupBy((F.col("id") % 30_000).alias("k")).agg(F.min("id").alias("m"))
    out = stored(df, "freed")
    deadline = time.time() + 15
    while (left := shuffle_files(spark) - before) and time.time() < deadline:
        time.sleep(0.2)
    assert not left
    assert out.agg(F.count("*"), F.sum("m")).first() == (30_000, 30_000 * 29_999 // 2)
    # the same frame can be written again
    assert stored(df, "freed").count() == 30_000


@pytest.mark.parametrize("own", [None, "false", "true"])
def test_the_setting_is_put_back(spark, own):
    if own is not None:
        spark.conf.set(FREED, own)
    try:
        with pytest.raises(ZeroDivisionError), shuffles_freed(spark):
            assert spark.conf.get(FREED) == "true"
            raise ZeroDivisionError
        assert spark.conf.get(FREED, None) == own
    finally:
        spark.conf.unset(FREED)


def test_near_stage_writes_prefixes_once(spark, tmp_path, documents, monkeypatch):
    monkeypatch.setattr(common, "shared_dir", lambda _: f"file://{tmp_path}")
    texts = [" ".join(f"w{(i * 7919 + k * k) % 100_003}" for k in range(600)) for i in range(300)]
    assert simhash.drop_near_duplicates(documents(texts + texts[:5])).count() == 300
    sizes = {}
    for f in tmp_path.rglob("*.parquet"):
        label = f.parent.name.split("-")[0]
        sizes[label] = sizes.get(label, 0) + f.stat().st_size
    # there is one copy of all prefixes, and nothing else comes near its size but the texts
    assert sum(v for k, v in sizes.items() if k not in ("rows", "prefixes")) < sizes["prefixes"]
