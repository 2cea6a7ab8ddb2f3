"""Media columns: exact round trips, tar shards that tar can read, content addressing."""

import hashlib
import math
import tarfile
import zlib

import pytest
from tests.llm.conftest import ODD

from tessaria.llm import media


@pytest.mark.parametrize("raw", [b"", b"a", b"x" * 63, b"x" * 64, b"x" * 65, bytes(range(256)) * 999])
def test_round_trip(raw):
    full = media.payload(raw)
    assert len(full) % 64 == 0 and full and full[: len(raw)] == raw and len(full) - len(raw) in (range(64) if raw else (64,))
    medium = media.encode(full)
    assert media.decode(medium) == full
    assert media.header(medium[: media.HEADER]) == {"format": "png", "width": len(full) // 64, "height": 64, "bits": 8}


def test_not_a_medium():
    with pytest.raises(ValueError, match="not a PNG"):
        media.header(b"%PDF" * 9)


def test_store_and_read_back(spark, documents, tmp_path, monkeypatch):
    monkeypatch.setattr(media, "SHARD_BYTES", 2000)
    texts = ODD + [f"text {i} " * 50 for i in range(40)] + ["same text here"]
    ids = [None, *range(1, len(texts))]
    placed = media.store(documents(texts, ids), root=f"file://{tmp_path}")
    rows = media.with_content(media.with_metadata(placed)).collect()
    assert len(rows) == len(texts) and all(r.source for r in rows)
    by = {r.doc_id: r for r in rows}
    for i, t in zip(ids, texts, strict=True):
        full, r = media.payload((t or "").encode()), by[i]
        assert r.n_bytes == len((t or "").encode()) and r.media_content.payload_sha256 == hashlib.sha256(full).hexdigest() == r.digest
        assert r.media_content.tail_crc32 == zlib.crc32(full[-64:]) and r.media_header.width * 64 == len(full)
    assert by[3].shard == by[4].shard == by[len(texts) - 1].shard and by[3].offset == by[4].offset  # one content, one place
    for name in {r.shard for r in rows}:
        with tarfile.open(name.removeprefix("file://")) as tar:
            assert all(m.name == hashlib.sha256(media.decode(tar.extractfile(m).read())).hexdigest() + ".png" for m in tar)
    assert not list(tmp_path.glob("*.part"))


@pytest.mark.parametrize("rows_to_broadcast", [0, 200_000])
def test_copies_in_many_shards_name_one_place(spark, documents, tmp_path, monkeypatch, rows_to_broadcast):
    monkeypatch.setattr(media, "BROADCAST_ROWS", rows_to_broadcast)
    texts = ["hot copy"] * 60 + [f"warm {i % 4}" for i in range(40)] + ["one"]
    rows = media.with_content(media.store(documents(texts).repartition(7), root=f"file://{tmp_path}")).collect()
    places = {}
    for r in rows:
        places.setdefault(texts[r.doc_id], set()).add((r.shard, r.offset, r.length))
        assert r.media_content.payload_sha256 == hashlib.sha256(media.payload(texts[r.doc_id].encode())).hexdigest()
    assert len(rows) == len(texts) and all(len(p) == 1 for p in places.values())


def test_query(spark):
    d = "/root/testdata/sf0.001"
    rows = {r.doc_id: r for r in media.op4_media(spark, d).collect()}
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for doc in docs:
        full, r = media.payload((doc.text or "").encode()), rows[doc.doc_id]
        medium = media.encode(full)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len((doc.text or "").encode()), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-64:]))
        assert (r.media_bytes, r.media_sha256, r.length) == (len(medium), hashlib.sha256(medium).hexdigest(), len(medium))
        share = [full.count(b) / len(full) for b in range(256)]
        mean = sum(full) / len(full)
        got = dict(x.split("=") for x in r.feature.split(";")[2:])
        assert r.feature.startswith(f"png;{len(full) // 64}x64x8;") and float(got["max"]) == max(full)
        assert abs(float(got["mean"]) - mean) < 1e-3 and abs(float(got["std"]) - (sum((b - mean) ** 2 for b in full) / len(full)) ** 0.5) < 1e-3
        assert abs(float(got["entropy"]) + sum(p * math.log2(p) for p in share if p)) < 1e-3


def test_a_damaged_medium_is_noticed(documents, tmp_path):
    placed = media.store(documents(["some text"]), root=f"file://{tmp_path}")
    wrong = placed.withColumn("digest", placed.shard)
    with pytest.raises(Exception, match="does not hold"):
        media.with_content(wrong).collect()


def test_empty(documents, tmp_path):
    assert media.with_content(media.store(documents(["a"]).limit(0), root=f"file://{tmp_path}")).count() == 0
