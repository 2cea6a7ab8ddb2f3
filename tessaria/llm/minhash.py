"""MinHash near-dedup by a multi-index Hamming join of b-bit signatures.

A signature has ``CHUNKS * CHUNK`` positions of ``BITS`` bits: the last bits of the least hash of a
text's shingles under one function after another. Two signatures' distance is the number of positions
in which they differ. They are split into ``CHUNKS`` chunks: by the pigeonhole principle, if at most
``RADIUS`` positions differ then some chunk has at most ``ERRORS`` of them. So a text enters, for
each chunk and each set of ``ERRORS`` positions that may be wrong, a bucket by the chunk's other
positions: all pairs within ``RADIUS`` meet, whatever positions differ.

Texts of a similarity J agree in a position with probability J. At the threshold of 0.85 a pair is
beyond the radius once in a million times, and even then meets in some chunk by itself: it has no
common bucket with a probability of (1 - J**5 - 5 * J**4 * (1 - J)) ** 12 = 4e-10, less for any
higher similarity. Members of buckets are compared on their whole sets (``linking.connect``), so no
link is found that isn't one.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessaria.llm import linking
from tessaria.llm.common import stored, table, text_of
from tessaria.llm.components import components

#: Words of a shingle, and the least similarity of two sets: 85 of 100.
RULE = linking.Likeness(17, 20, 5)
#: Chunks of a signature, positions of a chunk, bits of a position, positions of a chunk that may differ.
CHUNKS, CHUNK, BITS, ERRORS = 12, 5, 16, 1
#: Signatures that differ in no more positions than this share a bucket.
RADIUS = CHUNKS * (ERRORS + 1) - 1
#: Numbers that the hash functions and the buckets' keys are made from.
_made = np.random.default_rng(13)
FLIPS = _made.integers(0, 2**63, CHUNKS * CHUNK, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FACTORS = _made.integers(0, 2**63, CHUNKS * CHUNK, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Hashes that are put through all functions at a time.
PIECE = 4096


def words(text: str | None) -> bool:
    """Whether a text has any word."""
    return bool((text or "").encode("utf-8", "surrogatepass").split(None, 1))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The b-bit signature of a set's hashes, 16 bits a position."""
    least = np.full(CHUNKS * CHUNK, np.uint64(2**64 - 1))
    for at in range(0, len(hashes), PIECE):
        least = np.minimum(least, ((hashes[at : at + PIECE, None] ^ FLIPS) * FACTORS).min(axis=0))
    return (least & np.uint64((1 << BITS) - 1)).astype(np.uint16)


def distance(a: np.ndarray, b: np.ndarray) -> int:
    """In how many positions two signatures differ."""
    return int((a != b).sum())


def bucket_keys(signatures: np.ndarray) -> np.ndarray:
    """The buckets of each signature (a row each): one for each chunk and each choice of positions that may differ."""
    chunks = signatures.reshape(-1, CHUNKS, CHUNK).astype(np.uint64)
    out = []
    for k in range(CHUNKS):
        for wrong in combinations(range(CHUNK), ERRORS):
            key = np.zeros(len(chunks), dtype=np.uint64)
            for j in (j for j in range(CHUNK) if j not in wrong):
                key = (key << np.uint64(BITS)) | chunks[:, k, j]  # 64 bits in all: nothing is lost
            key = (key ^ np.uint64(len(out))) * MIX
            out.append((key ^ (key >> np.uint64(29))) * MIX + np.uint64(len(out)))
    return np.stack(out, axis=1)


def _sets(texts: pd.Series) -> pd.DataFrame:
    sizes, same, signatures, cells = [], [], [], []
    for t in texts:
        own = linking.shingles(t, RULE.words) if words(t) else set()
        h = np.sort(np.fromiter(own, dtype="<u8", count=len(own)))
        sizes.append(len(h))
        same.append(xxhash.xxh3_128_digest(h.tobytes()))
        signatures.append(signature(h).tobytes())
        cells.append(linking.parity(h))
    return pd.DataFrame({"n": pd.Series(sizes, dtype="int64"), "same": same, "signature": signatures, "parity": pd.Series(cells, dtype=object)})


def _keys(signatures: pd.Series) -> pd.Series:
    if not len(signatures):
        return pd.Series([], dtype=object)
    return pd.Series(list(bucket_keys(np.frombuffer(b"".join(signatures), dtype=np.uint16).reshape(-1, CHUNKS * CHUNK)).view(np.int64)), dtype=object)


sets = F.pandas_udf(_sets, T.StructType().add("n", "long").add("same", "binary").add("signature", "binary").add("parity", T.ArrayType(T.LongType())))
keys_of = F.pandas_udf(_keys, T.ArrayType(T.LongType()))


def near_groups(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``df``: links at a Jaccard similarity of 0.85 of five-word shingles.

    Words are what ASCII white space leaves, A-Z lower-cased; a text with fewer than five has the
    whole sequence as its only shingle. Null and empty texts, and others without a word, have an
    empty set and are linked with nothing: each is a component of its own. component_id is the
    smallest id reachable. Rows that repeat an id are nodes of their own, which repeats of the text
    link. Null ids name a component only if it has no other, and are not kept. Texts of any length
    count whole. An empty table has no rows. Other columns may have any names: none is kept.
    """
    of = [F.col("`" + c.replace("`", "``") + "`") for c in (id_col, text_col)]
    rows = stored(df.select(of[0].alias("id"), of[1].alias("text"), F.monotonically_increasing_id().alias("row")), "rows")
    own = F.struct(F.col("id").isNull().alias("no_id"), "id")
    keyed = stored(rows.select("row", "id", own.alias("own"), sets(text_of("text")).alias("s")).select("row", "id", "own", "s.*"), "sets")
    # rows of equal sets are one node, named by the first row
    nodes = keyed.filter("n > 0").groupBy("same").agg(F.min("row").alias("node"), F.min("own").alias("own"), F.min("n").alias("n"), F.min("signature").alias("signature"), F.min("parity").alias("parity"))
    nodes = stored(nodes.withColumn("tokens", keys_of("signature")), "nodes")
    shared = linking.shared_keys(nodes)
    held = nodes.select("node", "n", F.lit(0).alias("pos"), F.explode("tokens").alias("token")).join(linking.few(shared), "token")
    links = linking.connect(stored(held, "held"), nodes.select("node", "n", "parity"), rows.select(F.col("row").alias("t_row"), text_of("text").alias("t")), RULE)
    roots = stored(components(links, "a", "b"), "roots").select(F.col("node").alias("r_node"), "root")
    named = stored(nodes.select("same", "node", "own").join(roots, F.col("node") == F.col("r_node"), "left").select("same", "own", F.coalesce("root", "node").alias("group")), "named")
    least = stored(named.groupBy("group").agg(F.min("own.id").alias("component_id")).withColumnRenamed("group", "l_group"), "least")
    found = stored(named.join(least, F.col("group") == F.col("l_group")).select(F.col("same").alias("f_same"), "component_id"), "found")
    out = keyed.filter("n > 0").join(found, F.col("same") == F.col("f_same")).select("id", "n", "component_id")
    out = out.unionByName(keyed.filter("n = 0").select("id", "n", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document, by whole sets of five-word shingles."""
    return near_groups(table(spark, sf_dir, "documents"))


SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS shingle FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach AS (SELECT a AS doc_id, b AS other FROM link UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.other),
low AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least_id AS component_id, w.doc_id = least_id AS kept
FROM (SELECT w.doc_id, least(w.doc_id, coalesce(low.other, w.doc_id)) AS least_id FROM w LEFT JOIN low ON low.doc_id = w.doc_id) w LEFT JOIN n ON n.doc_id = w.doc_id
"""
