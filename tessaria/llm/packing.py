"""Mixture-controlled packing: deficit round-robin over source queues, in closed form.

Every window of ``WINDOW`` tokens takes from each source's queue its share of the window. A share
is rarely a whole number of tokens: what a source is owed but not served is its deficit, carried
to the next window. With shares p_1..p_n that sum to P (exact integers), and G(w) tokens in the
windows before w, source i has been served

    floor(G(w) * (p_1 + .. + p_i) / P) - floor(G(w) * (p_1 + .. + p_(i-1)) / P)

tokens: every window is full, every deficit stays below one token, and any partition computes
any window's deficits from w alone, so nothing is carried from task to task. Targets other than
the sources' own proportions hold until a source runs low; the others then keep theirs among
themselves. What none of these windows takes is packed by its own proportions, so that all queues
end together and only the last window has padding.

Tokenising writes each partition's ids, with the tokens of its source before each document, to
the shared folder. Only the tokens per (source, partition) are summed up to place a document in
its queue: texts and ids are never shuffled, not even if queues follow the order of the rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessaria.llm.common import shared_dir, stored, table, text_of

WINDOW, END = 4096, 2
VOCABULARY = "word_bpe_49k.json"
#: Words whose ids a worker remembers, in two generations of half this many.
REMEMBERED = 400_000
#: Rows of the (source, partition) table that may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000
#: Characters whose words can be encoded one by one: no combining marks, nothing that normalisation joins or contextual case.
PLAIN = "\t\n\x0b\x0c\r -~\xa1-\xac\xae-\xffĀ-įĲ-ž"


#: The tokenizer's own split, over plain lower-case words: contractions, letters, single digits, all else.
LETTERS, DIGITS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xffĀ-ž", "0-9\xb2\xb3\xb9\xbc-\xbe"
PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^{LETTERS}{DIGITS}]+")


def _byte_letters() -> dict[int, str]:
    """What byte-level vocabularies write for each byte: itself if it is visible, else a letter from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (c for c in range(256) if c not in visible)
    return {c: chr(c) for c in visible} | {c: chr(256 + i) for i, c in enumerate(rest)}


class Remembered(dict):
    """Finds what is missing and keeps it; when full, it keeps what is asked for again."""

    def __init__(self, find):
        super().__init__()
        self.find, self.old = find, {}

    def __missing__(self, word: str) -> bytes:
        got = self.old.get(word)
        self[word] = got = self.find(word) if got is None else got
        return got

    def trim(self) -> None:
        if len(self) > REMEMBERED // 2:
            self.old = dict(self)
            self.clear()


class WordIds:
    """Ids of texts as 16-bit numbers, found once for each white-space separated word and each of its parts.

    The tokenizer splits at white space and drops it, and no token spans it, so a text's ids are
    those of its words in order, and a word's those of its parts. Texts that hold an added token,
    or characters that normalisation may change, go through the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # tokens added to the vocabulary are found in the text before it is split into words
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        model, letters = self.tokenizer.model, _byte_letters()
        self.plain = re.compile(f"[{PLAIN}]*").fullmatch
        self.parts = Remembered(lambda part: np.asarray([t.id for t in model.tokenize(part.encode().decode("latin-1").translate(letters))], dtype="<u2").tobytes())
        self.words = Remembered(lambda word: b"".join(map(self.parts.__getitem__, PARTS.findall(word))))

    def of(self, text: str) -> np.ndarray:
        """All ids of a text."""
        low = text.lower()
        if not self.plain(text) or any(t in low for t in self.added):
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u2")
        self.parts.trim()
        self.words.trim()
        return np.frombuffer(b"".join(map(self.words.__getitem__, low.split())), dtype="<u2")


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """A worker's word ids, which its next tasks find filled."""
    return WordIds(path)


def _at_place(df: DataFrame, columns: list[Column]) -> DataFrame:
    """The columns of ``df``, and the file and the first byte of the piece of it that a row is read from.

    Partitions of a scan don't follow the order of files. Rows that come from several tables are
    not read but shuffled, and their partitions do: for them both are constant.
    """
    try:
        return df.select(*columns, F.input_file_name().alias("file"), F.input_file_block_start().alias("block"))
    except AnalysisException:
        return df.select(*columns, F.lit("").alias("file"), F.lit(-1).cast("bigint").alias("block"))


def tokenised(df: DataFrame, source_col: str, text_col: str, id_col: str, path: str, in_order: bool = False) -> DataFrame:
    """(doc_id, source, part, before, tokens, ids): ids end with ``END``; before counts its source's tokens in the partition.

    ``in_order`` also gives (file, block), see ``_at_place``, and before counts in these.
    """
    carried = ["file", "block"] if in_order else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, before = word_ids(path), TaskContext.get().partitionId(), {}
        for batch in batches:
            ids, lengths, starts = [], [], []
            sources = batch.column("source").to_pylist()
            queues = zip(sources, *(batch.column(c).to_pylist() for c in carried), strict=True)
            for queue, text in zip(queues, batch.column("text"), strict=True):
                own = words.of(text.as_py())
                n = len(own) + 1
                starts.append(before.get(queue, 0))
                before[queue] = starts[-1] + n
                lengths.append(n)
                ids.append(own.tobytes() + END.to_bytes(2, "little"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sources, pa.string()), pa.array([part] * len(ids), pa.int64()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.binary()), *map(batch.column, carried)],
                names=["doc_id", "source", "part", "before", "tokens", "ids", *carried],
            )

    columns = [F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.concat(F.lit("s:"), F.col(source_col)), F.lit("none")).alias("source"), text_of(text_col).alias("text")]
    rows = _at_place(df, columns) if in_order else df.select(*columns)
    return rows.mapInArrow(run, "doc_id bigint, source string, part bigint, before bigint, tokens bigint, ids binary" + ", file string, block bigint" * in_order)


class Mixture:
    """Where each source's tokens go: windows of a target mixture, then windows of what is left.

    ``totals`` has the tokens of each source in a fixed order, ``weights`` their target weights
    (None: the sources' own proportions).
    """

    def __init__(self, totals: list[int], weights: list[int] | None = None, window: int = WINDOW):
        self.window, self.phases = window, []  # (first window, first token, tokens, prefix sums of shares, served before by source)
        served, at = [0] * len(totals), 0
        active = [0] * len(totals) if weights is None else list(weights)
        while share := sum(active):
            windows = [(t - s - 1) * share // w // window if w else None for t, s, w in zip(totals, served, active, strict=True)]
            full = min(x for x in windows if x is not None)
            if full < 1:  # a source has less left than a window takes
                active = [0 if x is not None and x < 1 else w for x, w in zip(windows, active, strict=True)]
                continue
            prefix = self._prefix(active)
            self.phases.append((at, at * window, full * window, prefix, served))
            at, served = at + full, [s + self._cut(full * window, prefix, i) for i, s in enumerate(served)]
        left = [t - s for t, s in zip(totals, served, strict=True)]
        if sum(left):
            self.phases.append((at, at * window, sum(left), self._prefix(left), served))

    @staticmethod
    def _prefix(shares: list[int]) -> list[int]:
        out = [0]
        for s in shares:
            out.append(out[-1] + s)
        return out

    @staticmethod
    def _cut(tokens: int, prefix: list[int], i: int) -> int:
        return tokens * prefix[i + 1] // prefix[-1] - tokens * prefix[i] // prefix[-1]

    def pieces(self, i: int, start: int, length: int) -> Iterator[tuple[int, int, int, int]]:
        """(start in the document, length, sequence, offset) of tokens start..start+length of source ``i``'s queue."""
        done = 0
        for first, _, tokens, prefix, served in self.phases:
            share = prefix[i + 1] - prefix[i]
            end = served[i] + self._cut(tokens, prefix, i)
            if not share or start + done >= end:
                continue

            def given(w: int, tokens=tokens, prefix=prefix, served=served) -> int:
                return served[i] + self._cut(min(w * self.window, tokens), prefix, i)

            w = max(0, (start + done - served[i] - 1) * prefix[-1] // share // self.window)
            while w and given(w) > start + done:
                w -= 1
            while done < length and start + done < end:
                while given(w + 1) <= start + done:
                    w += 1
                n = min(length - done, given(w + 1) - start - done)
                here = min((w + 1) * self.window, tokens) * prefix[i] // prefix[-1] - min(w * self.window, tokens) * prefix[i] // prefix[-1]
                yield done, n, first + w, here + start + done - given(w)
                done += n
            if done == length:
                return


def pack(
    df: DataFrame,
    path: str,
    source_col: str = "source",
    text_col: str = "text",
    id_col: str = "doc_id",
    weights: dict[str | None, int] | None = None,
    with_ids: bool = False,
    in_order: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and the ids).

    ``path`` is the vocabulary file of a public tokenizer with under 65,536 ids. Null and empty
    texts have one token, the end; null sources are a source of their own; repeated rows are
    packed as often as they occur; an empty table gives an empty result. A null id stays null.
    Queues follow the scan; ``in_order`` they follow the rows: of a table that is read from files,
    as Spark numbers the files it writes, else of the partitions.
    """
    spark = df.sparkSession
    shared_dir(spark)
    ids = stored(tokenised(df, source_col, text_col, id_col, path, in_order), "tokens")
    pieces = ["source", "file", "block", "part"] if in_order else ["source", "part"]
    parts = ids.groupBy(*pieces).agg(F.sum("tokens").alias("n"))
    # numbers of files have five digits or more
    queue = W.partitionBy("source").orderBy(*[F.length("file"), "file", "block"] * in_order, "part")
    bases = stored(parts.select(*[F.col(c).alias(f"b_{c}") for c in pieces], (F.sum("n").over(queue) - F.col("n")).alias("base"), "n"), "queues")
    totals = {r[0]: r[1] for r in bases.groupBy("b_source").agg(F.sum("n")).collect()}  # a row for each source
    names = sorted(totals)
    named = None if weights is None else {"none" if k is None else f"s:{k}": v for k, v in weights.items()}
    mixture = Mixture([totals[s] for s in names], None if named is None else [named.get(s, 0) for s in names])
    index = {s: i for i, s in enumerate(names)}
    small = bases.count() <= BROADCAST_ROWS
    placed = ids.join(F.broadcast(bases) if small else bases, [F.col(c) == F.col(f"b_{c}") for c in pieces])
    placed = placed.select("doc_id", "source", (F.col("base") + F.col("before")).alias("at"), "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")}
            for doc, source, at, raw in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "source", "at", "ids")), strict=True):
                own = np.frombuffer(raw, dtype="<u2").astype("<u4")
                for start, n, window, offset in mixture.pieces(index[source], at, len(own)):
                    piece = own[start : start + n].tobytes()
                    for k, v in zip(out, (doc, start, n, zlib.crc32(piece), len(own), window, offset, piece if with_ids else None), strict=True):
                        out[k].append(v)
            yield pa.RecordBatch.from_pandas(pd.DataFrame({k: out[k] for k in out if k != "ids" or with_ids}), schema=arrow, preserve_index=False)

    arrow = pa.schema([(k, pa.int64()) for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")] + [("ids", pa.binary())] * with_ids)
    return placed.mapInArrow(run, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint" + ", ids binary" * with_ids)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in windows that all hold the corpus's own mixture of sources."""
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())
