"""Substring deduplication by content-defined chunks of a gear rolling hash.

A text is cut at word starts. The gear hash up to the end of a word depends on the last sixteen bytes only; a word is a cut
where that hash is the smallest among the ``radius`` words on either side. Cuts therefore depend on the content around them,
an insertion moves only the cuts next to it, and chunks have about twice the radius of words with little spread, so that a
passage of some fifty words holds several whole chunks wherever it stands. Chunks are compared by a 128-bit digest of their
bytes. A run of neighbouring chunks that all occur in other rows too is a repeated passage when it has ``min_words`` words. Of
equal chunks those in the row read first are the originals and stay.

Defined cases: null, empty and blank texts have no chunks; a text without a cut is one chunk; where hashes tie the first place
wins, and a stretch without cuts (one word repeated) is cut every ``longest`` words; repeated rows are told apart by a row
number that is written with the chunks, so the second one is a repeat of the first; ids may be null. First and last rows of a
digest are combined before the shuffle, a digest that occurs everywhere is an equi-join that can be split, and only chunks
that occur again are brought back to their row.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.session import cut_lineage

RADIUS = 3
LONGEST = 64
# A passage of over 50 words keeps far more than this many in whole chunks.
MIN_WORDS = 16
# Bytes that a gear hash of 64 bits still sees.
REACH = 16

_GEAR = np.random.default_rng(20240630).integers(0, 1 << 63, 256, dtype=np.uint64)


def gear_hashes(raw: np.ndarray) -> np.ndarray:
    """The rolling hash after every byte: each step shifts the hash by four bits and adds the gear of the byte, so the hash
    after byte i is the sum over the last sixteen bytes. Computed for all places at once."""
    gears = _GEAR[raw]
    out = gears.copy()
    for back in range(1, min(REACH, len(raw))):
        out[back:] += gears[:-back] << np.uint64(4 * back)
    return out


def chunk_starts(raw: bytes, radius: int = RADIUS, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets where chunks start, and the number of words of each chunk. White space before a word belongs to the chunk
    before it; leading white space to the first chunk."""
    data = np.frombuffer(raw, np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    starts = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1]))) if len(data) else np.empty(0, np.int64)
    n = len(starts)
    if not n:
        return starts, starts
    # The hash at a word start covers the word itself: its bytes and those before it.
    ends = np.append(starts[1:], len(data)) - 1
    key = gear_hashes(data)[ends]
    padded = np.concatenate((np.full(radius, np.iinfo(np.uint64).max), key, np.full(radius, np.iinfo(np.uint64).max)))
    windows = np.lib.stride_tricks.sliding_window_view(padded, 2 * radius + 1)
    lowest = (windows[:, :radius].min(axis=1) > key) & (windows[:, radius + 1 :].min(axis=1) >= key)
    # A word start is a cut only if all its neighbours are there: the text's own ends are no content.
    lowest[: min(radius, n)] = False
    lowest[max(0, n - radius) :] = False
    cuts = np.flatnonzero(lowest)
    bounds = np.unique(np.concatenate(([0], cuts)))
    gaps = np.diff(np.append(bounds, n))
    if gaps.max() > longest:
        bounds = np.concatenate([np.arange(b, b + g, longest) for b, g in zip(bounds, gaps, strict=True)])
    words = np.diff(np.append(bounds, n))
    at = starts[bounds]
    at[0] = 0
    return at, words


CHUNKED = "_row long, doc_id long, n_bytes int, starts array<int>, n_words array<int>, high array<long>, low array<long>"


def chunked(docs: DataFrame, radius: int = RADIUS, longest: int = LONGEST) -> DataFrame:
    """Per row of docs (_row, doc_id, text): where its chunks start, their words, and their digests in two halves."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def column(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
            offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
            flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))

        for batch in batches:
            sizes, starts, words, halves = [], [], [], []
            for text in batch.column("text"):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                at, n = chunk_starts(raw, radius, longest)
                bounds, view = [*at.tolist(), len(raw)], memoryview(raw)
                digests = (hashlib.blake2b(view[a:b], digest_size=16).digest() for a, b in itertools.pairwise(bounds))
                sizes.append(len(raw))
                starts.append(at)
                words.append(n)
                halves.append(np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2))
            yield pa.RecordBatch.from_pydict(
                {
                    "_row": batch.column("_row"),
                    "doc_id": batch.column("doc_id"),
                    "n_bytes": pa.array(sizes, pa.int32()),
                    "starts": column(starts, pa.int32()),
                    "n_words": column(words, pa.int32()),
                    "high": column([h[:, 0] for h in halves], pa.int64()),
                    "low": column([h[:, 1] for h in halves], pa.int64()),
                }
            )

    return docs.select("_row", F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, CHUNKED)


FOUND = "_row long, doc_id long, n_chunks long, n_words long, n_repeat_words long, n_removed_words long, removed array<int>"


def _marked(marks: DataFrame, min_words: int) -> DataFrame:
    """Runs of repeated chunks, from the chunks of a row and those of them that occur in other rows."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], [], [], []]
            columns = (batch.column(c).to_pylist() for c in ("n_bytes", "starts", "n_words", "again"))
            for n_bytes, starts, words, again in zip(*columns, strict=True):
                n_words = np.array(words, np.int64)
                repeated, removed = np.zeros(len(words), bool), np.zeros(len(words), bool)
                for found in again or ():
                    repeated[found["place"]] = True
                    removed[found["place"]] = not found["original"]
                edges = np.flatnonzero(np.diff(np.concatenate(([0], repeated.view(np.int8), [0]))))
                for a, b in zip(edges[::2], edges[1::2], strict=True):
                    if n_words[a:b].sum() < min_words:
                        repeated[a:b] = False
                removed &= repeated
                edges = np.flatnonzero(np.diff(np.concatenate(([0], removed.view(np.int8), [0]))))
                bounds = [*starts, n_bytes]
                values = (len(words), n_words.sum(), n_words[repeated].sum(), n_words[removed].sum())
                for column, value in zip(out, (*map(int, values), [bounds[e] for e in edges]), strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int32())]
            arrays = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
            names = "_row doc_id n_chunks n_words n_repeat_words n_removed_words removed".split()
            yield pa.RecordBatch.from_arrays([batch.column("_row"), batch.column("doc_id"), *arrays], names=names)

    return marks.mapInArrow(mark, FOUND)


def _repeats(numbered: DataFrame, min_words: int, radius: int, longest: int) -> DataFrame:
    rows = cut_lineage(chunked(numbered, radius, longest))
    placed = rows.select("_row", F.posexplode(F.arrays_zip("high", "low")).alias("place", "d")).select(
        "_row", "place", "d.high", "d.low"
    )
    # Written, so that the join below has a shuffle of its own, in which a frequent chunk can be split.
    shared = cut_lineage(
        placed.groupBy("high", "low")
        .agg(F.min("_row").alias("first"), F.max("_row").alias("last"))
        .where("first < last")
        .select("high", "low", "first")
    )
    again = (
        placed.join(shared, ["high", "low"])
        .groupBy("_row")
        .agg(F.collect_list(F.struct("place", (F.col("_row") == F.col("first")).alias("original"))).alias("again"))
    )
    marks = rows.select("_row", "doc_id", "n_bytes", "starts", "n_words").join(again, "_row", "left")
    return _marked(marks, min_words)


def repeats(
    docs: DataFrame, min_words: int = MIN_WORDS, radius: int = RADIUS, longest: int = LONGEST
) -> DataFrame:
    """Per row of docs: doc_id, chunks, words, words in repeated passages, words removed, removed byte ranges (start, end, ...)."""
    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("_row"))
    return _repeats(numbered, min_words, radius, longest).drop("_row")


def deduplicated(
    docs: DataFrame, min_words: int = MIN_WORDS, radius: int = RADIUS, longest: int = LONGEST
) -> DataFrame:
    """docs with every repeated passage cut out but where it was read first; all rows and columns stay."""
    whole = docs.select(F.struct("*").alias("_doc"), "doc_id", "text", F.monotonically_increasing_id().alias("_row"))
    numbered = cut_lineage(whole)
    found = _repeats(numbered, min_words, radius, longest).select("_row", "removed")
    joined = numbered.join(found, "_row").select("_doc", "text", "removed")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                without(text, spans)
                for text, spans in zip(*(batch.column(c).to_pylist() for c in ("text", "removed")), strict=True)
            ]
            yield pa.RecordBatch.from_pydict({"_doc": batch.column("_doc"), "text": pa.array(texts, pa.string())})

    changed = joined.mapInArrow(cut, joined.select("_doc", "text").schema)
    return changed.select(F.col("_doc").withField("text", F.col("text")).alias("_doc")).select("_doc.*")


def without(text: str | None, spans: list[int]) -> str | None:
    """The text without the byte ranges, which start and end at words."""
    if not spans:
        return text
    raw, at, out = text.encode("utf-8", "surrogatepass"), 0, []
    for a, b in zip(spans[::2], spans[1::2], strict=True):
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")
