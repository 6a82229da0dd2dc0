"""Benchmark decontamination: training texts are scanned for word windows of test items.

Words are runs of characters other than ASCII punctuation, blanks and controls, with A-Z lowered. A test item gives its
windows of ``window`` consecutive words; an item of fewer words, but not none, is one window. Windows are broadcast as a
hash set of a stated size: larger test sets are cut into blocks of whole windows, and each block is one narrow pass over the
texts that adds its hits to those of the last. A hit of the 64-bit hash is verified word by word.

Defined cases: a null text or item has no words and no windows; a repeated item text gives its windows to each of its item
ids; a document is judged row by row, so repeated rows stay repeated; a null item id is ignored, since nothing could name
it; extra columns, whatever their names, are passed on by ``decontaminated`` and not read by ``contamination``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.session import cut_lineage

WINDOW = 10
# Windows of one broadcast block, the bound of what is broadcast; a few hundred bytes each in a task.
BLOCK_WINDOWS = 200_000

_KEEP = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def split_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_KEEP).split() if text else []


def item_windows(text: str | None, window: int = WINDOW) -> list[tuple[bytes, ...]]:
    words = split_words(text)
    if not words:
        return []
    return [tuple(words[i : i + window]) for i in range(max(1, len(words) - window + 1))]


def hashed_rows(runs: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every row of word numbers."""
    out = np.zeros(len(runs), dtype=np.uint64)
    for k in range(runs.shape[1]):
        out = (out + runs[:, k].astype(np.uint64) + np.uint64(1)) * _MULTIPLIER
        out ^= out >> np.uint64(29)
    return out


@dataclass
class WindowSet:
    """The windows of a block: word numbers, and by window length the sorted hashes, windows and items."""

    numbers: dict[bytes, int]
    by_length: dict[int, tuple[np.ndarray, np.ndarray, list[list]]]

    @classmethod
    def of(cls, items_of: dict[tuple[bytes, ...], set]) -> WindowSet:
        numbers: dict[bytes, int] = {}
        for window in items_of:
            for word in window:
                numbers.setdefault(word, len(numbers))
        by_length = {}
        for length in sorted({len(w) for w in items_of}):
            own = [w for w in items_of if len(w) == length]
            rows = np.array([[numbers[x] for x in w] for w in own], dtype=np.int64)
            hashes = hashed_rows(rows)
            order = np.argsort(hashes, kind="stable")
            by_length[length] = (hashes[order], rows[order], [sorted(items_of[own[i]]) for i in order])
        return cls(numbers, by_length)

    def scan(self, text: str | None) -> tuple[int, np.ndarray, set]:
        """Number of words, a mark for each word in an occurrence, and the items that occur."""
        words = split_words(text)
        ids = np.fromiter(map(self.numbers.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        hit, items = np.zeros(len(ids), dtype=bool), set()
        for length, (hashes, rows, owners) in self.by_length.items():
            if len(ids) < length:
                continue
            # Only runs of known words can be a window.
            known = np.concatenate(([0], np.cumsum(ids >= 0)))
            at = np.flatnonzero(known[length:] - known[:-length] == length)
            if not len(at):
                continue
            runs = ids[at[:, None] + np.arange(length)]
            keys = hashed_rows(runs)
            low, high = np.searchsorted(hashes, keys, "left"), np.searchsorted(hashes, keys, "right")
            for k in np.flatnonzero(high > low):
                for row in range(low[k], high[k]):
                    if np.array_equal(rows[row], runs[k]):
                        hit[at[k] : at[k] + length] = True
                        items.update(owners[row])
        return len(ids), hit, items


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.where("item_id is not null and text is not null").select("item_id", "text")


def window_blocks(benchmark: DataFrame, window: int, block_windows: int) -> Iterator[WindowSet]:
    """Blocks of at most ``block_windows`` windows; items come to the driver one partition at a time."""
    items_of: dict[tuple[bytes, ...], set] = {}
    held = 0
    for row in _items(benchmark).toLocalIterator():
        for found in item_windows(row["text"], window):
            held += row["item_id"] not in items_of.setdefault(found, set())
            items_of[found].add(row["item_id"])
            if held >= block_windows:
                yield WindowSet.of(items_of)
                items_of, held = {}, 0
    if items_of:
        yield WindowSet.of(items_of)


def _scan_block(df: DataFrame, windows: WindowSet) -> DataFrame:
    """Adds the hits of one block to what earlier blocks found; spans are hit word ranges as start, end, start, end ..."""
    # Plain values: a broadcast of the class would need this package on the executors.
    shared, names = df.sparkSession.sparkContext.broadcast((windows.numbers, windows.by_length)), df.columns

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = WindowSet(*shared.value)
        for batch in batches:
            out = {"n_words": [], "spans": [], "items": []}
            before = [batch.column(c) for c in ("spans", "items")]
            for at, text in enumerate(batch.column("_text")):
                n, hit, items = found.scan(text.as_py())
                for first, last in zip(*[iter(before[0][at].as_py())] * 2, strict=True):
                    hit[first:last] = True
                out["n_words"].append(n)
                out["spans"].append(edges(hit).tolist())
                out["items"].append(sorted(items.union(before[1][at].as_py())))
            own = {c: batch.column(c) for c in names if c not in out}
            yield pa.RecordBatch.from_pydict(own | {c: pa.array(v, batch.schema.field(c).type) for c, v in out.items()})

    return df.mapInArrow(scan, df.schema)


def edges(marks: np.ndarray) -> np.ndarray:
    """Starts and ends of the runs of true marks, in turn."""
    return np.flatnonzero(np.diff(np.concatenate(([0], marks.view(np.int8), [0]))))


def scanned(df: DataFrame, benchmark: DataFrame, window: int, block_windows: int) -> DataFrame:
    """df with a column ``_text`` gets ``n_words``, ``spans`` and ``items`` (ids, of the type they have). One narrow pass a block; the usual test set is one block."""
    spans, items = F.array().cast("array<bigint>"), F.array().cast(f"array<{dict(benchmark.dtypes)['item_id']}>")
    out = df.withColumns({"n_words": F.lit(0).cast("long"), "spans": spans, "items": items})
    blocks = window_blocks(benchmark, window, block_windows)
    out, more = _scan_block(out, next(blocks, WindowSet({}, {}))), next(blocks, None)
    while more is not None:
        # Written between two blocks, so that a task holds one block at a time.
        out, more = _scan_block(cut_lineage(out), more), next(blocks, None)
    return out


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS, key: str = "doc_id"
) -> DataFrame:
    """Per row of docs: the key, ``n_words``, ``n_hit``, ``items`` (ids, sorted), ``spans`` (word ranges, end excluded)."""
    found = scanned(docs.select(F.col(key).alias("_key"), F.col("text").alias("_text")), benchmark, window, block_windows)
    n_hit = F.aggregate(
        F.transform("spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("long"), lambda a, b: a + b
    )
    return found.select(F.col("_key").alias(key), "n_words", n_hit.alias("n_hit"), "items", "spans")


def digest(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """The counts with ``n_items`` and a digest of the item ids, sorted as strings."""
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return df.select(
        key,
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    max_share: float = 0.5,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Rows of docs with hit words cut out; a document goes as a whole when more than ``max_share`` of its words are hit.

    Text between two kept words stays as it is, and each cut leaves one blank. Documents without a hit are unchanged.
    """
    whole = docs.select(F.struct("*").alias("_doc"), F.col("text").alias("_text"))
    found = scanned(whole, benchmark, window, block_windows)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, texts = [], []
            rows = zip(*(batch.column(c) for c in ("_text", "n_words", "spans")), strict=True)
            for text, n, spans in ((t.as_py(), n.as_py(), s.as_py()) for t, n, s in rows):
                hits = sum(spans[1::2]) - sum(spans[::2])
                keep.append(hits <= max_share * n)
                texts.append(without(text, spans) if keep[-1] and hits else text)
            changed = pa.RecordBatch.from_pydict({"_doc": batch.column("_doc"), "_text": pa.array(texts, pa.string())})
            yield changed.filter(pa.array(keep, pa.bool_()))

    kept = found.mapInArrow(cut, whole.schema)
    return kept.select(F.col("_doc").withField("text", F.col("_text")).alias("_doc")).select("_doc.*")


def without(text: str, spans: list[int]) -> str:
    """The text with the words of the spans, and what stands between two of them, replaced by one blank."""
    raw = text.encode("utf-8", "surrogatepass")
    at_words = edges(np.frombuffer(raw.translate(_KEEP), dtype=np.uint8) != 32)
    starts, ends = at_words[::2], at_words[1::2]
    out, at = [], 0
    for first, last in zip(spans[::2], spans[1::2], strict=True):
        out += [raw[at : starts[first]], b" "]
        at = ends[last - 1]
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")
