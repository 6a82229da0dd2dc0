"""N-gram Jaccard join: a forest of sorted signature prefixes finds candidates, exact comparison verifies them.

A document is the set of its runs of five words (lower case, cut at white space; a shorter text is one run). Documents of equal
sets form a class, and only one of each class goes on. A class has ``trees`` signatures of independent minimum hashes, each
the path of the class in one prefix trie. Starting from the full depth, the matched prefix is shortened until two sets of the
wanted similarity share at least one prefix with the target probability; all classes below the same trie node are then
candidates. Candidates are united to clusters. A cluster is cut into blocks of bounded size and every two of its blocks meet in
one group, where all pairs are compared exactly and only counts and local roots come out, so that a cluster of near copies
never becomes rows of pairs.

Defined cases: null, empty and blank texts form one class without links; an id that comes with several texts has the links of
all of them; a text that only comes with null ids takes no part and keeps null results; repeated rows are copies. No frequent
run, bucket or cluster is left out. The only probabilistic step is the forest: see ``recall``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.components import components
from stayline.llm.token_counts import slices
from stayline.session import cut_lineage

RUN = 5
SIMILARITY = Fraction(4, 5)
TREES = 32
DEEPEST = 10
TARGET_RECALL = 0.9999
# A block of a cluster has about this many documents and word runs at most.
BLOCK_DOCS = 256
BLOCK_RUNS = 400_000
# Words a task remembers the hash of.
HELD_WORDS = 200_000


def recall(similarity: float, trees: int, depth: int) -> float:
    """Probability that two sets share a prefix of this depth in at least one tree."""
    return 1 - (1 - similarity**depth) ** trees


def matched_depth(similarity: float, trees: int = TREES, target: float = TARGET_RECALL, deepest: int = DEEPEST) -> int:
    """The longest prefix that still reaches the target, found by shortening."""
    depth = deepest
    while depth > 1 and recall(similarity, trees, depth) < target:
        depth -= 1
    return depth


class RunHasher:
    """Sets of word runs as sorted 64-bit hashes."""

    def __init__(self, run: int = RUN) -> None:
        self.run, self.known = run, {}

    def of(self, text: str | None) -> np.ndarray:
        words = text.lower().split() if text else []
        if not words:
            return np.empty(0, np.uint64)
        if len(self.known) > HELD_WORDS:
            self.known = {}
        known = self.known
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = max(1, len(words) - self.run + 1)
        out = np.full(n, min(len(words), self.run), np.uint64)
        for k in range(min(self.run, len(words))):
            out = (out ^ codes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(31)
        return np.unique(out)


def signatures(sets: list[np.ndarray], trees: int, depth: int, seed: int = 1) -> np.ndarray:
    """One hashed prefix per set and tree. Sets are not empty."""
    random = np.random.default_rng(seed)
    flips, factors = random.integers(0, 1 << 63, (2, trees, depth), dtype=np.uint64)
    flat = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), trees), np.uint64)
    for t in range(trees):
        path = np.full(len(sets), t + 1, np.uint64)
        for d in range(depth):
            mixed = (flat ^ flips[t, d]) * (factors[t, d] | np.uint64(1))
            mixed ^= mixed >> np.uint64(32)
            lowest = np.minimum.reduceat(mixed * np.uint64(0xD6E8FEB86659FD93), starts)
            path = (path ^ lowest) * np.uint64(0x9E3779B97F4A7C15)
            path ^= path >> np.uint64(29)
        out[:, t] = path
    return out.view(np.int64)


def sketches(docs: DataFrame, trees: int, depth: int, run: int = RUN) -> DataFrame:
    """Per row: doc_id, digest of the set, number of runs, hashed prefixes (none for an empty set)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = RunHasher(run)
        for batch in batches:
            digests, sizes, tags = [], [], []
            for texts in slices(batch.column("text").to_pylist()):
                sets = [hasher.of(text) for text in texts]
                digests += [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                sizes += [len(s) for s in sets]
                full = [s for s in sets if len(s)]
                paths = iter(signatures(full, trees, depth) if full else ())
                tags += [next(paths) if len(s) else np.empty(0, np.int64) for s in sets]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "digest": pa.array(digests, pa.binary()),
                    "n_runs": pa.array(sizes, pa.int64()),
                    "tags": pa.array(tags, pa.list_(pa.int64())),
                }
            )

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return columns.mapInArrow(sketch, "doc_id long, digest binary, n_runs long, tags array<long>")


def _clusters(classes: DataFrame) -> DataFrame:
    """Classes (class_id, tags) united where they share a trie node: (node, root) of those that share any."""
    placed = classes.select("class_id", F.explode("tags").alias("tag"))
    shared = placed.groupBy("tag").agg(F.min("class_id").alias("first"), F.max("class_id").alias("last")).where("first < last")
    edges = placed.join(shared, "tag").select(F.col("first").alias("a"), F.col("class_id").alias("b"))
    return components(edges)


def _intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left with every right set."""
    if len(left) * len(right) <= 32:
        return np.array([[len(np.intersect1d(a, b, assume_unique=True)) for b in right] for a in left])
    sizes = [len(s) for s in (*left, *right)]
    values, column = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    row, n = np.repeat(np.arange(len(sizes)), sizes), len(left)
    # Only values on both sides count; they are taken a few thousand at a time.
    both = np.intersect1d(np.unique(column[row < n]), np.unique(column[row >= n]), assume_unique=True)
    place = np.full(len(values), -1)
    place[both] = np.arange(len(both))
    row, column = row[place[column] >= 0], place[column[place[column] >= 0]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out, width = np.zeros((n, len(right)), np.float32), 4096
    for start in range(0, len(both), width):
        a, b = np.searchsorted(column, (start, start + width))
        dense = np.zeros((len(sizes), width), np.float32)
        dense[row[a:b], column[a:b] - start] = 1
        out += dense[:n] @ dense[n:].T
    return out.astype(np.int64)


def _linked(left: list[np.ndarray], right: list[np.ndarray], similarity: Fraction) -> np.ndarray:
    common = _intersections(left, right)
    a, b = np.array([len(s) for s in left]), np.array([len(s) for s in right])
    union = a[:, None] + b[None, :] - common
    return common * similarity.denominator >= similarity.numerator * union


def _compare(
    low: int, high: int, ids: list[int], blocks: list[int], sets: list[np.ndarray], similarity: Fraction
) -> list[tuple[int, int, int]]:
    """Of two blocks (or one with itself): id, number of links, smallest id that it reaches by links in here."""
    seen: dict[tuple[int, bytes], int] = {}
    for i, (x, s) in enumerate(zip(ids, sets, strict=True)):
        seen.setdefault((x, s.tobytes()), i)
    rows = list(seen.values())
    alone = low == high
    left, right = ([i for i in rows if blocks[i] == block] for block in (low, high))
    if not left or not right:
        return []
    links = _linked([sets[i] for i in left], [sets[i] for i in right], similarity)
    if alone:
        np.fill_diagonal(links, False)
    own, other = np.array([ids[i] for i in left]), np.array([ids[i] for i in right])
    least_left, least_right = own.copy(), other.copy()
    none = np.iinfo(np.int64).max
    while True:
        new_left = np.minimum(least_left, np.where(links, least_right[None, :], none).min(axis=1, initial=none))
        new_right = np.minimum(least_right, np.where(links, new_left[:, None], none).min(axis=0, initial=none))
        if (new_left == least_left).all() and (new_right == least_right).all():
            break
        least_left, least_right = (np.minimum(new_left, new_right),) * 2 if alone else (new_left, new_right)
    out = list(zip(own.tolist(), links.sum(axis=1).tolist(), least_left.tolist(), strict=True))
    if not alone:
        out += zip(other.tolist(), links.sum(axis=0).tolist(), least_right.tolist(), strict=True)
    return [x for x in out if x[1]]


def _verified(docs: DataFrame, members: DataFrame, similarity: Fraction, run: int) -> DataFrame:
    """Links of every candidate class, summed later: (class_id, n_links, root), from each two blocks of a cluster."""
    texts = docs.select(F.col("doc_id").cast("long").alias("class_id"), "text").join(members, "class_id")
    met = texts.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "cluster", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "class_id", "block", "text"
    )
    keys = ["cluster", "low", "high"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, at, held = RunHasher(run), None, ([], [], [])

        def result(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["class_id", "n_links", "root"]
            )

        found: list[tuple[int, int, int]] = []
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in (*keys, "class_id", "block", "text")), strict=True)
            for cluster, low, high, own, block, text in rows:
                if (cluster, low, high) != at:
                    if at is not None:
                        found += _compare(*at[1:], *held, similarity)
                    at, held = (cluster, low, high), ([], [], [])
                for part, value in zip(held, (own, block, hasher.of(text)), strict=True):
                    part.append(value)
            if found:
                yield result(found)
                found = []
        if at is not None:
            found += _compare(*at[1:], *held, similarity)
        yield result(found)

    return (
        met.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "class_id long, n_links long, root long")
    )


def join(
    docs: DataFrame,
    similarity: Fraction = SIMILARITY,
    run: int = RUN,
    trees: int = TREES,
    target_recall: float = TARGET_RECALL,
) -> DataFrame:
    """Per row of docs: doc_id, class_id (smallest id of equal sets), n_links (other classes at the similarity or above) and
    group_id (smallest id that links lead to)."""
    depth = matched_depth(float(similarity), trees, target_recall)
    rows = cut_lineage(sketches(docs, trees, depth, run))
    # Written, so that the join below has a shuffle of its own, in which the copies of one text can be split.
    ids = cut_lineage(rows.groupBy("digest").agg(F.min("doc_id").alias("class_id")))
    # One row of each class carries its signature: the row of its smallest id.
    named = cut_lineage(rows.join(ids, "digest").select("doc_id", "class_id", "n_runs", "tags"))
    classes = named.where("doc_id = class_id and n_runs > 0").dropDuplicates(["class_id", "n_runs", "tags"])
    clusters = cut_lineage(
        _clusters(classes).select(F.col("node").alias("class_id"), F.col("root").alias("cluster"))
    )
    sized = clusters.join(classes.groupBy("class_id").agg(F.sum("n_runs").alias("n_runs")), "class_id")
    blocks = sized.groupBy("cluster").agg(
        F.ceil(F.greatest(F.count("*") / F.lit(BLOCK_DOCS), F.sum("n_runs") / F.lit(BLOCK_RUNS))).alias("blocks")
    )
    members = clusters.join(blocks, "cluster").withColumn("block", F.pmod(F.xxhash64("class_id"), "blocks"))
    found = cut_lineage(_verified(docs, members, similarity, run))
    links = found.groupBy("class_id").agg(F.sum("n_links").alias("n_links"))
    groups = components(found.select(F.col("root").alias("a"), F.col("class_id").alias("b")))
    per_class = links.join(groups.toDF("class_id", "group_id"), "class_id", "left")
    return (
        named.select("doc_id", "class_id")
        .join(per_class, "class_id", "left")
        .select(
            "doc_id",
            "class_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("group_id", "class_id").alias("group_id"),
        )
    )


def one_of_each_group(docs: DataFrame, **options) -> DataFrame:
    """The document of the smallest id of every group, with the columns of docs; documents without an id all stay."""
    kept = join(docs, **options).where("doc_id = group_id").select(F.col("doc_id").alias("_kept")).distinct()
    whole = docs.select(F.struct("*").alias("_doc"), F.col("doc_id").cast("long").alias("_kept"))
    named = whole.join(kept, "_kept").dropDuplicates(["_kept"])
    return named.select("_doc.*").unionByName(docs.where("doc_id is null"))
