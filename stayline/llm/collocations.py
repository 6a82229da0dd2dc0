"""Phrases that occur together more often than their parts would let one expect, by exact counts of n-grams per language.

Texts become shards: id sequences of some two million words of one language with a word list of their own. Counting goes level by level, because a
phrase cannot be frequent unless both phrases of one word less in it are: a shard extends only what is frequent in the whole
corpus, counts its extensions in a counting quotient filter (``quotient_filter``) and hands it on in ranges of quotients. Each
range is one task's work: it merges the sorted filters of all shards, keeps the frequent entries, and answers every shard with
the entries of it that are frequent. So no dictionary and no table of phrases is broadcast or collected, each task sees its own shard or range
only, and a phrase however common is one entry a shard. The number of ranges follows the number of words.

Defined cases: null or empty texts have no words; a null language is ``und``; very long texts are cut where pieces end;
repeated rows count each; an empty table gives no rows; other columns are not read. Ties are broken as the ranking says.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.quotient_filter import Filter, merged
from stayline.session import cut_lineage

LEAST, LONGEST, TOP = 100, 5, 2000
SHARD_WORDS, RANGE_WORDS, BLOCK_BYTES = 2_000_000, 4_000_000, 4_000_000
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_ONE_BREAK = bytes.maketrans(_BREAKS, b"." * len(_BREAKS))
_NEXT_BREAK = re.compile(b"[.,;:!?\n-\r]")
_SHARD = "shard long, lang string"


def tokens(raw: bytes) -> list[bytes]:
    """Words with A-Z lower-cased, and a full stop, which no word holds, where a piece ends."""
    return raw.lower().translate(_ONE_BREAK).replace(b".", b" . ").split()


def blocks(raw: bytes) -> Iterator[bytes]:
    """A text, if it is long in parts that end with a piece."""
    at = 0
    while len(raw) - at > BLOCK_BYTES:
        found = _NEXT_BREAK.search(raw, at + BLOCK_BYTES)
        if not found:
            break
        yield raw[at : found.end()]
        at = found.end()
    yield raw[at:]


def shards(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """Id sequences (4 bytes a word, -1 between pieces) with the words they number and how often each is there."""

    class Held:
        def __init__(self) -> None:
            self.number: defaultdict[bytes, int] = defaultdict()
            self.number.default_factory = self.number.__len__
            self.number[b"."]  # noqa: B018  numbers the break as 0
            self.parts: list[np.ndarray] = []
            self.size = 0

        def add(self, raw: bytes) -> None:
            own = tokens(raw)
            own.append(b".")
            self.parts.append(np.fromiter(map(self.number.__getitem__, own), np.int32, len(own)))
            self.size += len(own)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, given = TaskContext.get().partitionId(), 0
        held: dict[str, Held] = {}

        def close(name: str) -> pa.RecordBatch:
            nonlocal given
            own = held.pop(name)
            line = np.concatenate(own.parts) - 1
            given += 1
            return pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([part << 32 | given], pa.int64()),
                    "lang": pa.array([name], pa.string()),
                    "line": pa.array([line.tobytes()], pa.binary()),
                    "words": pa.array([list(own.number)[1:]], pa.list_(pa.binary())),
                    "counts": pa.array([np.bincount(line + 1, minlength=len(own.number))[1:]], pa.list_(pa.int64())),
                }
            )

        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                for block in blocks(raw.as_py() or b""):
                    if not block:
                        continue
                    name = "und" if name is None else name
                    own = held.setdefault(name, Held())
                    own.add(block)
                    if own.size >= SHARD_WORDS:
                        yield close(name)
                if len(held) > 1 and sum(own.size for own in held.values()) >= 2 * SHARD_WORDS:
                    yield close(max(held, key=lambda x: held[x].size))
        for name in list(held):
            yield close(name)

    return docs.select(F.col(lang), F.col(text)).mapInArrow(
        cut, f"{_SHARD}, line binary, words array<binary>, counts array<bigint>"
    )


def numbered(words: DataFrame) -> DataFrame:
    """Adds dense ids. One count per task that wrote the words reaches the driver."""
    raw = cut_lineage(words.withColumn("_at", F.monotonically_increasing_id()))
    sizes = raw.groupBy(F.shiftright("_at", 33).alias("part")).count().orderBy("part").collect()
    starts = np.cumsum([0, *(r["count"] for r in sizes)])
    start = F.create_map(*(F.lit(x) for r, s in zip(sizes, starts, strict=False) for x in (r["part"], int(s)))) if sizes else F.lit(None)
    own = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    number = own + F.element_at(start, F.shiftright("_at", 33)) if sizes else own
    return raw.withColumn("id", number).drop("_at")


def collapsed(line: np.ndarray) -> np.ndarray:
    """The sequence with one -1 in place of several."""
    keep = line >= 0
    keep[1:] |= line[:-1] >= 0
    return line[keep]


def extended(line: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, Filter | None]:
    """From a sequence of places of frequent phrases (-1: none) and their word ids, the sequence of places of the phrases one
    word longer in their filter, and that filter."""
    left, right = line[:-1], line[1:]
    both = (left >= 0) & (right >= 0)
    pairs, first, which, counts = np.unique(
        left[both].astype(np.int64) << 32 | right[both], return_index=True, return_inverse=True, return_counts=True
    )
    out = np.full(len(left), -1, np.int32)
    if not len(pairs):
        return collapsed(out), None
    ids = np.concatenate([known[pairs >> 32], known[pairs & 0xFFFFFFFF][:, -1:]], axis=1)
    found, order = Filter.of(ids, counts)
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    out[both] = place[which]
    return collapsed(out), found


_EMITTED = f"{_SHARD}, line binary, number long, entries binary"


def _emit(shard: int, lang: str, line: np.ndarray, found: Filter | None, bits: int) -> pa.RecordBatch:
    own = found.ranges(bits) if found else []
    n = len(own) + 1
    return pa.RecordBatch.from_pydict(
        {
            "shard": pa.array([shard] * n, pa.int64()),
            "lang": pa.array([lang] * n, pa.string()),
            "line": pa.array([line.astype("<i4").tobytes(), *[None] * len(own)], pa.binary()),
            "number": pa.array([None, *(number for number, _ in own)], pa.int64()),
            "entries": pa.array([None, *(part.to_bytes(number, bits) for number, part in own)], pa.binary()),
        }
    )


def first_level(lines: DataFrame, bits: int) -> DataFrame:
    """Pairs of frequent words, from shards and the frequent ones of their words (``places``, ``ids``)."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                line = np.frombuffer(row["line"], "<i4")
                places, ids = np.array(row["places"], np.int64), np.array(row["ids"], np.int64)
                table = np.full(max(int(line.max(initial=0)), int(places.max(initial=0))) + 2, -1, np.int32)
                table[places] = np.arange(len(places), dtype=np.int32)
                # The last entry stands for -1, the break.
                yield _emit(row["shard"], row["lang"], *extended(collapsed(table[line]), ids[:, None]), bits)

    return lines.select("shard", "lang", "line", "places", "ids").mapInArrow(extend, _EMITTED)


def next_level(lines: DataFrame, bits: int) -> DataFrame:
    """Phrases one word longer, from the sequences of a level and the answers to their shards."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                line = np.frombuffer(row["line"], "<i4")
                answers = sorted(row["answers"], key=lambda a: a["number"])
                frequent = np.concatenate([np.unpackbits(np.frombuffer(a["flags"], np.uint8), count=a["n"]) for a in answers])
                table = np.full(len(frequent) + 1, -1, np.int32)
                chosen = np.flatnonzero(frequent)
                table[chosen] = np.arange(len(chosen), dtype=np.int32)
                kept = [Filter.from_bytes(a["entries"]).ids() for a in answers if a["entries"]]
                if kept:
                    yield _emit(row["shard"], row["lang"], *extended(collapsed(table[line]), np.concatenate(kept)), bits)

    return lines.select("shard", "lang", "line", "answers").mapInArrow(extend, _EMITTED)


_MERGED = "shard long, lang string, number long, n long, flags binary, entries binary, ids array<array<bigint>>, f array<bigint>"


def merged_ranges(emitted: DataFrame, bits: int, least: int) -> DataFrame:
    """The filters of all shards merged range by range: one row with the frequent phrases of a range and their counts, and one
    answer for each shard with flags for its entries and its frequent entries."""

    def merge(key, table):
        lang, number = key[0].as_py(), key[1].as_py()
        filters = [Filter.from_bytes(raw.as_py()) for raw in table.column("entries")]
        total, places = merged(filters)
        enough = total.counts >= least
        best = total.part(enough)
        rows = [{"lang": lang, "number": number, "ids": best.ids().tolist(), "f": best.counts.tolist()}]
        for shard, own, place in zip(table.column("shard").to_pylist(), filters, places, strict=True):
            flags = enough[place]
            rows.append(
                {
                    "shard": shard,
                    "lang": lang,
                    "number": number,
                    "n": len(own),
                    "flags": np.packbits(flags).tobytes(),
                    "entries": own.part(flags).to_bytes(number, bits) if flags.any() else None,
                }
            )
        return pa.Table.from_pylist(rows, schema=arrow)

    arrow = pa.schema(
        [
            ("shard", pa.int64()),
            ("lang", pa.string()),
            ("number", pa.int64()),
            ("n", pa.int64()),
            ("flags", pa.binary()),
            ("entries", pa.binary()),
            ("ids", pa.list_(pa.list_(pa.int64()))),
            ("f", pa.list_(pa.int64())),
        ]
    )
    return (
        emitted.where("number is not null")
        .select("shard", "lang", "number", "entries")
        .groupBy("lang", "number")
        .applyInArrow(merge, _MERGED)
    )


def counted(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, lang: str = "lang", text: str = "text"):
    """Words of each language (lang, word, f, id; all frequent ones), their total number by language, and all frequent phrases
    of 1 to ``longest`` words (lang, ids, f)."""
    lines = cut_lineage(shards(docs, lang, text))
    listed = lines.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "own"))
    counts = cut_lineage(
        listed.groupBy("lang", F.col("own.words").alias("word")).agg(F.sum("own.counts").alias("f"))
    )
    totals = cut_lineage(counts.groupBy("lang").agg(F.sum("f").alias("n")))
    words = cut_lineage(numbered(counts.where(F.col("f") >= least)))
    n_words = totals.agg(F.sum("n")).first()[0] or 0
    bits = max(int(n_words // RANGE_WORDS).bit_length(), 0)

    answers = (
        listed.select("shard", "lang", "place", F.col("own.words").alias("word"))
        .join(words.select("lang", "word", "id"), ["lang", "word"], "left")
        .groupBy("shard")
        .agg(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("place", "id"))).alias("own"))
        .select("shard", F.col("own.place").alias("places"), F.col("own.id").alias("ids"))
    )
    emitted = cut_lineage(first_level(lines.select("shard", "lang", "line").join(answers, "shard"), bits))
    phrases = words.select("lang", F.array("id").alias("ids"), "f")
    for size in range(2, longest + 1):
        ranges = cut_lineage(merged_ranges(emitted, bits, least))
        found = ranges.where("shard is null").select("lang", F.inline(F.arrays_zip("ids", "f")))
        phrases = phrases.unionByName(found.select("lang", "ids", "f"))
        if size < longest:
            replies = (
                ranges.where("shard is not null")
                .groupBy("shard")
                .agg(F.collect_list(F.struct("number", "n", "flags", "entries")).alias("answers"))
            )
            kept = emitted.where("line is not null").select("shard", "lang", "line")
            emitted = cut_lineage(next_level(kept.join(replies, "shard"), bits))
    return words, totals, cut_lineage(phrases)


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, lang: str = "lang", text: str = "text"
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of the cut that scores least, floor(1000 * a * n / (l * r)); ``n`` counts the words
    of the language. A phrase inside a longer candidate that is as frequent is left out.
    """
    words, totals, phrases = counted(docs, least, longest, lang, text)
    candidates = phrases.where(F.size("ids") > 1)

    def part(of, name: str) -> DataFrame:
        return phrases.select("lang", F.col("ids").alias(of), F.col("f").alias(name))

    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("ids") - 1))).withColumns(
        {"_left": F.expr("slice(ids, 1, k)"), "_right": F.expr("slice(ids, k + 1, size(ids) - k)")}
    )
    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("f", "n", "l", "r")}
    above = (F.lit(1000).cast("decimal(4,0)") * exact["f"]).cast("decimal(19,0)") * exact["n"]
    scored = (
        cuts.join(part("_left", "l"), ["lang", "_left"])
        .join(part("_right", "r"), ["lang", "_right"])
        .join(totals, "lang")
        .withColumns({"above": above.cast("decimal(38,0)"), "below": (exact["l"] * exact["r"]).cast("decimal(38,0)")})
        .withColumn("score", F.expr("above div below"))
        .groupBy("lang", "ids", F.col("f").alias("a"), "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "ids", "a", "n", "cut.score", "cut.l", "cut.r")
    )
    # A phrase within a longer one that is as frequent is also within one that is one word longer and as frequent.
    inside = (
        candidates.where(F.size("ids") > 2)
        .select("lang", F.explode(F.array(F.expr("slice(ids, 1, size(ids) - 1)"), F.expr("slice(ids, 2, size(ids) - 1)"))).alias("ids"), "f")
        .groupBy("lang", "ids")
        .agg(F.max("f").alias("longer"))
    )
    left = scored.join(inside, ["lang", "ids"], "left").where("longer is null or longer < a")
    by_numbers = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = cut_lineage(left.withColumn("_rank", F.rank().over(by_numbers)).where(F.col("_rank") <= top).drop("_rank", "longer"))
    spelled = (
        best.select("lang", "ids", F.posexplode("ids").alias("at", "id"))
        .join(words.select("lang", "id", F.col("word").cast("string").alias("word")), ["lang", "id"])
        .groupBy("lang", "ids")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    )
    ranked = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        best.join(spelled, ["lang", "ids"])
        .withColumn("rank", F.row_number().over(ranked).cast("long"))
        .where(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
