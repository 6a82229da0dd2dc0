"""Repair of conversations as a search for the lightest derivation.

An item says that some rows of a conversation were edited and that the roles put out so far leave an automaton in a state; its
weight is the pair (cost, audit), the audit being the initials of the edits in order. Edits are deductions from one item to the
next, and two items whose states meet are joined by a deduction with two antecedents. Both add costs and put audits together,
so a conclusion is never lighter than its antecedents and grows with them (superior functions): items popped from the agenda by rising weight
are final, and the first goal item popped is the lightest repair. Two derivations of one item that cost the same never have
audits of which one begins the other (that would take a further insertion), so the order of audits survives what is added.

A conversation of any length is spread: rows are laid out by range of (conversation, turn, role, text), every task cuts what it
holds of a conversation into blocks of ``BLOCK`` rows and runs one agenda per block and state it may be entered in. The blocks of a
conversation are then joined in order, which needs at most sixteen weights a block and no text. Equal rows are put together, batch by batch, before
any of this. Texts are compared by their SHA-256 where a conversation repeats itself.

Roles put out follow ``(s?(ua)+)?`` by their initials. Defined cases: a null role or text is one blank; a null conversation id
is a conversation of its own; rows of one turn are taken by role and text, null turns first; a role of no letter that the automaton knows
can be deleted or renamed only; a conversation whose rows are all gone (``copies`` 0) has an empty repair; an empty table gives no
rows; further columns are not read. Spans of turns that pass 64 bits wrap.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from stayline.session import cut_lineage

BLOCK = 128
BLANKS = " \t\n\x0b\f\r"
# Costs of the edits; keeping a row is free.
RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# States: nothing put out, after system, after user, after assistant; where each initial leads.
NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
GOALS = (0, 3)
LEGAL = frozenset(("su", "ua", "au"))
SOUND, CUT_OFF, SPOILT = 0, 1, 2

Row = tuple[str, int, int]  # initial of the role, fault, further copies
Weight = tuple[int, str]


def lightest(rows: list[Row], start: int, goal: bool = False) -> dict[int, Weight]:
    """The weight of the lightest derivation over all rows by the state it ends in; with ``goal`` only that of the goal item."""
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, start)]
    final: set[tuple[int, int]] = set()
    ends: dict[int, Weight] = {}
    while agenda:
        cost, audit, at, state = heapq.heappop(agenda)
        if (at, state) in final:
            continue
        final.add((at, state))
        if at == len(rows):
            ends[state] = cost, audit
            if goal and state in GOALS:
                return {state: (cost, audit)}
        role = 3 if state == 2 else 2  # where an inserted or renamed row leads
        steps = [(INSERT, "I", at, role)]
        if at < len(rows):
            initial, fault, copies = rows[at]
            more, rest = "D" * copies, DELETE * copies
            steps.append((DELETE + rest, "D" + more, at + 1, state))
            if fault != SPOILT:
                rest += TRUNCATED * fault
                steps.append((RENAME + rest, "R" + more, at + 1, role))
                to = NEXT.get(initial, {}).get(state)
                if to is not None:
                    steps.append((rest, "K" + more, at + 1, to))
        for more_cost, edit, next_at, to in steps:
            if (next_at, to) not in final:
                heapq.heappush(agenda, (cost + more_cost, audit + edit, next_at, to))
    return ends


def joined(before: dict[int, Weight], block: list[dict]) -> dict[int, tuple[int, str, int, str, int]]:
    """Deductions with two antecedents: the lightest way to each state, with the state and the audit of its last block."""
    out: dict[int, tuple] = {}
    for path in block:
        known = before.get(path["begin"])
        if known is not None:
            made = known[0] + path["cost"], known[1] + path["audit"], path["begin"], path["audit"], path["cost"]
            if path["end"] not in out or made < out[path["end"]]:
                out[path["end"]] = made
    return out


def edited(roles: list[str], texts: list[str], copies: list[int], state: int, audit: str) -> list[dict]:
    """The rows that an audit leaves of a block entered in a state."""
    given = [(r, t) for r, t, n in zip(roles, texts, copies, strict=True) for r, t in [(r, t)] + [("", "")] * n]
    out, at = [], 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else given[at]
        at += edit != "I"
        if edit == "D":
            continue
        if edit == "K":
            state = NEXT[role[:1]][state]
        else:
            role, state = ("assistant", 3) if state == 2 else ("user", 2)
        out.append({"role": role, "text": text})
    return out


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage by crc32 of ``conv_id:turn`` modulo 20, with ``copies``: 0 dropped, 2 repeated."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    return (
        conversations.select(
            "conv_id",
            "turn",
            F.coalesce("role", blank).alias("role"),
            F.coalesce("text", blank).alias("text"),
            (F.crc32(key) % 20).alias("kind"),
        )
        .withColumns(
            {
                "role": F.when(F.col("kind") == 4, "user").otherwise(F.col("role")),
                "text": F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(
                    F.col("text")
                ),
                "copies": F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long"),
            }
        )
        .drop("kind")
    )


def _combined(rows: DataFrame) -> DataFrame:
    """Equal rows of a batch as one row with the sum of their copies: copies by the million go into few rows before any shuffle."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                names = [name for name in batch.schema.names if name != "copies"]
                whole = pa.Table.from_batches([batch]).group_by(names, use_threads=False).aggregate([("copies", "sum")])
                yield from whole.rename_columns([*names, "copies"]).to_batches()

    return rows.mapInArrow(combine, rows.schema)


def _judged(rows: DataFrame) -> DataFrame:
    """Rows with their number of copies, whether their role and text come in an earlier turn, and how their text ends."""
    gone = F.col("copies") == 0
    plain = rows.select(
        "conv_id",
        "turn",
        F.when(gone, "").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(gone, "").otherwise(F.coalesce("text", F.lit(" "))).alias("text"),
        gone.alias("gone"),
        F.col("copies").cast("long").alias("copies"),
    )
    digest = F.unhex(F.sha2("text", 256))
    # Role and text of a conversation that come in more than one turn, with the first of these; a null turn is the first of all.
    # Stored, so that the join knows how few they are.
    again = cut_lineage(
        plain.where(~F.col("gone"))
        .groupBy(F.col("conv_id").alias("_conv_id"), F.col("role").alias("_role"), digest.alias("_digest"))
        .agg(F.min("turn").alias("_first"), F.max("turn").alias("_last"), F.bool_or(F.col("turn").isNull()).alias("_open"))
        .where("_first <> _last or (_open and _first is not null)")
    )
    same: Column = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("role") == F.col("_role")) & (digest == F.col("_digest"))
    later = F.when(F.col("_open"), F.col("turn").isNotNull()).otherwise(F.col("turn") != F.col("_first"))
    body = F.rtrim("text", F.lit(BLANKS))
    return _combined(plain).join(again, same & ~F.col("gone"), "left").select(
        "conv_id",
        "turn",
        "role",
        "text",
        "gone",
        "copies",
        F.coalesce(later, F.lit(False)).alias("later"),
        (body == "").alias("blank"),
        F.right(body, F.lit(1)).isin(".", "!", "?").alias("ended"),
    )


FACTS = "blank long, duplicate long, truncated long, illegal long"
PATHS = "paths array<struct<begin:int,end:int,cost:bigint,audit:string>>"
ORDER = ("conv_id", "part", "block")


def _arrow(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _schema(conv: StructField, ddl: str) -> StructType:
    return StructType([StructField("conv_id", conv.dataType), *StructType.fromDDL(ddl)])


def blocks(rows: DataFrame) -> DataFrame:
    """The rows of all conversations in blocks, each with the lightest way from state to state and what its faults are."""
    from pyspark.sql.pandas.types import to_arrow_schema

    conv = rows.schema["conv_id"]
    shape = _schema(
        conv,
        f"part int, block long, first string, last string, low long, high long, turns long, {FACTS}, {PATHS}, "
        "roles array<string>, texts array<string>, more array<bigint>",
    )
    arrow = to_arrow_schema(shape)
    order = ["conv_id", "turn", "role", "text", "gone"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        held: list[dict] = []
        before: tuple | None = None  # the conversation of the rows held, and whether its beginning was seen here
        out: list[dict] = []

        def block(ended: bool) -> dict:
            """``ended``: the conversation is known to end with these rows."""
            own = [r for r in held if not r["gone"]]
            faults = [SPOILT if r["blank"] or r["later"] else SOUND if r["ended"] else CUT_OFF for r in own]
            line = [(r["role"][:1], f, r["copies"] - 1) for r, f in zip(own, faults, strict=True)]
            turns = [r["turn"] for r in own if r["turn"] is not None]
            begins = (0,) if before[1] else (0, 1, 2, 3)
            whole = ended and before[1]
            pairs = zip([x[0] for x in line], [x[0] for x in line][1:], strict=False)
            return {
                "conv_id": before[0],
                "part": part,
                "block": number,
                "first": own[0]["role"][:1] if own else None,
                "last": own[-1]["role"][:1] if own else None,
                "low": turns[0] if turns else None,
                "high": turns[-1] if turns else None,
                "turns": len(set(turns)),
                "blank": sum(r["copies"] for r in own if r["blank"]),
                "duplicate": sum(r["copies"] - (not r["later"]) for r in own if not r["blank"]),
                "truncated": faults.count(CUT_OFF),
                "illegal": sum(x[2] for x in line) + sum(a + b not in LEGAL for a, b in pairs),
                "paths": [
                    {"begin": q, "end": to, "cost": cost, "audit": audit}
                    for q in begins
                    for to, (cost, audit) in lightest(line, q, goal=whole).items()
                ],
                "roles": [r["role"] for r in own],
                "texts": [r["text"] for r in own],
                "more": [r["copies"] - 1 for r in own],
            }

        for batch in batches:
            for row in batch.to_pylist():
                if held and all(row[c] == held[-1][c] for c in order):
                    held[-1]["copies"] += row["copies"]
                    continue
                if before is None:
                    before = row["conv_id"], False
                elif before[0] != row["conv_id"]:
                    out.append(block(ended=True))
                    held, before, number = [], (row["conv_id"], True), number + 1
                elif len(held) >= BLOCK:
                    out.append(block(ended=False))
                    held, before, number = [], (row["conv_id"], False), number + 1
                held.append(row)
                if len(out) >= 1000:
                    yield _arrow(out, arrow)
                    out = []
        if held:
            out.append(block(ended=False))
        if out:
            yield _arrow(out, arrow)

    laid_out = _judged(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    return laid_out.mapInArrow(cut, shape)


def chosen(found: DataFrame) -> DataFrame:
    """For every block the state it is entered in and its part of the lightest repair; the facts of a conversation stand in its
    first block."""
    from pyspark.sql.pandas.types import to_arrow_schema

    facts = f"gaps long, {FACTS}, cost long"
    shape = _schema(found.schema["conv_id"], f"part int, block long, begin int, audit string, {facts}")
    arrow = to_arrow_schema(shape)
    counts = ("blank", "duplicate", "truncated")

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        own: list[dict] = []

        def close() -> None:
            ways: dict[int, tuple] = {0: (0, "", None, "", 0)}
            steps, last, low, high, turns, seen = [], None, None, None, 0, dict.fromkeys((*counts, "illegal"), 0)
            for b in own:
                ways = joined({q: w[:2] for q, w in ways.items()}, b["paths"])
                steps.append({q: w[2:] for q, w in ways.items()})
                for name in seen:
                    seen[name] += b[name]
                if last is not None and b["first"] is not None:
                    seen["illegal"] += last + b["first"] not in LEGAL
                last = last if b["last"] is None else b["last"]
                if b["low"] is not None:
                    turns += b["turns"] - (high == b["low"])
                    low, high = (b["low"] if low is None else low), b["high"]
            state = min((q for q in GOALS if q in ways), key=lambda q: ways[q][:2])
            gaps = 0 if low is None else high - low + 1 - turns
            total = {"gaps": (gaps + (1 << 63)) % (1 << 64) - (1 << 63), "cost": ways[state][0], **seen}
            made = []
            for b, step in zip(reversed(own), reversed(steps), strict=True):
                state, audit, _ = step[state]
                made.append({**{c: b[c] for c in ORDER}, "begin": state, "audit": audit})
            made[-1] |= total
            out.extend(made)

        for batch in batches:
            for row in batch.to_pylist():
                if own and own[0]["conv_id"] != row["conv_id"]:
                    close()
                    own = []
                own.append(row)
                if len(out) >= 1000:
                    yield _arrow(out, arrow)
                    out = []
        if own:
            close()
        if out:
            yield _arrow(out, arrow)

    return found.drop("roles", "texts", "more").repartition("conv_id").sortWithinPartitions(*ORDER).mapInArrow(compose, shape)


def repaired(conversations: DataFrame) -> DataFrame:
    """Blocks of repaired conversations: ``conv_id, part, block`` (their order), ``rows`` (role, text), ``audit``, and in the first
    block of each the facts of the whole: gaps, blank, duplicate, truncated, illegal, cost.

    Rows may carry ``copies``: how often the row is there; 0 makes the conversation known and nothing else.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = conversations if "copies" in conversations.columns else conversations.withColumn("copies", F.lit(1).cast("long"))
    found = cut_lineage(blocks(rows))
    picked = cut_lineage(chosen(found))
    rows_type = "rows array<struct<role:string,text:string>>"
    facts = f"gaps long, {FACTS}, cost long"
    shape = _schema(found.schema["conv_id"], f"part int, block long, audit string, {facts}, {rows_type}")
    arrow = to_arrow_schema(shape)

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                given = [row.pop(name) for name in ("roles", "texts", "more", "begin")]
                out.append({**row, "rows": edited(*given, row["audit"])})
            yield _arrow(out, arrow)

    given = found.select("part", "block", "roles", "texts", "more")
    return picked.join(given, ["part", "block"]).mapInArrow(edit, shape)


def digest(found: DataFrame) -> DataFrame:
    """One row per conversation: its facts, the whole audit, and the SHA-256 of the repaired ``role:text`` lines. Rows pass one
    after the other; what is held of a conversation is its audit."""
    from pyspark.sql.pandas.types import to_arrow_schema

    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    shape = _schema(found.schema["conv_id"], f"gaps long, {FACTS}, cost long, audit string, repaired_sha256 string")
    arrow = to_arrow_schema(shape)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []

        def close() -> None:
            facts, audits, digester, _ = now
            out.append({**facts, "audit": "".join(audits), "repaired_sha256": digester.hexdigest()})

        for batch in batches:
            for row in batch.to_pylist():
                if row["gaps"] is not None:  # the first block of a conversation
                    if now:
                        close()
                    now = [{c: row[c] for c in ("conv_id", *names)}, [], sha256(), False]
                now[1].append(row["audit"])
                for made in row["rows"]:
                    now[2].update(("\n" * now[3] + f"{made['role']}:{made['text']}").encode("utf-8", "surrogatepass"))
                    now[3] = True
            if out:
                yield _arrow(out, arrow)
                out = []
        if now:
            close()
            yield _arrow(out, arrow)

    return found.repartition("conv_id").sortWithinPartitions(*ORDER).mapInArrow(hashed, shape)
