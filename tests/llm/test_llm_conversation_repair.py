import random
import re
from functools import cache
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from stayline.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\x0b\f\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain_repair(rows):
    """One conversation, top down: the lightest rest of every (row, state), with at most three insertions in a row."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    faults, seen = [], set()
    for _, _, role, text in rows:
        body = text.rstrip(BLANK)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    @cache
    def best(at, last, inserted):
        ways = []
        if at == len(rows):
            if last in ("", "a"):
                ways.append((0, "", ()))
        else:
            cost, audit, made = best(at + 1, last, 0)
            ways.append((cost + 2, "D" + audit, made))
            if faults[at] not in ("blank", "duplicate"):
                _, _, role, text = rows[at]
                extra = 5 * (faults[at] == "truncated")
                for new in {role, "user", "assistant"}:
                    if new and new[0] in follow[last]:
                        cost, audit, made = best(at + 1, new[0], 0)
                        keeps = new == role
                        ways.append((cost + extra + (not keeps), "RK"[keeps] + audit, (f"{new}:{text}", *made)))
        if inserted < 3:
            for new in ("user", "assistant"):
                if new[0] in follow[last]:
                    cost, audit, made = best(at, new[0], inserted + 1)
                    ways.append((cost + 5, "I" + audit, (f"{new}:", *made)))
        return min(ways, default=(10**9, "", ()))

    cost, audit, made = best(0, "", 0)
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, sha256("\n".join(made).encode()).hexdigest())


def plain(rows, damage=plain_damage):
    convs = {r[0]: [] for r in rows}
    for row in damage(rows):
        convs[row[0]].append(row)
    return sorted(((c, *plain_repair(own)) for c, own in convs.items()), key=repr)


def got(df):
    names = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def conversations(seed, n, longest=9):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", None, "tool", "", "sys", "uncle"]
    texts = ["Yes.", "No", "What?", "Yes.", "well!  \n", " ", "", None, "a\x85", "été.", "same.", "then. \x0b"]
    out = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            out.append((conv, rng.choice([turn, turn, turn, 2 * turn, 0, None]), rng.choice(roles), rng.choice(texts)))
    return [*out, (None, 1, "user", "Hi."), (None, None, "assistant", "Oh."), (-5, None, None, None)]


@pytest.mark.parametrize(("seed", "parts", "block"), [(1, 1, 128), (2, 6, 128), (3, 5, 3)])
def test_repairs_equal_those_of_a_plain_search(spark, conf, monkeypatch, seed, parts, block):
    conf(spark__sql__shuffle__partitions=str(parts), spark__sql__adaptive__coalescePartitions__enabled="false")
    monkeypatch.setattr(repair, "BLOCK", block)
    rows = conversations(seed, 150)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(repair.digest(repair.repaired(repair.damaged(df)))) == plain(rows)


@pytest.mark.parametrize("block", [7, 128])
def test_one_long_conversation_is_spread_and_joined_exactly(spark, conf, monkeypatch, block):
    conf(spark__sql__shuffle__partitions="5", spark__sql__adaptive__coalescePartitions__enabled="false")
    monkeypatch.setattr(repair, "BLOCK", block)
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["Yes.", f"so {t}.", f"cut {t}"])) for t in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = repair.blocks(df.withColumn("copies", F.lit(1).cast("long")))
    assert found.select("part").distinct().count() > 1
    assert got(repair.digest(repair.repaired(df))) == plain(rows, damage=list)


def test_copies_of_a_row_are_one_row_of_the_search(spark):
    rows = [(1, 1, "user", "Hi.")] * 3000 + [(1, 2, "assistant", "Yes.")]
    audit = repair.digest(repair.repaired(spark.createDataFrame(rows, SCHEMA))).first()
    assert (audit["cost"], audit["audit"], audit["duplicate"]) == (2 * 2999, "K" + "D" * 2999 + "K", 2999)


def test_the_repaired_rows_and_empty_or_lost_conversations(spark):
    df = spark.createDataFrame([(1, 1, "user", "Hi."), (1, 3, "user", "Yes."), (1, 4, "system", " ")], SCHEMA)
    first = repair.repaired(df.withColumn("own", F.lit(1))).first()
    assert [(r["role"], r["text"]) for r in first["rows"]] == [("user", "Hi."), ("assistant", "Yes.")]
    assert (first["audit"], first["cost"], first["gaps"], first["blank"]) == ("KRD", 3, 1, 1)
    lost = repair.digest(repair.repaired(df.withColumn("copies", F.lit(0).cast("long")))).first()
    assert tuple(lost) == (1, 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())
    assert repair.digest(repair.repaired(df.limit(0))).count() == 0
    text_ids = df.select(F.concat(F.lit("c"), "conv_id").alias("conv_id"), "turn", "role", "text")
    assert repair.digest(repair.repaired(text_ids)).first()["conv_id"] == "c1"


def test_a_goal_item_is_final_when_it_is_popped():
    assert repair.lightest([], 0, goal=True) == {0: (0, "")}
    assert repair.lightest([("u", 0, 0)], 0, goal=True) == {0: (2, "D")}
    every = repair.lightest([("u", 0, 0), ("a", 0, 1)], 0)
    assert every[3] == (2, "KKD")
