import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_cases import documents, unharmed, with_clashes

from __spark_entry__ import oracle_sql, queries
from stayline.llm import collocations
from stayline.llm.quotient_filter import Filter, merged
from verify import compare, connect


def plain(rows, least, longest, top):
    """All counts in one dictionary a language, every candidate against every longer one."""
    counts, totals = {}, Counter()
    for text, lang in rows:
        own = counts.setdefault("und" if lang is None else lang, Counter())
        body = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", body):
            words = tuple(w for w in re.split("[ \t]+", piece) if w)
            totals["und" if lang is None else lang] += len(words)
            for size in range(1, longest + 1):
                own.update(words[i : i + size] for i in range(len(words) - size + 1))
    out = []
    for lang, own in counts.items():
        found, n = {p: f for p, f in own.items() if len(p) > 1 and f >= least}, totals[lang]
        ranked = []
        for p, a in found.items():
            longer = (q for q in found if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))))
            if any(100 * found[q] >= 100 * a for q in longer):
                continue
            score, _, l, r = min((1000 * a * n // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), l, r, n))
        for at, (score, a, phrase, l, r, n) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, at, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def rows():
    rng = random.Random(4)
    words = ["the", "The", "a", "new", "york", "city", "hall", "été", "ß", "x\x85y", "日", "of", "#", "\x01"]
    weights = [9, 3, 8, 4, 4, 3, 2, 2, 1, 1, 1, 6, 1, 1]
    ends = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\r", " ! "]
    out = []
    for i in range(120):
        text = "".join(w + rng.choice(ends) for w in rng.choices(words, weights, k=rng.randint(0, 120)))
        out.append((text + "New York city hall of" * rng.randint(0, 3), rng.choice(["en", "en", "fr", None, "und"])))
    return [*out, (None, "en"), ("", "de"), (" .,\t", "de"), (out[0][0], "en")]


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(("shard", "per_range", "block"), [(2_000_000, 4_000_000, 4_000_000), (300, 200, 60)])
def test_phrases_are_those_of_plain_counts(spark, monkeypatch, shard, per_range, block):
    monkeypatch.setattr(collocations, "SHARD_WORDS", shard)
    monkeypatch.setattr(collocations, "RANGE_WORDS", per_range)
    monkeypatch.setattr(collocations, "BLOCK_BYTES", block)
    own = rows()
    df = documents(spark, [(i, t, lang, "s", 0) for i, (t, lang) in enumerate(own)]).repartition(4)
    for least, longest, top in ((3, 5, 2000), (6, 4, 7), (2, 2, 2000)):
        assert got(collocations.collocations(df, least, longest, top)) == plain(own, least, longest, top)


def test_query_matches_its_oracle(spark):
    folder = "/root/testdata/sf0.001"
    name = "op11_phrase_collocations"
    assert compare(queries()[name](spark, folder), connect(folder), oracle_sql()[name]) == []


def test_empty_tables_and_other_columns(spark):
    assert collocations.collocations(documents(spark, []), 1).count() == 0
    df = with_clashes(documents(spark, [(1, "a b a b"), (2, None)]))
    assert [tuple(r)[2:4] for r in collocations.collocations(df, 2).collect()] == [("a b", 2)]
    assert unharmed(df)


@pytest.mark.parametrize("n_words", [2, 3, 4, 5])
@pytest.mark.parametrize("bits", [0, 3])
def test_filters_lose_nothing(n_words, bits):
    rng = np.random.default_rng(n_words)
    shards, total = [], Counter()
    for size in (0, 1, 700, 40_000):
        ids = np.unique(rng.integers(0, [3, 1 << 32][size % 2], (size, n_words)) if size else np.empty((0, n_words), int), axis=0)
        counts = rng.integers(1, 600, len(ids)) ** 3
        total.update(dict(zip(map(tuple, ids.tolist()), counts.tolist(), strict=True)))
        own, order = Filter.of(ids, counts)
        assert (own.ids() == ids[order]).all()
        parts = [Filter.from_bytes(part.to_bytes(number, bits)) for number, part in own.ranges(bits)]
        for number, part in own.ranges(bits):
            back = Filter.from_bytes(part.to_bytes(number, bits))
            assert (back.ids() == part.ids()).all() and (back.counts == part.counts).all()
        assert sum(map(len, parts)) == len(ids)
        shards.append(own)
    whole, places = merged(shards)
    assert dict(zip(map(tuple, whole.ids().tolist()), whole.counts.tolist(), strict=True)) == dict(total)
    assert all((whole.ids()[at] == own.ids()).all() for at, own in zip(places, shards, strict=True))
    assert (np.diff(whole.lanes[0].astype(object)) >= 0).all()
