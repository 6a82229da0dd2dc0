import random

import pytest
from llm_cases import documents, jaccard_groups, unharmed, with_clashes

from stayline.llm import near_duplicates
from stayline.llm.components import components


def corpus(seed, copies=24):
    rng = random.Random(seed)
    bag = [f"w{i}" for i in range(400)]
    texts, base = {}, [rng.choices(bag, k=rng.randint(8, 120)) for _ in range(12)]
    for i, words in enumerate(base):
        texts[len(texts)] = " ".join(words)
        for _ in range(rng.randint(0, 3) if i else copies):
            own = list(words)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = rng.choice(bag)
            texts[len(texts)] = " ".join(own)
    for odd in (None, "", " \n", "one", "One", "one two three four", "ONE two  three\nfour", texts[0], texts[0].upper()):
        texts[len(texts)] = odd
    return texts


@pytest.mark.parametrize(("seed", "block"), [(1, 256), (2, 3)])
def test_join_equals_comparing_all_pairs(spark, monkeypatch, seed, block):
    monkeypatch.setattr(near_duplicates, "BLOCK_DOCS", block)
    texts = corpus(seed)
    got = near_duplicates.join(documents(spark, list(texts.items())).repartition(3)).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"], r["group_id"]) for r in got} == jaccard_groups(texts)
    assert len(got) == len(texts)


def test_nulls_repeated_rows_and_extra_columns(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (None, "only here it is seen at all"), (7, "q r s t u v")]
    df = with_clashes(documents(spark, rows))
    got = sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in near_duplicates.join(df).collect()), key=repr)
    assert got == sorted([(5, 5, 0), (5, 5, 0), (None, 5, 0), (None, None, 0), (7, 7, 0)], key=repr)
    kept = near_duplicates.one_of_each_group(df)
    assert kept.columns == df.columns and unharmed(kept)
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [5, 7, None, None]


def test_empty_table(spark):
    assert near_duplicates.join(documents(spark, [])).count() == 0
    assert near_duplicates.one_of_each_group(documents(spark, [])).count() == 0


def test_prefix_is_shortened_until_the_target():
    depth = near_duplicates.matched_depth(0.8)
    assert near_duplicates.recall(0.8, near_duplicates.TREES, depth) >= near_duplicates.TARGET_RECALL
    assert near_duplicates.recall(0.8, near_duplicates.TREES, depth + 1) < near_duplicates.TARGET_RECALL


def test_components_equal_a_plain_search(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)] + [(None, 3), (7, None)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {n: n for e in edges if None not in e and e[0] != e[1] for n in e}
    for _ in range(len(want)):
        for a, b in edges:
            if a in want and b in want:
                want[a] = want[b] = min(want[a], want[b])
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
