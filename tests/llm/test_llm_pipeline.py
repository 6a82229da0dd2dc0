import os
import re

import corpus_pipeline
from llm_cases import jaccard_groups
from test_llm_decontaminate import plain as contamination
from test_llm_rules import plain as counts

import __spark_entry__
from stayline.session import remove_intermediates, shared_dir
from verify import compare, connect

SF_DIR = "/root/testdata/sf0.001"


def test_stages_equal_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    first = stages["quality rules"](spark, docs, SF_DIR)
    kept = {r["doc_id"]: r["text"] for r in first.collect()}
    assert all(texts[i] == t for i, t in kept.items()) and len(kept) > 100
    assert not any(counts(t)[-1] for t in kept.values())

    second = stages["n-gram Jaccard join"](spark, first, SF_DIR)
    groups = jaccard_groups(kept)
    one = {r["doc_id"]: r["text"] for r in second.collect()}
    assert one == {i: t for i, t in kept.items() if groups[i][2] == i}

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    third = stages["benchmark decontamination"](spark, second, SF_DIR)
    clean = {r["doc_id"]: r["text"] for r in third.collect()}
    found = {i: contamination(t, items, 10) for i, t in one.items()}
    assert set(clean) == {i for i, (n, hit, _) in found.items() if hit <= 0.5 * n}
    assert all(contamination(t, items, 10)[1] == 0 for t in clean.values())
    assert all(clean[i] == one[i] for i in clean if not found[i][1])

    fourth = stages["secret scans"](spark, third, SF_DIR)
    safe = {r["doc_id"]: r["text"] for r in fourth.collect()}
    secret = re.compile(r"AKIA[A-Z0-9]{16}|(?<=token = \")[0-9a-f]{40}|(?<=password=)[0-9a-f]{18}", re.I)
    assert safe == {i: secret.sub("[SECRET]", t) for i, t in clean.items()}

    last = stages["BPE encoding and decoding"](spark, fourth, SF_DIR).collect()
    assert len(last) == len(safe) and all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) > 0 for r in last)
    for stage in (first, second, third, fourth):
        assert stage.columns == docs.columns
    assert corpus_pipeline.run(spark, SF_DIR).count() == len(safe)


def test_empty_documents_go_through(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.count() == 0


def test_registered_queries_of_every_operator():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()


def test_queries_that_sql_expresses(spark):
    duck = connect(SF_DIR)
    for name in ("op4_decontamination", "op10_quality_rules", "op11_phrase_collocations"):
        assert compare(__spark_entry__.queries()[name](spark, SF_DIR), duck, __spark_entry__.oracle_sql()[name]) == []


def test_nothing_is_left_after_the_pipeline(spark):
    folder = shared_dir(spark).removeprefix("file:")
    remove_intermediates(spark)
    before = set(os.listdir(folder))
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
    assert set(os.listdir(folder)) - before
    remove_intermediates(spark)
    assert set(os.listdir(folder)) == before
