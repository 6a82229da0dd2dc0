from llm_cases import documents, unharmed, with_clashes
from pyspark.sql import functions as F

from stayline.llm import cotraining

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    known = labels.where("doc_id % 3 <> 0")
    scored = cotraining.scored(docs, known, rounds=1)
    assert scored.count() == docs.count()
    tested = scored.join(labels.where("doc_id % 3 = 0"), "doc_id").select((F.col("keep") == (F.col("quality") == 1)).cast("int").alias("right"))
    assert tested.agg(F.avg("right")).first()[0] > 0.95
    assert scored.where("not (score between 0 and 1)").count() == 0


def test_nulls_repeats_and_no_labels(spark):
    rows = [(1, "some text"), (1, "some text"), (None, None), (3, "")]
    docs = with_clashes(documents(spark, rows).withColumns({c: F.lit(None).cast(t) for c, t in (("lang", "string"), ("n_chars", "long"))}))
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = cotraining.scored(docs, empty)
    assert sorted((r["doc_id"] or 0, r["score"], r["keep"]) for r in got.collect()) == [(0, 1.0, True), (1, 1.0, True), (1, 1.0, True), (3, 1.0, True)]
    one = spark.createDataFrame([(1, 0, 0), (1, 0, 0), (77, 1, 0), (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    assert {r["keep"] for r in cotraining.scored(docs, one).collect()} == {False}
    assert cotraining.scored(documents(spark, []), empty).count() == 0
    assert unharmed(docs)


def test_labelled_rows_are_bounded_and_ties_go_up(spark):
    docs = documents(spark, [(i, f"text {i}") for i in range(40)])
    labels = spark.createDataFrame([(i, q, 0) for i in range(40) for q in (0, 1)], "doc_id long, quality int, toxic int")
    rows = cotraining.labelled_rows(cotraining.features(docs), labels, limit=15)
    assert rows.count() == 15 and {r["label"] for r in rows.collect()} == {1}


def test_both_views_teach_in_every_round(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    report = []
    cotraining.scored(docs, labels.where("doc_id % 3 <> 0"), report=report)
    given = {(r["round"], r["view"], r["label"]): r["n"] for r in report}
    assert set(given) == {(i, view, label) for i in (1, 2) for view in ("content", "meta") for label in (0, 1)}
    assert min(given.values()) > 0


def test_pseudo_labels_go_by_probability_and_by_rank(spark):
    from pyspark.sql import Row

    view = lambda name: cotraining.View(name, F.col(name), 1.0, 0.0)
    # The first view is sure of all but one row; the second stays near a half; the third tells nothing apart.
    free = spark.createDataFrame([Row(doc_id=i, a=9.0 if i else 0.0, b=i / 1000, c=0.0) for i in range(100)])
    a, b, c = cotraining.pseudo_labels(free, [view("a"), view("b"), view("c")], good=0.8, outer=0.1)
    labels = lambda df: {r["doc_id"]: r["label"] for r in df.collect()}
    assert labels(a) == {0: 0} | {i: 1 for i in range(1, 100)}
    got = labels(b)
    assert set(got.values()) == {0, 1} and abs(sum(got.values()) - 8) <= 1 and abs(len(got) - 10) <= 2
    assert max(i for i in got if not got[i]) < 5 and min(i for i in got if got[i]) > 85
    assert labels(c) == {}
    assert [df.count() for df in cotraining.pseudo_labels(free.limit(0), [view("a"), view("b")], good=0.8)] == [0, 0]
