"""Quality classifier by co-training of two views.

The content view sees the text only: pairs of character classes and a few shares of its words. The metadata view sees language,
source and length. Each view is a logistic regression, calibrated on held-out labels. In every round each view labels the
documents it is sure of, and the other view learns from them besides the labelled ones; the labelled documents themselves stay
as they are. A view is sure of a document by its probability, or as the document is among the outer ones of the view's own
scores, as many good and bad ones as the labels have: so a weak view, whose probabilities stay near the base rate, teaches too. At the end a third regression on the held-out labels weighs the calibrated views, and all documents get a score.

Labelled rows are bounded by ``max_labelled`` (chosen by a hash of the id). Pseudo-labels are bounded by nothing: every document
that a view is sure of takes part. Texts are read once; their features, some seventy numbers a document, are written.

Defined cases: null texts have the features of an empty one, null metadata those of an unknown value; labels that are null, of
unknown documents or without an id are left out, and of several labels of one document the mean decides, 0.5 up; without labels
of both kinds every score is the share of good ones (1.0 without any) and no view is fitted; repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.session import cut_lineage

MAX_LABELLED = 20_000
ROUNDS = 2
SURE = 0.95
# Share of the unlabelled documents that each view labels by rank, good and bad ones together.
OUTER = 0.05
KEEP = 0.5
CLASSES = 8
META_SLOTS = 32

_LOWER, _UPPER, _DIGIT, _BLANK, _LINE, _STOP, _MARK, _HIGH = range(CLASSES)
_CLASS_OF = np.array(
    [
        _LOWER if 97 <= b <= 122
        else _UPPER if 65 <= b <= 90
        else _DIGIT if 48 <= b <= 57
        else _LINE if b == 10
        else _BLANK if b <= 32
        else _STOP if chr(b) in ".,;:!?'\"()-"
        else _HIGH if b >= 128
        else _MARK
        for b in range(256)
    ],
    np.int64,
)


def content_features(text: str | None) -> np.ndarray:
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    kinds = _CLASS_OF[raw]
    pairs = np.bincount(kinds[:-1] * CLASSES + kinds[1:], minlength=CLASSES * CLASSES) / max(1, len(raw) - 1)
    words = text.split() if text else []
    n = max(1, len(words))
    again = sum(map(str.__eq__, words, words[1:])) / n
    extra = [np.log1p(len(words)), len(set(words)) / n, again, sum(map(len, words)) / n / 10, sum(map(str.isupper, words)) / n]
    return np.concatenate((np.sqrt(pairs), extra)).astype(np.float32)


def features(docs: DataFrame) -> DataFrame:
    """doc_id, content (array) and meta (array) of every row."""

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [content_features(text.as_py()) for text in batch.column("text")]
            content = pa.array([r.tolist() for r in rows], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "meta": batch.column("meta"), "content": content})

    slot = lambda c: F.pmod(F.xxhash64(F.coalesce(c, F.lit("?"))), F.lit(META_SLOTS)).cast("int")
    chars = F.coalesce(F.col("n_chars"), F.lit(0))
    one_hot = F.transform(
        F.sequence(F.lit(0), F.lit(2 * META_SLOTS - 1)),
        lambda i: ((i == slot(F.col("lang"))) | (i == META_SLOTS + slot(F.col("source")))).cast("float"),
    )
    length = F.log(F.greatest(chars, F.lit(0)) + 1.0).cast("float")
    meta = F.concat(one_hot, F.array(length, (length * length / 10).cast("float")))
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), meta.alias("meta"), "text")
    return columns.mapInArrow(described, "doc_id long, meta array<float>, content array<float>")


def _margin(model: LogisticRegressionModel, view: str) -> Column:
    """The regression's margin as an expression over an array column."""
    weights = F.array(*(F.lit(float(w)) for w in model.coefficients))
    products = F.zip_with(F.col(view), weights, lambda x, w: x * w)
    return F.aggregate(products, F.lit(float(model.intercept)), lambda a, b: a + F.coalesce(b, F.lit(0.0)))


def _sigmoid(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))


def _fitted(rows: DataFrame, columns: Column, **params) -> LogisticRegressionModel:
    return LogisticRegression(**{"maxIter": 40, "regParam": 1e-3, **params}).fit(
        rows.select(F.col("label").cast("double").alias("label"), array_to_vector(columns).alias("features"))
    )


@dataclass
class View:
    """A fitted view: its calibrated probability as an expression."""

    name: str
    margin: Column
    scale: float
    shift: float

    @property
    def logit(self) -> Column:
        return self.margin * self.scale + self.shift

    @property
    def probability(self) -> Column:
        return _sigmoid(self.logit)

    @classmethod
    def fit(cls, name: str, rows: DataFrame, held_out: DataFrame) -> View:
        margin = _margin(_fitted(rows, F.col(name)), name)
        platt = _fitted(held_out.select("label", F.array(margin).alias("m")), F.col("m"), regParam=1e-4)
        return cls(name, margin, float(platt.coefficients[0]), float(platt.intercept))


def labelled_rows(rows: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """Features with a label and whether the row is held out for calibration (one in four)."""
    own = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    )
    chosen = rows.join(own, "doc_id").dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    return chosen.withColumn("held_out", F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(4)) == 0)


def pseudo_labels(free: DataFrame, views: list[View], good: float, sure: float = SURE, outer: float = OUTER) -> list[DataFrame]:
    """Per view the rows of ``free`` that it is sure of, with its ``label``; ``good`` is the share of good labels. Equal scores
    are taken together, and a view whose scores are all equal has no outer ones."""
    scores = free.select(*(view.probability.alias(view.name) for view in views))
    ends = scores.approxQuantile([view.name for view in views], [outer * (1 - good), 1 - outer * good], 1e-3)
    out = []
    for view, cuts in zip(views, ends, strict=True):
        p, (low, high) = F.col("_p"), cuts or (0.0, 1.0)
        is_good = (p >= sure) | (p >= high) & (p > low)
        is_bad = (p <= 1 - sure) | (p <= low) & (p < high)
        # Where the two rules differ, the probability is heard first.
        label = F.when(p >= sure, 1).when(p <= 1 - sure, 0).otherwise(is_good.cast("int"))
        out.append(free.withColumn("_p", view.probability).where(is_good | is_bad).withColumn("label", label).drop("_p"))
    return out


def scored(
    docs: DataFrame,
    labels: DataFrame,
    rounds: int = ROUNDS,
    sure: float = SURE,
    max_labelled: int = MAX_LABELLED,
    report: list[dict] | None = None,
) -> DataFrame:
    """Per row of docs: doc_id, p_content, p_meta, score and keep. A ``report`` gets the numbers of pseudo-labels: round, view
    that gave them, label, n."""
    rows = cut_lineage(features(docs))
    labelled = cut_lineage(labelled_rows(rows, labels, max_labelled))
    counts = {(r["held_out"], r["label"]): r["count"] for r in labelled.groupBy("held_out", "label").count().collect()}
    if len(counts) < 4:
        good, total = sum(n for (_, label), n in counts.items() if label), sum(counts.values())
        share = F.lit(good / total if total else 1.0)
        return rows.select("doc_id", share.alias("p_content"), share.alias("p_meta"), share.alias("score")).withColumn(
            "keep", F.col("score") >= KEEP
        )
    train, held_out = labelled.where("not held_out").drop("held_out"), labelled.where("held_out").drop("held_out")
    free = rows.join(labelled.select("doc_id"), "doc_id", "left_anti") if rounds else rows
    content, meta = View.fit("content", train, held_out), View.fit("meta", train, held_out)
    good = sum(n for (_, label), n in counts.items() if label) / sum(counts.values())
    for i in range(rounds):
        # What one view is sure of teaches the other.
        taught = [more.select(*train.columns) for more in pseudo_labels(free, [meta, content], good, sure)]
        if report is not None:
            for view, more in zip((meta, content), taught, strict=True):
                found = more.groupBy("label").count().collect()
                report += [{"round": i + 1, "view": view.name, "label": r["label"], "n": r["count"]} for r in found]
        content, meta = (
            View.fit(name, train.unionByName(more), held_out) for name, more in zip(("content", "meta"), taught, strict=True)
        )
    both = F.array(content.logit, meta.logit)
    last = _fitted(held_out.select("label", both.alias("views")), F.col("views"))
    score = _sigmoid(_margin(last, "views"))
    return (
        rows.select(
            "doc_id", content.probability.alias("p_content"), meta.probability.alias("p_meta"), both.alias("views")
        )
        .withColumn("score", score)
        .withColumn("keep", F.col("score") >= KEEP)
        .drop("views")
    )
