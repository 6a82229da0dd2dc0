"""Secret scan with a random forest that removes false positives, as one projection of built-in functions.

Candidates are long runs of key characters. Each is described by its length, its character transitions, the share of it that
frequent words of the corpus cover, its path and its neighbouring words. A forest is fitted to labelled findings (at most
``max_labelled`` rows) and compiled into a conditional expression, so that scoring, like the search, happens inside the row:
no shuffle, no user function, and the text is read once.

Defined cases: a null or empty text has no candidates and stays as it is; a null path has the features of an empty one; a very
long run is one candidate; repeated rows are judged alike. Without labelled findings of both kinds the score is the share of
real ones among them (a half if there are none at all).
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm.rules import let
from stayline.session import cut_lineage

CANDIDATE = "[A-Za-z0-9+/_-]{16,}={0,2}"
CONTEXT_CHARS = 60
DICTIONARY_WORDS = 500
MAX_LABELLED = 20_000
THRESHOLD = 0.5
MARK = "[SECRET]"
FOREST = {"numTrees": 15, "maxDepth": 5, "seed": 7, "maxBins": 64}
FEATURES = (
    "length transitions digit_share upper_share distinct_share dictionary_share path_depth path_config path_test "
    "named_before assigned quoted"
).split()

NAMES = "(?i)(token|secret|passw(or)?d|passphrase|pwd|credential|bearer|auth|api|key)"
ASSIGNED = "[=:]\\s*[\"'`]?$"
CLASS_CHANGES = "(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])"
CONFIG_PATH = "(?i)\\.(env|ya?ml|json|toml|ini|cfg|conf|properties|tf|sh|py|js|ts|java|go)$"
TEST_PATH = "(?i)(test|example|sample|fixture|mock|doc)"


def dictionary(docs: DataFrame, words: int = DICTIONARY_WORDS, text: str = "text") -> list[str]:
    """The most frequent words of 3 to 12 letters of all rows; a list of fixed length."""
    counted = (
        docs.select(F.explode(F.split(F.lower(text), "[^a-z]+")).alias("word"))
        .where(F.length("word").between(3, 12))
        .groupBy("word")
        .count()
    )
    return [r["word"] for r in counted.orderBy(F.desc("count"), "word").limit(words).collect()]


def _described(value: Column, before: Column, after: Column, path: Column, words: list[str]) -> Column:
    size = F.length(value)
    # Longer words first, as an alternative takes the first that fits.
    known = "|".join(sorted(words, key=lambda w: (-len(w), w))) or "(?!)"
    flag = lambda c: c.cast("double")
    left = lambda pattern: size - F.length(F.regexp_replace(value, pattern, ""))
    return F.struct(
        value.alias("value"),
        before.alias("before"),
        size.cast("double").alias("length"),
        (F.regexp_count(value, F.lit(CLASS_CHANGES)) / size).alias("transitions"),
        (left("[0-9]+") / size).alias("digit_share"),
        (left("[A-Z]+") / size).alias("upper_share"),
        (F.size(F.array_distinct(F.split(value, ""))) / size).alias("distinct_share"),
        (1 - F.length(F.regexp_replace(F.lower(value), known, "")) / size).alias("dictionary_share"),
        (F.length(path) - F.length(F.translate(path, "/", ""))).cast("double").alias("path_depth"),
        flag(path.rlike(CONFIG_PATH)).alias("path_config"),
        flag(path.rlike(TEST_PATH)).alias("path_test"),
        flag(before.rlike(NAMES)).alias("named_before"),
        flag(before.rlike(ASSIGNED)).alias("assigned"),
        flag(before.rlike("[\"'`]$") & after.rlike("^[\"'`]")).alias("quoted"),
    )


def _candidates(text: Column, path: Column, words: list[str]) -> Column:
    """Array of described candidates, in text order."""
    body, place = F.coalesce(text, F.lit("")), F.coalesce(path, F.lit(""))

    def at_gaps(gaps: Column) -> Column:
        return F.transform(
            F.regexp_extract_all(body, F.lit(CANDIDATE), F.lit(0)),
            lambda value, i: _described(
                value, F.right(F.get(gaps, i), F.lit(CONTEXT_CHARS)), F.left(F.get(gaps, i + 1), F.lit(8)), place, words
            ),
        )

    return let(F.split(body, CANDIDATE, -1), at_gaps)


def weak_label(found: Column) -> Column:
    """1 for findings of well-known formats: issued key ids, and values with digits that a named setting is given."""
    issued = found["value"].rlike("^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{20,}$|^xox[abprs]-")
    named = found["before"].rlike("(?i)(token|secret|passw(or)?d|pwd|api.?key|auth\\w*)[\"'`]?\\s*[=:]\\s*[\"'`]?$")
    return (issued | (named & found["value"].rlike("[0-9].*[0-9].*[0-9]"))).cast("double")


def labelled_findings(
    docs: DataFrame, words: list[str], limit: int = MAX_LABELLED, text: str = "text", path: str = "source", label=weak_label
) -> DataFrame:
    """At most ``limit`` described candidates with a ``label``, half of them of each kind if there are enough. The choice
    goes by a hash of the finding, so it does not depend on how rows are spread."""
    found = docs.select(F.explode(_candidates(F.col(text), F.col(path), words)).alias("found")).select(
        label(F.col("found")).alias("label"), "found.*"
    )
    order = (F.xxhash64("value", "before"), "value", "before")
    halves = [found.where(F.col("label") == kind).orderBy(*order).limit(limit // 2) for kind in (0.0, 1.0)]
    return halves[0].unionByName(halves[1]).select("label", "value", *FEATURES)


def fit(labelled: DataFrame, **params) -> RandomForestClassificationModel | float:
    """A forest, or the share of real findings where only one kind is there."""
    kinds = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    if len(kinds) < 2:
        return next(iter(kinds), 0.5)
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(labelled)
    return RandomForestClassifier(featuresCol="features", labelCol="label", **{**FOREST, **params}).fit(rows)


def compiled(model: RandomForestClassificationModel | float):
    """The forest as an expression over a described candidate: the mean of its trees' shares of real findings."""
    if isinstance(model, float):
        return lambda found: F.lit(model)

    def leaf(node) -> float:
        counts = list(node.impurityStats().stats())
        return counts[1] / sum(counts)

    def tree(node) -> tuple | float:
        if node.getClass().getSimpleName() == "LeafNode":
            return leaf(node)
        split = node.split()
        return (FEATURES[split.featureIndex()], split.threshold(), tree(node.leftChild()), tree(node.rightChild()))

    trees = [tree(t._call_java("rootNode")) for t in model.trees]

    def expression(node: tuple | float, found: Column) -> Column:
        if isinstance(node, float):
            return F.lit(node)
        name, threshold, low, high = node
        return F.when(found[name] <= threshold, expression(low, found)).otherwise(expression(high, found))

    def score(found: Column) -> Column:
        return sum((expression(t, found) for t in trees), F.lit(0.0)) / len(trees)

    return score


def scan(
    docs: DataFrame, words: list[str], score, text: str = "text", path: str = "source", threshold: float = THRESHOLD
) -> DataFrame:
    """docs with ``findings`` (array of value, start in characters, score, real) and ``redacted``; own columns of these names
    are replaced."""
    body = F.coalesce(F.col(text), F.lit(""))

    def judged(found: Column) -> Column:
        return F.transform(found, lambda x: F.struct(x["value"].alias("value"), score(x).alias("score")))

    def located(gaps: Column) -> Column:
        scored = let(_candidates(F.col(text), F.col(path), words), judged)
        return let(scored, lambda found: let(starts(found, gaps), lambda at: assembled(found, gaps, at)))

    def starts(found: Column, gaps: Column) -> Column:
        """Where each candidate starts, then where the last one ends: running sums of the lengths before it."""
        steps = F.transform(
            found, lambda x, i: F.struct(F.length(F.get(gaps, i)).alias("gap"), F.length(x["value"]).alias("own"))
        )
        begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("all"))
        add = lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["own"]).alias("at"),
            F.concat(acc["all"], F.array(acc["at"] + x["gap"])).alias("all"),
        )
        return F.aggregate(steps, begin, add, lambda acc: acc["all"])

    def assembled(found: Column, gaps: Column, at: Column) -> Column:
        real = lambda x: x["score"] >= threshold
        findings = F.transform(
            found,
            lambda x, i: F.struct(
                x["value"].alias("value"), F.get(at, i).alias("start"), x["score"].alias("score"), real(x).alias("real")
            ),
        )
        parts = F.transform(found, lambda x, i: F.concat(F.get(gaps, i), F.when(real(x), F.lit(MARK)).otherwise(x["value"])))
        return F.struct(
            findings.alias("findings"), F.concat(F.array_join(parts, ""), F.element_at(gaps, -1)).alias("redacted")
        )

    found = docs.withColumn("_found", let(F.split(body, CANDIDATE, -1), located))
    return found.withColumns(
        {
            "findings": F.col("_found")["findings"],
            "redacted": F.when(F.col(text).isNotNull(), F.col("_found")["redacted"]),
        }
    ).drop("_found")


def trained(docs: DataFrame, text: str = "text", path: str = "source", max_labelled: int = MAX_LABELLED):
    """Dictionary and compiled forest from the documents themselves, with the labels of ``weak_label``."""
    words = dictionary(docs, text=text)
    labelled = cut_lineage(labelled_findings(docs, words, max_labelled, text, path))
    return words, compiled(fit(labelled))


def redacted(docs: DataFrame) -> DataFrame:
    """docs with real findings in ``text`` replaced by a mark; all rows and columns stay."""
    words, score = trained(docs)
    whole = docs.select(F.struct("*").alias("_doc"), "text", "source")
    return (
        scan(whole, words, score)
        .select(F.col("_doc").withField("text", F.col("redacted")).alias("_doc"))
        .select("_doc.*")
    )
