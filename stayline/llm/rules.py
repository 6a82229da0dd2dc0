"""Quality rules: a table of thresholds compiled into one projection.

Every measure is an expression over the text of its own row, so the whole operator is a narrow projection: no shuffle, no
user function, no driver action, and a lost executor repeats only its own splits.

Defined cases: a null or empty text has no words and fails the base rule, as does a text of white space only; a null
measure never occurs because every ratio is divided by at least one. Columns of the input are kept as they are; a column of
the same name as a measure is replaced by the measure.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_SPLIT = "[\\x20\\x09-\\x0D]+"
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "a an and are as at be by for from has he in is it its of on or that the this to was were will with "
    "au avec ce dans de des du elle en est et la le les ne pas pour que qui se sur un une "
    "auf das dem den der die ein eine für ich im in ist mit nicht sich sie und von zu "
    "con como del el la las los no para por que se su una y"
).split()


@dataclass(frozen=True)
class Rule:
    """A document is rejected when ``measure`` lies outside [low, high]; an open side is None."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None

    def violated(self) -> Column:
        value, tests = F.col(self.measure), []
        if self.low is not None:
            tests.append(value < F.lit(self.low))
        if self.high is not None:
            tests.append(value > F.lit(self.high))
        out = F.lit(False)
        for test in tests:
            out = out | test
        return F.coalesce(out, F.lit(False))


RULES = (
    Rule("symbols per word", "symbol_ratio", high=0.3),
    Rule("upper case", "upper_ratio", high=0.4),
    Rule("mean word length", "mean_word_chars", low=1.5, high=40.0),
    Rule("repeated lines", "dup_line_ratio", high=0.6),
    Rule("stop words of texts long enough to have some", "stop_shortfall", high=0.0),
)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, whatever the optimizer does with projections."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _words_in_repeated_windows(words: Column) -> Column:
    """Words of a text that lie in a window of five words occurring more than once in it.

    Windows are compared by a 64-bit hash of their words' hashes. Where all differ the count is zero; else they are sorted
    inside the row, equal neighbours mark repeated starts, and each start adds the words up to the next repeated start,
    five at most.
    """

    def hashed(codes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(codes) - WINDOW)
        return let(
            F.transform(starts, lambda i: F.xxhash64(*(F.get(codes, i + k) for k in range(WINDOW)))),
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
                let(F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), repeated)
            ),
        )

    def repeated(s: Column) -> Column:
        kept = F.filter(
            s,
            lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)),
        )
        return let(F.array_sort(F.transform(kept, lambda x: x["i"])), covered)

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda at, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - at, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    coded = let(F.transform(words, lambda w: F.xxhash64(w)), hashed)
    return F.when(F.size(words) > WINDOW, coded).otherwise(F.lit(0)).cast("long")


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the base counts and the ratios of the threshold table."""
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(body, WORD_SPLIT), lambda w: w != "")
    lines = F.filter(F.split(body, "\n"), lambda x: F.translate(x, BLANKS, "") != "")
    # Capitals and symbols are few: one pass cuts the text down to them, and both counts look at what is left.
    marks = F.regexp_replace(body, "[^\\p{Lu}#*$%&|<>]+", "")
    out = df.withColumns({"_words": words, "_lines": lines, "_marks": marks, ONCE: F.monotonically_increasing_id()})
    out = out.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "_n_upper": F.length(F.translate("_marks", SYMBOLS, "")),
            "_n_marks": F.length("_marks"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": _words_in_repeated_windows(F.col("_words")),
            "_n_lines": F.size("_lines"),
            "_stop": F.size(F.filter("_words", lambda w: w.isin(*STOP_WORDS, *(x.capitalize() for x in STOP_WORDS)))),
        }
    ).withColumn("n_symbols", (F.col("_n_marks") - F.col("_n_upper")).cast("long"))
    words_or_one = F.greatest(F.col("n_words"), F.lit(1))
    return out.withColumns(
        {
            "symbol_ratio": F.col("n_symbols") / words_or_one,
            "upper_ratio": F.col("_n_upper") / F.greatest(F.col("word_chars"), F.lit(1)),
            "mean_word_chars": F.col("word_chars") / words_or_one,
            "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("_n_lines"), F.lit(1)),
            # A text of at least 60 words should have one stop word in a hundred.
            "stop_shortfall": F.when(F.col("n_words") >= 60, F.col("n_words") * 0.01 - F.col("_stop")).otherwise(-1.0),
        }
    ).drop("_words", "_lines", "_marks", "_n_upper", "_n_marks", "_n_lines", "_stop")


# Numbers the rows where the text is cut. A filter that names it is not moved below that place, where each measure it looks at
# would cut the text again.
ONCE = "_once"
MEASURES = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words symbol_ratio upper_ratio mean_word_chars dup_line_ratio "
    "stop_shortfall"
).split()


def apply_rules(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """One row per input row with the measures, ``base_failed``, ``failed_rules`` (names) and ``kept``."""
    added = [*MEASURES, "base_failed", "failed_rules", "kept"]
    whole = df.select(F.struct("*").alias("_doc"), F.col(text).alias("_text"))
    own = (F.col("_doc")[c].alias(c) for c in df.columns if c not in added)
    return _judged(whole, rules, "_text").select(*own, *added)


def _judged(df: DataFrame, rules: tuple[Rule, ...], text: str) -> DataFrame:
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    failed = F.array_compact(F.array(*(F.when(rule.violated(), F.lit(rule.name)) for rule in rules)))
    return (
        measures(df, text)
        .withColumns({"base_failed": base, "failed_rules": failed if rules else F.array().cast("array<string>")})
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    )


def passing(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows that the rules keep, with the columns of the input."""
    whole = docs.select(F.struct("*").alias("_doc"), F.col(text).alias("_text"))
    return _judged(whole, rules, "_text").where(F.col("kept") & (F.col(ONCE) >= 0)).select("_doc.*")
