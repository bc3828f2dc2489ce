"""Quality rules: a table of thresholds compiled into one projection of built-in expressions.

Every measure of a text is one column expression. `with_measures` computes them in one pass,
without a shuffle and without Python. Null and empty texts have no words and count 0 in every
measure; texts of any length are measured whole; repeated rows are judged alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from igarape.llm.common import WHITE, let

# Common words of the four languages of the corpus.
STOP_WORDS = (
    "a an and are as at be by for from has have he her his in is it its not of on or she that the their "
    "they this to was we were which will with you "
    "au aux avec ce ces cette dans des du elle en est et il ils je la le les leur mais ne nous ou par pas "
    "pour que qui sa se ses son sur un une vous "
    "al como con de del el ella es esta este lo los las mas más no o para pero por su sus una y "
    "aber als auch auf aus bei das dem den der des die ein eine einen er für ich im ist mit nicht sein sich "
    "sie sind und von war wie zu zum"
).split()


@dataclass(frozen=True)
class Rule:
    """A text passes if `numerator` / `denominator` lies in [least, most]; a zero denominator passes."""

    name: str
    numerator: str
    denominator: str
    least: float | None = None
    most: float | None = None


BASE_RULES = (
    Rule("words", "n_words", "one", least=50),
    Rule("repeated_words", "n_repeat_words", "n_words", most=0.5),
)
MORE_RULES = (
    Rule("word_length", "word_chars", "n_words", least=2.0, most=20.0),
    Rule("symbols", "n_symbols", "n_words", most=0.1),
    Rule("shouting", "n_marks", "n_words", most=0.3),
    Rule("stop_words", "n_stop_words", "n_words", least=0.02),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", most=0.6),
)


def _words(text: Column) -> Column:
    inner = F.trim(text, F.lit(WHITE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, "[\\x20\\x09-\\x0D]+"))


def _covered(at: Column) -> Column:
    """Number of places in windows of three that start at the ascending places `at`."""
    steps = F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3))))
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def _repeated(words: Column) -> Column:
    """Number of words that lie in a window of three words found at least twice.

    Windows are compared by 64-bit hashes. Equal neighbours among the sorted hashes are the
    repeated ones. Their places are found by look-up where few hashes repeat, and else by
    sorting hashes together with places, which stays n log n on any text.
    """
    few = 32

    def by_lookup(hashes: Column, found: Column) -> Column:
        at = F.transform(hashes, lambda h, i: F.when(F.array_contains(found, h), i))
        return let(F.filter(at, lambda p: p.isNotNull()), _covered)

    def by_sorting(hashes: Column) -> Column:
        def places(pairs: Column) -> Column:
            at = F.transform(
                pairs,
                lambda x, i: F.when(
                    (F.get(pairs, i + 1)["h"] == x["h"]) | (F.get(pairs, i - 1)["h"] == x["h"]), x["i"]
                ),
            )
            return let(F.sort_array(F.filter(at, lambda p: p.isNotNull())), _covered)

        return let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), places)

    def repeats(hashes: Column) -> Column:
        def found(ordered: Column) -> Column:
            return F.array_distinct(F.filter(ordered, lambda h, i: h == F.get(ordered, i - 1)))

        return let(
            let(F.sort_array(hashes), found),
            lambda d: F.when(F.size(d) == 0, F.lit(0))
            .when(F.size(d) <= few, by_lookup(hashes, d))
            .otherwise(by_sorting(hashes)),
        )

    each = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    return F.when(F.size(words) < 3, F.lit(0)).otherwise(let(each, repeats))


def measures(text: Column) -> Column:
    """A struct of all measures of a text."""

    def over(parts: Column) -> Column:
        t, words, lines = parts["t"], parts["words"], parts["lines"]
        return F.struct(
            F.lit(1).cast("long").alias("one"),
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            F.regexp_count(t, F.lit("[!?~^=_{}\\[\\]\\\\]")).cast("long").alias("n_marks"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _repeated(words).cast("long").alias("n_repeat_words"),
        )

    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.trim(x, F.lit(WHITE)) != "")
    return let(F.struct(t.alias("t"), _words(t).alias("words"), lines.alias("lines")), over)


def verdict(measured: Column, rules: tuple[Rule, ...]) -> Column:
    """True if every rule of the table holds; exact, since ratios are compared as products."""
    passed = F.lit(True)
    for rule in rules:
        number, whole = measured[rule.numerator], measured[rule.denominator]
        if rule.least is not None:
            passed = passed & (number >= F.lit(rule.least) * whole)
        if rule.most is not None:
            passed = passed & (number <= F.lit(rule.most) * whole)
    return passed


def judge(docs: DataFrame, text: str = "text", into: str = "quality", rules: tuple[Rule, ...] = MORE_RULES) -> DataFrame:
    """`docs` with a struct column `into`: the measures, `base_failed` and `kept`."""

    def decided(measured: Column) -> Column:
        failed = ~verdict(measured, BASE_RULES)
        kept = ~failed & verdict(measured, rules)
        return measured.withField("base_failed", failed).withField("kept", kept)

    return docs.withColumn(into, let(measures(F.col(text)), decided))
