"""Quality rules: a table of thresholds compiled into one Spark projection.

Every figure of a text is a Spark expression; no user function is evaluated.
A rule names a figure and the bounds it must keep; ``verdict`` compiles a rule
table into one boolean column.

Defined results: a null text has no words; a text without words has ratios of 0 and
fails the base rule; a very long text is one row, whose lists of words and windows are in the memory of one task; rows are judged one by one, so repeated rows get equal
results; an empty table gives an empty result; other columns are kept, and a figure whose name is taken gets an underscore in front.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, fresh, numbered, pinned, quoted, with_text

# The commonest function words of four languages, as published in general word-frequency lists.
STOP_WORDS = (
    "the of and to in a is that for it on was with as be by this are at from or an not "
    "le la les de des du et un une en est que qui dans pour par sur au pas avec "
    "der die das und den von zu mit sich ist im nicht ein eine auf "
    "el los las que y se por con para del su al no una lo"
).split()


@dataclass(frozen=True)
class Rule:
    """A figure's share lies within [low, high]; None is no bound.

    A share is ``figure`` over ``of``, both counts; the compiled test multiplies out
    (bounds are hundredths), so that it is exact integer arithmetic.
    """

    figure: str
    of: str
    low: int | None = None
    high: int | None = None


#: Beside the base rule: the table that is compiled. Bounds are in hundredths.
RULES = (
    Rule("word_chars", "n_words", 200, 1400),
    Rule("n_symbols", "n_words", None, 10),
    Rule("n_stop_words", "n_words", 3, None),
    Rule("n_dup_lines", "n_lines", None, 50),
    Rule("n_upper", "word_chars", None, 30),
    Rule("n_exclaimed", "n_words", None, 10),
)
MIN_WORDS = 50
#: Most words, in hundredths of all, within repeated 3-word windows.
MAX_REPEATED = 50
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FIGURES = (*BASE, "n_lines", "n_stop_words", "n_upper", "n_exclaimed")


def words_of(text: Column) -> Column:
    """The words in order; no element for a text without any."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+", -1))


def verdict(rules: Sequence[Rule]) -> Column:
    """The rule table as one boolean column over the figures."""
    tests = [F.lit(True)]
    for r in rules:
        if r.low is not None:
            tests.append(100 * F.col(r.figure) >= r.low * F.col(r.of))
        if r.high is not None:
            tests.append(100 * F.col(r.figure) <= r.high * F.col(r.of))
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def figures(texts: DataFrame, text: str) -> DataFrame:
    """``texts`` with the counts of FIGURES for the string column ``text``, in narrow projections only.

    Repeated windows: the hashes of a text's 3-word windows are sorted with their
    positions, so that equal ones are neighbours. A hash has 64 bits and is
    compared within one text only.
    """
    lines = F.filter(F.split(F.col(text), "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    # Lists that lambdas look into are made once for each row.
    out = texts.select("*", pinned(words_of(F.col(text))).alias("_w"), pinned(lines).alias("_ls"))
    starts = F.when(F.size("_w") >= 3, F.sequence(F.lit(0), F.size("_w") - 3)).otherwise(F.array().cast("array<int>"))
    window = F.transform(starts, lambda i: F.struct(F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)).alias("h"), i.alias("i")))
    upper = F.regexp_count(F.col(text), F.lit("[A-ZÀ-ÖØ-Þ]"))
    out = out.select(
        "*",
        pinned(F.sort_array(window)).alias("_s"),
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count(F.col(text), F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_ls") - F.size(F.array_distinct("_ls"))).cast("long").alias("n_dup_lines"),
        F.size("_ls").cast("long").alias("n_lines"),
        F.size(F.filter("_w", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        upper.cast("long").alias("n_upper"),
        F.regexp_count(F.col(text), F.lit("!!")).cast("long").alias("n_exclaimed"),
    )
    hash_at = lambda j: F.get("_s", j)["h"]
    twice = F.filter("_s", lambda x, j: (hash_at(j - 1) == x["h"]) | (hash_at(j + 1) == x["h"]))
    covered = F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    return out.withColumn("n_repeat_words", pinned(F.size(covered)).cast("long")).drop("_w", "_ls", "_s")


def _judged(docs: DataFrame, text_col: str, rules: Sequence[Rule], min_words: int, max_repeated: int) -> DataFrame:
    """The columns of ``docs`` by number, the figures and the verdicts."""
    out = figures(docs.select(*numbered(docs, text_col), with_text(docs, text_col).alias("_text"), quoted(text_col).alias("_given")), "_text")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeated * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def _own(docs: DataFrame, text_col: str) -> list[Column]:
    return [F.col("_given" if c == text_col else f"_c{i}").alias(c) for i, c in enumerate(docs.columns)]


def quality_rules(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES, min_words: int = MIN_WORDS, max_repeated: int = MAX_REPEATED) -> DataFrame:
    """``docs`` with the figures, ``base_failed`` and ``kept``."""
    names = fresh(docs, *FIGURES, "base_failed", "kept")
    out = _judged(docs, text_col, rules, min_words, max_repeated)
    return out.select(*_own(docs, text_col), *[F.col(x).alias(n) for x, n in zip((*FIGURES, "base_failed", "kept"), names, strict=True)])


def keep_by_rules(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES, min_words: int = MIN_WORDS, max_repeated: int = MAX_REPEATED) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with its columns alone."""
    return _judged(docs, text_col, rules, min_words, max_repeated).where("kept").select(*_own(docs, text_col))
