"""Quality rules: a table of thresholds over length, symbol, stop-word and line
ratios, compiled into one projection of Spark's own functions.

Every measure is an expression over the words and lines of a text; ``compile``
turns the rows of the table into comparisons on them. No rule needs another
row, so there is no shuffle and nothing grows but the text at hand.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import SPACES

#: Fixed: frequent function words of the four languages the corpus declares.
STOP_WORDS = {
    "en": "the of and to is in that it for with on as at by this be are was from or an a not".split(),
    "fr": "le la les de des et un une en du que qui pour dans par sur au est avec il elle".split(),
    "de": "der die das und ist in den von zu mit ein eine nicht auf für sich auch dem des im".split(),
    "es": "el la los las de y que en un una del por con para es no se su al lo como".split(),
}


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie within [low, high]; None leaves a side open."""

    measure: str
    low: float | None = None
    high: float | None = None


#: The threshold table. Ratios are of words unless named otherwise.
RULES = (
    Rule("mean_word_chars", 3.0, 10.0),
    Rule("symbol_ratio", None, 0.10),
    Rule("stop_word_ratio", 0.06, None),
    Rule("upper_ratio", None, 0.30),      # upper-case ASCII letters of word characters
    Rule("dup_line_ratio", None, 0.30),   # repeated lines of lines
    Rule("words_per_line", 1.5, None),
)

WINDOW = 5


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and use it any number of times in ``body``."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column, n: Column) -> Column:
    """Words that lie in some window of five found at least twice in the text."""
    hashes = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(
        *[F.element_at(words, i + k + 1) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))

    def covered(h: Column) -> Column:
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def count(s: Column) -> Column:
            twice = F.filter(s, lambda e, k: ((k > 0) & (F.get(s, k - 1)["x"] == e["x"]))
                             | ((k < F.size(s) - 1) & (F.get(s, k + 1)["x"] == e["x"])))
            at = F.sort_array(F.transform(twice, lambda e: e["i"]))
            start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("last"))
            return F.aggregate(at, start, lambda a, i: F.struct(
                (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(_let(ranked, count))
    return _let(hashes, covered)


def measures(text: Column) -> dict[str, Column]:
    """Word and line counts of one text column (null: empty), as expressions over
    the arrays ``__words`` and ``__lines`` that ``score_quality`` projects first."""
    words, lines = F.col("__words"), F.col("__lines")
    n = F.size(words)
    listed = sorted({w + tail for ws in STOP_WORDS.values() for w in ws for tail in ("", ",", ".")})
    return {
        "n_words": n.cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": _repeat_words(words, n),
        "n_lines": F.size(lines).cast("long"),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(listed))).cast("long"),
        "n_upper": F.regexp_count(text, F.lit(r"[A-Z]")).cast("long"),
    }


RATIOS = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbol_ratio": ("n_symbols", "n_words"),
    "stop_word_ratio": ("n_stop_words", "n_words"),
    "upper_ratio": ("n_upper", "word_chars"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
    "words_per_line": ("n_words", "n_lines"),
}


def compile_rules(rules=RULES) -> Column:
    """The names of the rules a row breaks, as one array expression. A ratio
    without a denominator is 0."""
    broken = []
    for r in rules:
        top, bottom = RATIOS[r.measure]
        value = F.coalesce(F.try_divide(F.col(top).cast("double"), F.col(bottom)), F.lit(0.0))
        fails = F.lit(False)
        if r.low is not None:
            fails = fails | (value < r.low)
        if r.high is not None:
            fails = fails | (value > r.high)
        broken.append(F.when(fails, F.lit(r.measure)))
    return F.filter(F.array(*broken), lambda x: x.isNotNull())


def score_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """One row per input row: id, the base counts, ``base_failed`` (fewer than 10
    words, or over a fifth of them in repeated windows), ``broken`` (the rules of
    the table it breaks) and ``kept``.

    Null and empty texts have no words and fail; every row is judged by itself,
    so repeated rows get equal verdicts; an empty table gives none; only the two
    named columns are read.
    """
    text = F.coalesce(F.col("__text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = (docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
            .select("__id", "__text", F.array_remove(F.split(text, SPACES, -1), "").alias("__words"), lines.alias("__lines")))
    found = base.select("__id", *[c.alias(name) for name, c in measures(text).items()])
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    judged = found.select("*", failed.alias("base_failed"), compile_rules(rules).alias("broken"))
    return judged.select(F.col("__id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "broken", (~F.col("base_failed") & (F.size("broken") == 0)).alias("kept"))
