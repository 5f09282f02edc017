"""Quality rules: a table of thresholds compiled into one Spark projection.

Everything is a built-in function; there is no Python on the rows. Measures of a
text are counts of words, symbols, stop words and lines. ``THRESHOLDS`` bounds
ratios of them, and ``verdict`` compiles the table into one expression.

Words repeated in eight-word windows are found inside the row in n log n steps:
window hashes are built by doubling (1, 2, 4, 8 words), and only a text in which
a hash repeats sorts its (hash, position) pairs and compares the words of
neighbours, so a hash collision cannot make a window count as repeated.

Defined results: a null text has no words and fails the length rule; very long texts
are judged whole; a ratio just at its threshold passes where the table says so; an empty
table gives no rows; repeated rows are judged each for itself; other columns,
whatever their names, are ignored (``filter_documents`` returns them unchanged).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorecard.llm.common import WHITE, texts_of, word_array

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from in is it not of on or that the this to was were with "
    "auf aus das dem den der des die ein eine einen für im ist mit nicht sich sie und von zu "
    "au aux avec ce dans de du elle en est et la le les ne par pas pour que qui sur un une "
    "al como con del el es las los lo más no para por se su una y"
).split()

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
# Up to so many repeated hashes a text is searched for each; beyond, it is sorted.
FEW_HASHES = 64


@dataclass(frozen=True)
class Threshold:
    """A ratio ``over / under`` of two measures and its inclusive bounds."""

    name: str
    over: str
    under: str
    low: float | None = None
    high: float | None = None


THRESHOLDS = (
    Threshold("mean word length", "word_chars", "n_words", low=2.0, high=15.0),
    Threshold("symbols per word", "n_symbols", "n_words", high=0.25),
    Threshold("shouting per word", "n_exclamations", "n_words", high=0.3),
    Threshold("upper case share", "n_upper", "word_chars", high=0.5),
    Threshold("stop words per word", "n_stop_words", "n_words", low=0.06),
    Threshold("letter share", "n_letters", "word_chars", low=0.6),
    Threshold("words equal to the one before", "n_stutters", "n_words", high=0.2),
    Threshold("repeated lines", "n_dup_lines", "n_lines", high=0.5),
    Threshold("lines ending in an ellipsis", "n_ellipsis_lines", "n_lines", high=0.5),
    Threshold("bullet lines", "n_bullet_lines", "n_lines", high=0.9),
)


def compiled(thresholds: tuple[Threshold, ...] = THRESHOLDS) -> Column:
    """One Boolean expression for the whole table; an absent ratio passes."""

    def rule(t: Threshold) -> Column:
        # Compared without division, so nothing is undefined at zero.
        over, under = F.col(t.over).cast("double"), F.col(t.under).cast("double")
        tests = []
        if t.low is not None:
            tests.append(over >= F.lit(t.low) * under)
        if t.high is not None:
            tests.append(over <= F.lit(t.high) * under)
        return reduce(lambda a, b: a & b, tests)

    return reduce(lambda a, b: a & b, map(rule, thresholds), F.lit(True))


def _doubled(array: str, by: int) -> Column:
    """Hashes of runs twice as long; runs past the end are hashes of what is left."""
    return F.transform(array, lambda h, i: F.xxhash64(h, F.get(array, i + by)))


def _stutters() -> Column:
    return F.filter("_h1", lambda h, i: h == F.get("_h1", i + 1))


def _repeated_words() -> Column:
    """Words covered by windows that occur twice or more, from ``_runs`` and ``_words``."""
    # A one-element array carries an expression into a lambda, so it is made once.
    once = lambda value, f: F.element_at(F.transform(F.array(value), f), 1)
    pair = lambda h, i: F.struct(h.alias("h"), i.alias("i"))

    def repeated(ordered: Column) -> Column:
        return F.array_distinct(F.filter(ordered, lambda h, i: h == F.get(ordered, i + 1)))

    def candidates(hashes: Column) -> Column:
        """Pairs whose hash repeats; with many such hashes all pairs, which sort alike."""
        few = F.transform(
            "_runs", lambda h, i: F.when(F.array_contains(hashes, h), pair(h, i))
        )
        return F.sort_array(
            F.when(F.size(hashes) <= FEW_HASHES, F.array_compact(few)).otherwise(
                F.transform("_runs", pair)
            )
        )

    def same(a: Column, b: Column) -> Column:
        window = lambda x: F.slice(F.col("_words"), x["i"] + 1, WINDOW)
        return F.when(a["h"] == b["h"], window(a) == window(b)).otherwise(F.lit(False))

    def starts(sorted_pairs: Column) -> Column:
        count = F.size(sorted_pairs) - 1
        equal = F.zip_with(
            F.slice(sorted_pairs, 1, count),
            F.slice(sorted_pairs, 2, count),
            lambda a, b: F.when(same(a, b), F.array(a["i"], b["i"])),
        )
        return F.sort_array(F.array_distinct(F.flatten(F.array_compact(equal))))

    def covered(positions: Column) -> Column:
        count = F.greatest(F.size(positions) - 1, F.lit(0))
        gaps = F.zip_with(
            F.slice(positions, 1, count),
            F.slice(positions, 2, count),
            lambda a, b: F.least(b - a, F.lit(WINDOW)),
        )
        return F.when(F.size(positions) == 0, F.lit(0)).otherwise(
            F.aggregate(gaps, F.lit(WINDOW), lambda total, gap: total + gap)
        )

    positions = once(once(once(F.sort_array("_runs"), repeated), candidates), starts)
    return F.when(
        F.size(F.array_distinct("_runs")) < F.size("_runs"), once(positions, covered)
    ).otherwise(F.lit(0))


def measures(docs: DataFrame) -> DataFrame:
    """One row per document with every count that the rules use."""
    text = F.col("text")
    base = texts_of(docs).select(
        "doc_id",
        "text",
        word_array(text).alias("_words"),
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "").alias("_lines"),
    )
    hashed = base.withColumn("_h1", F.transform("_words", lambda w: F.xxhash64(w)))
    for size in (1, 2, 4):
        hashed = hashed.withColumn(f"_h{2 * size}", _doubled(f"_h{size}", size))
    whole = F.greatest(F.size("_h8") - (WINDOW - 1), F.lit(0))
    hashed = hashed.withColumn("_runs", F.slice("_h8", F.lit(1), whole))
    line_end = lambda x: F.btrim(x, F.lit(WHITE))
    cased = dict.fromkeys(w for s in STOP_WORDS for w in (s, s.capitalize()))
    stop = [F.xxhash64(F.lit(w)) for w in cased]
    return hashed.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        (F.length(text) - F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]")))
        .cast("long")
        .alias("word_chars"),
        F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words().cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.regexp_count(text, F.lit("!")).cast("long").alias("n_exclamations"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace(text, r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
        F.size(F.filter("_h1", lambda h: h.isin(stop)))
        .cast("long")
        .alias("n_stop_words"),
        F.size(_stutters()).cast("long").alias("n_stutters"),
        F.size(F.filter("_lines", lambda x: line_end(x).endswith("...") | line_end(x).endswith("…")))
        .cast("long")
        .alias("n_ellipsis_lines"),
        F.size(
            F.filter(
                "_lines",
                lambda x: line_end(x).startswith("•")
                | line_end(x).startswith("* ")
                | line_end(x).startswith("- "),
            )
        )
        .cast("long")
        .alias("n_bullet_lines"),
    )


def judge(docs: DataFrame, thresholds: tuple[Threshold, ...] = THRESHOLDS) -> DataFrame:
    """``measures`` with base_failed and kept."""
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    return measures(docs).select(
        "*", failed.alias("base_failed"), (~failed & compiled(thresholds)).alias("kept")
    )


def filter_documents(docs: DataFrame, thresholds: tuple[Threshold, ...] = THRESHOLDS) -> DataFrame:
    """Rows of ``docs`` that pass, judged in place: no join, no shuffle."""
    names = docs.columns
    carried = docs.select(F.struct(*names).alias("_row"), F.col("text"), F.lit(0).alias("doc_id"))
    wrapped = carried.select(F.col("_row").alias("doc_id"), "text")
    # A row number keeps the optimiser from copying every measure into the filter.
    judged = judge(wrapped, thresholds).withColumn("_n", F.monotonically_increasing_id())
    return judged.where(F.col("kept") & (F.col("_n") >= 0)).select("doc_id.*")
