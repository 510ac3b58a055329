"""Quality rules: a table of thresholds compiled into one Spark projection, with no user function."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Frequent function words of the four languages of the tables.
STOP_WORDS = (
    "the of and to in a is that it for on was be as with by this are at from "
    "der die und das den von zu mit ist nicht sich des auf ein "
    "le la les de et des que un une est dans pour par qui "
    "el los las que en y del por se con una para no"
)
# The bytes that separate words, the characters counted as symbols, and those left off stop words.
BLANKS = " \t\n\u000b\u000c\r"
SYMBOLS = "#*$%&|<>"
STOPS = '.,;:!?"()'


@dataclass(frozen=True)
class Threshold:
    """A row of the table: ``metric`` must lie in [low, high]; an open side is None."""

    metric: str
    low: float | None = None
    high: float | None = None

    def holds(self) -> Column:
        value, ok = F.col(self.metric), F.lit(True)
        if self.low is not None:
            ok = ok & (value >= self.low)
        if self.high is not None:
            ok = ok & (value <= self.high)
        return F.coalesce(ok, F.lit(False))


DEFAULT_RULES: tuple[Threshold, ...] = (
    Threshold("n_words", low=10, high=100_000),
    Threshold("mean_word_chars", low=2.0, high=14.0),
    Threshold("symbol_ratio", high=0.1),
    Threshold("dup_line_ratio", high=0.5),
    Threshold("stop_word_ratio", low=0.02),
    Threshold("shout_ratio", high=0.5),
)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, even where lambdas in it use the value again and again."""
    return F.transform(F.array(value), body)[0]


def split_words(text: Column) -> Column:
    plain = F.translate(F.coalesce(text, F.lit("")), BLANKS[1:], " " * (len(BLANKS) - 1))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def _covered(grams: Column, width: int) -> Column:
    """Positions inside a window whose hash stands twice or more in ``grams``."""
    pairs = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    twice = let(
        pairs,
        lambda s: F.filter(
            s,
            lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)),
        ),
    )
    starts = F.sort_array(F.transform(twice, lambda x: x["p"]))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        starts,
        zero,
        lambda acc, p: F.struct((acc["n"] + (p + width - F.greatest(p, acc["end"]))).cast("long").alias("n"), (p + width).alias("end")),
        lambda acc: acc["n"],
    )


def repeat_words(words: Column, width: int = 5) -> Column:
    """Words in ``width``-word windows found twice or more in the text, the first included.

    The sort that finds positions runs only for texts in which some window repeats."""

    def grams(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)]))

    def count(h: Column) -> Column:
        return F.when(F.size(h) <= width, F.lit(0).cast("long")).otherwise(
            let(grams(h), lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(_covered(g, width)))
        )

    return let(F.transform(words, lambda w: F.xxhash64(w)), count)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """The metrics of every whole text beside its row, in a struct ``m`` next to the struct ``row`` of the input's columns.

    A null text counts as an empty one: no words, no lines, ratios 0."""
    stops = sorted(set(STOP_WORDS.split()))
    stops += [w.capitalize() for w in stops]
    body = F.coalesce(F.col(f"row.`{text}`"), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.translate(x, BLANKS, "") != "")

    def per_word(ws: Column) -> Column:
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.size(F.filter(ws, lambda w: F.translate(w, STOPS, "").isin(stops))).alias("n_stop"),
            F.size(F.filter(ws, lambda w: (F.length(w) > 1) & (w == F.upper(w)) & (w != F.lower(w)))).alias("n_shout"),
            repeat_words(ws).alias("n_repeat_words"),
        )

    def per_line(ls: Column) -> Column:
        return F.struct(F.size(ls).alias("n_lines"), (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"))

    own = docs.select(F.struct("*").alias("row"))
    own = own.select(
        "row",
        let(split_words(body), per_word).alias("w"),
        let(lines, per_line).alias("l"),
        F.length(F.translate(body, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    words = F.greatest(F.col("w.n_words"), F.lit(1))
    return own.select(
        "row",
        F.struct(
            "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words",
            (F.col("word_chars") / words).alias("mean_word_chars"),
            (F.col("n_symbols") / words).alias("symbol_ratio"),
            (F.col("l.n_dup_lines") / F.greatest(F.col("l.n_lines"), F.lit(1))).alias("dup_line_ratio"),
            (F.col("w.n_stop") / words).alias("stop_word_ratio"),
            (F.col("w.n_shout") / words).alias("shout_ratio"),
        ).alias("m"),
    )


def quality_rules(docs: DataFrame, rules: Sequence[Threshold] = DEFAULT_RULES, text: str = "text") -> DataFrame:
    """Metrics, ``base_failed`` and ``kept`` of every row of ``docs``; nothing but maps over rows, so no shuffle.

    ``base_failed``: fewer than 10 words, or over a fifth of them in repeated five-word windows.
    ``kept``: not ``base_failed``, and every threshold holds. Null and empty texts fail the base.
    Repeated rows each get their own row back. Input columns come back in the struct ``row``,
    so names may clash freely."""
    own = measure(docs, text).select("row", "m.*")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    verdict = F.lit(True)
    for rule in rules:
        verdict = verdict & rule.holds()
    return own.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict)
