"""Document quality rules: a table of thresholds compiled into one Spark projection."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"
#: Low bits of a window's key that hold its place: all that an array can have.
PLACE_BITS = 31
#: Frequent function words of the four languages; fixed values.
STOP_WORDS = (
    "the of and to in a is that for with "
    "der die und den von zu das mit auf ein "
    "le la les de des et en un une du "
    "el los y del por con las que se al"
).split()

#: As they are counted: in lower case, and with a capital as at the start of a sentence.
STOP_FORMS = [*dict.fromkeys(STOP_WORDS), *dict.fromkeys(w.capitalize() for w in STOP_WORDS)]


class Threshold(NamedTuple):
    """Documents pass if low <= measure <= high (a missing side always holds)."""

    measure: str
    low: float | None
    high: float | None


#: Of the kind that web corpora are filtered by; every document has to pass all.
THRESHOLDS = (
    Threshold("mean_word_length", 2.0, 14.0),
    Threshold("symbols_per_word", None, 0.10),
    Threshold("stop_word_ratio", 0.05, None),
    Threshold("letter_ratio", 0.60, None),
    Threshold("upper_ratio", None, 0.50),
    Threshold("dup_line_ratio", None, 0.50),
    Threshold("repeat_word_ratio", None, 0.50),
)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _at(c: Column | str, i: Column) -> Column:
    return F.get(F.col(c) if isinstance(c, str) else c, i)


def settled(df: DataFrame, passed: list[str], computed: list[Column | str]) -> DataFrame:
    """``passed`` columns as they are and ``computed`` ones worked out once.

    A generator of one row: no filter or join on what it makes moves below it,
    where each statistic would be written out anew at every use of it, and
    filters on the passed columns still reach the scan.
    """
    return df.select(*passed, F.inline(F.array(F.struct(*computed))))


def measures(df: DataFrame, kept: list[str], text_col: str = "text") -> DataFrame:
    """One row a document, with the columns ``kept`` as c0, c1 and on, its counts and its ratios, by DataFrame functions alone.

    Words found in 3-word windows that occur twice: a window's hash with its
    place in the low bits is sorted as a plain long array, equal neighbours
    name the places that may repeat, and only those are compared as strings
    (sorted with their places), so long texts cost n log n. Null text is
    empty. Every count is of the whole text.
    """
    own = [f"c{i}" for i in range(len(kept))]
    t = df.select(*(F.col(f"`{c}`").alias(o) for c, o in zip(kept, own, strict=True)), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    t = t.select(
        *own,
        F.array_remove(F.split("t", f"[{SPACE}]+"), "").alias("w"),
        F.filter(F.split("t", "\n", -1), lambda x: x.rlike(f"[^{SPACE}]")).alias("lines"),
        F.length(F.regexp_replace("t", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("t", r"\P{Lu}+", "")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace("t", r"\P{L}+", "")).cast("long").alias("n_letters"),
    )
    n = F.size("w").cast("long")
    places = F.when(F.size("w") >= 3, F.sequence(F.lit(0), F.size("w") - 3)).otherwise(F.array().cast("array<int>"))
    low = F.lit((1 << PLACE_BITS) - 1).cast("long")
    keys = F.transform(places, lambda i: F.xxhash64(_at("w", i), _at("w", i + 1), _at("w", i + 2)).bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long")))
    counts = (
        n.alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.size(F.filter("w", lambda x: x.isin(*STOP_FORMS))).cast("long").alias("n_stop_words"),
    )
    t = t.select("*", *counts, F.sort_array(keys).alias("k"))
    # neighbours with the same hash: the pairs of a sorted array and itself one place on
    head = F.when(F.size("k") >= 2, F.slice("k", 1, F.size("k") - 1)).otherwise(F.array().cast("array<bigint>"))
    tail = F.when(F.size("k") >= 2, F.slice("k", 2, F.size("k") - 1)).otherwise(F.array().cast("array<bigint>"))
    both = F.flatten(F.filter(F.zip_with(head, tail, lambda a, b: F.when(a.bitwiseXOR(b) <= low, F.when(a.bitwiseXOR(b) >= 0, F.array(a.bitwiseAND(low).cast("int"), b.bitwiseAND(low).cast("int"))))), lambda x: x.isNotNull()))
    t = t.select("*", F.array_distinct(both).alias("m"))
    grams = F.transform(F.col("m"), lambda i: F.struct(F.concat_ws(" ", _at("w", i), _at("w", i + 1), _at("w", i + 2)).alias("g"), i.alias("i")))
    t = t.select("*", F.sort_array(grams).alias("g"))
    some = F.size("g") >= 2
    none = F.expr("cast(array() as array<struct<g:string,i:int>>)")
    first = F.when(some, F.slice("g", 1, F.size("g") - 1)).otherwise(none)
    second = F.when(some, F.slice("g", 2, F.size("g") - 1)).otherwise(none)
    same = F.flatten(F.filter(F.zip_with(first, second, lambda a, b: F.when(a["g"] == b["g"], F.array(a["i"], b["i"]))), lambda x: x.isNotNull()))
    t = t.select("*", F.sort_array(F.array_distinct(same)).alias("d"))
    gaps = F.zip_with(F.slice("d", 1, F.greatest(F.size("d") - 1, F.lit(0))), F.slice("d", 2, F.greatest(F.size("d") - 1, F.lit(0))), lambda a, b: F.least(b - a, F.lit(3)))
    covered = F.when(F.size("d") > 0, F.aggregate(gaps, F.lit(3), lambda s, x: s + x)).otherwise(F.lit(0))
    counts = [
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        "n_stop_words",
        "n_upper",
        "n_letters",
    ]
    return settled(t, own, counts).select(
        "*",
        _ratio(F.col("word_chars"), F.col("n_words")).alias("mean_word_length"),
        _ratio(F.col("n_symbols"), F.col("n_words")).alias("symbols_per_word"),
        _ratio(F.col("n_stop_words"), F.col("n_words")).alias("stop_word_ratio"),
        _ratio(F.col("n_letters"), F.col("word_chars")).alias("letter_ratio"),
        _ratio(F.col("n_upper"), F.col("n_letters")).alias("upper_ratio"),
        _ratio(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_ratio"),
        _ratio(F.col("n_repeat_words"), F.col("n_words")).alias("repeat_word_ratio"),
    )


def compiled(thresholds: tuple[Threshold, ...]) -> Column:
    """The table as one boolean column."""
    verdict = F.lit(True)
    for t in thresholds:
        if t.low is not None:
            verdict = verdict & (F.col(t.measure) >= F.lit(t.low))
        if t.high is not None:
            verdict = verdict & (F.col(t.measure) <= F.lit(t.high))
    return verdict


def apply_rules(df: DataFrame, thresholds: tuple[Threshold, ...] = THRESHOLDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A verdict for each document: its counts, ``base_failed`` and ``kept``.

    base_failed: under 50 words, or over half of the words lie in 3-word
    windows that occur twice. kept: not base_failed, and every threshold
    holds. Null and empty texts have zero counts and are not kept; a repeated
    id gives a row each time; ids may be null. A narrow projection: no
    shuffle, no Python.
    """
    out = measures(df, [id_col], text_col)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select(
        F.col("c0").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & compiled(thresholds)).alias("kept"),
        "mean_word_length", "symbols_per_word", "stop_word_ratio", "letter_ratio", "upper_ratio", "dup_line_ratio",
    )


def only(rows: DataFrame, columns: list[str], keep: Column) -> DataFrame:
    """The rows of ``measures`` for which ``keep`` holds, with their kept columns under their own names."""
    return rows.filter(keep).select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(columns)))


def kept_documents(df: DataFrame, thresholds: tuple[Threshold, ...] = THRESHOLDS, text_col: str = "text") -> DataFrame:
    """The documents that ``apply_rules`` keeps, with all their columns, in the same narrow pass."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return only(measures(df, df.columns, text_col), df.columns, ~failed & compiled(thresholds))
