"""Quality rules: a threshold table compiled into Spark projections, without user functions.

Each rule of :data:`RULES` compares one ratio with a lower and an upper bound.
``measure`` computes the counts of every text, ``verdict`` turns the table into
one boolean per row. All of it is row-local: no shuffle, no Python on the
executors, memory bounded by one row.

Defined cases: a null text has no words and fails the base rule; an empty
table gives an empty result; repeated rows are judged alike; other columns
pass through ``filter_documents`` unchanged, whatever their names.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACE, fresh, words

#: Frequent function words of the four languages of the documents.
STOP_WORDS = (
    "the of and to in a is that for it was on with as be by at this from or are an "
    "der die das und in zu den von mit ist des im für auf nicht ein eine als auch es "
    "le la les de des et en un une du que est pour dans par sur pas au il elle "
    "el la los las de del y en que un una por con para es se al lo su no"
).split()

WINDOW = 8


class Rule(NamedTuple):
    """Keep a text only if ``low <= numerator / denominator <= high``."""

    name: str
    numerator: str
    denominator: str
    low: float
    high: float


#: The threshold table. Counts are columns made by :func:`measure`.
RULES = (
    Rule("word_length", "word_chars", "n_words", 1.5, 40.0),
    Rule("symbols", "n_symbols", "n_words", 0.0, 0.12),
    Rule("exclamations", "n_bangs", "n_words", 0.0, 0.25),
    Rule("capitals", "n_capitals", "n_letters", 0.0, 0.35),
    Rule("stop_words", "n_stop", "n_words", 0.01, 1.0),
    Rule("repeated_lines", "n_dup_lines", "n_lines", 0.0, 0.5),
)


def _neighbours(array: Column, distance: int, combine) -> Column:
    """``combine(a[i], a[i + distance])`` for every i that has such a partner."""
    n = F.greatest(F.size(array) - distance, F.lit(0))
    return F.zip_with(F.slice(array, 1, n), F.slice(array, distance + 1, n), combine)


def _without(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def measure(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row of counts per text, after the columns ``keep``.

    Repeated 8-word windows are found by the 64-bit hashes of the windows
    (doubled from word hashes: 1, 2, 4, 8 words), equal hashes being neighbours
    after a sort; only texts with fewer distinct hashes than windows are sorted.
    """
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    cols = [F.col(f"`{c}`") for c in keep]
    out = df.select(*cols, t.alias("_t"), words(t).alias("_w"))
    lines = F.filter(F.split(F.col("_t"), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = out.select(*cols, "_t", "_w", lines.alias("_l"), F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"))
    for i, step in enumerate((1, 2, 4)):
        src, dst = "_h" if i == 0 else f"_g{i}", f"_g{i + 1}"
        rest = [c for c in out.columns if c != src]
        out = out.select(*[F.col(f"`{c}`") for c in rest], _neighbours(F.col(src), step, lambda a, b: F.xxhash64(a, b)).alias(dst))
    enough = F.size("_w") >= WINDOW
    has_repeat = enough & (F.size(F.array_distinct("_g3")) < F.size("_g3"))
    out = out.select(
        *cols,
        "_t",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        _without(F.col("_t"), r"[#*$%&|<>]+").cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.size("_l").cast("long").alias("n_lines"),
        F.size(F.filter("_w", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop"),
        F.when(
            has_repeat, F.array_sort(F.transform("_g3", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        ).alias("_s"),
    )
    pairs = _neighbours(F.col("_s"), 1, lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    starts = F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))
    out = out.withColumn("_p", F.when(F.col("_s").isNotNull(), starts)).drop("_s")
    gaps = _neighbours(F.col("_p"), 1, lambda a, b: F.least(b - a, F.lit(WINDOW)))
    covered = F.aggregate(gaps, F.lit(WINDOW).cast("long"), lambda acc, g: acc + g)
    return out.select(
        *cols,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.when(F.col("_p").isNotNull(), covered).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
        "n_lines",
        "n_stop",
        _without(F.col("_t"), "!+").cast("long").alias("n_bangs"),
        _without(F.col("_t"), r"\p{Lu}+").cast("long").alias("n_capitals"),
        _without(F.col("_t"), r"\p{L}+").cast("long").alias("n_letters"),
    )


def base_failed() -> Column:
    """Too few words, or more than 30 % of them in repeated 8-word windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rule_passes(rule: Rule) -> Column:
    """The ratio lies within its bounds (multiplied out; a zero denominator passes)."""
    num, den = F.col(rule.numerator).cast("double"), F.col(rule.denominator).cast("double")
    return (num >= F.lit(rule.low) * den) & (num <= F.lit(rule.high) * den)


def verdict(counts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add ``base_failed``, ``kept`` and the names of the failed rules."""
    failed = F.filter(
        F.array(*[F.when(~rule_passes(r), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull()
    )
    return (
        counts.withColumn("base_failed", base_failed())
        .withColumn("failed_rules", F.array_join(failed, ","))
        .withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))
    )


def filter_documents(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``df`` that the rules keep, columns unchanged."""
    box = fresh(df, "_row")
    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(box), F.col(f"`{text}`").alias("_text"))
    judged = verdict(measure(whole, "_text", keep=(box,)), rules)
    # a row number keeps the optimizer from moving the filter down and unfolding all counts into it
    kept = judged.withColumn("_at", F.monotonically_increasing_id()).where("kept and _at >= 0")
    return kept.select(*[F.col(box)[c].alias(c) for c in df.columns])
