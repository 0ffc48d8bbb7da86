"""Mixing sources to target weights by entropy balancing.

Rates r(i) minimise the relative entropy to one copy of every document,
subject to one token constraint per source, sum r(i) * size(i) = target, and to
r <= 2. The solution is an exponential tilt, r = min(2, exp(lambda * size)),
with one dual variable per source; Newton steps on the convex dual find it.

Documents of one source and size share a rate, so the solver reads a stored histogram
(source, size, count) and not the documents. A Newton iteration is a distributed sum: the
tokens and their slope at every source's dual variable, over all rows of the histogram,
added up exactly (as decimals) and so alike in every run; the dual variables are a table
of one row per source. Copies are then settled per class
(source, size), carrying the rounding error from long to short documents, then
dealt out inside the class over hashed buckets, by exact quotas. A source has at most
sqrt(2 * words) different sizes, which bounds the group that settles them; the documents of
a hot source are never brought together. The result depends on the documents alone, so
reruns agree.

Defined cases: null text has size 0; a document of size 0 keeps its one copy
and takes no words; a null source is a source of its own, last in the order;
repeated rows are documents of their own; an empty table gives an empty result;
other columns pass through, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import fresh, ship, stored, word_count

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
BUCKETS = 256

KEYS = ["no_source", "source_key"]


def source_targets(
    histogram: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """One row per source: its words and its target.

    Weights repeat over the sources in code-point order, null last. A target
    stops at ``most`` times the source's words and the excess goes to the others
    by weight; that fixed point is target = min(cap, level * weight), and the
    level follows from the sources sorted by cap / weight. One row per source
    reaches the single-partition windows.
    """
    src = histogram.groupBy(*KEYS).agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    everything = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(*KEYS)) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    src = src.withColumn("w", weight).withColumn("cap", F.col("source_size") * F.lit(most))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), *KEYS)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    src = src.withColumn("goal", F.sum("source_size").over(everything) * F.lit(share))
    src = src.withColumn(
        "level",
        (F.col("goal") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)),
    )
    fits = F.col("level") * F.col("w") <= F.col("cap")
    first = F.when(fits, F.struct(F.row_number().over(by_ratio).alias("at"), F.col("level").alias("level")))
    src = src.withColumn("first", first).withColumn("level", F.min("first").over(everything)["level"])
    return src.select(
        *KEYS, "source_size", F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("w"), F.col("cap"))).alias("target")
    )


def solve_dual(size: np.ndarray, n: np.ndarray, target: float, most: float = MOST) -> np.ndarray:
    """Rates min(most, exp(lambda * size)) whose tokens meet ``target``; Newton steps, kept inside a bracket.

    One source in memory; :func:`solve_duals` takes the same steps for all sources at once.
    """
    total = float((size * n).sum())
    if total == 0:
        return np.ones(len(size))
    if target >= most * total * (1 - 1e-12):
        return np.where(size > 0, most, 1.0)
    x = size / (total / n.sum())  # in mean document lengths
    goal = target / total
    mass = size * n / total
    lam, low, high = 0.0, -np.inf, np.inf
    ceiling = np.log(most)
    for _ in range(200):
        tilt = np.minimum(lam * x, ceiling)
        rate = np.exp(tilt)
        gap = float((mass * rate).sum()) - goal
        if abs(gap) <= 1e-12 * max(goal, 1e-3):
            break
        low, high = (low, lam) if gap > 0 else (lam, high)
        slope = float((mass * x * rate * (lam * x < ceiling)).sum())
        step = lam - gap / slope if slope > 0 else np.nan
        if not low < step < high:  # outside the bracket: halve it, or double away from its one end
            if np.isinf(low):
                step = 2 * high - 1 if high <= 0 else -1.0
            elif np.isinf(high):
                step = 2 * low + 1 if low >= 0 else 1.0
            else:
                step = (low + high) / 2
                if step in (low, high):
                    break
        lam = step
    return np.exp(np.minimum(lam * x, ceiling))


def settle_copies(size: np.ndarray, n: np.ndarray, rate: np.ndarray, most: float = MOST) -> np.ndarray:
    """Whole copies per class, from long to short documents; each class corrects the words missed so far."""
    copies = np.zeros(len(size), dtype=np.int64)
    owed = 0.0
    for i in np.argsort(-size, kind="stable"):
        wanted = n[i] * rate[i] * size[i] + owed
        if size[i] == 0:
            copies[i] = n[i]
            continue
        copies[i] = int(min(max(np.floor(wanted / size[i] + 0.5), 0), n[i] * most))
        owed = wanted - float(copies[i]) * size[i]
    return copies


#: Iterations at most, and when a source's tokens are close enough to its target (as a share).
ITERATIONS, CLOSE = 100, 1e-12


def _rate(lam: Column, x: Column, most: float) -> Column:
    return F.when(x == 0, 1.0).otherwise(F.exp(F.least(lam * x, F.lit(float(np.log(most))))))


def solve_duals(goals: DataFrame, most: float = MOST) -> DataFrame:
    """``goals`` (source, size, n, source_size, target; one row per class) with the ``rate`` of each class."""
    goals = stored(goals, "mix_histogram")
    inf = F.lit(float("inf"))
    settled = (F.col("total") == 0) | (F.col("target") >= F.lit(most * (1 - 1e-12)) * F.col("total"))
    duals = goals.groupBy(*KEYS).agg(
        F.max("target").alias("target"), F.max("source_size").cast("double").alias("total"), F.sum("n").alias("docs")
    )
    duals = duals.select(
        *KEYS,
        F.coalesce(F.try_divide("target", "total"), F.lit(0.0)).alias("goal"),
        "total",
        F.coalesce(F.try_divide("total", "docs"), F.lit(0.0)).alias("mean"),
        F.when(settled, inf).otherwise(0.0).alias("lam"),  # without a bound to meet, as many copies as there may be
        (-inf).alias("low"),
        inf.alias("high"),
        settled.alias("done"),
    )
    duals = stored(duals, "mix_duals")
    exact = "decimal(38,20)"
    for _ in range(ITERATIONS):
        active = duals.where(~F.col("done"))
        if active.isEmpty():
            break
        x, mass = F.col("size") / F.col("mean"), F.col("size") * F.col("n") / F.col("total")
        tokens = mass * _rate(F.col("lam"), x, most)
        free = (F.col("lam") * x < float(np.log(most))).cast("double")
        state = ["goal", "total", "mean", "lam", "low", "high"]
        sums = goals.drop("target").join(active, KEYS).groupBy(*KEYS, *state).agg(
            F.sum(tokens.cast(exact)).cast("double").alias("got"), F.sum((tokens * x * free).cast(exact)).cast("double").alias("slope")
        )
        gap = F.col("got") - F.col("goal")
        moved = sums.select(
            *KEYS, "goal", "total", "mean", "lam", "slope", gap.alias("gap"),
            F.when(gap > 0, F.col("low")).otherwise(F.col("lam")).alias("low"),
            F.when(gap > 0, F.col("lam")).otherwise(F.col("high")).alias("high"),
        )
        newton = F.col("lam") - F.try_divide(F.col("gap"), F.col("slope"))
        halved = (F.col("low") + F.col("high")) / 2
        outside = (
            F.when(F.col("low") == -inf, F.when(F.col("high") <= 0, F.col("high") * 2 - 1).otherwise(-1.0))
            .when(F.col("high") == inf, F.when(F.col("low") >= 0, F.col("low") * 2 + 1).otherwise(1.0))
            .otherwise(halved)
        )
        step = F.when((newton > F.col("low")) & (newton < F.col("high")), newton).otherwise(outside)
        met = F.abs("gap") <= F.greatest(F.col("goal"), F.lit(1e-3)) * CLOSE
        stuck = (step == F.col("low")) | (step == F.col("high"))
        moved = moved.select(
            *KEYS, "goal", "total", "mean", F.when(met | stuck, F.col("lam")).otherwise(step).alias("lam"), "low", "high",
            (met | stuck).alias("done"),
        )
        duals = stored(moved.unionByName(duals.where("done")), "mix_duals")
    found = goals.join(duals.select(*KEYS, "mean", "lam"), KEYS)
    x = F.coalesce(F.try_divide(F.col("size"), F.col("mean")), F.lit(0.0))
    return found.withColumn("rate", _rate(F.col("lam"), x, most)).drop("mean", "lam")


def _settle(group: pd.DataFrame) -> pd.DataFrame:
    out = group[[*KEYS, "size", "n", "source_size", "target", "rate"]].copy()
    size, n = out["size"].to_numpy(np.float64), out["n"].to_numpy(np.float64)
    out["copies"] = settle_copies(size, n, out["rate"].to_numpy(np.float64))
    return out


def mix(df: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", keep: Column | None = None) -> DataFrame:
    """Rows of ``df`` as ``row`` (or ``keep``) with size, source_size, target, rate and copies.

    Only the histogram and one row per class bucket are aggregated; the documents
    are shuffled once, on (source, size, bucket).
    """
    row = keep if keep is not None else F.struct(*[F.col(f"`{c}`") for c in df.columns])
    src = F.col(f"`{source}`").cast("string")
    one = df.select(
        row.alias("row"),
        src.isNull().alias("no_source"),
        F.coalesce(src, F.lit("")).alias("source_key"),
        word_count(F.col(f"`{text}`")).alias("size"),
        F.xxhash64(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))).alias("h"),
    ).withColumn("bucket", F.pmod(F.col("h"), F.lit(BUCKETS)).cast("int"))
    cells = one.groupBy(*KEYS, "size", "bucket").agg(F.count(F.lit(1)).alias("in_bucket"))
    histogram = cells.groupBy(*KEYS, "size").agg(F.sum("in_bucket").alias("n"))
    goals = histogram.join(source_targets(histogram), KEYS)
    ship(df.sparkSession)
    solved = solve_duals(goals).groupBy(*KEYS).applyInPandas(
        _settle,
        "no_source boolean, source_key string, size long, n long, source_size long, target double, rate double, copies long",
    )
    in_class = Window.partitionBy(*KEYS, "size").orderBy("bucket")
    upto = F.sum("in_bucket").over(in_class.rowsBetween(Window.unboundedPreceding, 0))
    # exact in decimals: extra * upto may pass 2**63
    big = "cast(%s as decimal(19,0))"
    share = f"{big % 'extra'} * {big % '%s'} div {big % 'n'}"
    quota = (
        cells.join(solved, [*KEYS, "size"])
        .withColumn("upto", upto)
        .withColumn("extra", F.col("copies") % F.col("n"))
        .select(
            *KEYS,
            "size",
            "bucket",
            "source_size",
            "target",
            "rate",
            F.expr("copies div n").alias("whole"),
            F.expr(f"({share % 'upto'}) - ({share % '(upto - in_bucket)'})").cast("long").alias("quota"),
        )
    )
    in_bucket = Window.partitionBy(*KEYS, "size", "bucket").orderBy("h", "row")
    return (
        one.join(quota, [*KEYS, "size", "bucket"])
        .withColumn("place", F.row_number().over(in_bucket))
        .select(
            "row",
            "size",
            "source_size",
            "target",
            "rate",
            (F.col("whole") + (F.col("place") <= F.col("quota")).cast("long")).alias("copies"),
        )
    )


def apply_mix(df: DataFrame) -> DataFrame:
    """Each row of ``df`` as often as the mix takes it; columns unchanged."""
    n = fresh(df, "_copy")
    mixed = mix(df).where("copies > 0")
    rows = mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias(n))
    return rows.select(*[F.col("row")[c].alias(c) for c in df.columns])
