"""Exact weighted quantiles without a table of all values of a group in one task.

Distinct values of a group are counted and stored first.  A wanted rank is then
narrowed down: values of an interval that is too large to be sorted by one task
are cut at approximate quantiles *of the distinct values*, the weights between
the cuts are added up exactly, and the rank goes on in the one part that holds
it.  Each round divides the values left by some ``CUTS``, whatever their
distribution and weights, so two or three rounds do for any table.  What is left
is sorted, at most ``most`` values an interval.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerlens.functions.columns import quoted
from peerlens.functions.missing import sum_poisoning
from peerlens.sources.staging import stage

CUTS = 64
# Accuracy of the cuts: parts hold up to 1/CUTS + 2/ACCURACY of an interval's values.
ACCURACY = 1000
# Values of one interval are spread over this many join keys, so a hot group is not one task.
SALTS = 32
SERIES = ["g", "f"]  # the group and the frequency column


def _salted(intervals: DataFrame) -> DataFrame:
    return intervals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _inside(counted: DataFrame, intervals: DataFrame) -> DataFrame:
    """Values with the interval they lie in; intervals of a series do not overlap."""
    met = counted.join(_salted(intervals), [*SERIES, "salt"])
    return met.where((F.col("value") >= F.col("low")) & (F.col("value") <= F.col("high")))


def _intervals(found: DataFrame) -> DataFrame:
    """One row an interval: the ranks wanted in it and the weight before it."""
    want = F.struct("target", "rank")
    return found.groupBy(*SERIES, "low", "high", "before", "values").agg(F.collect_list(want).alias("wants"))


def _wanted(steps: DataFrame, below: Column, weight: Column) -> DataFrame:
    """Rows of ``steps`` that hold a wanted rank, one a rank."""
    ranks = steps.withColumns({"from": below, "to": below + weight}).withColumn("want", F.explode("wants"))
    return ranks.where("want.rank >= `from` AND want.rank < `to`").selectExpr("*", "want.target", "want.rank")


def _narrowed(counted: DataFrame, large: DataFrame) -> DataFrame:
    """The part of each large interval in which each rank lies."""
    shares = F.array(*[F.lit(i / CUTS) for i in range(1, CUTS)])
    cuts = (
        _inside(counted, large)
        .groupBy(*SERIES, "low")
        .agg(F.array_distinct(F.percentile_approx("value", shares, ACCURACY)).alias("cuts"))
    )
    met = _inside(counted, large.drop("wants").join(cuts, [*SERIES, "low"]))
    part = F.size(F.filter("cuts", lambda c: c < F.col("value")))
    parts = (
        met.groupBy(*SERIES, "low", part.alias("part"))
        .agg(
            F.sum("n").alias("weight"), F.count(F.lit(1)).alias("part_values"),
            F.min("value").alias("part_low"), F.max("value").alias("part_high"),
        )
    )
    order = Window.partitionBy(*SERIES, "low").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    steps = parts.withColumn("earlier", F.coalesce(F.sum("weight").over(order), F.lit(0)))
    steps = steps.join(large, [*SERIES, "low"])
    held = _wanted(steps, F.col("before") + F.col("earlier"), F.col("weight"))
    return held.select(
        *SERIES, F.col("part_low").alias("low"), F.col("part_high").alias("high"), F.col("from").alias("before"),
        F.col("part_values").alias("values"), "target", "rank",
    )


def _values_at(counted: DataFrame, intervals: DataFrame) -> DataFrame:
    """``(series, target, value)`` by sorting each interval."""
    order = Window.partitionBy(*SERIES, "low").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    steps = _inside(counted, intervals).withColumn("earlier", F.coalesce(F.sum("n").over(order), F.lit(0)))
    return _wanted(steps, F.col("before") + F.col("earlier"), F.col("n")).select(*SERIES, "target", "value")


def ranked_values(counted: DataFrame, wanted: DataFrame, most: int) -> DataFrame:
    """``(g, f, target, value)``: the value at each 0-based rank of ``wanted(g, f, target, rank)``.

    ``counted`` is ``(g, f, value, n, salt)``, a value once a series, and stored.
    The driver gets the number of large intervals of each round only.
    """
    whole = counted.groupBy(*SERIES).agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.lit(0).cast("long").alias("before"),
        F.count(F.lit(1)).alias("values"),
    )
    left = stage(_intervals(whole.join(wanted, SERIES)), "quantile-ranks")
    done = []
    while True:
        done.append(left.where(F.col("values") <= most))
        large = left.where(F.col("values") > most)
        if large.isEmpty():
            break
        left = stage(_intervals(_narrowed(counted, large)), "quantile-ranks")
    return _values_at(counted, reduce(DataFrame.unionByName, done))


def weighted_quantiles_by_rank(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    frequencies: Sequence[str],
    quantiles: Mapping[str, float],
    total: str = "popn",
    spread: tuple[str, str, str] | None = None,
    most: int = 250_000,
) -> DataFrame:
    """What ``rollup.weighted_quantiles`` returns, for groups with any number of distinct values.

    Rows with a missing value (also NaN), or a missing or zero frequency, do not
    count towards quantiles; a negative frequency fails the job.  Null keys are a
    group.  Groups without any weight have null quantiles.
    """
    group = F.struct(*[F.col(quoted(c)) for c in by]) if by else F.struct(F.lit(0).alias("all"))
    x = F.nanvl(F.col(quoted(value)).cast("double"), F.lit(None).cast("double")) + F.lit(0.0)  # -0.0 is 0.0
    rows = df.select(group.alias("g"), x.alias("value"), *[F.col(quoted(f)).cast("long").alias(f"n{i}") for i, f in enumerate(frequencies)])
    numbers = range(len(frequencies))
    totals = rows.groupBy("g").agg(*[sum_poisoning(f"n{i}").alias(f"t{i}") for i in numbers])
    checked = [
        F.sum(F.when(F.col(f"n{i}") < 0, F.raise_error(F.lit("negative frequency")).cast("long")).otherwise(F.col(f"n{i}"))).alias(f"n{i}")
        for i in numbers
    ]
    by_value = rows.where("value IS NOT NULL").groupBy("g", "value").agg(*checked)
    series = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(f"n{i}").alias("n")) for i in numbers]))
    counted = by_value.select("g", "value", series.alias("s")).select("g", "s.f", "value", "s.n").where("n > 0")
    salt = F.expr(f"CAST(pmod(xxhash64(value), {SALTS}) AS INT)")
    counted = stage(counted.withColumn("salt", salt), "quantile-counts")

    last = counted.groupBy(*SERIES).agg((F.sum("n") - 1).alias("last"))
    names = list(quantiles)
    position = {q: F.col("last") * F.lit(float(p)) for q, p in quantiles.items()}
    ends = [
        F.struct(F.lit(2 * i + side).alias("target"), end(position[q]).cast("long").alias("rank"))
        for i, q in enumerate(names)
        for side, end in ((0, F.floor), (1, F.ceil))
    ]
    wanted = last.select(*SERIES, F.explode(F.array(*ends)).alias("w")).select(*SERIES, "w.target", "w.rank")
    at = ranked_values(counted, wanted, most).groupBy(*SERIES)
    at = at.pivot("target", list(range(2 * len(names)))).agg(F.first("value")).join(last, SERIES)
    blocks = []
    for i, q in enumerate(names):
        low, high = F.col(f"`{2 * i}`"), F.col(f"`{2 * i + 1}`")
        between = (F.ceil(position[q]) - position[q]) * low + (position[q] - F.floor(position[q])) * high
        blocks.append(F.when(low == high, low).otherwise(between).alias(q))
    found = at.select(*SERIES, F.struct(*blocks).alias("q"))
    wide = found.groupBy("g").agg(*[F.first(F.when(F.col("f") == i, F.col("q")), ignorenulls=True).alias(f"q{i}") for i in numbers])
    t, w = totals.alias("t"), wide.alias("w")
    joined = t.join(w, F.col("t.g") == F.col("w.g"), "left").select("t.*", *[f"w.q{i}" for i in numbers])
    columns = [F.col(f"q{i}")[q].alias(f"{q}_{f}") for q in names for i, f in enumerate(frequencies)]
    if spread:
        label, high, low = spread
        columns += [(F.col(f"q{i}")[high] - F.col(f"q{i}")[low]).alias(f"{label}_{f}") for i, f in enumerate(frequencies)]
    columns += [F.col(f"t{i}").alias(f"{total}_{f}") for i, f in enumerate(frequencies)]
    return joined.select(*[F.col("g")[c].alias(c) for c in by], *columns)
