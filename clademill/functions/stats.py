"""Distribution statistics and correlation as plain aggregations and windows.

Weighted values are counted first, so a group's sort sees each distinct value once; sorts spill like any other, and nothing is gathered into arrays.
A group with more different values than one task should sort is split: its values are counted by intervals, and only the interval that holds a quantile's place is looked
into, until it is small.

Cases: null values and null or zero weights are left out; a group without values has no row; NaN counts as null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import saved

#: Values that differ by less than this share of their size count as equal.
SAME = 1e-12
STATISTICS = ("mean", "median", "stdev", "cv", "p05", "p95")


def ratio(a: Column, b: Column) -> Column:
    """a / b in double precision; null unless b is positive."""
    return F.when(b > 0, a.cast("double") / b)


#: Intervals that a large group's values are counted by, at a time.
INTERVALS = 1024


def _places(n: Column, weight: bool) -> dict[str, Column]:
    """Running weights at which the quantiles of a group of weight n are: with weights, shares of it; without, places in the order."""
    if weight:
        return {"m1": n * 0.5, "m2": n * 0.5, "p05": n * 0.05, "p95": n * 0.95}
    return {"m1": F.floor((n + 1) / 2), "m2": F.ceil((n + 1) / 2), "p05": F.round((n - 1) * 0.05) + 1, "p95": F.round((n - 1) * 0.95) + 1}


def _statistics(mean: Column, median: Column, stdev: Column, p05: Column, p95: Column) -> list[Column]:
    return [mean.alias("mean"), median.alias("median"), stdev.alias("stdev"), F.when(mean != 0, stdev / mean).alias("cv"), p05.alias("p05"), p95.alias("p95")]


def _split(counted: DataFrame, keys: list[str], weight: bool, most: int) -> DataFrame:
    """distribution() of counted values (keys, _x, _w), each once a group, for groups of any size.

    A group's places start with the interval from its least to its largest value. Each round counts the values of every place's interval by INTERVALS parts, in partial sums,
    and goes on with the part that holds the place; parts of at most `most` values are sorted.
    """
    whole = counted.groupBy(*keys).agg(F.sum("_w").alias("_n"), F.sum(F.col("_x") * F.col("_w")).alias("_sum"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.count(F.lit(1)).alias("_rows"))
    whole = saved(whole.withColumn("_mean", F.col("_sum") / F.col("_n")), "groups")
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), p.cast("double").alias("place")) for k, p in _places(F.col("_n"), weight).items()])).alias("_p")
    open_ = whole.select(*keys, "_lo", "_hi", "_rows", kinds).select(*keys, "_lo", "_hi", "_rows", F.col("_p.kind").alias("_kind"), F.col("_p.place").alias("_place"), F.lit(0.0).alias("_before"))
    open_, found = saved(open_, "places"), []
    inside = lambda spans: counted.join(spans, keys).filter(F.col("_x").between(F.col("_lo"), F.col("_hi")))
    group = Window.partitionBy(*keys, "_kind")
    while True:
        found.append(open_.filter("_rows = 1").select(*keys, "_kind", F.col("_lo").alias("_value")))
        small = inside(open_.filter((F.col("_rows") > 1) & (F.col("_rows") <= most)))
        upto = F.col("_before") + F.sum("_w").over(group.orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        found.append(small.withColumn("_upto", upto).filter(F.col("_upto") >= F.col("_place")).groupBy(*keys, "_kind").agg(F.min("_x").alias("_value")))
        large = open_.filter(F.col("_rows") > most)
        if not large.limit(1).count():
            break
        part = F.least(F.floor((F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * INTERVALS), F.lit(INTERVALS - 1))
        parts = inside(large).groupBy(*keys, "_kind", "_place", "_before", part.alias("_part")).agg(F.sum("_w").alias("_w"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.count(F.lit(1)).alias("_rows"))
        # INTERVALS rows a place.
        parts = parts.withColumn("_upto", F.col("_before") + F.sum("_w").over(group.orderBy("_part")))
        first = parts.filter(F.col("_upto") >= F.col("_place")).groupBy(*keys, "_kind", "_place").agg(F.min_by(F.struct("_lo", "_hi", "_rows", (F.col("_upto") - F.col("_w")).alias("_before")), "_part").alias("_s"))
        open_ = saved(first.select(*keys, "_s._lo", "_s._hi", "_s._rows", "_kind", "_place", "_s._before"), "places")
    values = found[0]
    for f in found[1:]:
        values = values.unionByName(f)
    at = lambda k: F.max(F.when(F.col("_kind") == k, F.col("_value")))
    quantiles = values.groupBy(*keys).agg(((at("m1") + at("m2")) / 2).alias("_median"), at("p05").alias("_p05"), at("p95").alias("_p95"))
    away = F.col("_x") - F.col("_mean")
    spread = counted.join(whole.select(*keys, "_mean"), keys).groupBy(*keys).agg(F.sum(F.col("_w") * away * away).alias("_spread"))
    out = whole.select(*keys, "_n", "_mean").join(quantiles, keys).join(spread, keys)
    stdev = F.when(F.col("_n") > 1, F.sqrt(F.col("_spread") / (F.col("_n") - 1)))
    return out.select(*keys, *_statistics(F.col("_mean"), F.col("_median"), stdev, F.col("_p05"), F.col("_p95")))


def distribution(rows: DataFrame, keys: list[str], value: str = "value", weight: str | None = None, most: int | None = None) -> DataFrame:
    """(keys, mean, median, stdev, cv, p05, p95) of values, one row a group.

    With weight, a quantile is the least value at which the running weight reaches that share of all, and stdev divides by the
    weight less one. Without, the median is the usual one, p05 and p95 are the values nearest to that place. With most, values are counted and written first,
    and groups of more different values are split, so that no task sorts more; keys are then not null.
    """
    x = F.col(value).cast("double")
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    counted = rows.select(*keys, F.when(~F.isnan(x), x).alias("_x"), w.alias("_w")).filter("_x IS NOT NULL AND _w > 0")
    if weight or most:  # equal values are pooled before they are shuffled; without weights most values differ
        counted = counted.groupBy(*keys, "_x").agg(F.sum("_w").alias("_w"))
    if most:
        counted = saved(counted, "counted")
        large = saved(counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > most).select(*keys), "large")
        if large.limit(1).count():
            rest = _sorted_distribution(counted.join(large, keys, "left_anti"), keys, bool(weight))
            return _split(counted.join(large, keys, "left_semi"), keys, bool(weight), most).unionByName(rest)
    return _sorted_distribution(counted, keys, bool(weight))


def _sorted_distribution(counted: DataFrame, keys: list[str], weight: bool) -> DataFrame:
    """distribution() of (keys, _x, _w) by one sort a group."""
    by_value = Window.partitionBy(*keys).orderBy("_x")
    whole = by_value.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = counted.select(
        *keys, "_x", "_w",
        F.sum("_w").over(whole).alias("_n"),
        F.sum(F.col("_x") * F.col("_w")).over(whole).alias("_sum"),
        F.sum("_w").over(by_value.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_upto"),
    ).withColumn("_mean", F.col("_sum") / F.col("_n"))
    reaching = {k: F.min(F.when(F.col("_upto") >= p, F.col("_x"))) for k, p in _places(F.col("_n"), weight).items()}
    spread = F.sum(F.col("_w") * (F.col("_x") - F.col("_mean")) * (F.col("_x") - F.col("_mean")))
    stdev = F.when(F.first("_n") > 1, F.sqrt(spread / (F.first("_n") - 1)))
    out = placed.groupBy(*keys).agg(F.first("_mean").alias("mean"), ((reaching["m1"] + reaching["m2"]) / 2).alias("median"), stdev.alias("stdev"), reaching["p05"].alias("p05"), reaching["p95"].alias("p95"))
    return out.select(*keys, *_statistics(*[F.col(c) for c in ("mean", "median", "stdev", "p05", "p95")]))


#: Values that a task of distributions() sorts, if the number of rows is known.
TASK_VALUES = 1_000_000


def distributions(rows: DataFrame, keys: list[str], metrics: dict[str, Column], weight: str | None = None, n_rows: int | None = None) -> DataFrame:
    """(keys, <metric>_mean, ..., <metric>_p95) for several values of the same rows, with one shuffle: of the counted values, or without weight of the rows themselves.

    A row is a value for each metric in its task, which the bytes that are shuffled don't tell. With n_rows, the number of rows at most, rows go to as many
    tasks as hold TASK_VALUES values each.
    """
    tasks = -(-(n_rows or 0) * len(metrics) // TASK_VALUES)
    if not weight or tasks > 1:
        rows = rows.select(*keys, *([weight] if weight else []), *[c.alias(f"_metric_{i}") for i, c in enumerate(metrics.values())])
        rows = rows.repartition(tasks, *keys) if tasks > 1 else rows.repartition(*keys)
        metrics = {m: F.col(f"_metric_{i}") for i, m in enumerate(metrics)}
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), c.cast("double").alias("value")) for m, c in metrics.items()]))
    kept = [*keys, *([weight] if weight else [])]
    long = rows.select(*kept, each.alias("_m")).select(*kept, F.col("_m.metric").alias("_metric"), F.col("_m.value").alias("_value"))
    stats = distribution(long, [*keys, "_metric"], "_value", weight)
    return stats.groupBy(*keys).agg(*[F.max(F.when(F.col("_metric") == m, F.col(s))).alias(f"{m}_{s}") for m in metrics for s in STATISTICS])


def pearson(x: Column, y: Column) -> Column:
    """Pearson's r over pairs without nulls, as an aggregate; null unless both sides vary."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    spread = lambda c: F.max(c) - F.min(c) > SAME * F.greatest(F.abs(F.max(c)), F.abs(F.min(c)))
    r = F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
    return F.when(spread(a) & spread(b), F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0)))


def correlations(rows: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """(keys, n_pairs, r): pearson() by group, of groups that have a pair."""
    pairs = rows.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_pairs"), pearson(F.col(x), F.col(y)).alias("r"))


def correlation_p(r: Column, n: Column) -> Column:
    """Two-tailed p of a correlation of n pairs by Student's t with n - 2 degrees of freedom; null for n < 3.

    For whole degrees of freedom the integral is a finite sum of powers of cos(theta), with tan(theta) = t / sqrt(n - 2).
    """
    df = (n - 2).cast("int")
    t = F.abs(r) * F.sqrt(df / (1 - r * r))
    theta = F.atan(t / F.sqrt(df.cast("double")))
    cos, sin = F.cos(theta), F.sin(theta)
    odd = df % 2 == 1
    # Terms 1 .. m, each the one before times cos^2 and a quotient of neighbours: (2k - 1) / 2k, or 2k / (2k + 1) if df is odd.
    m = F.when(odd, (df - 3) / 2).otherwise((df - 2) / 2).cast("int")
    steps = F.when(m >= 1, F.sequence(F.lit(1), m)).otherwise(F.array().cast("array<int>"))
    start = F.when(odd, F.when(df >= 3, cos).otherwise(F.lit(0.0))).otherwise(F.lit(1.0))

    def add(acc: Column, k: Column) -> Column:
        term = acc["term"] * cos * cos * F.when(odd, 2 * k / (2 * k + 1)).otherwise((2 * k - 1) / (2 * k))
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    total = F.aggregate(steps, F.struct(start.alias("term"), start.alias("sum")), add, lambda acc: acc["sum"])
    inside = F.when(odd, 2 / math.pi * (theta + sin * total)).otherwise(sin * total)
    return F.when((n >= 3) & r.isNotNull(), F.when(F.abs(r) >= 1, F.lit(0.0)).otherwise(F.greatest(1 - inside, F.lit(0.0))))
