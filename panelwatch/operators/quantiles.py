"""Exact, linearly interpolated quantiles, for groups of any size.

The rows of a key with at most 4,096 of them, as nearly every firm has, meet in one task.  A longer key, or the whole panel, is one
too large for that: its values are parted into ranges by (key, column, value) and written sorted, each with its place.  A group's values then stand in a
row over one or more ranges; counts per (group, range), one row each, tell the places of the wanted ranks, and the values at these
places are fetched.  The values of a large key are sorted by many tasks; equal values are told apart by the task they were read in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import in_ranges, stored


#: Most rows of a key whose values are sorted in one task.
WHOLE = 4096


def group_quantiles(df: DataFrame, key: str, columns: Sequence[str], p: float | Sequence[float]) -> DataFrame:
    """Per key, the quantile ``p`` of each column (one share for all, or one per column); NULL where a key has no value.

    Keys without any value are absent.  The values are written once; keys with few rows are shuffled once, whole rows by key.
    """
    shares = [float(p)] * len(columns) if isinstance(p, (int, float)) else list(map(float, p))
    values = df.select(key, *[F.col(c).cast("double").alias(c) for c in columns])
    values = stored(values.where(F.coalesce(*columns).isNotNull()), "values")
    counted = values.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > WHOLE)
    large = stored(counted.select(F.col(key).alias("_large")), "large")
    if large.isEmpty():
        return _by_key(values, key, columns, shares)
    # At most one key for every 4,096 rows: safe to broadcast.
    large, same = F.broadcast(large), F.col(key).eqNullSafe(F.col("_large"))
    small = _by_key(values.join(large, same, "left_anti"), key, columns, shares)
    return small.unionByName(_by_ranges(values.join(large, same, "left_semi"), key, columns, shares))


def _by_key(values: DataFrame, key: str, columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """Rows meet by key first, so that no half-made lists of values are shuffled."""
    return values.repartition(key).groupBy(key).agg(*[F.percentile(c, p).alias(c) for c, p in zip(columns, shares)])


def _by_ranges(values: DataFrame, key: str, columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    each = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(c).alias("value")) for n, c in enumerate(columns)])
    metric = F.col("metric")
    ends = _ends(values.select(key, F.inline(each)), [key, "metric"], F.get(F.array(*map(F.lit, shares)), metric))
    return ends.groupBy(key).agg(*[_between(lambda x, n=n: F.when(metric == n, F.col(x))).alias(c) for n, c in enumerate(columns)])


def column_quantile(df: DataFrame, column: str, p: float) -> DataFrame:
    """One row: the quantile ``p`` over all rows of the column."""
    ends = _ends(df.select(F.col(column).cast("double").alias("value")), [], F.lit(float(p)))
    return ends.agg(_between(F.col).alias("quantile"))


def _ends(values: DataFrame, keys: list[str], p: Column) -> DataFrame:
    """keys, value, share: the one or two values per group between which the quantile lies; ``p`` may depend on the keys."""
    sorted_once = in_ranges(values.where("value IS NOT NULL").withColumn("_tie", F.spark_partition_id()), *keys, "value", "_tie")
    spans = sorted_once.groupBy(*keys, F.shiftright("_at", 33).alias("_range")).agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("first"))
    group = Window.partitionBy(*keys)
    before = F.coalesce(F.sum("n").over(group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = spans.withColumns({"before": before, "position": (F.sum("n").over(group) - 1) * p})
    low, high = F.floor("position"), F.ceil("position")
    place = lambda rank: F.when((rank >= F.col("before")) & (rank < F.col("before") + F.col("n")), F.col("first") + rank - F.col("before"))
    wanted = spans.select(*keys, (F.col("position") - low).alias("share"), F.explode(F.array_distinct(F.array_compact(F.array(place(low), place(high))))).alias("_at"))
    return sorted_once.select("_at", "value").join(wanted, "_at").drop("_at")


def _between(of):
    """The quantile, from the rows of :func:`_ends`; ``of`` gives a column by name, or NULL on the rows of others."""
    low, high, share = F.min(of("value")), F.max(of("value")), F.max(of("share"))
    return F.when(low == high, low).otherwise(low * (1 - share) + high * share)
