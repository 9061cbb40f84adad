"""One feature row per firm: what all the point rules read."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import relative_change
from .ordered import ROW_ORDER, last_rows
from .quantiles import column_quantile, group_quantiles

TAIL = 24


@dataclass(frozen=True)
class Features:
    """Which panel columns a rule set looks at, and how.

    ``last`` gives x_last; ``recent`` maps a column to the row counts k of its trailing means
    x_m<k>; ``medians`` gives x_med; ``before_last`` maps a column to k, for x_rest, the mean of
    all but the last k rows.
    """

    last: tuple[str, ...] = ()
    recent: dict[str, tuple[int, ...]] = field(default_factory=dict)
    medians: tuple[str, ...] = ()
    before_last: dict[str, int] = field(default_factory=dict)

    def within(self, columns: list[str]) -> Features:
        """Only what the panel has: rules on a missing column drop out."""
        return Features(
            tuple(c for c in self.last if c in columns),
            {c: k for c, k in self.recent.items() if c in columns},
            tuple(c for c in self.medians if c in columns),
            {c: k for c, k in self.before_last.items() if c in columns},
        )

    def __or__(self, other: Features) -> Features:
        recent = dict(self.recent)
        for column, ks in other.recent.items():
            recent[column] = tuple(sorted({*recent.get(column, ()), *ks}))
        return Features(
            tuple(dict.fromkeys(self.last + other.last)),
            recent,
            tuple(dict.fromkeys(self.medians + other.medians)),
            {**self.before_last, **other.before_last},
        )


def exact(column: str) -> str:
    """Ratio to 12 places as a decimal, so that its sums do not depend on the order of addition."""
    return f"cast({column} AS decimal(38,12))"


def firm_features(panel: DataFrame, wanted: Features, key: str = "gvkey") -> DataFrame:
    """Feature row per firm from aggregations that meet on the firm key.

    The tail keeps at most 24 rows per firm and map task before the shuffle; the history is a
    partial aggregation.  Both arrive partitioned by the firm, so their join moves nothing.
    """
    wanted = wanted.within(panel.columns)
    panel = panel.where(F.col(key).isNotNull())
    read = {*wanted.last, *wanted.recent, *wanted.before_last, "price", *ROW_ORDER} - {key}
    tail = last_rows(panel.select(key, *sorted(read)), TAIL, key)

    picked = [
        "max(CASE WHEN rn = 1 THEN date END) AS last_date",
        "max(CASE WHEN rn = 1 THEN price END) AS last_price",
        f"max(CASE WHEN rn = {TAIL} THEN price END) AS tail_first_price",
    ]
    picked += [f"max(CASE WHEN rn = 1 THEN {c} END) AS {c}_last" for c in wanted.last]
    for c, ks in wanted.recent.items():
        picked += [f"avg(CASE WHEN rn <= {k} THEN {c} END) AS {c}_m{k}" for k in ks]
    for c, k in wanted.before_last.items():
        picked += [
            f"sum(CASE WHEN rn <= {k} THEN {exact(c)} END) AS _{c}_sum",
            f"count(CASE WHEN rn <= {k} THEN {c} END) AS _{c}_n",
        ]
    recent = tail.groupBy(key).agg(*map(F.expr, picked))

    counts = ["count(*) AS n_rows"]
    for c in wanted.before_last:
        counts += [f"sum({exact(c)}) AS _{c}_all", f"count({c}) AS _{c}_all_n"]
    history = panel.groupBy(key).agg(*map(F.expr, counts))
    features = recent.join(history, key)
    if wanted.medians:
        medians = group_quantiles(panel, key, wanted.medians, 0.5)
        features = features.join(medians.withColumnsRenamed({c: f"{c}_med" for c in wanted.medians}), key, "left")
    for column in wanted.before_last:
        features = _mean_of_the_rest(features, column)
    return features.withColumn("price_change", relative_change(F.col("last_price"), F.col("tail_first_price")))


def _mean_of_the_rest(features: DataFrame, column: str) -> DataFrame:
    """x_recent, x_rest and x_rises: are the last rows' mean values above those before?

    The comparison multiplies out the divisions, so it is exact.
    """
    near, near_n = F.col(f"_{column}_sum"), F.col(f"_{column}_n")
    far, far_n = F.col(f"_{column}_all") - F.coalesce(near, F.lit(0)), F.col(f"_{column}_all_n") - near_n
    return features.withColumns(
        {
            f"{column}_recent": F.try_divide(near.cast("double"), near_n),
            f"{column}_rest": F.try_divide(far.cast("double"), far_n),
            f"{column}_rises": (near_n > 0) & (far_n > 0) & (near * far_n > far * near_n),
        }
    ).drop(f"_{column}_sum", f"_{column}_n", f"_{column}_all", f"_{column}_all_n")


def dataset_bounds(panel: DataFrame) -> DataFrame:
    return panel.agg(F.min("date").alias("dataset_start"), F.max("date").alias("dataset_end"))


def dataset_end(panel: DataFrame) -> Column:
    return panel.agg(F.max("date")).scalar()


def dataset_start(panel: DataFrame) -> Column:
    return panel.agg(F.min("date")).scalar()


def days_before(end: Column) -> Column:
    return F.datediff(end, F.col("last_date"))


def global_quantile(panel: DataFrame, column: str, p: float) -> Column:
    """Quantile over the whole panel as a scalar, computed once for all firms."""
    return column_quantile(panel, column, p).scalar()
