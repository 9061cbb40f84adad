"""Profiles of a panel: coverage, basic statistics, gap patterns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import number_text
from .events import sum_lines
from .normalize import ESSENTIAL
from .ordered import date_cells

# The features each detection step looks for.
CRITICAL_FEATURES = {
    "Bankruptcy Detection": [
        "z_score", "o_score", "kz_index", "ni_be", "ocf_at", "zero_trades_252d", "ami_126d", "at_be",
    ],
    "Merger Detection": ["dolvol_126d", "bidaskhl_21d", "ni_be", "eqnpo_me"],
    "Liquidity Metrics": [
        "zero_trades_21d", "zero_trades_126d", "zero_trades_252d", "turnover_126d", "ami_126d", "dolvol_var_126d",
    ],
    "Quality Metrics": ["f_score", "ni_ar1", "ni_ivol"],
}


def _spellings(feature: str) -> list[str]:
    camel = feature.title().replace("_", "")
    return [feature, camel, feature.lower(), feature.upper()]


def feature_coverage(panel: DataFrame) -> DataFrame:
    """Per wanted feature: found under which spelling, and the share of rows that have it."""
    found = {
        feature: next((s for s in _spellings(feature) if s in panel.columns), None)
        for features in CRITICAL_FEATURES.values()
        for feature in features
    }
    counts = panel.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(c) for c in dict.fromkeys(found.values()) if c]
    )
    rows = []
    for category, features in CRITICAL_FEATURES.items():
        for feature in features:
            column = found[feature]
            share = F.col(column) / F.col("rows") * 100 if column else F.lit(None).cast("double")
            rows.append(
                F.struct(
                    F.lit(category).alias("category"),
                    F.lit(feature).alias("feature"),
                    F.lit(column is not None).alias("available"),
                    F.lit(column or "NOT FOUND").alias("column_name"),
                    share.alias("coverage"),
                )
            )
    shown = F.when(F.col("available"), F.concat(F.expr(number_text("coverage", 1)), F.lit("%"))).otherwise("N/A")
    return counts.select(F.inline(F.array(*rows))).withColumn("coverage_pct", shown)


def sample_statistics(panel: DataFrame) -> DataFrame:
    """One row of basic counts.  Distinct counts run on keys already grouped, not on raw rows."""
    cells = panel.groupBy("ticker", "gvkey", "year", "excntry").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("first"), F.max("date").alias("last")
    )
    features = [c for c in panel.columns if c not in ESSENTIAL]
    return cells.agg(
        F.sum("n").alias("total_rows"),
        F.count_distinct("ticker").alias("unique_tickers"),
        F.count_distinct("gvkey").alias("unique_stocks"),
        F.min("first").alias("first_date"),
        F.max("last").alias("last_date"),
        F.count_distinct("year").alias("years_covered"),
        F.array_join(F.sort_array(F.collect_set("excntry")), ",").alias("countries"),
    ).withColumns(
        {
            "avg_observations_per_stock": F.col("total_rows") / F.col("unique_tickers"),
            "total_features": F.lit(len(features)).cast("long"),
        }
    )


def missing_patterns(panel: DataFrame, as_of: date, key: str = "ticker") -> DataFrame:
    """Per ticker: span, rows, gaps above 35 days, largest gap, days since the last row, status."""
    since, gaps = F.col("days_since_last"), F.col("n_gaps")
    status = (
        F.when(since > 365, "likely_delisted")
        .when(since > 90, "possibly_delisted")
        .when(gaps > 5, "many_gaps")
        .otherwise("active")
    )
    return (
        date_cells(panel, key)
        .groupBy(key)
        .agg(
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
            F.sum("n_rows").alias("n_observations"),
            F.count_if(F.col("gap_days") > 35).alias("n_gaps"),
            F.coalesce(F.max("gap_days"), F.lit(0)).alias("max_gap_days"),
        )
        .withColumn("days_since_last", F.datediff(F.lit(as_of), "last_date"))
        .withColumn("status", status)
    )


def pattern_summary(patterns: DataFrame) -> DataFrame:
    """(metric, n): number of stocks, by status, with gaps, likely delisted."""
    by_status = patterns.groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("n_gaps") > 0).alias("gapped")
    )
    return sum_lines(
        by_status,
        ("'total_stocks'", "n"),
        ("'stocks_with_gaps'", "gapped"),
        ("'likely_delisted'", "CASE WHEN status = 'likely_delisted' THEN n ELSE 0 END"),
        ("concat('status:', status)", "n"),
    )
