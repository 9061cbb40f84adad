"""Event tables: common schema, unions, filters, counts, ranking."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import LABEL_RANK, date_or_null, is_true_text, rank_of

# The columns all detectors share.
EVENT_SCHEMA = {
    "gvkey": "bigint",
    "company_name": "string",
    "event_type": "string",
    "event_date": "date",
    "detection_score": "int",
    "confidence": "string",
    "reasons": "string",
}
EVENT_COLUMNS = tuple(EVENT_SCHEMA)

# The verdict columns of an events file.
VERDICT_SCHEMA = {
    "verified": "boolean",
    "actual_event_type": "string",
    "actual_date": "string",
    "llm_confidence": "string",
    "details": "string",
    "acquirer": "string",
    "acquisition_price": "double",
}


def ensure_columns(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    missing = {c: F.lit(None).cast(t) for c, t in schema.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def event_rows(df: DataFrame) -> DataFrame:
    """Exactly the shared event columns, NULL where a detector has none."""
    return ensure_columns(df, EVENT_SCHEMA).select(*EVENT_COLUMNS)


def union_events(detections: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [event_rows(d) for d in detections])


def min_history(panel: DataFrame, n: int, key: str = "gvkey") -> DataFrame:
    """Keys with at least ``n`` rows, and their row counts."""
    return panel.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") >= n)


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts of the non-null values of several columns in one pass: (column, value, n).

    Each column is a grouping set of its own type; values become text when they are counted.
    """
    marks = {c: f"_set_{i}" for i, c in enumerate(columns)}
    counted = df.groupingSets([[F.col(c)] for c in columns], *[F.col(c) for c in columns]).agg(
        F.count(F.lit(1)).alias("_n"), *[F.grouping(c).alias(mark) for c, mark in marks.items()]
    )
    here = {c: F.col(mark) == 0 for c, mark in marks.items()}
    column = F.coalesce(*[F.when(here[c], F.lit(c)) for c in columns])
    value = F.coalesce(*[F.when(here[c], F.col(c).cast("string")) for c in columns])
    return counted.select(column.alias("column"), value.alias("value"), F.col("_n").alias("n")).where("value IS NOT NULL")


def sum_lines(groups: DataFrame, *lines: tuple[str, str]) -> DataFrame:
    """(metric, n) from grouped counts: each row adds to its lines, given as (metric SQL, n SQL).

    One pass over a few grouped rows, instead of one query per line over the data.
    """
    structs = ", ".join(f"struct({metric} AS metric, bigint({n}) AS n)" for metric, n in lines)
    spread = groups.selectExpr(f"inline(array({structs}))").where("metric IS NOT NULL")
    return spread.groupBy("metric").agg(F.sum("n").alias("n"))


def best_events(candidates: DataFrame, key: str = "gvkey") -> DataFrame:
    """One event per firm: lowest priority number, then highest score."""
    order = Window.partitionBy(key).orderBy("priority", F.col("detection_score").desc(), "event_date", "reasons")
    return candidates.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") == 1).drop("_rank")


def in_year(events: DataFrame, year: int, date: Column) -> DataFrame:
    return events.where(F.year(date) == year)


def verified_acquisitions(verdicts: DataFrame) -> DataFrame:
    """Verified acquisitions with a usable date outside December 2014."""
    dated = verdicts.where(is_true_text("verified") & (F.lower("actual_event_type") == "acquisition"))
    dated = dated.withColumn("actual_date", date_or_null("actual_date_raw")).where(F.col("actual_date").isNotNull())
    return dated.where(~((F.year("actual_date") == 2014) & (F.month("actual_date") == 12)))


def confident_verdicts(verdicts: DataFrame, minimum: str = "medium") -> DataFrame:
    """Verified rows whose confidence ranks at least as ``minimum``; unknown words rank 0."""
    rank = F.coalesce(rank_of("llm_confidence", LABEL_RANK), F.lit(0))
    return verdicts.where(is_true_text("verified") & (rank >= LABEL_RANK[minimum]))
