"""Scalar column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ranks of the confidence words in the verification queue and in the label filter.
QUEUE_RANK = {"high": 3, "medium": 2, "low": 1, "very_low": 0}
LABEL_RANK = {"high": 3, "medium": 2, "low": 1}


def nan_as_null(df: DataFrame) -> DataFrame:
    """A panel's NaN means "missing": turn it into NULL once, at the scan."""
    floats = {
        f.name: F.when(~F.isnan(f.name), F.col(f.name))
        for f in df.schema
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(floats) if floats else df


def ticker(gvkey: str = "gvkey", iid: str = "iid") -> Column:
    return F.concat_ws("_", F.col(gvkey).cast("string"), F.col(iid).cast("string"))


def yyyymmdd(column: str) -> Column:
    """Number such as 19990401.0 as a date; a bad value fails the job."""
    return F.to_date(F.col(column).cast("long").cast("string"), "yyyyMMdd")


def yyyymmdd_or_null(column: str) -> Column:
    return F.try_to_date(F.col(column).cast("long").cast("string"), "yyyyMMdd")


def date_or_null(column: str) -> Column:
    return F.try_to_date(F.col(column))


def relative_change(new: Column, old: Column) -> Column:
    """(new - old) / old with the float answers for old = 0: a signed infinity, and missing for 0/0."""
    return (
        F.when((old == 0) & (new < 0), F.lit(float("-inf")))
        .when((old == 0) & (new > 0), F.lit(float("inf")))
        .otherwise(F.try_divide(new - old, old))
    )


def number_text(value: str, places: int) -> str:
    """SQL for a number with fixed decimals, rounded half-even on its exact binary value.

    ``format_string`` would round half-up, so this uses ``format_number`` with a pattern.
    """
    pattern = "0" if places == 0 else "0." + "0" * places
    return (
        f"CASE WHEN {value} = double('inf') THEN 'inf' WHEN {value} = double('-inf') THEN '-inf' "
        f"ELSE format_number({value}, '{pattern}') END"
    )


def rank_of(confidence: str, ranks: dict[str, int]) -> Column:
    """Rank of a confidence word, NULL for an unknown word."""
    rank = F.lit(None).cast("int")
    for word, value in ranks.items():
        rank = F.when(F.col(confidence) == word, F.lit(value)).otherwise(rank)
    return rank


def has_name(column: str = "company_name") -> Column:
    name = F.col(column)
    return name.isNotNull() & (name != "Unknown") & (name != "")


def lacks_name(column: str = "company_name") -> Column:
    """Complement of :func:`has_name` that is also true for NULL."""
    name = F.col(column)
    return name.isNull() | (name == "Unknown") | (name == "")


def is_true_text(column: str) -> Column:
    """Booleans that went through a text file: any spelling of TRUE."""
    return F.coalesce(F.upper(F.col(column).cast("string")) == "TRUE", F.lit(False))


def band(score: Column, *cuts: tuple[int, str], floor: str) -> Column:
    """First label whose cut the score reaches, else ``floor``."""
    label = F.lit(floor)
    for cut, name in reversed(cuts):
        label = F.when(score >= cut, F.lit(name)).otherwise(label)
    return label


def confidence_band(score: Column, event_type: Column) -> Column:
    """Confidence of a single-pass candidate, by event type."""
    return (
        F.when(event_type == "bankruptcy", band(score, (60, "high"), (40, "medium"), floor="low"))
        .when(event_type == "merger", band(score, (50, "medium"), floor="low"))
        .when(event_type == "halt", band(score, (35, "medium"), floor="low"))
        .otherwise(F.lit("medium"))
    )
