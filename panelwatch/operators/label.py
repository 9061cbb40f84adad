"""Labelling a panel from verified events, without pairing a firm's rows with its events.

A firm may have many rows and many events, and each row takes the last event that covers it.
Both sides are therefore first reduced to (firm, date): the calendar bounds what is left of any
firm, the winner per date is found by aggregation or by one running maximum, and the panel rows
fetch it by an equality join on (firm, date), which spreads a large firm over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import date_or_null
from .ordered import first_by

DISTRESS_DAYS = 60
#: Days of a calendar bin in which windows and the panel's dates meet.
BIN_DAYS = 128
BEFORE_EVENT = ("bankruptcy", "merger", "acquisition")

# What a labelling summary says about the filters behind it.
FILTERS_APPLIED = (
    "Only acquisitions (not mergers)",
    "Excluded all December 2014",
    "Dropped duplicates (gvkey + actual_date)",
    "Labeled closest month before acquisition",
    "Only verified events with actual_date",
)


def event_windows(events: DataFrame) -> DataFrame:
    """Add the dates [lo, hi] an event labels, by its type; ``halt_end_date`` may be absent."""
    day = F.col("event_date")
    end = F.coalesce("halt_end_date", day) if "halt_end_date" in events.columns else day
    kind = F.coalesce("actual_event_type", F.lit(""))
    return events.withColumns(
        {
            "lo": F.when(kind.isin(*BEFORE_EVENT), F.date_sub(day, DISTRESS_DAYS)).otherwise(day),
            "hi": F.when(kind == "halt", end).otherwise(day),
        }
    )


def _bin(date: str) -> Column:
    return F.floor(F.unix_date(F.col(date)) / BIN_DAYS)


def label_windows(panel: DataFrame, events: DataFrame, key: str = "gvkey") -> DataFrame:
    """Label each panel row with the last event (by ``seq``) whose window holds its date.

    ``events`` has key, seq, actual_event_type, event_date, llm_confidence, details.  An interval join
    by calendar bins: a window has a row per bin it touches, a date of the panel lies in one bin, and
    inside a bin the dates are compared, so no day without rows is ever made.  Per (firm, date) the
    last event wins, and each panel row meets at most one row.
    """
    label = F.struct(
        F.col("actual_event_type").alias("event_label"),
        F.col("event_date"),
        F.coalesce("llm_confidence", F.lit("medium")).alias("event_confidence"),
        F.coalesce("details", F.lit("")).alias("event_details"),
    )
    windows = (
        event_windows(events)
        .where(F.col("lo") <= F.col("hi"))
        .groupBy(key, "lo", "hi")
        .agg(F.max("seq").alias("seq"), F.max_by(label, "seq").alias("label"))
    )
    # Only bins between the panel's first and last date are made, whatever dates an event names.
    first, last = panel.agg(F.min("date")).scalar(), panel.agg(F.max("date")).scalar()
    windows = windows.withColumns({"lo": F.greatest("lo", first), "hi": F.least("hi", last)}).where("lo <= hi")
    binned = windows.withColumn("_bin", F.explode(F.sequence(_bin("lo"), _bin("hi"))))
    # The distinct dates of a panel are calendar days, a few ten thousand at most: safe to broadcast.
    calendar = F.broadcast(panel.select("date").distinct().withColumn("_bin", _bin("date")))
    covered = binned.join(calendar, "_bin").where(F.col("date").between(F.col("lo"), F.col("hi")))
    winners = covered.groupBy(key, "date").agg(F.max_by("label", "seq").alias("_label"))
    labeled = panel.join(winners, [key, "date"], "left")
    return labeled.withColumns(
        {
            "event_label": F.coalesce("_label.event_label", F.lit("none")),
            "event_date": F.col("_label.event_date"),
            "event_confidence": F.col("_label.event_confidence"),
            "event_details": F.coalesce("_label.event_details", F.lit("")),
        }
    ).drop("_label")


def dedup_events(events: DataFrame) -> DataFrame:
    """First event in file order per firm and date."""
    return first_by(events, ["gvkey", "actual_date"], "seq")


def acquisition_fields(events: DataFrame) -> DataFrame:
    return events.select("seq", "gvkey", "actual_date", "actual_event_type", "acquirer", "acquisition_price")


def label_acquisitions(panel: DataFrame, events: DataFrame) -> DataFrame:
    """Label all months before an acquisition, and flag the closest one.

    Each row takes the last event (by ``seq``) among those dated strictly after it; the flag goes
    to the first row of the latest date before each event.
    """
    details = F.struct("seq", "actual_date", "acquirer", "acquisition_price", "actual_event_type")
    marks = events.groupBy("gvkey", F.col("actual_date").alias("date")).agg(F.max(details).alias("event"))
    cells = panel.groupBy("gvkey", "date").agg(F.min("iid").alias("first_iid"))
    line = marks.withColumn("is_event", F.lit(1)).unionByName(
        cells.withColumn("is_event", F.lit(0)), allowMissingColumns=True
    )
    # From the newest date back; on one date the panel comes first, so equal dates do not match.
    back = Window.partitionBy("gvkey").orderBy(F.col("date").desc(), "is_event")
    later = back.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    labels = (
        line.where(F.col("gvkey").isNotNull() & F.col("date").isNotNull())
        .withColumn("_last", F.max("event").over(later))
        .withColumn("_next_is_event", F.lag("is_event").over(back) == 1)
        .where((F.col("is_event") == 0) & F.col("_last").isNotNull())
        .select("gvkey", "date", "first_iid", "_last", "_next_is_event")
    )
    flagged = F.col("_next_is_event") & F.col("iid").eqNullSafe(F.col("first_iid"))
    return (
        panel.join(labels, ["gvkey", "date"], "left")
        .withColumns(
            {
                "is_acquired": F.when(flagged, 1).otherwise(0),
                "acquisition_date": F.col("_last.actual_date"),
                "days_to_acquisition": F.datediff("_last.actual_date", "date"),
                "acquirer": F.col("_last.acquirer"),
                "acquisition_price": F.col("_last.acquisition_price"),
                "event_type_verified": F.col("_last.actual_event_type"),
            }
        )
        .drop("first_iid", "_last", "_next_is_event")
    )


def match_counts(panel: DataFrame, events: DataFrame) -> DataFrame:
    """One row: events with, and events without, an earlier panel row of their firm."""
    first = panel.groupBy("gvkey").agg(F.min("date").alias("first_date"))
    dates = events.groupBy("gvkey", "actual_date").agg(F.count(F.lit(1)).alias("n"))
    matched = F.coalesce(F.col("first_date") < F.col("actual_date"), F.lit(False))
    return (
        dates.join(first, "gvkey", "left")
        .withColumn("matched", matched)
        .agg(
            F.coalesce(F.sum(F.when(F.col("matched"), F.col("n"))), F.lit(0)).alias("events_matched"),
            F.coalesce(F.sum(F.when(~F.col("matched"), F.col("n"))), F.lit(0)).alias("events_unmatched"),
        )
    )


def label_events(verdicts: DataFrame) -> DataFrame:
    """Verdict rows as labelling events: the verified date, else the detected one."""
    actual = date_or_null("actual_date_raw")
    return verdicts.withColumn("event_date", F.coalesce(actual, date_or_null("detected_date_raw")))


def label_distribution(labeled: DataFrame) -> DataFrame:
    """(label, n, percent of all rows), with one line for all labelled rows."""
    counts = labeled.groupBy(F.col("event_label").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    # One row per label from here on.
    whole = counts.withColumn("total", F.sum("n").over(Window.partitionBy()))
    own = "struct(label AS label, n AS n, total AS total)"
    labeled_rows = "struct('(labeled rows)' AS label, if(label = 'none', 0L, n) AS n, total AS total)"
    lines = whole.selectExpr(f"inline(array({own}, {labeled_rows}))")
    summed = lines.groupBy("label").agg(F.sum("n").alias("n"), F.max("total").alias("total"))
    return summed.selectExpr("label", "n", "n / total * 100 AS percent")


def positives_by_year(labeled: DataFrame) -> DataFrame:
    positive = labeled.where(F.col("is_acquired") == 1)
    return positive.groupBy(F.year("date").alias("year")).agg(F.count(F.lit(1)).alias("n"))


def label_summary(labeled: DataFrame) -> DataFrame:
    """One row: rows, positives, negatives, rate in percent, years covered, filters applied."""
    by_year = labeled.groupBy(F.year("date").alias("year")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("is_acquired") == 1).alias("positives")
    )
    with_positive: Column = F.when(F.col("positives") > 0, F.col("year"))
    return by_year.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("positives"), F.lit(0)).alias("total_acquired"),
        F.sort_array(F.collect_set(with_positive)).alias("years_covered"),
    ).select(
        "total_rows",
        "total_acquired",
        (F.col("total_rows") - F.col("total_acquired")).alias("total_not_acquired"),
        F.try_divide(F.col("total_acquired") * F.lit(100.0), F.col("total_rows")).alias("positive_rate"),
        "years_covered",
        F.array(*[F.lit(text) for text in FILTERS_APPLIED]).alias("filters_applied"),
    )


def events_by_year(events: DataFrame) -> DataFrame:
    return events.groupBy(F.year("actual_date").alias("year")).agg(F.count(F.lit(1)).alias("n")).orderBy("year")


def multi_label_firms(labeled: DataFrame, largest: int = 10) -> DataFrame:
    """Firms with more than one positive row, the ``largest`` first, and how many there are."""
    firms = labeled.where(F.col("is_acquired") == 1).groupBy("gvkey").agg(F.count(F.lit(1)).alias("n"))
    several = firms.where(F.col("n") > 1)
    total = several.agg(F.count(F.lit(1))).scalar()
    return several.orderBy(F.col("n").desc(), "gvkey").limit(largest).withColumn("firms_with_several", total)
