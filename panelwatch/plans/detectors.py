"""The detectors: feature rows or dated gaps in, event rows out."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.points import Rule, total_points, usable, joined_reasons, with_score
from ..functions.scalars import band, number_text
from ..operators.events import EVENT_COLUMNS, best_events, event_rows, union_events
from ..operators.features import (
    Features,
    dataset_end,
    dataset_start,
    days_before,
    firm_features,
    global_quantile,
)
from ..operators.names import attach_names
from ..operators.ordered import ROW_ORDER, date_cells, stored, with_previous
from . import rules

SPREAD_QUANTILE = 0.85
MERGER_MIN_DAYS = 120
SINGLE_MERGER_MIN_DAYS = 240
REJECT_MERGER_AT = 30


def firm_rows(panel: DataFrame, wanted: Features, end: Column, key: str = "gvkey") -> DataFrame:
    """Feature rows of firms plus the days between their last row and ``end``."""
    return firm_features(panel, wanted, key).withColumn("days_since", days_before(end))


def _with_spread(firms: DataFrame, panel: DataFrame) -> DataFrame:
    if "bidaskhl_21d" not in panel.columns:
        return firms
    return firms.withColumn("spread_p85", global_quantile(panel, "bidaskhl_21d", SPREAD_QUANTILE))


def _scored(firms: DataFrame, **rule_sets: list[Rule]) -> DataFrame:
    """Add <name>_score and <name>_reasons per rule set, each computed once per firm."""
    columns = firms.columns
    added = {}
    for name, rule_set in rule_sets.items():
        live = usable(rule_set, columns)
        added[f"{name}_score"] = total_points(live)
        added[f"{name}_reasons"] = joined_reasons(live)
    return firms.withColumns(added)


def _candidate(kind: str, holds: str, confidence: str, priority: int = 1) -> str:
    """SQL struct of one possible event of a scored firm."""
    return (
        f"struct('{kind}' AS event_type, last_date AS event_date, {kind}_score AS detection_score, "
        f"{confidence} AS confidence, {kind}_reasons AS reasons, {holds} AS holds, {priority} AS priority)"
    )


def _graded(score: str, *cuts: tuple[int, str]) -> str:
    return "CASE " + " ".join(f"WHEN {score} >= {cut} THEN '{label}'" for cut, label in cuts) + " ELSE 'low' END"


def _full_bankruptcy(threshold: int) -> str:
    graded = _graded("bankruptcy_score", (60, "high"), (40, "medium"))
    return _candidate("bankruptcy", f"bankruptcy_score >= {threshold}", graded)


def _full_merger(threshold: int) -> str:
    holds = f"days_since >= {MERGER_MIN_DAYS} AND merger_score >= {threshold} AND against_score < {REJECT_MERGER_AT}"
    return _candidate("merger", holds, _graded("merger_score", (40, "medium")))


def _flagged(firms: DataFrame, candidates: Sequence[str], *keep: str) -> DataFrame:
    """One row per candidate that holds, from a single pass over the feature rows."""
    return firms.selectExpr(*keep, f"inline(array({', '.join(candidates)}))").where("holds").drop("holds")


EXTRAS = ("last_price", "price_change_60d")


def detect_bankruptcy(panel: DataFrame, names: DataFrame, threshold: int = 50) -> DataFrame:
    firms = firm_rows(panel, rules.BANKRUPTCY_FEATURES, dataset_end(panel))
    firms = _scored(_with_spread(firms.where("n_rows >= 24"), panel), bankruptcy=rules.BANKRUPTCY)
    firms = firms.withColumn("price_change_60d", F.col("price_change") * 100)
    flagged = _flagged(firms, [_full_bankruptcy(threshold)], "gvkey", *EXTRAS)
    return attach_names(flagged, names).select(*EVENT_COLUMNS, *EXTRAS)


def detect_merger(panel: DataFrame, names: DataFrame, threshold: int = 40) -> DataFrame:
    firms = firm_rows(panel, rules.MERGER_FEATURES, dataset_end(panel))
    firms = _scored(firms.where("n_rows >= 24"), merger=rules.MERGER, against=rules.NOT_MERGER)
    firms = firms.withColumn("price_change_60d", F.col("price_change") * 100)
    flagged = _flagged(firms, [_full_merger(threshold)], "gvkey", *EXTRAS)
    return attach_names(flagged, names).select(*EVENT_COLUMNS, *EXTRAS)


def detect_all(
    panel: DataFrame, names: DataFrame, bankruptcy: int = 15, merger: int = 10
) -> DataFrame:
    """Bankruptcies and mergers of the full rule sets from one feature table."""
    wanted = rules.BANKRUPTCY_FEATURES | rules.MERGER_FEATURES
    firms = firm_rows(panel, wanted, dataset_end(panel)).where("n_rows >= 24")
    firms = _scored(
        _with_spread(firms, panel), bankruptcy=rules.BANKRUPTCY, merger=rules.MERGER, against=rules.NOT_MERGER
    )
    flagged = _flagged(firms, [_full_bankruptcy(bankruptcy), _full_merger(merger)], "gvkey")
    return event_rows(attach_names(flagged, names))


def single_pass_scores(panel: DataFrame) -> DataFrame:
    """Per firm the single-pass bankruptcy and merger scores with their reasons.

    Firms with fewer than 24 rows, and merger scores of firms that still trade, are 0.
    """
    firms = firm_rows(panel, rules.SINGLE_FEATURES, dataset_end(panel))
    firms = _scored(firms, bankruptcy=rules.SINGLE_BANKRUPTCY, merger=rules.SINGLE_MERGER)
    scored = "n_rows >= 24"
    mergeable = f"{scored} AND days_since >= {SINGLE_MERGER_MIN_DAYS}"
    return firms.selectExpr(
        "gvkey",
        "n_rows",
        "last_date",
        f"CASE WHEN {scored} THEN bankruptcy_score ELSE 0 END AS bankruptcy_score",
        f"CASE WHEN {scored} THEN bankruptcy_reasons ELSE '' END AS bankruptcy_reasons",
        f"CASE WHEN {mergeable} THEN merger_score ELSE 0 END AS merger_score",
        f"CASE WHEN {mergeable} THEN merger_reasons ELSE '' END AS merger_reasons",
    )


def single_pass_candidates(
    panel: DataFrame, bankruptcy: int = 50, merger: int = 40
) -> DataFrame:
    """Possible events of each firm with at least 10 rows, with their priorities."""
    firms = single_pass_scores(panel).where("n_rows >= 10")
    failed = _candidate(
        "bankruptcy",
        f"bankruptcy_score >= {bankruptcy}",
        _graded("bankruptcy_score", (60, "high"), (40, "medium")),
    )
    merged = _candidate(
        "merger",
        f"bankruptcy_score < {bankruptcy * 0.8} AND merger_score >= {merger}",
        _graded("merger_score", (50, "medium")),
        priority=2,
    )
    return _flagged(firms, [failed, merged], "gvkey")


def detect_single_pass(
    panel: DataFrame, names: DataFrame, bankruptcy: int = 50, merger: int = 40
) -> DataFrame:
    """At most one event per firm."""
    best = best_events(single_pass_candidates(panel, bankruptcy, merger))
    return event_rows(attach_names(best, names))


# ---------------------------------------------------------------------------------------------
# Gaps in trading.  Everything here works on (firm, date) cells, see operators.ordered.


def _cells_with_history(panel: DataFrame, key: str, at_least: int = 10) -> DataFrame:
    cells = date_cells(panel.where(F.col(key).isNotNull()), key)
    total = F.sum("n_rows").over(Window.partitionBy(key))
    return cells.withColumn("firm_rows", total).where(F.col("firm_rows") >= at_least)


def gap_islands(cells: DataFrame, min_days: int, key: str = "gvkey") -> DataFrame:
    """Runs of gaps with no ordinary row between them: start, end, days, number, resumed.

    A gap continues a run if the row before it is itself the end of a gap.  A run is resumed if
    any row follows its last gap row, be it on the same date.
    """
    by_date = Window.partitionBy(key).orderBy("date")
    gaps = cells.where(F.col("gap_days") >= min_days)
    continues = (F.lag("date").over(by_date) == F.col("prev_date")) & (F.col("prev_rows") == 1)
    numbered = gaps.withColumn("_starts", F.when(continues, 0).otherwise(1)).withColumn(
        "_run", F.sum("_starts").over(by_date)
    )
    followed = F.col("next_date").isNotNull() | (F.col("n_rows") > 1)
    return (
        numbered.groupBy(key, "_run")
        .agg(
            F.min("prev_date").alias("start_date"),
            F.max("date").alias("end_date"),
            F.sum("gap_days").alias("total_gap_days"),
            F.count(F.lit(1)).alias("consecutive_gaps"),
            F.max_by(followed, "date").alias("resumed"),
        )
        .drop("_run")
    )


def halt_islands(panel: DataFrame, key: str = "gvkey", min_days: int = 120) -> DataFrame:
    return gap_islands(_cells_with_history(panel, key), min_days, key)


def detect_halt(panel: DataFrame, names: DataFrame, threshold: int = 30) -> DataFrame:
    halts = with_score(halt_islands(panel), rules.HALT, "detection_score", "reasons")
    halts = halts.where(F.col("detection_score") >= threshold).select(
        "gvkey",
        F.lit("halt").alias("event_type"),
        F.col("start_date").alias("event_date"),
        F.col("end_date").alias("halt_end_date"),
        "detection_score",
        band(F.col("detection_score"), (20, "medium"), floor="low").alias("confidence"),
        "reasons",
        "total_gap_days",
        "consecutive_gaps",
    )
    return attach_names(halts, names).select(*EVENT_COLUMNS, "halt_end_date", "total_gap_days", "consecutive_gaps")


def score_single_halts(panel: DataFrame) -> DataFrame:
    """Per firm the best single gap that was followed by a later date; the earliest of equals."""
    gaps = _cells_with_history(panel, "gvkey").where((F.col("gap_days") >= 120) & F.col("next_date").isNotNull())
    scored = with_score(gaps, rules.SINGLE_HALT, "score", "reasons")
    best = Window.partitionBy("gvkey").orderBy(F.col("score").desc(), "date")
    return (
        scored.withColumn("_rank", F.row_number().over(best))
        .where(F.col("_rank") == 1)
        .select("gvkey", "score", "reasons", F.col("date").alias("halt_date"))
    )


def detect_halt_simple(panel: DataFrame, threshold: int = 3, key: str = "ticker") -> DataFrame:
    """Every gap of 90 days or more is an event of its own."""
    gaps = _cells_with_history(panel, key).where(F.col("gap_days") >= 90)
    gaps = gaps.withColumn("resumed", F.col("next_date").isNotNull() | (F.col("n_rows") > 1))
    scored = with_score(gaps, rules.SIMPLE_HALT, "detection_score", "reasons")
    return scored.where(F.col("detection_score") >= threshold).select(
        key,
        F.lit("halt").alias("event_type"),
        F.col("prev_date").alias("event_date"),
        F.col("date").alias("halt_end_date"),
        "detection_score",
        band(F.col("detection_score"), (25, "medium"), floor="low").alias("confidence"),
        "reasons",
        "gap_days",
    )


# ---------------------------------------------------------------------------------------------
# First appearances.


def first_row_values(panel: DataFrame, columns: Sequence[str], key: str = "gvkey") -> DataFrame:
    """First date per firm and the values of its first row, as one partial aggregation."""
    order = F.struct(*ROW_ORDER)
    firms = panel.where(F.col(key).isNotNull()).groupBy(key)
    first = firms.agg(F.min_by(F.struct("date", *columns), order).alias("first"))
    return first.select(key, F.col("first.date").alias("first_date"), *[F.col(f"first.{c}").alias(f"first_{c}") for c in columns])


def _appeared(firms: DataFrame, start: Column) -> DataFrame:
    return firms.withColumn("months_after_start", F.datediff("first_date", start) / F.lit(30.0))


def detect_ipo(panel: DataFrame, names: DataFrame, start: date | None = None) -> DataFrame:
    """Firms that appear 18 months or more after the data starts, under three years old."""
    if "age" not in panel.columns:
        return event_rows(panel.limit(0).select("gvkey")).withColumn("first_price", F.lit(None).cast("double"))
    begin = F.lit(start) if start is not None else dataset_start(panel)
    firms = _appeared(first_row_values(panel, ["age", "price"]), begin)
    young = firms.where((F.col("months_after_start") >= 18) & (F.col("first_age") < 3))
    reason = rules.text(
        "'Young firm (age '", number_text("first_age", 1), "'y), appeared '",
        number_text("months_after_start", 1), "' months after dataset start'",
    )
    events = young.select(
        "gvkey",
        F.lit("ipo").alias("event_type"),
        F.col("first_date").alias("event_date"),
        F.lit(100).alias("detection_score"),
        F.lit("high").alias("confidence"),
        F.expr(reason).alias("reasons"),
        "first_price",
    )
    return attach_names(events, names).select(*EVENT_COLUMNS, "first_price")


def detect_ipo_simple(panel: DataFrame, start: date | None = None, key: str = "ticker") -> DataFrame:
    """Tickers that appear six months or more after the data starts, graded by the firm's age."""
    begin = F.lit(start) if start is not None else dataset_start(panel)
    aged = "firm_age" in panel.columns
    firms = _appeared(first_row_values(panel, ["price", *(["firm_age"] if aged else [])], key), begin)
    age = F.col("first_firm_age") if aged else F.lit(None).cast("double")
    later = rules.text(number_text("months_after_start", 1), "' months after dataset start'")
    firms = firms.where(F.col("months_after_start") >= 6).withColumn("_age", age)
    age_text = number_text("_age", 1)
    return firms.select(
        key,
        F.when(F.col("_age") >= 2, "uncertain_ipo").otherwise("ipo").alias("event_type"),
        F.col("first_date").alias("event_date"),
        F.lit(100).alias("detection_score"),
        F.when(F.col("_age") < 2, "high").otherwise("medium").alias("confidence"),
        F.when(F.col("_age") < 2, F.expr(rules.text("'Young firm (age '", age_text, "'y), appeared '", later)))
        .when(F.col("_age") >= 2, F.expr(rules.text("'Firm age '", age_text, "'y, appeared '", later)))
        .otherwise(F.expr(rules.text("'Appeared '", later)))
        .alias("reasons"),
        "first_price",
    )


# ---------------------------------------------------------------------------------------------
# Row against previous row.


def return_on_previous(price: Column, previous: Column) -> Column:
    """price / previous - 1, a signed infinity over zero, missing for 0/0."""
    return (
        F.when((previous == 0) & (price > 0), F.lit(float("inf")))
        .when((previous == 0) & (price < 0), F.lit(float("-inf")))
        .otherwise(F.try_divide(price, previous) - 1)
    )


def rows_with_previous(panel: DataFrame, key: str) -> DataFrame:
    """Prices and volumes of each row and of the firm's (or ticker's) row before it."""
    columns = [c for c in ("price", "volume") if c in panel.columns]
    rows = panel.where(F.col(key).isNotNull()).select(*dict.fromkeys([key, "date", "iid", *columns]))
    return with_previous(rows, columns, key)


def split_rows(rows: DataFrame, key: str) -> DataFrame:
    """Rows whose price fell by a split ratio, scored; ``rows`` come from :func:`rows_with_previous`."""
    volume = "volume" in rows.columns
    rows = rows.withColumn("change", return_on_previous(F.col("price"), F.col("prev.price")))
    kind = F.lit(None).cast("string")
    for ratio, name in rules.SPLIT_RATIOS.items():
        kind = F.when(F.abs(F.col("change") - ratio) < rules.SPLIT_TOLERANCE, F.lit(name)).otherwise(kind)
    rows = rows.withColumn("split_type", kind).where(F.col("split_type").isNotNull())
    if volume:
        rows = rows.withColumn("prev_volume", F.col("prev.volume"))
    return with_score(rows, rules.SPLIT, "detection_score", "reasons").select(
        key,
        F.lit("stock_split").alias("event_type"),
        F.col("date").alias("event_date"),
        "detection_score",
        F.lit("medium").alias("confidence"),
        "reasons",
        "split_type",
    )


def detect_stock_split(panel: DataFrame, names: DataFrame) -> DataFrame:
    return attach_names(split_rows(rows_with_previous(panel, "gvkey"), "gvkey"), names).select(*EVENT_COLUMNS, "split_type")


def detect_split_simple(panel: DataFrame) -> DataFrame:
    return split_rows(rows_with_previous(panel, "ticker"), "ticker")


def data_error_rows(rows: DataFrame, key: str, rule_set: list[Rule], threshold: int) -> DataFrame:
    """Rows whose price or volume cannot be right; ``rows`` come from :func:`rows_with_previous`."""
    before = F.col("prev.price")
    rows = rows.withColumn("prev_price", before).withColumn(
        "jump", F.when(before > 0, (F.col("price") - before) / before)
    )
    return (
        with_score(rows, rule_set, "detection_score", "reasons")
        .where(F.col("detection_score") >= threshold)
        .select(
            key,
            F.lit("data_error").alias("event_type"),
            F.col("date").alias("event_date"),
            "detection_score",
            F.lit("high").alias("confidence"),
            "reasons",
            "price",
        )
    )


def detect_data_errors(panel: DataFrame, names: DataFrame, threshold: int = 10) -> DataFrame:
    rows = data_error_rows(rows_with_previous(panel, "gvkey"), "gvkey", rules.DATA_ERROR, threshold)
    return attach_names(rows, names).select(*EVENT_COLUMNS, "price")


def detect_data_errors_simple(panel: DataFrame, threshold: int = 3) -> DataFrame:
    return data_error_rows(rows_with_previous(panel, "ticker"), "ticker", rules.SIMPLE_DATA_ERROR, threshold)


# ---------------------------------------------------------------------------------------------
# Simplified bankruptcy and merger rules.  ``as_of`` stands in for the clock.


def detect_bankruptcy_simple(
    panel: DataFrame, as_of: date, threshold: int = 5, key: str = "ticker"
) -> DataFrame:
    firms = firm_rows(panel, rules.SIMPLE_BANKRUPTCY_FEATURES, F.lit(as_of), key)
    firms = _scored(firms.where("n_rows >= 24"), bankruptcy=rules.SIMPLE_BANKRUPTCY)
    graded = _graded("bankruptcy_score", (50, "high"), (35, "medium"))
    option = _candidate("bankruptcy", f"bankruptcy_score >= {threshold}", graded)
    return _flagged(firms, [option], key, "last_price").drop("priority")


def detect_merger_simple(
    panel: DataFrame, as_of: date, threshold: int = 5, key: str = "ticker"
) -> DataFrame:
    firms = firm_rows(panel, rules.SIMPLE_MERGER_FEATURES, F.lit(as_of), key)
    firms = firms.where("n_rows >= 24 AND days_since >= 90")
    firms = _scored(firms, merger=rules.SIMPLE_MERGER, against=rules.SIMPLE_NOT_MERGER)
    holds = f"merger_score >= {threshold} AND against_score < {REJECT_MERGER_AT}"
    option = _candidate("merger", holds, _graded("merger_score", (35, "medium")))
    return _flagged(firms, [option], key, "last_price").drop("priority")


def union_detections(panel: DataFrame, names: DataFrame, thresholds: dict[str, int] | None = None) -> DataFrame:
    """All six full detectors on the shared columns, over one feature table and one table of previous rows.

    The columns they read are written once, so that what makes the panel is not shuffled again for each detector.
    """
    wanted = rules.BANKRUPTCY_FEATURES | rules.MERGER_FEATURES
    read = {"gvkey", *ROW_ORDER, "price", "volume", "age", "bidaskhl_21d", *wanted.last, *wanted.recent, *wanted.medians, *wanted.before_last}
    return stored_detections(stored(panel.select(*[c for c in panel.columns if c in read]), "panel"), names, thresholds)


def stored_detections(panel: DataFrame, names: DataFrame, thresholds: dict[str, int] | None = None) -> DataFrame:
    """:func:`union_detections` over a panel that is a table already."""
    limits = {"bankruptcy": 50, "merger": 40, "halt": 30, "data_error": 10, **(thresholds or {})}
    rows = rows_with_previous(panel, "gvkey")
    errors = data_error_rows(rows, "gvkey", rules.DATA_ERROR, limits["data_error"])
    unnamed = attach_names(split_rows(rows, "gvkey").drop("split_type").unionByName(errors.drop("price")), names)
    return union_events(
        [
            detect_all(panel, names, limits["bankruptcy"], limits["merger"]),
            detect_halt(panel, names, limits["halt"]),
            detect_ipo(panel, names),
            event_rows(unnamed),
        ]
    )
