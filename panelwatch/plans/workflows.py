"""The end-to-end runs, each a composition of operators on lazy tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import answers
from ..functions.scalars import date_or_null, has_name, number_text
from ..operators import label, verify
from ..operators.events import confident_verdicts, in_year, value_counts, verified_acquisitions
from ..operators.ordered import stored, with_prior_sums
from ..sources import readers, writers
from .detectors import stored_detections

REPORT = ("section", "metric", "key", "value")


def reverify_year(
    events: DataFrame,
    responses: DataFrame,
    year: int,
    resume_from: int = 0,
    budget: str | None = None,
    model: str = answers.PRICED_MODEL,
) -> DataFrame:
    """One year's named events against their answers, written back onto the whole events table.

    ``events`` has seq, event_date (text), company_name, ...; ``responses`` has seq, prompt,
    response_text, error_text.  The run skips ``resume_from`` events, ends when the budget is
    spent and ends at the first stop error.
    """
    dated = events.withColumn("_day", date_or_null("event_date"))
    due = in_year(dated, year, F.col("_day")).where(has_name()).select("seq")
    calls = verify.with_cost(responses, model).select(
        "seq", "cost", answers.is_stop(F.col("error_text")).alias("stop"), F.lit(True).alias("answered")
    )
    counted = {"position": F.lit(1).cast("long"), "spent_before": F.col("cost"), "stops_before": F.col("stop").cast("int")}
    line = with_prior_sums(due.join(calls, "seq", "left"), counted)
    live = line.where((F.col("position") >= resume_from) & F.col("answered"))
    spent, stops = F.col("spent_before"), F.col("stops_before")
    if resume_from:  # what was spent before the first event of this run does not count in it
        start = line.where(F.col("position") == resume_from)
        spent, stops = spent - start.agg(F.max("spent_before")).scalar(), stops - start.agg(F.max("stops_before")).scalar()
    reached = live.where(~F.col("stop") & (stops == 0))
    if budget is not None:
        reached = reached.where(spent < F.lit(budget).cast("decimal(20,12)"))
    admitted = responses.join(reached.select("seq"), "seq", "left_semi")
    return verify.upsert_verdicts(events, verify.verdicts_from_answers(admitted))


def upsert_stored(events_path: str, verdicts: DataFrame, by: str = "year") -> None:
    """Write verdicts (see :func:`verify.upsert_verdicts`) onto an events folder laid out by ``by``, rewriting only what they touch.

    The folder's events carry the verdict columns, empty at first (see ``pad_event_schema``).  Two events may share a partition, so a partition that holds one new verdict is written anew as a whole; the others, usually most
    of the folder, are neither read beyond their keys nor written.
    """
    events = verdicts.sparkSession.read.parquet(events_path)
    touched = stored(events.select("seq", by).join(verdicts.select("seq"), "seq", "left_semi").select(by).distinct(), "touched")
    changed = verify.upsert_verdicts(events.join(touched, by, "left_semi"), verdicts)
    writers.overwrite_partitions(stored(changed, "changed"), events_path, by)


def reverified_year_summary(updated: DataFrame, year: int) -> DataFrame:
    return verify.year_summary(in_year(updated, year, date_or_null("event_date")))


def verify_queue(events: DataFrame, responses: DataFrame, batch_size: int | None = 100) -> DataFrame:
    """Queued events with their parsed answers, plus the rows skipped for want of a name.

    ``events`` carries the ``seq`` under which its answer is found; an event without one gets the
    verdict 'error'.  Only answers of queued events are parsed.
    """
    queued = verify.verification_queue(events, batch_size).select(
        "seq", "gvkey", "company_name", F.col("event_type").alias("detected_event_type"),
        F.date_format("event_date", "yyyy-MM-dd").alias("detected_date"),
    )
    given = queued.join(responses.select("seq", "response_text", "error_text"), "seq", "left")
    verdicts = verify.verdicts_from_answers(given, balanced=False).select(
        "gvkey", "company_name", "verified", "actual_event_type", "actual_date", "llm_confidence", "details",
        "acquirer", "acquisition_price", "detected_event_type", "detected_date",
    )
    return verify.skipped_rows(events).unionByName(verdicts, allowMissingColumns=True)


def label_from_verdicts(panel: DataFrame, verdicts: DataFrame, minimum: str = "medium") -> DataFrame:
    """Panel labelled by the confident verdicts' windows."""
    events = label.label_events(confident_verdicts(verdicts, minimum))
    return label.label_windows(panel, events)


def clean_acquisitions(verdicts: DataFrame) -> DataFrame:
    return label.acquisition_fields(label.dedup_events(verified_acquisitions(verdicts)))


def label_from_acquisitions(panel: DataFrame, verdicts: DataFrame) -> DataFrame:
    return label.label_acquisitions(panel, clean_acquisitions(verdicts))


def _lines(df: DataFrame, section: str, metric, key, value) -> DataFrame:
    as_text = lambda c: c.cast("string")
    return df.select(
        F.lit(section).alias("section"), metric.alias("metric"), as_text(key).alias("key"), as_text(value).alias("value")
    )


def summary_report(
    panel: DataFrame, detected: DataFrame, verdicts: DataFrame, labeled: DataFrame
) -> DataFrame:
    """Long table (section, metric, key, value) over the panel, the detection, the verdicts, the labels."""
    none = F.lit(None).cast("string")
    cells = panel.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("first"), F.max("date").alias("last")
    )
    data = cells.agg(
        F.count(F.lit(1)).alias("total_stocks"),
        F.min("first").alias("first_date"),
        F.max("last").alias("last_date"),
        F.sum("n").alias("total_observations"),
    )
    facts = ("total_stocks", "first_date", "last_date", "total_observations")
    pairs = F.array(*[F.struct(F.lit(c).alias("m"), F.col(c).cast("string").alias("v")) for c in facts])
    dataset = _lines(data.select(F.inline(pairs)), "dataset", F.col("m"), none, F.col("v"))

    counts = value_counts(detected.withColumn("total", F.lit("")), ["total", "event_type", "confidence"])
    found = _lines(counts, "detection", F.col("column"), F.nullif("value", F.lit("")), F.col("n"))

    verified = _lines(verify.verdict_summary(verdicts), "verification", F.col("metric"), none, F.col("n"))

    shares = label.label_distribution(labeled).selectExpr(
        "inline(array(struct('rows' AS metric, label AS key, string(n) AS value), struct("
        f"if(label = '(labeled rows)', 'percent', NULL) AS metric, NULL AS key, {number_text('percent', 2)} AS value)))"
    )
    labels = _lines(shares.where("metric IS NOT NULL"), "labels", F.col("metric"), F.col("key"), F.col("value"))
    return dataset.unionByName(found).unionByName(verified).unionByName(labels)


# The thresholds of a run whose events are all checked afterwards.
WIDE_NET = {"bankruptcy": 5, "merger": 5, "halt": 5}


def full_run(
    panel: DataFrame, names: DataFrame, responses: DataFrame, folder: str, batch_size: int | None = None
) -> dict[str, DataFrame]:
    """Detect, verify, label and export: four outputs below ``folder``, each returned as read back.

    ``responses`` holds a firm's answer (gvkey, response_text, error_text); an event of a firm
    without one gets an error verdict.  Each step starts from the file of the step before; the panel is written once, for all steps.
    """
    spark = panel.sparkSession
    panel = stored(panel, "panel")

    def exported(df: DataFrame, name: str, write) -> DataFrame:
        write(df, f"{folder}/{name}")
        return readers.read_table(spark, f"{folder}/{name}", df.schema, free_text=True)

    detected = exported(stored_detections(panel, names, WIDE_NET), "detected_events.csv", writers.write_events_csv)
    asked = detected.withColumn("seq", F.col("gvkey"))
    verified = verify_queue(asked, responses.withColumn("seq", F.col("gvkey")), batch_size)
    verified = exported(verified, "verified_events.csv", writers.write_events_csv)
    # Events of one firm share its answer, so what comes last among equals makes no difference.
    last = F.struct("detected_date", "detected_event_type")
    dated = verified.withColumns(
        {"seq": last, "verified": F.col("verified").cast("string"), "actual_date_raw": F.col("actual_date"), "detected_date_raw": F.col("detected_date")}
    )
    labeled = label_from_verdicts(panel, dated)
    labeled.write.mode("overwrite").parquet(f"{folder}/labeled_data.parquet")
    labeled = readers.read_parquet(spark, f"{folder}/labeled_data.parquet")
    report = summary_report(panel, detected, verified, labeled)
    writers.write_report_text(report, f"{folder}/summary_report.txt")
    return {"detected": detected, "verified": verified, "labeled": labeled, "report": report}
