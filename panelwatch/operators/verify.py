"""Verification as tables: events to request texts, answers to verdicts, verdicts onto events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import answers
from ..functions.scalars import QUEUE_RANK, has_name, lacks_name, rank_of
from .events import VERDICT_SCHEMA, ensure_columns, sum_lines
from .ordered import after_first, with_prior_sums

# What a skipped event says, and the price of one check by the verifier's size.
SKIP_DETAILS = "Skipped verification - no company name found in database"
NO_ANSWER = "no answer"
VERIFIER_PRICES = {"large": "0.003", "small": "0.0003"}


def verification_queue(events: DataFrame, batch_size: int | None) -> DataFrame:
    """Named events: the ``batch_size`` most confident ones in order, or all of them, unsorted."""
    named = events.where(has_name()).withColumn("conf_rank", rank_of("confidence", QUEUE_RANK))
    if batch_size is None:
        return named
    first = (F.col("conf_rank").desc_nulls_last(), F.col("detection_score").desc(), "gvkey", "event_type", "event_date", "seq")
    return named.orderBy(*first).limit(batch_size)


def skipped_rows(events: DataFrame) -> DataFrame:
    """Verdict rows of the events that have no name to search for."""
    return events.where(lacks_name()).select(
        "gvkey",
        F.lit("Unknown").alias("company_name"),
        F.lit(False).alias("verified"),
        F.lit("skipped").alias("actual_event_type"),
        F.lit("low").alias("llm_confidence"),
        F.lit(SKIP_DETAILS).alias("details"),
        F.col("event_type").alias("detected_event_type"),
        F.date_format("event_date", "yyyy-MM-dd").alias("detected_date"),
        F.lit("no_company_name").alias("skip_reason"),
    )


def _or(column: str, default: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(default))


def request_text() -> Column:
    """Request for one event of any kind."""
    name, kind = _or("company_name", "Unknown Company"), F.col("event_type")
    return F.concat(
        F.lit("Check a suspected "), kind, F.lit(" of "), name, F.lit(" (GVKEY "), _or("gvkey", "Unknown"),
        F.lit(").\nDetected date: "), F.date_format("event_date", "yyyy-MM-dd"),
        F.lit("\nDetection score: "), _or("detection_score", "N/A"),
        F.lit("\nConfidence: "), _or("confidence", "N/A"),
        F.lit("\nReasons: "), _or("reasons", "N/A"),
        F.lit("\nSearch for what happened to "), name, F.lit(" around "), F.date_format("event_date", "MMMM yyyy"),
        F.lit(" and answer with one JSON object with these keys:\n"), F.lit(answers.field_guide(answers.EVENT_TYPES)),
        F.lit("\nIf nothing is found, set verified to false and llm_confidence to low."),
    )


def request_text_for_year(year: int) -> Column:
    """Stricter request: the date must be found, not guessed, and the year is named."""
    name, kind = _or("company_name", "Unknown"), F.col("event_type")
    return F.concat(
        F.lit("Check a suspected "), kind, F.lit(" of "), name, F.lit(" (GVKEY "), _or("gvkey", "Unknown"),
        F.lit(").\nDetected date: "), F.date_format("event_date", "yyyy-MM-dd"),
        F.lit("\nFind out what really happened to "), name,
        F.lit(f" in {year}.\nLeave actual_date null unless the exact date is found; never reuse the detected date unconfirmed."),
        F.lit("\nAnswer with one JSON object with these keys:\n"), F.lit(answers.field_guide(answers.YEAR_EVENT_TYPES)),
        F.lit("\nIf nothing is found, set verified to false and llm_confidence to low."),
    )


def verdicts_from_answers(responses: DataFrame, balanced: bool = True) -> DataFrame:
    """Add the verdict fields, ``failed`` and ``stop`` to rows with response_text and error_text.

    A failed call or an unreadable answer gives an unverified 'error' verdict; some call errors
    stop the run.
    """
    extract = answers.balanced_json if balanced else answers.fenced_json
    error = F.col("error_text")
    rows = responses.withColumn("_verdict", F.when(error.isNull(), answers.parse_verdict(extract(F.col("response_text")))))
    failed = F.col("_verdict").isNull()
    stop = answers.is_stop(error)
    unread = F.when(F.col("response_text").isNull(), F.lit(NO_ANSWER)).otherwise(F.lit("answer is not a JSON object"))
    problem = F.coalesce(error, unread)
    if balanced:
        problem = F.concat(F.when(stop, "API error: ").otherwise("Error: "), problem)
        date = answers.null_if_no_date(F.col("_verdict.actual_date"))
    else:
        problem = F.concat(F.lit("Error during verification: "), problem)
        date = F.col("_verdict.actual_date")
    return rows.withColumns(
        {
            "failed": failed,
            "stop": stop,
            "verified": F.coalesce("_verdict.verified", F.lit(False)),
            "actual_event_type": F.when(failed, "error").otherwise(F.col("_verdict.actual_event_type")),
            "actual_date": date,
            "llm_confidence": F.when(failed, "low").otherwise(F.col("_verdict.llm_confidence")),
            "details": F.when(failed, problem).otherwise(F.col("_verdict.details")),
            "acquirer": F.col("_verdict.acquirer"),
            "acquisition_price": F.col("_verdict.acquisition_price"),
        }
    ).drop("_verdict")


def with_metadata(verdicts: DataFrame, events: DataFrame, on: str = "seq") -> DataFrame:
    """Add what was detected to each verdict."""
    detected = events.select(
        on,
        "gvkey",
        "company_name",
        F.col("event_type").alias("detected_event_type"),
        F.date_format("event_date", "yyyy-MM-dd").alias("detected_date"),
    )
    known = [c for c in ("gvkey", "company_name") if c in verdicts.columns]
    return verdicts.drop(*known).withColumnRenamed("response_text", "llm_response").join(detected, on)


def with_cost(responses: DataFrame, model: str = answers.PRICED_MODEL, prices: DataFrame | None = None) -> DataFrame:
    """Add the cost of each answered call; a failed call costs nothing.

    With a table ``prices`` (model, per_input, per_output, per_call), each call is priced by the model
    named in its row (``model`` where the row names none), and models outside the table cost the
    default.  A model listed more than once takes its dearest prices, and no call is counted twice.
    """
    free = F.lit(0).cast("decimal(20,12)")
    if prices is None:
        cost = answers.request_cost(F.col("prompt"), F.col("response_text"), model)
        return responses.withColumn("cost", F.when(F.col("error_text").isNull(), cost).otherwise(free))
    columns = ("per_input", "per_output", "per_call")
    listed = prices.groupBy(F.col("model").alias("_model")).agg(*[F.max(F.col(c).cast("decimal(20,12)")).alias(f"_{c}") for c in columns])
    named = F.coalesce("model", F.lit(model)) if "model" in responses.columns else F.lit(model)
    cost = answers.call_cost(F.col("prompt"), F.col("response_text"), *[F.col(f"_{c}") for c in columns])
    priced = responses.withColumn("_model", named).join(listed, "_model", "left")
    return priced.withColumn("cost", F.when(F.col("error_text").isNull(), cost).otherwise(free)).drop("_model", *[f"_{c}" for c in columns])


def admit_within_budget(
    requests: DataFrame, budget: str | None, keys: tuple[str, ...] = ()
) -> DataFrame:
    """Add what was spent before each request, and whether it is still admitted.

    Costs are never negative, so the rows not admitted are exactly those after the budget ran out.
    """
    rows = with_prior_sums(requests, {"spent_before": F.col("cost")}, "seq", keys)
    if budget is None:
        return rows.withColumns({"admitted": F.lit(True), "percent_used": F.lit(None).cast("double")})
    limit = F.lit(budget).cast("decimal(20,12)")
    return rows.withColumns(
        {
            "admitted": F.col("spent_before") < limit,
            "percent_used": F.col("spent_before").cast("double") / F.lit(float(budget)) * 100,
        }
    )


def before_stop(rows: DataFrame, stop: str = "stop") -> DataFrame:
    """Rows before the first stop in ``seq`` order: the stop row and all after it stay unprocessed."""
    first = rows.where(F.col(stop)).agg(F.min("seq")).scalar()
    return rows.where(first.isNull() | (F.col("seq") < first))


def upsert_verdicts(events: DataFrame, verdicts: DataFrame, on: str = "seq") -> DataFrame:
    """Overwrite the verdict columns of processed events; an absent date clears the old one."""
    events = ensure_columns(events, VERDICT_SCHEMA)
    new = verdicts.select(on, F.lit(True).alias("_done"), *[F.col(c).alias(f"_{c}") for c in VERDICT_SCHEMA])
    written = {c: F.when(F.col("_done"), F.col(f"_{c}")).otherwise(F.col(c)) for c in VERDICT_SCHEMA}
    written["actual_date"] = F.when(
        F.col("_done"), answers.null_if_no_date(F.col("_actual_date"))
    ).otherwise(F.col("actual_date"))
    return events.join(new, on, "left").withColumns(written).drop("_done", *[f"_{c}" for c in VERDICT_SCHEMA])


def cost_estimate(events: DataFrame, batch_size: int, delay_seconds: float = 0.5) -> DataFrame:
    """One row: events, named events, how many would be verified, and at what cost and time."""
    counted = events.agg(F.count(F.lit(1)).alias("events"), F.count_if(has_name()).alias("named"))
    n = F.least(F.lit(batch_size).cast("long"), F.col("named"))
    costs = {f"cost_{size}": n * F.lit(float(price)) for size, price in VERIFIER_PRICES.items()}
    return counted.withColumns({"to_verify": n, **costs, "minutes": n * F.lit(delay_seconds) / 60})


def usage_stats(requests: DataFrame) -> DataFrame:
    """One row over the answered calls: number, total cost, mean cost."""
    answered = requests.where(F.col("error_text").isNull())
    total = F.sum("cost").cast("double")
    n = F.count(F.lit(1))
    return answered.agg(
        n.alias("requests"), F.coalesce(total, F.lit(0.0)).alias("total_cost"), F.try_divide(total, n).alias("mean_cost")
    )


def verdict_summary(verdicts: DataFrame) -> DataFrame:
    """(metric, n): verified, not verified, and the event types among the verified."""
    kinds = verdicts.groupBy("verified", "actual_event_type").agg(F.count(F.lit(1)).alias("n"))
    return sum_lines(
        kinds,
        ("CASE WHEN verified THEN 'verified' ELSE 'not_verified' END", "n"),
        ("CASE WHEN verified THEN concat('type:', actual_event_type) END", "n"),
    )


def year_summary(events: DataFrame) -> DataFrame:
    """(metric, n) over one year's events: total, verified, dated, cleared, types of the dated."""
    dated = F.col("actual_date").isNotNull()
    kinds = events.groupBy("actual_event_type").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("verified")).alias("verified"),
        F.count_if(dated).alias("with_date"),
        F.count_if(~dated).alias("no_date"),
    )
    return sum_lines(
        kinds,
        *[(f"'{name}'", name) for name in ("total", "verified", "with_date", "no_date")],
        ("CASE WHEN with_date > 0 THEN concat('type:', actual_event_type) END", "with_date"),
    )


def resume_after(events: DataFrame, done: int) -> DataFrame:
    return after_first(events, done)
