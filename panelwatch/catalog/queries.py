"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import answers
from ..functions.scalars import confidence_band, date_or_null, has_name, yyyymmdd, yyyymmdd_or_null
from ..operators import events as ev
from ..operators import label, names, normalize, ordered, profile, verify
from ..operators.features import Features, dataset_bounds, dataset_end, dataset_start, firm_features
from ..operators.features import global_quantile as global_quantile_of
from ..operators.quantiles import column_quantile, group_quantiles
from ..plans import detectors, workflows
from ..sources import readers, writers
from .fixtures import AS_OF, Inputs

YEAR = 1998
RESUME_FROM = 20
BUDGET = "0.0050"
BATCH = 100
SINGLE = {"bankruptcy": 55, "merger": 50}

QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {}


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register a query under its function's name, without the underscore that avoids a name clash."""
    QUERIES[build.__name__.rstrip("_")] = build
    return build


def plain(df: DataFrame) -> DataFrame:
    """Result types every engine shares: dates as text, whole numbers as long, doubles to 6 places.

    Scaling before rounding rounds the same binary value in both engines.
    """
    out = []
    for f in df.schema:
        c = f"`{f.name}`"
        if isinstance(f.dataType, T.DateType):
            c = f"string({c})"
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = f"bigint({c})"
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = f"round(double({c}) * 1000000) / 1000000"
        elif isinstance(f.dataType, T.ArrayType):
            c = f"array_join(cast({c} AS array<string>), '; ')"
        out.append(f"{c} AS `{f.name}`")
    return df.selectExpr(*out)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build):
        return lambda spark, folder: plain(build(Inputs(spark, folder)))

    return {name: bind(build) for name, build in QUERIES.items()}


# Shared inputs ---------------------------------------------------------------------------------


def raw_panel(i: Inputs) -> DataFrame:
    return readers.nan_as_null(i.view("panel"))


def panel(i: Inputs) -> DataFrame:
    return normalize.with_ticker(normalize.with_price(raw_panel(i)))


def simple_panel(i: Inputs) -> DataFrame:
    return normalize.simple_dialect(panel(i))


def global_links(i: Inputs) -> DataFrame:
    return i.view("names_global").withColumn("datadate", date_or_null("datadate_raw"))


def company_names(i: Inputs) -> DataFrame:
    return names.company_names(i.view("names_usa"), global_links(i))


def flagged(i: Inputs) -> DataFrame:
    """The flagged-events file with names; its date is text."""
    return names.attach_names(i.view("flagged"), company_names(i))


def flagged_dated(i: Inputs) -> DataFrame:
    return flagged(i).withColumn("event_date", date_or_null("event_date"))


def verdicts(i: Inputs) -> DataFrame:
    return i.view("verdicts")


def acquisitions(i: Inputs) -> DataFrame:
    return workflows.clean_acquisitions(verdicts(i))


def acquisition_labels(i: Inputs) -> DataFrame:
    return workflows.label_from_acquisitions(panel(i), verdicts(i)).select(
        "gvkey", "iid", "date", "year", "is_acquired", "acquisition_date",
        F.col("days_to_acquisition").cast("double"), "acquirer", "acquisition_price", "event_type_verified",
    )


def window_labels(i: Inputs) -> DataFrame:
    return workflows.label_from_verdicts(panel(i), verdicts(i)).select(
        "gvkey", "iid", "date", "event_label", "event_date", "event_confidence", "event_details"
    )


def parsed_answers(i: Inputs) -> DataFrame:
    return verify.verdicts_from_answers(i.view("responses"))


def priced(i: Inputs) -> DataFrame:
    return verify.with_cost(i.view("responses"))


def _verified_as_text(df: DataFrame) -> DataFrame:
    """An optional flag as text, as the events file has it."""
    return df.withColumn("verified", F.col("verified").cast("string"))


# Sources and sinks -----------------------------------------------------------------------------

PANEL_COLUMNS = ("gvkey", "iid", "date", "prc", "volume", "stock_ret", "z_score", "f_score", "age")


@query
def scan_panel_parquet(i: Inputs) -> DataFrame:
    path = writers.scratch_folder(i.spark, "panel.parquet")
    rows = i.view("panel").select(*PANEL_COLUMNS)
    rows.write.mode("overwrite").parquet(path)
    return readers.read_parquet(i.spark, path, rows.schema)


@query
def scan_panel_csv(i: Inputs) -> DataFrame:
    path = writers.scratch_folder(i.spark, "panel.csv")
    rows = i.view("panel").select(*PANEL_COLUMNS)
    rows.write.mode("overwrite").options(**readers.CSV_OPTIONS).csv(path)
    return readers.read_csv(i.spark, path, rows.schema)


@query
def scan_dispatch(i: Inputs) -> DataFrame:
    """Parquet by its extension, and a CSV copy of it by its own."""
    orders = readers.read_table(i.spark, f"{i.folder}/orders.parquet")
    orders = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    path = writers.scratch_folder(i.spark, "orders.csv")
    writers.write_events_csv(orders, path)
    copied = readers.read_table(i.spark, path, orders.schema)
    return orders.withColumn("kind", F.lit("parquet")).unionByName(copied.withColumn("kind", F.lit("csv")))


@query
def distinct_keys(i: Inputs) -> DataFrame:
    return readers.distinct_keys(raw_panel(i))


@query
def scan_by_key_list(i: Inputs) -> DataFrame:
    """A literal list of firms."""
    return readers.rows_of_keys(raw_panel(i), [4, 7, 15, 22]).select("gvkey", "iid", "date", "prc")


@query
def scan_by_keys(i: Inputs) -> DataFrame:
    wanted = readers.distinct_keys(acquisitions(i))
    return readers.rows_of_keys(raw_panel(i), wanted).select("gvkey", "iid", "date", "prc", "volume")


@query
def sink_events_csv(i: Inputs) -> DataFrame:
    found = detectors.detect_single_pass(panel(i), company_names(i), **SINGLE)
    path = writers.scratch_folder(i.spark, "events.csv")
    writers.write_events_csv(found, path)
    return readers.read_table(i.spark, path, found.schema, free_text=True)


@query
def sink_labeled_parquet(i: Inputs) -> DataFrame:
    path = writers.scratch_folder(i.spark, "labeled.parquet")
    writers.write_labeled_parquet(acquisition_labels(i), path)
    return readers.read_parquet(i.spark, path).select(
        "gvkey", "date", "year", "is_acquired", "acquisition_date", "days_to_acquisition", "acquirer"
    )


@query
def sink_label_summary_json(i: Inputs) -> DataFrame:
    path = writers.scratch_folder(i.spark, "summary.json")
    summary = label.label_summary(acquisition_labels(i))
    writers.write_summary_json(summary, path)
    return i.spark.read.schema(summary.schema).json(path)


@query
def summary_report(i: Inputs) -> DataFrame:
    detected = detectors.detect_single_pass(panel(i), company_names(i), **SINGLE)
    checked = workflows.verify_queue(flagged_dated(i), i.view("responses"), BATCH)
    return workflows.summary_report(panel(i), detected, checked, window_labels(i))


@query
def full_run(i: Inputs) -> DataFrame:
    """Detection at 5/5/5, verdicts, labels and the four outputs; their row counts join the report."""
    first = i.view("responses").groupBy("gvkey").agg(F.min_by(F.struct("response_text", "error_text"), "seq").alias("a"))
    given = first.select("gvkey", "a.*")
    folder = writers.scratch_folder(i.spark, "run")
    outputs = workflows.full_run(panel(i), company_names(i), given, folder)
    lines = [
        outputs[name].agg(
            F.lit("export").alias("section"), F.lit("rows").alias("metric"), F.lit(name).alias("key"),
            F.count(F.lit(1)).cast("string").alias("value"),
        )
        for name in ("detected", "verified", "labeled")
    ]
    fields = F.split("value", "\t")
    text = i.spark.read.text(f"{folder}/summary_report.txt")
    report = text.select(*[F.nullif(F.get(fields, F.lit(k)), F.lit("")).alias(c) for k, c in enumerate(workflows.REPORT)])
    return report.unionByName(lines[0]).unionByName(lines[1]).unionByName(lines[2])


# Projections and filters -----------------------------------------------------------------------


@query
def make_ticker(i: Inputs) -> DataFrame:
    return normalize.with_ticker(raw_panel(i)).select("gvkey", "iid", "date", "ticker")


def _dated_numbers(i: Inputs) -> DataFrame:
    number = (F.col("year") * 10000 + F.col("month") * 100 + 1).cast("double")
    return raw_panel(i).select("gvkey", "iid", number.alias("raw"))


@query
def parse_yyyymmdd(i: Inputs) -> DataFrame:
    return _dated_numbers(i).withColumn("date", yyyymmdd("raw"))


@query
def parse_yyyymmdd_coerce(i: Inputs) -> DataFrame:
    spoiled = F.when(F.col("gvkey") % 7 == 0, F.col("raw") + 90).otherwise(F.col("raw"))
    return _dated_numbers(i).withColumn("raw", spoiled).withColumn("date", yyyymmdd_or_null("raw"))


@query
def parse_date_coerce(i: Inputs) -> DataFrame:
    return i.view("names_global").select("gvkey", "seq", "datadate_raw", date_or_null("datadate_raw").alias("datadate"))


@query
def resolve_price(i: Inputs) -> DataFrame:
    return normalize.with_price(raw_panel(i)).select("gvkey", "iid", "date", "price")


@query
def volume_proxy(i: Inputs) -> DataFrame:
    return normalize.with_volume(raw_panel(i).drop("volume")).select("gvkey", "iid", "date", "volume")


@query
def normalize_panel(i: Inputs) -> DataFrame:
    """The whole normalising step on a raw panel: numeric dates, no price, no volume."""
    raw = raw_panel(i).drop("prc", "volume")
    number = (F.col("year") * 10000 + F.col("month") * 100 + 1).cast("double")
    return normalize.normalize(raw.withColumn("date", number))


@query
def project_essential(i: Inputs) -> DataFrame:
    return normalize.essential_first(panel(i).drop("prc"))


@query
def pad_event_schema(i: Inputs) -> DataFrame:
    return ev.event_rows(detectors.detect_split_simple(panel(i))).withColumn("gvkey", F.col("gvkey").cast("double"))


def _firms_with_names(i: Inputs) -> DataFrame:
    return names.attach_names(readers.distinct_keys(raw_panel(i)), company_names(i))


@query
def filter_has_name(i: Inputs) -> DataFrame:
    return _firms_with_names(i).withColumn("named", F.coalesce(has_name(), F.lit(False)))


@query
def filter_min_history(i: Inputs) -> DataFrame:
    return ev.min_history(raw_panel(i), 24)


@query
def filter_verified_acquisitions(i: Inputs) -> DataFrame:
    return ev.verified_acquisitions(verdicts(i)).select("seq", "gvkey", "actual_date", "acquirer", "acquisition_price")


@query
def filter_event_year(i: Inputs) -> DataFrame:
    dated = verdicts(i).withColumn("event_date", date_or_null("detected_date_raw"))
    return ev.in_year(dated, YEAR, F.col("event_date")).select("seq", "gvkey", "event_date")


@query
def filter_label_confidence(i: Inputs) -> DataFrame:
    return ev.confident_verdicts(verdicts(i), "medium").select("seq", "gvkey", "llm_confidence")


@query
def ensure_columns(i: Inputs) -> DataFrame:
    return _verified_as_text(ev.ensure_columns(i.view("flagged"), ev.VERDICT_SCHEMA))


@query
def project_acquisition_fields(i: Inputs) -> DataFrame:
    return label.acquisition_fields(ev.verified_acquisitions(verdicts(i)))


@query
def skip_unnamed_rows(i: Inputs) -> DataFrame:
    return verify.skipped_rows(flagged_dated(i))


# Joins -----------------------------------------------------------------------------------------


@query
def company_name_mapping(i: Inputs) -> DataFrame:
    return company_names(i)


@query
def attach_company_name(i: Inputs) -> DataFrame:
    return _firms_with_names(i)


@query
def label_event_windows(i: Inputs) -> DataFrame:
    """Windows of all verdicts, with a halt end for half of the halts."""
    known = label.label_events(verdicts(i))
    end = F.when(F.col("seq") % 2 == 0, F.date_add("event_date", 200))
    return label.label_windows(panel(i), known.withColumn("halt_end_date", end)).select(
        "gvkey", "iid", "date", "event_label", "event_date", "event_confidence", "event_details"
    )


@query
def label_acquisitions(i: Inputs) -> DataFrame:
    return acquisition_labels(i)


@query
def match_counts(i: Inputs) -> DataFrame:
    return label.match_counts(raw_panel(i), acquisitions(i))


@query
def upsert_verdicts(i: Inputs) -> DataFrame:
    """Verdicts with a date written onto all flagged events, over older values."""
    old = flagged(i).withColumn("actual_date", F.lit("1990-01-01")).withColumn("details", F.lit("old"))
    return _verified_as_text(verify.upsert_verdicts(old, parsed_answers(i).where(F.col("verified"))))


@query
def broadcast_global_stats(i: Inputs) -> DataFrame:
    rows = panel(i)
    firms = rows.groupBy("gvkey").agg(F.max("date").alias("last_date"))
    return firms.withColumns(
        {
            "dataset_start": dataset_start(rows),
            "dataset_end": dataset_end(rows),
            "spread_p85": global_quantile_of(rows, "bidaskhl_21d", 0.85),
        }
    ).withColumn("days_since", F.datediff("dataset_end", "last_date"))


# Aggregations ----------------------------------------------------------------------------------


@query
def dataset_bounds_(i: Inputs) -> DataFrame:
    return dataset_bounds(raw_panel(i))


@query
def feature_coverage(i: Inputs) -> DataFrame:
    return profile.feature_coverage(raw_panel(i))


@query
def sample_statistics(i: Inputs) -> DataFrame:
    return profile.sample_statistics(panel(i).drop("prc"))


@query
def missing_patterns(i: Inputs) -> DataFrame:
    return profile.missing_patterns(panel(i), AS_OF)


@query
def missing_pattern_summary(i: Inputs) -> DataFrame:
    return profile.pattern_summary(profile.missing_patterns(panel(i), AS_OF))


@query
def value_counts(i: Inputs) -> DataFrame:
    return ev.value_counts(verdicts(i), ["actual_event_type", "llm_confidence", "verified"])


MEDIANS = ("ami_126d", "turnover_126d", "dolvol_126d", "bidaskhl_21d")


@query
def firm_median(i: Inputs) -> DataFrame:
    return group_quantiles(panel(i), "gvkey", MEDIANS, 0.5).select("gvkey", *MEDIANS)


@query
def global_quantile(i: Inputs) -> DataFrame:
    return column_quantile(panel(i), "bidaskhl_21d", 0.85)


@query
def verification_summary(i: Inputs) -> DataFrame:
    return verify.verdict_summary(workflows.verify_queue(flagged_dated(i), i.view("responses"), BATCH))


@query
def year_summary(i: Inputs) -> DataFrame:
    return workflows.reverified_year_summary(reverified(i), YEAR)


@query
def label_distribution(i: Inputs) -> DataFrame:
    return label.label_distribution(window_labels(i))


@query
def acquisition_label_summary(i: Inputs) -> DataFrame:
    return label.label_summary(acquisition_labels(i)).drop("filters_applied")


@query
def acquisition_labels_by_year(i: Inputs) -> DataFrame:
    return label.positives_by_year(acquisition_labels(i))


@query
def acquisitions_by_year(i: Inputs) -> DataFrame:
    return label.events_by_year(acquisitions(i))


@query
def multi_label_firms(i: Inputs) -> DataFrame:
    return label.multi_label_firms(acquisition_labels(i))


@query
def dedup_events(i: Inputs) -> DataFrame:
    return label.dedup_events(ev.verified_acquisitions(verdicts(i))).select("seq", "gvkey", "actual_date", "acquirer")


@query
def verification_cost_estimate(i: Inputs) -> DataFrame:
    return verify.cost_estimate(flagged(i), BATCH)


@query
def usage_stats(i: Inputs) -> DataFrame:
    return verify.usage_stats(priced(i))


# Windows ---------------------------------------------------------------------------------------


@query
def date_gaps(i: Inputs) -> DataFrame:
    rows = ordered.with_previous(raw_panel(i).select("gvkey", "iid", "date"), ["date"])
    return rows.select("gvkey", "iid", "date", F.datediff("date", "prev.date").cast("double").alias("gap_days"))


@query
def pct_change(i: Inputs) -> DataFrame:
    rows = ordered.with_previous(panel(i).select("gvkey", "iid", "date", "price"), ["price"])
    change = detectors.return_on_previous(F.col("price"), F.col("prev.price"))
    return rows.select("gvkey", "iid", "date", change.alias("change"))


@query
def tail_n(i: Inputs) -> DataFrame:
    return ordered.last_rows(panel(i).select("gvkey", "iid", "date", "price"), 24)


@query
def last_and_nth_last(i: Inputs) -> DataFrame:
    features = firm_features(panel(i), Features(last=("z_score", "f_score")))
    return features.select(
        "gvkey", "last_date", "last_price", "tail_first_price", "price_change", "z_score_last", "f_score_last"
    )


@query
def trailing_mean(i: Inputs) -> DataFrame:
    wanted = Features(recent={"dolvol_126d": (6, 12), "bidaskhl_21d": (6,), "eqnpo_me": (5,)})
    return firm_features(panel(i), wanted).select(
        "gvkey", "dolvol_126d_m6", "dolvol_126d_m12", "bidaskhl_21d_m6", "eqnpo_me_m5"
    )


@query
def mean_excluding_last_k(i: Inputs) -> DataFrame:
    features = firm_features(panel(i), Features(before_last={"eqnpo_me": 5}))
    return features.select("gvkey", "eqnpo_me_recent", "eqnpo_me_rest", "eqnpo_me_rises")


@query
def price_index_from_returns(i: Inputs) -> DataFrame:
    rows = panel(i).select("ticker", "date", "stock_ret")
    return normalize.with_price_index(rows, "price")


@query
def consecutive_gap_islands(i: Inputs) -> DataFrame:
    return detectors.halt_islands(panel(i))


@query
def rank_best_event(i: Inputs) -> DataFrame:
    """Best of all verdict events of a firm, bankruptcy before merger before the rest."""
    kind = F.col("actual_event_type")
    priority = F.when(kind == "bankruptcy", 1).when(kind.isin("merger", "acquisition"), 2).otherwise(3)
    score = (F.col("seq") % 50).cast("int")
    candidates = label.label_events(verdicts(i)).select(
        "gvkey", kind.alias("event_type"), "event_date", score.alias("detection_score"),
        F.col("details").alias("reasons"), priority.alias("priority"),
    )
    return ev.best_events(candidates)


@query
def budget_admission(i: Inputs) -> DataFrame:
    return verify.admit_within_budget(priced(i), BUDGET).select("seq", "cost", "spent_before", "admitted", "percent_used")


@query
def stop_after_error(i: Inputs) -> DataFrame:
    return verify.before_stop(parsed_answers(i)).select("seq", "gvkey", "actual_event_type")


@query
def first_row_value(i: Inputs) -> DataFrame:
    return detectors.first_row_values(panel(i), ["age", "price"])


@query
def prev_row_value(i: Inputs) -> DataFrame:
    rows = ordered.with_previous(panel(i).select("gvkey", "iid", "date", "price", "volume"), ["price", "volume"])
    return rows.select(
        "gvkey", "iid", "date", F.col("prev.price").alias("prev_price"), F.col("prev.volume").alias("prev_volume")
    )


# Sorts and limits ------------------------------------------------------------------------------


@query
def sort_panel(i: Inputs) -> DataFrame:
    return ordered.in_order(raw_panel(i).select("gvkey", "iid", "date", "prc"))


@query
def verification_queue(i: Inputs) -> DataFrame:
    return verify.verification_queue(flagged_dated(i), BATCH)


@query
def resume_offset(i: Inputs) -> DataFrame:
    return verify.resume_after(flagged(i).where(has_name()), 613).select("seq", "gvkey", "company_name")


@query
def sample_head(i: Inputs) -> DataFrame:
    return acquisitions(i).orderBy("seq").limit(10)


# Set operations --------------------------------------------------------------------------------


@query
def union_detections(i: Inputs) -> DataFrame:
    return detectors.union_detections(panel(i), company_names(i))


@query
def union_skipped_and_verified(i: Inputs) -> DataFrame:
    return workflows.verify_queue(flagged_dated(i), i.view("responses"), None)


@query
def names_except(i: Inputs) -> DataFrame:
    primary = names.latest_names(i.view("names_usa"))
    return names.secondary_only(primary, names.latest_names(names.usable_links(global_links(i))))


# Detectors -------------------------------------------------------------------------------------


@query
def detect_bankruptcy(i: Inputs) -> DataFrame:
    return detectors.detect_bankruptcy(panel(i), company_names(i))


@query
def detect_merger(i: Inputs) -> DataFrame:
    return detectors.detect_merger(panel(i), company_names(i))


@query
def detect_halt(i: Inputs) -> DataFrame:
    return detectors.detect_halt(panel(i), company_names(i))


@query
def detect_ipo(i: Inputs) -> DataFrame:
    return detectors.detect_ipo(panel(i), company_names(i))


@query
def detect_stock_split(i: Inputs) -> DataFrame:
    return detectors.detect_stock_split(panel(i), company_names(i))


@query
def detect_data_errors(i: Inputs) -> DataFrame:
    return detectors.detect_data_errors(panel(i), company_names(i))


@query
def detect_all_events(i: Inputs) -> DataFrame:
    return detectors.detect_all(panel(i), company_names(i))


@query
def score_bankruptcy_single(i: Inputs) -> DataFrame:
    scores = detectors.single_pass_scores(panel(i))
    return scores.select("gvkey", "n_rows", "last_date", "bankruptcy_score", "bankruptcy_reasons")


@query
def score_merger_single(i: Inputs) -> DataFrame:
    return detectors.single_pass_scores(panel(i)).select("gvkey", "n_rows", "last_date", "merger_score", "merger_reasons")


@query
def score_halt_single(i: Inputs) -> DataFrame:
    return detectors.score_single_halts(panel(i))


@query
def confidence_band_(i: Inputs) -> DataFrame:
    score = (F.col("seq") % 90).cast("int")
    return verdicts(i).select(
        "seq", score.alias("score"), "actual_event_type",
        confidence_band(score, F.col("actual_event_type")).alias("confidence"),
    )


@query
def detect_single_pass(i: Inputs) -> DataFrame:
    return detectors.detect_single_pass(panel(i), company_names(i), **SINGLE)


@query
def detect_bankruptcy_simple(i: Inputs) -> DataFrame:
    return detectors.detect_bankruptcy_simple(simple_panel(i), AS_OF)


@query
def detect_merger_simple(i: Inputs) -> DataFrame:
    return detectors.detect_merger_simple(normalize.simple_dialect(panel(i)), AS_OF)


@query
def detect_halt_simple(i: Inputs) -> DataFrame:
    return detectors.detect_halt_simple(simple_panel(i))


@query
def detect_ipo_simple(i: Inputs) -> DataFrame:
    return detectors.detect_ipo_simple(simple_panel(i))


@query
def detect_split_simple(i: Inputs) -> DataFrame:
    return detectors.detect_split_simple(simple_panel(i))


@query
def detect_data_errors_simple(i: Inputs) -> DataFrame:
    return detectors.detect_data_errors_simple(simple_panel(i))


# Verification ----------------------------------------------------------------------------------


@query
def build_prompts(i: Inputs) -> DataFrame:
    return flagged_dated(i).select("seq", verify.request_text().alias("prompt"))


@query
def build_prompts_year(i: Inputs) -> DataFrame:
    return flagged_dated(i).select("seq", verify.request_text_for_year(YEAR).alias("prompt"))


@query
def extract_json_fenced(i: Inputs) -> DataFrame:
    return i.view("responses").select("seq", answers.fenced_json(F.col("response_text")).alias("json"))


@query
def extract_json_balanced(i: Inputs) -> DataFrame:
    return i.view("responses").select("seq", answers.balanced_json(F.col("response_text")).alias("json"))


@query
def parse_verdict(i: Inputs) -> DataFrame:
    verdict = answers.parse_verdict(answers.balanced_json(F.col("response_text")))
    return _verified_as_text(i.view("responses").select("seq", verdict.alias("v")).select("seq", "v.*"))


@query
def null_token_dates(i: Inputs) -> DataFrame:
    verdict = answers.parse_verdict(answers.balanced_json(F.col("response_text")))
    rows = i.view("responses").select("seq", verdict["actual_date"].alias("raw"))
    return rows.withColumn("actual_date", answers.null_if_no_date(F.col("raw")))


@query
def verdict_errors(i: Inputs) -> DataFrame:
    return parsed_answers(i).select("seq", "failed", "stop", "verified", "actual_event_type", "llm_confidence", "details")


@query
def verdict_metadata(i: Inputs) -> DataFrame:
    return verify.with_metadata(parsed_answers(i), flagged_dated(i)).select(
        "seq", "gvkey", "company_name", "verified", "detected_event_type", "detected_date", "llm_response"
    )


@query
def request_cost(i: Inputs) -> DataFrame:
    other = answers.request_cost(F.col("prompt"), F.col("response_text"), "another-model")
    return priced(i).select(
        "seq",
        answers.tokens(F.col("prompt")).alias("input_tokens"),
        answers.tokens(F.col("response_text")).alias("output_tokens"),
        (F.col("cost") * 1000000).alias("micro_dollars"),
        other.alias("other_model_cost"),
    )


def reverified(i: Inputs) -> DataFrame:
    return workflows.reverify_year(flagged(i), i.view("responses"), YEAR, RESUME_FROM, BUDGET)


@query
def reverify_year(i: Inputs) -> DataFrame:
    return _verified_as_text(reverified(i))


@query
def verify_queue(i: Inputs) -> DataFrame:
    return workflows.verify_queue(flagged_dated(i), i.view("responses"), BATCH)


@query
def label_from_verdicts(i: Inputs) -> DataFrame:
    return window_labels(i)


@query
def label_from_acquisitions(i: Inputs) -> DataFrame:
    """The whole acquisition run: filter, parse, first per firm and date, label."""
    return acquisition_labels(i)
