"""CSV rows that do not fit their schema, and panels laid out by firm."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from panelwatch.operators import events, ordered
from panelwatch.plans import workflows
from panelwatch.sources import readers, writers

SCHEMA = "gvkey long, prc double, name string"
GOOD = [(1, 1.5, "a"), (5, None, 'x "y"'), (6, 2.0, None)]
LINES = ["gvkey,prc,name", "1,1.5,a", "2,abc,b", "3", "4,1.0,d,9", '5,,"x ""y"""', "6,2.0,"]


@pytest.fixture
def bad_file(tmp_path):
    path = tmp_path / "PANEL.CSV"
    path.write_text("\n".join(LINES) + "\n")
    return str(path)


def test_bad_rows_stop_a_scan(spark, bad_file, tmp_path):
    """Too few or too many fields stop any scan, text in a number the scans that read the number."""
    scan = readers.read_table(spark, bad_file, SCHEMA)
    for read in (scan, scan.select("gvkey"), scan.select("name")):
        with pytest.raises(Exception, match="(?i)malformed"):
            read.collect()
    for line, columns in ((LINES[2], ["gvkey", "prc"]), (LINES[3], ["gvkey"]), (LINES[4], ["gvkey"])):
        path = tmp_path / f"one{line[0]}.csv"
        path.write_text(f"{LINES[0]}\n{LINES[1]}\n{line}\n")
        with pytest.raises(Exception, match="(?i)malformed"):
            readers.read_csv(spark, str(path), SCHEMA).select(*columns).collect()
    with pytest.raises(ValueError):
        readers.read_csv(spark, bad_file, SCHEMA, bad_rows="skip")


def test_bad_rows_set_apart_with_their_text(spark, bad_file):
    good, bad = readers.read_csv_apart(spark, bad_file, SCHEMA)
    assert good.columns == ["gvkey", "prc", "name"] and rows(good, "gvkey") == GOOD and good.count() == 3
    assert bad.count() == 3 and sorted(r.bad_row for r in bad.select("bad_row").collect()) == LINES[2:5]
    assert rows(bad.select("gvkey", "prc"), "gvkey") == [(2, None), (3, None), (4, 1.0)]
    with pytest.raises(ValueError):
        readers.read_csv_apart(spark, bad_file, "gvkey long, bad_row string")


def test_bad_fields_as_null_where_asked(spark, bad_file):
    assert rows(readers.read_csv(spark, bad_file, SCHEMA, bad_rows="null").select("gvkey", "prc"), "gvkey") == [(1, 1.5), (2, None), (3, None), (4, 1.0), (5, None), (6, 2.0)]


def test_extensions_in_capitals(spark, tmp_path):
    path = str(tmp_path / "Panel.PARQUET")
    spark.range(3).write.parquet(path)
    assert readers.read_table(spark, path).count() == 3


def firm_table(spark, tmp_path, name):
    panel = spark.range(4000).selectExpr("id % 97 AS gvkey", "1 AS iid", "date_add(DATE'2000-01-01', int(id DIV 97)) AS date", "double(id) AS price")
    path = str(tmp_path / name)
    writers.write_firm_table(panel, name, path, buckets=16)
    return panel, path


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_key_list_reads_its_buckets_alone(spark, tmp_path):
    panel, _ = firm_table(spark, tmp_path, "panel_by_firm")
    table = readers.read_firm_table(spark, "panel_by_firm")
    some = readers.rows_of_keys(table, [4, 7])
    assert rows(some) == rows(panel.where("gvkey IN (4, 7)"))
    assert "SelectedBucketsCount: 2 out of 16" in plan_of(ordered.last_rows(some, 3))
    assert some.select(F.input_file_name()).distinct().count() == 2
    assert rows(table) == rows(panel)


def test_work_by_firm_needs_no_shuffle(spark, tmp_path):
    panel, _ = firm_table(spark, tmp_path, "panel_no_shuffle")
    table = readers.read_firm_table(spark, "panel_no_shuffle")
    tail, history = ordered.last_rows(table, 5), events.min_history(table, 42)
    for found, want in ((tail, ordered.last_rows(panel, 5)), (history, events.min_history(panel, 42))):
        assert "Exchange" not in plan_of(found) and "Exchange" in plan_of(want)
        assert rows(found) == rows(want)


def test_a_table_of_an_earlier_session(spark, tmp_path):
    panel, path = firm_table(spark, tmp_path, "panel_earlier")
    again = readers.read_firm_table(spark, "panel_again", path)
    assert "SelectedBucketsCount: 1 out of 16" in plan_of(events.min_history(again.where(F.col("gvkey") == 4), 1)) and rows(again) == rows(panel)


def test_new_verdicts_rewrite_their_years_alone(spark, tmp_path):
    path = str(tmp_path / "events")
    events_table = spark.range(90).selectExpr("id AS seq", "id % 7 AS gvkey", "CAST(2000 + id % 3 AS INT) AS year")
    events_table = events.ensure_columns(events_table, events.VERDICT_SCHEMA)
    writers.write_labeled_parquet(events_table.withColumn("date", F.lit("2000-01-01")), path)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "events").rglob("*.parquet")}
    fields = {"verified": "true", "actual_event_type": "'merger'", "actual_date": "'2001-02-03'", "llm_confidence": "'high'", "details": "'d'", "acquirer": "'a'", "acquisition_price": "1.0"}
    verdicts = spark.range(1).selectExpr("4L AS seq", *[f"{v} AS {c}" for c, v in fields.items()])
    workflows.upsert_stored(path, verdicts)
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "events").rglob("*.parquet")}
    kept = {f for f in before if "year=2001" not in str(f)}
    assert kept and all(after.get(f) == before[f] for f in kept) and kept == {f for f in after if "year=2001" not in str(f)}
    found = spark.read.parquet(path)
    assert found.count() == 90 and [(r.seq, r.year, r.details) for r in found.where("verified").collect()] == [(4, 2001, "d")]


def test_value_counts_are_grouping_sets(spark):
    df = spark.createDataFrame([("a", True, 1), ("a", None, 2), (None, False, 1), ("b", True, None)], "k string, b boolean, n int")
    found = events.value_counts(df, ["k", "b", "n"])
    assert rows(found) == [("b", "false", 1), ("b", "true", 2), ("k", "a", 2), ("k", "b", 1), ("n", "1", 2), ("n", "2", 1)]
    assert "Generate" not in plan_of(found) and "Expand" in plan_of(found)
