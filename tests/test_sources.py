"""Scans, normalisation and sinks."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows
from panelwatch.operators import normalize, profile
from panelwatch.sources import readers, writers

SCHEMA = "gvkey long, iid int, date double, prc double, stock_ret double, excntry string, year int, month int"
TABLE = [
    (1, 1, 19990131.0, 5.0, float("nan"), "USA", 1999, 1),
    (1, 2, 19990228.0, float("nan"), -0.1, "USA", 1999, 2),
]


def test_round_trip_and_dispatch(spark, tmp_path):
    df = spark.createDataFrame(TABLE, SCHEMA)
    parquet, csv = str(tmp_path / "p.parquet"), str(tmp_path / "p.csv")
    df.write.parquet(parquet)
    readers.nan_as_null(df).write.options(**readers.CSV_OPTIONS).csv(csv)
    want = rows(readers.nan_as_null(df))
    assert want[0][4] is None and want[1][3] is None
    assert rows(readers.read_table(spark, parquet)) == want
    assert rows(readers.read_table(spark, csv, df.schema)) == want
    with pytest.raises(ValueError):
        readers.read_table(spark, str(tmp_path / "p.xlsx"))
    with pytest.raises(ValueError):
        readers.read_table(spark, csv)


def test_csv_keeps_quotes_blanks_and_line_breaks(spark, tmp_path):
    path = str(tmp_path / "e.csv")
    table = [(1, 'say "hi", twice'), (2, "  "), (3, "two\nlines"), (4, None), (5, "back\\slash")]
    df = spark.createDataFrame(table, "k int, t string")
    writers.write_events_csv(df, path)
    assert rows(readers.read_csv(spark, path, df.schema, free_text=True)) == table


def test_key_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "p.parquet")
    spark.createDataFrame(TABLE, SCHEMA).write.parquet(path)
    some = readers.rows_of_keys(readers.read_parquet(spark, path), [1]).select("gvkey")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(gvkey,1)" in plan or "In(gvkey, [1])" in plan
    assert "ReadSchema: struct<gvkey:bigint>" in plan
    keys = spark.createDataFrame([(2,)], "gvkey long")
    assert readers.rows_of_keys(readers.read_parquet(spark, path), keys).count() == 0


def test_normalize(spark):
    got = normalize.normalize(spark.createDataFrame(TABLE, SCHEMA).withColumn("z_score", F.lit(1.0)))
    assert got.columns == [*normalize.ESSENTIAL, "prc", "z_score"]
    assert rows(got.select("ticker", "date", "price", "volume")) == [
        ("1_1", date(1999, 1, 31), 5.0, None),
        ("1_2", date(1999, 2, 28), None, 100000.0),
    ]


def test_price_and_volume_fall_back(spark):
    df = spark.createDataFrame([("a", date(2000, 1, 1), 0.1), ("a", date(2000, 2, 1), None), ("a", date(2000, 3, 1), -1.0),
                                ("a", date(2000, 4, 1), 0.5)], "ticker string, date date, stock_ret double")
    prices = [r[0] for r in normalize.with_price(df).orderBy("date").select("price").collect()]
    assert prices == [pytest.approx(110.0), None, pytest.approx(0.0), pytest.approx(0.0)]
    bare = df.drop("stock_ret")
    assert "price" not in normalize.with_price(bare).columns
    assert rows(normalize.with_volume(bare).select("volume").distinct()) == [(1000000.0,)]
    assert normalize.with_price(df.withColumn("price", F.lit(7.0))).select("price").distinct().count() == 1


def test_missing_columns_are_reported(spark):
    df = spark.createDataFrame(TABLE, SCHEMA)
    with pytest.raises(ValueError, match="excntry"):
        normalize.normalize(df.drop("excntry"))
    with pytest.raises(ValueError, match="date"):
        normalize.normalize(df.drop("date"))
    char = normalize.with_date(df.withColumnRenamed("date", "char_date"))
    assert rows(char.select("date")) == [(date(1999, 1, 31),), (date(1999, 2, 28),)]


def test_strict_dates_fail_and_lenient_ones_do_not(spark):
    df = spark.createDataFrame([(19991331.0,)], "date double")
    with pytest.raises(Exception):
        normalize.with_date(df).collect()
    assert rows(normalize.with_date(df, strict=False)) == [(None,)]


class Settings:
    """Stands in for a session with given settings."""

    def __init__(self, master, **settings):
        self.conf = self.sparkContext = self
        self.master = master
        self.settings = settings

    def get(self, name, default=None):
        return self.settings.get(name, default)

    def getCheckpointDir(self):
        return None


def test_scratch_folder_follows_the_cluster_setting():
    shared = Settings("yarn", **{"spark.checkpoint.dir": "hdfs://shared/scratch/"})
    path = writers.scratch_folder(shared, "x.csv")
    assert path.startswith("hdfs://shared/scratch/") and path.endswith("/x.csv")
    assert path != writers.scratch_folder(shared, "x.csv")
    with pytest.raises(ValueError):
        writers.scratch_folder(Settings("yarn"), "x")
    local = Settings("local[2]", **{"spark.sql.warehouse.dir": "file:/w"})
    assert writers.scratch_folder(local, "x").startswith("file:/w/scratch/")


def test_a_large_csv_is_split_among_tasks(spark, tmp_path):
    path = str(tmp_path / "big.csv")
    spark.range(200_000).withColumn("t", F.lit("text")).coalesce(1).write.options(**readers.CSV_OPTIONS).csv(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        df = readers.read_csv(spark, path, "id long, t string")
        assert df.rdd.getNumPartitions() > 3 and df.count() == 200_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_camel_case_spelling_of_features(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "Ami126D double, ZScore double")
    found = {r.feature: r.column_name for r in profile.feature_coverage(df).collect() if r.available}
    assert found == {"ami_126d": "Ami126D", "z_score": "ZScore"}


def test_labeled_parquet_is_sorted_by_firm_inside_a_year(spark, tmp_path):
    path = str(tmp_path / "l")
    table = [(y, g, date(y, 1, 1 + m)) for y in (1999, 2000) for g in range(20) for m in range(5)]
    df = spark.createDataFrame(table, "year int, gvkey long, date date").repartition(7)
    writers.write_labeled_parquet(df, path)
    back = spark.read.parquet(path)
    assert rows(back.select("year", "gvkey", "date")) == sorted(table, key=str)
    files = [p for p in (tmp_path / "l").glob("year=*/*.parquet")]
    assert len(files) <= 2 * 4


def test_report_and_labels_as_text(spark, tmp_path):
    report = spark.createDataFrame(
        [("labels", "rows", "none", "5"), ("dataset", "total_stocks", None, "2")],
        "section string, metric string, key string, value string",
    )
    writers.write_report_text(report, str(tmp_path / "r"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "r")).collect()] == ["dataset\ttotal_stocks\t\t2", "labels\trows\tnone\t5"]
    labeled = spark.createDataFrame([(1, date(2000, 1, 1), None)], "gvkey long, date date, acquirer string")
    writers.write_labeled_csv(labeled, str(tmp_path / "c"))
    assert rows(readers.read_csv(spark, str(tmp_path / "c"), labeled.schema)) == [(1, date(2000, 1, 1), None)]
