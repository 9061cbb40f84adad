"""How often the plans read the given tables, and what they must not contain."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from panelwatch.plans import detectors, workflows

FOLDER = "/root/testdata/sf0.001"

#: Most scans of the given tables in a plan; a shared stage is read once.  Quantiles and prior sums read them once more, when they
#: write their ranges or cells.
MOST_SCANS = {
    "global_quantile": 0,
    "firm_median": 0,
    "budget_admission": 1,
    "detect_bankruptcy": 5,
    "detect_merger": 5,
    "detect_all_events": 5,
    "union_detections": 8,
    "reverify_year": 8,
}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(MOST_SCANS))
def test_scans(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that shared stages show before the run
    try:
        plan = driver.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    found = len(re.findall(rf"FileScan parquet.*Location: [^\[]*\[file:{FOLDER}", plan))
    assert found <= MOST_SCANS[name], found
    assert "percentile_approx" not in plan
    assert "CartesianProduct" not in plan and "Python" not in plan


def counted_panel(spark):
    """240 rows of 4 firms whose key adds to the counter each time it is made."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def key(i):
        made.add(1)
        return i % 4

    rows = spark.range(0, 240, 1, 4).withColumn("gvkey", key("id")).withColumn("iid", F.lit(1)).withColumn("ticker", F.col("gvkey").cast("string"))
    price = F.col("id") % 7 + F.when(F.col("id") > 200, 400.0).otherwise(1.0)
    rows = rows.withColumns({"date": F.expr("add_months(DATE'2000-01-01', int(id / 4))"), "price": price, "volume": F.lit(5.0)})
    features = ("z_score", "dolvol_126d", "turnover_126d", "ami_126d", "bidaskhl_21d", "ni_be", "age")
    return rows.drop("id").withColumns({c: F.col("price") / (n + 2) for n, c in enumerate(features)}), made


def test_the_panel_is_made_once_for_all_detectors(spark):
    panel, made = counted_panel(spark)
    names = spark.createDataFrame([(0, "A"), (1, "B")], "gvkey long, company_name string")
    assert detectors.union_detections(panel, names).count() > 0
    assert made.value == 240


def test_the_panel_is_made_once_for_a_full_run(spark, tmp_path):
    panel, made = counted_panel(spark)
    names = spark.createDataFrame([(0, "A"), (1, "B")], "gvkey long, company_name string")
    answers = spark.createDataFrame([(0, "{}", None)], "gvkey long, response_text string, error_text string")
    outputs = workflows.full_run(panel, names, answers, str(tmp_path))
    assert outputs["labeled"].count() == 240 and outputs["detected"].count() > 0
    assert made.value == 240
