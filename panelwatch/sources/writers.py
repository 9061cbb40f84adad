"""Sinks.  All write folders of part files in parallel; none brings rows to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .folders import CSV_OPTIONS, scratch_folder

__all__ = ["scratch_folder"]


def write_events_csv(events: DataFrame, path: str) -> None:
    events.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_labeled_parquet(labeled: DataFrame, path: str, by: str = "year") -> None:
    """Labelled panel by year, rows in firm and date order so that scans can skip row groups.

    Ranges over (year, firm, date) give each task one stretch of a year: no task opens a file for
    every year, and a large firm is spread over many tasks.
    """
    order = [by, "gvkey", "date"]
    ranged = labeled.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.write.mode("overwrite").partitionBy(by).parquet(path)


def overwrite_partitions(rows: DataFrame, path: str, by: str = "year") -> None:
    """Replace only those partitions of a folder of which there are rows; the files of all others stay as they are."""
    ranged = rows.repartitionByRange(by, "gvkey").sortWithinPartitions(by, "gvkey")
    ranged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def write_firm_table(panel: DataFrame, table: str, path: str, buckets: int = 200, key: str = "gvkey", order: tuple[str, ...] = ("date", "iid")) -> None:
    """A panel as a table bucketed by firm and sorted inside each bucket.

    A key list then reads its buckets alone, and work by firm (last rows, firm features, joins on the firm) needs no shuffle.  A
    firm lies in one bucket, so a firm that holds much of the panel makes one bucket long: lay the panel out plainly
    then.  Rows are dealt to one task per bucket first, so that each bucket is one file.
    """
    by = [key, *order]
    dealt = panel.repartition(buckets, key).sortWithinPartitions(*by)
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(*by).option("path", path).saveAsTable(table)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in panel.schema)
    layout = panel.sparkSession.createDataFrame([(columns, key, ", ".join(by), buckets)], "columns string, key string, order string, buckets int")
    layout.coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}-layout")


def write_labeled_csv(labeled: DataFrame, path: str) -> None:
    labeled.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_summary_json(summary: DataFrame, path: str) -> None:
    summary.write.mode("overwrite").json(path)


def write_report_text(report: DataFrame, path: str) -> None:
    """Report lines in their order; a report has a few dozen lines, so one file is right."""
    line = F.concat_ws("\t", "section", "metric", F.coalesce("key", F.lit("")), "value")
    report.orderBy("section", "metric", "key").select(line.alias("value")).coalesce(1).write.mode("overwrite").text(path)
