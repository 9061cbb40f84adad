"""What readers and writers share: the folder for intermediate files and the CSV dialect."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder path under the shared folder the cluster names.

    A session that runs in one process may go without that setting and gets a folder in its
    warehouse; on a cluster, a folder of one machine would hide files from the others, so the
    setting is required there.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not in_one_process(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}/{name}"


def in_one_process(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")
