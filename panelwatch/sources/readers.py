"""Scans.  Schemas are given, not inferred, so a scan reads each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import nan_as_null
from .folders import CSV_OPTIONS, scratch_folder

def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return nan_as_null(reader.parquet(path))


def _csv(spark: SparkSession, path: str, schema: T.StructType, free_text: bool, **options) -> DataFrame:
    # Without column pruning the fields of a row are counted, whichever columns a query reads.
    return spark.read.schema(schema).options(**CSV_OPTIONS, multiLine=free_text, columnPruning=False, **options).csv(path)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, free_text: bool = False, bad_rows: str = "fail"
) -> DataFrame:
    """A file is split among tasks, unless ``free_text`` says that quoted values may hold line feeds.

    A row with too few or too many fields stops the query, and so does text in a number that it reads.  With ``bad_rows`` = "null" such fields
    become NULL and surplus ones go; :func:`read_csv_apart` sets such rows apart instead.
    """
    if bad_rows not in ("fail", "null"):
        raise ValueError(f"bad_rows is 'fail' or 'null', not {bad_rows!r}")
    return nan_as_null(_csv(spark, path, schema, free_text, mode="FAILFAST" if bad_rows == "fail" else "PERMISSIVE"))


def read_csv_apart(
    spark: SparkSession, path: str, schema: T.StructType | str, free_text: bool = False, bad_column: str = "bad_row"
) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with their text in ``bad_column`` and what could be read of them).

    The file is parsed once, into a table in the shared folder that both results read.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if bad_column in fields.names:
        raise ValueError(f"the file has a column {bad_column}; name another one")
    extended = T.StructType([*fields, T.StructField(bad_column, T.StringType())])
    path_of_parsed = scratch_folder(spark, "parsed.parquet")
    _csv(spark, path, extended, free_text, mode="PERMISSIVE", columnNameOfCorruptRecord=bad_column).write.parquet(path_of_parsed)
    parsed = read_parquet(spark, path_of_parsed, extended)
    return parsed.where(F.col(bad_column).isNull()).drop(bad_column), parsed.where(F.col(bad_column).isNotNull())


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, free_text: bool = False
) -> DataFrame:
    """Choose the reader by the file extension, in capitals or not."""
    kind = path.lower().rstrip("/")
    if kind.endswith(".parquet"):
        return read_parquet(spark, path, schema)
    if kind.endswith(".csv"):
        if schema is None:
            raise ValueError("a CSV scan needs a schema")
        return read_csv(spark, path, schema, free_text)
    raise ValueError(f"unsupported file type: {path}")


def read_firm_table(spark: SparkSession, table: str, path: str | None = None) -> DataFrame:
    """A panel laid out by firm, see :func:`writers.write_firm_table`.

    ``path`` makes the files of an earlier session known to this one's catalog; bucket count and columns are taken from the file
    that stands beside them.
    """
    if path is not None and not spark.catalog.tableExists(table):
        layout = spark.read.json(f"{path.rstrip('/')}-layout").first()
        spark.sql(f"CREATE TABLE {table} ({layout.columns}) USING parquet CLUSTERED BY ({layout.key}) SORTED BY ({layout.order}) INTO {layout.buckets} BUCKETS LOCATION '{path}'")
    return nan_as_null(spark.table(table))


def distinct_keys(panel: DataFrame, key: str = "gvkey") -> DataFrame:
    return panel.select(key).distinct()


def rows_of_keys(panel: DataFrame, keys: DataFrame | list, key: str = "gvkey") -> DataFrame:
    """Only the rows of the given firms: a literal list reaches the scan as a filter.

    On a plain parquet panel it skips row groups; on a table of :func:`writers.write_firm_table` it picks the buckets to read.
    """
    if isinstance(keys, list):
        return panel.where(F.col(key).isin(keys))
    return panel.join(keys.select(key), key, "left_semi")
