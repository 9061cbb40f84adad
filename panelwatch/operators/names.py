"""Company names: one name per firm from two link tables, attached to events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "Unknown"


def latest_names(links: DataFrame) -> DataFrame:
    """Per firm the latest non-null name.  An undated row counts as latest; ``seq`` settles ties."""
    order = []
    if "datadate" in links.columns:
        order += [F.col("datadate").isNull(), F.col("datadate")]
    order += [F.col("seq")]
    rank = F.when(F.col("conm").isNotNull(), F.struct(*order))
    return links.where(F.col("gvkey").isNotNull()).groupBy("gvkey").agg(F.max_by("conm", rank).alias("company_name"))


def usable_links(links: DataFrame) -> DataFrame:
    return links.where(F.col("conm").isNotNull() & (F.btrim("conm", F.lit(" \t\n\r")) != ""))


def secondary_only(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Names for firms the primary table does not list at all."""
    return secondary.join(primary, "gvkey", "left_anti")


def company_names(primary: DataFrame, secondary: DataFrame | None = None) -> DataFrame:
    """(gvkey, company_name).  A firm listed in the primary table keeps that entry, even a NULL name."""
    names = latest_names(primary)
    if secondary is None:
        return names
    listed = names.withColumn("_listed", F.lit(True))
    other = latest_names(usable_links(secondary)).withColumnRenamed("company_name", "_other")
    name = F.when(F.col("_listed"), F.col("company_name")).otherwise(F.col("_other"))
    return listed.join(other, "gvkey", "full").select("gvkey", name.alias("company_name"))


def attach_names(events: DataFrame, names: DataFrame) -> DataFrame:
    """Left lookup; 'Unknown' only for firms without an entry, a NULL name stays NULL.

    No broadcast is forced: the name table grows with the firms, so Spark picks by its size.
    """
    known = names.select("gvkey", "company_name", F.lit(True).alias("_known"))
    name: Column = F.when(F.col("_known"), F.col("company_name")).otherwise(F.lit(UNKNOWN))
    return events.join(known, "gvkey", "left").withColumn("company_name", name).drop("_known")
