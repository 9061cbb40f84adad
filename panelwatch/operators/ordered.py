"""Work that needs the row order inside a firm, without one task per firm.

A window over a firm alone sorts the whole firm in one task, which fails when one firm holds a
large share of the panel.  Four ways around that are used here:

* the last n rows of a firm: Spark limits each group before the shuffle (``WindowGroupLimit``);
* dates, previous rows and running products: rows are worked on inside (firm, date) cells, and
  what must cross a date is carried through one row per cell, so a firm's window is bounded by
  the calendar and not by its rows;
* sequence numbers: their digits make cells, and one row per cell carries over;
* values: rows are parted into sorted ranges and written once; one row per range carries over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.folders import scratch_folder

ROW_ORDER = ("date", "iid")
#: A cell of with_prior_sums spans 2**20 sequence numbers, a block of cells 2**20 cells.
CELL_BITS = 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder: what reads them repeats no work."""
    path = scratch_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_ranges(df: DataFrame, *order: str) -> DataFrame:
    """The rows parted into ranges of ``order``, sorted, and written once, with ``_at``: the range's number times 2**33, plus the place in it.

    So what must cross a range is one row per range, and no other step depends on how Spark drew the bounds.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranges")


def with_previous(
    df: DataFrame, columns: Sequence[str], key: str = "gvkey", order: Sequence[str] = ROW_ORDER
) -> DataFrame:
    """Add ``prev``: a struct of ``columns`` from the key's previous row, NULL on its first row.

    ``order`` starts with the date; a row looks back inside its cell, a cell's first row to the
    last row of the cell before.
    """
    cell = [key, order[0]]
    rows = df.repartition(*cell).withColumn("_row", F.struct(*columns))
    rows = rows.withColumn("prev", F.lag("_row").over(Window.partitionBy(*cell).orderBy(*order)))
    last = rows.groupBy(*cell).agg(F.max_by("_row", F.struct(*order)).alias("_last"))
    carried = last.select(*cell, F.lag("_last").over(Window.partitionBy(key).orderBy(order[0])).alias("_carried"))
    return rows.join(carried, cell, "left").withColumn("prev", F.coalesce("prev", "_carried")).drop("_row", "_carried")


def with_running_product(
    df: DataFrame, factor, name: str, key: str = "ticker", order: Sequence[str] = ("date",)
) -> DataFrame:
    """Add the running product of ``factor`` along the key; NULL factors are skipped and stay NULL."""
    cell = [key, order[0]]
    rows = df.repartition(*cell).withColumn("_factor", factor)
    inside = Window.partitionBy(*cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_inside", F.product("_factor").over(inside))
    whole = rows.groupBy(*cell).agg(F.product("_factor").alias("_whole"))
    earlier = Window.partitionBy(key).orderBy(order[0]).rowsBetween(Window.unboundedPreceding, -1)
    carried = whole.select(*cell, F.product("_whole").over(earlier).alias("_carried"))
    product = F.when(F.col("_factor").isNotNull(), F.coalesce("_carried", F.lit(1.0)) * F.col("_inside"))
    return rows.join(carried, cell, "left").withColumn(name, product).drop("_factor", "_inside", "_carried")


def in_order(panel: DataFrame, key: str = "gvkey", order: Sequence[str] = ROW_ORDER) -> DataFrame:
    """The whole panel sorted; Spark cuts the sort into ranges, also inside a large firm."""
    return panel.orderBy(key, *order)


def last_rows(df: DataFrame, n: int, key: str = "gvkey", order: Sequence[str] = ROW_ORDER) -> DataFrame:
    """The last ``n`` rows per key with ``rn`` = 1 for the very last."""
    newest_first = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("rn", F.row_number().over(newest_first)).where(F.col("rn") <= n)


def first_by(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The first row per key in ``order``; duplicates go before the shuffle."""
    in_order = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("_rank", F.row_number().over(in_order)).where(F.col("_rank") == 1).drop("_rank")


def date_cells(df: DataFrame, key: str = "gvkey") -> DataFrame:
    """One row per (key, date): row count, previous date, days since it, rows before the gap, next date.

    Rows on one date have no gap between them, so every gap of a firm is one between cells.
    """
    cells = df.groupBy(key, "date").agg(F.count(F.lit(1)).alias("n_rows"))
    by_date = Window.partitionBy(key).orderBy("date")
    return (
        cells.withColumn("prev_date", F.lag("date").over(by_date))
        .withColumn("prev_rows", F.lag("n_rows").over(by_date))
        .withColumn("next_date", F.lead("date").over(by_date))
        .withColumn("gap_days", F.datediff("date", "prev_date"))
    )


def with_prior_sums(df: DataFrame, sums: dict[str, Column], seq: str = "seq", keys: Sequence[str] = ()) -> DataFrame:
    """Add, per name, the sum of its column over all rows with a smaller ``seq`` (a unique long), per key if keys are given.

    The digits of the sequence number part the work: rows are summed up inside cells of 2**20 numbers, cells inside blocks of
    2**20 cells, and blocks over all.  As numbers are unique, no task sorts more than 2**20 rows, 2**20 cells or 2**23 blocks of a
    key, whatever the numbers are.  Rows are read twice and shuffled once, by cell; cells and blocks are partial sums.  Rows
    without a number have no place and go.
    """
    prior = lambda part, order: Window.partitionBy(*keys, *part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    numbered = df.where(F.col(seq).isNotNull()).withColumn("_cell", F.shiftright(seq, CELL_BITS))
    totals = numbered.groupBy(*keys, "_cell", F.shiftright("_cell", CELL_BITS).alias("_block")).agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    cells = stored(totals, "cells")  # one row per 2**20 numbers
    blocks = cells.groupBy(*keys, "_block").agg(*[F.sum(f"_{n}").alias(f"_{n}") for n in sums])
    blocks = blocks.select(*keys, "_block", *[F.sum(f"_{n}").over(prior([], "_block")).alias(f"_{n}_blocks") for n in sums])
    cells = cells.select(*keys, "_cell", "_block", *[F.sum(f"_{n}").over(prior(["_block"], "_cell")).alias(f"_{n}_cells") for n in sums])
    carried = cells.join(blocks, [*keys, "_block"]).drop("_block")
    rows = numbered.withColumns({f"_{n}_inside": F.sum(c).over(prior(["_cell"], seq)) for n, c in sums.items()}).join(carried, [*keys, "_cell"])
    parts = [f"_{{}}_{x}" for x in ("inside", "cells", "blocks")]
    whole = {n: sum((F.coalesce(part.format(n), zero) for part in parts), zero) for n in sums}
    return rows.withColumns(whole).drop("_cell", *[part.format(n) for n in sums for part in parts])


def after_first(df: DataFrame, n: int, seq: str = "seq") -> DataFrame:
    """Skip the first ``n`` rows in ``seq`` order; rows are counted cell by cell, not brought together."""
    if n <= 0:
        return df
    counted = with_prior_sums(df.select(seq), {"before": F.lit(1).cast("long")}, seq)
    first = counted.where(F.col("before") >= n).agg(F.min(seq)).scalar()
    return df.where(F.col(seq) >= first)
