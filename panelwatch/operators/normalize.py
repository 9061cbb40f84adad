"""From a raw panel file to the panel the detectors read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import nan_as_null, ticker, yyyymmdd, yyyymmdd_or_null
from .ordered import with_running_product

# The columns every normalised panel must have, in this order.
ESSENTIAL = ("ticker", "date", "price", "volume", "stock_ret", "gvkey", "iid", "excntry", "year", "month")

# The panel's column names and their names in the simplified detectors.
SIMPLE_NAMES = {
    "z_score": "altman_z_score",
    "o_score": "ohlson_o_score",
    "ni_be": "return_on_equity",
    "zero_trades_252d": "zero_trades_12m",
    "dolvol_126d": "dollar_volume",
    "age": "firm_age",
}

# Placeholders where the panel has no volume, and the level of a price index.
VOLUME_PER_RETURN = 1_000_000
VOLUME_PLACEHOLDER = 1_000_000
INDEX_BASE = 100.0


def with_ticker(panel: DataFrame) -> DataFrame:
    return panel.withColumn("ticker", ticker())


def with_date(panel: DataFrame, strict: bool = True) -> DataFrame:
    """``date`` from the number in ``date``, else in ``char_date``."""
    source = next((c for c in ("date", "char_date") if c in panel.columns), None)
    if source is None:
        raise ValueError("the panel has neither a 'date' nor a 'char_date' column")
    return panel.withColumn("date", yyyymmdd(source) if strict else yyyymmdd_or_null(source))


def with_price_index(panel: DataFrame, name: str = "price") -> DataFrame:
    """Price index from returns, 100 before the first month of each ticker."""
    indexed = with_running_product(panel, 1 + F.col("stock_ret"), name, "ticker", ("date",))
    return indexed.withColumn(name, INDEX_BASE * F.col(name))


def with_price(panel: DataFrame) -> DataFrame:
    """Existing price, else ``prc``, else an index from returns, else no price at all."""
    if "price" in panel.columns:
        return panel
    if "prc" in panel.columns:
        return panel.withColumn("price", F.col("prc"))
    if "stock_ret" in panel.columns:
        return with_price_index(panel, "price")
    return panel


def with_volume(panel: DataFrame) -> DataFrame:
    """Existing volume, else a proxy from the size of the return, else a constant."""
    if "volume" in panel.columns:
        return panel
    if "stock_ret" in panel.columns:
        return panel.withColumn("volume", F.abs("stock_ret") * VOLUME_PER_RETURN)
    return panel.withColumn("volume", F.lit(float(VOLUME_PLACEHOLDER)))


def essential_first(panel: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    panel = panel.withColumnsRenamed(renames or {})
    missing = [c for c in ESSENTIAL if c not in panel.columns]
    if missing:
        raise ValueError(f"the panel lacks the columns {missing}")
    return panel.select(*ESSENTIAL, *[c for c in panel.columns if c not in ESSENTIAL])


def normalize(raw: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Ticker, date, price, volume, then the essential columns in front of all features."""
    panel = with_date(with_ticker(nan_as_null(raw)))
    return essential_first(with_volume(with_price(panel)), renames)


def simple_dialect(panel: DataFrame) -> DataFrame:
    """The panel under the column names of the simplified detectors."""
    panel = panel if "ticker" in panel.columns else with_ticker(panel)
    return panel.withColumnsRenamed(SIMPLE_NAMES)
