"""URL filters: allow and block rules, and a character language-model ratio for all other URLs.

URLs that a rule decides train two variable-order Markov models over bytes, one of accepted and one of rejected URLs.  The chance of
a byte mixes orders 0 to 5: at each order its count after that context, plus `blend` times the chance from the order below, over the
context's count plus `blend`; below order 0 all bytes are alike.  A URL's score is the difference of its log-likelihoods per byte;
it is blocked if the score is below a threshold, calibrated on a tenth of the accepted URLs held out of training (by hash): at most
`false_block` of them fall below it.

Counts cover all decided URLs and are exact: a context of up to five bytes with its next byte fits one long, and the counts are a
Spark table that grows with the URLs.  Scoring deals URLs to blocks of at most BLOCK_URLS, takes the distinct windows of six bytes of
each block, joins the distinct windows of all to the counts order by order, and hands each block the log chances of its own windows.
So a frequent window is one row per block, and neither the driver nor a task holds the models.

Defined cases: a null URL, or one without `://`, has an empty host and path, no rule fits it, and it is scored as an empty text; if
rules accept or reject no URL at all, every URL without a rule is allowed; repeated rows are judged one by one; an empty table gives
an empty result; other columns are neither read nor touched.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, sorted_groups, table

#: (verdict, host, start of the path).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
MOST_RULES = 1000
ORDERS = 6
#: URLs of a block; the windows that a task holds are those of its block.
BLOCK_URLS = 8_192
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), "^([^/?#]*)", 1), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """The longest rule that fits, as struct(length, rule, verdict); null if none does.

    Rules are settings, at most MOST_RULES of them.  Of rules of one length the last in alphabetical order wins.
    """
    if len(rules) > MOST_RULES:
        raise ValueError("too many rules")
    fits = [
        F.when(
            ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p)),
            F.struct(F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for v, h, p in rules
    ]
    return F.array_max(F.array(*fits))


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(windows, owner) by byte: its five bytes before and itself in one number; each text ends with an end mark."""
    pad = b"\x02" * (ORDERS - 1)
    data = np.frombuffer(b"".join(pad + x + b"\x03" for x in texts), np.uint8).astype(np.int64)
    lengths = np.array([len(x) + 1 for x in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    at = np.arange(len(owner)) + (owner + 1) * len(pad)
    windows = np.zeros(len(at), np.int64)
    for order in range(ORDERS):
        windows += data[at - order] << (8 * order)
    return windows, owner


def per_byte(texts: list[bytes], windows: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Score by text.  windows: sorted, all that the texts have, with their differences of log chances."""
    found, owner = windows_of(texts)
    return np.bincount(owner, logs[np.searchsorted(windows, found)], len(texts)) / np.array([len(x) + 1 for x in texts])


def gram(window: Column, order: int) -> Column:
    """The last order + 1 bytes of a window."""
    return window.bitwiseAND(F.lit((1 << (8 * (order + 1))) - 1))


def sliced(urls: Iterable, size: int = 1 << 18) -> Iterator[list[bytes]]:
    """Runs of texts of about `size` bytes."""
    held, total = [], 0
    for url in urls:
        data = ("" if url is None else url).encode("utf-8", "surrogatepass")
        held.append(data)
        total += len(data) + ORDERS
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """url, side -> window, rejected, accepted: how often it is in URLs of each side."""
    for batch in batches:
        for side, urls in batch.groupby("side")["url"]:
            for texts in sliced(urls, 1 << 20):
                windows, n = np.unique(windows_of(texts)[0], return_counts=True)
                yield pd.DataFrame({"window": windows, "rejected": n * (side == 0), "accepted": n * (side == 1)})


SIDES = ("rejected", "accepted")


@dataclass(frozen=True)
class Models:
    """Counts of windows by side (window, rejected, accepted), and the threshold of the score."""

    counts: DataFrame
    threshold: float = float("-inf")
    blend: float = 4.0

    def logs(self, windows: DataFrame) -> DataFrame:
        """window and log, the difference of its log chances (accepted - rejected), of distinct windows.

        Goes up from order 0: what is looked up at an order are the distinct grams of the windows.
        """
        summed = [F.sum(side).alias(side) for side in SIDES]
        wanted, seen = [windows], [self.counts]
        for order in reversed(range(ORDERS - 1)):
            shorter = gram(F.col("window"), order).alias("window")
            wanted.insert(0, cut(wanted[0].select(shorter).distinct()))
            seen.insert(0, cut(seen[0].groupBy(shorter).agg(*summed)))
        lower = None
        for order in range(ORDERS):
            context = F.shiftright("window", 8).alias("context")
            around = seen[order].groupBy(context).agg(*[F.sum(side).alias(f"all_{side}") for side in SIDES])
            rows = wanted[order].withColumn("context", F.shiftright("window", 8)).join(seen[order].hint("merge"), "window", "left").join(around.hint("merge"), "context", "left")
            if lower is not None:
                rows = rows.withColumn("shorter", gram(F.col("window"), order - 1)).join(lower.hint("merge"), "shorter")
            chances = []
            for side in SIDES:
                below = F.lit(1 / 256) if lower is None else F.col(f"below_{side}")
                chances.append(((F.coalesce(side, F.lit(0)) + self.blend * below) / (F.coalesce(f"all_{side}", F.lit(0)) + self.blend)).alias(f"below_{side}"))
            lower = rows.select(F.col("window").alias("shorter"), *chances)
        ends = [F.log(F.least(f"below_{side}", F.lit(1.0))) for side in SIDES]
        return lower.select(F.col("shorter").alias("window"), (ends[1] - ends[0]).alias("log"))

    def scored(self, rows: DataFrame) -> DataFrame:
        """The rows with their score, the difference of log-likelihoods per byte of their url, the end mark included."""
        dealt = cut(rows.withColumn("block", F.floor(F.monotonically_increasing_id() / BLOCK_URLS)))  # written once, so blocks stay as they are

        def distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for group in sorted_groups(batches, ["block"]):
                found = [np.unique(windows_of(texts)[0]) for texts in sliced(group["url"])]
                yield pd.DataFrame({"block": group["block"].iloc[0], "window": np.unique(np.concatenate(found))})

        met = cut(dealt.select("block", "url").mapInPandas(distinct, "block long, window long"))
        logs = met.join(self.logs(cut(met.select("window").distinct())).hint("merge"), "window")

        def joined(own: pa.Table, logs: pa.Table) -> pa.Table:  # Arrow, so that ids beside nulls stay whole numbers
            logs = logs.sort_by("window")
            windows, values = logs["window"].to_numpy(), logs["log"].to_numpy()
            score = [per_byte(texts, windows, values) for texts in sliced(own["url"].to_pylist())]
            return own.drop_columns("block").append_column("score", pa.array(np.concatenate(score) if score else np.zeros(0)))

        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        return dealt.groupBy("block").cogroup(logs.groupBy("block")).applyInArrow(joined, f"{kinds}, score double")

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Scores of a few texts."""
        windows = np.unique(windows_of(texts)[0])
        spark = self.counts.sparkSession
        logs = self.logs(cut(spark.createDataFrame(pd.DataFrame({"window": windows})))).toPandas().sort_values("window")
        return per_byte(texts, logs["window"].to_numpy(), logs["log"].to_numpy())


def with_sides(decided: DataFrame) -> DataFrame:
    """url, side (1: accepted) and held (a tenth, by hash, that no model counts) of decided URLs (url, verdict)."""
    sides = decided.where("url is not null").select("url", (F.col("verdict") == "allow").cast("int").alias("side"))
    return sides.withColumn("held", F.pmod(F.xxhash64("url", F.lit(5)), F.lit(10)) == 0)


def count_models(sides: DataFrame) -> Models | None:
    """Models of both sides, without a threshold; null if one side has no URL."""
    found = sides.where("not held").select("url", "side").mapInPandas(counted, "window long, rejected long, accepted long")
    counts = cut(found.groupBy("window").agg(*[F.sum(side).alias(side) for side in SIDES]))
    return Models(counts) if all(counts.where(F.col(side) > 0).limit(1).count() for side in SIDES) else None


def threshold_of(scored: DataFrame, false_block: float) -> float:
    """The threshold, 0 at most, below which at most a share `false_block` of these accepted URLs (score) lies."""
    bins = F.floor(F.least(F.greatest("score", F.lit(-20.0)), F.lit(20.0)) * 1000).alias("bin")
    found = sorted((r.bin, r["count"]) for r in scored.select(bins).groupBy("bin").count().collect())  # at most 40,001 rows
    allowed, below = false_block * sum(n for _, n in found), 0
    for edge, n in found:
        if below + n > allowed:
            return min(edge / 1000, 0.0)
        below += n
    return float("-inf")


def fit(decided: DataFrame, false_block: float = 0.01) -> Models | None:
    """Models of decided URLs (url, verdict) with their threshold; null if one side has none."""
    sides = with_sides(decided)
    models = count_models(sides)
    return models and Models(models.counts, threshold_of(models.scored(sides.where("held and side = 1").select("url")), false_block))


def judged(pages: DataFrame, rules: tuple = RULES, false_block: float = 0.01) -> DataFrame:
    """page_id, host, path, rule, verdict and score (null where a rule decides) of every row of pages (page_id, url).

    The URLs held out for the threshold and those to be judged are scored in one pass.
    """
    urls = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    urls = urls.withColumns({"host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit(""))})
    ruled = urls.withColumn("r", rule_for(F.col("host"), F.col("path"), rules)).select("page_id", "url", "host", "path", "r.rule", "r.verdict")
    by_rule = ruled.where("rule is not null").withColumn("score", F.lit(None).cast("double"))
    rest = ruled.where("rule is null").withColumn("held", F.lit(False))
    sides = with_sides(ruled.where("verdict is not null"))
    models = count_models(sides)
    if models:
        both = cut(models.scored(rest.unionByName(sides.where("held and side = 1").select("url", "held"), allowMissingColumns=True)))
        threshold = threshold_of(both.where("held"), false_block)
        scored, by_method = both.where("not held"), F.when(F.col("score") < threshold, "block").otherwise("allow")
    else:
        scored, by_method = rest.withColumn("score", F.lit(None).cast("double")), F.lit("allow")
    return by_rule.unionByName(scored.drop("held")).select("page_id", "host", "path", "rule", F.coalesce("verdict", by_method).alias("verdict"), "score")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")
