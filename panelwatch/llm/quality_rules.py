"""Quality rules: words, symbols and repeats of whole texts, then bands of zstandard ratios.

The method's verdict rests on compression bands.  A whole text's ratio (bytes / compressed bytes) must lie inside the limits of
its length (one pair of limits per power of two bytes), and so must the ratios of its fixed chunks: a text with more than
`chunk_share` of its chunks outside is rejected as well.  Above a band a text repeats itself, below it cannot be compressed.  Texts of
4,096 bytes or more are cut into chunks of that size, the last of which ends with the text and may overlap the one before, so
every byte is judged.

Limits are fitted on all labelled good texts: the exact 0.5 % and 99.5 % quantiles of a length, widened by `margin`; for chunks, of each
text's lowest and highest chunk; and the share of chunks that 99.5 % of the good texts keep inside.  Every text is measured where it
lies and only its ratios meet the labels, so no text is shuffled; quantiles are taken over sorted ranges, so no task holds all ratios.  Lengths with fewer than `least` labelled texts use the limits of the next shorter length
that has any, fitted or DEFAULT_BANDS.

Defined cases: a null text is an empty one: no words, base_failed, not kept.  Rows are judged one by one, so repeated rows and
null ids come back as often as they came; an empty table gives an empty result; other columns are neither read nor touched.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quantiles import column_quantile, group_quantiles
from .common import Remembered, cut, table, window_hashes, word_hashes

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
#: Limits of the ratio for texts of 2**k to 2**(k+1) - 1 bytes: about what zstandard gives on prose in many languages.
DEFAULT_BANDS = {k: (0.72 * m, 1.35 * m) for k, m in enumerate([0.1, 0.2, 0.35, 0.6, 0.72, 0.86, 1.06, 1.34, 1.58, 1.77, 1.94, 2.09, 2.2, 2.3, 2.38, 2.46, 2.55, 2.65, 2.75, 2.85, 2.95])}


@dataclass(frozen=True)
class Bands:
    """Limits by power of two bytes, limits of full chunks, chunk size in bytes and level of the compressor."""

    whole: dict = field(default_factory=lambda: dict(DEFAULT_BANDS))
    chunk: tuple = (0.72 * 2.2, 1.35 * 2.2)
    size: int = 4096
    chunk_share: float = 0.1
    level: int = 3
    least_bytes: int = 64

    def limits(self, n_bytes: int) -> tuple:
        k = max(n_bytes, 1).bit_length() - 1
        return self.whole[k if k in self.whole else max(x for x in self.whole if x <= k)]


def ratios(data: bytes, bands: Bands, compressor: zstandard.ZstdCompressor) -> tuple[float, list[float]]:
    """Ratio of the whole text and of each chunk of a text of a chunk's size or more; the last chunk ends with the text."""
    if not data:
        return 0.0, []
    whole = len(data) / len(compressor.compress(data))
    if len(data) < bands.size:
        return whole, []
    view = memoryview(data)
    starts = [*range(0, len(data) - bands.size, bands.size), len(data) - bands.size]
    return whole, [bands.size / len(compressor.compress(view[i : i + bands.size])) for i in starts]


def verdict(data: bytes, bands: Bands, compressor: zstandard.ZstdCompressor) -> tuple[float, float, bool]:
    """(ratio, share of chunks outside the limits, inside).  Texts under `least_bytes` are too short to judge and pass."""
    whole, chunks = ratios(data, bands, compressor)
    low, high = bands.limits(len(data))
    outside = sum(not bands.chunk[0] <= r <= bands.chunk[1] for r in chunks) / len(chunks) if chunks else 0.0
    good = len(data) < bands.least_bytes or (low <= whole <= high and outside <= bands.chunk_share)
    return whole, outside, good


def repeated_words(ids: np.ndarray, n: int = WINDOW) -> int:
    """Words that lie in a window of n words found twice or more, first included.  ids: 64-bit hashes of the words."""
    if len(ids) <= n:
        return 0
    keys = window_hashes(ids, n)
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    if not same.any():
        return 0
    a, b = order[1:][same], order[:-1][same]
    if any((ids[a + i] != ids[b + i]).any() for i in range(n)):  # two windows share a hash: count the windows themselves
        windows = [tuple(ids[i : i + n]) for i in range(len(ids) - n + 1)]
        found = Counter(windows)
        starts = np.array([i for i, w in enumerate(windows) if found[w] > 1])
    else:
        starts = np.concatenate([a, b])
    edge = np.zeros(len(ids) + 1, np.int64)
    edge[np.unique(starts)] += 1
    np.subtract.at(edge, np.unique(starts) + n, 1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base_counts(text: str, hashes: Remembered) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    spaces = sum(data.count(c) for c in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f"))
    symbols = sum(data.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS)))
    lines = [x for x in data.split(b"\n") if x.strip()] if b"\n" in data else []
    ids = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    return len(words), len(text) - spaces, symbols, len(lines) - len(set(lines)), repeated_words(ids)


VERDICT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, ratio double, chunks_outside double, base_failed boolean, kept boolean"


def verdict_of(bands: Bands):
    """The rules as a column function: text -> struct of VERDICT."""

    @F.pandas_udf(VERDICT)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        compressor = zstandard.ZstdCompressor(level=bands.level)
        hashes = word_hashes()
        for texts in batches:
            rows = []
            for text in texts:
                text = "" if text is None else text
                counts = base_counts(text, hashes)
                failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
                ratio, outside, good = verdict(text.encode("utf-8", "surrogatepass"), bands, compressor)
                rows.append((*counts, ratio, outside, failed, good and not failed))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in VERDICT.split(", ")])

    return judged


def fit_bands(docs: DataFrame, labels: DataFrame, least: int = 40, margin: float = 0.04, base: Bands = Bands()) -> Bands:
    """Limits from all labelled good texts (quality = 1)."""

    def measured(batches):
        compressor = zstandard.ZstdCompressor(level=base.level)
        for batch in batches:
            rows = []
            for i, text in zip(batch["doc_id"], batch["text"]):
                data = text.encode("utf-8", "surrogatepass")
                whole, chunks = ratios(data, base, compressor)
                rows.append((i, max(len(data), 1).bit_length() - 1, whole, chunks))
            yield pd.DataFrame(rows, columns=["doc_id", "k", "ratio", "chunks"])

    texts = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    kind = docs.schema["doc_id"].dataType.simpleString()
    each = texts.mapInPandas(measured, f"doc_id {kind}, k int, ratio double, chunks array<double>")
    found = cut(each.join(labels.where("quality = 1").select("doc_id"), "doc_id", "left_semi").drop("doc_id"))  # one row per good text
    counts = {r.k: r.n for r in found.groupBy("k").agg(F.count("*").alias("n")).collect()}  # one row per power of two
    cut_up = found.where(F.size("chunks") > 0)
    wholes = found.select("k", F.col("ratio").alias("low"), F.col("ratio").alias("high"))
    chunks = cut_up.select(F.lit(-1).alias("k"), F.array_min("chunks").alias("low"), F.array_max("chunks").alias("high"))
    edges = group_quantiles(wholes.unionByName(chunks), "k", ["low", "high"], [0.005, 0.995])
    widened = {r.k: (r.low * (1 - margin), r.high * (1 + margin)) for r in edges.collect()}  # and one of the chunks
    whole = dict(base.whole) | {k: widened[k] for k, n in counts.items() if n >= least}
    if cut_up.count() < least:
        return Bands(whole, base.chunk, base.size, base.chunk_share, base.level, base.least_bytes)
    low, high = widened[-1]
    outside = F.size(F.filter("chunks", lambda r: ~r.between(low, high))) / F.size("chunks")
    share = column_quantile(cut_up.select(outside.alias("outside")), "outside", 0.995).first()[0]
    return Bands(whole, (low, high), base.size, share, base.level, base.least_bytes)


def quality_rules(docs: DataFrame, bands: Bands) -> DataFrame:
    """doc_id and the verdict's columns, for every row of docs (doc_id, text)."""
    return docs.select("doc_id", verdict_of(bands)("text").alias("v")).select("doc_id", "v.*")


def keep_good(docs: DataFrame, bands: Bands) -> DataFrame:
    """The rows of docs that pass, with their columns as they were."""
    return docs.where(verdict_of(bands)("text")["kept"])


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    bands = fit_bands(docs, table(spark, sf_dir, "labels"))
    return quality_rules(docs, bands).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
