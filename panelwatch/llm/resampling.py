"""Target-distribution importance resampling: documents that look like a target corpus are drawn more often.

A feature is a word or a pair of neighbouring words, put into one of `buckets` by its CRC-32.  Bucket counts over the whole corpus
and over the whole target give each bucket a gain, the log of how much likelier the target makes it; a document's weight is the mean
gain of its features, and Gumbel noise from a hash of its id turns weights into a draw without replacement: the highest scores win.

Features come from Arrow kernels on whole batches: ascii_lower, split_pattern_regex, list_flatten and dictionary_encode give
one index per word; the indices, shifted by one, make pairs, which are dictionary-encoded again, so each distinct word and pair of
a batch gets one CRC; `take` spreads buckets and gains over the features, and sums between document bounds reduce them.

Counts are one row per task and bucket.  The draw needs no global sort of all documents: a histogram of scores, which are whole
numbers between bounds set by 64-bit counts and 32-bit noise, gives the score of the last one drawn; only documents from there on
are sorted, by ranges, and numbered through with the counts of the ranges before.

Defined cases: a null text is empty; a text without words has no features and weight 0; documents with fewer than `least_words`
words are never drawn; a row without doc_id takes its noise from the empty id and comes last among equal scores; repeated rows are
drawn one by one; an empty corpus or target counts nothing, and gains follow the formula.  Other columns are not touched.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of text whose features are held at a time; a longer text is one piece by itself.
PIECE = 1 << 22


def pieces(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of rows of about PIECE bytes."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, before + PIECE, "right")))
        yield texts.slice(at, end - at)
        at = end


def bucketed(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets of all words and then of all pairs, row of each of them, words by row)."""
    parts = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), SEPARATORS)
    words, owner = pc.list_flatten(parts), pc.list_parent_indices(parts)
    some = pc.not_equal(words, "")  # what stands before a first or after a last separator
    coded = words.filter(some).dictionary_encode()
    owner = owner.filter(some).to_numpy(zero_copy_only=False).astype(np.int64)
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    names = [w.encode() for w in coded.dictionary.to_pylist()]
    crc = [zlib.crc32(w) for w in names]
    of_words = np.array(crc, np.int64)[index] if names else np.zeros(0, np.int64)

    inside = owner[1:] == owner[:-1]
    pairs = pa.array((index[:-1] * len(names) + index[1:])[inside]).dictionary_encode()
    firsts, seconds = np.divmod(pairs.dictionary.to_numpy(zero_copy_only=False), max(len(names), 1))
    after = [b" " + w for w in names]
    pair_crc = np.array([zlib.crc32(after[j], crc[i]) for i, j in zip(firsts.tolist(), seconds.tolist())], np.int64)
    of_pairs = pair_crc[pairs.indices.to_numpy(zero_copy_only=False)] if len(pair_crc) else np.zeros(0, np.int64)
    rows = np.concatenate([owner, owner[1:][inside]])
    return np.concatenate([of_words, of_pairs]) % buckets, rows, np.bincount(owner, minlength=len(texts))


def bucket_counts(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n) over all texts of docs (text)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for texts in pieces(batch["text"]):
                total += np.bincount(bucketed(texts, buckets)[0], minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found])], names=["bucket", "n"])

    counts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(counted, "bucket int, n long")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int, scale: int) -> np.ndarray:
    """Gain of each bucket, floored: `scale` times the log ratio of its smoothed shares of target and corpus."""
    corpus, wanted = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for counts, source in ((corpus, docs), (wanted, target)):
        for r in bucket_counts(source, buckets).collect():  # one row per bucket
            counts[r.bucket] = r.n
    s_all, t_all = float(corpus.sum() + buckets), float(wanted.sum() + buckets)
    ratio = [(float(t + 1) * s_all) / (float(s + 1) * t_all) for s, t in zip(corpus.tolist(), wanted.tolist())]
    return np.array([math.floor(scale * math.log(r)) for r in ratio], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row of docs (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in pieces(batch["text"]):
                found, rows, words = bucketed(texts, len(gain))
                order = np.argsort(rows, kind="stable")
                ends = np.cumsum(np.bincount(rows, minlength=len(texts)))
                sums = np.concatenate([[0], np.cumsum(gain[found[order]])])
                n = np.diff(ends, prepend=0)
                total = sums[ends] - sums[ends - n]
                columns = [batch["doc_id"].slice(at, len(texts)), pa.array(words), pa.array(n), pa.array(total // np.maximum(n, 1))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])
                at += len(texts)

    read = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return read.mapInArrow(summed, f"doc_id {kind.simpleString()}, n_words long, n_features long, weight long")


def with_noise(rows: DataFrame, seed: int, scale: int) -> DataFrame:
    """Add score: weight and Gumbel noise, from the first 32 bits of a SHA-256 of seed and id."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    share = (F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double") + 0.5) / float(1 << 32)
    return rows.withColumn("score", F.col("weight") + F.floor(F.lit(float(-scale)) * F.log(-F.log(share))))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 25, buckets: int = 10_000, seed: int = 7, least_words: int = 20, scale: int = 1000
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (from 1; null if not drawn) of every row of docs (doc_id, text)."""
    scored = cut(with_noise(weighed(docs, gains(docs, target, buckets, scale)), seed, scale))
    fit = F.col("n_words") >= least_words
    histogram = scored.where(fit).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    falling = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = histogram.select("score", F.sum("n").over(falling).alias("upto"), F.expr(f"sum(n) OVER () * {int(percent)} DIV 100").alias("drawn"))
    found = upto.where("upto >= drawn AND drawn > 0").agg(F.max("score").alias("last"), F.max("drawn").alias("drawn")).first()  # of as many rows as there are scores
    if found.drawn is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    drawn, winning = found.drawn, fit & (F.col("score") >= found.last)

    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    placed = scored.where(winning).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut(placed.withColumn("_place", F.monotonically_increasing_id()))  # number of the range, then place inside it
    part, place = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))  # one row per range
    rank = F.col("_before") + place + 1
    ranked = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn("rank", F.when(rank <= drawn, rank))
    rest = scored.where(~winning).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*scored.columns, "rank").unionByName(rest)


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


#: CRC-32 of a text in SQL: a table of 256 steps (fixed value: the reflected polynomial), folded over the bytes.
CRC_TABLE = """
    SELECT list(c ORDER BY i) AS t
    FROM (
        SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
        FROM range(256) r(i)
    )"""


def crc_sql(text: str, table_of: str) -> str:
    """CRC-32 of a text column; `table_of` is the column that holds CRC_TABLE's list."""
    data = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), (2 * i + 1)::INT, 2))::BIGINT)"
    step = f"xor(c // 256, {table_of}[xor(c % 256, b) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {data}), lambda c, b: {step}), 4294967295)"


RESAMPLING_SQL = f"""
WITH crc AS ({CRC_TABLE}),
texts AS (
    SELECT 0 AS side, row_number() OVER () AS row, doc_id, text FROM documents
    UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark
),
worded AS (
    SELECT side, row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM texts
),
features AS (
    SELECT side, row, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM worded
),
named AS (SELECT f, {crc_sql("f", "t")} % 10000 AS bucket FROM (SELECT DISTINCT f FROM features), crc),
counts AS (
    SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM features JOIN named USING (f) GROUP BY bucket
),
totals AS (SELECT coalesce(sum(s), 0)::BIGINT AS sa, coalesce(sum(t), 0)::BIGINT AS ta FROM counts),
gain AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sa + 10000) / ((s + 1)::DOUBLE * (ta + 10000))))::BIGINT AS g FROM counts, totals),
weights AS (
    SELECT row, count(*) AS n, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight
    FROM features JOIN named USING (f) JOIN gain USING (bucket) WHERE side = 0 GROUP BY row
),
scored AS (
    SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) AS words,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM worded LEFT JOIN weights USING (row) WHERE side = 0
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
        count(*) OVER (PARTITION BY words >= 20) AS fit
    FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN words >= 20 AND place <= 25 * fit // 100 THEN place END AS rank FROM ranked
"""
