"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Codes: vectors are made unit length and centred, turned onto their principal axes, and each of two learned rotations (iterative
quantisation: the rotation that brings the signs closest to the values) gives one bit per dimension.  Rotations and the search
radius are fitted on at most `sample` vectors (8,192; those with the smallest hash of vec_id): the radius holds the share `keep` of
the true neighbours of sampled vectors.  Every row is indexed.

Index: a code is cut into substrings of 8 bits, and each substring position has a table from value to rows.  By the pigeonhole
principle a code within `radius` of a query's agrees with it up to radius // substrings bits in at least one substring, so probing
all values that near in every table meets every code within the radius; what the probes of a value meet is laid down when a table is built.  Those are checked on the whole code, and the floats of
those that pass are compared exactly.  A query that meets fewer than k codes in a block takes all rows of the block, so results
are never short.

Scale: rows are dealt by hash to blocks of some 8,192, queries to chunks of some 2,048; each pair of block and chunk is one group,
whose output is k rows per query at most, and a window takes the k best per query.

Defined cases: vectors that are null, empty, zero, hold a null or a non-finite number, or differ in length from most of the sample
take no part, as queries or candidates, and so do rows without vec_id.  A query has all rows but those with its own vec_id as candidates.  Repeated rows (equal
vec_id and vector) are one; different vectors of one vec_id are candidates each, and as queries share one answer, in which a candidate
has its best score.  With fewer than k candidates all are returned; an empty table gives an empty result.  Other columns are neither
read nor touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import hash_sample, sorted_groups, table

BITS = 8
BLOCK_ROWS = 8_192
CHUNK_QUERIES = 2_048
PAIRS = "query_id long, vec_id long, copy long, score double"


@dataclass(frozen=True)
class Codes:
    """Centre, projections (one column per bit) and the search radius in bits."""

    centre: np.ndarray
    axes: np.ndarray
    radius: int

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """Substrings of the codes, one byte each."""
        return np.packbits((unit(vectors) - self.centre) @ self.axes > 0, axis=1)


def unit(vectors: np.ndarray) -> np.ndarray:
    top = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / top
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))

def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors times a power of two that brings their largest component near 1: no digit changes, and squares stay finite."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=-1, keepdims=True))[1])


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosines in double precision of scaled vectors; the sums of a row do not depend on the rows around it, so equal vectors score alike."""
    dot = (vectors * query).sum(axis=1)
    return dot / (np.sqrt((query * query).sum()) * np.sqrt((vectors * vectors).sum(axis=1)))


def learn(vectors: np.ndarray, rotations: int = 2, rounds: int = 40, k: int = 5, keep: float = 0.98, probes: int = 400, seed: int = 3) -> Codes:
    """Codes of sampled vectors (one per row, none of them zero)."""
    near = unit(vectors)
    centre = near.mean(axis=0)
    shifted = near - centre
    _, principal = np.linalg.eigh(shifted.T @ shifted)
    values = shifted @ principal
    rng = np.random.default_rng(seed)
    axes = []
    for _ in range(rotations):
        turn = np.linalg.qr(rng.normal(size=(values.shape[1],) * 2))[0]
        for _ in range(rounds):
            u, _, vt = np.linalg.svd(np.where(values @ turn > 0, 1.0, -1.0).T @ values)
            turn = (u @ vt).T
        axes.append(principal @ turn)
    columns = np.concatenate(axes, axis=1)
    columns = columns[:, : columns.shape[1] - columns.shape[1] % BITS] if columns.shape[1] >= BITS else np.tile(columns, (1, BITS))[:, :BITS]
    codes = Codes(centre, columns, columns.shape[1])
    packed = codes.of(vectors)
    found = []
    for i in range(0, len(near), max(1, len(near) // probes)):
        score = near @ near[i]
        score[i] = -2
        best = np.argpartition(-score, min(k, len(score)) - 1)[:k]
        found.append(np.bitwise_count(packed[best] ^ packed[i]).sum(axis=1))
    radius = int(np.quantile(np.concatenate(found), keep)) + 1 if len(near) > k else columns.shape[1]
    return Codes(centre, columns, min(radius, columns.shape[1]))


class Tables:
    """One table per substring position: for each value, the rows met by probing all values near it, as bits."""

    def __init__(self, codes: np.ndarray, radius: int):
        self.codes, self.radius = codes, radius
        near = radius // codes.shape[1]  # so far at most in one substring of a code within the radius
        values = np.arange(256, dtype=np.uint8)
        probed = np.bitwise_count(values[:, None] ^ values[None, :]) <= near
        self.met = [np.packbits(probed[:, column], axis=1) for column in codes.T]

    def within(self, code: np.ndarray) -> np.ndarray:
        """All rows whose code differs from `code` in at most `radius` bits."""
        found = np.bitwise_or.reduce([rows[value] for value, rows in zip(code, self.met)])
        some = np.flatnonzero(np.unpackbits(found, count=len(self.codes)))
        return some[np.bitwise_count(self.codes[some] ^ code).sum(axis=1, dtype=np.int32) <= self.radius]


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        some = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def searched(batches: Iterator[pd.DataFrame], codes: Codes, k: int) -> Iterator[pd.DataFrame]:
    """Groups of (block, chunk): rows with their `is_query`; k best candidates of the block per query."""
    for group in sorted_groups(batches, ["block", "chunk"]):
        is_query = group["is_query"].to_numpy()
        vectors = np.stack(group["embedding"].to_numpy()).astype(np.float64)
        ids, copies = group["vec_id"].to_numpy(np.int64), group["copy"].to_numpy(np.int64)
        packed = codes.of(vectors)
        even = scaled(vectors)
        base, base_ids, base_copies = even[~is_query], ids[~is_query], copies[~is_query]
        if not len(base):
            continue
        tables = Tables(packed[~is_query], codes.radius)
        out = []
        for query, query_id, code in zip(even[is_query], ids[is_query], packed[is_query]):
            for some in (tables.within(code), np.arange(len(base))):
                some = some[base_ids[some] != query_id]
                if len(some) >= k:
                    break
            scores = cosines(query, base[some])
            best = best_of(base_ids[some], scores, k)
            out.append(pd.DataFrame({"query_id": query_id, "vec_id": base_ids[some][best], "copy": base_copies[some][best], "score": scores[best]}))
        yield pd.concat(out, ignore_index=True) if out else pd.DataFrame({"query_id": [], "vec_id": [], "copy": [], "score": []})


def fitting(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of rows that can take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return rows.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite & F.exists("embedding", lambda x: x != 0))


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, sample: int = 8_192, keep: float = 0.98) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k nearest found, for rows of vectors (vec_id, embedding) with is_query."""
    rows = fitting(vectors)
    picked = hash_sample(rows, "vec_id", sample).select("embedding").toArrow()["embedding"].to_pylist()  # at most `sample` rows
    if not picked:
        return vectors.sparkSession.createDataFrame([], f"query_id long, rank int, vec_id long, score double")
    lengths = [len(x) for x in picked]
    size = max(sorted(set(lengths)), key=lengths.count)
    codes = learn(np.array([x for x in picked if len(x) == size]), k=k, keep=keep)
    rows = rows.where(F.size("embedding") == size).dropDuplicates(["vec_id", "embedding"]).withColumn("copy", F.xxhash64("embedding"))
    n, queries = rows.count(), rows.where(is_query).count()
    blocks, chunks = max(1, -(-n // BLOCK_ROWS)), max(1, -(-queries // CHUNK_QUERIES))
    own = lambda parts, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(parts)).cast("int")
    each = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    base = rows.withColumn("block", own(blocks, 1)).withColumn("chunk", each(chunks)).withColumn("is_query", F.lit(False))
    asked = rows.where(is_query).withColumn("chunk", own(chunks, 2)).withColumn("block", each(blocks)).withColumn("is_query", F.lit(True))
    columns = ["block", "chunk", "is_query", "vec_id", "copy", "embedding"]
    dealt = base.select(*columns).unionByName(asked.select(*columns)).repartition("block", "chunk").sortWithinPartitions("block", "chunk")
    found = dealt.mapInPandas(lambda batches: searched(batches, codes, k), PAIRS).groupBy("query_id", "vec_id", "copy").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "copy")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
