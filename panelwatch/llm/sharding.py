"""Sharding: a Feistel permutation with cycle walking over global row numbers.

Rows get gapless global numbers (in order of a hash bucket, then doc_id, checksum and size), and a keyed permutation of 0 to N - 1
sends each number to a position; shard = position mod shards, slot = position div shards.  So shard sizes differ by one row at
most (the law `rows`), slots are gapless, the shuffle is the same for any partitioning of the input, and shard and slot of a row
number, or the row number in a slot, can be computed without data.

The Feistel network acts on pairs (l, r), l < a, r < b, with a * b the least such product of N or more for a = ceil(sqrt(N)), and
adds a mixing of one half to the other, modulo its size.  Positions of N or more walk on along their cycle until they fall below N.

Numbering shuffles only doc_id, checksum and size.  Equal rows are counted first and numbered together; the numbers of a row repeated
more than RANGE times are dealt to tasks in ranges.  A bucket has some 200,000 rows whatever the input.  All DataFrame functions.

Defined cases: a null text has size 1 (0 bytes plus 1) and checksum 0, like an empty one; null and repeated doc_ids are rows like
any other; rows with equal doc_id, checksum and size are interchangeable; an empty table gives an empty result; other columns are
neither read nor touched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

#: Fixed values of the mixing function: a prime, a factor, and increments per round.
PRIME = 2147483647
FACTOR = 48271
STEP = 1442695041
ROUNDS = 8
BUCKET_ROWS = 200_000
#: Numbers that one task gives to repeats of a row at a time.
RANGE = 65_536


def halves(n: int) -> tuple[int, int]:
    """(a, b) with a * b >= n and a * b - n < a."""
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return a, max(1, -(-n // a))


def walk_limit(n: int) -> int:
    """Steps after which every walk has ended: at most a * b - n positions lie outside, and a cycle passes each once.

    Beyond 64 the chance that any of n walks is longer is below n * (1 / sqrt(n)) ** 64, and such a walk raises an error.
    """
    a, b = halves(n)
    return min(a * b - n, 64)


def whole(n: int) -> Column:
    return F.lit(n).cast("long")


def scrambled(x: Column, key: Column) -> Column:
    y = F.pmod(x + key, whole(PRIME))
    return F.pmod(F.pmod(y * y, whole(PRIME)) * FACTOR + x, whole(PRIME))


def round_keys(seed: int) -> list[int]:
    return [(seed * FACTOR + (i + 1) * STEP) % PRIME for i in range(ROUNDS)]


def feistel(x: Column, n: int, seed: int) -> Column:
    """One pass of the network: a permutation of 0 to a * b - 1 (for numbers below 2**53)."""
    a, b = halves(n)
    keys = F.array(*[F.struct(F.lit(i % 2 == 0).alias("left"), whole(k).alias("key")) for i, k in enumerate(round_keys(seed))])
    low = F.pmod(x, whole(b))
    start = F.struct(((x - low) / b).cast("long").alias("l"), low.alias("r"))

    def turn(s: Column, k: Column) -> Column:
        left = F.struct(F.pmod(s["l"] + scrambled(s["r"], k["key"]), whole(a)).alias("l"), s["r"].alias("r"))
        right = F.struct(s["l"].alias("l"), F.pmod(s["r"] + scrambled(s["l"], k["key"]), whole(b)).alias("r"))
        return F.when(k["left"], left).otherwise(right)

    return F.aggregate(keys, start, turn, lambda s: s["l"] * whole(b) + s["r"])


def position(row: Column, n: int, seed: int) -> Column:
    """Place of a row number in the shuffle of 0 to n - 1."""
    steps = F.sequence(F.lit(0), F.lit(walk_limit(n)))
    walked = F.aggregate(steps, row, lambda x, i: F.when((i == 0) | (x >= whole(n)), feistel(x, n, seed)).otherwise(x))
    return F.when(walked < whole(n), walked).otherwise(F.raise_error(F.lit("a walk did not end")).cast("long"))


def numbered(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Adds `row`, gapless from 0 over all rows, in order of a hash bucket and the keys."""
    buckets = max(64, -(-n // BUCKET_ROWS))
    equal = rows.groupBy(*keys).agg(F.count("*").alias("copies")).withColumn("bucket", F.pmod(F.xxhash64(*keys), whole(buckets)))
    totals = equal.groupBy("bucket").agg(F.sum("copies").alias("total"))
    before = totals.select("bucket", (F.sum("total").over(Window.orderBy("bucket")) - F.col("total")).alias("before"))  # one row per bucket
    inside = F.sum("copies").over(Window.partitionBy("bucket").orderBy(*[F.col(k).asc_nulls_first() for k in keys])) - F.col("copies")
    first = equal.withColumn("inside", inside).join(before, "bucket")
    first = first.select(*keys, "copies", (F.col("before") + F.col("inside")).alias("first"))
    each = lambda start, end: F.explode(F.sequence(start, end)).alias("row")
    few = first.where(F.col("copies") <= RANGE).select(*keys, each(F.col("first"), F.col("first") + F.col("copies") - 1))
    starts = first.where(F.col("copies") > RANGE).select(*keys, (F.col("first") + F.col("copies")).alias("end"), F.explode(F.sequence(whole(0), F.col("copies") - 1, whole(RANGE))).alias("i"), "first")
    ranges = starts.select(*keys, "end", (F.col("first") + F.col("i")).alias("start")).repartition(*keys, "start")
    return few.unionByName(ranges.select(*keys, each(F.col("start"), F.least(F.col("start") + RANGE, "end") - 1)))


def sharded(docs: DataFrame, shards: int = 16, seed: int = 11) -> DataFrame:
    """doc_id, size, text_crc32, row, shard and slot of every row of docs (doc_id, text)."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    checksum = F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long")
    rows = cut(docs.select("doc_id", size.alias("size"), checksum.alias("text_crc32")))
    n = rows.count()
    placed = numbered(rows, ["doc_id", "text_crc32", "size"], n).withColumn("position", position(F.col("row"), n, seed))
    shard = F.pmod("position", whole(shards))
    return placed.select("doc_id", "size", "text_crc32", "row", shard.cast("int").alias("shard"), ((F.col("position") - shard) / shards).cast("long").alias("slot"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
