"""Helpers shared by the operators: tables, the shared folder, words, connected classes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words a task remembers at most.
MEMORY = 300_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the folder the cluster names in spark.checkpoint.dir.

    Where that is unset, a session in one process gets a folder of its own; a cluster has to name one.
    """
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not top:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        top = tempfile.mkdtemp(prefix="panelwatch-")
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def unused(df: DataFrame, name: str) -> str:
    """A column name that df does not have, `name` where it can be."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def cut(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder, so that later jobs neither repeat the work nor depend on an executor.

    It is a reliable checkpoint: executors may be lost after it.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def hash_sample(df: DataFrame, key: str, size: int) -> DataFrame:
    """The `size` rows with the smallest hash of a key (30 bits of xxhash64; ties by all bits, then by key).

    A first cut at the least power of two below which `size` rows lie keeps what tasks send small and changes nothing.
    """
    low = F.pmod(F.xxhash64(key), F.lit(1 << 30))
    found = {r.bits: r["count"] for r in df.groupBy(F.length(F.bin(low)).alias("bits")).count().collect()}  # at most 30 rows
    bits = next((b for b in range(31) if sum(n for x, n in found.items() if x <= b) >= size), 30)
    return df.where(low < F.lit(1 << bits)).orderBy(low, F.xxhash64(key), key).limit(size)


def words_of(text: str) -> list[bytes]:
    """Maximal runs without ASCII white space, as UTF-8 (lone surrogates pass through)."""
    return text.encode("utf-8", "surrogatepass").split()


class Remembered(dict):
    """Value of each word met, made on first sight; forgets all when full, so memory is bounded and results are not touched."""

    def __init__(self, make, limit: int = MEMORY):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, word):
        value = self.make(word)
        if len(self) >= self.limit:
            self.clear()
        if len(word) <= 200:
            self[word] = value
        return value


def word_hashes() -> Remembered:
    return Remembered(xxhash.xxh3_64_intdigest)


MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all runs of n words; a shorter text that has words counts as one run."""
    n = min(n, len(words))
    out = np.zeros(len(words) - n + 1 if n else 0, np.uint64)
    for i in range(n):
        out = out * MIX + words[i : i + len(out)]
    return mixed(out)


def sorted_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of a partition sorted by keys; only one group and one batch are held."""
    kept = None
    for batch in batches:
        batch = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
        if not len(batch):
            continue
        new = np.ones(len(batch), bool)
        new[1:] = np.any([batch[k].to_numpy()[1:] != batch[k].to_numpy()[:-1] for k in keys], axis=0)
        starts = np.flatnonzero(new)
        for i, j in zip(starts[:-1], starts[1:]):
            yield batch.iloc[i:j]
        kept = batch.iloc[starts[-1] :]
    if kept is not None and len(kept):
        yield kept


def connected_classes(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, class) of every node in links (a, b): connected nodes share a class, which is named after one of them.

    Each round gives every node the smallest of itself and its neighbours as its parent, and replaces
    the ends of all links by their parents, which keeps what is connected connected; links that fall
    together go.  So links shrink from round to round until none is left, and the parents of the
    rounds, put together from the last to the first, lead every node to its class.  Nodes should be
    named without regard to their links, as digests are: then a star with the smallest node in its
    middle goes in one round, and a path in few.  Rows stay on the executors: the driver sees one
    count per round.  Raises if the rounds do not suffice.
    """
    edges = cut(links.select("a", "b").where("a <> b").distinct())
    parents = []
    while edges.limit(1).count():
        if len(parents) == rounds:
            raise RuntimeError("classes did not settle")
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        parent = cut(low.select("node", F.least("node", "low").alias("class")))
        parents.append(parent)
        left = edges.join(parent.hint("merge"), edges.a == parent.node).select(F.col("class").alias("pa"), "b")
        right = left.join(parent.hint("merge"), left.b == parent.node).select("pa", F.col("class").alias("pb"))
        moved = right.where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
        edges = cut(moved.distinct())
    if not parents:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("class"))
    labels = parents.pop()
    while parents:
        above = labels.select(F.col("node").alias("class"), F.col("class").alias("top"))
        labels = cut(parents.pop().join(above, "class", "left").select("node", F.coalesce("top", "class").alias("class")))
    return labels
