"""Conversation prefix trie by truncation peeling: nodes are the distinct beginnings of conversations.

A conversation becomes a chain, one 16-byte digest per turn that covers all turns up to it: equal digests mean equal beginnings.
Equal chains are counted together, then all distinct chains are sorted by ranges (bytes in order, so a beginning stands before
what continues it, and the members of any node stand together) and written once.

Each task peels its sorted chains batch by batch, from the longest down: at depth d the conversations of d turns join the surviving
nodes cut to d turns, neighbours with the same digest become one node, its figures are summed as it is found, and its last turn is
stripped for the next depth.  What a chain shares with the chain before it (over batches and ranges too: one number per range is
passed on) tells which of its nodes are new, so distinct nodes, children and leaves are plain sums as well.  A node that
lies in several batches comes once per batch; a last aggregation by digest adds these up.  No step repeats per depth on the cluster,
and the root or a common beginning is one row per batch.

Result per node: node (digest; empty for the root), parent, depth, conv_id (smallest member), parent_conv_id, n_convs (members),
n_children, n_leaves (childless nodes of its subtree), saved_tokens (over its subtree, (n_convs - 1) times the words of a node's
last text).  `memberships` gives every conversation's own end node.

Defined cases: null roles and texts are empty; turns come in order of turn (nulls first), then role and text, so repeated rows
are turns of their own; rows without conv_id belong to no conversation; an empty table has no nodes, not even a root; a conversation
rebuilt without turns ends at the root.  Other columns are not touched.  One conversation is one value of 20 bytes a turn; its
texts are only streamed.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table
from .resampling import CRC_TABLE, crc_sql

SIZE = 16
CHAINS = "conv_id long, chain binary, words binary"
PARTIAL = "node binary, parent binary, depth long, batch long, low long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def extended(before: bytes, role: str, text: str) -> bytes:
    data = role.encode("utf-8", "surrogatepass")
    return hashlib.md5(before + len(data).to_bytes(8, "big") + data + text.encode("utf-8", "surrogatepass")).digest()


def count_words(text: str) -> int:
    return len(text.encode("utf-8", "surrogatepass").split())


def frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])


def chains(conversations: DataFrame, family: int = 1, taken: Callable[[int], int] = lambda conv: 0, most_taken: int = 3) -> DataFrame:
    """CHAINS: one row per conversation of conv_id, turn, role, text.

    With a family size, conversation c begins with the first taken(c) turns (`most_taken` at most) of conversation c - c % family,
    in place of as many of its own.  Families are dealt to tasks and streamed, the conversation they begin with at their head.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    ).where("conv_id IS NOT NULL")
    rows = rows.withColumn("first", F.col("conv_id") - F.col("conv_id") % family)

    def streamed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv = line = None
        head, links, words, at, skip = [], bytearray(), [], 0, 0
        for batch in batches:
            done = []
            for first, c, role, text in zip(batch["first"], batch["conv_id"], batch["role"], batch["text"]):
                if c != conv:
                    if conv is not None:
                        done.append((conv, bytes(links), np.array(words, np.int32).tobytes()))
                    if first != line:
                        line, head = first, []
                    conv, at, skip = c, 0, 0 if c == first else taken(c)
                    links, words = bytearray(b"".join(x for x, _ in head[:skip])), [n for _, n in head[:skip]]
                if at >= skip:
                    links += extended(bytes(links[-SIZE:]), role, text)
                    words.append(count_words(text))
                    if c == first and len(head) < most_taken:
                        head.append((bytes(links[-SIZE:]), words[-1]))
                at += 1
            if done:
                yield frame(done, CHAINS)
        if conv is not None:
            yield frame([(conv, bytes(links), np.array(words, np.int32).tobytes())], CHAINS)

    order = ["first", F.col("conv_id") != F.col("first"), "conv_id", F.asc_nulls_first("turn"), "role", "text"]
    dealt = rows.repartition("first").sortWithinPartitions(*order)
    return dealt.select("first", "conv_id", "role", "text").mapInPandas(streamed, CHAINS)


def memberships(chained: DataFrame) -> DataFrame:
    """conv_id and node, the end of the conversation, for every conversation."""
    return chained.select("conv_id", F.substring("chain", -SIZE, SIZE).alias("node"))


def shared_turns(a: bytes, b: bytes) -> int:
    """Turns that two chains have in common."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // SIZE
    return int((np.frombuffer(a, np.uint64, n // 8) != np.frombuffer(b, np.uint64, n // 8)).argmax()) * 8 // SIZE


def peel(rows: pd.DataFrame, known: np.ndarray, ends_line: np.ndarray, batch: int) -> pd.DataFrame:
    """PARTIAL nodes of sorted distinct chains, from the longest turn to the root.

    known: turns that each chain shares with the one before it.  ends_line: whether no chain continues it.
    """
    data = b"".join(rows["chain"])
    digests, halves = np.frombuffer(data, f"V{SIZE}"), np.frombuffer(data, np.uint64).reshape(-1, SIZE // 8)
    turn_words = np.frombuffer(b"".join(rows["words"]), np.int32).astype(np.int64)
    lengths = np.array([len(c) // SIZE for c in rows["chain"]], np.int64)
    begins = np.cumsum(lengths) - lengths
    by_length = np.argsort(lengths, kind="stable")
    bounds = np.searchsorted(lengths[by_length], np.arange(lengths.max() + 2))
    copies, low = rows["copies"].to_numpy(np.int64), rows["low"].to_numpy(np.int64)

    at = np.zeros(0, np.int64)  # the first chain of each surviving node, in order
    sums = np.zeros((5, 0), np.int64)  # n_convs, n_leaves, words of members, words of distinct nodes, low
    out = []
    for d in range(int(lengths.max()), -1, -1):
        ended = by_length[bounds[d] : bounds[d + 1]]
        fresh = np.stack([copies[ended], ends_line[ended].astype(np.int64), np.zeros_like(ended), np.zeros_like(ended), low[ended]])
        spots = np.concatenate([ended, at])
        order = np.argsort(spots, kind="stable")
        spots, merged = spots[order], np.concatenate([fresh, sums], axis=1)[:, order]
        child = np.concatenate([np.zeros(len(ended), bool), known[at] <= d])[order]  # a child not met before
        starts = np.zeros(1, np.int64)
        if d:
            keys = halves[begins[spots] + d - 1]
            starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
        at = spots[starts]
        sums = np.concatenate([np.add.reduceat(merged[:4], starts, axis=1), np.minimum.reduceat(merged[4:], starts, axis=1)])
        if d:
            words = turn_words[begins[at] + d - 1]
            sums[2] += sums[0] * words
            sums[3] += np.where(known[at] < d, words, 0)
        names = digests[begins[at] + d - 1].tolist() if d else [b""]
        parents = digests[begins[at] + d - 2].tolist() if d > 1 else [b"" if d else None] * len(at)
        out.append((names, parents, np.full(len(at), d), sums[4], sums[0], np.add.reduceat(child.astype(np.int64), starts), sums[1], sums[2] - sums[3]))
    columns = [c.split()[0] for c in PARTIAL.split(", ") if not c.startswith("batch")]
    found = {c: [x for part in parts for x in part] if c in ("node", "parent") else np.concatenate(parts) for c, parts in zip(columns, zip(*out))}
    return pd.DataFrame(found | {"batch": batch})[[c.split()[0] for c in PARTIAL.split(", ")]]


def prefix_trie(chained: DataFrame) -> DataFrame:
    """The nodes of CHAINS (see the top): one row each."""
    sequences = chained.groupBy("chain", "words").agg(F.min("conv_id").alias("low"), F.count(F.lit(1)).alias("copies"))
    ranged = cut(sequences.repartitionByRange("chain").sortWithinPartitions("chain").withColumn("part", F.spark_partition_id()))

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known = [shared_turns(a, b) if a is not None else 0 for a, b in zip(batch["before"], batch["head"])]
            goes_on = [b is not None and b.startswith(a) for a, b in zip(batch["tail"], batch["after"])]
            yield pd.DataFrame({"part": batch["part"], "known": known, "goes_on": goes_on})

    along = Window.orderBy("part")  # one row per range
    edges = ranged.groupBy("part").agg(F.min("chain").alias("head"), F.max("chain").alias("tail"))
    edges = edges.withColumns({"before": F.lag("tail").over(along), "after": F.lead("head").over(along)})
    joints = {r.part: (r.known, r.goes_on) for r in edges.mapInPandas(compared, "part int, known long, goes_on boolean").collect()}

    def peeled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept, before, n = None, None, 0
        for batch in batches:
            rows = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
            kept = rows.iloc[-1:]  # whether the last one goes on shows in the next batch
            if len(rows) > 1:
                yield of_batch(rows.iloc[:-1], before, kept["chain"].iloc[0], n)
                before, n = rows["chain"].iloc[-2], n + 1
        if kept is not None and len(kept):
            yield of_batch(kept, before, None, n)

    def of_batch(rows, before, after, n):
        all_chains, part = rows["chain"].tolist(), int(rows["part"].iloc[0])
        first = joints[part][0] if before is None else shared_turns(before, all_chains[0])
        known = np.array([first, *map(shared_turns, all_chains, all_chains[1:])], np.int64)
        last = joints[part][1] if after is None else after.startswith(all_chains[-1])
        goes_on = [b.startswith(a) for a, b in zip(all_chains, all_chains[1:])] + [last]
        return peel(rows, known, ~np.array(goes_on, bool), (part << 32) + n)

    partial = cut(ranged.mapInPandas(peeled, PARTIAL))
    nodes = (
        partial.repartition("node")
        .groupBy("node", "parent", "depth")
        .agg(F.min("batch").alias("batch"), F.min("low").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    )
    # A node's first batch also holds its parent: joined there, the children of one parent do not meet in one task.
    named = nodes.select("node", F.col("conv_id").alias("parent_conv_id"))
    parents = partial.where("n_children > 0").select("batch", "node").join(named, "node").withColumnRenamed("node", "parent")
    found = nodes.join(parents, ["batch", "parent"], "left")
    return found.select("node", "parent", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")


NOTHING = hashlib.sha256(b"").hexdigest()


def end_digests(members: DataFrame) -> DataFrame:
    """node and ends_sha256 over the comma-joined conv_ids that end there, for nodes where any do; ids are streamed in order."""

    def streamed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, state = None, None
        for batch in batches:
            done = []
            for name, conv in zip(batch["node"], batch["conv_id"]):
                if state is not None and name == node:
                    state.update(b",%d" % conv)
                    continue
                if state is not None:
                    done.append((node, state.hexdigest()))
                node, state = name, hashlib.sha256(b"%d" % conv)
            if done:
                yield pd.DataFrame(done, columns=["node", "ends_sha256"])
        if state is not None:
            yield pd.DataFrame([(node, state.hexdigest())], columns=["node", "ends_sha256"])

    return members.repartition("node").sortWithinPartitions("node", "conv_id").mapInPandas(streamed, "node binary, ends_sha256 string")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    chained = cut(chains(table(spark, sf_dir, "conversations"), 20, lambda conv: zlib.crc32(b"%d" % conv) % 4))
    nodes = prefix_trie(chained).join(end_digests(memberships(chained)), "node", "left")
    digest = F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256")
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", digest)


TRIE_SQL = f"""
WITH crc AS ({CRC_TABLE}),
turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {crc_sql("conv_id::VARCHAR", "t")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM turns), crc),
own AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY pos) AS l FROM turns GROUP BY conv_id),
rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.l[:c.h], []), o.l[c.h + 1:]) AS l
    FROM convs c JOIN own o ON o.conv_id = c.conv_id LEFT JOIN own b ON b.conv_id = c.base
),
places AS (SELECT conv_id, len(l) AS length, unnest(range(len(l) + 1)) AS depth, l FROM rebuilt),
cuts AS (SELECT conv_id, length, depth, md5(l[:depth]::VARCHAR) || depth AS node, CASE WHEN depth > 0 THEN md5(l[:depth - 1]::VARCHAR) || (depth - 1) END AS parent,
    CASE WHEN depth > 0 THEN len(regexp_extract_all(l[depth].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words FROM places),
nodes AS (
    SELECT node, parent, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (length = depth), '')) AS ends_sha256
    FROM cuts GROUP BY node, parent, depth
),
kids AS (SELECT parent AS node, count(*) AS n FROM nodes GROUP BY parent),
known AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN kids USING (node)),
below AS (
    SELECT up.node, count(*) FILTER (down.n_children = 0) AS n_leaves, sum((down.n_convs - 1) * down.words)::BIGINT AS saved_tokens
    FROM known down JOIN cuts up ON up.conv_id = down.conv_id AND up.depth <= down.depth GROUP BY up.node
)
SELECT k.conv_id, k.depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, b.n_leaves, b.saved_tokens, k.ends_sha256
FROM known k JOIN below b USING (node) LEFT JOIN nodes p ON p.node = k.parent
"""
