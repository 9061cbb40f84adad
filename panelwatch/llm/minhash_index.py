"""MinHash near-dedup by an inverted index of signature coordinates.

A text's set is its distinct runs of three words (A-Z lower-cased; a shorter text is one run).  Two texts are linked if the Jaccard
similarity of their sets is `threshold` or more; connected texts are one component.

1. Texts with equal sets are one node, with a MinHash signature of `k` coordinates.  Linked nodes agree on at least `least` of them
   but for a chance of `miss` (`match_threshold`: 39 of 64 for 0.85 and one in a million).
2. Postings: every (coordinate, value) pair lists its nodes.  Pairs with one node go; a node left with fewer than `least` has no partner.
   A node's other pairs are put in one global order, rarest first, and all but its last `least - 1` are its prefix: two nodes that agree
   on `least` pairs meet in a list of prefixes, so the most frequent lists are skipped.
3. Every node of a list is compared with the list's smallest node: collisions of the whole signatures are counted, pairs below `least`
   go, the rest are confirmed on full sets.  Confirmed links make classes: of a list of near copies, this leaves one class.
4. Only lists that still hold several classes are merged in full, in blocks of BLOCK nodes, and there only pairs of different classes
   count; each pair is looked at in the list of its first common coordinate.  A task says which nodes have such pairs, their sets
   are fetched, and links are confirmed in place; so no step emits the pairs of a group.

Result per row of docs: doc_id, n_shingles, component_id (smallest doc_id of its component), kept (doc_id is the component's).

Defined cases: a null text, or one without words, has an empty set, links with nothing and is kept.  Repeated rows are copies; rows with
the smallest doc_id are all kept.  Rows without doc_id are linked like all others; a component without any id has no component_id
and its rows are kept.  An empty table gives an empty result.  Other columns are neither read nor touched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import connected_classes, cut, sorted_groups, table, window_hashes, word_hashes

#: Nodes of a list, or partners of a node, that one task takes at a time.
BLOCK = 500


def match_threshold(k: int, jaccard: float, miss: float) -> int:
    """The most coordinates on which sets of this similarity agree with a chance of 1 - miss."""
    below = 0.0
    for x in range(k + 1):
        below += math.comb(k, x) * jaccard**x * (1 - jaccard) ** (k - x)
        if below > miss:
            return x
    return k


def shingles(text: str | None, n: int, hashes) -> np.ndarray:
    """Sorted distinct hashes of all runs of n words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and spaces only
    return np.unique(window_hashes(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)), n))


def set_digest(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def sketcher(k: int, seed: int = 13):
    """set -> the smallest value of each of k hash functions."""
    rng = np.random.default_rng(seed)
    flips = rng.integers(0, 1 << 63, k, dtype=np.uint64)[:, None]
    factors = (rng.integers(0, 1 << 63, k, dtype=np.uint64) | np.uint64(1))[:, None]

    def sketch(found: np.ndarray) -> np.ndarray:
        low = np.full(k, 0xFFFFFFFF, np.uint64)
        for i in range(0, len(found), 2048):
            np.minimum(low, (((found[None, i : i + 2048] ^ flips) * factors) >> np.uint64(32)).min(axis=1), out=low)
        return low.astype(np.uint32).view(np.int32)

    return sketch


def sketches(docs: DataFrame, n: int, k: int) -> DataFrame:
    """doc_id, h1 and h2 (which tell rows by id and text), node (null without words), n_shingles, sketch."""

    @F.pandas_udf("node binary, n_shingles long, sketch array<int>")
    def sketched(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes, sketch = word_hashes(), sketcher(k)
        for texts in batches:
            rows = []
            for text in texts:
                found = shingles(text, n, hashes)
                rows.append((set_digest(found), len(found), sketch(found)) if len(found) else (None, 0, None))
            yield pd.DataFrame(rows, columns=["node", "n_shingles", "sketch"])

    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("h1"), F.hash("text").alias("h2"), sketched(F.col("text").cast("string")).alias("s"))
    return keyed.select("doc_id", "h1", "h2", "s.*")


def prefix_postings(nodes: DataFrame, least: int) -> DataFrame:
    """(pair, nid, mask): the postings of all prefixes; mask has a bit for each coordinate of the node's prefix."""
    postings = nodes.select("nid", F.posexplode("sketch").alias("j", "v")).selectExpr("nid", "shiftleft(cast(j AS long), 32) | (cast(v AS long) & 4294967295) AS pair")
    lists = postings.groupBy("pair").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    held = postings.join(lists.hint("merge"), "pair").groupBy("nid").agg(F.array_sort(F.collect_list(F.struct("n", "pair"))).alias("held"))  # at most k
    prefix = held.where(F.size("held") >= least).selectExpr("nid", f"slice(held, 1, size(held) - {least - 1}).pair AS prefix")
    bits = "aggregate(prefix, 0L, (m, p) -> m | shiftleft(1L, cast(shiftright(p, 32) AS int))) AS mask"
    return prefix.selectExpr("nid", bits, "explode(prefix) AS pair")


def sets_of(nodes: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """(nid, grams): the full sets of nodes (nid, h1, h2)."""

    @F.pandas_udf("binary")
    def grams(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes = word_hashes()
        for texts in batches:
            yield pd.Series([shingles(text, n, hashes).tobytes() for text in texts], dtype=object)

    texts = docs.select(F.xxhash64("doc_id", "text").alias("h1"), F.hash("text").alias("h2"), F.col("text").cast("string").alias("text"))
    one = texts.dropDuplicates(["h1", "h2"]).join(nodes.select("nid", "h1", "h2").hint("merge"), ["h1", "h2"])
    return one.select("nid", grams("text").alias("grams"))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, of sorted distinct hashes."""
    if len(a) > len(b):
        a, b = b, a
    spots = np.searchsorted(b, a)
    common = int((b[np.minimum(spots, len(b) - 1)] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def confirmed_with_heads(close: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links (a, b) among pairs (nid, head); partners of one head go to several tasks, BLOCK to each."""
    sizes = close.groupBy("head").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("nid"), F.col("blocks")).cast("int")
    partners = close.join(sizes.hint("merge"), "head").withColumn("block", block).join(sets.hint("merge"), "nid")
    heads = sizes.select(F.col("head").alias("nid"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).join(sets.hint("merge"), "nid")
    both = partners.selectExpr("head", "block", "true AS partner", "nid", "grams").unionByName(heads.selectExpr("nid AS head", "block", "false AS partner", "nid", "grams"))

    def checked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lead = None
        for batch in batches:
            out = []
            for head, partner, nid, grams in zip(batch["head"], batch["partner"], batch["nid"], batch["grams"]):
                found = np.frombuffer(grams, np.uint64)
                if not partner:
                    lead = found
                elif linked(lead, found, percent):
                    out.append((nid, head))
            if out:
                yield pd.DataFrame(out, columns=["a", "b"])

    dealt = both.repartition("head", "block").sortWithinPartitions("head", "block", "partner")
    return dealt.mapInPandas(checked, "a long, b long")


MEETING = "pair long, i int, j int, side int, nid long, class long, other boolean, mask long, n_shingles long, sketch array<int>"


def meetings(met: DataFrame, classes: DataFrame, signed: DataFrame) -> DataFrame:
    """MEETING: the nodes of lists that hold several classes, dealt so that nodes of different classes meet.

    Of two such nodes one is outside the list's largest class.  Those others stand on side 0, in blocks i, and all nodes on side 1, in
    blocks j; so a large class beside a few others is not multiplied.
    """
    placed = met.where("n > 2").join(classes.hint("merge"), met.nid == classes.node, "left").select("pair", "nid", "mask", F.coalesce("class", "nid").alias("class"))
    by_class = placed.groupBy("pair", "class").agg(F.count(F.lit(1)).alias("n"))
    largest = by_class.groupBy("pair").agg(F.max_by("class", F.struct("n", "class")).alias("major"), F.sum("n").alias("n"), F.max("n").alias("most")).where("n > most")
    blocks = largest.selectExpr("pair", "major", f"cast(ceil((n - most) / {BLOCK}) AS int) AS wide", f"cast(ceil(n / {BLOCK}) AS int) AS deep")
    rows = placed.join(blocks.hint("merge"), "pair").withColumn("other", F.expr("class <> major"))
    own = "cast(pmod(xxhash64(nid), {0}) AS int)"
    all_sides = f"transform(sequence(0, wide - 1), x -> struct(x AS i, {own.format('deep')} AS j, 1 AS side))"
    other_side = f"transform(sequence(0, deep - 1), x -> struct({own.format('wide')} AS i, x AS j, 0 AS side))"
    dealt = rows.join(signed.hint("merge"), "nid").withColumn("at", F.expr(f"explode(CASE WHEN other THEN concat({all_sides}, {other_side}) ELSE {all_sides} END)"))
    return dealt.select("pair", "at.i", "at.j", "at.side", "nid", "class", "other", "mask", "n_shingles", "sketch")


def open_pairs(group: pd.DataFrame, least: int, percent: int) -> tuple[pd.DataFrame, pd.DataFrame, np.ndarray]:
    """(side 0, side 1, matrix of the pairs to confirm) of one meeting."""
    left, right = group[group["side"] == 0], group[group["side"] == 1]
    if not len(left) or not len(right):
        return left, right, np.zeros((len(left), len(right)), bool)
    a, b = np.stack(left["sketch"].to_numpy()), np.stack(right["sketch"].to_numpy())
    column = lambda name: (left[name].to_numpy()[:, None], right[name].to_numpy()[None, :])  # noqa: E731
    (mask_a, mask_b), here = column("mask"), int(group["pair"].iloc[0]) >> 32
    agree, before = np.zeros((len(a), len(b)), np.uint8), np.zeros((len(a), len(b)), bool)
    for c in range(a.shape[1]):
        same = a[:, c][:, None] == b[:, c][None, :]
        agree += same
        if c < here:  # the pair meets in an earlier list as well
            before |= same & ((mask_a >> c) & (mask_b >> c) & 1).astype(bool)
    (n_a, n_b), (class_a, class_b), (nid_a, nid_b) = column("n_shingles"), column("class"), column("nid")
    once = ~column("other")[1].astype(bool) | (nid_a < nid_b)
    sized = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    return left, right, (agree >= least) & ~before & (class_a != class_b) & once & sized


def links_between_classes(meeting: DataFrame, sets: DataFrame, least: int, percent: int) -> DataFrame:
    """(a, b): classes that a confirmed link joins, a spanning choice of them per meeting."""
    keys = ["pair", "i", "j"]
    names = [c.split()[0] for c in MEETING.split(", ")]

    def with_partners(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in sorted_groups(batches, keys):
            left, right, found = open_pairs(group, least, percent)
            if found.any():
                yield pd.concat([left[found.any(axis=1)], right[found.any(axis=0)]])[names]

    def confirmed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in sorted_groups(batches, keys):
            left, right, found = open_pairs(group, least, percent)
            top, out = {}, []

            def root(x):
                while top.get(x, x) != x:
                    x = top[x]
                return x

            for x, y in zip(*np.nonzero(found)):
                a, b = root(int(left["class"].iloc[x])), root(int(right["class"].iloc[y]))
                if a != b and linked(np.frombuffer(left["grams"].iloc[x], np.uint64), np.frombuffer(right["grams"].iloc[y], np.uint64), percent):
                    top[a] = b
                    out.append((a, b))
            if out:
                yield pd.DataFrame(out, columns=["a", "b"])

    first = cut(meeting.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(with_partners, MEETING))
    second = first.join(sets.hint("merge"), "nid").select(*names, "grams")
    return second.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(confirmed, "a long, b long")


def near_copies(docs: DataFrame, n: int = 3, percent: int = 85, k: int = 64, miss: float = 1e-6) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of docs (doc_id, text)."""
    if not 1 <= k <= 64:
        raise ValueError("k is the number of bits of a mask at most, 64")
    least = max(1, match_threshold(k, percent / 100, miss))
    keyed = cut(sketches(docs, n, k))
    some = keyed.where("node IS NOT NULL")
    nodes = cut(some.drop("doc_id").dropDuplicates(["node"]).withColumn("nid", F.monotonically_increasing_id()))
    signed = nodes.select("nid", "n_shingles", "sketch")

    postings = cut(prefix_postings(nodes, least))
    lists = postings.groupBy("pair").agg(F.min("nid").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    met = cut(postings.join(lists.hint("merge"), "pair"))

    @F.pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=bool)
        return pd.Series((np.stack(a.to_numpy()) == np.stack(b.to_numpy())).sum(axis=1) >= least)

    heads = signed.selectExpr("nid AS head", "n_shingles AS head_n", "sketch AS head_sketch")
    tried = met.where("nid <> head").select("nid", "head").distinct()
    sized = F.expr(f"100 * least(n_shingles, head_n) >= {percent} * greatest(n_shingles, head_n)")
    pairs = tried.join(signed.hint("merge"), "nid").join(heads.hint("merge"), "head").where(sized)
    close = cut(pairs.where(alike("sketch", "head_sketch")).select("nid", "head"))

    sets = cut(sets_of(met.select("nid").distinct().join(nodes.hint("merge"), "nid"), docs, n))
    classes = connected_classes(confirmed_with_heads(close, sets, percent))
    between = connected_classes(links_between_classes(meetings(met, classes, signed), sets, least, percent))

    upper = between.select(F.col("node").alias("class"), F.col("class").alias("top"))
    ids = some.groupBy("node").agg(F.min("doc_id").alias("least_id"))
    of_node = nodes.select("nid", "node").join(classes.select(F.col("node").alias("nid"), "class"), "nid", "left").withColumn("class", F.coalesce("class", "nid"))
    of_node = of_node.join(upper, "class", "left").select("node", F.coalesce("top", "class").alias("class")).join(ids, "node")
    named = of_node.groupBy("class").agg(F.min("least_id").alias("component_id"))
    component = of_node.join(named, "class").select("node", "component_id")
    result = lambda name: ["doc_id", "n_shingles", F.col(name).alias("component_id"), F.col("doc_id").eqNullSafe(F.col(name)).alias("kept")]  # noqa: E731
    return some.join(component, "node").select(*result("component_id")).unionByName(keyed.where("node IS NULL").select(*result("doc_id")))


def op13_minhash_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"))


NEAR_COPIES_SQL = r"""
WITH RECURSIVE worded AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-]+') AS w
    FROM documents
),
shingled AS (
    SELECT row, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
    FROM worded
),
sets AS (SELECT md5(list_sort(s)::VARCHAR) AS node, any_value(s) AS s, len(any_value(s)) AS n FROM shingled WHERE len(s) > 0 GROUP BY node),
grams AS (SELECT node, n, unnest(s) AS g FROM sets),
links AS (
    SELECT a.node AS a, b.node AS b FROM grams a JOIN grams b ON a.g = b.g AND a.node < b.node AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
    GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
reach(a, b) AS (
    SELECT node, node FROM sets
    UNION
    SELECT r.a, l.b FROM reach r JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) l ON r.b = l.a
),
ids AS (SELECT md5(list_sort(s)::VARCHAR) AS node, min(doc_id) AS doc_id FROM shingled WHERE len(s) > 0 GROUP BY node),
component AS (SELECT r.a AS node, min(i.doc_id) AS component_id FROM reach r JOIN ids i ON i.node = r.b GROUP BY r.a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, CASE WHEN len(s) = 0 THEN doc_id ELSE component_id END AS component_id,
    doc_id IS NOT DISTINCT FROM (CASE WHEN len(s) = 0 THEN doc_id ELSE component_id END) AS kept
FROM shingled LEFT JOIN component ON len(s) > 0 AND component.node = md5(list_sort(s)::VARCHAR)
"""
