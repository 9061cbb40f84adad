"""N-gram Jaccard join: MinHash banding finds candidates, full n-gram sets decide.

A text's n-grams are its runs of five words (maximal runs without ASCII white space, as they are); a shorter text that has words
is one n-gram.  Two texts are linked if the Jaccard similarity of their n-gram sets is 0.8 or more.

1. Texts with equal n-gram sets are one node.  Each node gets a MinHash signature, cut into bands.  `choose_bands` takes the rows
   per band and then the fewest bands that find a pair at the threshold with the target recall (0.99999 gives 22 bands of 4).
2. Nodes meet in buckets by band hash.  Two that meet are candidates if their sizes allow the threshold and their whole signatures
   agree as often as linked sets do but for a chance of `miss`; so weakly similar texts that share a bucket make no chains.  Each node
   of a bucket is tried with the bucket's smallest node first.  Buckets that still hold several groups are dealt into blocks, where
   only nodes outside the largest group meet all others, and a task returns a spanning forest of the groups, no pairs.
3. Nodes of a candidate group are verified on their full n-gram sets (64-bit hashes of all n-grams), each pair once: inside the
   group, whether or not the two share a bucket.  A large group is dealt into blocks of some 500 texts, and pairs of blocks go to
   separate tasks; a task counts intersections by matrix products and returns a count per text and a spanning forest, no pairs.
4. Verified edges make the classes.  Everything stays on the executors.

Result per row of docs: doc_id; class_id, the smallest doc_id of all rows connected by links; n_links, other rows linked directly
(rows with an equal n-gram set among them); n_text_links, different n-gram sets linked directly.

Defined cases: a null text, or one without words, has no n-grams and no links, and is its own class.  Repeated rows are linked
copies.  Rows without doc_id are linked like all others.  A class of several rows none of which has an id is named by a negative number
made of a digest; a single row without id has no class_id.  Other columns are neither read nor touched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import connected_classes, cut, mixed, sorted_groups, table, unused, window_hashes, word_hashes, words_of
from .minhash_index import match_threshold

#: Work of one block: its texts, each counted as 800 n-grams at least.
BLOCK = 400_000
LEAST = 800

#: Nodes on each side of a meeting inside a bucket.
MEETING = 500


def choose_bands(threshold: float = 0.8, recall: float = 0.99999, most_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows per band): the most rows, for few chance meetings, whose bands reach the recall at the threshold within `most_hashes`."""
    best = None
    for rows in range(1, most_hashes + 1):
        hit = threshold**rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - hit))
        if bands * rows > most_hashes:
            break
        best = bands, rows
    if best is None:
        raise ValueError("no bands reach this recall")
    return best


def gram_set(text: str | None, n: int, hashes) -> np.ndarray:
    """Sorted distinct n-gram hashes."""
    words = words_of(text or "")
    return np.unique(window_hashes(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)), n))


def set_key(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.tobytes())


def signer(bands: int, rows: int, seed: int = 1):
    """grams -> one 64-bit hash per band, and a byte per signature coordinate."""
    rng = np.random.default_rng(seed)
    flips = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)[:, None]
    factors = (rng.integers(0, 1 << 31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
    salt = mixed(np.arange(1, bands + 1, dtype=np.uint64))

    def sign(grams: np.ndarray) -> tuple[np.ndarray, bytes]:
        low = np.full(bands * rows, 0xFFFFFFFF, np.uint32)
        short = (grams >> np.uint64(32)).astype(np.uint32)
        for i in range(0, len(short), 4096):
            np.minimum(low, ((short[None, i : i + 4096] ^ flips) * factors).min(axis=1), out=low)
        out = salt.copy()
        for column in low.reshape(bands, rows).T.astype(np.uint64):
            out = mixed(out * np.uint64(31) + column)
        return out.view(np.int64), ((low * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes()

    return sign


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, h1 and h2 (which tell rows by id and text), node, n_grams, bands, sketch.  node, bands and sketch are null without n-grams."""

    @F.pandas_udf("node binary, n_grams int, bands array<long>, sketch binary")
    def signed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes, sign = word_hashes(), signer(bands, rows)
        for texts in batches:
            found = []
            for text in texts:
                grams = gram_set(text, n, hashes)
                found.append((set_key(grams), len(grams), *sign(grams)) if len(grams) else (None, 0, None, None))
            yield pd.DataFrame(found, columns=["node", "n_grams", "bands", "sketch"])

    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("h1"), F.hash("text").alias("h2"), signed("text").alias("s"))
    return keyed.select("doc_id", "h1", "h2", "s.*")


def sketch_rows(sketches: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1)


def close_groups(meeting: pd.DataFrame, least: int, threshold: float) -> list[tuple[bytes, bytes]]:
    """Edges (a, b) that connect the groups of one meeting whose nodes may be linked."""
    other = meeting["other"].to_numpy(bool)
    left, right = meeting[other], meeting[~other]
    if not len(left) or not len(right):
        return []
    a, b = sketch_rows(left["sketch"]), sketch_rows(right["sketch"])
    names, codes = np.unique(np.concatenate([left["group"], right["group"]]), return_inverse=True)
    of_a, of_b = codes[: len(left)], codes[len(left) :]
    n_a, n_b = left["n_grams"].to_numpy()[:, None], right["n_grams"].to_numpy()[None, :]
    may = (of_a[:, None] != of_b[None, :]) & (np.minimum(n_a, n_b) >= threshold * np.maximum(n_a, n_b) - 1e-9)
    x, y = np.nonzero(may)
    linked = np.zeros((len(names), len(names)), bool)
    for i in range(0, len(x), 65_536):
        p, q = x[i : i + 65_536], y[i : i + 65_536]
        hit = np.count_nonzero(a[p] == b[q], axis=1) >= least
        linked[of_a[p[hit]], of_b[q[hit]]] = True
    return [(names[i], names[r]) for i, r in enumerate(forest(linked | linked.T)) if i != r]


def candidate_groups(nodes: DataFrame, bands: int, rows: int, threshold: float, miss: float = 1e-6) -> DataFrame:
    """(node, class): nodes (node, n_grams, bands, sketch) that share a bucket and may be linked share a class; lone nodes are left out."""
    least = max(1, match_threshold(bands * rows, threshold, miss))
    signed = nodes.select("node", "n_grams", "sketch")
    listed = nodes.select("node", F.explode("bands").alias("bucket"))
    met = listed.groupBy("bucket").agg(F.min("node").alias("head"), F.max("node").alias("high"), F.count("*").alias("n")).where("head <> high").drop("high")
    placed = cut(listed.join(met, "bucket"))

    @F.pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=bool)
        return pd.Series(np.count_nonzero(sketch_rows(a) == sketch_rows(b), axis=1) >= least)

    heads = signed.select(F.col("node").alias("head"), F.col("n_grams").alias("head_n"), F.col("sketch").alias("head_sketch"))
    sized = F.least("n_grams", "head_n") >= F.lit(threshold) * F.greatest("n_grams", "head_n") - 1e-9
    tried = placed.where("node <> head").select("node", "head").distinct().join(signed, "node").join(heads, "head").where(sized)
    groups = connected_classes(tried.where(alike("sketch", "head_sketch")).select(F.col("node").alias("a"), F.col("head").alias("b")))

    grouped = placed.where("n > 2").join(groups, "node", "left").select("bucket", "node", F.coalesce("class", "node").alias("group"))
    sizes = grouped.groupBy("bucket", "group").agg(F.count("*").alias("n")).groupBy("bucket").agg(F.max_by("group", F.struct("n", "group")).alias("major"), F.sum("n").alias("n"), F.max("n").alias("most"))
    open_buckets = sizes.where("n > most").select("bucket", "major", F.ceil((F.col("n") - F.col("most")) / MEETING).cast("int").alias("wide"), F.ceil(F.col("n") / MEETING).cast("int").alias("deep"))
    block = lambda count: F.pmod(F.xxhash64("node"), F.col(count)).cast("int")
    up_to = lambda count: F.sequence(F.lit(0), F.col(count) - 1)
    as_one_of_all = F.transform(up_to("wide"), lambda i: F.struct(i.alias("i"), block("deep").alias("j"), F.lit(False).alias("other")))
    as_other = F.transform(up_to("deep"), lambda j: F.struct(block("wide").alias("i"), j.alias("j"), F.lit(True).alias("other")))
    seats = F.when(F.col("group") == F.col("major"), as_one_of_all).otherwise(F.concat(as_one_of_all, as_other))
    keys = ["bucket", "i", "j"]
    meetings = grouped.join(open_buckets, "bucket").join(signed, "node").withColumn("seat", F.explode(seats)).select("bucket", "seat.*", "group", "n_grams", "sketch")

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for meeting in sorted_groups(batches, keys):
            if edges := close_groups(meeting, least, threshold):
                yield pd.DataFrame(edges, columns=["a", "b"])

    between = connected_classes(meetings.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(joined, "a binary, b binary"))
    lone = between.join(groups, "node", "left_anti").select("node", F.col("node").alias("class"))
    upper = between.select(F.col("node").alias("class"), F.col("class").alias("top"))
    return groups.unionByName(lone).join(upper, "class", "left").select("node", F.coalesce("top", "class").alias("class"))


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all left with all right sets, by matrix products over the n-grams that both sides hold."""
    a, b = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(a, b)
    out = np.zeros((len(left), len(right)), np.float32)
    of_a, of_b = np.repeat(np.arange(len(left)), [len(x) for x in left]), np.repeat(np.arange(len(right)), [len(x) for x in right])
    spots = []
    for grams, owner in ((a, of_a), (b, of_b)):
        at = np.searchsorted(both, grams)
        hit = at < len(both)
        hit[hit] = both[at[hit]] == grams[hit]
        order = np.argsort(at[hit], kind="stable")
        spots.append((at[hit][order], owner[hit][order]))
    for start in range(0, len(both), 4096):
        sides = []
        for (at, owner), count in zip(spots, out.shape):
            i, j = np.searchsorted(at, [start, start + 4096])
            side = np.zeros((count, min(4096, len(both) - start)), np.float32)
            side[owner[i:j], at[i:j] - start] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out


def forest(linked: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each index over a symmetric matrix of links."""
    root = np.arange(len(linked))
    while True:
        low = np.minimum(root, np.where(linked, root[None, :], len(linked)).min(axis=1, initial=len(linked)))
        low = low[low]
        if (low == root).all():
            return root
        root = low


def verify(rows: pd.DataFrame, p: int, q: int, n: int, threshold: float, hashes) -> pd.DataFrame:
    """Links between blocks p and q of a candidate group (inside p, if equal): a count per node, and edges that connect them."""
    sets, copies, block = {}, {}, {}
    for node, text, k, b in zip(rows["node"], rows["text"], rows["copies"], rows["block"]):
        if bytes(node) not in sets and set_key(grams := gram_set(text, n, hashes)) == bytes(node):
            sets[bytes(node)], copies[bytes(node)], block[bytes(node)] = grams, k, b
    left = [x for x in sets if block[x] == p]
    right = left if p == q else [x for x in sets if block[x] == q]
    if not left or not right:
        return pd.DataFrame({"node": [], "other": [], "links": [], "text_links": []})
    common = intersections([sets[x] for x in left], [sets[x] for x in right]).astype(np.int64)
    sizes = np.array([len(sets[x]) for x in left])[:, None] + np.array([len(sets[x]) for x in right])[None, :]
    linked = common >= threshold * (sizes - common) - 1e-9
    out = []
    if p == q:
        np.fill_diagonal(linked, False)
        root = forest(linked)
        out += [(left[i], left[r], 0, 0) for i, r in enumerate(root) if i != r]
        sides = ((left, linked, left),)
    else:
        both = np.zeros((len(left) + len(right),) * 2, bool)
        both[: len(left), len(left) :], both[len(left) :, : len(left)] = linked, linked.T
        names = left + right
        out += [(names[i], names[r], 0, 0) for i, r in enumerate(forest(both)) if i != r]
        sides = ((left, linked, right), (right, linked.T, left))
    for own, matrix, others in sides:
        weights = np.array([copies[x] for x in others], np.int64)
        out += [(x, None, int(weights[row].sum()), int(row.sum())) for x, row in zip(own, matrix) if row.any()]
    return pd.DataFrame(out, columns=["node", "other", "links", "text_links"])


def ngram_classes(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.99999) -> DataFrame:
    """doc_id, h1, h2, class_id, n_links, n_text_links of every row of docs (doc_id, text)."""
    bands, rows = choose_bands(threshold, recall)
    keyed = cut(signatures(docs, n, bands, rows))
    some = keyed.where("node is not null").groupBy("node")
    nodes = cut(some.agg(F.min("doc_id").alias("doc"), F.min(F.struct("h1", "h2")).alias("row"), F.count("*").alias("copies"), F.first(F.struct("n_grams", "bands", "sketch")).alias("s")).select("node", "doc", "row", "copies", "s.*"))
    candidates = candidate_groups(nodes, bands, rows, threshold)

    members = cut(candidates.join(nodes.drop("bands", "sketch"), "node"))
    work = F.greatest(F.col("n_grams"), F.lit(LEAST))
    spread = members.groupBy("class").agg(F.ceil(F.sum(work) / BLOCK).cast("int").alias("blocks"))
    placed = members.join(spread, "class").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    texts = docs.select(F.struct(F.xxhash64("doc_id", "text").alias("h1"), F.hash("text").alias("h2")).alias("row"), "text")
    meeting = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.struct(F.least(i, "block").alias("p"), F.greatest(i, "block").alias("q"))))
    of_members = texts.join(placed, "row").dropDuplicates(["row"])  # one text of repeated rows
    pairs = of_members.select("class", "node", "text", "copies", "block", meeting.alias("m")).select("class", "m.p", "m.q", "node", "text", "copies", "block")
    keys = ["class", "p", "q"]

    def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = word_hashes()
        for group in sorted_groups(batches, keys):
            yield verify(group, int(group["p"].iloc[0]), int(group["q"].iloc[0]), n, threshold, hashes)

    found = cut(pairs.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(verified, "node binary, other binary, links long, text_links long"))
    classes = connected_classes(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = classes.join(nodes, "node")
    ids = named.groupBy("class").agg(F.min("doc").alias("class_id"))
    counts = found.where("other is null").groupBy("node").agg(F.sum("links").alias("links"), F.sum("text_links").alias("text_links"))
    linked = named.join(ids, "class").join(counts, "node", "left").select("node", "class", "class_id", "links", "text_links")
    several = F.col("class").isNotNull() | (F.col("copies") > 1)
    without_id = F.when(several, -1 - F.pmod(F.xxhash64(F.coalesce("class", "node")), F.lit(1 << 62))).try_cast(docs.schema["doc_id"].dataType)
    stats = nodes.join(linked, "node", "left").select(
        "node",
        F.coalesce("class_id", "doc", without_id).alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("text_links", F.lit(0)).alias("n_text_links"),
    )
    wordless = keyed.where("node is null").select("doc_id", "h1", "h2", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(0).cast("long").alias("n_text_links"))
    rest = keyed.where("node is not null").select("doc_id", "h1", "h2", "node").join(stats, "node").drop("node")
    return rest.unionByName(wordless)


def ngram_join(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.99999) -> DataFrame:
    return ngram_classes(docs, n, threshold, recall).select("doc_id", "class_id", "n_links", "n_text_links")


def keep_one(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.99999) -> DataFrame:
    """One row of each class of docs, the one with the smallest doc_id, with its columns as they were.

    Rows without words stay; of a class without ids one row stays; of repeated rows (equal doc_id and text) one stays.
    """
    h1, h2 = unused(docs, "h1"), unused(docs, "h2")
    classes = ngram_classes(docs, n, threshold, recall)
    pick = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "h1", "h2")
    alone = F.when(F.col("class_id").isNull() | ((F.col("n_links") == 0) & (F.col("class_id") == F.col("doc_id"))), F.col("h1"))
    kept = classes.groupBy("class_id", alone.alias("alone")).agg(F.min(pick).alias("k")).select(F.col("k.h1").alias(h1), F.col("k.h2").alias(h2)).distinct()
    marked = docs.withColumns({h1: F.xxhash64("doc_id", "text"), h2: F.hash("text")})
    return marked.join(kept, [h1, h2], "left_semi").dropDuplicates([h1, h2]).drop(h1, h2)


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))
