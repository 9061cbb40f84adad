"""The prefix trie against nodes built one by one."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from panelwatch.llm import prefix_trie

CHATS = "conv_id long, turn long, role string, text string, node string, depth int, first string"


def heads_by_crc():
    """A function that goes to executors by value: they cannot import this file."""
    return lambda conv: zlib.crc32(str(conv).encode()) % 4


crc_heads = heads_by_crc()


def trunc_base(conv, family):
    return conv - (abs(conv) % family if conv >= 0 else -(abs(conv) % family))


def plain(rows, family=1, taken=lambda conv: 0):
    """{path: (conv_id, parent's conv_id, n_convs, n_children, n_leaves, saved_tokens, ends)}"""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), (role or "").encode(), (text or "").encode()))
    turns = {c: [x[1:] for x in sorted(xs)] for c, xs in own.items()}
    built = {c: turns.get(trunc_base(c, family), [])[: taken(c)] + xs[taken(c) :] for c, xs in turns.items()}
    members = defaultdict(list)
    for c, xs in built.items():
        for d in range(len(xs) + 1):
            members[tuple(xs[:d])].append(c)
    out = {}
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        words = lambda p: len(re.findall(rb"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        saved = sum((len(members[p]) - 1) * words(p) for p in below)
        kids = sum(len(p) == len(path) + 1 for p in below)
        ends = ",".join(map(str, sorted(c for c in convs if len(built[c]) == len(path))))
        out[path] = (min(convs), min(members[path[:-1]]) if path else None, len(convs), kids, len(leaves), saved, ends)
    return sorted((len(p), *v[:6], hashlib.sha256(v[6].encode()).hexdigest()) for p, v in out.items() for p in [p])


def found(spark, rows, family=1, taken=None):
    table = spark.createDataFrame([(*r, "a", 1, "b") for r in rows], CHATS)
    chained = prefix_trie.cut(prefix_trie.chains(table, family, taken) if taken else prefix_trie.chains(table))
    nodes = prefix_trie.prefix_trie(chained).join(prefix_trie.end_digests(prefix_trie.memberships(chained)), "node", "left").collect()
    assert len({r.node for r in nodes}) == len(nodes)
    by_name = {r.node: r for r in nodes}
    assert all(r.parent is None if not r.depth else by_name[r.parent].conv_id == r.parent_conv_id for r in nodes)
    return sorted((r.depth, r.conv_id, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256 or prefix_trie.NOTHING) for r in nodes)


def some_rows(seed, n, common=0.3):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        conv = rng.randint(-25, 90)
        length = rng.choice([1, 1, 2, 3, 5, 12])
        first = [(0, "user", "the common first turn")] if rng.random() < common else []
        rows += [(conv, i, *t) for i, t in enumerate([x[1:] for x in first])]
        rows += [(conv, rng.choice([None, i, i, 2]), rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "a b", None, "", " x\x85y\n z"])) for i in range(length)]
    return rows


@pytest.mark.parametrize("batch,parts", [(10_000, 2), (3, 7), (1, 3)])
def test_nodes_across_batches_and_ranges(spark, batch, parts):
    rows = some_rows(batch, 60) + [(200 + i, j, "user", t) for i in range(40) for j, t in enumerate(["same", "words here", "again"])]
    rows += [(300 + i, 0, "user", "same") for i in range(5)] + [(None, 0, "user", "nobody"), (400, 0, "user", "long " * 50_000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(spark, rows) == plain(rows)
        assert found(spark, rows, 20, crc_heads) == plain(rows, 20, crc_heads)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_conversations_without_turns_and_without_rows(spark):
    lone = next(c for c in range(21, 40) if crc_heads(c))  # its family's first conversation is not there
    rows = [(lone, 0, "user", "taken away")]
    assert found(spark, rows, 20, crc_heads) == plain(rows, 20, crc_heads) == [(0, lone, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]
    assert found(spark, []) == []


def test_one_long_conversation(spark):
    rows = [(c, i, "user", f"turn {i}") for c, n in ((1, 700), (2, 699), (3, 350)) for i in range(n)]
    nodes = found(spark, rows)
    assert [r[0] for r in nodes] == list(range(701)) and nodes[0][5] == 1
    assert nodes[0][6] == sum(2 * (2 if i < 350 else 1) for i in range(699)) and [r[3] for r in nodes[:352:351]] == [3, 2]
