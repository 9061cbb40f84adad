"""Importance resampling against a plain reading of its definition."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa

from panelwatch.llm import resampling

DOCS = "doc_id long, text string, rank string, score string, n_words string, _place int"


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def plain(rows, target, percent=25, buckets=10_000, seed=7, least=20):
    """(doc_id, n_features, weight, score, rank) by row."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, text in rows for f in features(text)[1])
    t = Counter(bucket(f) for text in target for f in features(text)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    scored = []
    for doc, text in rows:
        words, found = features(text)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((doc, len(found), weight, score, len(words) >= least))
    order = sorted((i for i, r in enumerate(scored) if r[4]), key=lambda i: (-scored[i][3], scored[i][0] is None, scored[i][0] or 0))
    rank = {i: k + 1 for k, i in enumerate(order[: percent * len(order) // 100])}
    return [(*r[:4], rank.get(i)) for i, r in enumerate(scored)]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z", 5) for i, t in rows], DOCS)


def found(spark, rows, target, **options):
    out = resampling.resample(docs(spark, rows), spark.createDataFrame([(t,) for t in target], "text string"), **options)
    assert out.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in out.collect()), key=str)


def test_all_rows_agree_with_plain_python(spark):
    rng = random.Random(3)
    bits = ["math", "Proof", "LEMMA", "chat", "buy", "ÉTÉ", "日本", "a1", "x y", "Äİ", "ſ"]
    marks = [" ", "\n", "\t", "--", "'", "\x00", "\x7f", "  ", "_", "@"]
    text = lambda n: "".join(rng.choice(bits) + rng.choice(marks) for _ in range(n))
    rows = [(i, text(rng.choice([0, 1, 5, 19, 20, 60]))) for i in range(300)]
    rows += [(None, text(40)), (None, None), (301, None), (302, ""), (303, " \n "), (5, rows[5][1]), (304, "lemma " * 30_000), (305, "z" * 50_000), (306, "buy " * 20), (306, "buy " * 20)]
    target = [text(30) + " lemma proof math" * 20, "lemma", None, "", "日本"]
    assert found(spark, rows, target) == sorted(plain(rows, target), key=str)
    assert found(spark, rows, target, percent=100, buckets=50, seed=9, least_words=1) == sorted(plain(rows, target, 100, 50, 9, 1), key=str)


def test_ties_go_to_smaller_ids_across_ranges(spark):
    rows = [(7, "same words here " * 10)] * 40 + [(i, "same words here " * 10) for i in range(200)]
    got = found(spark, rows, ["words"], percent=60)
    assert got == sorted(plain(rows, ["words"], 60), key=str)
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 60 * 240 // 100 + 1))


def test_empty_tables_and_nothing_to_draw(spark):
    assert found(spark, [], ["a"]) == [] and found(spark, [], []) == []
    short = [(i, "few words") for i in range(9)]
    assert found(spark, short, []) == sorted(plain(short, []), key=str)
    assert all(r[4] is None for r in found(spark, [(1, "w " * 30)], ["w"]))  # a quarter of one document is none


def test_pieces_cover_a_batch(monkeypatch):
    monkeypatch.setattr(resampling, "PIECE", 10)
    texts = pa.array(["aaaa", None, "b" * 30, "", "cc dd", "ee", "ff gg hh ii"])
    assert [x for p in resampling.pieces(texts) for x in p.to_pylist()] == texts.to_pylist()
    whole = resampling.bucketed(texts, 1000)
    parts = [resampling.bucketed(p, 1000) for p in resampling.pieces(texts)]
    assert sorted(whole[0]) == sorted(x for p in parts for x in p[0]) and list(whole[2]) == [x for p in parts for x in p[2]]
