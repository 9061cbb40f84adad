"""MinHash near-dedup against all pairs."""

import math
import random
from itertools import combinations

import numpy as np
import pytest

from panelwatch.llm import minhash_index

DOCS = "doc_id long, text string, kept string, nid string, node int, n_shingles string"


def plain(rows, n=3, percent=85):
    sets = []
    for _, text in rows:
        words = [w for w in "".join(c.lower() if c.isascii() else c for c in (text or "")).encode().split()]
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(doc)
    least = {r: min((x for x in found if x is not None), default=None) for r, found in ids.items()}
    named = [least[find(i)] if sets[i] else doc for i, (doc, _) in enumerate(rows)]
    return sorted(((doc, len(sets[i]), named[i], doc == named[i]) for i, (doc, _) in enumerate(rows)), key=str)


def found(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, "x", "y", 1, "z") for i, t in rows], DOCS)
    return sorted((tuple(r) for r in minhash_index.near_copies(docs, **options).collect()), key=str)


def prose(rng, n):
    return [rng.choice("abcdefghij") + str(rng.randint(0, 400)) for _ in range(n)]


def corpus():
    """Clusters of all kinds: copies, stars, chains of texts of which only neighbours are linked, pairs just off, common passages."""
    rng = random.Random(4)
    texts = [" ".join(prose(rng, rng.choice([3, 20, 90]))) for _ in range(60)]
    passage = prose(rng, 40)
    texts += [" ".join(passage + prose(rng, rng.choice([5, 30]))) for _ in range(30)]
    base = prose(rng, 120)
    for i in range(25):  # near copies of one text
        copy = list(base)
        copy[rng.randrange(120)] = f"new{i}"
        texts.append(" ".join(copy))
    line = prose(rng, 400)
    texts += [" ".join(line[i : i + 100]) for i in range(0, 290, 5)]  # each linked with its neighbours alone
    texts += [" ".join(line[i : i + 100]) for i in range(300, 400, 40)]
    texts += [texts[0]] * 20 + [texts[-1].upper()] * 3 + ["one", "two words", "one", "Two  words", " ", "", None, "É é", "é É", "long tail " * 20_000]
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows + [(None, texts[0]), (None, "id less text here"), (None, "id less text here"), (None, None), rows[0], rows[0]]


@pytest.mark.parametrize("block", [500, 4])
def test_components_agree_with_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(minhash_index, "BLOCK", block)
    rows = corpus()
    assert found(spark, rows) == plain(rows)


def test_other_settings(spark):
    rows = corpus()[:90]
    assert found(spark, rows, n=2, percent=60, k=64, miss=1e-7) == plain(rows, 2, 60)
    with pytest.raises(ValueError):
        found(spark, rows, k=65)


def test_no_rows_and_no_words(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, ""), (2, None), (None, " ")]) == sorted([(1, 0, 1, True), (2, 0, 2, True), (None, 0, None, True)], key=str)


def test_match_threshold_and_collision_rate():
    for k, jaccard, miss in ((64, 0.85, 1e-6), (32, 0.5, 1e-3), (10, 0.9, 0.5)):
        least = minhash_index.match_threshold(k, jaccard, miss)
        below = lambda t: sum(math.comb(k, x) * jaccard**x * (1 - jaccard) ** (k - x) for x in range(t))
        assert below(least) <= miss < below(least + 1)
    rng = np.random.default_rng(1)
    sketch, shares = minhash_index.sketcher(64), []
    for _ in range(200):
        both, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (850, 75, 75))
        shares.append((sketch(np.concatenate([both, a])) == sketch(np.concatenate([both, b]))).mean())
    assert abs(np.mean(shares) - 0.85) < 0.01 and min(shares) * 64 >= 39


def test_a_large_class_beside_a_few_is_not_multiplied(spark):
    """500 near copies and two strangers in one list: rows stay near the list's length."""
    met = spark.range(502).selectExpr("7L AS pair", "id AS nid", "1L AS mask", "0L AS head", "502L AS n")
    classes = spark.range(500).selectExpr("id AS node", "0L AS class")
    signed = spark.range(502).selectExpr("id AS nid", "10L AS n_shingles", "array(7) AS sketch")
    assert minhash_index.meetings(met, classes, signed).count() <= 502 + 2 * 2
    alone = met.where("nid < 500")
    assert minhash_index.meetings(alone, classes, signed).count() == 0
