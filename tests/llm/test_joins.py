"""N-gram join, nearest neighbours, packing, sharding and mixing, against plain Python, brute force and SQL."""

import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwatch.llm import ann, mixing, ngram_join, packing, sharding

DOCS = "doc_id long, text string, lang string, source string, class_id string, row long, epoch string, length long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, "c", 5, "e", 9) for i, t, lang, source in rows], DOCS)


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(n))


def edited(text, seed, changes):
    words, rng = text.split(), random.Random(seed)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.random()}"
    return " ".join(words)


# -- n-gram join


def plain_classes(rows):
    """(class_id, n_links, n_text_links) by row, from all pairs."""
    sets = []
    for _, text, *_ in rows:
        w = (text or "").encode().split()
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None)
    n = len(rows)
    near = lambda a, b: a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9
    links = [[j for j in range(n) if j != i and near(sets[i], sets[j])] for i in range(n)]
    parent = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            low = min([parent[i], *(parent[j] for j in links[i])])
            if low < parent[i]:
                parent[i], changed = low, True
    ids = defaultdict(list)
    for i, p in enumerate(parent):
        ids[p].append(rows[i][0])
    return Counter((rows[i][0], min(ids[parent[i]]), len(links[i]), len({sets[j] for j in links[i]} - {sets[i]})) for i in range(n))


def near_copies():
    rows = []
    for g in range(12):
        base = prose(g, 120)
        rows += [(100 * g, base), (100 * g + 1, base), (100 * g + 2, base.replace(" ", "  \n"))]
        rows += [(100 * g + 10 + i, edited(base, 50 * g + i, 1 + i % 4)) for i in range(8)]
    chain = prose(77, 100).split()
    rows += [(5000 + i, " ".join(chain[2 * i : 2 * i + 60])) for i in range(20)]  # neighbours overlap, ends do not
    rows += [(6000, None), (6001, ""), (6002, " \n"), (6003, "tiny text"), (6004, "tiny text"), (6005, "tiny  text"), (6006, "tiny"), (6007, prose(9, 20_000)), (6008, edited(prose(9, 20_000), 1, 5))]
    rows += [(6009, "again and again and again and again"), (6009, "again and again and again and again"), (6010, "w " * 400), (6011, "w " * 300)]
    return [(i, t, "en", "s") for i, t in rows]


@pytest.mark.parametrize("block", [ngram_join.BLOCK, 8_000])
def test_ngram_join_agrees_with_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = near_copies()
    found = ngram_join.ngram_join(documents(spark, rows))
    assert found.columns == ["doc_id", "class_id", "n_links", "n_text_links"]
    assert Counter(map(tuple, found.collect())) == plain_classes(rows)


def test_one_row_of_each_class_stays(spark):
    rows = near_copies()
    classes = {c for _, c, *_ in plain_classes(rows)}
    kept = ngram_join.keep_one(documents(spark, rows))
    assert kept.columns == [c.split()[0] for c in DOCS.split(", ")]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(classes)


def test_ngram_join_without_ids_rows_or_links(spark):
    text = prose(3, 50)
    rows = [(None, text, "en", "s"), (4, text, "en", "s"), (None, prose(4, 50), "en", "s"), (None, None, "en", "s")]
    found = Counter(map(tuple, ngram_join.ngram_join(documents(spark, rows)).collect()))
    assert found == Counter([(None, 4, 1, 0), (4, 4, 1, 0), (None, None, 0, 0), (None, None, 0, 0)])
    assert ngram_join.keep_one(documents(spark, rows)).count() == 3
    assert ngram_join.ngram_join(documents(spark, [])).count() == 0 and ngram_join.keep_one(documents(spark, [])).count() == 0


def test_near_copies_without_ids_are_linked(spark):
    with_ids = near_copies()
    blank = lambda i: None if i < 300 or i % 3 == 0 else i
    rows = [(blank(i), *rest) for i, *rest in with_ids]
    found = ngram_join.ngram_join(documents(spark, rows)).collect()
    links = lambda table: Counter(r[2:] for r in table)
    assert links(map(tuple, found)) == links(plain_classes(with_ids).elements())
    assert all((r.class_id is None) == (r.doc_id is None and r.n_links == 0) for r in found)
    assert len({r.class_id for r in found if r.doc_id is None and r.class_id is not None and r.class_id < 0}) >= 3  # groups 0 to 2 have no id
    classes = len({c for _, c, *_ in plain_classes(with_ids)})
    kept = ngram_join.keep_one(documents(spark, rows)).collect()
    # rows without words and id fold to those that differ
    assert len(kept) == classes - sum(i % 3 == 0 and not (t or "").split() for i, t, *_ in with_ids) + len({t for i, t, *_ in with_ids if i % 3 == 0 and not (t or "").split()})


def test_weakly_similar_texts_make_no_chain(spark):
    words = prose(78, 4_100).split()
    rows = [(i, " ".join(words[20 * i : 20 * i + 60]), "en", "s") for i in range(200)]  # neighbours at 0.47, most of them share a bucket
    bands, width = ngram_join.choose_bands()
    keyed = ngram_join.signatures(documents(spark, rows), 5, bands, width)
    shared = keyed.select("node", F.explode("bands").alias("b")).groupBy("b").count().where("count > 1").count()
    sizes = [r["count"] for r in ngram_join.candidate_groups(keyed, bands, width, 0.8).groupBy("class").count().collect()]
    assert shared > 100 and sum(sizes) < 40 and max(sizes, default=0) <= 4


@pytest.mark.parametrize("meeting", [ngram_join.MEETING, 3])
def test_groups_of_a_bucket_meet_beside_its_smallest_node(spark, monkeypatch, meeting):
    monkeypatch.setattr(ngram_join, "MEETING", meeting)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 256, (4, 88), dtype=np.uint8)
    base[3, :44], base[3, 44:] = base[1, :44], rng.integers(0, 256, 44)  # like family 1 in half of the coordinates
    nodes, expected = [], defaultdict(set)
    for i in range(40):
        family = i % 4
        sketch = base[family].copy()
        sketch[rng.integers(0, 88, 4)] = 7
        size = 1_000 if i == 38 else 100  # the sizes of node 38 and its family forbid a link
        nodes.append((bytes([i] * 16), size, [1, 2 + family], sketch.tobytes()))
        expected["alone" if i == 38 else family].add(bytes([i] * 16))
    bridge = base[1].copy()
    bridge[:30] = base[0, :30]
    nodes += [(bytes([200] * 16), 100, [1], bridge.tobytes())]
    expected[1].add(bytes([200] * 16))
    found = ngram_join.candidate_groups(spark.createDataFrame(nodes, "node binary, n_grams int, bands array<long>, sketch binary"), 22, 4, 0.8)
    classes = defaultdict(set)
    for r in found.collect():
        classes[bytes(r["class"])].add(bytes(r["node"]))
    assert sorted(map(sorted, classes.values())) == sorted(sorted(x) for k, x in expected.items() if k != "alone")


def test_bands_reach_the_recall():
    for recall in (0.9, 0.999, 0.99999):
        bands, rows = ngram_join.choose_bands(0.8, recall)
        assert 1 - (1 - 0.8**rows) ** bands >= recall and bands * rows <= 128
        assert 1 - (1 - 0.8 ** (rows + 1)) ** (128 // (rows + 1)) < recall


# -- nearest neighbours


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2.0) for i, v in rows], "vec_id long, embedding array<float>, label int, block string, score double")


def brute(rows, k=5):
    rows = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v) and len(v) == 16]
    out = {}
    for q, x in rows:
        if q % 50 == 0:
            found = sorted(((-(x @ y) / np.sqrt((x @ x) * (y @ y)), i) for i, y in rows if i != q))
            out[q] = [(i, -s) for s, i in found[:k]]
    return out


def test_nearest_reaches_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 700)
    monkeypatch.setattr(ann, "CHUNK_QUERIES", 20)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 16))
    data = np.float32(centres[rng.integers(0, 8, 2500)] + rng.normal(size=(2500, 16)))
    data[1000:1200] = data[1000]  # one common vector
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    rows += [(9000, None), (9050, []), (9100, [0.0] * 16), (9150, [float("nan")] + [1.0] * 15), (9200, [None] + [1.0] * 15), (9250, [float("inf")] * 16), (9300, [1.0] * 15), (None, [1.0] * 16)]
    truth = brute(rows)
    found = defaultdict(list)
    for r in ann.nearest(vectors(spark, rows), F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(found[r.query_id]) + 1
        found[r.query_id].append((r.vec_id, r.score))
    assert found.keys() == truth.keys() and all(len(v) == 5 for v in found.values())
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in truth[q]}) for q in truth)
    assert hits >= 0.9 * 5 * len(truth)
    assert [i for i, _ in found[1000]] == [1001, 1002, 1003, 1004, 1005]  # ties go to the smaller id
    plain = {i: np.float32(v).astype(float) for i, v in rows[:2500]}
    for q, best in found.items():
        for i, score in best:
            assert score == pytest.approx(plain[q] @ plain[i] / np.linalg.norm(plain[q]) / np.linalg.norm(plain[i]), abs=1e-12)


def test_nearest_of_few_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])]
    assert [(r.vec_id, round(r.score, 6)) for r in ann.nearest(vectors(spark, rows), F.col("vec_id") == 0).orderBy("rank").collect()] == [(1, 0.707107), (2, 0.0)]
    assert ann.nearest(vectors(spark, []), F.col("vec_id") == 0).count() == 0
    assert ann.nearest(vectors(spark, rows[:1]), F.col("vec_id") == 0).count() == 0


def test_repeated_rows_take_no_places(spark, monkeypatch):
    rng = np.random.default_rng(9)
    data = np.float32(rng.normal(size=(60, 16)))
    data[7] = data[0] * np.float32(1.01)
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    for block_rows in (8_192, 20):
        monkeypatch.setattr(ann, "BLOCK_ROWS", block_rows)
        answer = lambda some: [tuple(r)[:3] for r in ann.nearest(vectors(spark, some), F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()]  # noqa: E731, B023
        once = answer(rows)
        assert len(once) == 10 and once[0] == (0, 1, 7)
        assert answer(rows + [rows[7]] * 5 + [rows[0]] * 3 + [rows[50]]) == once
    few = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (0, [2.0, 0.0])]
    assert [tuple(r)[:3] for r in ann.nearest(vectors(spark, few), F.col("vec_id") == 0).orderBy("rank").collect()] == [(0, 1, 1), (0, 2, 1), (0, 3, 2)]


@pytest.mark.parametrize("power", [0, 200, -200])
def test_nearest_of_very_large_and_small_components(spark, power):
    big = 10.0**power
    rows = [(0, [big, 0.0]), (1, [big, big / 10]), (2, [big, big]), (3, [1.0, 0.0]), (4, [0.0, big])]
    found = [(r.vec_id, round(r.score, 6)) for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0).orderBy("rank").collect()]
    assert found == [(3, 1.0), (1, 0.995037), (2, 0.707107), (4, 0.0)]


def test_probing_meets_every_code_in_the_radius():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 256, (3000, 8), dtype=np.uint8)
    for radius in (0, 7, 8, 20, 27):
        tables = ann.Tables(codes, radius)
        for query in codes[:10]:
            want = np.flatnonzero(np.bitwise_count(codes ^ query).sum(axis=1) <= radius)
            assert (tables.within(query) == want).all()


# -- packing


def test_plan_places_every_piece_once_and_tightly():
    rng = random.Random(3)
    for case in range(60):
        capacity = rng.choice([10, 64, 2048])
        sizes = Counter(rng.choice([rng.randint(1, capacity), rng.randint(1, max(1, capacity // 6)), capacity // 2, capacity // 3 + 1]) for _ in range(rng.randint(0, 400)))
        filled = defaultdict(list)
        seen = defaultdict(list)
        for length, first, count, sequence, each, offset in packing.plan(sizes, capacity):
            for j in range(count):
                filled[sequence + j // each].append((offset + j % each * length, length))
                seen[length].append(first + j)
        assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(n)) for k, n in sizes.items()}
        for parts in filled.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity and sum(x > capacity // 3 for _, x in parts) <= 2
        bound = -(-sum(k * n for k, n in sizes.items()) // capacity)
        assert len(filled) <= max(bound, sum(n for k, n in sizes.items() if 2 * k > capacity)) * 1.25 + 2
        assert set(filled) == set(range(len(filled)))


def test_packing_reads_back_as_the_tokenizer_says(spark):
    from tokenizers import Tokenizer

    rows = [(i, prose(i, 30 + 40 * i), "en", "s") for i in range(40)]
    rows += [(100, None, "en", "s"), (101, "", "en", "s"), (102, "w " * 9000, "en", "s"), (103, "日本 Ünï'll <|endoftext|> x\x1cy 12³", "en", "s"), (104, "x" * 5000, "en", "s")]
    tokens = Tokenizer.from_file(packing.tokenizer_path())
    docs = documents(spark, rows)
    found = packing.packed(docs).collect()
    sequences = {r.sequence_id: np.frombuffer(bytes(r.ids), "<u4") for r in packing.assembled(packing.pieces_of(docs, packing.tokenizer_path()), packing.packed(docs)).collect()}
    by_doc = defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append(r)
    for doc_id, text, *_ in rows:
        ids = np.array(tokens.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        own = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // 2048))) and sum(r.length for r in own) == len(ids)
        for r in own:
            part = ids[r.start : r.start + r.length]
            assert r.start == 2048 * r.piece and r.ids_crc32 == zlib.crc32(part.tobytes())
            assert (sequences[r.sequence_id][r.offset : r.offset + r.length] == part).all()
    assert len(sequences) == -(-sum(r.length for r in found) // 2048)


def test_packing_of_repeats_and_nothing(spark):
    rows = [(None, "a b", "en", "s"), (1, "a b", "en", "s"), (1, "a b", "en", "s")]
    found = packing.packed(documents(spark, rows)).collect()
    assert sorted(r.offset for r in found) == [0, 3, 6] and {r.sequence_id for r in found} == {0}
    assert packing.packed(documents(spark, [])).count() == 0


def test_word_tokens_equal_the_whole_tokenizer():
    from tokenizers import Tokenizer

    whole, words = Tokenizer.from_file(packing.tokenizer_path()), packing.WordTokens(packing.tokenizer_path())
    rng = random.Random(1)
    pool = "abcXYZ éÉß'sIΣσςİıſǅ0²½ÀÿŸ\x1c\x85\xa0 　…—'re ’<|endoftext|><|\t\n.,!ẞK日本́é​\xadªº_ŉ"
    for _ in range(5000):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 25)))
        assert np.frombuffer(words.ids(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


# -- sharding


def plain_position(row, n, seed=11):
    a, b = sharding.halves(n)
    prime, factor = sharding.PRIME, sharding.FACTOR

    def mix(x, key):
        y = (x + key) % prime
        return (y * y % prime * factor + x) % prime

    while True:
        left, right = divmod(row, b)
        for i, key in enumerate(sharding.round_keys(seed)):
            if i % 2 == 0:
                left = (left + mix(right, key)) % a
            else:
                right = (right + mix(left, key)) % b
        row = left * b + right
        if row < n:
            return row


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 100, 1000, 1023])
def test_positions_are_the_plain_permutation(spark, n):
    found = {r.id: r.p for r in spark.range(n).select("id", sharding.position(F.col("id"), n, 11).alias("p")).collect()}
    assert sorted(found.values()) == list(range(n))
    assert found == {i: plain_position(i, n) for i in range(n)}


def test_shards_are_level_gapless_and_reproducible(spark):
    rows = [(i if i % 7 else None, None if i % 11 == 0 else "" if i % 13 == 0 else f"täxt {i % 50}", "en", "s") for i in range(500)] + [(1, "same", "en", "s")] * 300
    found = sharding.sharded(documents(spark, rows)).collect()
    again = sharding.sharded(documents(spark, rows[::-1]).repartition(7)).collect()
    assert Counter(found) == Counter(again)
    assert sorted(r.row for r in found) == list(range(800))
    by_shard = defaultdict(list)
    for r in found:
        by_shard[r.shard].append(r.slot)
        assert divmod(plain_position(r.row, 800), 16) == (r.slot, r.shard)
    assert all(sorted(s) == list(range(50)) for s in by_shard.values()) and len(by_shard) == 16
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == want
    assert sharding.sharded(documents(spark, [])).count() == 0


# -- mixing

MIX = mixing.Mix({"domain": {"web": 3, "none": 0}, "lang": {"en": 2, "xx": 0}, "source": {"s1": 5}}, 90, 3, 5, {"web": ["s0", "s1"], "none": ["s9"]})


def mix_rows():
    rng = random.Random(8)
    rows = [(i, None if i % 41 == 0 else "" if i % 43 == 0 else " " + prose(i, rng.randint(1, 80)) + "\n", rng.choice(["en", "en", "de", "xx", None]), rng.choice(["s0", "s0", "s0", "s1", "s2", "s9", None])) for i in range(600)]
    return rows + [(5, "a b c", "en", "s0")] * 4 + [(None, "a b", "en", "s2"), (700, None, "fr", "s7")]


@pytest.mark.parametrize("mix", [MIX, mixing.Mix(percent=250, max_epochs=2), mixing.Mix(percent=0), mixing.PRODUCTION])
def test_mix_agrees_with_sql(spark, mix):
    rows = mix_rows()
    docs = documents(spark, rows)
    given = docs.select("doc_id", "text", "lang", "source").toPandas().astype({"doc_id": "Int64"})  # noqa: F841
    want = duckdb.sql(mixing.mixing_sql(mix, "given")).fetchall()
    found = mixing.mixed_ids(docs, mix)
    assert found.columns == ["doc_id", "domain", "lang", "source", "tokens", "epoch", "order_key"]
    assert Counter(map(tuple, found.collect())) == Counter(want)
    kept = mixing.mixed_docs(docs, mix)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text, r.lang, r.source) for r in kept.collect()).total() == len(want)


def test_shortage_goes_to_siblings_before_ancestors(spark):
    stats = spark.createDataFrame([("a", "en", "s1", 10), ("a", "en", "s2", 1000), ("a", "de", "s3", 5), ("b", "en", "s4", 10_000)], "domain string, lang string, source string, tokens long")
    mix = mixing.Mix({}, 10, 1)
    shares = {r.source: int(r.share) for r in mixing.leaf_shares(stats, mix).collect()}
    # 1,101 tokens: 550 for each domain; s3 offers 5, so its language's rest goes to en; s1 offers 10, the rest goes to s2
    assert shares == {"s3": 5, "s1": 10, "s2": 535, "s4": 550}
    small = {r.source: int(r.share) for r in mixing.leaf_shares(stats, mixing.Mix({}, 50, 1)).collect()}
    # 5,507 tokens: domain a offers 1,015 in all, so b gets the rest
    assert small == {"s3": 5, "s1": 10, "s2": 1000, "s4": 4492}


def test_mix_of_nothing(spark):
    assert mixing.mixed_ids(documents(spark, [])).count() == 0 and mixing.mixed_docs(documents(spark, [])).count() == 0


def test_sharding_of_a_row_repeated_many_times(spark, monkeypatch):
    """Repeats beyond RANGE are numbered in ranges, by several tasks."""
    monkeypatch.setattr(sharding, "RANGE", 50)
    rows = [(1, "again")] * 503 + [(2, "x")] * 50 + [(3, "y")] * 51 + [(i, f"t{i}") for i in range(10, 60)]
    found = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.row for r in found) == list(range(len(rows)))
    assert sorted((r.doc_id, r.size) for r in found) == sorted((i, len(t) + 1) for i, t in rows)
    slots = {s: sorted(r.slot for r in found if r.shard == s) for s in range(16)}
    assert all(x == list(range(len(x))) for x in slots.values()) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_columns_that_share_a_helpers_name_stay(spark):
    rows = [(i, f"{prose(i % 9, 30)}", "en", "src1") for i in range(30)]
    more = documents(spark, rows).selectExpr("*", "'a' AS __h1", "'b' AS h1", "'c' AS __epoch", "'d' AS __p_full", "'e' AS h2")
    for found in (ngram_join.keep_one(more), mixing.mixed_docs(more)):
        assert found.columns == more.columns
        assert {(r["__h1"], r["h1"], r["__epoch"], r["__p_full"], r["h2"]) for r in found.collect()} == {("a", "b", "c", "d", "e")}
    assert ngram_join.keep_one(more).count() == 9
