"""Quality rules, toxicity and chat formatting, against plain Python."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import zstandard

from panelwatch.llm import chat_format, quality_rules, toxicity
from panelwatch.llm.common import word_hashes

SPACES = " \t\n\v\f\r"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_words string, toxic string"


def documents(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "src0", 1, "x", "y", "z") for i, t in rows], DOCS)


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(n))


ODD = [None, "", " \n\t ", "one", "a b\nc d\na b\n\n \n a b", "# $ | < >", "x y   z\x1cw", "é " * 30, "w " * 12_000]


def plain_counts(text):
    text = text or ""
    words, word = [], ""
    for c in text + " ":
        if c in SPACES:
            words += [word] if word else []
            word = ""
        else:
            word += c
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_base_counts_agree_with_plain_python():
    rng = random.Random(5)
    texts = ODD[:-1] + ["".join(rng.choice("ab \n\t#é") for _ in range(rng.randint(0, 80))) for _ in range(300)]
    hashes = word_hashes()
    for text in texts:
        assert quality_rules.base_counts(text or "", hashes) == plain_counts(text)


def test_quality_rules_on_odd_rows(spark):
    rows = list(enumerate(ODD)) + [(None, prose(1, 200)), (3, prose(1, 200)), (3, prose(1, 200))]
    found = quality_rules.quality_rules(documents(spark, rows), quality_rules.Bands()).collect()
    assert len(found) == len(rows)
    for (_, text), r in zip(sorted(rows, key=str), sorted(found, key=lambda r: str((r.doc_id, r.n_words)))):
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert Counter(r[1:6] for r in found) == Counter(plain_counts(t) for _, t in rows)
    kept = quality_rules.keep_good(documents(spark, rows), quality_rules.Bands())
    assert kept.columns == [c.split()[0] for c in DOCS.split(", ")]
    assert sorted((r.doc_id or -1, r.kept) for r in kept.collect()) == [(-1, "x"), (3, "x"), (3, "x")]
    assert quality_rules.keep_good(documents(spark, [])  , quality_rules.Bands()).count() == 0


def test_bands_reject_repetition_and_noise():
    compressor, bands = zstandard.ZstdCompressor(level=3), quality_rules.Bands()
    rng = random.Random(2)
    noise = "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(3000))
    good = prose(3, 3000)
    stuffed = good[:9000] + prose(4, 40) * 40
    assert quality_rules.verdict(good.encode(), bands, compressor)[2]
    assert not quality_rules.verdict(("buy it now " * 400).encode(), bands, compressor)[2]
    assert not quality_rules.verdict(noise.encode(), bands, compressor)[2]
    whole, outside, kept = quality_rules.verdict(stuffed.encode(), bands, compressor)
    assert outside > 0.25 and not kept
    # against a plain reading of the definition
    data = stuffed.encode()
    chunks = [len(data[i : i + 4096]) / len(compressor.compress(data[i : i + 4096])) for i in [*range(0, len(data) - 4096, 4096), len(data) - 4096]]  # the last one ends with the text
    assert outside == sum(not bands.chunk[0] <= r <= bands.chunk[1] for r in chunks) / len(chunks)
    assert whole == len(data) / len(compressor.compress(data))


def test_bands_are_fitted_on_good_texts_only(spark):
    rows = [(i, prose(i, 300)) for i in range(60)] + [(100 + i, "ha " * 700) for i in range(60)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(100 + i, 0, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    bands = quality_rules.fit_bands(documents(spark, rows), labels, margin=0.0)
    compressor = zstandard.ZstdCompressor(level=3)
    k = len(rows[0][1]).bit_length() - 1
    ratios = [len(t) / len(compressor.compress(t.encode())) for _, t in rows[:60] if len(t).bit_length() - 1 == k]
    assert bands.whole[k] == pytest.approx(tuple(np.quantile(ratios, [0.005, 0.995])))
    assert quality_rules.fit_bands(documents(spark, rows), labels.limit(0)) == quality_rules.Bands()


def test_bands_are_fitted_on_every_good_text(spark):
    """Beyond 10,000 good texts too; labels may repeat, and texts that are bad or not labelled do not count."""
    rng = random.Random(5)
    rows = [(i, prose(i % 700, 24)[: rng.randint(64, 127)]) for i in range(11_000)]
    rows += [(20_000 + i, prose(i, 2500)) for i in range(60)] + [(30_000 + i, "x" * 100) for i in range(300)]
    marks = [(i, 1, 0) for i, _ in rows[:11_060]] + [(5, 1, 0)] + [(30_000 + i, 0, 0) for i in range(150)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    bands = quality_rules.fit_bands(documents(spark, rows), labels, margin=0.0)
    compressor = zstandard.ZstdCompressor(level=3)
    found = [quality_rules.ratios(t.encode(), quality_rules.Bands(), compressor) for _, t in rows[:11_060]]
    whole = [r for (_, t), (r, _) in zip(rows, found) if len(t) < 128]
    assert len(whole) == 11_000
    assert bands.whole[6] == pytest.approx(tuple(np.quantile(whole, [0.005, 0.995])), rel=1e-12)
    chunks = [c for _, c in found if c]
    low, high = np.quantile([min(c) for c in chunks], 0.005), np.quantile([max(c) for c in chunks], 0.995)
    assert len(chunks) == 60 and bands.chunk == pytest.approx((low, high), rel=1e-12)
    outside = [sum(not bands.chunk[0] <= r <= bands.chunk[1] for r in c) / len(c) for c in chunks]
    assert bands.chunk_share == pytest.approx(np.quantile(outside, 0.995), rel=1e-12)


def test_noise_at_any_place_of_a_text_is_rejected(spark):
    """Every byte lies in a judged chunk, whatever a text's length."""
    rng = random.Random(9)
    rows = [(i, prose(i, rng.choice([300, 800, 1200, 2500, 9000]))) for i in range(300)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    bands = quality_rules.fit_bands(documents(spark, rows), labels)
    compressor = zstandard.ZstdCompressor(level=3)
    good = [quality_rules.verdict(t.encode(), bands, compressor)[2] for _, t in rows]
    assert sum(good) >= 0.97 * len(rows)
    noise = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(n))
    for size, bad in ((12_287, 4_095), (12_287, 3_000), (65_536, 16_384), (200_000, 50_000), (5_000, 3_000)):
        for case in range(5):
            clean = prose(1000 + case, size // 4)[: size - bad]
            assert not quality_rules.verdict((clean + noise(bad)).encode(), bands, compressor)[2], (size, bad)
            assert not quality_rules.verdict((clean[: len(clean) // 2] + noise(bad) + clean[len(clean) // 2 :]).encode(), bands, compressor)[2]


def test_limits_of_very_long_texts_are_fitted_too():
    bands = quality_rules.Bands({0: (0, 1), 20: (1, 2), 23: (3, 4)})
    assert [bands.limits(n) for n in (1, 1 << 20, 1 << 22, 1 << 23, 1 << 30)] == [(0, 1), (1, 2), (1, 2), (3, 4), (3, 4)]


# -- toxicity


def labelled(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = prose(seed * 100_000 + i, 60).split()
        toxic = i % 8 == 0
        for _ in range(rng.randint(1, 5) if toxic else 0):
            words.insert(rng.randint(0, len(words)), rng.choice(["Vilefool", "vilefools!", "dungheap", "DUNGHEAP,"]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_ordinal_gradient_reaches_the_likelihood_maximum():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3)) < 0.5
    latent = x @ np.array([2.0, -1.0, 0.5]) + rng.logistic(size=3000)
    grades = (latent > 0.0).astype(int) + (latent > 1.5) + (latent > 3.0)
    rows, cols = np.nonzero(x)
    w, cuts = toxicity.fit_thresholds_and_weights(rows, cols, grades, 3, steps=800, rate=0.05, penalty=0.0)
    assert np.allclose(w, [2.0, -1.0, 0.5], atol=0.25) and np.allclose(cuts, [0.0, 1.5, 3.0], atol=0.25)

    def loss(w, cuts):
        p = np.concatenate([np.zeros((3000, 1)), toxicity.sigmoid(np.array(cuts)[None] - (x @ w)[:, None]), np.ones((3000, 1))], axis=1)
        return -np.log(p[np.arange(3000), grades + 1] - p[np.arange(3000), grades]).mean()

    best = loss(w, cuts)
    for i in range(3):
        for step in (-0.05, 0.05):
            assert loss(w + step * np.eye(3)[i], cuts) > best and loss(w, cuts + step * np.eye(3)[i]) > best


def test_toxicity_on_held_out_texts(spark):
    train, test = labelled(800, 1), labelled(400, 2)
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in train], "doc_id long, quality int, toxic int")
    model = toxicity.fit(documents(spark, [r[:2] for r in train]), labels)
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) == 3
    rows = [r[:2] for r in test] + [(None, None), (-1, ""), (-2, "w " * 20_000), (-3, "vilefool dungheap " * 5000)]
    found = {r.doc_id: r for r in toxicity.toxicity(documents(spark, rows), model).collect()}
    truth = {i: bool(t) for i, _, t in test}
    assert sum(found[i].toxic != t for i, t in truth.items()) <= 4
    assert not found[None].toxic and found[None].severity == found[-1].severity and not found[-2].toxic and found[-3].toxic
    assert all(0 <= r.severity <= 3 and (r.grade > 0) == r.toxic == (not r.kept) for r in found.values())
    hits = lambda t: sum("vilefool" in w.lower() or "dungheap" in w.lower() for w in t.split())
    mild, grave = ([found[i].severity for i, t, x in test if x and few(hits(t))] for few in (lambda n: n <= 1, lambda n: n >= 4))
    assert np.mean(grave) > np.mean(mild)
    kept = toxicity.keep_civil(documents(spark, rows), model)
    assert kept.columns == [c.split()[0] for c in DOCS.split(", ")] and kept.count() == sum(not r.toxic for r in found.values())


def test_toxic_words_count_wherever_they_stand(spark):
    train = labelled(800, 1)
    rows = [r[:2] for r in train] + [(10_000 + i, "天地玄黄宇宙" * (i % 5 + 1) + ("毒舌" if i % 4 == 0 else "") + "洪荒日月盈昃" * 3) for i in range(200)]
    labels = [(i, 1, t) for i, _, t in train] + [(10_000 + i, 1, int(i % 4 == 0)) for i in range(200)]
    model = toxicity.fit(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    clean = prose(5, 20).split() * 15
    marks = "\u00a0\u3000,-/\u2014"
    found = [(2 * i + end, mark.join([*clean, *["vilefools", "dungheap"] * end])) for i, mark in enumerate(marks) for end in (0, 1)]
    found += [(100, "x" * 396 + "," + "vilefools,dungheap"), (102, "天地玄黄" * 60), (103, "天地玄黄" * 60 + "毒舌" + "洪荒日月" * 60)]
    toxic = {r.doc_id: r.toxic for r in toxicity.toxicity(documents(spark, found), model).collect()}
    assert toxic == {i: i % 2 == 1 or i == 100 for i, _ in found}


def test_toxicity_with_given_grades_and_without_labels(spark):
    train = labelled(400, 3)
    labels = spark.createDataFrame([(i, t, 2 * t) for i, _, t in train], "doc_id long, toxic int, level int")
    model = toxicity.fit(documents(spark, [r[:2] for r in train]), labels, grade="level")
    assert len(model.thresholds) == 2
    none = toxicity.fit(documents(spark, [r[:2] for r in train]), labels.limit(0))
    assert not any(r.toxic for r in toxicity.toxicity(documents(spark, [r[:2] for r in train[:20]]), none).collect())
    assert toxicity.toxicity(documents(spark, []), model).count() == 0


# -- chat formatting

CHATS = "conv_id long, turn long, role string, text string, formatted string, part int"


def chats(spark, rows):
    return spark.createDataFrame([(*r, "x", 7) for r in rows], CHATS)


def test_chat_round_trip_and_mask(spark):
    rng = random.Random(1)
    bits = ["<|", "<\\|", "<\\\\|", "<", "|", "\\", "\n", "<|im_end|>\n", "<|im_start|>assistant", "é日", "plain ", ""]
    rows = [(rng.choice([1, 2, 3, None]), i, rng.choice(["user", "assistant", "a\nb\\n", None, "<|im_end|>"]), rng.choice([None, "".join(rng.choice(bits) for _ in range(6))])) for i in range(400)]
    rows += [(9, 0, "assistant", ""), (8, 5, "assistant", "b"), (8, 5, "assistant", "a"), (8, None, "user", "first"), (8, 5, "assistant", "a"), (7, 0, "assistant", "long " * 100_000)]
    found = {r.conv_id: r for r in chat_format.formatted(chats(spark, rows)).collect()}
    assert all(r.part == 0 for r in found.values()) and len(found) == 7
    order = lambda r: ((r[1] is not None, r[1] or 0), r[2] is not None, (r[2] or "").encode(), r[3] is not None, (r[3] or "").encode())
    digests = {r.conv_id: r for r in chat_format.digests(chats(spark, rows)).collect()}
    for conv, r in found.items():
        turns = [((x[2] or ""), (x[3] or "")) for x in sorted((x for x in rows if x[0] == conv), key=order)]
        data = r.formatted.encode()
        assert [(a.decode(), b.decode()) for a, b in chat_format.turns_of(data)] == turns and r.n_turns == len(turns)
        masked = [chat_format.unescaped(data[i:j]).decode() for i, j in zip(r.loss_starts, r.loss_ends)]
        assert masked == [t for a, t in turns if a == "assistant" and t]
        loss = "".join(t for a, t in turns if a == "assistant")
        d = digests[conv]
        assert d.turns_sha256 == hashlib.sha256("".join(f"{a}\n{t}\n" for a, t in turns).encode()).hexdigest()
        assert (d.n_turns, d.loss_chars, d.loss_sha256, d.formatted_chars) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(r.formatted))


def test_long_conversations_come_in_parts_that_join_up(spark, monkeypatch):
    rows = [(c, i, "assistant" if i % 2 else "user", f"text {c} {i} <|x|>") for c in range(5) for i in range(300)]
    whole = {r.conv_id: r for r in chat_format.digests(chats(spark, rows)).collect()}
    monkeypatch.setattr(chat_format, "PART", 500)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        parts = chat_format.formatted(chats(spark, rows)).collect()
        assert max(r.part for r in parts) > 1
        for c in range(5):
            own = sorted((r for r in parts if r.conv_id == c), key=lambda r: r.part)
            assert [r.part for r in own] == list(range(len(own)))
            assert len(chat_format.turns_of("".join(r.formatted for r in own).encode())) == 300
        assert {r.conv_id: r for r in chat_format.digests(chats(spark, rows)).collect()} == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert chat_format.digests(chats(spark, [])).count() == 0
