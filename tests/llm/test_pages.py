"""URL filter, HTML extraction, and the registered queries with their pipeline."""

import html
import math
import os
import random
import re
import shutil
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from panelwatch.llm import common, html_extract, quality_rules, registry, toxicity, url_filter

FOLDER = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, host string, rule string, text string, score string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "h", "r", "t", "s") for i, u, h in rows], PAGES)


# -- URL filter


def plain_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest, re.S).groups()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [h + p for _, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=len) if fits else None


ODD_URLS = [
    None, "", "no scheme", "http://", "http://ORG", "http://ORG/", "http://Ünï.Example.ORG/es/x?y#z", "http://example.org/en/1?a", "http://example.org/en/1", "x://a://b/c",
    "http://notexample.org/es/", "http://sub.example.org/es", "http://com/fr/", "http://a.com?/fr/", "http://a.com#/fr/", "http://a.com/de/\n/x", "http://İ.com/fr/", "http://" + "a" * 50_000 + ".com/fr/" + "b" * 50_000,
]


def test_hosts_paths_and_rules(spark):
    rows = [(i, u, None) for i, u in enumerate(ODD_URLS)] + [(1, ODD_URLS[5], None)] * 2 + [(None, ODD_URLS[5], None)]
    found = url_filter.judged(pages(spark, rows)).collect()
    assert Counter((r.page_id, r.host, r.path, r.rule) for r in found) == Counter((i, *plain_rule(u)) for i, u, _ in rows)
    kind = {h + p: v for v, h, p in url_filter.RULES}
    assert all(r.verdict == kind[r.rule] for r in found if r.rule) and {r.verdict for r in found} <= {"allow", "block"}
    assert url_filter.judged(pages(spark, [])).count() == 0


class PlainModel:
    """The same mixture with a dictionary of contexts."""

    def __init__(self, texts):
        self.n = Counter()
        for text in texts:
            data = b"\x02" * 5 + text + b"\x03"
            for i in range(5, len(data)):
                for order in range(6):
                    self.n[data[i - order : i], None] += 1
                    self.n[data[i - order : i], data[i]] += 1

    def log(self, text):
        data, total = b"\x02" * 5 + text + b"\x03", 0.0
        for i in range(5, len(data)):
            p = 1 / 256
            for order in range(6):
                context = data[i - order : i]
                p = (self.n[context, data[i]] + 4 * p) / (self.n[context, None] + 4)
            total += math.log(p)
        return total


def urls(n, seed):
    rng = random.Random(seed)
    good, bad = ["river", "stone", "garden", "school", "bridge"], ["casino", "pills", "xxbet", "freewin", "cashnow"]
    out = []
    for i in range(n):
        words = good if i % 2 else bad
        out.append((i, f"http://{rng.choice(words)}.{rng.choice(['net', 'net', 'org' if i % 2 else 'com'])}/{'en' if i % 2 else 'de'}/{rng.choice(words)}-{rng.randint(0, 99)}", None))
    return out


def test_models_agree_with_a_plain_mixture_and_tell_urls_apart(spark):
    rows = urls(1500, 1)
    ruled = pages(spark, rows)
    ruled = ruled.withColumn("verdict", url_filter.rule_for(url_filter.host_of(ruled.url), url_filter.path_of(ruled.url))["verdict"]).where("verdict is not null").cache()
    models = url_filter.fit(ruled)
    held = {r.url for r in ruled.where("pmod(xxhash64(url, 5), 10) = 0").collect()}
    sides = {v: PlainModel([r.url.encode() for r in ruled.collect() if r.verdict == v and r.url not in held]) for v in ("allow", "block")}
    texts = [u.encode() for _, u, _ in rows[:40]] + [b"", "http://ü.net/日本".encode()]
    plain = [(sides["allow"].log(t) - sides["block"].log(t)) / (len(t) + 1) for t in texts]
    off = np.abs(models.scores(texts) - plain)
    assert np.median(off) < 0.005 and off.max() < 0.3  # a few cells are shared
    found = [r for r in url_filter.judged(pages(spark, rows)).collect() if r.rule is None]
    assert len(found) > 400 and sum((r.verdict == "allow") != (r.page_id % 2 == 1) for r in found) <= 0.05 * len(found)
    accepted = [r.url for r in ruled.collect() if r.verdict == "allow" and r.url in held]
    assert sum(s < models.threshold for s in models.scores([u.encode() for u in accepted])) <= 0.01 * len(accepted)


def test_counts_are_exact_however_many_contexts(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BLOCK_URLS", 500)
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(40))
    rows = [(f"http://{word()}.org/{word()}", "allow" if i % 2 else "block") for i in range(3000)]
    decided = spark.createDataFrame(rows, "url string, verdict string").cache()
    models = url_filter.fit(decided)
    held = {r.url for r in decided.where("pmod(xxhash64(url, 5), 10) = 0").collect()}
    sides = {v: PlainModel([u.encode() for u, x in rows if x == v and u not in held]) for v in ("allow", "block")}
    texts = [u for u, _ in rows[:60]] + ["", "http://ü.net/日本"] + [f"http://{word()}.net/" for _ in range(20)]
    plain = {t: (sides["allow"].log(t.encode()) - sides["block"].log(t.encode())) / (len(t.encode()) + 1) for t in texts}
    assert np.allclose(models.scores([t.encode() for t in texts]), list(plain.values()), rtol=0, atol=1e-9)
    found = models.scored(spark.createDataFrame([(u,) for u, _ in rows] + [(t,) for t in texts], "url string")).collect()
    assert len(found) == len(rows) + len(texts) and all(r.score == pytest.approx(plain[r.url], abs=1e-9) for r in found if r.url in plain)
    big = [(2**60 + 1, "http://a.net/x", None), (None, "http://a.net/x", None), *urls(60, 2)]
    assert {r.page_id for r in url_filter.judged(pages(spark, big)).collect()} == {i for i, *_ in big}


def test_urls_without_decided_ones_are_allowed(spark):
    assert {r.verdict for r in url_filter.judged(pages(spark, [(1, "http://a.net/x", None), (2, None, None)])).collect()} == {"allow"}


# -- HTML extraction


def built_page(rng):
    """A page and its article's text."""
    words = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 8))) for _ in range(n))
    blocks, article = [], ""
    for i in range(rng.randint(1, 9)):
        text = words(rng.choice([1, 3, 30, 90])) + rng.choice(["", " & <so> on", ' "é" 5 > 4'])
        blocks.append(text)
        shown = html.escape(text)
        shown = shown.replace(" ", rng.choice([" ", "\n  ", "&nbsp;", "&#32;"]), 1)
        if rng.random() < 0.4:
            first, _, rest = shown.partition(" ")
            shown = f'<a href="/x?a=1&b=2" title="a > b">{first}</a> <b>{rest}</b>' if rest else f"<i>{first}</i>"
        article += rng.choice([f"<p>{shown}</p>", f"<p>{shown}", f"<h2>{shown}</h2>", f"<ul><li>{shown}</ul>", f"<div>{shown}</div>", f"<blockquote><p>{shown}</blockquote>", f"<table><tr><td>{shown}</table>"])
        article += rng.choice(["", "<!-- x > y -->", '<script>var a = "<p>no</p>";</script>', f'<div class="ad-box"><p>{words(60)}</p></div>', f"<form><label>{words(9)}</label><input></form>", f'<aside class="related"><p>{words(40)}</aside>'])
    menu = "".join(f'<li><a href="/{i}">{words(2)}</a></li>' for i in range(rng.randint(3, 12)))
    wrap = rng.choice(["<article>{}</article>", "<main><div>{}</div></main>", '<main role="main"><article class="post">{}</article></main>', '<div id="content">{}</div>', '<div class="article-body">{}</div>'])
    top = rng.choice(["", f"<header><h1>{words(5)}</h1></header>", f'<div class="site-header">{words(12)}</div>']) + rng.choice([f"<nav><ul>{menu}</ul></nav>", f'<div class="top-menu"><ul>{menu}</ul></div>', f"<ul>{menu}</ul>"])
    side = rng.choice(["", f"<aside><p>{words(150)}</p></aside>", f'<div class="sidebar-right">{words(150)}</div>', f'<div id="cookieNotice">{words(80)}</div>', f'<div role="alert">{words(70)}</div>'])
    end = rng.choice(["", f'<section id="comments"><h3>{words(2)}</h3><article class="comment"><p>{words(200)}</p></article></section>', f'<div class="comment-list"><p>{words(200)}</p></div>']) + rng.choice([f"<footer>{words(20)}</footer>", f'<div class="footer">{words(20)}</div>'])
    body = f'<!DOCTYPE html><html><head><title>{words(6)}</title><style>p>a{{}}</style></head><body class="has-sidebar">{top}{side}{wrap.format(article)}{end}</body></html>'
    return body, "\n".join(" ".join(b.split()) for b in blocks)


def test_articles_come_out_whole_and_alone():
    rng = random.Random(7)
    weights = html_extract.Weights()
    for _ in range(400):
        page, text = built_page(rng)
        assert html_extract.Page(page).text(weights) == text, page


def test_region_is_the_largest_sum():
    rng = random.Random(2)
    weights = html_extract.Weights()
    for _ in range(300):
        page = "".join(rng.choice(["<div>", "</div>", "<li>", "<a>", "</a>", "<p>", "x y z ", "w ", "<span>", "</span>", "many words in one run of text "]) for _ in range(rng.randint(1, 25)))
        read = html_extract.Page(page)
        scores = read.scores(weights)
        i, j = read.region(weights)
        best = max([0.0] + [sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)])
        assert sum(scores[i:j]) == pytest.approx(best)


def test_odd_pages(spark):
    long = "<article>" + "<p>some words here</p>" * 20_000 + "</article>"
    rows = [
        (1, None, None), (2, "u", ""), (3, "u", "just text &amp; more"), (4, "u", "<nav>menu</nav>"), (5, "u", long), (5, "u", long), (None, "u", "<article><p>cut off"),
        (7, "u", "<article><p>a</p><p>b<br>c</article"), (8, "u", "<script>never closed <p>x</p>"), (9, "u", "<article>x&lt;y&am &notit; &#x41;</article>"), (10, "u", "<p>one</p><!-- open <p>two"),
    ]
    found = html_extract.extracted(pages(spark, rows), html_extract.fit(pages(spark, rows)))
    assert found.columns == ["page_id", "url", "text"]
    texts = defaultdict(list)
    for r in found.collect():
        texts[r.page_id].append(r.text)
    assert texts == {
        1: [""], 2: [""], 3: ["just text & more"], 4: [""], 5: ["\n".join(["some words here"] * 20_000)] * 2, None: ["cut off"],
        7: ["a\nb\nc"], 8: [""], 9: ["x<y&am ¬it; A"], 10: ["one"],
    }
    empty = pages(spark, [])
    assert html_extract.extracted(empty, html_extract.fit(empty)).count() == 0


@pytest.mark.parametrize("name", ["post-title", "post-meta", "entry-date", "content-top"])
def test_a_named_title_or_date_does_not_hide_the_text(spark, name):
    text = " ".join(f"word{i}" for i in range(500))
    page = f'<ul><li><a href="/">home</a></li></ul><div class="{name}"><h1>one two three four five six seven eight</h1></div><div class="text"><p>{text}</p></div>'
    labelled = pages(spark, [(i, "u", f"<nav>menu</nav><article><h1>title</h1><p>{text}</p></article><footer>end</footer>") for i in range(5)])
    for weights in (html_extract.Weights(), html_extract.fit(labelled)):
        assert html_extract.Page(page).text(weights) == f"one two three four five six seven eight\n{text}"
        assert html_extract.Page(f"<h1>the title</h1><p>a lead of the text</p><article><p>{text}</p></article>").text(weights) == f"the title\na lead of the text\n{text}"


def test_names_that_articles_use_take_nothing_away():
    text = " ".join(f"word{i}" for i in range(60))
    inner = f'<h2 id="related-work">Related</h2><p>{text}</p><section id="discussion"><h2 id="sharing">Sharing</h2><p class="ad-hoc">an <span class="menu">menu</span> of things</p></section><p id="notice">kept</p>'
    want = f"Related\n{text}\nSharing\nan menu of things\nkept"
    for page in (f"<article>{inner}</article>", f'<div id="content">{inner}</div>', f'<main>{inner}<div class="share-buttons">one two</div><div class="ad-box">{text}</div></main>'):
        assert html_extract.Page(page).text(html_extract.Weights()) == want


def test_samples_follow_one_rule_at_every_size(spark):
    for n in (0, 5, 10, 79, 81, 3000):
        rows = spark.range(n).selectExpr("id", "pmod(xxhash64(id), 1 << 30) AS low")
        want = [r.id for r in sorted(rows.collect(), key=lambda r: r.low)[:10]]
        assert [r.id for r in common.hash_sample(rows, "id", 10).collect()] == want
    same = spark.range(500).selectExpr("CAST(7 AS long) AS id")
    assert common.hash_sample(same, "id", 10).count() == 10
    rng = random.Random(4)
    labelled = [(i, "u", built_page(rng)[0] + "<article><p>one two</p></article>") for i in range(40)]
    few = [(1000 + i, "u", "<p>text</p>") for i in range(3000)]
    assert html_extract.fit(pages(spark, labelled + few), sample=20) == html_extract.fit(pages(spark, labelled), sample=20) != html_extract.Weights()


def test_hostile_pages_take_linear_time():
    weights = html_extract.Weights()
    for part in ("<b><p>x", "<a href='", "<div></p>", "<", "<!--", "<li>", "<td><table>", "<script>", '<p a="', "</x>"):
        html_extract.Page(part * 20_000).text(weights)


# -- registered queries


def rows_of(columns, table):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(r[i] for i in order) for r in table)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_agrees_with_its_sql(spark, name):
    con = duckdb.connect()
    for one in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {one[:-8]} AS SELECT * FROM '{FOLDER}/{one}'")
    want = con.execute(registry.ORACLE[name])
    columns = [c[0] for c in want.description]
    found = registry.QUERIES[name](spark, FOLDER)
    assert sorted(found.columns) == sorted(columns)
    assert rows_of(found.columns, found.collect()) == rows_of(columns, want.fetchall())


@pytest.mark.parametrize("name, rows", [("op1_toxicity", 200), ("op3_quality_rules", 200), ("op4_ngram_join", 200), ("op8_sharding", 200), ("op7_url_filter", None), ("op9_html_extract", None)])
def test_query_returns_a_row_per_row(spark, name, rows):
    table = "documents" if rows else "pages"
    assert driver.queries()[name](spark, FOLDER).count() == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()


def test_pages_query_takes_the_article(spark):
    found = {r.page_id: r for r in html_extract.op9_html_extract(spark, FOLDER).collect()}
    for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        parts = re.sub(r"</?b>", "", re.sub(r"<(?:/?p|br|/?h1)>", "\0", inner)).split("\0")
        text = "\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)
        assert found[r.page_id].text == text and found[r.page_id].n_chars == len(text)


def test_pipeline_stages_and_rows(spark, tmp_path):
    stages = [name for name, _ in corpus_pipeline.STAGES]
    assert stages == ["quality_rules", "toxicity", "ngram_join", "mixing", "packing"] and corpus_pipeline.ORACLE_SQL is None
    folder = tmp_path / "in"
    folder.mkdir()
    for name in ("documents", "labels"):
        shutil.copy(f"{FOLDER}/{name}.parquet", folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, before, str(folder))
        out.write.parquet(f"{tmp_path}/{i}")
        after = spark.read.parquet(f"{tmp_path}/{i}")
        if i < 4:
            assert after.columns == columns
        if name == "quality_rules":
            bands = quality_rules.fit_bands(before, spark.read.parquet(f"{folder}/labels.parquet"))
            want = {r.doc_id for r in quality_rules.quality_rules(before, bands).collect() if r.kept}
            assert {r.doc_id for r in after.collect()} == want
        if name == "toxicity":
            model = toxicity.fit(before, spark.read.parquet(f"{folder}/labels.parquet"))
            assert {r.doc_id for r in after.collect()} == {r.doc_id for r in toxicity.toxicity(before, model).collect() if not r.toxic}
        before = after
    assert rows_of(before.columns, before.collect()) == rows_of(before.columns, corpus_pipeline.run(spark, str(folder)).collect())


@pytest.mark.parametrize(
    "inside",
    [
        "<header><h1>TITLE of it</h1><p>KEPT lead of the story</p></header>",
        '<section id="comments-on-the-theorem"><p>KEPT remarks on a proof</p></section>',
        '<div class="ad-hoc-networks"><p>KEPT words on networks</p></div>',
        '<table class="results sidebar-none"><tr><td>KEPT figures</td></tr></table>',
        '<div class="discussion"><p>KEPT weighing of results</p></div>',
    ],
)
@pytest.mark.parametrize("tag", ["article", "main"])
def test_names_take_no_part_of_an_article_by_one_word(inside, tag):
    body = "".join(f"<p>Plain words of paragraph {i} with some length to it.</p>" for i in range(8))
    for page in (f"<html><body><nav>menu</nav><{tag}>{inside}{body}</{tag}></body></html>", f"<html><body><{tag}>{body}{inside}<p>The end of it.</p></{tag}><footer>foot</footer></body></html>"):
        found = html_extract.Page(page).text(html_extract.Weights())
        assert "KEPT" in found and "paragraph 7" in found and "menu" not in found and "foot" not in found


@pytest.mark.parametrize("name", ["comments", "sidebar", "related-posts", "comment-list", "user-comments", "newsletter-signup", "share-buttons", "comment-12", "ad"])
def test_names_of_other_parts_inside_an_article_still_go(name):
    body = "".join(f"<p>Plain words of paragraph {i} with some length to it.</p>" for i in range(8))
    for mark in (f'class="x {name}"', f'id="{name}"'):
        page = f"<html><body><article>{body}<div {mark}><p>GONE words of another part</p></div></article></body></html>"
        found = html_extract.Page(page).text(html_extract.Weights())
        assert "GONE" not in found and "paragraph 7" in found


def test_nothing_else_imports_the_package():
    top = os.path.dirname(os.path.abspath(driver.__file__))
    for folder, _, files in os.walk(f"{top}/panelwatch"):
        if not folder.endswith("llm"):
            for name in files:
                if name.endswith(".py"):
                    assert not re.findall(r"^\s*(?:from|import) .*\bllm\b.*", open(f"{folder}/{name}").read(), re.M)
