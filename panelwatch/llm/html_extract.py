"""HTML extraction by the maximum-scoring subsequence of words and tags.

A page is read once into a sequence of tags and runs of text, with the usual repairs (unclosed paragraphs, list items and inline
tags; raw text of scripts, styles and titles; quoted attribute values; cut-off tags).  Subtrees that markup itself names as
something else (menus, headers, footers, sidebars, adverts, forms, reader comments, hidden parts) leave the sequence.  By class or id
only containers do, and not for one word that articles use as well (discussion, related, notice): its words weigh as in a link.
Inside <article> or <main> a name counts only if all its words say so (`sidebar`, `user-comments`), and of an article's header
headings and paragraphs stay.
In the rest each word scores above zero and each tag below, and one linear scan finds the contiguous run of largest sum.

Weights come from labelled pages, those that mark their article with <article> or <main> (at most `sample` of them, those with
the smallest hash of page_id): a word weighs the share of such words inside the article, by whether it is inside a link; a tag
weighs minus `tag_cost` times the share of such tags outside.  Words that markup names as the article weigh more: `in_article` times
inside <article> or <main> (the odds of inside against outside on labelled pages, 10 at most), `named` times where a class or id says
so; all other words keep their weight.  An article's edge costs the words that labelled pages have outside on average.  A run inside
an element named as the article is extended to that whole element, and a run that crosses such elements to those of which it holds
half the words, so that nothing of them is lost at its ends.

Text: character references decoded, white space (any Unicode white space) inside a block made one space, blocks trimmed and joined
by one line feed; block-level tags, cells and <br> end a block.

Defined cases: null or empty html, or a page without text, gives an empty text; plain text without tags is its own content;
repeated rows are extracted one by one; without labelled pages default weights hold; an empty table gives an empty result; other
columns are neither read nor touched.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hash_sample, table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OFF_TAGS = frozenset("head title script style noscript template iframe noembed noframes object svg canvas audio video nav aside footer form button select textarea datalist dialog menu".split())
OFF_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
OFF_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs "
    "sidebar footer cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended comment comments commentlist reply replies respond disqus discussion widget toolbar pagination pager skip masthead topbar copyright disclaimer".split()
)
#: Containers that a name can take out; names of headings, paragraphs and inline tags, often generated, do not.
NAMED_OFF = frozenset("article div section ul ol dl table tbody tr td th center details fieldset header".split())
#: Names that articles have of their own: one of them alone only lowers the weight of a container's words.
AMBIGUOUS = frozenset("discussion notice notices share sharing social related recommended menu copyright disclaimer banner promo promotion reply replies respond skip widget navigation subscription consent overlay".split())
#: What makes an ambiguous name a certain one, beside a second name of OFF_NAMES.
EVIDENCE = frozenset("top main site bar buttons links icons list box posts articles stories items".split())
#: Words that stand beside such names in names of parts that belong to a page and not to its article.
COMPANIONS = EVIDENCE | frozenset("reader readers user users section area block thread form post article".split())
COMMENT_NAMES = frozenset("comment comments reply replies respond discussion".split())
LAYOUT_NAMES = frozenset("with has no without layout wrapper container page".split())
ARTICLE_NAMES = frozenset("article content post entry story main".split())
ARTICLE_TAGS = frozenset(["article", "main"])
NEVER_OFF = frozenset(["html", "body", "main"])
#: Parents inside which an open element of this kind ends when another starts.
SIBLINGS = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select", "datalist")}

OPENS = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
STOPS = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


@dataclass(frozen=True)
class Weights:
    plain_word: float = 1.0
    link_word: float = 0.2
    in_article: float = 4.0
    named: float = 1.5
    tags: dict = field(default_factory=lambda: {"a": -4.0, "li": -2.0, "ul": -2.0, "div": -2.0, "td": -2.0, "tr": -2.0, "span": -0.5})
    other_tag: float = -0.05
    edge_cost: float = 0.0


def tag_end(page: str, at: int, dead: set) -> int:
    """Index of the `>` that ends a tag, past quoted values; -1 if the page ends first."""
    while True:
        stop = STOPS.search(page, at)
        if stop is None:
            return -1
        mark, i = stop[0], stop.start()
        if mark == ">":
            return i
        at = i + 1
        if mark not in dead and page[max(0, i - 8) : i].rstrip().endswith("="):
            close = page.find(mark, at)
            if close < 0:
                dead.add(mark)
            else:
                at = close + 1


def events(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest): text and its raw characters; open and close tags and their attributes."""
    at, size, dead = 0, len(page), set()
    while at < size:
        found = OPENS.search(page, at)
        start = found.start() if found else size
        if start > at:
            yield "text", "", page[at:start]
        if not found:
            return
        if found[1]:
            end = page.find("-->", found.end() - 2)
            at = size if end < 0 else end + 3
        elif found[2]:
            end = page.find(">", found.end())
            at = size if end < 0 else end + 1
        else:
            end = tag_end(page, found.end(), dead)
            if end < 0:
                return
            name = found[4].lower()
            at = end + 1
            if found[3]:
                yield "close", name, ""
                continue
            rest = page[found.end() : end]
            yield "open", name, rest
            if name in RAW:
                close = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
                stop = close.start() if close else size
                yield "text", "", page[at:stop]
                at = stop


def names_in(value: str) -> set[str]:
    return {x.lower() for x in NAME_PARTS.findall(value)}


def named_off(tag: str, given: dict[str, str], in_article: bool) -> str:
    """"off" if a container's class or id says that it is not part of an article, "doubt" if it may say so, else ""."""
    if tag not in NAMED_OFF:
        return ""
    if in_article and tag != "article":
        return named_off_inside(given)
    doubt = False
    for value in (given.get("class", ""), given.get("id", "")):
        for one in value.split():
            parts = names_in(one)
            if tag == "article":
                if parts & COMMENT_NAMES:
                    return "off"
            elif parts & OFF_NAMES and not parts & LAYOUT_NAMES:
                if parts & OFF_NAMES - AMBIGUOUS or len(parts & OFF_NAMES) > 1 or parts & EVIDENCE:
                    return "off"
                doubt = True
            elif "header" in parts and not in_article and not parts & ARTICLE_NAMES and not parts & LAYOUT_NAMES:
                return "off"
    return "doubt" if doubt else ""


def named_off_inside(given: dict[str, str]) -> str:
    """The same inside <article> or <main>: there a class or id counts only if all its words say so, and not one part of it."""
    found = ""
    for one in f"{given.get('class', '')} {given.get('id', '')}".split():
        parts = {x for x in names_in(one) if not x.isdigit()}
        telling = parts & OFF_NAMES
        if telling and parts <= OFF_NAMES | COMPANIONS:
            if telling - AMBIGUOUS or len(parts) > 1:
                return "off"
            found = "doubt"
    return found


def marked_off(tag: str, rest: str, in_article: bool) -> str:
    """Whether an element is not part of an article, by its tag, role, names or style: "off", "doubt" or ""."""
    if tag in OFF_TAGS or (tag == "header" and not in_article):
        return "off"
    if not rest or rest.isspace() or tag in NEVER_OFF:
        return ""
    given = {k.lower(): (a or b or c or "") for k, a, b, c in ATTRIBUTE.findall(rest)}
    if given.get("role", "").lower() in OFF_ROLES or "hidden" in given or given.get("aria-hidden", "").lower() == "true":
        return "off"
    if re.search(r"display\s*:\s*none", given.get("style", ""), re.I):
        return "off"
    return named_off(tag, given, in_article)


def names_article(tag: str, rest: str) -> bool:
    if tag in ARTICLE_TAGS:
        return True
    if tag not in ("div", "section", "td") or not rest:
        return False
    given = {k.lower(): (a or b or c or "") for k, a, b, c in ATTRIBUTE.findall(rest)}
    return given.get("role", "").lower() == "main" or any(names_in(x) & ARTICLE_NAMES for k in ("class", "id") for x in given.get(k, "").split())


class Page:
    """items: (kind, name, text, links and doubtful containers open, number of the innermost element named as article, inside <article> or <main>)."""

    def __init__(self, page: str):
        self.items: list[tuple[str, str, str, int, int, bool]] = []
        self.parents = [-1]  # of elements named as article; 0 is the page
        open_: list[tuple[str, bool, bool, int, bool, bool]] = []  # tag, off, off by header, article number, inside article tags, doubtful by name
        count: Counter = Counter()
        blocks: list[int] = []
        paragraphs: list[int] = []
        links = 0

        def shut(to: int) -> None:
            nonlocal links
            while len(open_) > to:
                tag, *_, doubt = open_.pop()
                count[tag] -= 1
                links -= (tag == "a") + doubt
                if blocks and blocks[-1] == len(open_):
                    blocks.pop()
                if paragraphs and paragraphs[-1] == len(open_):
                    paragraphs.pop()

        def last(tag: str) -> int:
            return next(i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == tag)

        for kind, name, rest in events(page):
            tag, off, by_header, number, inside, _ = open_[-1] if open_ else ("", False, False, 0, False, False)
            if kind == "text":
                if not off:
                    self.items.append(("text", name, rest, links, number, inside))
                continue
            if kind == "close":
                if not count[name]:
                    continue
                i = last(name)
                if name not in BLOCK and blocks and blocks[-1] > i:
                    continue
                was = open_[i]
                shut(i)
                if not was[1]:
                    self.items.append(("tag", name, "", links, was[3], was[4]))
                continue
            if name in BLOCK and name != "br" and paragraphs and (not blocks or paragraphs[-1] > blocks[-1]):
                shut(paragraphs[-1])
            if name in SIBLINGS and count[name]:
                i = last(name)
                if not any(open_[j][0] in SIBLINGS[name] for j in range(i + 1, len(open_))):
                    shut(i)
            tag, off, by_header, number, inside, _ = open_[-1] if open_ else ("", False, False, 0, False, False)
            doubt = False
            if not off and name not in VOID:
                inside = inside or name in ARTICLE_TAGS
                mark = marked_off(name, rest, inside)
                off, doubt = mark == "off", mark == "doubt"
                if not off and name == "header":
                    off = by_header = True
                elif not off and names_article(name, rest):
                    self.parents.append(number)
                    number = len(self.parents) - 1
            elif off and by_header and (name in HEADINGS or name == "p"):
                off = by_header = False  # the title and the lead in an article's header
            if not off:
                self.items.append(("tag", name, "", links, number, inside))
            if name in VOID or rest.endswith("/") and name not in BLOCK and name not in RAW and name not in ("a", "b", "i", "span"):
                continue
            open_.append((name, off, by_header, number, inside, doubt))
            count[name] += 1
            links += (name == "a") + doubt
            if name == "p":
                paragraphs.append(len(open_) - 1)
            elif name in BLOCK:
                blocks.append(len(open_) - 1)

    def scores(self, weights: Weights) -> list[float]:
        out = []
        for kind, name, text, links, number, inside in self.items:
            if kind == "text":
                place = weights.in_article if inside else weights.named if number else 1.0
                out.append(len(text.split()) * place * (weights.link_word if links else weights.plain_word))
            elif name == "article":
                out.append(-weights.edge_cost)
            else:
                out.append(weights.tags.get(name, weights.other_tag))
        return out

    def chain(self, number: int) -> set[int]:
        """The numbers of an element named as article and of all such elements around it; 0 is the page."""
        found = {0}
        while number > 0:
            found.add(number)
            number = self.parents[number]
        return found

    def region(self, weights: Weights) -> tuple[int, int]:
        """[i, j) of the largest sum, the longest of equals from the earliest start, extended to the element it lies in."""
        best, span, total, start = 0.0, (0, 0), 0.0, 0
        for i, score in enumerate(self.scores(weights)):
            if total < 0:
                total, start = 0.0, i
            total += score
            if total > best:
                best, span = total, (start, i + 1)
        if span[1] == 0:
            return span
        chains = [self.chain(n) for n in {item[4] for item in self.items[slice(*span)] if item[0] == "text" and not item[2].isspace()}]
        holder = max(set.intersection(*chains))  # the innermost: children have larger numbers than their parents
        if holder == 0:
            return self.widened(span, set.union(*chains) - {0})
        own = {holder}
        for i, parent in enumerate(self.parents):
            if parent in own:
                own.add(i)
        held = [i for i, item in enumerate(self.items) if item[4] in own]
        return held[0], held[-1] + 1

    def widened(self, span: tuple[int, int], numbers: set[int]) -> tuple[int, int]:
        """The span with the whole of each numbered element of which it holds half the words or more."""
        words, held, first, last = Counter(), Counter(), {}, {}
        for i, (kind, _, text, _, number, _) in enumerate(self.items):
            n = len(text.split()) if kind == "text" else 0
            while number > 0:
                first.setdefault(number, i)
                last[number] = i + 1
                words[number] += n
                held[number] += n if span[0] <= i < span[1] else 0
                number = self.parents[number]
        whole = [x for x in numbers if 2 * held[x] >= words[x]]
        return min([span[0], *(first[x] for x in whole)]), max([span[1], *(last[x] for x in whole)])

    def text(self, weights: Weights) -> str:
        blocks, now = [], []
        for kind, name, text, *_ in self.items[slice(*self.region(weights))]:
            if kind == "text":
                now.append(entities.unescape(text))
            elif name in BLOCK:
                blocks.append(" ".join("".join(now).split()))
                now = []
        blocks.append(" ".join("".join(now).split()))
        return "\n".join(b for b in blocks if b)


LABELLED = re.compile(r"<(?:article|main)[\s>]", re.I)


def fit(pages: DataFrame, sample: int = 1_000, tag_cost: float = 5.0) -> Weights:
    """Weights of labelled pages, at most `sample` of them."""
    labelled = pages.select("page_id", "html").where(F.col("html").rlike(r"(?i)<(?:article|main)[\s>]"))
    picked = hash_sample(labelled, "page_id", sample).select("html")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            within, outside = Counter(), Counter({"#page": len(batch)})
            for page in batch["html"]:
                for kind, name, text, links, number, inside in Page(page).items:
                    key = name if kind == "tag" else "#link" if links else "#word"
                    (within if inside else outside)[key] += 1 if kind == "tag" else len(text.split())
            known = [k for k in within.keys() | outside.keys() if k in BLOCK or k in VOID or k in OFF_TAGS or k[0] == "#" or len(k) <= 6 and k.isalpha()]
            yield pd.DataFrame({"name": known, "within": [within[k] for k in known], "outside": [outside[k] for k in known]})

    sums = picked.mapInPandas(counted, "name string, within long, outside long").groupBy("name").agg(F.sum("within").alias("within"), F.sum("outside").alias("outside"))
    found = {r.name: (r.within, r.outside) for r in sums.collect()}  # names of the sampled pages
    if not found:
        return Weights()
    share = {k: (a + 1) / (a + b + 2) for k, (a, b) in found.items()}
    base = Weights()
    tags = base.tags | {k: -max(0.02, tag_cost * (1 - s)) for k, s in share.items() if k[0] != "#"}
    plain, link = max(0.5, share.get("#word", 1.0)), max(0.05, share.get("#link", base.link_word))
    words, others = found.get("#word", (0, 0))
    return Weights(plain, min(link, plain), min(10.0, max(1.0, (words + 1) / (others + 1))), base.named, tags, base.other_tag, plain * others / max(1, found.get("#page", (0, 1))[1]))


def text_of(weights: Weights):
    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([Page(page).text(weights) if page else "" for page in pages], dtype=object)

    return extracted


def extracted(pages: DataFrame, weights: Weights) -> DataFrame:
    """page_id, url and the main text of every row of pages (page_id, url, html)."""
    return pages.select("page_id", "url", text_of(weights)("html").alias("text"))


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extracted(pages, fit(pages)).withColumn("n_chars", F.length("text").cast("long"))
