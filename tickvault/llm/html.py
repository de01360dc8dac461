"""HTML extraction by tag-path ratios.

A page is read into blocks; each block knows its tag path, a node of a trie of tags from the root. For each path the
length and the punctuation of its blocks are added up: its ratio is its text a block, raised by punctuation a block.
Ratios are smoothed along the page and fused with the path's own. What is fused is weighed by priors, and blocks that
reach THRESHOLD of the largest weighed ratio are content. Priors are 0 for the furniture of a page by its tag (nav,
footer, aside, menu, a page's header, what is hidden), ARTICLE inside an article or main element, and less than one
where the class, id or role of an element tells of furniture: NAMED if it says nothing else, HALF_NAMED if it does. A name
does not count on what holds an article or a main element, or most of the text of a page without them, as a form does not; on a leaf such
as a paragraph it counts by the share of its path's text that is named, so one odd paragraph among many stays.

Short blocks between content have low ratios of their own: an element in which content is half of the text or more is
kept whole, unless it holds an article or a main element, but for blocks of a lower prior than its content; and so is
what lies between the content blocks of a page that has no article. Headings just before it belong to it.

Defined results: a null page is empty, and a page without content gives the empty text; an empty table gives no rows;
repeated rows and null ids are pages of their own; columns other than page_id, url and html are not passed on, whatever
their names. Very long and very deep pages take time and memory in proportion to their size.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickvault.llm.common import table
from tickvault.llm.tokens import mapped, texts

#: Elements whose text is never content.
SILENT = frozenset("script style noscript template iframe svg math object embed canvas audio video map head title select option textarea button datalist dialog".split())
#: Elements that are furniture of a page.
FURNITURE = frozenset("nav footer aside menu".split())
#: Words of a class, id or role that tell of furniture.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored banner banners promo promos promotion cookie cookies consent gdpr notice notices alert popup modal overlay paywall subscribe subscription newsletter signup login sidebar sidebars "
    "side aside rail menu menus nav navbar navigation breadcrumb breadcrumbs crumbs topbar masthead footer foot comment comments commentlist disqus replies reply respond responses share sharing social related recommended recommendations "
    "widget widgets pagination pager toolbar search searchform skip tags copyright legal disclaimer".split()
)
#: Words that say nothing beside such a word.
GENERIC = frozenset("list lists inner outer container wrapper wrap box block area section item items link links post posts content left right top bottom main page site row col column text body form icon group bar slot unit module js the of".split())
#: A header is one of the page, and furniture, unless its name tells of the article.
OF_ARTICLE = frozenset("article post entry story content title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre section summary table caption thead tbody tfoot tr td th ul".split()
)
#: Elements that a tag of the key's kind closes, up to the nearest of the bounds.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BOUNDS = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements of text, whose names say little.
LEAVES = HEADINGS | frozenset("p li dd dt td th blockquote pre figcaption caption summary address".split())
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
SPACE = re.compile(r"\s+")
THRESHOLD = 0.35
#: Priors, and the share of content from which an element is kept whole.
ARTICLE, NAMED, HALF_NAMED, FORM, MOSTLY = 4.0, 0.02, 0.4, 0.1, 0.5


def name_prior(attrs: list[tuple[str, str | None]]) -> float:
    """NAMED if the words of a class, id or role tell of furniture and of nothing else, HALF_NAMED if some do, else 1."""
    prior = 1.0
    for name, value in attrs:
        if name in ("class", "id", "role"):
            words = {w.lower() for w in WORD.findall(value or "")}
            told = words & HINTS
            if "header" in words and not words & OF_ARTICLE:
                told = told | {"header"}
            if told:
                prior = min(prior, NAMED if words <= told | GENERIC else HALF_NAMED)
    return prior


def hidden(attrs: list[tuple[str, str | None]]) -> bool:
    return any(name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value or "", re.I) for name, value in attrs)


class Blocks(HTMLParser):
    """Blocks of a page, (element, text) in order, and its elements and tag paths by number; what holds comes before what it holds."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[int] = []
        self.opened: Counter[str] = Counter()  # open elements by tag
        self.paths: dict[tuple[int, str], int] = {}  # the trie: (path of the parent, tag) -> path
        # of each element: tag, parent, path, whether furniture, whether inside an article or main, prior by its name
        self.tag, self.parent, self.path, self.furniture, self.article, self.prior = [], [], [], [], [], []
        self.holds: list[bool] = []  # whether an article or a main element lies inside
        self.blocks: list[tuple[int, str]] = []
        self.text: list[str] = []
        self.silent: list[str] = []

    def flush(self) -> None:
        text = SPACE.sub(" ", "".join(self.text)).strip()
        self.text.clear()
        if text:
            self.blocks.append((self.open[-1] if self.open else -1, text))

    def cut(self, k: int) -> None:
        """Closes all elements from the k-th open one on."""
        self.flush()
        for e in self.open[k:]:
            self.opened[self.tag[e]] -= 1
        del self.open[k:]

    def shut(self, tags: tuple[str, ...], bounds: tuple[str, ...]) -> None:
        """Closes the innermost of these elements, unless a bound is nearer."""
        if not any(self.opened[t] for t in tags):
            return
        for k in range(len(self.open) - 1, -1, -1):
            tag = self.tag[self.open[k]]
            if tag in tags:
                self.cut(k)
                return
            if tag in bounds:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in SILENT:
            if tag == "head" or tag not in VOID:
                self.silent.append(tag)
            return
        if self.silent:
            if self.silent == ["head"] and tag == "body":
                self.silent.clear()
            else:
                return
        if tag == "br":
            self.text.append(" ")
        if tag not in BLOCK:
            return
        self.flush()
        self.shut(("p", *HEADINGS) if tag in HEADINGS else ("p",), ("article", "section", "div", "td", "th", "li", "body", "main", "blockquote", "table"))
        if tag in CLOSES:
            self.shut(CLOSES[tag], BOUNDS[tag])
        if tag in VOID:
            return
        whole, up = tag in ("html", "body", "article", "main"), self.open[-1] if self.open else -1
        inside = up >= 0 and self.article[up]
        furniture = up >= 0 and self.furniture[up] or tag in FURNITURE or not whole and hidden(attrs) or tag == "header" and not inside
        named = 1.0 if tag in ("html", "body", "main") else name_prior(attrs)
        self.tag.append(tag)
        self.parent.append(up)
        self.path.append(self.paths.setdefault((self.path[up] if up >= 0 else -1, tag), len(self.paths)))
        self.furniture.append(furniture)
        self.article.append(inside or tag == "main" or tag == "article")
        self.prior.append(min(named, FORM) if tag == "form" else named)
        self.holds.append(False)
        if tag == "main" or tag == "article" and named == 1:  # comments and teasers may be articles by their tag
            for e in reversed(self.open):
                if self.holds[e]:
                    break
                self.holds[e] = True
        self.open.append(len(self.tag) - 1)
        self.opened[tag] += 1

    def handle_endtag(self, tag: str) -> None:
        if self.silent:
            if tag in self.silent:
                while self.silent.pop() != tag:
                    pass
            return
        if tag not in BLOCK or tag in VOID or not self.opened[tag]:
            return
        for k in range(len(self.open) - 1, -1, -1):
            own = self.tag[self.open[k]]
            if own == tag:
                self.cut(k)
                return
            if tag == "p" and own in ("article", "section", "div", "body", "main"):
                return

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.text.append(data)

    def close(self) -> None:
        super().close()
        self.flush()

    def summed(self, of_blocks: list[float]) -> list[float]:
        """What the blocks below each element add up to."""
        total = [0.0] * len(self.tag)
        for (e, _), x in zip(self.blocks, of_blocks):
            if e >= 0:
                total[e] += x
        for e in range(len(total) - 1, -1, -1):
            if self.parent[e] >= 0:
                total[self.parent[e]] += total[e]
        return total


def _marks(text: str) -> int:
    return sum(unicodedata.category(c)[0] == "P" for c in text if not c.isalnum() and not c.isspace())


def fused_ratios(paths: list[int], texts: list[str]) -> list[float]:
    """The ratio of each block's path, smoothed along the page and fused with itself."""
    length, marks, count = Counter(), Counter(), Counter()
    for path, text in zip(paths, texts):
        length[path] += len(text)
        marks[path] += _marks(text)
        count[path] += 1
    ratio = {k: length[k] / count[k] * (1 + math.log1p(marks[k] / count[k])) for k in count}
    own = [ratio[k] for k in paths]
    edge = [own[0], *own, own[-1]] if own else []
    smooth = [(a + 2 * b + c) / 4 for a, b, c in zip(edge, edge[1:], edge[2:])]
    return [math.sqrt(a * b) for a, b in zip(own, smooth)]


def priors(page: Blocks) -> list[float]:
    """The prior of each block, by the elements that hold it."""
    length = [float(len(text)) for _, text in page.blocks]
    below = page.summed([0.0 if e >= 0 and page.furniture[e] else n for (e, _), n in zip(page.blocks, length)])
    most = sum(n for (e, _), n in zip(page.blocks, length) if e < 0 or not page.furniture[e]) / 2
    per_path, told = Counter(), Counter()
    for (e, _), n in zip(page.blocks, length):
        if e >= 0:
            per_path[page.path[e]] += n
            told[page.path[e]] += n * (page.prior[e] < 1)
    has_article = any(a and p == 1 and n and not f for a, p, n, f in zip(page.article, page.prior, below, page.furniture))
    found: list[float] = []
    for e, up in enumerate(page.parent):
        own = page.prior[e]
        if own < 1 and (page.holds[e] or not has_article and below[e] > most):
            own = 1.0
        elif own < 1 and page.tag[e] in LEAVES and per_path[page.path[e]]:
            own = 1.0 if page.article[e] or 2 * told[page.path[e]] <= per_path[page.path[e]] else own
        found.append(0.0 if page.furniture[e] else own * (found[up] if up >= 0 else 1.0) * (ARTICLE if page.article[e] and not (up >= 0 and page.article[up]) else 1.0))
    return [found[e] if e >= 0 else 1.0 for e, _ in page.blocks]


def main_blocks(html: str, threshold: float = THRESHOLD) -> list[str]:
    page = Blocks()
    page.feed(html)
    page.close()
    weight = priors(page)
    shown = [k for k, w in enumerate(weight) if w > 0]
    if not shown:
        return []
    page.blocks, weight = [page.blocks[k] for k in shown], [weight[k] for k in shown]
    score = [w * f for w, f in zip(weight, fused_ratios([page.path[e] if e >= 0 else -1 for e, _ in page.blocks], [t for _, t in page.blocks]))]
    limit = threshold * max(score)
    content = [s >= limit for s in score]
    # elements that are content for the most part are kept whole, but for blocks of a lower prior than their content has
    length = [float(len(t)) for _, t in page.blocks]
    usual = min(w for w, c in zip(weight, content) if c)
    plain = [w >= usual for w in weight]
    all_text = page.summed([n * p for n, p in zip(length, plain)])
    of_content = page.summed([n * c for n, c in zip(length, content)])
    kept: list[bool] = []
    for e, up in enumerate(page.parent):
        kept.append(up >= 0 and kept[up] or page.tag[e] not in ("html", "body") and not page.holds[e] and of_content[e] > 0 and of_content[e] >= MOSTLY * all_text[e])
    chosen = [c or p and e >= 0 and kept[e] for (e, _), c, p in zip(page.blocks, content, plain)]
    first, last = chosen.index(True), len(chosen) - 1 - chosen[::-1].index(True)
    if not any(page.article[e] for (e, _), c in zip(page.blocks, chosen) if c and e >= 0):
        chosen[first : last + 1] = [c or p for c, p in zip(chosen[first : last + 1], plain[first : last + 1])]
        while first and plain[first - 1] and page.blocks[first - 1][0] >= 0 and page.tag[page.blocks[first - 1][0]] in HEADINGS:
            first -= 1
            chosen[first] = True
    return [text for (_, text), c in zip(page.blocks, chosen) if c]


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text: the blocks of the article, joined by blank lines."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = ["\n\n".join(main_blocks(h)) for h in texts(batch.column(2))]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string())], ["page_id", "url", "text"])

    return pages.select(F.col("page_id").cast("bigint"), "url", "html").mapInArrow(mapped(run), "page_id bigint, url string, text string")


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
