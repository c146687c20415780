"""Main text of web pages by text-to-tag ratio.

The standard library's parser streams events. Text between block boundaries is a *line*,
with the tags met since the last one. A line's ratio is its characters by its tags; a
Gaussian kernel smooths the ratios along the page, and the lines above a threshold (a share
of their spread) form the clusters of content. Lines in elements that by tag, role or name
are menus, headers, footers, sidebars, notices, adverts, forms or reader comments never
count; an element that only its name, its role or being a form speaks against counts if it
holds the page's article or most of the clusters' text (a layout's wrapper). Inside an article a
name must be a whole class, or its element hold few characters a tag, to drop it. The main text is all
that is left inside the article that holds nearly all of the clusters' text (and the articles
beside it in one <main>), or without one inside the smallest container that holds all clusters:
short paragraphs of the article stay, blocks beside it go.

Elements are numbered as they open and know what they stand in, and open tags are looked up by
name, so the work is in proportion to the page however deep it is nested.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbend.llm.pieces import groups

SIGMA, CUT, HOLDS = 1.5, 0.25, 0.9

#: Fixed values of HTML: elements by what they are.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre
    section summary table tbody td tfoot th thead tr ul""".split())
SILENT = frozenset("""head script style noscript template iframe object svg canvas audio video title
    button select option textarea datalist""".split())
ASIDE = frozenset("nav header footer aside menu dialog".split())
#: These hold the end tags of what they do not contain.
HOLDERS = ASIDE | frozenset("form table".split())
CONTAINER = frozenset("html body main article section div td center".split())
ENDS_P = BLOCK - frozenset({"body", "html"})
#: An open element that the start of one of these closes, up to the list or table it stands in.
SAME = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"})}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
#: Words in a class or id that name what is beside the main text.
NAMES = frozenset("""ad ads adbox adslot adsense advert adverts advertisement advertising sponsor sponsored promo
    promotion banner masthead nav navbar navigation menu breadcrumb breadcrumbs header footer sidebar
    aside widget widgets related recommended share sharing social newsletter subscribe signup
    login cookie cookies consent gdpr notice notices alert popup modal overlay paywall comment
    comments commentlist discussion disqus replies respond toolbar pagination pager skip copyright
    disclaimer tags hidden""".split())
#: Of these, what readers write: it may be longer than the article.
READERS = frozenset("comment comments commentlist discussion disqus replies respond".split())
#: A name after one of the first, or before one of the second, tells what a layout has.
HAS, WRAPS = frozenset("has no not with without".split()), frozenset("wrap wrapper layout".split())
#: Class tokens of the article itself: a part of another token does not outweigh them.
ARTICLE = frozenset("post entry hentry article content story main".split())
#: How surely a name speaks against an element: a part of a token, a whole token, a form or a role,
#: readers' comments.
PART, WHOLE, ROLE, COMMENT = 1, 2, 3, 4
SPLIT = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")


def named(value: str) -> int:
    """How surely a class or id names what is beside the main text; 0: not at all."""
    found, article = 0, False
    for token in value.split():
        words = [w.lower() for w in SPLIT.split(token) if w]
        if not words:
            continue
        article = article or "-".join(words) in ARTICLE
        if all(w in NAMES for w in words):
            found = max(found, COMMENT if READERS.intersection(words) else WHOLE)
        elif not HAS.intersection(words) and words[-1] not in WRAPS and (words[0] in NAMES or words[-1] in NAMES):
            found = max(found, PART)
    return 0 if article and found == PART else found


def beside(tag: str, attrs: list[tuple[str, str | None]]) -> tuple[bool, int]:
    """Does the element stand beside the main text for certain, and how surely by its name?"""
    if tag in ASIDE:
        return True, 0
    if tag in ("html", "body", "main", "article"):
        return False, 0
    name = ROLE if tag == "form" else 0
    for key, value in attrs:
        if key in ("class", "id") and value:
            name = max(name, named(value))
        elif key == "role" and (value or "").lower() in ROLES:
            name = max(name, ROLE)
        elif key == "hidden":
            return True, 0
        elif key == "style" and "display:none" in (value or "").replace(" ", "").lower():
            return True, 0
        elif key == "aria-hidden" and value == "true":
            return True, 0
    return False, name


class Lines(HTMLParser):
    """Lines of a page in page order: (pieces, tags, container), a piece being (text, innermost
    element that its name speaks against). Containers and named elements are numbers, 0 for
    none; what one stands in has a smaller number."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[list[tuple[str, int]], int, int]] = []
        self.stack: list[tuple[str, bool, bool, bool]] = []  # tag, silent, beside, named
        self.places: dict[str, list[int]] = {}  # open tags: where in the stack
        self.kinds, self.outer, self.depth = [""], [0], [0]  # by container
        self.marked = [False]  # is it in an article or main?
        self.above = [0]  # the named element that a container stands in
        self.names, self.around, self.within = [0], [0], [False]  # by named element: how surely, what it is in, in an article?
        self.container = self.named = 0
        self.text: list[tuple[str, int]] = []
        self.tags = self.silent = self.beside = 0

    def end_line(self) -> None:
        if any(text.strip() for text, _ in self.text):
            self.lines.append((self.text, self.tags, self.container))
            self.tags = 0
        self.text = []

    def without(self, dropped: list[bool]) -> list[tuple[str, int, int]]:
        """(text, tags, container) of the lines, less what is inside the ``dropped``."""
        out, tags = [], 0
        for pieces, more, container in self.lines:
            tags += more
            text = " ".join("".join([t for t, of in pieces if not dropped[of]]).split())
            if text:
                out.append((text, max(1, tags), container))
                tags = 0
        return out

    def dropped(self) -> list[bool]:
        """By named element: does it stand beside the main text, or in one that does? Not those
        that hold a <main>, the page's only <article>s or most of the clusters' text."""
        n, free = len(self.names), False
        gone = [False] * n
        if n == 1:
            return gone
        holds = [0] * n  # 1: an article inside, 2: a main
        for c, kind in enumerate(self.kinds):
            if kind in ("article", "main"):
                free = free or not self.above[c]
                holds[self.above[c]] = max(holds[self.above[c]], 2 if kind == "main" else 1)
        lines = self.without(gone)
        size, dense, weight, total = [0] * n, [0] * n, [0] * n, 0
        own, ratios, cut = rated(lines) if lines else ([], [], 0)
        rates = iter(zip(own, ratios))
        for pieces, _, _ in self.lines:
            if not "".join(t for t, _ in pieces).strip():
                continue
            o, r = next(rates)
            for text, of in pieces:
                k = len("".join(text.split()))
                size[of] += k
                dense[of] += k * (o >= cut / 2)
                weight[of] += k * (o >= cut / 2 and r >= cut)
                total += k * (o >= cut / 2 and r >= cut)
        for e in range(n - 1, 0, -1):  # outwards
            out = self.around[e]
            for sums in (size, dense, weight):
                sums[out] += sums[e]
            holds[out] = max(holds[out], holds[e])
        for e in range(1, n):
            sure = self.names[e]
            if self.within[e] and sure == PART and 2 * dense[e] > size[e]:
                out = False  # in an article, a part of a class name does not outweigh lines of text
            elif sure == COMMENT:
                out = holds[e] != 2
            else:
                most = 0.9 if sure == ROLE else 0.5
                out = holds[e] != 2 and (free or not holds[e]) and weight[e] <= most * total
            gone[e] = out or gone[self.around[e]]
        return gone

    def pop(self) -> None:
        tag, silent, beside_, name = self.stack.pop()
        self.places[tag].pop()
        if tag in BLOCK:
            self.end_line()
        self.silent -= silent
        self.beside -= beside_
        if name:
            self.named = self.around[self.named]
        if tag in CONTAINER:
            self.container = self.outer[self.container]

    def innermost(self, tags: set[str] | frozenset[str]) -> int:
        """Where in the stack the innermost open element of ``tags`` is; -1: there is none."""
        return max([at[-1] for t in tags if (at := self.places.get(t))], default=-1)

    def close_to(self, tags: set[str] | frozenset[str], within: set[str] | frozenset[str]) -> None:
        """Close the innermost open element of ``tags``, unless one of ``within`` is inside it."""
        k = self.innermost(tags)
        if k >= 0 and k >= self.innermost(within):
            while len(self.stack) > k:
                self.pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in ENDS_P:
            self.close_to({"p"}, CONTAINER | {"table", "li", "blockquote", "button"})
        if tag in SAME:
            self.close_to(*SAME[tag])
        if tag == "body":
            self.close_to({"head"}, set())
        if tag in BLOCK:
            self.end_line()
        if tag == "br":
            self.text.append((" ", self.named))
        if tag in VOID:
            return
        aside, sure = beside(tag, attrs)
        if tag == "header" and self.marked[self.container]:
            aside = False  # the article's own, with its title
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, tag in SILENT, aside, sure > 0))
        self.silent += tag in SILENT
        self.beside += aside
        if sure:
            self.names.append(sure)
            self.around.append(self.named)
            self.within.append(self.marked[self.container])
            self.named = len(self.names) - 1
        if tag in CONTAINER:
            self.kinds.append(tag)
            self.outer.append(self.container)
            self.depth.append(self.depth[self.container] + 1)
            self.marked.append(self.marked[self.container] or tag in ("article", "main"))
            self.above.append(self.named)
            self.container = len(self.kinds) - 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag == "br":
            self.text.append((" ", self.named))
        # an end tag inside a cell or the like does not close what is outside it
        self.close_to({tag}, set() if tag in CONTAINER | HOLDERS else CONTAINER | HOLDERS)

    def handle_data(self, data: str) -> None:
        if not self.silent and not self.beside:
            self.text.append((data, self.named))


def smoothed(ratios: list[float], sigma: float = SIGMA) -> list[float]:
    """Gaussian kernel of two deviations to either side, normalised at the ends."""
    reach = math.ceil(2 * sigma)
    kernel = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-reach, reach + 1)]
    out = []
    for i in range(len(ratios)):
        near = [(kernel[j - i + reach], ratios[j]) for j in range(max(0, i - reach), min(len(ratios), i + reach + 1))]
        out.append(sum(w * r for w, r in near) / sum(w for w, _ in near))
    return out


def rated(lines: list[tuple[str, int, int]]) -> tuple[list[float], list[float], float]:
    """Of the lines: their own ratios, the smoothed ones, and the threshold of a cluster, ``CUT``
    of the way from the least smoothed ratio to the greatest."""
    own = [len(text) / tags for text, tags, _ in lines]
    ratios = smoothed(own)
    return own, ratios, min(ratios) + CUT * (max(ratios) - min(ratios))


def content_lines(lines: list[tuple[str, int, int]]) -> list[bool]:
    """Which lines are in a cluster of content: the smoothed ratio reaches the threshold, and
    the line's own ratio half of it, so that a row of links beside a long paragraph does not
    count."""
    own, ratios, cut = rated(lines)
    return [r >= cut and o >= cut / 2 for r, o in zip(ratios, own)]


def whole_tags(html: str) -> str:
    """The page without what it does not finish: a comment without end hides the rest, and what
    follows the last tag is text up to a tag without end. The parser would look for those ends
    again from each start."""
    comment = html.find("<!--", max(0, html.rfind("-->") + 3, html.rfind("--!>") + 4) if "-->" in html or "--!>" in html else 0)
    if comment >= 0:
        html = html[:comment]
    html = html.replace("<![", "<!-[")  # to the parser a comment up to the next ">", as in browsers
    tail = html.rfind(">") + 1
    cut = re.compile(r"<[A-Za-z/!?]").search(html, tail)
    return html[:cut.start()] if cut else html


def main_text(html: str | None) -> str:
    """The main text of a page; empty for null, empty or text-free pages."""
    parser = Lines()
    parser.feed(whole_tags(html or ""))
    parser.close()
    while parser.stack:
        parser.pop()
    parser.end_line()
    lines = parser.without(parser.dropped())
    if not lines:
        return ""
    if any(parser.marked[c] for _, _, c in lines):  # the page marks its article
        lines = [x for x in lines if parser.marked[x[2]]]
    n = len(parser.kinds)
    weight, total = [0] * n, 0
    for (text, _, container), keep in zip(lines, content_lines(lines)):
        if keep:
            total += len(text)
            weight[container] += len(text)
    for c in range(n - 1, 0, -1):  # outwards
        weight[parser.outer[c]] += weight[c]
    marked = [c for c in range(1, n) if weight[c] and weight[c] >= HOLDS * total and parser.kinds[c] in ("article", "main")]
    # the article as the page marks it, or else the innermost container of all clusters
    holding = marked or [c for c in range(1, n) if weight[c] == total]
    if not holding:
        return "\n".join(text for text, _, _ in lines)
    place = max(holding, key=lambda c: parser.depth[c])
    in_main = [0] * n  # the <main> that a container stands in
    taken = [False] * n
    for c in range(1, n):
        in_main[c] = c if parser.kinds[c] == "main" else in_main[parser.outer[c]]
    for c in range(1, n):  # with an article, all articles of the same <main>
        beside_it = parser.kinds[c] == parser.kinds[place] == "article" and in_main[place] and in_main[c] == in_main[place]
        taken[c] = c == place or bool(beside_it) or taken[parser.outer[c]]
    return "\n".join(text for text, _, c in lines if taken[c])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row.

    Null or empty html: empty text. Any string is taken: unclosed, crossed and unknown tags
    are closed as browsers do in the common cases. Repeated rows come back each; an empty
    table gives no rows; only the three named columns are read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(t) for part in groups(b.column("h")) for t in part]
            yield pa.RecordBatch.from_arrays(
                [b.column("i"), b.column("u"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    return (pages.select(F.col(id_col).alias("i"), F.col(url_col).alias("u"), F.col(html_col).alias("h"))
            .mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint"))
