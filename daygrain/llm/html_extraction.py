"""Main text of web pages: the contiguous run of words and tags with the highest score.

A page is read as a sequence of words and tags. Words score by the block they stand in and tags by
their name, words mostly above 0 and tags below; the weights are log odds counted on pages whose own
markup says where the article is. One linear scan finds the best run. No run crosses the border of an
article, and a run inside one stands for all of it. What is marked as menu, footer, sidebar, notice,
advert, form, script or comments scores no words and gives no text, wherever it is.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape
from itertools import accumulate
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distinct labelled pages that the weights are counted on.
SAMPLE = 2_000
#: Bounds of a weight, and the score of the border of an article.
LEAST, MOST, BORDER = -3.0, 3.0, -1e9

# Names of HTML elements.
#: Their content is no markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: They have no content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: They break the line they stand in.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "select summary table tbody td tfoot th thead tr ul".split()
)
#: They do not hold text of an article.
NO_TEXT = frozenset(
    "aside audio button canvas datalist dialog fieldset footer form head iframe menu nav noembed noframes noscript object "
    "optgroup option script select style svg template textarea title video".split()
)
#: An open element of the first kind ends where one of the others starts, within the last kind.
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Tags that stand in running text.
IN_TEXT = frozenset(
    "abbr b blockquote br cite code del dfn em figcaption figure h1 h2 h3 h4 h5 h6 i ins kbd mark p pre q s small span "
    "strong sub sup time u var wbr".split()
)
#: They hold a short text of their own.
CELLS = frozenset("caption dd dt li pre td th".split())

# Words in a class, an id or a role that mark what is not the article.
MARKS = frozenset(
    "ad ads adbox adslot adunit adsense aside banner breadcrumb breadcrumbs complementary consent contentinfo copyright "
    "dialog disclaimer gdpr legal login masthead menu menubar modal nav navbar navigation newsletter notice notices "
    "overlay pager pagination popup promo promotion recommended related search share sharing sidebar signup "
    "skip social sponsored subscribe subscription teaser teasers toolbar topbar".split()
)
MARK_STARTS = ("advert", "cookie", "footer", "navig", "sidebar", "sponsor")
#: The same for what readers have written.
COMMENT_STARTS = ("comment", "disqus", "replies", "reply")
#: In front of a mark: the element is about the mark, and is not it.
NOT_MARKED = frozenset("has is no not with without".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_REST = re.compile(r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>""")
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""")
_HUMP = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


@dataclass
class Page:
    """The words and tags of a page in order, as parallel lists."""

    texts: list[str] = field(default_factory=list)  # decoded text, empty for a tag
    names: list[str] = field(default_factory=list)  # a tag's name, or the block of a text
    words: list[int] = field(default_factory=list)  # words of a text, -1 for a tag
    elements: list[tuple[int, int, str, str]] = field(default_factory=list)  # first, end, name, mark of elements that count


def _marked(attributes: str) -> str:
    """``hidden``, ``comments``, ``marked`` or nothing, by the attributes of a tag."""
    found = ""
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), unescape(value.strip("\"'"))
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return "hidden"
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return "hidden"
        if name in ("class", "id", "role"):
            for token in value.split():
                parts = [p.lower() for p in re.split(r"[^A-Za-z]+", _HUMP.sub("-", token)) if p]
                if not parts or parts[0] in NOT_MARKED:
                    continue
                if any(p.startswith(COMMENT_STARTS) for p in parts):
                    found = "comments"
                elif any(p in MARKS or p.startswith(MARK_STARTS) for p in parts):
                    found = found or "marked"
    return found


def read_page(html: str) -> Page:
    """Words, tags and elements of a page. Reads any text; work is linear in it.

    End tags close what is open inside their element; an end tag without its element is skipped. A quote
    that is never closed does not hide the rest, a comment, script or style that is never closed does.
    """
    page = Page()
    stack: list[tuple[str, int, str, str, bool]] = []  # name, first, mark, block, in a link
    opened: Counter = Counter()
    at, end, quotes = 0, len(html), True

    def text(part: str) -> None:
        if part and not part.isspace():
            part = unescape(part)
        block, link = (stack[-1][3], stack[-1][4]) if stack else ("body", False)
        page.texts.append(part)
        page.names.append(block + " a" if link else block)
        page.words.append(len(part.split()))

    def tag(name: str) -> None:
        page.texts.append("")
        page.names.append(name)
        page.words.append(-1)

    def close() -> None:
        name, first, mark, _, _ = stack.pop()
        opened[name] -= 1
        if mark or name in ("article", "main", "header"):
            page.elements.append((first, len(page.names), name, mark))

    while at < end:
        start = html.find("<", at)
        found = _TAG.match(html, start) if start >= 0 else None
        while start >= 0 and not found and html[start + 1 : start + 2] not in ("!", "?", "/"):
            start = html.find("<", start + 1)  # a sign in the text
            found = _TAG.match(html, start) if start >= 0 else None
        text(html[at : start if start >= 0 else end])
        if start < 0:
            break
        if not found:
            close_mark = "-->" if html.startswith("<!--", start) else ">"
            stop = html.find(close_mark, start + 2)
            at = end if stop < 0 else stop + len(close_mark)
            continue
        rest = _REST.match(html, found.end()) if quotes else None
        if rest:
            at = rest.end()
        else:
            quotes = False  # the text from here has no end of a tag outside quotes
            stop = html.find(">", found.end())
            at = end if stop < 0 else stop + 1
        name = found[2].lower()
        if found[1]:
            if opened[name]:
                while stack[-1][0] != name:
                    close()
                tag(name)
                close()
            elif name in BLOCKS:
                tag(name)
            continue
        if name in BLOCKS and name != "hr" and opened["p"]:
            while opened["p"]:
                close()
        if name in ENDED_BY:
            ended, within = ENDED_BY[name]
            depth = len(stack) - 1
            while depth >= 0 and stack[depth][0] not in within and stack[depth][0] not in ended:
                depth -= 1
            while depth >= 0 and len(stack) > depth and stack[depth][0] in ended:
                close()
        first = len(page.names)
        tag(name)
        if name in VOID:
            continue
        if name in RAW:
            stop = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
            page.elements.append((first, first + 1, name, "tag"))
            at = end if not stop else max(html.find(">", stop.end()) + 1, stop.end())
            continue
        mark = "" if name in ("html", "body", "main") else _marked(html[found.end() : at - 1]) if at - found.end() > 1 else ""
        if name in NO_TEXT or (name == "article" and opened["article"]):
            mark = mark or "tag"
        block = name if name in BLOCKS else stack[-1][3] if stack else "body"
        stack.append((name, first, mark, block, name == "a" or bool(stack and stack[-1][4])))
        opened[name] += 1
    while stack:
        close()
    return page


def _covered(spans: list[tuple[int, int]], size: int) -> list[bool]:
    change = [0] * (size + 1)
    for first, end in spans:
        change[first] += 1
        change[end] -= 1
    return [depth > 0 for depth in accumulate(change[:-1])]


def without_text(page: Page) -> tuple[list[bool], list[tuple[int, int]]]:
    """For each word and tag whether it lies in what is not the article, and the spans of the articles.

    An element that holds the first article or the main part of the page is no menu or advert, whatever
    its name, unless it is hidden or holds comments; a header inside an article belongs to it.
    """
    elements = sorted(page.elements)
    never = _covered([(f, e) for f, e, _, mark in elements if mark in ("hidden", "comments")], len(page.names))
    first = []
    for kind in ("article", "main"):
        found = ((f, e) for f, e, name, mark in elements if name == kind and not mark and not never[f])
        first += [h for h in [next(found, None)] if h]
    dropped = []
    for f, e, name, mark in elements:
        if name == "header" and not any(h[0] <= f and e <= h[1] for h in first):
            mark = mark or "tag"
        holds = mark not in ("hidden", "comments") and any(f <= h[0] and h[1] <= e for h in first)
        if mark and not holds:
            dropped.append((f, e))
    out = _covered(dropped, len(page.names))
    articles, reach = [], -1
    for f, e, name, _ in elements:
        if name == "article" and f >= reach and not out[f]:
            articles.append((f, e))
            reach = e
    return out, articles


@dataclass(frozen=True)
class Weights:
    """Weight of a word by its block, and of a tag by its name.

    Behind the block stands ``a`` for words in a link and ``-`` for words outside the only article of their
    page. What was counted is added to a few occurrences that are assumed of each kind.
    """

    counts: dict[tuple[bool, str], tuple[int, int]] = field(default_factory=dict)

    def __call__(self, word: bool, name: str) -> float:
        inside, outside = self.counts.get((word, name), (0, 0))
        if word:
            block, _, where = name.partition(" ")
            before = (3, 1) if block in IN_TEXT else (2, 1) if block in CELLS else (4, 3)
            before = (1, 3) if where.endswith("-") else (1, 1) if where else before
        else:
            before = (3, 1) if name in IN_TEXT else (1, 3)
        weight = log((inside + before[0]) / (outside + before[1]))
        return max(LEAST, min(MOST, weight) if word else min(-0.1, weight))


def kinds_of(page: Page, articles: list[tuple[int, int]]) -> list[str]:
    """The name that the weight of each word and tag goes by."""
    if len(articles) != 1:
        return page.names
    (first, end), = articles
    return [
        name if words < 0 or first <= i < end else f"{name} -"
        for i, (name, words) in enumerate(zip(page.names, page.words, strict=True))
    ]


def best_run(scores: list[float]) -> tuple[int, int]:
    """First and end of the contiguous run with the highest sum; of equal ones the first. Empty if none is above 0."""
    best, low, high = 0.0, 0, 0
    total, first = 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, first = 0.0, i
        total += score
        if total > best:
            best, low, high = total, first, i + 1
    return low, high


def main_text(html: str | None, weights: Weights) -> str:
    """The blocks of the best run of a page, joined by line breaks."""
    page = read_page(html or "")
    out, articles = without_text(page)
    known: dict[tuple[bool, str], float] = {}
    scores = []
    for name, words, dropped in zip(kinds_of(page, articles), page.words, out, strict=True):
        word = words >= 0
        if word and (dropped or not words):
            scores.append(0.0)
            continue
        weight = known.get((word, name))
        if weight is None:
            weight = known[word, name] = weights(word, name)
        scores.append(weight * words if word else weight)
    for first, end in articles:
        scores[first] = BORDER
        if page.names[end - 1] == "article" and page.words[end - 1] < 0:
            scores[end - 1] = BORDER
        elif end < len(scores):
            scores[end] = BORDER  # an article that something else has ended
    low, high = best_run(scores)
    for first, end in articles:
        if first <= low < end:
            low, high = first, end
            break
    blocks: list[str] = []
    line: list[str] = []
    for i in range(low, high):
        if page.words[i] < 0:
            if page.names[i] in BLOCKS:
                blocks.append("".join(line))
                line = []
            elif page.names[i] == "br":
                line.append(" ")
        elif not out[i]:
            line.append(page.texts[i])
    blocks.append("".join(line))
    return "\n".join(b for b in (" ".join(block.split()) for block in blocks) if b)


def labelled_counts(html: str) -> Counter:
    """(word, name, inside) -> how often, of a page with one article; of any other page nothing.

    What is marked as no text is not counted: for that no weights are needed.
    """
    page = read_page(html)
    out, articles = without_text(page)
    counts: Counter = Counter()
    if len(articles) != 1:
        return counts
    (first, end), = articles
    for i, (name, words) in enumerate(zip(kinds_of(page, articles), page.words, strict=True)):
        if not out[i] and words and i not in (first, end - 1):
            known = name if name.split(" ")[0] in BLOCKS | IN_TEXT | VOID | {"a"} else ""
            if known:
                counts[words > 0, known, first <= i < end] += max(1, words)
    return counts


def learn_weights(pages: DataFrame, sample: int = SAMPLE, html_col: str = "html") -> Weights:
    """Log odds counted on the ``sample`` distinct pages of smallest hash whose markup names one article.

    Pages are counted where they lie; the driver gets a number for each kind of word and tag.
    """
    html = pages.select(F.col(html_col).alias("html")).filter(F.lower("html").contains("<article"))
    hashed = html.select("html", F.xxhash64("html").alias("hash"))
    last = hashed.select("hash").distinct().orderBy("hash").limit(sample).agg(F.max("hash")).first()[0]
    if last is None:
        return Weights()
    chosen = hashed.filter(F.col("hash") <= last).groupBy("hash").agg(F.first("html").alias("html")).select("html")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for html in batch.column(0).to_pylist():
                total.update(labelled_counts(html))
        columns = [list(c) for c in zip(*(k for k in total), strict=True)] if total else [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.bool_()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.bool_()), pa.array(total.values(), pa.int64())],
            ["word", "name", "inside", "n"],
        )

    counted = chosen.mapInArrow(count, "word boolean, name string, inside boolean, n long")
    totals = counted.groupBy("word", "name", "inside").agg(F.sum("n").alias("n")).collect()
    counts: dict[tuple[bool, str], tuple[int, int]] = {}
    for r in totals:
        inside, outside = counts.get((r.word, r.name), (0, 0))
        counts[r.word, r.name] = (inside + r.n, outside) if r.inside else (inside, outside + r.n)
    return Weights(counts)


def extract_main_text(
    pages: DataFrame, weights: Weights, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row.

    ``text`` is the article without menus, headers, footers, sidebars, notices, adverts, forms, scripts,
    styles, markup and comments: character references decoded, white space in a block turned into one
    space, blocks in page order joined by a line break. ``n_chars`` counts code points.

    Pages are read where they lie, one at a time; nothing is shuffled, and a page of any length is read
    whole, in memory in proportion to it. A null or empty page, and one where no run scores above 0, has an
    empty text. Of equal runs the first counts. Null ids and urls stay null, repeated rows each get
    their row, an empty table gives none. Other columns are ignored, whatever their names.
    """
    kinds = dict(pages.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py(), weights) for html in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    taken = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return taken.mapInArrow(run, f"page_id {kinds[id_col]}, url {kinds[url_col]}, text string, n_chars long")
