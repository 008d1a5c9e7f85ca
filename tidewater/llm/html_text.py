"""Main text of web pages by site template removal.

Every page is parsed into an element tree and the subtrees of its block elements are
hashed.  Spark counts, for each host, on how many pages of different articles a
subtree occurs, apart for subtrees in an article or main element and outside of them.  Outside, a
subtree on at least ``min_pages`` different articles is the site's template, however large the
site; running text (paragraphs and headings) and whatever stands in an article must be on half of
the host's articles, too, since sentences recur.  Template subtrees are deleted wherever they occur.
Pages with one heading count as one article, so copies of a page don't turn its paragraphs into a
template; on a host where half the different texts have the same first heading (a site's name or
logo), the title tells articles apart, and where that is the same too, the whole text.  What of
the template stays is decided by element: template paragraphs that are more than half of the text
of the element around them are the article of near copies and stay; and a page of which only
headings would be left keeps its text.  What a page marks as not its article (navigation, page
header and footer, sidebar, forms, adverts, notices, comments, scripts, styles, hidden parts) goes by
its mark-up, since such parts often differ from page to page; a class or id says so outside of
articles by a listed word in it, inside them only by being one (``related-work`` is no ``related``).
If there is an article or main element, only its content counts.

Pages are parsed one at a time, once for the counts and once for the text; a page is bounded memory.  Counts are pre-aggregated, so a
hot host costs no more than others, and a host's template is a few hashes (each on half of
its articles).

Defined results: null and empty html give an empty text; a page without a url belongs to
the host ''; broken mark-up is read as browsers do in the main (implied end tags, unknown end
tags skipped, references without semicolons); repeated rows give repeated rows; an empty
table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import need, ship_by_value

MIN_PAGES, MIN_SHARE = 8, 0.5
#: The largest share of an element's text that can be template paragraphs directly in it; more are an article's near copy.
MOST = 0.5

ship_by_value(__name__)

#: Mark-up that isn't the article.
DROPPED = frozenset("head script style noscript template nav footer aside form iframe svg math object embed canvas "
                    "button select textarea datalist dialog menu audio video map".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 title".split())
RUNNING = frozenset("p blockquote pre".split())
#: A start tag closes an open element of these kinds, if no element of the second set is between.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)), "body": (("head",), ()),
}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar "
                  "toolbar form".split())
LISTED = (
    r"ads?|adv|advert\w*|adsense|sponsor\w*|promo\w*|banners?|nav\w*|menus?|breadcrumbs?|sidebars?|side-bar|"
    r"widgets?|footers?|masthead|site-header|page-header|topbar|cookies?|consent|gdpr|notices?|notification|popups?|modal|"
    r"overlay|newsletter|subscribe|subscription|signup|sign-up|login|social|share|sharing|comments?|commentlist|disqus|"
    r"replies|related|recommend\w*|pagination|pager|toolbar|skip-link|hidden")
#: Of a class or id: a listed word somewhere in it; a name of a whole part, inside articles.
NAMES = re.compile(rf"(?:^|[\s_-])(?:{LISTED})(?:$|[\s_-])", re.I)
WHOLE = re.compile(rf"(?:^|\s)(?:{LISTED}|(?:comments?|replies|disqus)[_-](?:list|area|section|thread|form)|(?:ad|advert)[_-](?:box|slot|unit))(?:$|\s)", re.I)
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|replies)(?:$|[\s_-])", re.I)
_ATTRS = r"(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+"
TOKEN = re.compile(
    rf"<!--.*?(?:--!?>|\Z)|<(?P<raw>script|style|textarea|title|noscript|iframe)\b{_ATTRS}>(?P<content>.*?)(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>{_ATTRS})>|<[!?/][^>]*>", re.S | re.I)
ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


#: Deeper elements are read as parts of the element at this depth, as browsers do.
DEPTH = 512


class Element:
    """inside: an article; comments: of readers; unseen: in something that's dropped; spared: kept
    even if it is template."""

    __slots__ = ("tag", "parts", "drop", "inside", "comments", "unseen", "digest", "spared")

    def __init__(self, tag: str, drop: bool, parent: Element | None = None, comments: bool = False) -> None:
        self.tag, self.drop, self.digest, self.spared = tag, drop, 0, False
        self.inside = tag in ("article", "main") or parent is not None and parent.inside
        self.comments = comments or parent is not None and parent.comments
        self.unseen = drop or parent is not None and parent.unseen
        self.parts: list[str | Element] = []


def attributes(raw: str) -> dict[str, str]:
    return {m[0].lower(): m[1] or m[2] or m[3] for m in ATTR.findall(raw)} if raw else {}


def unwanted(tag: str, attrs: dict[str, str], inside: bool) -> bool:
    """Whether an element's mark-up says that it isn't article text; inside: of an article."""
    if tag in DROPPED or tag == "header" and not inside:
        return True
    if not attrs or tag in ("html", "body", "main"):
        return False
    style = attrs.get("style", "").replace(" ", "").lower()
    names = WHOLE if inside else NAMES
    return ("hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in style
            or attrs.get("role", "").lower() in ROLES
            or bool(names.search(attrs.get("class", "")) or names.search(attrs.get("id", ""))))


def pop_to(stack: list[Element], tags: tuple, until: tuple) -> None:
    """Close the innermost open element of ``tags``, unless one of ``until`` is further in."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            del stack[i:]
            return
        if stack[i].tag in until:
            return


def open_paragraph(stack: list[Element]) -> None:
    """A block's start or end closes an open paragraph and the inline elements in it."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == "p":
            del stack[i:]
            return
        if stack[i].tag not in INLINE:
            return


def parse(html: str) -> Element:
    """The element tree; the content of scripts, styles and comments is left out."""
    root = Element("#root", False)
    stack, at = [root], 0
    for m in TOKEN.finditer(html):
        if at < m.start():
            stack[-1].parts.append(html[at:m.start()])
        at = m.end()
        if m["raw"]:
            if m["raw"].lower() == "title":
                title = Element("title", True)
                title.parts.append(m["content"])
                stack[-1].parts.append(title)
            continue
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if m["end"]:
            if tag == "br":
                stack[-1].parts.append(" ")
            elif tag in INLINE or tag == "p":  # only within its block
                pop_to(stack, (tag,), ("article", "main", "section", "div", "table", "td", "th", "li", "body"))
                if tag == "p":
                    stack[-1].parts.append(Element("p", False))  # a boundary, even if none was open
            else:
                pop_to(stack, (tag,), () if tag in ("article", "main", "body", "html") else ("article", "main"))
            continue
        attrs = attributes(m["attrs"])
        if tag not in INLINE:
            open_paragraph(stack)
        if tag in CLOSES:
            pop_to(stack, *CLOSES[tag])
        drop = unwanted(tag, attrs, stack[-1].inside)
        if tag in ("article", "main") and not drop and stack[-1].unseen and not stack[-1].comments:
            for i, e in enumerate(stack):  # an advert or menu that was never closed doesn't hold the article
                if e.drop:
                    del stack[i:]
                    break
        e = Element(tag, drop, stack[-1], drop and bool(COMMENTS.search(attrs.get("class", "")) or COMMENTS.search(attrs.get("id", ""))))
        stack[-1].parts.append(e)
        if tag not in VOID and len(stack) < DEPTH and not (m["attrs"].endswith("/") and tag not in ("p", "div", "article", "main")):
            stack.append(e)
    if at < len(html):
        stack[-1].parts.append(html[at:])
    return root


def plain(raw: str) -> str:
    return " ".join(unescape(raw).split())


def hash_subtrees(root: Element, seen: dict[int, Element]) -> None:
    """Fill ``digest`` of every element (tag, content, whether it is inside an article; blind to white
    space) and collect the block elements that have any content.  Iterative: nesting may be deep."""
    from xxhash import xxh64_intdigest

    order, todo = [], [root]
    while todo:
        e = todo.pop()
        order.append(e)
        todo.extend(x for x in e.parts if isinstance(x, Element))
    for e in reversed(order):
        inner = [" ".join(x.split()) if isinstance(x, str) else f"\x01{x.digest:x}" for x in e.parts]
        inner = [x for x in inner if x and x != "\x010"]
        e.digest = xxh64_intdigest("\x00".join(["\x02" * e.inside + e.tag, *inner])) - (1 << 63) if inner else 0
        if inner and e.tag not in INLINE and e.tag not in ("#root", "html", "body", "article", "main", "title", "head"):
            seen[e.digest] = e


def text_of(e: Element) -> str:
    """All text of an element."""
    text, todo = [], [e]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            text.append(x)
        else:
            todo.extend(reversed(x.parts))
    return plain(" ".join(text))


def spare_near_copy(e: Element, template: frozenset[int] | set[int]) -> None:
    """Mark the parts of ``e`` that stay although they are template: those of an element that is
    spared itself, and those of a near copy's article, where template paragraphs directly in ``e``
    are most of its text without headings, beside some that is no template.  Outside articles,
    menus before its first paragraph and footers after its last one still go."""
    parts = [x for x in e.parts if isinstance(x, Element) and not x.drop]
    if e.spared:
        for x in parts:
            x.spared = True
        return
    running = [i for i, x in enumerate(parts) if x.tag in RUNNING]
    shared = sum(len(text_of(parts[i])) for i in running if parts[i].digest in template)
    if not shared:
        return
    own = sum(len(text_of(x)) for x in parts if x.tag not in HEADINGS and x.digest not in template)
    own += sum(len(plain(x)) for x in e.parts if isinstance(x, str))
    if own and shared > MOST * (own + shared):
        for x in parts if e.inside else parts[running[0]:running[-1] + 1]:
            x.spared = True


def blocks(root: Element, template: frozenset[int] | set[int] = frozenset(), headings: bool = True) -> list[str]:
    """The kept text, block by block: only inside articles, if there are any outside
    what is dropped.  headings: they count."""
    found: list[tuple[bool, str]] = []
    line: list[str] = []
    in_article = [False]

    def flush() -> None:
        text = plain("".join(line))
        if text:
            found.append((in_article[0], text))
        line.clear()

    any_article = False
    todo: list = [(root, False)]
    while todo:
        x, inside = todo.pop()
        if x is None:  # the end of a block
            flush()
            in_article[0] = inside
        elif isinstance(x, str):
            line.append(x)
        elif x.drop or x.digest in template and not x.spared or not headings and x.tag in HEADINGS:
            if x.tag not in INLINE:
                flush()
            else:
                line.append(" ")
        else:
            block = x.tag not in INLINE
            if x.tag == "br":
                line.append(" ")
            if block:
                flush()
                todo.append((None, inside))
                inside = inside or x.tag in ("article", "main")
                any_article = any_article or x.tag in ("article", "main")
                in_article[0] = inside
            if template:
                spare_near_copy(x, template)
            todo.extend((p, inside) for p in reversed(x.parts))
    flush()
    return [t for a, t in found if a or not any_article]


def subjects(root: Element, kept: list[str]) -> tuple[str, str, str]:
    """What can tell pages of different articles apart: the first heading (in an article, if one
    has any, else of the page, else the title, else the longest block), the title, the whole text."""
    title, inner, outer, todo = "", "", "", [root]
    while todo:
        e = todo.pop()
        if e.drop and e.tag not in ("head", "title"):
            continue
        if e.tag in ("h1", "title"):
            words = text_of(e)
            if e.tag == "title":
                title = title or words
            elif e.inside:
                inner = inner or words
            else:
                outer = outer or words
            continue
        todo.extend(x for x in reversed(e.parts) if isinstance(x, Element))
    return inner or outer or title or max(kept, key=len, default=""), title, "\n".join(kept)


def told_apart_by(subjects_: DataFrame, min_pages: int, min_share: float) -> DataFrame:
    """(c_host, by): 1 or 2, the subject that tells the articles of a host apart, for hosts where
    the first heading doesn't: one is on ``min_share`` of the host's different texts."""
    values = subjects_.distinct().select("host", F.posexplode(F.array("heading", "title")).alias("kind", "value"))
    most = (values.groupBy("host", "kind", "value").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("host", "kind").agg(F.sum("n").alias("texts"), F.max("n").alias("most")))
    same = F.col("most") >= F.col("texts") * min_share
    return (most.filter(F.col("texts") >= min_pages).groupBy(F.col("host").alias("c_host"))
            .agg(F.bool_or((F.col("kind") == 0) & same).alias("h"), F.bool_or((F.col("kind") == 1) & same).alias("t"))
            .filter("h").select("c_host", F.when(F.col("t"), 2).otherwise(1).alias("by")))


def strict(e: Element) -> bool:
    """Whether a subtree must be on half of the host's articles to be template."""
    return e.inside or e.tag in RUNNING or e.tag in HEADINGS


SUBTREES = "host string, subtree long, strict boolean, heading long, title long, whole long"


def page_subtrees(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(host, subtree, strict, heading, title, whole) for each different subtree of each page, with
    the hashes of the page's ``subjects``, and one row with a null subtree for the page."""
    from xxhash import xxh64_intdigest

    for pages in batches:
        hosts, subtrees, flags, named = [], [], [], []
        for host, html in zip(pages["host"], pages["html"], strict=True):
            root = parse(html or "")
            seen: dict[int, Element] = {}
            hash_subtrees(root, seen)
            subject = tuple(xxh64_intdigest(x) - (1 << 63) for x in subjects(root, blocks(root)))
            hosts += [host] * (len(seen) + 1)
            subtrees += [None, *seen]
            flags += [False, *map(strict, seen.values())]
            named += [subject] * (len(seen) + 1)
        yield pd.DataFrame({"host": hosts, "subtree": pd.array(subtrees, dtype="Int64"), "strict": flags,
                            **{k: [x[i] for x in named] for i, k in enumerate(("heading", "title", "whole"))}})


def main_text(html: str | None, template: set[int] | frozenset[int] = frozenset()) -> str:
    root = parse(html or "")
    whole = blocks(root)
    if not template:
        return "\n".join(whole)
    hash_subtrees(root, {})
    # only headings left: a near copy of an article that fills its host
    return "\n".join(blocks(root, template) if blocks(root, template, headings=False) else whole)


@F.pandas_udf(T.StringType())
def main_texts(html: pd.Series, template: pd.Series) -> pd.Series:
    return pd.Series([main_text(h, frozenset(t.tolist()) if t is not None and len(t) else frozenset())
                      for h, t in zip(html, template, strict=True)], dtype=object)


def host_of(url):
    """The host of a url in lower case, '' if it has none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def site_templates(pages: DataFrame, store: Callable[[DataFrame], DataFrame], url: str, html: str,
                   min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, template): the hashes of the subtrees on ``min_pages`` different articles of the host and,
    where they are ``strict``, on ``min_share`` of them."""
    named = pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html"))
    found = store(named.mapInPandas(page_subtrees, SUBTREES))  # one parse, two readers
    apart = store(told_apart_by(found.filter("subtree IS NULL").select("host", "heading", "title", "whole"),
                                min_pages, min_share))  # hosts, small files: broadcast by their size
    article = F.element_at(F.array("heading", "title", "whole"), F.coalesce("by", F.lit(0)) + 1)
    counts = (found.join(apart, found["host"] == apart["c_host"], "left")
              .select("host", "subtree", "strict", article.alias("article")).distinct()
              .groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("n"), F.bool_or("strict").alias("strict")))
    counts = store(counts.filter((F.col("n") >= min_pages) | F.col("subtree").isNull()))  # two readers
    total = counts.filter("subtree IS NULL").select(F.col("host").alias("t_host"), F.col("n").alias("articles"))
    often = counts.filter(F.col("subtree").isNotNull())
    return (often.join(total, often["host"] == total["t_host"])
            .filter(~F.col("strict") | (F.col("n") >= F.col("articles") * min_share))
            .groupBy("host").agg(F.array_sort(F.collect_list("subtree")).alias("template")))


def extract_main_text(pages: DataFrame, store: Callable[[DataFrame], DataFrame], url: str = "url",
                      html: str = "html", out: str = "text", min_pages: int = MIN_PAGES,
                      min_share: float = MIN_SHARE) -> DataFrame:
    """``pages`` without the html, with the main text as ``out`` (an earlier column of that name
    gives way)."""
    need(pages, url, html)
    templates = store(site_templates(pages, store, url, html, min_pages, min_share))  # small files: broadcast by their size
    columns = [c for c in pages.columns if c.lower() not in (html.lower(), out.lower())]
    t = templates.select(F.col("host").alias("t_host_"), F.col("template").alias("template_"))
    return (pages.join(t, host_of(F.col(url)) == F.col("t_host_"), "left")
            .select(*columns, main_texts(F.col(html), F.col("template_")).alias(out)))
