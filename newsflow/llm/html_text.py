"""HTML extraction by maximum-scoring subsequence.

A page is a sequence of words and tags. Each kind of token is worth the logarithm of its odds inside against outside the
main text of labelled pages; words are kept positive and tags negative. Elements that are no part of an article by their
markup (menus, headers, footers, sidebars, notices, adverts, forms, reader comments, scripts, styles) count nothing and
give no text. One linear scan finds the contiguous region with the highest sum, and its text is returned: character
references decoded, inline tags removed, blocks joined by one space. A word of an advert or the like that is only a part of
a class or beside one that names the article (``tag-social``, ``has-ads``) sets nothing apart that is the article itself.

A page is labelled by the document it shows: blocks whose text occurs in the document are content.

Defined cases: a null or empty page, or one without words, gives an empty text. Markup may be broken: elements that are
never closed, comments and tags that are cut off at the end. Rows with null ids, or repeated rows, are extracted each.
Without labelled pages the default weights hold.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|</?[a-zA-Z][^>]*+(?:>|\Z)|[^<]++|<""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""")

# HTML's own element names, by what they mean here.
RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "template", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
APART = {"head", "nav", "footer", "aside", "form", "button", "select", "svg", "math", "canvas", "object", "audio", "video", "dialog", "menu"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert", "menu", "menubar"}
ARTICLE = {"article", "main"}
CLOSES_P = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())

# Words in class and id attributes that tell what an element is.
ALWAYS_APART_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored cookie cookies consent gdpr "
    "newsletter subscribe subscription signup login comment comments reply replies respond disqus share sharing social breadcrumb breadcrumbs "
    "popup modal overlay pagination pager".split()
)
# Of these, the ones that say of an article as a whole that it is none; the others may be its topic.
NO_ARTICLE_WORDS = set("ad ads adv advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored comment comments reply replies respond disqus".split())
# These may also describe what is around or beside: not on an element that names the article as well.
APART_WORDS = set("sidebar notice related recommended menu nav navbar navigation footer widget toolbar search searchbox skip masthead topbar copyright".split())
ARTICLE_WORDS = {"article", "main", "content", "post", "entry", "story", "body", "text"}

# Kinds of tokens that no labelled page shows, and limits of what is learned. On a page with an article element, tokens in
# it and outside of it are kinds of their own, so that a list in an article is no menu.
DEFAULT = {"": 1.0, "in:": 1.0, "out:": 0.05}
TAG = {"": -1.0, "in:": -0.05, "out:": -4.0}
LEAST, MOST = 0.05, 4.0
LABELLED_PAGES = 500


class Token:
    """A piece of text (``name`` is empty) or a tag; ``apart`` once it belongs to an element that is not article;
    ``inside``: within an article element."""

    __slots__ = ("apart", "attributes", "close", "inside", "name", "text")

    def __init__(self, name: str, close: bool, attributes: str, text: str):
        self.name, self.close, self.attributes, self.text, self.apart, self.inside = name, close, attributes, text, False, False


def tokens(page: str) -> list[Token]:
    out, at = [], 0
    while m := _TOKEN.match(page, at):
        at = m.end()
        name = m["name"]
        if name:
            name = name.lower()
            out.append(Token(name, bool(m["close"]), m["rest"], ""))
            if name in RAW and not m["close"]:
                # the element's content is no markup: go to its end tag
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
                at = end.end() if end else len(page)
        elif page[m.start()] != "<" or m.end() == m.start() + 1:
            out.append(Token("", False, "", m[0]))
    return out


def _attributes(token: Token) -> dict[str, str]:
    return {k.lower(): (a or b or c).lower() for k, a, b, c in _ATTRIBUTE.findall(token.attributes)}


def _names(token: Token) -> list[set[str]]:
    """The words of each class and of the id."""
    found = _attributes(token)
    return [set(re.split(r"[^a-z0-9]+", name)) for name in f"{found.get('class', '')} {found.get('id', '')}".split()]


def _names_article(token: Token) -> bool:
    """By its element, or by a class that is not that of an advert's or a comment's content."""
    return token.name in ARTICLE or any(name & ARTICLE_WORDS and not name & ALWAYS_APART_WORDS for name in _names(token))


def _may_be_article(token: Token) -> bool:
    """Is a token that is apart so only by words beside others, which may as well tell what an article has or is about?"""
    if token.name in APART or token.name in RAW or token.name == "header":
        return False
    said = [name & ALWAYS_APART_WORDS for name in _names(token)]
    whole = set().union(*(words for words, name in zip(said, _names(token), strict=True) if words == name))
    return any(said) and not whole & (NO_ARTICLE_WORDS if _names_article(token) else ALWAYS_APART_WORDS)


def _is_the_article(page: list[Token], start: int, stop: int) -> bool:
    """Is the element in these tokens, which may be the article, the article itself or around it?

    It is if it names or holds an article (or the main heading) and no other article beside it has as many words, or if no
    other part of the page has words.
    """
    own = _words_of(page[start:stop])
    holds = _names_article(page[start]) or any(_is_clean_article(t) or (t.name == "h1" and not t.close) for t in page[start + 1 : stop])
    i, beside, rest = 0, 0, 0
    while i < len(page):
        token = page[i]
        if i == start:
            i = stop
        elif token.name and not token.close and token.name not in VOID and _is_apart(token, True) and not (i < start < _end(page, i)):
            i = _end(page, i)
        elif _is_clean_article(token) and not (i < start < _end(page, i)):
            words = _words_of(page[i : (end := _end(page, i))])
            beside, rest, i = max(beside, words), rest + words, end
        else:
            rest += _words_of([token])
            i += 1
    return own > beside if holds else not rest


def _is_clean_article(token: Token) -> bool:
    return bool(token.name) and not token.close and token.name not in VOID and _names_article(token) and not _is_apart(token, True)


def _words_of(page: list[Token]) -> int:
    return sum(len(t.text.split()) for t in page if not t.name)


def _is_apart(token: Token, in_article: bool) -> bool:
    name = token.name
    if name in ("html", "body"):
        return False
    if name in APART or name in RAW or (name == "header" and not in_article):
        return True
    if not token.attributes:
        return False
    found = _attributes(token)
    words = set(re.split(r"[^a-z0-9]+", f"{found.get('class', '')} {found.get('id', '')}"))
    if words & ALWAYS_APART_WORDS:
        return True
    if name in ARTICLE or words & ARTICLE_WORDS:
        return False
    hidden = re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", token.attributes) or "display:none" in found.get("style", "").replace(" ", "")
    return bool(hidden or words & APART_WORDS or found.get("role") in ROLES or ("header" in words and not in_article))


def set_apart(page: list[Token]) -> None:
    """Mark the tokens of elements that are no part of an article, and those within an article element."""
    i, depth = 0, 0
    while i < len(page):
        token = page[i]
        if token.name in ARTICLE and token.close:
            depth = max(depth - 1, 0)
        if token.name and not token.close and token.name not in VOID and _is_apart(token, depth > 0):
            end = _end(page, i)
            if not (_may_be_article(token) and _is_the_article(page, i, end)):
                for k in range(i, end):
                    page[k].apart = True
                i = end
                continue
        token.inside = depth > 0
        if token.name in ARTICLE and not token.close:
            depth += 1
        i += 1


def _end(page: list[Token], start: int) -> int:
    """Index after the element that begins at ``start``; one that is never closed ends where an article begins."""
    name, depth, stop = page[start].name, 0, len(page)
    if name in RAW:
        return start + 1
    for k in range(start, len(page)):
        token = page[k]
        if name == "p" and k > start and (token.name in CLOSES_P):
            return k + (token.close and token.name == "p")
        if token.name == name:
            depth += -1 if token.close else 1
            if depth == 0:
                return k + 1
        if stop == len(page) and k > start and token.name in ("article", "main", "h1") and not token.close:
            stop = k
    return stop


def _kinds(page: list[Token]) -> list[tuple[str, str]]:
    """(place, tag) of every token: place is empty on pages without text in an article element, tag is empty for words."""
    marked = any(t.inside and not t.name and not t.apart and t.text.strip() for t in page)
    return [(("in:" if t.inside else "out:") if marked else "", f"/{t.name}" if t.close else t.name) for t in page]


def _unseen(place: str, tag: str) -> float:
    if not tag:
        return DEFAULT[place]
    name = tag.removeprefix("/")
    return -LEAST if place != "out:" and (name in INLINE or name in ("p", "br")) else TAG[place]


def region(page: list[Token], weights: dict[str, float]) -> tuple[int, int]:
    """(start, end) of the contiguous tokens with the highest sum: the linear scan."""
    best, here, start, found = 0.0, 0.0, 0, (0, 0)
    for i, (token, (place, tag)) in enumerate(zip(page, _kinds(page), strict=True)):
        if token.apart:
            continue
        if here <= 0:
            here, start = 0.0, i
        worth = weights.get(place + tag, _unseen(place, tag))
        here += worth if tag else worth * len(html.unescape(token.text).split())
        if here >= best and here > 0:
            best, found = here, (start, i + 1)
    return found


def extract(source: str | None, weights: dict[str, float]) -> str:
    page = tokens(source or "")
    set_apart(page)
    start, end = region(page, weights)
    pieces = []
    for token in page[start:end]:
        if token.apart:
            pieces.append(" " if token.name and token.name not in INLINE else "")
        elif token.name:
            pieces.append("" if token.name in INLINE else " ")
        else:
            pieces.append(html.unescape(token.text))
    return " ".join("".join(pieces).split())


def count_tokens(source: str, document: str) -> Counter:
    """(kind, inside) counts of a page's tokens, by the span of the blocks whose text the document has."""
    page = tokens(source)
    set_apart(page)
    known = "".join(document.split())
    content = []
    for i, token in enumerate(page):
        text = "" if token.name else "".join(html.unescape(token.text).split())
        # a few characters occur in any document
        if len(text) >= 20 and text in known:
            content.append(i)
    found: Counter = Counter()
    if content:
        low, high = content[0], content[-1]
        for i, (token, (place, tag)) in enumerate(zip(page, _kinds(page), strict=True)):
            n = 1 if tag else len(html.unescape(token.text).split())
            for kind in {tag, place + tag}:
                found[kind, low <= i <= high] += n
    return found


def learn_weights(labelled: DataFrame) -> dict[str, float]:
    """Weights from (html, text) rows: log-odds of each kind of token, words positive and tags negative.

    Only the counts per kind leave the tasks; kinds that fewer than two pages show are left out. How many there are is bounded
    by the labelled sample alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = zip(*(batch[c].to_pylist() for c in ("html", "text")), strict=True)
            found = [count_tokens(page or "", text or "") for page, text in pages]
            # One row per page and kind, so that a kind's rows are the pages that show it.
            rows = [(kind, page[kind, True], page[kind, False]) for page in found for kind in sorted({k for k, _ in page})]
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "inner", "outer"])

    counted = labelled.select("html", "text").mapInArrow(run, "kind string, inner long, outer long")
    counts = counted.groupBy("kind").agg(F.sum("inner").alias("inner"), F.sum("outer").alias("outer"), F.count("*").alias("pages"))
    rows = counts.filter("pages >= 2").collect()
    weights = {}
    for marked in (False, True):
        own = [r for r in rows if r.kind.startswith(("in:", "out:")) == marked]
        inner, outer = sum(r.inner for r in own), sum(r.outer for r in own)
        for r in own:
            odds = math.log((r.inner + 0.5) / (inner + 1)) - math.log((r.outer + 0.5) / (outer + 1))
            is_tag = r.kind.partition(":")[2] if marked else r.kind
            weights[r.kind] = max(-MOST, min(odds, -LEAST)) if is_tag else min(MOST, max(odds, LEAST))
    return weights


def extract_text(pages: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text and n_chars.

    ``labelled``: a bounded sample of (html, text) rows to learn the weights from; see ``LABELLED_PAGES``.
    """
    weights = learn_weights(labelled) if labelled is not None else {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [extract(page, weights) for page in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    wanted = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return wanted.mapInArrow(run, "page_id long, url string, text string, n_chars long")
