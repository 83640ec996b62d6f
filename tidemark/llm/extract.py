"""Main text of web pages by the maximum-scoring subsequence.

A page becomes a sequence of words and tags. Words score positive and tags negative, with weights
learned from pages whose main text is marked; one linear scan finds the contiguous region of the
highest sum. Parts that are never main text by their name (scripts, forms, menus, adverts, comments)
are taken out before the scan, so they neither split the region nor end up in it.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import map_texts

#: Marked pages whose counts set the weights, chosen evenly by a hash of their id. The only sample here.
TRAINING_PAGES = 2000

#: Names of HTML elements by their role.
RAW = ("script", "style", "noscript", "template", "svg", "math", "iframe", "textarea", "title", "object", "canvas")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
NEVER = ("nav", "aside", "form", "footer", "button", "select", "dialog", "menu", "fieldset", "label", "datalist")
MAIN = ("article", "main")
BLOCK = (
    "address", "article", "aside", "blockquote", "body", "caption", "dd", "details", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "li",
    "main", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul",
)
INLINE = (
    "a", "abbr", "b", "br", "center", "cite", "code", "del", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "s",
    "small", "span", "strong", "sub", "sup", "td", "th", "time", "tt", "u", "var", "wbr",
)
#: Parts of class, id and role names that mark what is not the article.
MARKS = frozenset((
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment",
    "comments", "consent", "cookie", "cookies", "disqus", "discussion", "footer", "masthead", "menu", "modal", "nav",
    "navbar", "navigation", "newsletter", "notice", "notices", "overlay", "paywall", "popup", "promo", "promotion",
    "recommended", "related", "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "signup", "skip",
    "social", "sponsor", "sponsored", "subscribe", "toolbar", "complementary", "contentinfo", "alert", "login",
))
#: Weights of what no marked page shows; tags of running text cost less.
WORD_WEIGHT, LINK_WORD_WEIGHT, TAG_WEIGHT, PROSE_TAG_WEIGHT = 1.0, 0.1, -0.5, -0.05
PROSE = (
    "p", "b", "i", "em", "strong", "br", "q", "cite", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6", "header", "span",
    "sub", "sup", "td", "th", "tr", "figure", "figcaption",
)

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<(?P<raw>{'|'.join(RAW)})\b[^>]*>.*?(?:</(?P=raw)\b[^>]*>|\Z)"
    r"""|<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<rest>(?:[^"'<>]|"[^"]*"|'[^']*')*+)>|<[!?][^>]*>|<[a-z/][^<>]*>|(?P<text>[^<]+|<)""",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_KNOWN = frozenset(BLOCK + INLINE)


def _unwanted(name: str, rest: str, in_main: bool, main_seen: bool) -> bool:
    """By name, or by marks; the first main element is wanted whatever its marks."""
    if name in NEVER or (name == "header" and not in_main):
        return True
    if not rest or name in ("html", "body") or (name in MAIN and not main_seen):
        return False
    if _HIDDEN.search(rest):
        return True
    for match in _NAMES.finditer(rest):
        if not MARKS.isdisjoint(part.lower() for part in _PARTS.findall("".join(filter(None, match.groups())))):
            return True
    return False


def sequence(page: str) -> Iterator[tuple[str, str, bool]]:
    """(kind, value, marked) in page order: kind "" with a text, or a tag's name with "/" if it closes.

    Unwanted elements are left out with all they hold, unless the first main element is inside: then
    the mark belonged to a frame around it. `marked` tells whether a main element is open.
    """
    skipped, depth, mains, main_seen = "", 0, 0, False
    for token in _TOKEN.finditer(page):
        text = token["text"] or token["cdata"]
        if text:
            if not skipped:
                yield "", text, mains > 0
            continue
        name = token["name"]
        if not name:
            continue
        name, closes, rest = name.lower(), bool(token["end"]), token["rest"]
        if skipped and name in MAIN and not closes and not main_seen:
            skipped = ""
        elif skipped:
            if name == skipped and not rest.endswith("/"):
                depth += -1 if closes else 1
                if depth == 0:
                    skipped = ""
                    yield name, "/", mains > 0
            elif closes and name in (*MAIN, "body"):
                skipped = ""  # the element that holds the unwanted one ends, so that one was never closed
            else:
                continue
            if skipped or not (closes and name in (*MAIN, "body")):
                continue
        if not closes and name not in VOID and _unwanted(name, rest, mains > 0, main_seen):
            skipped, depth = name, 1
            continue
        if name in MAIN:
            mains = max(0, mains - 1) if closes else mains + 1
            main_seen = True
        yield name, "/" if closes else "", mains > 0


def token_classes(page: str) -> Counter:
    """How often each class of word and tag occurs inside (True) and outside the marked content."""
    counts: Counter = Counter()
    links = 0
    for name, value, marked in sequence(page):
        if not name:
            counts["link word" if links else "word", marked] += len(value.split())
            continue
        if name == "a":
            links = max(0, links - 1) if value else links + 1
        if name not in MAIN:
            counts[name if name in _KNOWN else "other", marked] += 1
    return counts


def weights_of(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log odds of standing inside, held positive for words and negative for tags."""
    inside = sum(n for (_, marked), n in counts.items() if marked)
    outside = sum(n for (_, marked), n in counts.items() if not marked)
    weights = {"word": WORD_WEIGHT, "link word": LINK_WORD_WEIGHT} | dict.fromkeys(PROSE, PROSE_TAG_WEIGHT)
    if not inside:
        return weights
    for name in {name for name, _ in counts}:
        share = [(counts.get((name, marked), 0) + 1) / (n + len(_KNOWN)) for marked, n in ((True, inside), (False, outside))]
        odds = math.log(share[0] / share[1])
        weights[name] = max(0.05, odds) if name.endswith("word") else min(-0.05, odds)
    return weights


def main_text(page: str, weights: dict[str, float]) -> str:
    """Blocks of the best region, white space inside them made one space, joined by two line ends."""
    tokens = list(sequence(page))
    best, best_range, total, start, links = 0.0, (0, 0), 0.0, 0, 0
    for i, (name, value, _) in enumerate(tokens):
        if name:
            if name == "a":
                links = max(0, links - 1) if value else links + 1
            total += 0.0 if name in MAIN else weights.get(name if name in _KNOWN else "other", TAG_WEIGHT)
        else:
            total += weights["link word" if links else "word"] * len(value.split())
        if total > best:
            best, best_range = total, (start, i + 1)
        elif total < 0:
            total, start = 0.0, i + 1
    blocks, current = [], []
    for name, value, _ in tokens[slice(*best_range)]:
        if not name:
            current.append(value)
        elif name in BLOCK:
            blocks.append(current)
            current = []
        elif name in ("br", "td", "th", "img"):
            current.append(" ")
    blocks.append(current)
    lines = (" ".join(html.unescape("".join(block)).split()) for block in blocks)
    return "\n\n".join(line for line in lines if line)


def learn_weights(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> dict[str, float]:
    """Weights from at most about TRAINING_PAGES pages that mark their content with article or main.

    Tasks count classes (as many as HTML has element names) and Spark adds the counts up.
    """
    marked = pages.select(F.col(id_col).alias("page_id"), F.col(html_col).alias("html")).where(
        F.col("html").rlike("(?i)<(article|main)[ >]")
    )
    total = marked.count()
    share = min(1.0, TRAINING_PAGES / max(1, total))
    chosen = marked.where(F.pmod(F.xxhash64("page_id", "html"), F.lit(1 << 20)) < share * (1 << 20))

    def rows(batches):
        counts: Counter = Counter()
        for _, texts in batches:
            for text in texts:
                counts.update(token_classes(text))
        keys = list(counts)
        yield [[k for k, _ in keys], [m for _, m in keys], [counts[k] for k in keys]]

    found = (
        map_texts(chosen, [], "html", "class string, marked boolean, n long", rows)
        .groupBy("class", "marked")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    return weights_of({(row["class"], row["marked"]): row["n"] for row in found})


def extract(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Per row: page_id, url, text, n_chars (code points of text).

    NULL and empty pages, and pages without words, give an empty text. Of regions with equal sums the
    first counts. Pages are read whole and one by one, without a shuffle; repeated rows give equal
    results. An empty table gives no rows.
    """
    weights = weights or learn_weights(pages)

    def rows(batches: Iterator) -> Iterator:
        for keys, texts in batches:
            found = [main_text(text, weights) for text in texts]
            yield [*keys, found, [len(text) for text in found]]

    kind = pages.schema["page_id"].dataType.simpleString()
    return map_texts(pages, ["page_id", "url"], "html", f"page_id {kind}, url string, text string, n_chars long", rows)
