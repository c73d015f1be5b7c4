"""Main text of web pages by a maximum-scoring subsequence.

A page is a row of tokens: tags, and the words between them.  Tags score below zero.
A word scores by where it stands: its nearest block or sectioning element, whether in a
link, and the parts that whole names in class, id and role around it name.  The scores are log odds of lying in the
content, counted on labelled pages, those whose markup names its content (article
or main element), so that pages without such markup are read by the same weights.
One scan finds the contiguous run of tokens with the largest sum; its blocks, less
the ones that are markup of another kind (forms, notices, comments), are the text.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygauge.llm.common import slices, whole

#: Pages (at most, in expectation) from which weights are counted.
LABELLED_PAGES = 4000
#: What marks the place of a text in a link.
LINK = " a"
#: Score of a tag, and bounds of a word's score.
TAG, BOUND = -0.05, 3.0

# Elements by their part in a page.
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
    "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "select", "summary",
    "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Their content is no text of the page.
HIDDEN = {"script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "textarea", "title",
          "head", "button", "select", "option"}
#: Their content is text, but never the article's.
APART = {"nav", "menu", "aside", "footer", "form", "dialog"}
#: Words of class, id and role that name a part which is never the article's.
PARTS = {
    "ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "commentlist", "comments",
    "consent", "cookie", "cookies", "copyright", "disqus", "footer", "form", "login", "menu", "nav", "navbar", "navigation", "newsletter",
    "notice", "pagination", "popup", "promo", "related", "reply", "replies", "respond", "share", "sharing", "sidebar",
    "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
#: Words that stand beside these in a name without changing what it names.
LAYOUT = {
    "area", "bar", "block", "bottom", "box", "buttons", "container", "content", "fixed", "form", "inner", "item", "items",
    "left", "links", "list", "main", "navigation", "outer", "page", "policy", "post", "posts", "primary", "right", "secondary",
    "section", "site", "sticky", "thread", "top", "unit", "wrap", "wrapper",
}
CONTENT = {"article", "main"}

_RAW = "script|style|noscript|template|textarea|iframe|svg|title"
_TOKEN = re.compile(
    rf"(?is)<!--.*?(?:-->|\Z)|<({_RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"""|<(/?)([a-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>|<[!?/][^>]*>""")
_NAMES = re.compile(r"""(?is)[\s"'/](?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[^\W\d_]+")
_WORD = re.compile(r"\S+")
#: White space as HTML and Unicode know it.
_SPACE = re.compile(r"\s+")


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """("open" or "close", element, attributes) and ("text", "", raw text), in page order."""
    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            yield "text", "", page[at: m.start()]
        at = m.end()
        if m[3]:
            name = m[3].lower()
            yield ("close" if m[2] else "open"), name, m[4]
            if not m[2] and (name in VOID or m[4].endswith("/") and name not in BLOCKS):
                yield "close", name, ""
    if at < len(page):
        yield "text", "", page[at:]


def named_parts(attributes: str) -> set[str]:
    """Parts that class, id and role name: "site-footer" is a footer, "share-market" no sharing."""
    found: set[str] = set()
    for m in _NAMES.finditer(f" {attributes}"):
        for name in (m[1] or m[2] or m[3] or "").split():
            own = {piece.lower() for piece in _PIECE.findall(name)}
            if own <= PARTS | LAYOUT | {"header"}:
                found |= own & (PARTS | {"header"})
    return found


def pieces(page: str) -> list[tuple[str, str, bool, int]]:
    """The pieces of a page, see ``_pieces``; no wrapper of its content counts as another part.

    A wrapper is an element that holds all words of article and main elements, or on
    pages without these, named as a part, more than half of all words.
    """
    words: dict[int, list[int]] = {}
    found = _pieces(page, frozenset(), words)
    every, inside = words.pop(-1, [0, 0])
    wrappers = frozenset(n for n, (own, labelled) in words.items() if (labelled == inside if inside else
                                                                      2 * own > every))
    return _pieces(page, wrappers, {}) if wrappers else found


def _pieces(page: str, wrappers: frozenset[int], words: dict[int, list[int]]) -> list[tuple[str, str, bool, int]]:
    """(text, place, in labelled content, block number) of each text, and ("", "", _, block) of each tag.

    ``place`` is what the weights know: the nearest block element, or the part of the
    page around it.  Texts of hidden elements are left out.  ``words`` gets words of the
    page (-1) and of each part outside of content, in all and in content; ``wrappers`` are
    numbers of elements that are no parts.
    """
    number, parts = 0, [(0, -1, True)]  # depth, number, whether a name makes it one
    stack: list[tuple[str, str, bool, bool]] = [("", "", False, False)]  # element, part, hidden, content
    found: list[tuple[str, str, bool, int]] = []
    block = 0
    for kind, name, rest in tokens(page):
        element, part, hidden, content = stack[-1]
        if kind == "text":
            if not hidden:
                level = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] in BLOCKS), 0)
                near = stack[level][0] + (LINK if any(e == "a" for e, *_ in stack[level:]) else "")
                found.append((rest, part or near, content, block))
                count = len(_WORD.findall(rest))
                while parts[-1][0] >= len(stack):
                    parts.pop()
                for _, n, named in parts:
                    if named or content:
                        total = words.setdefault(n, [0, 0])
                        total[0] += count
                        total[1] += count * content
            continue
        block += name in BLOCKS
        found.append(("", "", content, block))
        if name == "br" and kind == "open":
            found.append((" ", part or "br", content, block))
        if kind == "open":
            if name == "p" or name in ("li", "dd", "dt", "tr", "td", "th", "option"):
                # These end where the next of them begins.
                while len(stack) > 1 and (stack[-1][0] not in BLOCKS or stack[-1][0] == "p" and name == "p"):
                    if stack[-1][0] not in BLOCKS and not any(e == "p" for e, *_ in stack):
                        break
                    stack.pop()
            element, part, hidden, content = stack[-1]
            names = named_parts(rest)
            own = name if name in APART else next(iter(sorted(names - {"header"})), "")
            own = own or ("header" if not content and (name == "header" or "header" in names) else "")
            if name in CONTENT or name == "body" or name == "html":
                own = name if name in APART else ""
            number += 1
            if own and not content and number in wrappers:
                own = ""
            while parts[-1][0] >= len(stack):
                parts.pop()
            if own and not content:
                parts.append((len(stack), number, own != name))
            stack.append((name, part or own, hidden or name in HIDDEN, content or name in CONTENT))
        else:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
            if depth:
                del stack[depth:]
    return found


def count_places(pages: DataFrame, limit: int = LABELLED_PAGES) -> dict[str, float]:
    """Score of a word by place: log odds of content on labelled pages."""
    def count(batches):
        for batch in slices(batches):
            seen: dict[str, list[int]] = {}
            for page in batch.column(0).to_pylist():
                found = pieces(page)
                if any(inside for _, _, inside, _ in found):
                    for text, place, inside, _ in found:
                        seen.setdefault(place, [0, 0])[inside] += len(_WORD.findall(text))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array([v[0] for v in seen.values()], pa.int64()),
                 pa.array([v[1] for v in seen.values()], pa.int64())], ["place", "outside", "inside"])

    share = min(1.0, limit / max(1, pages.count()))
    sample = pages.select(whole("html").alias("html"))
    sample = sample.sample(share, seed=5) if share < 1 else sample
    rows = sample.mapInArrow(count, "place string, outside long, inside long").groupBy("place").agg(
        F.sum("outside").alias("outside"), F.sum("inside").alias("inside")).collect()  # places are few
    return {r["place"]: max(-BOUND, min(BOUND, math.log((r["inside"] + 0.5) / (r["outside"] + 0.5)))) for r in rows}


def best_run(scores: list[float]) -> tuple[int, int]:
    """[start, stop) of the contiguous run with the largest positive sum; (0, 0) if there is none."""
    best, run, start, answer = 0.0, 0.0, 0, (0, 0)
    for i, score in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += score
        if run > best:
            best, answer = run, (start, i + 1)
    return answer


def is_apart(place: str) -> bool:
    return place in APART or place in PARTS or place == "header"


def neutral_inside(found: list[tuple[str, str, bool, int]], scores: list[float]) -> list[float]:
    """The scores, zero for tags and removable parts between two texts of one content element.

    Such a part is removed anyway, so its length must not part the texts around it.
    """
    answer = list(scores)
    inside = [i for i, (text, place, content, _) in enumerate(found) if content and text.strip() and not is_apart(place)]
    for before, after in zip(inside, inside[1:], strict=False):
        if all(found[i][2] for i in range(before + 1, after)):
            answer[before + 1: after] = [0.0] * (after - before - 1)
    return answer


def main_text(page: str, weights: dict[str, float]) -> str:
    """The article's blocks, one to a line."""
    found = pieces(page)
    scores = []
    for text, place, content, _ in found:
        if not place:
            scores.append(TAG if not text else 0.0)
        else:
            apart, link = is_apart(place), place.endswith(LINK) and not content
            weight = weights.get(place, -1.0 if apart or link and place != "p" + LINK else 1.0)
            weight = min(weight, -0.5) if apart else weight if link else max(weight, 0.5)
            scores.append(len(_WORD.findall(text)) * weight)
    start, stop = best_run(neutral_inside(found, scores))
    blocks: dict[int, list[str]] = {}
    for text, place, _, block in found[start:stop]:
        if text and not is_apart(place):
            blocks.setdefault(block, []).append(text)
    lines = (_SPACE.sub(" ", entities.unescape("".join(parts))).strip() for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``.

    A null or empty html has an empty text, as has a page without words.  Repeated
    rows are read alike; an empty table gives no rows.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        whole("html").alias("html"))
    weights = count_places(rows)

    def read(batches):
        for batch in slices(batches):
            texts = [main_text(page, weights) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(read, "page_id long, url string, text string, n_chars long")
