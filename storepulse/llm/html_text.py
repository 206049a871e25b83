"""Main text of web pages by line-block distribution.

1. Markup is stripped into lines, one for each block of text. Elements that are never
   article text (scripts, styles, forms, navigation, page headers, footers, asides, and those
   whose class, id or role names them an advert, menu, sidebar, notice,
   comment list and so on) leave ``WINDOW`` empty lines in their place, as do the edges of
   ``article`` and ``main``.
2. A line counts its characters outside links. Over windows of ``WINDOW``
   lines the sums surge where text begins and dive to nothing where ``WINDOW``
   lines are empty.
3. The lines between a surge and its dive are a region. Regions whose sums reach ``SURGE``
   characters are kept, or the longest one where none does. Where the page marks
   an article, it bounds the regions, and links count in it too.
4. A short region next to a kept one is kept with it: in the same marked article, or,
   elsewhere, if it ends a sentence and one stripped element stands between.

An article that lies in a boilerplate element or is named as one (a comment) is
boilerplate, unless the page has no other text worth a surge.

Character references are decoded, white space inside a block becomes one
space, and blocks are joined in page order by a line feed; nothing is capped.

Null and empty html give an empty text. Unclosed elements end with the page,
unclosed boilerplate also where an article or main begins (a main ends closed one as well). Repeated rows give
repeated results; every page is read by itself. Extra columns pass through,
result columns replace those of the same name.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Production parameters.
WINDOW = 3
SURGE = 80

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[A-Za-z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"(?:^|[\s\"'])(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "object", "canvas"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_DROPPED = {"head", "nav", "footer", "aside", "form", "button", "select", "dialog", "menu"}
_MAIN = {"article", "main"}
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
    "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
    "time", "tt", "u", "var", "img", "wbr",
}
_BOILERPLATE = {
    "ad", "ads", "advert", "adverts", "advertisement", "alert", "aside", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "masthead", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination", "popup", "promo",
    "related", "replies", "search", "share", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe",
    "toolbar", "widget",
}
_SENTENCE_ENDS = (".", "!", "?", "…", "。", "！", "？")
#: Words beside those that a boilerplate article's class may have.
_PARTS = {"article", "block", "body", "box", "card", "content", "entry", "item", "list", "reply", "text", "user"}


def _is_boilerplate(name: str, attrs: str, in_main: bool) -> bool:
    if name in _DROPPED or (name == "header" and not in_main):
        return True
    if not attrs or name in _MAIN - {"article"} or name in ("html", "body") or name in _INLINE:
        return False
    for m in _NAMES.finditer(attrs):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return True
        elif key in ("class", "id", "role"):
            if name == "article":
                if any(_names_boilerplate(token) for token in value.split()):
                    return True
                continue
            words = set(re.split(r"[^a-z0-9]+", value))
            if words & _BOILERPLATE or (not in_main and "header" in words):
                return True
    return False


def _names_boilerplate(token: str) -> bool:
    """Whether a class of an article says nothing but boilerplate (``comment-12``), unlike ``comments-open``."""
    words = {w for w in re.split(r"[^a-z]+", token) if w}
    return bool(words & _BOILERPLATE) and words <= _BOILERPLATE | _PARTS


def lines(page: str, strict: bool = True) -> list[tuple[str, int, int]]:
    """(text, characters outside links, number of the marked article or 0) of each line; stripped elements leave empty lines.

    Not ``strict``: an article or main ends the boilerplate it lies in, and is never boilerplate itself.
    """
    out: list[tuple[str, int, int]] = []
    parts: list[str] = []
    linked = main = links = marked = 0
    skipped, depth = "", 0  # the boilerplate element that is being skipped
    ends = False  # it is known to have an end tag
    at, size = 0, len(page)

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            out.append((text, max(0, len(text) - linked), marked if main else 0))
        linked = 0

    def gap() -> None:
        flush()
        out.extend([("", 0, marked if main else 0)] * WINDOW)

    while at < size:
        token = _TOKEN.search(page, at)
        end = token.start() if token else size
        if not depth and end > at:
            parts.append(page[at:end])
            if links:
                linked += len(html.unescape(page[at:end]).strip())
        if not token:
            break
        at = token.end()
        name = (token["name"] or token["name2"] or "").lower()
        if not name:
            continue
        closing = bool(token["close"] or token["close2"])
        attrs = token["attrs"] or token["attrs2"] or ""
        if depth:
            if name == skipped and name not in _VOID:
                depth += -1 if closing else 1
            elif name in _MAIN and not closing and (name == "main" or not ends):
                ends = strict and name == "article" and _closes(page, at, skipped, depth)
                depth = depth if ends else 0
            if depth or closing:
                if not closing and name in _RAW:
                    at = _after(page, at, name)
                continue
        if closing:
            if name == "a":
                links = max(0, links - 1)
            elif name in _MAIN and main:
                gap()
                main -= 1
            elif name not in _INLINE:
                flush()
            continue
        if name in _RAW:
            gap()
            at = _after(page, at, name)
        elif name == "br":
            parts.append(" ")
        elif name in _VOID:
            if name not in _INLINE:
                flush()
        elif (strict or name not in _MAIN) and _is_boilerplate(name, attrs, main > 0) and not attrs.endswith("/"):
            gap()
            skipped, depth, ends = name, 1, False
        elif name == "a":
            links = 1
        elif name in _MAIN:
            gap()
            marked += not main
            main += 1
        elif name not in _INLINE:
            flush()
            links = 0
    flush()
    return out


def _after(page: str, at: int, name: str) -> int:
    """Place behind the end tag of an element whose content is not markup."""
    end = re.compile(rf"</{re.escape(name)}\s*[^>]*>", re.I).search(page, at)
    return end.end() if end else len(page)


def _closes(page: str, at: int, name: str, depth: int) -> bool:
    """Whether the ``depth`` open elements called ``name`` all end behind ``at``."""
    while token := _TOKEN.search(page, at):
        at = token.end()
        found = (token["name"] or token["name2"] or "").lower()
        closing = bool(token["close"] or token["close2"])
        if found == name:
            depth += -1 if closing else 1
            if not depth:
                return True
        elif found in _RAW and not closing:
            at = _after(page, at, found)
    return False


def regions(weights: list[int], window: int = WINDOW) -> list[tuple[int, int, int]]:
    """(first line, end, peak window sum) of the stretches between a surge from nothing and the next dive to nothing."""
    sums, total = [], 0
    for i, w in enumerate(weights):  # sums[i]: lines i - window + 1 .. i
        total += w - (weights[i - window] if i >= window else 0)
        sums.append(total)
    found, start = [], None
    for i, s in enumerate(sums):
        if s and start is None:
            start = i
        elif not s and start is not None:
            found.append((start, i - window + 1, max(sums[start:i])))
            start = None
    if start is not None:
        end = max(i for i in range(start, len(weights)) if weights[i]) + 1
        found.append((start, end, max(sums[start:])))
    return found


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """The article's blocks joined by line feeds."""
    if not page:
        return ""
    found = lines(page)
    every = _weighed(found, window)
    most = max((peak for _, _, peak in every), default=0)
    if most < surge and not any(inside and text for text, _, inside in found):
        # What the names call boilerplate may be the page's only text: a frame "with-sidebar", an article "notice".
        found = lines(page, strict=False)
        every = _weighed(found, window) if any(inside and text for text, _, inside in found) else every
    kept = [r for r in every if r[2] >= surge] or sorted(every, key=lambda r: (-r[2], r[0]))[:1]
    return "\n".join(found[i][0] for a, b, _ in _joined(found, every, kept, window) for i in range(a, b) if found[i][0])


def _weighed(found: list[tuple[str, int, int]], window: int) -> list[tuple[int, int, int]]:
    """Regions of a page; only of its marked articles where they have text, whose characters in links count too."""
    bound = any(inside and text for text, _, inside in found)
    return regions([(len(text) if inside else 0) if bound else w for text, w, inside in found], window)


def _joined(
    found: list[tuple[str, int, int]], every: list[tuple[int, int, int]], kept: list[tuple[int, int, int]], window: int
) -> list[tuple[int, int, int]]:
    """``kept`` and the short regions next to one of them.

    In a marked article those before and behind it; elsewhere sentences behind it, where one stripped element
    stands between.
    """
    chosen = set(kept)
    near = set(kept)
    for a, b in zip(every, every[1:]):
        if found[a[0]][2] == found[b[0]][2] > 0:
            if a in chosen or b in chosen:
                near |= {a, b}
        elif a in chosen and not found[b[0]][2] and b[0] - a[1] <= window and found[b[1] - 1][0].endswith(_SENTENCE_ENDS):
            if not any(found[i][0] for i in range(a[1], b[0])):
                near.add(b)
    return [r for r in every if r in near]


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page) for page in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=[*batch.schema.names, "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` without html, with ``text`` and ``n_chars`` (code points)."""
    rows = pages.drop(*[c for c in pages.columns if c.lower() in ("text", "n_chars")])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(_extract, f"{schema}, text string, n_chars long").drop("html")

