"""Operator 4, HTML extraction by tag-path ratios.

A page is cut into blocks of text, each with its root-to-leaf tag path.  Per
path the text length and the punctuation of its blocks are summed and
divided by their number; both ratios are smoothed over neighbouring paths in
page order, fused (length times punctuation times the path's weight), and a path is content if its
fused ratio reaches the mean of all paths' ratios and ``LAMBDA`` standard deviations more, or
``TOP`` of the highest.  The path's container brings along the other paths below it
(its title, its lists, its links) that nothing between the container and them marks as no article.

Structure is a weight of the fusion.  Menus, headers, footers, sidebars, notices, adverts, forms and
comments (by element, by role, or by the word that heads a class or id) weigh ``STRONG``; such a word
elsewhere in a class or id (``with-sidebar``, ``comment-policy``) weighs ``WEAK``; text below ``article`` or ``main`` weighs
``MAIN_WEIGHT``.  The weights along a path multiply, and the threshold is relative to the page's own ratios: a
mark around everything changes nothing, and a marked path of enough length and punctuation is content
like any other.  Paths of mostly links choose nothing.

Character references are decoded, white space inside a block becomes one
space, blocks are joined in page order by an empty line.

Cases: null and empty pages give empty text, as do pages without content;
unclosed elements, comments and raw elements end where the page ends;
paths are numbered by parent and name and the parser keeps places of open elements, so long and
deeply nested pages take time in proportion to their length;
repeated pages are rows like any other; extra columns are carried.
"""

from __future__ import annotations

import html
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ptloom.llm import rows

LAMBDA, TOP = 0.5, 0.6
SMOOTH = (0.15, 0.7, 0.15)
LINK_SHARE = 0.5
#: weight of a path below article or main; others weigh 1
MAIN_WEIGHT = 2.0
#: weight of a path for each mark on it, and the least weight below a container that comes along with it
STRONG, WEAK, ALONG = 0.15, 0.8, 0.5

# fixed values: elements of HTML, and words that mark a part of a page that is no article
RAW = "script|style|noscript|template|iframe|svg|math|object|canvas|video|audio|textarea|title"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong "
                   "sub sup td th time tt u var wbr".split())
SKIP = frozenset("nav header footer aside form button select option dialog menu head fieldset input script style".split())
SKIP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
SKIP_WORDS = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer "
                       "footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice notification pagination popup promo "
                       "promoted promotion recommended related replies reply search share sharing sidebar signup social sponsor sponsored subscribe "
                       "subscription toolbar topbar widget widgets".split())
#: words before a mark that speak of the page's state, and words behind one that only name its box
STATES = frozenset("has with without no is js show hide can allow enable disable toggle".split())
BOXES = frozenset("area bar block body box buttons column container content footer group header holder inner item items label link links list message outer panel region row "
                  "section text title top unit wrap wrapper zone".split())
MAIN = frozenset(("article", "main"))
_ENDS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_SCOPE = frozenset("article aside blockquote body button caption div dl fieldset figure footer form header html li main nav ol section table td th ul".split())

_TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tr figure figcaption address".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^\"'<>]|\"[^\"]*\"|'[^']*')*+)>|</?[a-zA-Z][^>]*>|<[!?/][^>]*>",
    re.S | re.I)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_PUNCT = re.compile(r"[.,;:!?…。，、；：！？]")
_BREAK = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _named(value: str) -> float:
    """Weight of a class or id: strong if a word that heads it marks a part that is no article, weak if one is anywhere in it."""
    weight = 1.0
    for token in value.split():
        words = _WORD.findall(_BREAK.sub(" ", token).lower())
        if SKIP_WORDS.isdisjoint(words):
            continue
        head = len(words) - 1
        while head and words[head] in BOXES and words[head] not in ("footer", "header"):
            head -= 1
        state = STATES.isdisjoint(words[:head]) is False
        weight = min(weight, STRONG if words[head] in SKIP_WORDS and not state else WEAK)
    return weight


def mark(tag: str, attrs: str) -> float:
    """Weight of an element by its name, role, class and id; 1 where nothing says that it is no article text."""
    if tag in SKIP:
        return STRONG
    weight = 1.0
    if attrs and tag not in ("html", "body"):
        for name, *values in _ATTR.findall(attrs):
            value = "".join(values)
            if name.lower() != "role":
                weight = min(weight, _named(value))
            elif value.strip().lower() in SKIP_ROLES:
                weight = STRONG
    return weight


class Paths:
    """The tag paths of a page, numbered in the order in which they open; number 0 is the page itself."""

    def __init__(self):
        self.number: dict[tuple, int] = {}
        self.parent, self.name, self.own, self.weight, self.main = [0], [""], [1.0], [1.0], [False]

    def below(self, parent: int, tag: str, name: str, weight: float, main: bool) -> int:
        key = (parent, name, weight, main)
        if key not in self.number:
            self.number[key] = len(self.parent)
            self.parent.append(parent)
            self.name.append(tag)
            self.own.append(weight)
            self.weight.append(self.weight[parent] * weight)
            self.main.append(main)
        return self.number[key]


def blocks(page: str) -> tuple[Paths, list[tuple[int, str, int]]]:
    """The paths, and the blocks in page order: path, text, characters inside links."""
    paths = Paths()
    stack: list[tuple[str, int]] = []  # element, path
    places: dict[str, list[int]] = {}  # where each element is open in the stack
    scopes = [-1]  # where elements are open that end the search for an open paragraph
    out: list[tuple[int, str, int]] = []
    parts: list[str] = []
    linked = where = 0
    filled = False

    def close():
        nonlocal linked, filled
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append((where, text, linked))
        parts.clear()
        linked, filled = 0, False

    def add(text: str):
        nonlocal linked, where, filled
        if text:
            if not filled:
                where = stack[-1][1] if stack else 0
            parts.append(text)
            said = text.strip()
            filled = filled or bool(said)
            if places.get("a"):
                linked += len(said)

    def push(tag: str, path: int):
        places.setdefault(tag, []).append(len(stack))
        if tag in _SCOPE:
            scopes.append(len(stack))
        stack.append((tag, path))

    def cut(to: int):
        while len(stack) > to:
            tag, _ = stack.pop()
            places[tag].pop()
            if tag in _SCOPE:
                scopes.pop()

    at, end = 0, page.rfind(">") + 1  # no element can end behind the last bracket
    for m in _TOKEN.finditer(page, 0, end):
        add(page[at:m.start()])
        at = m.end()
        if at == end and (m["raw"] and not m[0].rstrip(" >").lower().endswith("</" + m["raw"].lower()) or m[0].startswith("<!--") and not m[0].endswith("-->")):
            at = len(page)  # a raw element or a comment that nothing ends
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            if tag not in INLINE:
                close()
            elif tag in ("td", "th"):
                parts.append(" ")
            if places.get(tag):
                cut(places[tag][-1])
            continue
        if tag not in INLINE:
            close()
        elif tag in ("br", "td", "th"):
            parts.append(" ")
        if tag in _ENDS_P or tag == "li":
            ends = places.get("p" if tag != "li" else "li")
            if ends and ends[-1] >= scopes[-1]:
                cut(ends[-1])
        if tag in VOID or m["attrs"].endswith("/"):
            continue
        up = stack[-1][1] if stack else 0
        if tag in INLINE:
            push(tag, up)
            continue
        # a header inside an article holds its title
        weight = 1.0 if tag == "header" and paths.main[up] else mark(tag, m["attrs"])
        name = re.search(r"\bclass\s*=\s*[\"']?\s*([^\s\"'>]+)", m["attrs"], re.I) if m["attrs"] and tag in ("div", "section") else None
        main = tag in MAIN or (paths.main[up] and weight >= ALONG)
        push(tag, paths.below(up, tag, f"{tag}.{name[1]}" if name else tag, weight, main))
    add(page[at:].split("<!--", 1)[0])
    close()
    return paths, out


def ratios(paths: Paths, found: list[tuple[int, str, int]]) -> dict[int, float]:
    """Fused, smoothed ratio of each path that has text, in page order of the paths."""
    total: dict[int, list[float]] = {}
    for path, text, linked in found:
        s = total.setdefault(path, [0, 0, 0, 0])
        s[0] += len(text)
        s[1] += len(_PUNCT.findall(text))
        s[2] += 1
        s[3] += linked
    keys = list(total)
    s = np.array([total[k] for k in keys], float).reshape(-1, 4)
    weight = np.array([paths.weight[k] * (MAIN_WEIGHT if paths.main[k] else 1.0) for k in keys]) * (s[:, 3] <= LINK_SHARE * s[:, 0])
    length, punct = s[:, 0] / s[:, 2], (s[:, 1] + 1) / s[:, 2]
    smooth = [np.convolve(np.pad(x, 1, "edge"), SMOOTH, "valid") if len(x) else x for x in (length * weight, punct)]
    fused = weight * smooth[0] * np.sqrt(smooth[1])
    return dict(zip(keys, fused.tolist()))


def content(paths: Paths, fused: dict[int, float], spread: float | None = None) -> set[int]:
    """The paths whose text is content: those whose ratio reaches the threshold, and what their containers bring along."""
    values = np.array(list(fused.values()))
    limit = min(float(values.mean() + (LAMBDA if spread is None else spread) * values.std()), TOP * float(values.max()))
    chosen = {k for k, v in fused.items() if v > 0 and v >= limit}
    containers = set()
    for k in chosen:
        while paths.name[k] in _TEXTUAL:
            k = paths.parent[k]
        containers.add(k)
    # weight of a path below the nearest container around it; the page and its body as a whole hold no part together
    along = [0.0] * len(paths.parent)
    for k in range(len(along)):
        up = paths.parent[k]
        whole = paths.name[up] in ("", "html", "body") and paths.name[k] not in _TEXTUAL
        along[k] = 1.0 if k in containers else 0.0 if k == 0 or whole else along[up] * paths.own[k]
    return chosen | {k for k in fused if along[k] >= ALONG}


def extract(page: str, spread: float | None = None) -> str:
    """Main text of a page; ``spread`` stands for ``LAMBDA``."""
    paths, found = blocks(page)
    if not found:
        return ""
    kept = content(paths, ratios(paths, found), spread)
    return "\n\n".join(text for path, text, _ in found if path in kept)


def main_text(pages: DataFrame, *, html_col: str = "html", row: list[str] | None = None) -> DataFrame:
    """Columns ``row`` and ``res.text``."""
    def fn(texts, _):
        return {"text": [extract((t or b"").decode("utf-8", "replace")) for t in texts]}

    return rows.map_texts(pages, html_col, fn, T.StructType([T.StructField("text", T.StringType(), False)]), row=row)


def op4(spark, sf_dir: str) -> DataFrame:
    """Main text of every page and its length in characters."""
    got = main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"), row=["page_id", "url"])
    return got.select("row.page_id", "row.url", "res.text", F.char_length("res.text").cast("long").alias("n_chars"))
