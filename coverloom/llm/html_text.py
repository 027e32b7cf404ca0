"""Main text of web pages: flat text blocks judged by a decision tree.

A page is read once, left to right, into flat text blocks: block-level tags end a block, other
tags and line breaks do not. Every block gets its word count and link density, those of the
blocks before and after it, the share of its words that notices are made of, whether it is a
heading, and three marks from the tags around it. A decision tree (CART, Gini impurity) trained
here on the blocks of the small labelled table of pages below keeps or drops it: link lists and
notices go even from inside an article, and pages without an article element are read by the
lengths and links of neighbouring blocks.

A class that names something beside an article counts less where it is one of several: words
such as "promoted" or "search" do not count next to a class that names content, and no name counts
on an element that holds nearly all plain words of the page.

Defined results: a null or empty page, or one without main text, gives an empty string;
unclosed and stray tags are taken as they come; comments, scripts, styles and other elements
without text are skipped; a comment, script, style or textarea that is not closed ends with the
page, a head before the first text or element that cannot stand in it, any other before the
next block-level tag; character references are decoded after the tags are found; blocks are joined by one line break in page order, and
white space of any kind inside a block becomes one space. Rows are independent, so repeated
rows give equal results, and an empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverloom.llm.common import ship

# Element names of HTML.
SILENT = ("script", "style", "noscript", "template", "svg", "math", "iframe", "object", "head", "textarea", "select", "canvas")
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
HOLDERS = frozenset(
    "address article aside blockquote button dd details dialog div dl dt fieldset figure footer form header li main menu "
    "nav ol section table td th tr ul label".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that stand beside an article.
BESIDE = frozenset(("nav", "aside", "footer", "form", "menu", "button", "dialog", "fieldset"))
# Words in class, id or role that name something beside an article.
NAMES = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie "
    "cookies disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice pager pagination popup promo "
    "promoted related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar "
    "widget widgets".split()
)
UNNAMING = frozenset(("has", "with", "no", "without", "not"))
# Of these, the ones that an article's own wrapper may carry, and names of content.
WEAK = frozenset("consent modal popup promo promoted related reply respond search share sharing signup social sponsor sponsored subscribe widget widgets".split())
CONTENT = frozenset("article body content entry main page post story text".split())
# Words that notices and calls are made of.
NOTICE = frozenset(
    "© accept advertisement advertising consent cookie cookies copyright email follow login newsletter newsletters policy privacy register "
    "reserved rights share sign signup social sponsored subscribe terms unsubscribe".split()
)
# A holder with this share of all plain words of a page is its wrapper.
_WRAPPER = 0.95

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<silent>{'|'.join(SILENT)})(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^'\">])*>"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
# Unclosed, these hold the rest of the page.
RAW = frozenset(("script", "style", "textarea"))
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title head html".split())
# Block-level names that belong to an element without text.
OWN = {"select": frozenset(("option", "hr")), "svg": frozenset(("title",))}


def _end_of_raw(page: str, name: str, at: int) -> int:
    shut = re.compile(rf"</{name}\s*>", re.I).search(page, at)
    return shut.end() if shut else len(page)


def _ends(page: str, name: str) -> dict[int, int]:
    """Where the elements of a name end, by the place after their opening tag; every closing
    tag closes the last one that is open."""
    open_: list[int] = []
    found = {}
    for tag in re.finditer(rf"<(?:/{name}\s*|{name}(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>", page, re.I):
        if tag[0][1] != "/":
            if not tag[0].endswith("/>"):
                open_.append(tag.end())
        elif open_:
            found[open_.pop()] = tag.end()
    return found


def _next_block(page: str, name: str, at: int) -> int:
    """The next block-level tag that is not the element's own."""
    while token := _TOKEN.search(page, at):
        inner = (token["silent"] or "").lower()
        if (token["tag"] or "").lower() in BLOCKS - OWN.get(name, frozenset()):
            return token.start()
        at = _end_of_raw(page, inner, token.end()) if inner in RAW and not token[0].endswith("/>") else token.end()
    return len(page)


def _end_of_head(page: str, at: int, ends: dict[str, dict[int, int]]) -> int:
    """After the closing tag, or before what cannot stand in a head."""
    titled = False
    while token := _TOKEN.search(page, at):
        text = page[at : token.start()]
        if text.strip() and not titled:
            return at
        tag, silent = (token["tag"] or "").lower(), (token["silent"] or "").lower()
        if token["close"] and tag == "head":
            return token.end()
        if (tag or silent) not in IN_HEAD and (silent or tag and not token["close"]) or (token["close"] and tag in ("body", "html")):
            return token.start()
        titled = tag == "title" and not token["close"] or titled and not tag
        at = token.end()
        if silent and not token[0].endswith("/>"):
            if silent in RAW:
                at = _end_of_raw(page, silent, at)
            elif silent != "head":
                if silent not in ends:
                    ends[silent] = _ends(page, silent)
                at = ends[silent].get(at, at)
    return len(page) if titled or not page[at:].strip() else at


_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    notices: int
    heading: bool
    beside: bool
    named: tuple[int, ...]  # numbers of the named holders around it
    inside: bool

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


def _is_named(attrs: str) -> bool:
    """Whether a class, id or role names something beside an article; weak names do not count
    beside names of content."""
    names = [set(re.split(r"[^a-z0-9]+", n)) - {""} for f in _NAMED.finditer(attrs) for n in (f[1] or f[2] or f[3] or "").lower().split()]
    naming = [words & NAMES for words in names if words & NAMES and not words & UNNAMING]
    content = any(words & CONTENT for words in names)
    return any(found - WEAK or not content for found in naming)


_EDGES = "\"'.,:;!?()[]{}<>|–—-"


def _notices(words: list[str]) -> int:
    return sum(w in ("(c)", "©") or w.strip(_EDGES) in NOTICE for w in map(str.lower, words))


def blocks_of(page: str) -> list[Block]:
    """The flat text blocks of a page in order."""
    found: list[Block] = []
    # Open holders with the marks that hold inside each: beside, named, inside an article.
    open_: list[tuple[str, bool, tuple[int, ...], bool]] = []
    beside = inside = heading = False
    named: tuple[int, ...] = ()
    holders = 0
    parts: list[str] = []
    links: list[str] = []
    in_link = False
    ends: dict[str, dict[int, int]] = {}

    def end() -> None:
        nonlocal parts, links
        if parts:
            words = html.unescape("".join(parts)).split()
            if words:
                linked = len(html.unescape(" ".join(links)).split()) if links else 0
                found.append(Block(" ".join(words), len(words), min(linked, len(words)), _notices(words), heading, beside, named, inside))
            parts, links = [], []

    at, size = 0, len(page)
    while at < size:
        token = _TOKEN.search(page, at)
        text = page[at : token.start() if token else size]
        if text:
            parts.append(text)
            if in_link:
                links.append(text)
        if not token:
            break
        at = token.end()
        if token["silent"]:
            name = token["silent"].lower()
            if not token[0].endswith("/>"):
                if name == "head":
                    at = _end_of_head(page, at, ends)
                elif name in RAW:
                    at = _end_of_raw(page, name, at)
                else:
                    if name not in ends:
                        ends[name] = _ends(page, name)
                    at = ends[name].get(at) or _next_block(page, name, at)
            if name == "head":
                end()
            continue
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        if tag == "a":
            in_link = not token["close"]
        elif tag == "br":
            parts.append(" ")
        if tag not in BLOCKS and tag not in HOLDERS:
            continue
        end()
        heading = not token["close"] and len(tag) == 2 and tag[0] == "h" and tag[1] in "123456"
        if tag not in HOLDERS:
            continue
        if not token["close"]:
            attrs = token["attrs"]
            if attrs.endswith("/") or tag in VOID:
                continue
            open_.append((tag, beside, named, inside))
            is_named = bool(attrs) and _is_named(attrs)
            if tag in ("article", "main"):
                inside = True
            beside = beside or tag in BESIDE or (tag == "header" and not inside)
            if is_named or attrs and _HIDDEN.search(attrs):
                holders += 1
                named = (*named, holders)
        elif any(o[0] == tag for o in open_):
            while True:
                name, beside, named, inside = open_.pop()
                if name == tag:
                    break
        in_link = False
    end()
    return _without_wrappers(found)


def _without_wrappers(blocks: list[Block]) -> list[Block]:
    """Names do not count on a holder with nearly all plain words of the page."""
    plain = [0 if b.beside else b.words - b.linked for b in blocks]
    held: dict[int, int] = {}
    for block, words in zip(blocks, plain, strict=True):
        for holder in block.named:
            held[holder] = held.get(holder, 0) + words
    most = max(_WRAPPER * sum(plain), 1)
    wrappers = {holder for holder, words in held.items() if words >= most}
    return [b._replace(named=tuple(h for h in b.named if h not in wrappers)) if b.named else b for b in blocks] if wrappers else blocks


# ---- the tree ------------------------------------------------------------------------

FEATURES = (
    "words", "density", "words_before", "density_before", "words_after", "density_after", "notices", "heading", "beside", "named", "inside",
)
# The labelled table: pages whose blocks begin with + (main text) or - (anything else); {n} are
# n words of prose.
LABELLED = (
    # An article between header, menu, advert and footer; short blocks and lists inside it.
    "<header>-<a>{2}</a></header><nav><ul><li>-<a>{1}</a><li>-<a>{1}</a><li>-<a>{2}</a></ul></nav><div class=ad>-{9}</div>"
    "<article><h1>+{8}</h1><p>+{60}<p>+{45}<p>+{3}<p>+{120}</article><footer>-{12}</footer>",
    "<nav>-<a>{1}</a></nav><div class=ad>-{40}</div><article><h1>+{5}</h1><p>+{2}<ul><li>+{1}<li>+{3}<li>+{4}</ul><p>+{9}<p>+{1}</article>"
    "<div class=promo>-{25}</div><footer>-{4}</footer>",
    "<nav>-<a>{2}</a></nav><article><h1>+{8}</h1><p>+{95}<p>+{11}<p>+{210}<p>+{4}<p>+{20}<p>+{320}<p>+{2}<p>+{17}<p>+{130}<p>+{1}<p>+{150}<p>+{24}<p>+{107}</article>",
    "<article><h2>+{3}</h2><ul><li>+{2}<li>+{6}<li>+{1}<li>+{8}</ul><p>+{12}<p>+{15}<p>+{99}<p>+{22}<p>+{2}</article><div class=ad>-{8}</div>",
    "<article><p>+{1}</article>", "<article><h1>+{2}</h1><p>+{400}</article><footer>-{30}</footer>",
    # Menus, links and notices that no mark tells.
    "<main><div>-<a>Home</a> | <a>About</a> | <a>Contact</a></div><h1>+{6}</h1><p>+{40}<p>+{75}"
    "<div>-(c) 2024 All rights reserved. Subscribe to our newsletter now.</div></main>",
    "<article><h2>+{7}</h2><p>+{90}<p>+{33}<div>-<a>{5}</a> <a>{6}</a></div><ul><li>-<a>{7}</a><li>-<a>{6}</a><li>-<a>{8}</a></ul></article><aside>-{30}</aside>",
    "<main><ul><li>-<a>{1}</a><li>-<a>{2}</a></ul><div>-We use cookies to improve your experience. Accept all cookies or read our policy.</div>"
    "<h1>+{5}</h1><p>+{55}<p>+{8}<p>+{61}<p>-Copyright 2023 Example Ltd. All rights reserved.<p>-Share this article on social media<p>-Sign up for our newsletter</main>",
    "<article><h1>+Privacy policy and cookies</h1><p>+{70}<h2>+Newsletter</h2><p>+{50}<p>+{20} privacy {15} cookies {20}</article>",
    # Links in running text.
    "<article><h1>+{9}</h1><p>+{30} <a>{4}</a> {20}<p>+<a>{3}</a> {9}<p>+{12} <a>{8}</a><p>+{80}</article>",
    "<main><h1>+{4}</h1><p>+{25} <a>{9}</a> {8}<p>+{6} <a>{5}</a><p>-<a>{3}</a> / <a>{2}</a></main>",
    # Pages without an article element.
    "<div>-<a>{2}</a> <a>{1}</a> <a>{2}</a> <a>{1}</a></div><div><h1>+{7}</h1><p>+{50}<p>+{70}<p>+{25}<h2>+{4}</h2><p>+{64}</div>"
    "<div>-<a>{3}</a> <a>{4}</a></div><div>-{4}</div>",
    "<table><tr><td>-<a>{1}</a><td>-<a>{1}</a><td>-<a>{1}</a></table><p>+{38}<p>+{18}<p>+{110}<hr><p>-{3} <a>{2}</a>",
    "<div>-{2}</div><div>-<a>{1}</a> <a>{1}</a></div><div>-{3}</div><h1>+{9}</h1><div>+{200}</div><div>+{44}</div><div>-{5}</div><div>-<a>{2}</a></div><div>-{3}</div>",
    "<div>-<a>{6}</a></div><div>-{4}</div><div>-<a>{7}</a></div><div>-{3}</div><div>-<a>{5}</a></div><div><p>+{77}<p>+{58}<p>+{5}<p>+{49}</div>",
    "<div><p>+{30}<p>+{6}<p>+{28}<p>+{12} <a>{2}</a></div><div>-<a>{2}</a> <a>{2}</a></div><div>-Copyright {3}. All rights reserved.</div>",
    "<div>-<a>{2}</a></div><div><h1>+{6}</h1><p>+{95}<p>+{120}</div><div>-{6}</div><div>-{3}</div>", "<div><p>+{300}</div><div>-{8}</div><div>-<a>{3}</a></div>",
    # Text that would be main text in another place.
    "<article><h1>+{6}</h1><p>+{48}<p>+{36}</article><section id=comments><h3>-{2}</h3><div class=comment><p>-{65}</div>"
    "<div class=comment><p>-{30}<p>-{22}</div></section><footer>-{10}</footer>",
    "<article><p>+{70}<form>-{3}</form><p>+{41}<aside>-{28}</aside><p>+{52}<div class=advert><p>-{14}</div><p>+{6}</article>",
    "<div class=sidebar><p>-{60}<p>-{45}</div><div><h1>+{5}</h1><p>+{52}<p>+{66}</div><div class=newsletter>-{35}</div><aside>-{80}</aside><footer>-{50}</footer>",
    "<nav>-{3}</nav><form>-{20}</form><div class=cookie-notice>-{70}</div><p>+{33}<p>+{47}",
)
# Every page is labelled in several lengths: its prose so many times as long.
LENGTHS = (0.6, 1.0, 1.7, 3.0)
_FILL = re.compile(r"\{(\d+)\}")


def labelled_blocks() -> tuple[list[tuple[float, ...]], list[int]]:
    """Features and labels of the blocks of the labelled table."""
    features, labels = [], []
    for page, length in ((p, n) for p in LABELLED for n in LENGTHS):
        blocks = blocks_of(_FILL.sub(lambda n, by=length: " ".join(["prose"] * math.ceil(int(n[1]) * by)), page))
        labels += [int(b.text[0] == "+") for b in blocks]
        features += features_of([b._replace(text=b.text[1:], notices=_notices(b.text[1:].split())) for b in blocks])
    return features, labels


_DEPTH = 8

Tree = int | tuple[int, float, "Tree", "Tree"]


def grow(x: np.ndarray, y: np.ndarray, depth: int = _DEPTH) -> Tree:
    """CART: split where the Gini impurity falls most, in the first such place; leaves vote."""
    share = y.mean()
    best: tuple[float, int, float] | None = None
    if depth and 0 < share < 1:
        for feature in range(x.shape[1]):
            values = np.unique(x[:, feature])
            for cut in (values[1:] + values[:-1]) / 2:
                low = x[:, feature] <= cut
                impurity = sum(len(part) * part.mean() * (1 - part.mean()) for part in (y[low], y[~low]))
                if best is None or impurity < best[0] - 1e-12:
                    best = (impurity, feature, float(cut))
    if best is None:
        return int(share >= 0.5)
    low = x[:, best[1]] <= best[2]
    return best[1], best[2], grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)


@cache
def trained() -> Tree:
    features, labels = labelled_blocks()
    return grow(np.array(features, float), np.array(labels, float))


def features_of(blocks: list[Block]) -> list[tuple[float, ...]]:
    around = [(0, 0.0), *((b.words, b.density) for b in blocks), (0, 0.0)]
    return [
        (*around[k + 1], *around[k], *around[k + 2], b.notices / b.words, b.heading, b.beside, bool(b.named), b.inside)
        for k, b in enumerate(blocks)
    ]


def is_main(tree: Tree, features: tuple[float, ...]) -> bool:
    while not isinstance(tree, int):
        tree = tree[2] if features[tree[0]] <= tree[1] else tree[3]
    return bool(tree)


def main_text(page: str | None) -> str:
    if not page:
        return ""
    blocks, tree = blocks_of(page), trained()
    return "\n".join(b.text for b, f in zip(blocks, features_of(blocks), strict=True) if is_main(tree, f))


def extract(pages: DataFrame, html_column: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns named in ``keep``, then text and n_chars (code points)."""
    ship(pages.sparkSession)
    inner = [f"c{k}" for k in range(len(keep))]
    given = pages.select(F.col(f"`{html_column}`").alias("page"), *[F.col(f"`{c}`").alias(n) for c, n in zip(keep, inner, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], [*inner, "text", "n_chars"]
            )

    schema = ", ".join(f"{n} {t}" for n, t in [*given.dtypes[1:], ("text", "string"), ("n_chars", "bigint")])
    return given.mapInArrow(run, schema).toDF(*keep, "text", "n_chars")
