"""Main text of web pages by two-pass block rules.

A page is cut into blocks at its block elements. The first pass labels every block by stop-word density, link
density and length: good, bad, or short (undecided). The second gives undecided blocks the label of the nearest
decided blocks of the same region: between two of one label that label, otherwise that of the nearer one. An article
or main element is a region of its own; where nothing in a region is decided, it speaks for its text. What stands in
menus, footers, forms and the like is never text, whatever it reads like. A page on which no block is dense enough in
stop words is one of an unknown language, and goes by link density and length.
"""

from __future__ import annotations

import html
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import map_columns

# Stop words of the languages served.
STOP_WORDS = frozenset(
    """
    a an the of and or to in is are was were be been for on at by with from that this it its he she his her they we you
    i not as but have has had will would can could which who what when there their our your
    der die das und in zu den von mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass
    sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber
    le la les de des du et à un une en est que qui dans pour sur pas par au aux ce il elle ne se plus avec son sa ses
    sont ou mais nous vous je cette été être leur
    el los las del y una que se no por con para su al lo más pero sus este ha si porque esta entre cuando muy sin sobre
    también me hasta hay donde quien desde todo nos durante son era o ja
    """.split()
)
BLOCKS = frozenset(
    """
    address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form
    frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre search section select summary
    table tbody td textarea tfoot th thead title tr ul
    """.split()
)
#: Elements whose content is not shown, or not part of a page's text.
RAW = "script|style|noscript|template|iframe|object|svg|math|canvas|audio|video|textarea|title|noframes"
DROP = frozenset("nav aside footer form menu dialog button select option head fieldset search label input".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of class, id and role names that mark what is no article text.
MARKS = frozenset(
    """
    ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments comentarios kommentare
    commentaires discussion disqus cookie cookies consent copyright disclaimer footer gdpr header masthead menu menus
    menubar modal nav navbar navigation newsletter notice notices overlay pagination pager popup promo promoted promotion
    related replies reply respond share sharing sidebar sidenav skip social sponsor sponsored subscribe subscription tags
    toolbar topbar widget widgets complementary contentinfo alert alertdialog search signup login
    """.split()
)
ROOTS = frozenset(("article", "main"))
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<raw>{RAW})(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^\"'>])*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][\w:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^\"'>])*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
NAMED = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
WORDS = re.compile(r"[^\W\d_]+")

SHORT = 70
LONG = 180
STOP_LOW = 0.15
STOP_HIGH = 0.25
LINKS = 0.5
REACH = 200


#: For an article element, whose class often lists subjects, only these whole words count.
ASIDE = frozenset("comment comments reply ad advert advertisement sponsored promo related".split())
LAYOUT = frozenset("with has no without".split())
HEADS = frozenset("header masthead banner".split())


def _marked(attrs: str, root: bool, inside: bool) -> bool:
    """Whether class, id, role or style say that an element is not part of the text.

    `root`: it is an article or main element; `inside`: it stands in one, where a header is the article's own.
    """
    for name, value in NAMED.findall(attrs):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return True
            continue
        for word in value.split():
            parts = {word} if root else {word, *re.split(r"[-_]+", word)}
            bad = parts & (ASIDE if root else MARKS)
            if bad and not parts & LAYOUT and not (inside and bad <= HEADS):
                return True
    return False


class _Block:
    __slots__ = ("text", "links", "region", "heading", "barred")

    def __init__(self, text, links, region, heading, barred):
        self.text, self.links, self.region, self.heading, self.barred = text, links, region, heading, barred


def blocks(page: str) -> list[_Block]:
    """Blocks in page order. `region` numbers the article or main element around a block, 0 outside of all."""
    out: list[_Block] = []
    pieces: list[str] = []
    linked = 0
    stack: list[tuple[str, bool, int]] = []  # tag, whether barred from here on, region
    regions = 0
    in_link = 0
    heading = False

    def flush():
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                barred, region = (stack[-1][1], stack[-1][2]) if stack else (False, 0)
                out.append(_Block(text, linked, region, heading, barred))
            pieces.clear()
        linked = 0

    def add(text: str):
        nonlocal linked
        pieces.append(text)
        if in_link:
            linked += len(text.strip())

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "a":
            in_link = 0 if m["close"] else 1
            continue
        if tag == "br":
            add(" ")
            continue
        block = tag in BLOCKS
        if block:
            flush()
            heading = len(tag) == 2 and tag[0] == "h" and tag[1] in "123456" and not m["close"]
        if tag in VOID:
            continue
        if m["close"]:
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if k is not None:
                if not block and stack[k][1] != (stack[k - 1][1] if k else False):
                    flush()
                del stack[k:]
            continue
        if not block and tag not in DROP and "=" not in m["attrs"]:
            continue  # plain inline mark-up
        barred, region = (stack[-1][1], stack[-1][2]) if stack else (False, 0)
        if tag in ("p", "li", "td", "th", "tr", "dt", "dd", "option"):  # closes itself when the next begins
            top = len(stack) - 1
            while top >= 0 and stack[top][0] not in BLOCKS:
                top -= 1
            if top >= 0 and stack[top][0] == tag:
                del stack[top:]
                barred, region = (stack[-1][1], stack[-1][2]) if stack else (False, 0)
        if m["attrs"].endswith("/") and not block:
            continue
        own = tag in DROP or (tag == "header" and not region) or (
            tag not in ("html", "body") and "=" in m["attrs"] and _marked(m["attrs"], tag in ROOTS, bool(region))
        )
        if own and not block and not barred:
            flush()
        if tag in ROOTS and not barred and not own:
            if tag == "main" or not region or not any(t == "article" for t, _, _ in stack):
                regions += 1
                region = regions
        if block or own:
            stack.append((tag, barred or own, region))
    if at < len(page):
        add(page[at:])
    flush()
    return out


def _first_pass(b: _Block, foreign: bool = False) -> str:
    if b.barred:
        return "bad"
    size = len(b.text)
    if b.links > LINKS * size:
        return "bad"
    if size < SHORT or b.heading:
        return "short"
    if foreign:
        return "good"
    density = _density(b)
    if density >= STOP_HIGH or (size >= LONG and density >= STOP_LOW):
        return "good"
    if density >= STOP_LOW or b.region:  # lists, code and figures of an article go with what stands around them
        return "short"
    return "bad"


def _density(b: _Block) -> float:
    words = WORDS.findall(b.text.lower())
    return sum(w in STOP_WORDS for w in words) / max(len(words), 1)


def labels(found: list[_Block]) -> list[bool]:
    """Whether each block is text, after both passes."""
    first = [_first_pass(b) for b in found]
    if "good" not in first and all(_density(b) < STOP_LOW for b in found if not b.barred and len(b.text) >= SHORT and b.links <= LINKS * len(b.text)):
        first = [_first_pass(b, foreign=True) for b in found]
    by_region: dict[int, list[int]] = {}
    for i, b in enumerate(found):
        if not b.barred:
            by_region.setdefault(b.region, []).append(i)
    out = [False] * len(found)
    for region, own in by_region.items():
        decided = [(k, first[i]) for k, i in enumerate(own) if first[i] != "short"]
        before: list[tuple[int, str] | None] = []
        last = None
        for k, i in enumerate(own):
            before.append(last)
            if first[i] != "short":
                last = (k, first[i])
        after: list[tuple[int, str] | None] = [None] * len(own)
        last = None
        for k in range(len(own) - 1, -1, -1):
            after[k] = last
            if first[own[k]] != "short":
                last = (k, first[own[k]])
        for k, i in enumerate(own):
            if first[i] != "short":
                out[i] = first[i] == "good"
                continue
            near = [x for x in (before[k], after[k]) if x]
            if not decided:
                out[i] = region > 0  # nothing decided near: an article element speaks for its text
            elif len({x[1] for x in near}) == 1:
                out[i] = near[0][1] == "good"
            else:
                out[i] = min(near, key=lambda x: (abs(x[0] - k), x[1] == "bad"))[1] == "good"
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found = blocks(page)
    return "\n".join(b.text for b, keep in zip(found, labels(found)) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row.

    A null or empty page has the empty text. Repeated rows stay, each with its own result. Broken markup is
    read to its end: unclosed elements end with the page.
    """

    def start():
        def rows(at):
            texts = [main_text(h) for h in at["html"]]
            return {**at, "text": texts, "n_chars": [len(t) for t in texts]}

        return rows

    kind = "page_id long, url string, text string, n_chars long"
    return map_columns(pages.select(F.col("page_id").cast("long"), "url", "html"), kind, start)
