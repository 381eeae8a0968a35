"""Main-text extraction by two-pass block rules (operator 6).

A page is cut into blocks at block-level tags; each block knows its text, its
share of link text, its stop-word density, and the container it stands in.
Pass one classifies every block by itself: boilerplate containers and link-heavy
blocks are bad, long blocks with enough stop words are good, the rest is undecided.
Stop words are a list for some languages and, for any other, the short words that the
page itself repeats. Pass two lets undecided blocks inherit from the nearest decided
neighbours: a heading from what follows it, a short block from those in its own
container or from both sides, others from either side. Inside an ``article`` or
``main`` element the container is evidence that a block is text, so there only
runs of links are bad; what is good outside of it stays. A container is boilerplate by
its element, or by a word of its class, id or role; if no text is left, only the
elements count.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML by their role here.
SKIPPED = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "audio", "video",
           "select", "textarea", "head", "title"}
BOILERPLATE = {"nav", "footer", "aside", "form", "dialog", "menu", "button"}
MAIN = {"article", "main"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "dir",
          "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
          "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre",
          "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# A class, id or role with one of these words marks a boilerplate container.
HINTS = {"ad", "ads", "advert", "advertisement", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
         "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "masthead", "menu", "modal", "nav", "navbar",
         "navigation", "newsletter", "notice", "pagination", "popup", "promo", "promotion", "related", "replies", "respond",
         "search", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
         "contentinfo", "complementary"}
STOP_WORDS = frozenset((
    "the of and to in a is that for on with as it at by from be are was this or an not have has had were which their "
    "der die das und ist nicht ein eine mit von zu den dem des für auf im sich auch als bei aus "
    "le la les de des et un une du est que qui dans pour pas sur par plus avec au ne ce "
    "el los las que y en un una por con para es del se no lo como más su al").split())

# Words that turn a class name around (no-sidebar, has-footer).
NEGATIONS = {"no", "not", "without", "has", "with", "hide", "hidden"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Elements that hold blocks together, unlike paragraphs, headings and lists.
CONTAINERS = {"article", "aside", "body", "center", "details", "dialog", "div", "fieldset", "footer", "form", "header", "main", "nav",
              "section", "table"}

LENGTH_LOW, LENGTH_HIGH = 70, 200      # code points
FREQUENT, SHORT_WORD, MOST_STOPS = 3, 4, 0.85  # times on a page, letters, share of words
STOPS_LOW, STOPS_HIGH = 0.10, 0.20     # share of words
LINKS_HIGH = 0.33                      # share of link characters

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_HINT = re.compile(r"(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_WORD = re.compile(r"[^\W\d_]+")
_SPACE = re.compile(r"\s+")
_SENTENCE = re.compile(r"[.!?…。！？؟।][\"'”’»)\]]*$")


@dataclass
class Block:
    text: str
    links: int
    main: bool
    boilerplate: bool
    hinted: bool = False     # in a container that its class, id or role calls boilerplate
    heading: bool = False
    container: int = 0
    verdict: str = field(default="")


def _hinted(name: str, attributes: str) -> bool:
    """Whether a name of the element's class, id or role is a hint; of a name in two
    parts (site-footer) either part, but for elements that hold the main text."""
    for quoted in _HINT.findall(attributes):
        for token in quoted.strip("\"'").lower().split():
            parts = [w for w in re.split(r"[^a-z]+", token) if w]
            if token in HINTS or (name not in MAIN and len(parts) <= 2 and not NEGATIONS & set(parts) and HINTS & set(parts)):
                return True
    return False


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order, boilerplate ones included."""
    out: list[Block] = []
    text: list[str] = []
    links = 0
    # name; in main, in boilerplate, in a hinted container, in a link; container, heading
    stack: list[tuple] = []
    opened: Counter[str] = Counter()  # names on the stack
    main = boiler = hinted = link = heading = False
    at = container = containers = 0

    def close() -> None:
        nonlocal links
        joined = _SPACE.sub(" ", "".join(text)).strip()
        if joined:
            out.append(Block(joined, min(links, len(joined)), main, boiler, hinted, heading, container))
        text.clear()
        links = 0

    while at < len(page):
        m = _TOKEN.search(page, at)
        raw = page[at:m.start() if m else len(page)]
        if raw:
            decoded = entities.unescape(raw)
            text.append(decoded)
            links += len(decoded.strip()) if link else 0
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        name, closing = m[2].lower(), bool(m[1])
        if name in BLOCKS:
            close()
        if closing:
            while opened[name]:
                inner, main, boiler, hinted, link, container, heading = stack.pop()
                opened[inner] -= 1
                if inner == name:
                    break
            continue
        if name in SKIPPED:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            if not m[3].rstrip().endswith("/"):
                if end:
                    at = end.end()
                elif name != "head":
                    at = len(page)
            continue
        if name in VOID or m[3].rstrip().endswith("/"):
            continue
        if name in ("p", "li", "option", "tr", "td", "th", "dt", "dd") and stack and stack[-1][0] == name:
            _, main, boiler, hinted, link, container, heading = stack.pop()  # these end where the next one starts
            opened[name] -= 1
        stack.append((name, main, boiler, hinted, link, container, heading))
        opened[name] += 1
        header = name == "header" and not main  # an article's own header holds its heading
        boiler = boiler or name in BOILERPLATE or header or bool(name not in ("html", "body") and _HIDDEN.search(m[3]))
        hinted = hinted or name not in ("html", "body") and _hinted(name, m[3])
        main = main or name in MAIN
        link = link or name == "a"
        heading = heading or name in HEADINGS
        if name in CONTAINERS:
            containers += 1
            container = containers
    close()
    return out


def _frequent(blocks: list[Block]) -> set[str]:
    """Short words that a page repeats: what stop words are in any language."""
    counts = Counter(w for b in blocks if not b.boilerplate for w in _WORD.findall(b.text.lower()) if len(w) <= SHORT_WORD)
    return {w for w, n in counts.items() if n >= FREQUENT}


def _stop_share(text: str, frequent: set[str]) -> float:
    """Share of stop words, by the list or by the page, whichever is larger; where nearly
    every word is one of the page's, it tells nothing."""
    words = _WORD.findall(text.lower())
    listed, own = (sum(w in known for w in words) / max(1, len(words)) for known in (STOP_WORDS, frequent))
    return max(listed, own if own <= MOST_STOPS else 0.0)


def _first_pass(b: Block, frequent: set[str], hints: bool) -> str:
    """``bad`` and ``good`` are decided; ``heading``, ``short``, ``near`` and ``links`` are not."""
    if b.boilerplate or (hints and b.hinted):
        return "bad"
    share = b.links / max(1, len(b.text))
    if b.main:
        if share > 0.8:
            return "links"
        return "good" if len(b.text) >= LENGTH_LOW or _stop_share(b.text, frequent) >= STOPS_HIGH else "short"
    if share > LINKS_HIGH:
        return "bad"
    if b.heading:
        return "heading"
    if len(b.text) < LENGTH_LOW:
        return "bad" if b.links else "short"
    stops = _stop_share(b.text, frequent)
    if stops >= STOPS_HIGH and len(b.text) > LENGTH_HIGH:
        return "good"
    return "near" if stops >= STOPS_LOW or not b.links or _SENTENCE.search(b.text) else "bad"


def classify(blocks: list[Block], hints: bool = True) -> list[Block]:
    """Both passes; afterwards every verdict is ``good`` or ``bad``."""
    frequent = _frequent(blocks)
    first = [_first_pass(b, frequent, hints) for b in blocks]
    n = len(blocks)
    for i in range(n):  # links in the main text: three or more in a row are a menu
        if first[i] == "links" and (i == 0 or first[i - 1] != "links"):
            j = i
            while j < n and first[j] == "links":
                j += 1
            run = "bad" if j - i >= 3 else "short"
            first[i:j] = [run] * (j - i)
    before, after = [None] * n, [None] * n
    for order, side in ((range(n), before), (range(n - 1, -1, -1), after)):
        last = {}
        for i in order:  # the nearest decided neighbour in the same kind of container
            side[i] = last.get(blocks[i].main)
            if first[i] in ("good", "bad") and not blocks[i].boilerplate and not (hints and blocks[i].hinted):
                last[blocks[i].main] = (i, first[i])
    for i, b in enumerate(blocks):
        b.verdict = first[i]
        if first[i] in ("good", "bad"):
            continue
        near = sorted((abs(j - i), v != "good", v, blocks[j].container) for j, v in filter(None, (before[i], after[i])))
        if b.main:
            good = not (near and all(v == "bad" for _, _, v, _ in near) and b.links)
        elif first[i] == "heading":
            good = (after[i] or before[i] or (i, "good"))[1] == "good"
        elif first[i] == "near":
            good = not near or any(v == "good" for _, _, v, _ in near)
        else:
            good = (not near or any(v == "good" and c == b.container for _, _, v, c in near)
                    or len(near) == 2 and all(v == "good" for _, _, v, _ in near))
        b.verdict = "good" if good else "bad"
    # headings that introduce undecided text, by what became of it
    for i in range(n - 2, -1, -1):
        if first[i] == "heading" and first[i + 1] not in ("good", "bad") and blocks[i + 1].container == blocks[i].container:
            blocks[i].verdict = blocks[i + 1].verdict
    return blocks


def main_text(page: str | None) -> str:
    """The good blocks of a page, joined by one space; of a page without any, those
    that are good if class names tell nothing."""
    blocks = classify(blocks_of(page or ""))
    if not any(b.verdict == "good" for b in blocks):
        blocks = classify(blocks, hints=False)
    return " ".join(b.text for b in blocks if b.verdict == "good")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h).encode("utf-8", "replace").decode() for h in batch["html"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page.

    Defined cases: null or empty html gives an empty text; ids and urls may be
    null or repeated, every row is its own page; unclosed or stray tags, comments
    and character references without a semicolon are read as browsers do; text
    without any tag is one block outside of containers; an empty table gives no
    rows. Other columns are not read, whatever their names."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
