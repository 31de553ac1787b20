"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. The first pass decides the clear ones by the
elements and names around them, the share of their characters inside links, their length and
the share of stop words: boilerplate or main text. Short or unclear blocks stay open; the second
pass gives them the label of the nearest decided block, where a block of the same section is
nearer than any other.

Every page is worked on alone, inside the scan's tasks.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgrid.llm.common import table, text_or_empty
from obsgrid.llm.registry import query

#: Share of characters in links from which a block is boilerplate.
LINKS = 0.5
#: Blocks below so many characters are too short to be decided by their words.
SHORT = 70
#: Shares of stop words from which a block is main text, and below which it isn't.
MANY_STOPS = 0.15
FEW_STOPS = 0.03

# Frequent words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "the of and to in a is that it for as with was on be by this are from at or an not but have "
    "der die das und ist von den mit im ein eine zu auf für nicht des dem als auch sich es an in "
    "le la les de des et un une du est que qui dans pour pas sur au par en il elle ce avec "
    "el los las y en que del una por con para no se lo su es al como más o sus".split()
)
# Elements by their part in a page.
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BOILERPLATE = frozenset(
    "nav footer aside form head script style noscript iframe button select option textarea "
    "template svg canvas object dialog menu label fieldset video audio".split()
)
MAIN = frozenset("article main".split())
VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr "
    "html legend li main menu nav ol optgroup option p pre section select summary table tbody "
    "td tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Names in class, id and role attributes that mark boilerplate.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adsbygoogle sponsor sponsored "
    "promo promotion banner sidebar menu nav navbar navigation breadcrumb breadcrumbs masthead "
    "footer cookie cookies consent gdpr notice notification alert popup modal overlay newsletter "
    "subscribe subscription signup login search share sharing social related recommended "
    "recommendations widget comment comments respond replies disqus pagination pager "
    "contentinfo complementary dialog toolbar skip copyright disclaimer legal paywall".split()
)
#: First and last words of names that tell a page's state rather than what an element is.
STATE_FIRST = frozenset("has no not with without".split())
STATE_LAST = frozenset("open opened closed collapsed expanded enabled disabled".split())
OUTSIDE_MAIN = frozenset({"header", "site-header", "banner"})

TAG = re.compile(
    r"<!--(?:.*?-->|.*)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'){0,400}+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>"
    r"|<[!?/][^>]*+>",
    re.S,
)
ATTRIBUTE = re.compile(
    r"([a-zA-Z_:][-\w:.]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?+"
)
#: Ends of sentences, which lists of names and menus don't have.
SENTENCE = re.compile(r"[.!?…][\"'»”’)\]]*(?:\s|$)|[。！？।؟۔።]")
_LATIN = re.compile(r"[A-Za-zÀ-ɏ]")
_WORD = re.compile(r"[^\W\d_]+")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Block:
    text: str
    link_chars: int
    #: Number of the innermost section around it.
    section: int
    main: bool
    boilerplate: bool
    heading: bool
    code: bool = False
    #: Numbers of the elements around it that only their names mark, outermost first.
    named: tuple[int, ...] = ()
    #: How many of them are outside the outermost article.
    outside: int = 0
    label: bool | None = None
    #: The label that an open block gets from its neighbours.
    inherited: bool | None = None


@dataclass
class _Open:
    name: str
    boilerplate: bool
    main: bool
    section: int
    named: tuple[int, ...] = ()
    outside: int = 0


def _marks_boilerplate(name: str, attrs: str, in_main: bool) -> str:
    """What marks the element: "is" for itself, "name" for a name only, nothing else."""
    if name in BOILERPLATE or (name == "header" and not in_main):
        return "is"
    if not attrs.strip() or name in ("html", "body", "article", "main"):
        return ""
    found = {k.lower(): (a or b or c or "") for k, a, b, c in ATTRIBUTE.findall(attrs)}
    if "hidden" in found or found.get("aria-hidden") == "true":
        return "is"
    if "display:none" in found.get("style", "").replace(" ", "").lower():
        return "is"
    named = " ".join(found.get(k, "") for k in ("class", "id", "role"))
    words = set()
    for one in named.split():
        parts = [w.lower() for w in _NAME.findall(one)]
        if len(parts) < 2 or not (parts[0] in STATE_FIRST or parts[-1] in STATE_LAST):
            words.update(parts)
    return "name" if words & NAMES or (not in_main and words & OUTSIDE_MAIN) else ""


@dataclass
class _Cutter:
    """Cuts a page into blocks. Elements that are never closed end with the one around them."""

    blocks: list[Block] = field(default_factory=list)
    stack: list[_Open] = field(default_factory=lambda: [_Open("", False, False, 0)])
    pieces: list[tuple[str, bool]] = field(default_factory=list)
    link_depth: int = 0
    sections: int = 0

    def end_block(self) -> None:
        if self.pieces:
            whole = " ".join("".join(t for t, _ in self.pieces).split())
            if whole:
                linked = sum(len(" ".join(t.split())) for t, link in self.pieces if link)
                top = self.stack[-1]
                heading = any(e.name in HEADINGS for e in self.stack[-3:])
                code = any(e.name == "pre" for e in self.stack)
                self.blocks.append(
                    Block(whole, linked, top.section, top.main, top.boilerplate, heading, code, top.named, top.outside)
                )
            self.pieces = []

    def close(self, name: str) -> None:
        at = next((i for i in range(len(self.stack) - 1, 0, -1) if self.stack[i].name == name), 0)
        if at:
            del self.stack[at:]
            if len(self.stack) < self.link_depth:
                self.link_depth = 0

    def start(self, name: str, attrs: str) -> None:
        if name == "a":
            self.link_depth = len(self.stack) if "href" in attrs.lower() else 0
            return
        if name in VOID or attrs.endswith("/"):
            if name == "br" or name in BLOCKS:
                self.text(" ")
            if name in BLOCKS:
                self.end_block()
            return
        if name in BLOCKS:
            self.end_block()
            # A paragraph ends where the next block starts; so do items of one list or table.
            if self.stack[-1].name == "p" or self.stack[-1].name == name in ("li", "dd", "dt", "tr", "td", "th", "option"):
                self.close(self.stack[-1].name)
        elif name not in BOILERPLATE:
            return
        top = self.stack[-1]
        main = top.main or name in MAIN
        marked = _marks_boilerplate(name, attrs, main)
        if name in MAIN or marked or name in ("header", "section"):
            self.sections += 1
            section = self.sections
        else:
            section = top.section
        named = (*top.named, section) if marked == "name" else top.named
        outside = top.outside if top.main else len(named)
        self.stack.append(_Open(name, top.boilerplate or marked == "is", main, section, named, outside))

    def end(self, name: str) -> None:
        if name == "a":
            self.link_depth = 0
        elif name in BLOCKS:
            self.end_block()
            self.close(name)
        elif name in BOILERPLATE:
            self.close(name)

    def text(self, raw: str) -> None:
        if raw:
            self.pieces.append((html.unescape(raw), bool(self.link_depth)))


def cut(page: str) -> list[Block]:
    """The text blocks of a page in order. Scripts, styles and comments hold no text."""
    cutter, at, size = _Cutter(), 0, len(page)
    # No tag ends after this, so none is looked for there.
    last = page.rfind(">") + 1
    while at < size:
        tag = TAG.search(page, at, last) if at < last else None
        if tag is None:
            comment = page.find("<!--", at)
            cutter.text(page[at : comment if comment >= 0 else size])
            break
        cutter.text(page[at : tag.start()])
        at = tag.end()
        if tag[0].startswith("<!--") and not tag[0].endswith("-->"):
            break
        name = (tag["name"] or tag["name2"] or "").lower()
        if not name:
            continue
        if tag["end"] or tag["end2"]:
            cutter.end(name)
        elif name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
            if name in BLOCKS:
                cutter.end_block()
            at = close.end() if close else size
        else:
            cutter.start(name, tag["attrs"] or tag["attrs2"] or "")
    cutter.end_block()
    return cutter.blocks


def _first_pass(block: Block) -> bool | None:
    """True for main text, False for boilerplate, None for open."""
    size = len(block.text)
    if block.boilerplate or block.link_chars > LINKS * size:
        return False
    if size < SHORT or block.heading:
        return None
    words = _WORD.findall(block.text.lower())
    stops = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if stops >= MANY_STOPS:
        return True
    # Few stop words mean another language, code or a list: inside an article none of them is
    # boilerplate, outside only what doesn't read like text is.
    return False if stops < FEW_STOPS and not block.main and not _reads_on(block, words) else None


def _reads_on(block: Block, words: list[str]) -> bool:
    """Code, sentences, or letters of which the stop words say nothing."""
    if block.code or SENTENCE.search(block.text):
        return True
    return 2 * sum(bool(_LATIN.match(w)) for w in words) < len(words)


def _fall_back(blocks: list[Block]) -> None:
    """Where no block is decided to be main text, the long ones with few links are: those that
    are open, else those that only their words decided against."""
    if any(b.label for b in blocks):
        return
    long = [b for b in blocks if len(b.text) >= SHORT and not b.heading and not b.boilerplate]
    long = [b for b in long if b.link_chars <= LINKS * len(b.text)]
    if not any(b.main for b in blocks if b.label is None):
        long = [b for b in long if b.label is None] or long
    else:
        long = [b for b in long if b.label is None]
    for block in long:
        block.label = True


def _second_pass(blocks: list[Block]) -> None:
    """Open blocks take the label of the nearest decided one: of their own section if it has
    any, else of the page unless they are in an article. A heading looks ahead first; at equal
    distance main text wins. Where all blocks are short and none is decided to be main text, the
    open ones are it."""
    if not any(b.label for b in blocks if b.label is not None):
        near = {}
    else:
        near = _neighbours(blocks)
    for i, block in enumerate(blocks):
        if block.label is None:
            at = near.get(i, ())
            if block.heading:
                at = [j for j in at if j > i] or at
            best = min(at, key=lambda j: (abs(j - i), not blocks[j].label), default=None)
            block.inherited = True if best is None else blocks[best].label
    for block in blocks:
        if block.label is None:
            block.label = block.inherited


def _neighbours(blocks: list[Block]) -> dict[int, list[int]]:
    """For each open block the nearest decided ones before and after it, by one sweep each way: in
    its section, or on the page if the section has none and isn't in an article."""
    out: dict[int, list[int]] = {}
    sections = {b.section for b in blocks if b.label is not None}
    for turn in (range(len(blocks)), range(len(blocks) - 1, -1, -1)):
        last: dict[int | None, int] = {}
        for i in turn:
            block = blocks[i]
            if block.label is not None:
                last[block.section] = i
                if not block.boilerplate:
                    last[None] = i
            elif block.section in sections:
                if block.section in last:
                    out.setdefault(i, []).append(last[block.section])
            elif not block.main and None in last:
                out.setdefault(i, []).append(last[None])
    return out


def _mark_named(blocks: list[Block]) -> None:
    """Mark blocks under boilerplate names, leaving out names around what must be the text.

    Names outside all of a page's articles don't count for those, and where every block is under
    a name, that around most of the text doesn't, if it holds several blocks.
    """
    plain = [b for b in blocks if not b.boilerplate]
    main = [b for b in plain if b.main]
    if main and all(b.outside for b in main):
        for b in main:
            b.named = b.named[b.outside :]
    while plain and all(b.named for b in plain):
        held: dict[int, list[Block]] = {}
        for b in plain:
            held.setdefault(b.named[0], []).append(b)
        most = max(held.values(), key=lambda bs: sum(len(b.text) for b in bs))
        if len(most) < 2:
            break
        for b in most:
            b.named = b.named[1:]
    for b in plain:
        b.boilerplate = bool(b.named)


def main_text(page: str | None) -> str:
    """The blocks of main text, each with single spaces, joined by two line breaks."""
    blocks = cut(page or "")
    _mark_named(blocks)
    for block in blocks:
        block.label = _first_pass(block)
    _fall_back(blocks)
    open_blocks = [b for b in blocks if b.label is None]
    if open_blocks:
        # Labels of the first pass only: what inherits is no neighbour for others.
        _second_pass(blocks)
    return "\n\n".join(b.text for b in blocks if b.label)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    A null or empty page has an empty text. Ids and addresses come as they are, null and
    repeated ones too. An empty table gives no rows; other columns are not looked at.
    """

    @F.pandas_udf("string")
    def extracted(htmls: pd.Series) -> pd.Series:
        return pd.Series([main_text(x) for x in htmls], dtype=object)

    return (
        pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), text_or_empty(html).alias("_html"))
        .select("page_id", "url", extracted(F.col("_html")).alias("text"))
        .withColumn("n_chars", F.char_length("text").cast("long"))
    )


@query()
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
