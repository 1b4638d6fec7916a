"""HTML extraction by two-pass block rules.

A page is cut into blocks at its block-level tags. Pass one classifies every block by itself, by
its length, the share of its letters inside links (link density) and the share of its words that
are stop words: good, near good, bad or short. Markup that names its role counts as well: blocks
in navigation, headers, footers, asides, forms, notices, adverts and comments are bad, and inside
a marked article a block needs less to be good: some stop words at any length; without them, or
with many links, it is near good. Pass two lets the ambiguous blocks, short and near good, inherit
the label of their nearest decided neighbours before and after; a heading goes with what follows
it, and a short block without links with the good blocks of its parent element. A page on which no block
is decided good keeps its near good blocks, or else its short ones without links. A marked article (or else <main>) stands for the page, and what is outside of it is bad, only
if it holds at least half of the text found good; a teaser does not, and then blocks are judged
as if nothing were marked.

Stop words are those of six languages in Latin script. A block in another script is judged by its length
and links alone, and so are all blocks of a page in Latin script on which no block has stop words. In
scripts that write whole words in one character, a character counts as three.

Class and id names mark small parts only. A name is a whole token ("ad") or one made of such names
and words for parts ("social-share", "comment-list"), so that "category-legal" is none. Names do not
count on an article, nor on an element that holds more than half of the page's good text; an
element named after comments must hold all text that is not boilerplate otherwise.

Character references are decoded, white space inside a block becomes one space, and good blocks
are joined in page order by an empty line. Nothing else is dropped or capped.

Defined results: null and empty html give the empty text; unclosed and stray tags are taken as
browsers take them, as far as blocks are concerned; an unclosed comment or script runs to the end
of the page; an empty table gives no rows; repeated rows get equal texts; extra columns never clash.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgergraph.llm.common import pick, read

# Thresholds of pass one.
SHORT, LONG = 70, 200              # characters
FEW_STOP_WORDS, MANY_STOP_WORDS = 0.10, 0.25
MANY_LINKS = 0.33
# a notice of rights begins with one of these
RIGHTS = re.compile(r"\W{0,3}(?:©|\(c\)|copyright\b)", re.I)
# letters of Latin script; characters that are words or syllables (Chinese, Japanese, Korean)
LATIN = re.compile("[A-Za-z\u00aa-\u024f\u1e00-\u1eff]")
DENSE = re.compile("[\u2e80-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003ffff]")

# Stop words (fixed values): the commonest function words of the languages expected.
STOP_WORDS = frozenset((
    "a an and are as at be by for from has have he her his i in is it its not of on or she that the their "
    "they this to was we were which will with you "
    "au aux avec ce ces dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas "
    "pour qu que qui sa se ses son sur un une vous "
    "als am auch auf aus bei das dass dem den der die ein eine einen er es für hat ich ihr im ist "
    "mit nach nicht oder sich sie sind so über und von war wie wir zu zum "
    "al como con del donde el ella ellos era esta este fue ha los lo más muy no para pero por se si sin "
    "su sus también todo y ya").split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<((svg|math)|script|style|noscript|template|iframe|object|textarea|select|canvas|audio|video|title|noframes)"
    r"(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+>(?:(?(2)(?<=/>)|(?!))|.*?(?:</\1\s*+>|\Z))"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>"
    r"|<[!?/][^>]*+>", re.S | re.I)
ATTRIBUTE = re.compile(r"([^\s\"'=<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")

# <head> is no element here: what may stand in it has no text of the page, and what may not ends it
VOID = frozenset("head area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt "
                   "ruby s samp small span strike strong sub sup time tt u var wbr img input".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form button menu dialog fieldset".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu "
                              "menubar toolbar".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads advert advertisement advertising adsense adbox sponsor sponsored promo promotion widget comment comments reply "
    "replies respond disqus discussion notice notices cookie cookies consent gdpr popup modal overlay alert warning newsletter "
    "subscribe subscription signup signin login register share sharing social follow related recommended recommendations "
    "trending popular pagination pager skip copyright legal disclaimer".split())
# names of the parts of a page's layout; wrappers of a whole page bear them too ("has-sidebar")
LAYOUT_NAMES = frozenset("banner nav navbar navigation menu submenu breadcrumb breadcrumbs footer sidebar side aside rail "
                         "search toolbar".split())
HEADER_NAMES = frozenset("header masthead topbar".split())
COMMENT_NAMES = frozenset("comment comments reply replies respond disqus discussion".split())
# words for a part that may stand beside a name in one token ("comment-list")
PART_WORDS = frozenset("area banner bar block box button buttons container form icons inner links list message posts section "
                       "wrapper".split())
LAYOUT, HARD = 1, 2      # kinds of boilerplate: an article inside a layout part is an article all the same


NO_ELEMENT = ("", 0, 0, None)
# elements that are a block themselves
TEXT_ELEMENTS = frozenset("p li dd dt span".split())


@dataclass(eq=False)
class Named:
    """An element that its class or id names boilerplate; or an article in one, which no LAYOUT name marks."""
    kind: int                      # LAYOUT or HARD; 0: an article
    comments: bool = False
    outer: Named | None = None     # the next one around it
    depth: int = 0
    marks: int = 0                 # kind of boilerplate that names make of its text


@dataclass
class Block:
    text: str
    link_chars: int
    heading: bool
    boilerplate: int       # 0, LAYOUT or HARD
    region: int            # 0 outside, 1 inside <main>, 2 inside <article>
    named: Named | None = None     # innermost element around it that its name makes boilerplate
    label: str = ""
    stops: float | None = None     # share of its words that are stop words
    parent: int = 0        # number of the element that holds it
    size: int = 0          # characters, as far as they say how long it is


def _names(found: dict[str, str]) -> set[str]:
    """The boilerplate names among an element's class and id tokens."""
    names: set[str] = set()
    for token in (found.get("class", "") + " " + found.get("id", "")).lower().split():
        pieces = re.split(r"[^a-z0-9]+", token)
        own = {x for x in pieces if x in BOILERPLATE_NAMES or x in LAYOUT_NAMES or x in HEADER_NAMES}
        if own and all(x in own or x in PART_WORDS or not x for x in pieces):
            names |= own
    return names


def _evidence(name: str, attrs: str, region: int) -> tuple[int, Named | None, int]:
    """(kind of boilerplate or 0, what names alone make of it, region) that a start tag gives to what it
    contains."""
    found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attrs)} if attrs.strip(" /") else {}
    role = found.get("role", "").lower()
    article = name == "article" or found.get("itemprop", "").lower() == "articlebody"
    kind, named = 0, None
    if name not in ("html", "body", "main"):
        if (name in ("form", "button", "dialog", "fieldset") or "hidden" in found
                or role in BOILERPLATE_ROLES or found.get("aria-hidden", "").lower() == "true"
                or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", "").lower())):
            kind = HARD
        elif name in BOILERPLATE_TAGS or not region and name == "header":
            kind = LAYOUT
        if kind < HARD and not article and (names := _names(found)):
            if names & BOILERPLATE_NAMES:
                named = Named(HARD, bool(names & COMMENT_NAMES))
            elif names & LAYOUT_NAMES or not region:
                named = Named(LAYOUT)
    if article:
        region = 2
    elif name == "main" or role == "main":
        region = max(region, 1)
    return kind, named, region


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order, with what markup tells of them."""
    blocks: list[Block] = []
    stack: list[tuple[str, int, int, Named | None]] = []      # (tag, boilerplate, region, named) of open elements
    numbers: list[int] = []                      # of the same elements
    opened: Counter[str] = Counter()             # how many of each tag are on it
    elements = 0
    text: list[str] = []
    links = link_chars = 0
    heading = False

    def flush():
        nonlocal link_chars
        line = " ".join("".join(text).split())
        if line:
            _, bad, region, named = stack[-1] if stack else NO_ELEMENT
            holder = next((n for n, e in zip(reversed(numbers), reversed(stack)) if e[0] not in TEXT_ELEMENTS), 0)
            blocks.append(Block(line, min(link_chars, len(line)), heading, bad, region, named, parent=holder,
                                size=len(line) + (0 if line.isascii() else 2 * len(DENSE.findall(line)))))
        text.clear()
        link_chars = 0

    def add(raw: str):
        nonlocal link_chars
        if raw:
            raw = entities.unescape(raw)
            text.append(raw)
            if links:
                link_chars += len(raw.strip())

    def push(name: str, bad: int, region: int, named: Named | None) -> None:
        nonlocal elements
        elements += 1
        numbers.append(elements)
        stack.append((name, bad, region, named))
        opened[name] += 1

    def within(outer: Named | None, named: Named) -> Named:
        named.outer, named.depth = outer, outer.depth + 1 if outer else 0
        return named

    def close(name: str) -> None:
        if not opened[name]:
            return
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == name:
                opened.subtract(t[0] for t in stack[i:])
                del stack[i:], numbers[i:]
                return
            if stack[i][0] in ("article", "main", "body") and name in ("p", "li", "div", "span"):
                return

    at = 0
    for m in TOKEN.finditer(page):
        add(page[at:m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name == "a":
            links = 0 if m["close"] else 1
        elif name == "br":
            text.append(" ")
        elif name in INLINE:
            if name == "span" and (m["attrs"] or m["close"]):      # inline boilerplate, such as marked adverts
                if m["close"]:
                    if opened["span"]:
                        flush()
                        close("span")
                else:
                    _, bad, region, named = stack[-1] if stack else NO_ELEMENT
                    own, by_name, _ = _evidence(name, m["attrs"], region)
                    if own or by_name:
                        flush()
                        if not own:
                            by_name.kind = HARD
                            named = within(named, by_name)
                        push("span", HARD if own else bad, region, named)
        else:
            flush()
            links = 0
            if m["close"]:
                heading = False
                close(name)
            else:
                # a paragraph or list item ends where the next block begins
                if stack and stack[-1][0] == "p":
                    close("p")
                if name == "li" and opened["li"]:
                    inner = next(t[0] for t in reversed(stack) if t[0] in ("li", "ul", "ol", "menu"))
                    if inner == "li":
                        close("li")
                heading = len(name) == 2 and name[0] == "h" and name[1].isdigit()
                if name not in VOID and not heading:
                    _, bad, region, named = stack[-1] if stack else NO_ELEMENT
                    own, by_name, region = _evidence(name, m["attrs"], region)
                    if name == "main":
                        bad, named = 0, None
                    elif name == "article":
                        bad, named = bad if bad == HARD else 0, named and within(named, Named(0))
                    push(name, max(bad, own), region, within(named, by_name) if by_name else named)
    add(page[at:])
    flush()
    return blocks


def first_pass(block: Block, region: int) -> str:
    """Label of a block by itself; ``region``: the kind of region in which a block needs less to be good."""
    if block.boilerplate:
        return "bad"
    marked = 0 < region <= block.region
    size = block.size
    density = block.link_chars / len(block.text)
    if density > MANY_LINKS and not block.heading:
        return "bad" if not marked or density > 0.8 and size < LONG else "near"
    if size < SHORT:
        return "short"
    if RIGHTS.match(block.text) and size < LONG and not marked:
        return "bad"
    stops = stop_share(block)
    if stops >= (FEW_STOP_WORDS if marked else MANY_STOP_WORDS):
        return "good" if size >= LONG or marked else "near"
    return "near" if marked or stops >= FEW_STOP_WORDS else "bad"


def stop_share(block: Block) -> float:
    """The share of a block's words that are stop words; many in a script that has none here. Counted once,
    however often a block is judged."""
    if block.stops is None:
        words = block.text.lower().split()
        block.stops = sum(w.strip(".,;:!?()\"'«»„“”") in STOP_WORDS for w in words) / len(words)
        if block.stops < FEW_STOP_WORDS:
            letters = sum(map(str.isalpha, block.text))
            if letters and 2 * len(LATIN.findall(block.text)) < letters:
                block.stops = MANY_STOP_WORDS
    return block.stops


def judge_language(blocks: list[Block]) -> None:
    """Where no block has stop words the language is none of theirs, and length and links decide."""
    texts = [b for b in blocks if not b.boilerplate and b.size >= SHORT and b.link_chars <= MANY_LINKS * len(b.text)]
    if texts and max(map(stop_share, texts)) < FEW_STOP_WORDS:
        for b in texts:
            b.stops = MANY_STOP_WORDS


def second_pass(blocks: list[Block], region: int) -> None:
    """Ambiguous blocks inherit from their nearest decided neighbours. Inside a marked article only
    blocks of the article are neighbours, and an article without a good block is good but for its
    bad ones."""
    inside = [b for b in blocks if not region or (b.region >= region and not b.boilerplate)]
    decided = [b.label if b.label in ("good", "bad") else "" for b in inside]
    before, last = [], ""
    for label in decided:
        last = label or last
        before.append(last)
    after, last = [""] * len(inside), ""
    for i in range(len(inside) - 1, -1, -1):
        last = decided[i] or last
        after[i] = last
    default = "good" if region else "bad"
    unknown = "good" not in decided
    # what stands together with good blocks in one element
    homes = {b.parent for b, label in zip(inside, decided) if label == "good"}
    for b, left, right in zip(inside, before, after):
        if b.label == "short":
            if b.heading:
                b.label = right or left or default
            elif not region and not b.link_chars and not b.boilerplate and b.parent in homes:
                b.label = "good"
            elif left == right or not left or not right:
                b.label = left or right or default
            else:
                # between good and bad: with the article if links do not speak against it
                b.label = "good" if region and not b.link_chars else "bad"
        elif b.label == "near":
            b.label = "bad" if left == right == "bad" and not unknown else "good"


def classify(blocks: list[Block], region: int) -> int:
    """Labels all blocks, those outside of ``region`` as if nothing were marked; characters found good."""
    for b in blocks:
        b.label = first_pass(b, region)
    short = [b for b in blocks if b.label == "short" and not b.link_chars]
    inside = [b for b in blocks if b.region >= region]
    second_pass(inside, region)
    if not region and not any(b.label == "good" for b in blocks):
        for b in short:
            b.label = "good"
    if region:
        second_pass([b for b in blocks if b.region < region], 0)
    return sum(len(b.text) for b in inside if b.label == "good")


def spare_wrappers(blocks: list[Block]) -> None:
    """Takes the names off elements that hold the larger share of the page's good text, and makes
    boilerplate of what the other names mark."""
    seen: set[Named] = set()
    for b in blocks:
        e = b.named
        while e and e not in seen:
            seen.add(e)
            e = e.outer
    if not seen:
        return
    elements = sorted(seen, key=lambda e: e.depth)
    region = max((b.region for b in blocks if not b.boilerplate), default=0)

    def mark(parts: list[Block], comments: bool) -> None:
        held: Counter[Named] = Counter()       # characters of good blocks in an element
        stands: Counter[Named] = Counter()     # blocks in it
        good = 0
        for b in parts:
            n = len(b.text) if first_pass(b, region) == "good" else 0
            good += n
            if b.named:
                held[b.named] += n
                stands[b.named] += 1
        for e in reversed(elements):
            if e.outer:
                held[e.outer] += held[e]
                stands[e.outer] += stands[e]
        for e in elements:
            e.marks = e.outer.marks if e.outer else 0
            if not e.kind:
                e.marks = e.marks if e.marks == HARD else 0
            elif e.comments == comments and (stands[e] < len(parts) if comments else 2 * held[e] <= good):
                e.marks = max(e.marks, e.kind)
        for b in blocks:
            if b.named:
                b.boilerplate = max(b.boilerplate, b.named.marks)

    # comments are no part of the text that the other names are held against, unless they are all of it
    said: set[Named] = set()
    for e in elements:
        if e.comments or e.outer in said:
            said.add(e)
    own = [b for b in blocks if not b.boilerplate]
    beside = [b for b in own if b.named not in said]
    mark(beside if any(first_pass(b, region) == "good" for b in beside) else own, False)
    mark([b for b in blocks if not b.boilerplate], True)


def main_text(page: str | None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    blocks = blocks_of(page)
    judge_language(blocks)
    spare_wrappers(blocks)
    # the innermost kind of region that holds at least half of the good text; 0 is the whole page
    for region in sorted({b.region for b in blocks if not b.boilerplate} | {0}, reverse=True):
        good = classify(blocks, region)
        if good and 2 * good >= sum(len(b.text) for b in blocks if b.label == "good"):
            break
    return "\n\n".join(b.text for b in blocks if b.label == "good" and b.region >= region)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` as the struct ``row`` with ``text`` and ``n_chars`` (code points)."""
    def texts(pages: pd.Series) -> pd.DataFrame:
        out = [main_text(p) for p in pages]
        return pd.DataFrame({"text": out, "n_chars": [len(t) for t in out]})

    # annotations are texts in this module: the kind of function is named instead
    texts.__annotations__ = {"pages": pd.Series, "return": pd.DataFrame}
    texts = F.pandas_udf(texts, "text string, n_chars long")
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns])
    return (pages.select(row.alias("row")).withColumn("t", texts(F.col(f"row.`{html_col}`").cast("string")))
            .select("row", "t.*"))


def query(spark, sf_dir):
    """op3: the main text of every page."""
    pages = pick(read(spark, sf_dir, "pages"), ["page_id", "url", "html"])
    return extract(pages).select(F.col("row.page_id").alias("page_id"), F.col("row.url").alias("url"), "text", "n_chars")
