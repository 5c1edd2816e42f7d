"""Main text of web pages by two passes of block rules.

Pass one decides blocks by what surrounds them and by length, link density and stop-word density.
Pass two lets the undecided ones take the label of the nearest decided neighbours. A page is handled
on its own, so pages are spread over tasks as they are read; nothing is shuffled.
"""

from __future__ import annotations

import html as entities
import re
import sys
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import keeps_others, slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Frequent function words of the languages that the rules know.
STOP_WORDS = frozenset(
    """
    the and of to in is that it for was on with as be are by this from or an at
    der die das und zu den von mit ist im für auf des dem nicht ein eine als auch
    le la les de des et en un une que est pour dans qui pas sur au par avec
    el los las del y a en que un una por con no se su para es al lo como
    """.split()
)
# Elements that begin and end a block, elements without readable text, elements around the text.
BLOCK_TAGS = frozenset(
    """
    address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td
    tfoot th thead tr ul
    """.split()
)
RAW_TAGS = frozenset("script style noscript template textarea title iframe noframes noembed xmp".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CHROME_TAGS = frozenset("nav footer aside form menu dialog select option button svg canvas object audio video map head".split())
# Names in class, id and role that mark what is not the article.
CHROME_NAMES = frozenset(
    """
    ad ads adbox advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner teaser
    menu nav navbar navigation breadcrumb breadcrumbs pagination pager masthead topbar toolbar footer sidebar aside
    widget related recommended recommendations share sharing social cookie cookies consent gdpr notice notices
    notification alert popup modal overlay newsletter subscribe signup login search comment comments
    commentlist disqus respond reply replies discussion copyright complementary contentinfo
    """.split()
)
HEADER_NAMES = frozenset("header banner masthead".split())
REPLY_NAMES = frozenset("comment comments commentlist disqus respond reply replies discussion".split())
# Parts of a name that say what a page has, not what the element is; parts that only say what kind of box it is.
STATE_PARTS = frozenset("has have had no not non with without is are show shows hide hides enable enabled disable disabled open closed can".split())
BOX_PARTS = frozenset(
    """
    box boxes wrap wrapper wrapping container holder outer inner inside area block blocks section region zone slot unit
    list lists item items link links button buttons bar icon icons post posts article articles story stories form field
    panel text body content left right top bottom primary secondary default dark light fixed sticky widgets x px
    """.split()
)

MAX_LINKS = 0.33  # share of a block's characters inside links beyond which it is navigation
LENGTH_LOW, LENGTH_HIGH = 70, 200  # characters: a shorter block cannot decide, a longer one can
STOP_LOW, STOP_HIGH = 0.10, 0.25  # share of stop words: below it is no prose, beyond it is

# A quote opens a value only after "="; one that nothing closes up to the page's end is a sign like others.
_VALUE = r"\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]++)?+"
_TAG = re.compile(rf"<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:{_VALUE})?+)*+)>")
_TAG_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_NAMED = re.compile(r"[\s/]*+(?:[^\s/>][^\s/>=]*+(\s*+=\s*+)?)?")
_BARE = re.compile(r"[^\s>]*+")
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _attributes(said: str) -> dict[str, str]:
    """The attributes of a start tag by lower-case name; the first of a name counts."""
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(said):
        out.setdefault(name.lower(), a or b or c)
    return out


def _end_of_tag(page: str, at: int, lost: set[int]) -> int:
    """Where the ">" of a tag with its name before ``at`` stands; -1 if its values reach to the page's end.

    ``lost`` holds the quotes that are known to lead there. Each is followed once, so all the tags of
    a page take linear time together.
    """
    tried = []
    while True:
        m = _NAMED.match(page, at)
        at = m.end()
        if m.group(1):
            if at in lost:
                break
            end = page.find(page[at], at + 1) if page[at : at + 1] in ('"', "'") else -1
            if end >= 0:
                tried.append(at)
                at = end + 1
            else:
                at = _BARE.match(page, at).end()
        elif at >= len(page):
            break
        elif page[at] == ">":
            return at
    lost.update(tried)
    return -1


def _is_chrome(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in CHROME_TAGS or (tag == "header" and not in_article):
        return True
    if not attributes:
        return False
    for name, value in _attributes(attributes).items():
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "style":
            if _HIDDEN.search(value):
                return True
    return False


def _chrome_name(tag: str, attributes: str, in_article: bool) -> str | None:
    """What the names of an element call it, if that is chrome: a whole name, or what its last part says.

    Parts that only tell the kind of a box are left out before (sidebar-left, ad-box); a name that begins
    with a state (has-sidebar, no-sidebar, with-nav) is about the page.
    """
    if not attributes or tag in ("html", "body", "article", "main"):
        return None
    found = _attributes(attributes)
    for value in (found.get("class"), found.get("id"), found.get("role")):
        for name in (value or "").split():
            parts = [x.lower() for x in _NAME.findall(name)]
            if not parts or parts[0] in STATE_PARTS:
                continue
            while len(parts) > 1 and parts[-1] in BOX_PARTS:
                parts.pop()
            if parts[-1] in CHROME_NAMES or (not in_article and parts[-1] in HEADER_NAMES):
                return parts[-1]
    return None


class _Named:
    """An element that its name calls chrome, with the next such element (-1: none) and the article (0: none) around it."""

    __slots__ = ("around", "scope", "main", "reply")

    def __init__(self, around: int, scope: int, name: str):
        self.around, self.scope, self.main, self.reply = around, scope, False, name in REPLY_NAMES


class _Block:
    __slots__ = ("text", "links", "chrome", "scope", "heading", "named")

    def __init__(self, text: str, links: int, chrome: bool, scope: int, heading: bool, named: int):
        self.text, self.links, self.chrome, self.scope, self.heading, self.named = text, links, chrome, scope, heading, named


def blocks_of(page: str) -> list[_Block]:
    """The page's blocks of text in order, white space made single, references decoded."""
    out: list[_Block] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # open elements that matter: (tag, is chrome, is article, is chrome by name)
    called: list[_Named] = []
    named = -1  # the innermost open one of these
    homes: dict[int, int] = {}  # by scope, the innermost one around it
    parts: list[str] = []
    links = breaks = chrome = articles = scope = scopes = anchors = 0
    heading = False
    lost: set[int] | None = None  # set once a tag's values have reached to the page's end

    def flush() -> None:
        nonlocal links, breaks
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(_Block(text, links, chrome > 0, scope if articles else 0, heading, named))
            parts.clear()
        links = breaks = 0

    def close(at: int) -> None:
        nonlocal chrome, articles, named
        for _, is_chrome, is_article, _ in stack[at:]:
            chrome -= is_chrome
            articles -= is_article
        for x in reversed(stack[at:]):
            named = called[named].around if x[3] else named
        del stack[at:]

    def said(raw: str) -> None:
        nonlocal links, breaks
        text = entities.unescape(raw) if "&" in raw else raw
        if not text.isspace():
            breaks = 0
        parts.append(text)
        if anchors:
            links += len(" ".join(text.split()))

    at, size = 0, len(page)
    while at < size:
        next_tag = page.find("<", at)
        if next_tag < 0:
            said(page[at:])
            break
        if next_tag > at:
            said(page[at:next_tag])
        at = next_tag
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = end + 3 if end >= 0 else page.find(">", at) + 1 or size
            continue
        if page.startswith(("<!", "<?"), at):
            at = page.find(">", at) + 1 or size
            continue
        m = _TAG.match(page, at) if lost is None else None
        if m:
            attributes, at = m.group(3), m.end()
        else:
            m = _TAG_NAME.match(page, at)
            if not m:
                if page.startswith("</", at):
                    at = page.find(">", at) + 1 or size
                else:
                    said("<")
                    at += 1
                continue
            lost = set() if lost is None else lost
            end = _end_of_tag(page, m.end(), lost)
            if end < 0:  # no ">" but inside values: the tag ends at the first of these
                end = page.find(">", m.end())
                end = end if end >= 0 else size
            attributes, at = page[m.end() : end], min(end + 1, size)
        closing, tag = m.group(1), m.group(2).lower()
        if not closing and tag in RAW_TAGS:
            if tag not in ("noscript", "template"):
                end = re.compile(f"</{tag}\\b", re.I).search(page, at)
                at = (page.find(">", end.end()) + 1 or size) if end else size
                continue
        if tag == "br":
            breaks += 1
            if breaks >= 2:
                flush()
            else:
                parts.append(" ")
            continue
        if tag in BLOCK_TAGS:
            flush()
            heading = not closing and len(tag) == 2 and tag[0] == "h" and tag != "hr"
            anchors = 0  # a link never reaches past its block
        if tag == "a":
            anchors = 0 if closing else 1
        if tag in VOID_TAGS:
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    if tag in BLOCK_TAGS or all(x[0] not in BLOCK_TAGS for x in stack[k + 1 :]):
                        flush() if stack[k][1] or stack[k][3] else None
                        close(k)
                    break
            continue
        is_article = tag in ("article", "main")
        if is_article:
            # An article ends what was left open around it, unless it is a card in a side column.
            k = next((k for k, x in enumerate(stack) if (x[1] or x[3]) and x[0] in ("nav", "header", "form", "head", "ul", "li")), None)
            if k is not None:
                close(k)
            if not articles:
                scopes += 1
                scope = scopes
                homes[scope] = named
        if tag == "p":
            # A paragraph ends the one before; only containers are kept open.
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == "p"), None)
            if k is not None and all(x[0] not in BLOCK_TAGS for x in stack[k + 1 :]):
                close(k)
        if named >= 0 and tag == "main":
            called[named].main = True
        is_chrome = tag in ("noscript", "template") or _is_chrome(tag, attributes, articles > 0)
        name = None if is_chrome else _chrome_name(tag, attributes, articles > 0)
        if is_chrome or name:
            flush()
        if name:
            called.append(_Named(named, scope if articles else 0, name))
            named = len(called) - 1
        if is_chrome or name or is_article or tag in BLOCK_TAGS:
            stack.append((tag, is_chrome, is_article, bool(name)))
            chrome += is_chrome
            articles += is_article
    flush()
    _settle(out, called, homes)
    return out


def _settle(blocks: list[_Block], called: list[_Named], homes: dict[int, int]) -> None:
    """Mark the blocks in elements that are chrome by name, but for those that hold the page's text.

    An element is not what its name says if it holds main, the longest article of a page that has none
    elsewhere, or most of the page's prose. Beside an article the last is no reason; readers' replies
    may well be most of a page, so they are text only if nothing else is.
    """
    if not called:
        return
    stops = [_stops(b.text) for b in blocks]
    known = _knows(blocks, stops)
    plain = [0 if b.chrome or b.heading or b.links > MAX_LINKS * len(b.text) else len(b.text) for b in blocks]
    prose = [n if n >= LENGTH_LOW and (b.scope or not known or x >= STOP_LOW * w) else 0 for b, n, (x, w) in zip(blocks, plain, stops)]
    prose = prose if any(prose) else plain  # short lines only: all that are not links count
    total = sum(prose)
    own, articles = [0] * (len(called) + 1), Counter()  # the last of own is the prose in no named element
    for b, n in zip(blocks, prose):
        own[b.named] += n
        if b.scope and not b.chrome:
            articles[b.scope] += n
    inside = list(own)
    for k in range(len(called) - 1, -1, -1):
        inside[called[k].around] += inside[k]
        if called[k].around >= 0:
            called[called[k].around].main |= called[k].main
    holds = set()  # the named elements around the longest article
    if articles and all(homes[x] >= 0 for x in articles):
        k = homes[max(articles, key=lambda x: articles[x])]
        while k >= 0:
            holds.add(k)
            k = called[k].around
    around = {homes[x] for x in articles}
    article = -1 in around  # whether an article is found to be text
    good, others = {-1}, own[-1]  # others: the prose of what is found to hold text, without the named elements in it
    order = sorted(range(len(called)), key=lambda k: called[k].reply)
    for k in order + order:  # twice, for elements inside of replies
        c = called[k]
        if k not in good and c.around in good and (
            c.main or (k in holds and inside[k] > others) or (2 * inside[k] > total and not (c.reply and others) and (c.scope or not article))
        ):
            good.add(k)
            article |= k in around
            others += own[k]
    for b in blocks:
        b.chrome = b.chrome or b.named not in good


def _nearest(blocks: list[_Block], label: list[bool | None]) -> list[int | None]:
    """For each block, the last decided one before it that has a say.

    An article element is evidence of its own: what stands outside it, or is marked inside it as
    something else, has no say about its blocks.
    """
    last: dict[int, int] = {}
    out: list[int | None] = []
    for k, b in enumerate(blocks):
        out.append(last.get(b.scope))
        if label[k] is not None and not (b.scope and b.chrome):
            last[b.scope] = k
    return out


def _stops(text: str) -> tuple[int, int]:
    """The stop words and all the words of a text."""
    found = text.lower().split()
    return sum(w.strip(".,;:!?") in STOP_WORDS for w in found), len(found)


def _knows(blocks: list[_Block], stops: list[tuple[int, int]]) -> bool:
    """Whether the page is in a language of the stop words, as its blocks of some length say together."""
    fit = [x for b, x in zip(blocks, stops) if not (b.chrome or b.heading) and len(b.text) >= LENGTH_LOW and b.links <= MAX_LINKS * len(b.text)]
    return sum(x for x, _ in fit) >= STOP_LOW * sum(n for _, n in fit)


def _choose_by_length(blocks: list[_Block], label: list[bool | None]) -> None:
    """Decide text on a page where the rules have found none: long undecided blocks, in its articles if they have any.

    Where all are short, those are long that have half the length of the longest.
    """
    fit = [k for k, b in enumerate(blocks) if label[k] is None and not b.heading]
    fit = [k for k in fit if blocks[k].scope] or fit
    least = min(LENGTH_LOW, max((len(blocks[k].text) for k in fit), default=0) / 2)
    for k in fit:
        label[k] = len(blocks[k].text) >= least or None


def main_text(page: str | None) -> str:
    """The article's blocks joined by line feeds."""
    blocks = blocks_of(page or "")
    stops = [_stops(b.text) for b in blocks]
    known = _knows(blocks, stops)
    label: list[bool | None] = []
    for b, (found, n) in zip(blocks, stops):
        length, density, share = len(b.text), b.links / len(b.text), found / n
        if b.chrome or density > MAX_LINKS:
            label.append(False)
        elif length >= LENGTH_HIGH and share >= STOP_HIGH:
            label.append(True)
        elif b.scope or length < LENGTH_LOW or b.heading or share >= STOP_LOW or not known:
            label.append(None)  # short, or odd prose where prose is to be expected, or in a language without rules
        else:
            label.append(False)
    if True not in label:
        _choose_by_length(blocks, label)
    before, after = _nearest(blocks, label), _nearest(blocks[::-1], label[::-1])[::-1]
    keep: list[bool] = []
    for k, b in enumerate(blocks):
        near = [(abs(k - j), label[j]) for j in (before[k], None if after[k] is None else len(blocks) - 1 - after[k]) if j is not None]
        if label[k] is not None:
            keep.append(label[k])
        elif b.scope:
            keep.append(any(x for _, x in near) if near else True)
        elif b.heading:  # a heading belongs to what follows
            keep.append(after[k] is not None and near[-1][1])
        else:
            keep.append(bool(near) and min(near, key=lambda x: (x[0], not x[1]))[1])
    return "\n".join(b.text for b, good in zip(blocks, keep) if good)


@keeps_others("html")
def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """The pages with ``text`` in place of the html column, and ``n_chars``, its code points.

    A null or empty page has the text "". Nothing is capped: a long page is one row of its task.
    Repeated rows give equal rows; an empty table gives none; other columns are passed through, but
    for ones named ``text`` or ``n_chars``, which the result replaces.
    """
    given = [f for f in pages.schema.fields if f.name not in (html, "text", "n_chars")]
    schema = T.StructType([*given, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    names = [f.name for f in given]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_html"):
            texts = [main_text(x) for x in b.column("_html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(n) for n in names], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[*names, "text", "n_chars"],
            )

    read = pages.select(*[F.col(f"`{n}`") for n in names], F.col(f"`{html}`").cast("string").alias("_html"))
    return read.mapInArrow(run, schema)
