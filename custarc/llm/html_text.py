"""Main text of web pages by two passes of block rules.

A page is read once into blocks: stretches of text between block-level tags. Scripts, styles, other
raw elements, comments and the head are no text.

First pass. Each block is judged on its own by its share of stop words, its length and its share of
linked characters; inside an article or main element a block needs no stop words, only few links. Short
blocks without links stay ambiguous. A page whose long blocks have hardly any stop words is in a language
that is not known here: then length and links alone decide.

Where a block stands comes before that: elements made for navigation, page header or footer, asides,
notices and forms are bad, and so is what is hidden. An article or main element leaves a menu, a page
header, an aside or a form, whatever its own class. Class and id words are a prior only:

* A name that says reader comments, advert or consent and nothing else marks a bad part.
* Any other name with a suspect word - also one of these beside further words, as in comments-open - is
  a doubt, which an article or main element inside it leaves. In an article a doubtful part is bad
  unless its blocks with few links are together long and rich in stop words. Outside, it is bad if
  the page has an article with text; without one, the longest such part counts if it holds more than
  the blocks free of doubt do. Then its blocks are judged like all others.

A form is a doubt too, as it may wrap a whole page. In an article the names of headings and the ids of
sections, which are anchors, mark nothing, except that a section's id can mark reader comments.

Second pass. Ambiguous blocks take the label of the nearest decided neighbours: where both sides
agree, that one; else the nearer side's; at equal distance the label of the block that follows, as
headings and captions lead into what they belong to.

Null html, or a page without good blocks, gives the empty text. Broken markup is read leniently: a
stray end tag is ignored, an end tag closes what is open inside it, an article or main element ends
an open menu, header or sidebar, an unclosed comment or script runs to the end.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINKED = 0.5  # from this share of linked characters a block is bad
SHORT, LONG = 70, 200  # code points
STOPS_LOW, STOPS_HIGH = 0.15, 0.3  # shares of words

# Frequent function words of the languages that are read.
STOP_WORDS = frozenset(
    """
    a about after all also an and are as at be been but by can for from had has have he her his i if in into is it
    its more no not of on one or other she so some than that the their them then there these they this to up was we
    were what when which who will with would you
    aber als am an auch auf aus bei bis das dass dem den der des die durch ein eine einem einen einer er es für hat
    ich im in ist mit nach nicht noch nur oder sein sich sie sind so über um und von vor war werden wie wird zu zum zur
    au aux avec ce ces cette comme dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou où par
    pas plus pour qu que qui sa se ses son sont sur un une vous
    al como con de del el ella en entre era es esta este fue ha la las lo los más me mi muy no o para pero por que se
    ser si sin sobre son su sus también un una y ya
    """.split()
)
# Elements by their part in a page.
RAW = frozenset("script style template textarea title noscript iframe svg math object video audio canvas select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    """
    address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section
    summary table tbody td tfoot th thead tr ul
    """.split()
)
BAD_TAGS = frozenset("head nav header footer aside form button menu dialog fieldset".split())
GOOD_TAGS = frozenset("article main".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
BAD_NAMES = frozenset(
    """
    ad ads adsense advert adverts advertisement advertising advertorial alert announcement aside banner bottombar
    breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright disclaimer discussion disqus
    footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification
    overlay pager pagination paywall popup promo promotion recommended related replies reply respond responses search
    share sharing sidebar signin signup skip social sponsor sponsored subscribe subscription tags toast toolbar topbar
    trending widget
    """.split()
)
READER_NAMES = frozenset("comment commentlist comments disqus replies reply respond responses".split())
# Not written for the article, however long.
FOREIGN_NAMES = READER_NAMES | frozenset(
    """
    ad ads adsense advert adverts advertisement advertising advertorial consent cookie cookies gdpr newsletter paywall
    popup promo promotion sponsor sponsored
    """.split()
)
# Words that say what kind of element it is, not what it holds.
PART_NAMES = frozenset(
    """
    area banner bar block bottom box column container content footer form group header inner item left list main modal
    notice outer panel popup right section slot text thread top unit widget wrap wrapper
    """.split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LAYOUT_NAMES = frozenset("has no with without".split())  # the name behind them says what a page has
GOOD_NAMES = frozenset("article content entry main post story".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>?|[^<]+|<""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'=<>`]+))?""")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class _Block:
    __slots__ = ("parts", "linked", "place", "heading", "doubt")

    def __init__(self, place: int, heading: bool, doubt: int = 0):
        self.parts: list[str] = []
        self.linked: list[str] = []
        self.place, self.heading, self.doubt = place, heading, doubt


def _attributes(text: str) -> dict[str, str]:
    """The first value of each attribute of a tag, by lower-case name."""
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), value.strip("\"'"))
    return found


def _is_hidden(of: dict[str, str]) -> bool:
    return "hidden" in of or of.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN.search(of.get("style", "")))


def _suspect(tag: str, of: dict[str, str], inside: int) -> tuple[set[str], bool]:
    """The suspect words of class and id, and whether a name says that a part is foreign to the article."""
    words_of = lambda name: [w.lower() for w in _NAME.findall(name)]
    names = [words_of(n) for n in of.get("class", "").split()]
    own = [words_of(n) for n in of.get("id", "").split()]
    if inside > 0 and tag in HEADINGS:
        return set(), False
    if inside > 0 and tag == "section":
        own = [n for n in own if not READER_NAMES.isdisjoint(n)]
    found, foreign = set(), False
    for words in names + own:
        suspect = {w for before, w in zip(["", *words], words) if w in BAD_NAMES and before not in LAYOUT_NAMES}
        found |= suspect
        foreign |= bool(suspect & FOREIGN_NAMES) and all(w in BAD_NAMES or w in PART_NAMES for w in words)
    return found, foreign


def _place(tag: str, attributes: str, inside: int, doubt: str) -> tuple[int, str]:
    """-1 in a part that is no main text, 1 in the article, 0 elsewhere; and what makes that
    doubtful: "form", "name" or nothing. From those of the part around it."""
    if inside < 0:
        return -1, ""
    of = _attributes(attributes)
    if _is_hidden(of):
        return -1, ""
    role = of.get("role", "").lower()
    if tag in GOOD_TAGS or role in ("main", "article"):
        # Single comments are articles too, and say so in a word.
        comment = any(n.lower() in READER_NAMES for n in f"{of.get('class', '')} {of.get('id', '')}".split())
        return (-1, "") if comment else (1, doubt if inside > 0 and doubt == "name" else "")
    form = tag == "form" or role == "form"
    if not form and (tag in BAD_TAGS and not (tag == "header" and inside > 0) or role in BAD_ROLES):
        return -1, ""
    if tag in ("body", "html"):
        return inside, doubt
    suspect, foreign = _suspect(tag, of, inside)
    if foreign:
        return -1, ""
    # An article may have a header of its own.
    if suspect - ({"header"} if inside > 0 else set()) - ({"form"} if form else set()):
        return inside, "name"
    named = {w.lower() for w in _NAME.findall(f"{of.get('class', '')} {of.get('id', '')}")}
    if tag in ("div", "section") and doubt != "name" and not GOOD_NAMES.isdisjoint(named):
        return 1, doubt
    return inside, doubt or ("form" if form else "")


def _may_hide(attributes: str) -> bool:
    low = attributes.lower()
    return "hidden" in low or "none" in low


def blocks_of(page: str) -> Iterator[_Block]:
    """The blocks of a page that hold text, in page order."""
    stack: list[tuple[str, int, str, int]] = []
    links = doubts = 0
    unseen: list[str] = []  # open inline elements of a hidden one, itself included
    block = _Block(0, False)
    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.match(page, at)
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            text = m[0]
            if (text[0] != "<" or text == "<") and not unseen:
                (block.linked if links else block.parts).append(text)
                if links:
                    block.parts.append(text)
            continue
        tag, closing, attributes = tag.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag in RAW and not closing:
            if not attributes.endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                at = close.end() if close else end
            block.parts.append(" ")
            continue
        if tag == "a":
            links = 0 if closing else 1
        if tag == "br":
            block.parts.append(" ")
        if tag not in BLOCK:
            if closing and unseen and tag in unseen:
                while unseen.pop() != tag:
                    pass
            elif not closing and tag not in VOID and (unseen or _may_hide(attributes) and _is_hidden(_attributes(attributes))):
                unseen.append(tag)
            continue
        if closing:
            unseen = []  # left open
        if block.parts:
            yield block
        links = 0
        if closing:
            if any(t == tag for t, *_ in stack):
                while stack.pop()[0] != tag:
                    pass
        elif tag not in VOID:
            if tag in GOOD_TAGS:
                while stack and stack[-1][1] < 0 and any(t in ("head", "nav", "header", "aside", "menu") for t, *_ in stack):
                    stack.pop()
            if tag == "p" and stack and stack[-1][0] == "p":
                stack.pop()
            _, inside, doubt, number = stack[-1] if stack else ("", 0, "", 0)
            place = _place(tag, attributes, inside, doubt)
            if not place[1]:
                number = 0
            elif place != (inside, doubt):
                number = doubts = doubts + 1
            stack.append((tag, *place, number))
        _, place, _, number = stack[-1] if stack else ("", 0, "", 0)
        block = _Block(place, tag in HEADINGS and not closing, number)
    if block.parts:
        yield block


def _clean(parts: list[str]) -> str:
    return " ".join(html.unescape("".join(parts)).split())


def _linked(block: _Block, text: str) -> float:
    return len(_clean(block.linked)) / len(text) if block.linked else 0.0


def _stops(text: str) -> float:
    words = text.lower().split()
    return sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words) / len(words)


def _richness(found: list[tuple[_Block, str]]):
    """The share of stop words of a text; 1 for every text of a page in an unknown language."""
    long = " ".join(t for b, t in found if b.place >= 0 and len(t) >= SHORT and _linked(b, t) < LINKED)
    if long and _stops(long) < STOPS_LOW / 3:
        return lambda text: 1.0
    return _stops


def kept_doubts(found: list[tuple[_Block, str]], rich) -> set[int]:
    """The doubtful parts that hold main text after all."""
    texts: dict[int, list[str]] = {}
    inside: set[int] = set()
    sure, article = 0, False
    for block, text in found:
        if block.place < 0:
            continue
        few_links = _linked(block, text) < LINKED
        if block.doubt and few_links:
            texts.setdefault(block.doubt, []).append(text)
            if block.place > 0:
                inside.add(block.doubt)
        elif not block.doubt and judged(block, text, rich) == 1:
            sure += len(text)
            article |= block.place > 0
    whole = {k: " ".join(t) for k, t in texts.items()}
    possible = {k for k, t in whole.items() if len(t) >= LONG and rich(t) >= STOPS_HIGH}
    kept = possible & inside
    if not article and not kept:
        for k in sorted(possible, key=lambda k: len(whole[k]), reverse=True)[:1]:
            if len(whole[k]) > sure:
                kept.add(k)
    return kept


def judged(block: _Block, text: str, rich=_stops) -> int | None:
    """1 good, -1 bad, None ambiguous."""
    if block.place < 0:
        return -1
    links = _linked(block, text)
    if links >= LINKED:
        return -1
    if block.place > 0:
        return 1 if len(text) >= SHORT or not links else None
    if len(text) < SHORT:
        return None if not links else -1
    stops = rich(text)
    if stops >= STOPS_HIGH:
        return 1 if len(text) >= LONG else None
    return None if stops >= STOPS_LOW else -1


def main_text(page: str | None) -> str:
    found = [(b, t) for b in blocks_of(page or "") if (t := _clean(b.parts))]
    # Inside an article stop words don't matter unless there is a doubt.
    rich = _richness(found) if any(b.place == 0 or b.doubt for b, t in found) else _stops
    sure = kept_doubts(found, rich) if any(b.doubt for b, _ in found) else set()
    labels = [judged(b, t, rich) if not b.doubt or b.doubt in sure else -1 for b, t in found]
    before, last = [], None
    for k, label in enumerate(labels):
        last = k if label is not None else last
        before.append(last)
    after, last = [None] * len(labels), None
    for k in range(len(labels) - 1, -1, -1):
        last = k if labels[k] is not None else last
        after[k] = last
    kept = []
    for k, ((_, text), label) in enumerate(zip(found, labels)):
        if label is None:
            near = [(abs(k - j), side, labels[j]) for side, j in ((1, before[k]), (0, after[k])) if j is not None]
            label = min(near)[2] if near else 1
        if label > 0:
            kept.append(text)
    return "\n".join(kept)


@F.pandas_udf(T.StringType())
def _texts(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield batch.map(main_text, na_action=None).astype(object)


def extract(pages: DataFrame, markup: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the column ``out``, the main text, in place of the markup."""
    kept = [c for c in pages.columns if c.lower() not in (markup.lower(), out.lower())]
    return pages.select(*kept, _texts(F.coalesce(F.col(markup), F.lit(""))).alias(out))
