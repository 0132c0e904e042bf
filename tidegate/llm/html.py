"""Main text of web pages: parser events, text-to-tag ratios, clustering.

The standard library's streaming parser deals a page into lines, one per block,
each with its text, its number of tags and the elements it lies in. A line's
ratio is its text, links aside, to its tags; markup is a feature of it: lines of
elements that the markup tells as no part of an article (nav, footer, forms and
the like) have none, nor have those whose classes or ids say so (adverts,
comments and the like), unless their ratios say more: an element that holds more
than half of the page's, and all of its articles, is no advert, whatever its
names, and what names it then tells nothing of others either. Ratios are smoothed with a Gaussian over neighbouring lines, and
lines above the threshold, a share of the smoothed ratios' deviation, are
content if a line of their cluster is above it by itself.

Clusters then choose regions. An article or main element that holds a cluster is
taken with all its lines, others are not. Without such elements, each cluster
extends over the lines of the element that holds it, but for lines of links
before the first content line or after the last. Within an article, names that
may as well be a section's (discussion, related, notice) are doubtful: a cluster
in it, and not a list of links, keeps the element.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import spread, table

SIGMA = 1.0
#: Content lines lie above this share of the smoothed ratios' standard deviation.
LAMBDA = 0.5

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table"
    " tbody textarea tfoot thead title tr ul".split()
)
#: Elements never part of an article.
_OUT = frozenset("head script style noscript template nav aside footer form button select textarea iframe object svg canvas dialog menu audio video map search".split())
_CLOSES_P = _BLOCK - {"button", "option", "optgroup", "body", "html", "head", "title", "caption", "tbody", "thead", "tfoot", "tr"}
_OUT_ROLES = frozenset("navigation banner complementary contentinfo search alert alertdialog dialog menu menubar toolbar status form".split())
_OUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense banner sponsor sponsored sponsors promo promotion sidebar menu menubar nav"
    " navbar navigation breadcrumb breadcrumbs header footer masthead cookie cookies consent gdpr notice notices notification alert popup modal overlay"
    " newsletter subscribe subscription signup login comment comments disqus replies respond discussion share sharing social related recommended toolbar"
    " widget pagination pager copyright skip hidden".split()
)
#: Words that tell wherever they stand in a name, and in an article too; the others do so first or last.
_OUT_ANYWHERE = frozenset("ad ads advert adverts advertisement advertising sponsored cookie cookies comment comments commentlist newsletter popup breadcrumb breadcrumbs".split())
#: Within an article these name its own head.
_HEADS = frozenset("header masthead".split())
_NOT = frozenset("has with no without is".split())
#: Names of the readers' talk, which may be longer than the article: only a heading of the first rank in it refutes these.
_TALK = frozenset("comment comments commentlist disqus replies respond discussion".split())
#: Words that say nothing of what an element holds. Within an article a name with two words beside these and _OUT_WORDS may be a section's.
_FRAME = frozenset(
    "area bar block body bottom box button class col column container content count field form group heading id inner item items label large left link links list main meta middle module new outer"
    " page panel post right row section slot small space span text title top unit view wrap wrapper".split()
)
_PARTS = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
#: Elements whose end tags may be left out, by what ends them; and what these items lie in.
_ITEMS = {"li": "li", "dt": "d", "dd": "d", "tr": "tr", "option": "option"}
_SCOPES = frozenset({*_ITEMS, "ul", "ol", "menu", "dl", "table", "select", "article", "main"})
_UNSEEN = re.compile(r"display\s*:\s*none", re.IGNORECASE)
_COMMENT_END, _COMMENT_CLOSE = re.compile("-?>"), re.compile("--!?>")
#: References to numbers that no character has.
_NO_CHARACTER = re.compile("&#(?:0*+[0-9]{8,}|[xX]0*+[0-9A-Fa-f]{7,});?")


def _named(names: str, inside: bool) -> tuple[bool, frozenset[str], bool]:
    """What an element's class and id names say: perhaps no part of an article; the names that say surely none; are some of talk. inside: it lies in one."""
    doubt, sure, talk = False, set(), False
    for name in names.split():
        parts = _PARTS.split(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower())
        if _NOT.isdisjoint(parts):
            anywhere = not _OUT_ANYWHERE.isdisjoint(parts)
            if anywhere and inside:
                others = sum(bool(p) and not p.isdigit() and p not in _OUT_WORDS and p not in _OUT_ANYWHERE and p not in _FRAME for p in parts)
                anywhere, doubt = others < 2, doubt or others >= 2
            ends = {p for p in (parts[0], parts[-1]) if p in _OUT_WORDS}
            if anywhere or (ends and not inside):
                sure.add(name)
                talk = talk or not _TALK.isdisjoint(parts)
            elif ends - _HEADS:
                doubt = True
    return doubt, frozenset(sure), talk


class _Named(NamedTuple):
    """An element that names say is no part of an article, by the number of the one around it."""

    around: int
    names: frozenset[str]
    talk: bool


class _Open(NamedTuple):
    """An open element, with what holds inside of it."""

    tag: str
    out: bool
    #: number of the innermost element that names tell; 0 is none
    named: int
    doubt: int
    region: int
    block: int
    link: bool
    #: where the innermost open block stands, and the innermost element of _SCOPES
    last_block: int
    last_scope: int


class _Line(NamedTuple):
    text: str
    tags: int
    linked: int
    out: bool
    #: in a heading of the first rank
    head: bool
    named: int
    #: numbers of the doubtful element and of the article or main that hold the line; 0 is none
    doubt: int
    region: int
    block: int


_PAGE = _Open("", False, 0, 0, 0, 0, False, -1, -1)


class _Lines(HTMLParser):
    """Gets a whole page at once: what is left open at its end ends there, and is no text.

    Elements know the innermost block and list item around them, and open
    elements are counted by tag, so that no tag looks through all the others.
    """

    CDATA_CONTENT_ELEMENTS = ("script", "style", "title", "textarea", "iframe", "xmp", "noembed", "noframes")

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[_Line] = []
        self.stack: list[_Open] = []
        self.open: Counter = Counter()
        self.top = _PAGE
        #: each block's parent, blocks in order of their start tags; block 0 is the page
        self.parents = [0]
        self.named = [_Named(0, frozenset(), False)]
        self.linked = self.regions = self.doubts = self.tags = 0
        self.parts: list[str] = []

    def _whole(self, k: int) -> int:
        return k if k >= 0 else len(self.rawdata)

    def parse_starttag(self, i: int) -> int:
        return self._whole(super().parse_starttag(i))

    def parse_endtag(self, i: int) -> int:
        return self._whole(super().parse_endtag(i))

    def parse_pi(self, i: int) -> int:
        return self._whole(super().parse_pi(i))

    def parse_html_declaration(self, i: int) -> int:
        return self._whole(self.rawdata.find(">", i + 2) + 1 or -1)

    def parse_comment(self, i: int, report: int = 1) -> int:
        m = _COMMENT_END.match(self.rawdata, i + 4) or _COMMENT_CLOSE.search(self.rawdata, i + 4)
        return m.end() if m else len(self.rawdata)

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            t = self.top
            self.lines.append(_Line(text, self.tags, min(self.linked, len(text)), t.out, self.open["h1"] > 0, t.named, t.doubt, t.region, t.block))
            self.tags = 0
        self.parts.clear()
        self.linked = 0

    def _pop(self, n: int) -> None:
        self._flush()
        for e in self.stack[n:]:
            self.open[e.tag] -= 1
        del self.stack[n:]
        self.top = self.stack[-1] if self.stack else _PAGE

    def _end_open(self, tag: str) -> None:
        """Ends what a start tag ends without an end tag: a paragraph, or an item of the same list."""
        t = self.top
        if tag in _CLOSES_P and t.last_block >= 0 and self.stack[t.last_block].tag == "p":
            self._pop(t.last_block)
        if tag in _ITEMS:
            at = self.top.last_scope
            while at >= 0 and (other := self.stack[at].tag) in _ITEMS:
                if _ITEMS[other] == _ITEMS[tag]:
                    self._pop(at)
                    break
                at = self.stack[at - 1].last_scope if at else -1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
            return
        if tag == "body":  # a head left open ends here
            self._pop(0)
        else:
            self._end_open(tag)
        if tag in _BLOCK:
            self._flush()
        elif tag in ("td", "th", "img", "input"):
            self.parts.append(" ")
        if tag in _VOID:
            return
        t, given = self.top, {k: v or "" for k, v in attrs}
        out, named, doubt, region = t.out, t.named, t.doubt, t.region
        if not out:
            out = (tag in _OUT) or (tag == "header" and not region) or given.get("role", "").lower() in _OUT_ROLES or "hidden" in given or bool(_UNSEEN.search(given.get("style", "")))
            if not out and tag not in ("html", "body") and ("class" in given or "id" in given):
                perhaps, sure, talk = _named(f"{given.get('class', '')} {given.get('id', '')}", bool(region))
                if sure:
                    self.named.append(_Named(named, sure, talk))
                    named = len(self.named) - 1
                elif perhaps and not doubt:
                    self.doubts += 1
                    doubt = self.doubts
        if not out and not region and (tag in ("article", "main") or given.get("role") in ("main", "article")):
            self.regions += 1
            region = self.regions
        if (out, named, doubt, region) != t[1:5]:
            self._flush()
        at, block = len(self.stack), t.block
        if tag in _BLOCK:
            self.parents.append(block)
            block = len(self.parents) - 1
        self.top = _Open(tag, out, named, doubt, region, block, t.link or (tag == "a" and "href" in given), at if tag in _BLOCK else t.last_block, at if tag in _SCOPES else t.last_scope)
        self.stack.append(self.top)
        self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # HTML knows no self-closing elements

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in _BLOCK:
            self._flush()
        if not self.open[tag]:
            return
        # all that is looked through is popped
        i = len(self.stack) - 1
        while self.stack[i].tag != tag:
            i -= 1
        below = self.stack[i - 1] if i else _PAGE
        if tag in _BLOCK or self.top[1:6] != below[1:6]:
            self._flush()
        for e in self.stack[i:]:
            self.open[e.tag] -= 1
        del self.stack[i:]
        self.top = below

    def handle_data(self, data: str) -> None:
        self.parts.append(data)
        if self.top.link:
            self.linked += len(" ".join(data.split()))


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing, renewed at the ends so that weights sum to 1."""
    r = max(1, math.ceil(3 * sigma))
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    return np.convolve(ratios, k, "full")[r:-r] / np.convolve(np.ones_like(ratios), k, "full")[r:-r]


def _extended(blocks: list[int], linked: list[bool], content: np.ndarray, parents: list[int]) -> list[int]:
    """The lines of all clusters and of the elements that hold them.

    A cluster's element is the innermost one with all its lines; that of a single
    block is its parent, so that a paragraph comes with those beside it.
    """
    last = list(range(len(parents)))
    for b in range(len(parents) - 1, 0, -1):
        last[parents[b]] = max(last[parents[b]], last[b])
    holders: set[int] = set()
    holder, single = -1, True
    for b, is_link, is_content in zip([*blocks, -1], [*linked, True], [*content, False], strict=True):
        if is_content and holder < 0:
            holder, single = b, True
        elif is_content:
            single = single and b == holder
            while not holder <= b <= last[holder]:
                holder = parents[holder]
        elif is_link and holder >= 0:
            holders.add(parents[holder] if single else holder)
            holder = -1
    owner = [-1] * len(parents)  # the outermost of the holders
    for b in range(len(parents)):
        above = owner[parents[b]] if b else -1
        owner[b] = above if above >= 0 else b if b in holders else -1
    ends: dict[int, tuple[int, int]] = {}
    for i in np.flatnonzero(content).tolist():
        o = owner[blocks[i]]
        ends[o] = (ends.get(o, (i, i))[0], i)
    return [i for i, b in enumerate(blocks) if (o := owner[b]) >= 0 and (not linked[i] or ends[o][0] <= i <= ends[o][1])]


def _ratio(x: _Line) -> float:
    return 0.0 if x.out else (len(x.text) - x.linked) / max(x.tags, 1)


def weighed(lines: list[_Line], named: list[_Named]) -> list[_Line]:
    """Lines, out if an element around them is so by a name that no ratios refute.

    Refuted are the names of an element with more than half of the page's ratios
    and all lines of its articles, and for talk the page's heading too.
    """
    if len(named) == 1:
        return lines
    mass, inside, heads = ([0.0] * len(named) for _ in range(3))
    for x in lines:
        if not x.out:
            mass[x.named] += _ratio(x)
            inside[x.named] += x.region > 0
            heads[x.named] += x.head
    for e in range(len(named) - 1, 0, -1):
        for sums in (mass, inside, heads):
            sums[named[e].around] += sums[e]
    refuted: set[str] = set()
    for e, (_, names, talk) in enumerate(named):
        if e and 2 * mass[e] > mass[0] and inside[e] == inside[0] and (heads[e] or not talk):
            refuted |= names
    out = [False] * len(named)
    for e, (around, names, _) in enumerate(named):
        out[e] = bool(e) and (out[around] or not names <= refuted)
    return [x._replace(out=x.out or out[x.named]) for x in lines]


def content_of(lines: list[_Line]) -> np.ndarray:
    """Which lines belong to clusters of content."""
    ratios = np.array([*map(_ratio, lines)])
    smooth = smoothed(ratios)
    least = LAMBDA * smooth.std()
    above = (smooth > least) & np.array([not x.out for x in lines])
    # a cluster: lines above in one region without one below; it needs one that is above unaided
    region = np.array([x.region for x in lines])
    cluster = np.cumsum(np.concatenate(([True], ~above[1:] | ~above[:-1] | (region[1:] != region[:-1]))))
    return above & np.isin(cluster, cluster[above & (ratios > least)])


def main_text(html: str | None) -> str:
    """The page's main text, its blocks joined by an empty line; "" if it has none.

    Any string is a page: broken markup, and what the page's end cuts off, is
    skipped as browsers do. Time is linear in the page's length.
    """
    if not html:
        return ""
    p = _Lines()
    p.feed(_NO_CHARACTER.sub("\ufffd", html))
    p.close()
    p._flush()
    if not p.lines:
        return ""
    p.lines = weighed(p.lines, p.named)
    content = content_of(p.lines)
    linked, size = Counter(), Counter()
    for x in p.lines:
        linked[x.doubt] += x.linked
        size[x.doubt] += len(x.text)
    sure = {0} | {x.doubt for x, c in zip(p.lines, content, strict=True) if c and 2 * linked[x.doubt] <= size[x.doubt]}
    here = [i for i, x in enumerate(p.lines) if not x.out and x.doubt in sure]
    lines = [p.lines[i] for i in here]
    content = content[here]
    regions = {x.region for x, c in zip(lines, content, strict=True) if c and x.region}
    if regions:
        return "\n\n".join(x.text for x in lines if x.region in regions)
    if not content.any():
        return ""
    return "\n\n".join(lines[i].text for i in _extended([x.block for x in lines], [2 * x.linked > len(x.text) for x in lines], content, p.parents))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h.as_py()) for h in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row: page_id, url, text, n_chars (code points).

    Null and empty pages, and pages without main text, have an empty text.
    Repeated rows are repeated; extra columns aren't read; an empty table gives
    an empty one. Pages are handled one at a time, whole.
    """
    kinds = pages.schema
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return spread(src).mapInArrow(
        _extract, f"page_id {kinds[id_col].dataType.simpleString()}, url {kinds[url_col].dataType.simpleString()}, text string, n_chars long"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


ORACLE = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS x FROM pages),
b AS (SELECT page_id, url, unnest(string_split_regex(x, '</?(?:p|h1)>')) AS t, generate_subscripts(string_split_regex(x, '</?(?:p|h1)>'), 1) AS i FROM a),
c AS (SELECT page_id, url, i, regexp_replace(regexp_replace(t, '<br>', ' ', 'g'), '<[^>]*>', '', 'g') AS t FROM b),
d AS (SELECT page_id, url, i, trim(regexp_replace(replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;', '&'), '\s+', ' ', 'g')) AS t FROM c)
SELECT page_id, url, coalesce(string_agg(t, chr(10) || chr(10) ORDER BY i) FILTER (WHERE t <> ''), '') AS text, length(coalesce(string_agg(t, chr(10) || chr(10) ORDER BY i) FILTER (WHERE t <> ''), ''))::BIGINT AS n_chars
FROM d GROUP BY page_id, url
"""
