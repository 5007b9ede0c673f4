"""Main text of web pages by consensus paths of their host.

1. Each page's containers (article, main, section, div, td, ...) are scored by the
   text they hold outside boilerplate and links; a container's path is the tags
   and classes from the root down, with runs of digits generalised to "#".
2. Each page votes for the path of its best container; Spark counts the votes per
   host and path. A host's paths are those with at least two votes and LEAST_SHARE
   of its pages, so a host may have as many layouts as it has.
3. Each page is extracted again: of its host's paths the one with the highest score
   on the page, if that is at least COMPARABLE of the page's best; else (a layout
   of few pages) the page's own best container.

Text is what the container holds without menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments, told by tag, role, visibility,
class and id words, and without what browsers do not show (closed dialogs, the replacement
text of canvas and object, annotations of formulas). A class or id that names a state or a
subject (category-social, comments-open) says nothing, nor does one on a heading. An element that a class or id calls
boilerplate in plain words ("page-footer") is kept, with a lower score, if another one calls it content, or if it holds
most of the page's text outside links; only reader comments and consent notices go whatever
their length. Beside words that may be a subject ("related-work", "article-header") it goes only
if links prevail in its text. Character references are decoded, white space
inside a block becomes one space, blocks are joined by one line break; inline elements, shown or
not, never end a block. Markup
need not be well formed: open paragraphs, missing end tags, stray quotes and cut-off pages are
read as browsers do in these respects. Time and memory are linear in a page's length: paths are kept
as parts and hashes, sums go up from the leaves once, and nesting ends at ``MAX_DEPTH``.

Votes are combined map-side before they meet by (host, path), so a host with a
third of all pages is no hot task. The hosts' paths are broadcast if their
measured size is small, else joined by host, where Spark splits skewed partitions.

Defined results: null or empty html gives an empty text; a page without any
container gives the text of its body; a null url counts as one host;
repeated pages vote and are extracted each; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, pick, slices, stored, table

#: Share of a host's votes that makes a path one of the host's. It bounds the list that travels with a page
#: (1 / LEAST_SHARE paths); pages of rarer layouts use their own best container.
LEAST_SHARE = 0.02
#: Share of a page's best score from which one of its host's paths is preferred to the page's own best.
COMPARABLE = 0.25

# comments, tags, other declarations; each form also ends with the page, so that nothing is read twice. In a tag a quote counts after "=" only.
_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(>|\Z)"
                    r"|<(?:[!?]|/(?=[^a-zA-Z]))[^>]*+(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_RAW_END = {}
_DIGITS = re.compile(r"\d+")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")

_set = lambda s: frozenset(s.split())
VOID = _set("area base br col embed hr img input link meta param source track wbr")
RAW = _set("script style textarea title noscript iframe xmp noembed noframes")
CONTAINERS = _set("html body article main section div td li dd blockquote center table tbody tr ul ol dl")
BLOCKS = CONTAINERS | _set("p h1 h2 h3 h4 h5 h6 pre address figure figcaption details summary dt th thead tfoot"
                           " caption hr fieldset legend header footer nav aside form hgroup dialog menu")
DROPPED = _set("head script style noscript iframe template svg annotation annotation-xml canvas object nav header footer aside form"
               " button select textarea input label menu title")
ROLES = _set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar"
             " toolbar tablist status")
BOILERPLATE = _set("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie"
                   " cookies consent gdpr notice notification alert newsletter subscribe subscription signup login share"
                   " sharing social related recommended recommendations sidebar sidenav menu nav navbar navigation"
                   " breadcrumb breadcrumbs masthead header footer comment comments disqus replies respond widget"
                   " widgets popup modal overlay pagination pager toolbar skip copyright commentlist adsbygoogle")
#: Boilerplate that may be longer than the article.
REMARKS = _set("comment comments commentlist disqus replies respond cookie cookies consent gdpr")
#: Words that say where or how something stands, not what it is; beside boilerplate words they leave no doubt.
NEUTRAL = _set("main page layout wrapper wrap container site top bottom left right primary secondary global box bar block area section"
               " list lists item items inner outer button buttons icon icons link links posts articles form panel row col column module"
               " sticky fixed floating mobile desktop holder group bg full width s m l x y js the a of to")
HEADINGS = _set("h1 h2 h3 h4 h5 h6")
#: Open elements at most; start tags beyond that open none (browsers flatten deeper pages, too).
MAX_DEPTH = 512
#: Content words in a container's tag, class or id raise its score, general page parts lower it.
CONTENT = _set("article content entry post story text body main")
#: Class names of a state or a subject: their words do not tell what the element holds.
_STATE = re.compile(r"(?:has|with|no|without|hide|show)[-_].+|.+[-_](?:has|with|no|without)[-_].+|(?:category|categories|cat|tag|tax|taxonomy|term|topic|format|type|status|is|supports?)[-_].+"
                    r"|.+[-_](?:open|opened|closed|enabled|disabled|allowed|active|inactive|on|off|true|false)", re.I)
#: Factor on the score of a container that is called boilerplate but kept.
DOUBTFUL = 0.5
WEIGHT = {"article": 2.0, "main": 1.5, "html": 0.4, "body": 0.5}
#: Start tags that end an open element of the listed kinds (their end tags may be left out).
CLOSES = {"li": _set("li"), "dt": _set("dt dd"), "dd": _set("dt dd"), "tr": _set("tr td th"), "td": _set("td th"),
          "th": _set("td th"), "option": _set("option")}
SCOPE = _set("ul ol dl table tr td th div section article main body html blockquote form aside nav header footer")


def attributes(raw: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(raw):
        found.setdefault(name.lower(), html.unescape(a or b or c))
    return found


def words(value: str) -> set[str]:
    return {w.lower() for w in _WORDS.findall(value)}


def is_boilerplate(tag: str, attrs: dict[str, str]) -> bool:
    """Whether an element goes whatever it holds."""
    if tag in DROPPED or tag == "dialog" and "open" not in attrs:
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    if ("hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role", "").lower() in ROLES
            or re.search(r"display:none|visibility:hidden", attrs.get("style", "").replace(" ", "").lower())):
        return True
    return False


def called(tag: str, attrs: dict[str, str]) -> tuple[int, bool, bool]:
    """What an element's classes and id say: whether they call it boilerplate (DROP: in plain words; DOUBT: beside words that could
    be a subject, as in "related-work"; else 0), whether in REMARKS, and whether another one calls it content."""
    boilerplate, remarks, content = 0, False, False
    if tag not in ("html", "body", "article", "main") and tag not in HEADINGS:
        for name in [*attrs.get("class", "").split(), attrs.get("id", "")]:
            if _STATE.fullmatch(name):
                continue
            own = {w for w in words(name) if not w.isdigit()}
            if own & BOILERPLATE:
                plain = own <= BOILERPLATE | NEUTRAL or own & REMARKS and own <= BOILERPLATE | NEUTRAL | CONTENT
                boilerplate = DROP if plain or boilerplate == DROP else DOUBT
                remarks |= bool(plain and own & REMARKS)
            elif own & CONTENT:
                content = True
    return boilerplate, remarks, content


DROP, DOUBT = 1, 2


class Container:
    __slots__ = ("part", "key", "weight", "parent", "direct", "deeper", "first", "last")

    def __init__(self, part: str, weight: float, parent: Container | None, first: int):
        self.part, self.weight, self.parent, self.first, self.last = part, weight, parent, first, first
        self.direct = self.deeper = 0.0
        if parent is None:
            self.key = blake2b(part.encode("utf-8", "replace"), digest_size=16)
        else:
            self.key = parent.key.copy()
            self.key.update(f"/{part}".encode("utf-8", "replace") if parent.part else part.encode("utf-8", "replace"))

    @property
    def path(self) -> str:
        """The parts from the root down; ``key`` hashes the same string, so that no page holds a string for each container."""
        parts, at = [], self
        while at is not None:
            parts.append(at.part)
            at = at.parent
        return "/".join(filter(None, reversed(parts)))


def path_key(path: str) -> bytes:
    return blake2b(path.encode("utf-8", "replace"), digest_size=16).digest()


class Page:
    """The blocks of text of a page outside boilerplate, and its containers as ranges of blocks."""

    def __init__(self, source: str):
        self._parse(source, frozenset())
        if self._doubtful:
            whole = self._unlinked
            # what plain words call boilerplate needs most of the page's text to stay; beside other words links must prevail to let it go
            if kept := frozenset(n for n, how, held, linked in self._doubtful
                                 if 2 * held > whole or how == DOUBT and held > linked):
                self._parse(source, kept)

    def _parse(self, source: str, kept: frozenset[int]) -> None:
        """Read the page; ``kept``: the numbers of the start tags that are kept though called boilerplate."""
        self._kept, self._number = kept, 0
        #: elements called boilerplate: (number of the start tag, DROP or DOUBT, characters outside links, in links)
        self._doubtful: list[tuple[int, int, int, int]] = []
        #: characters outside and in links so far, those in certain boilerplate left out; open elements of the latter
        self._unlinked, self._inlinks, self._certain = 0, 0, 0
        self.blocks: list[str] = []
        self.containers: list[Container] = []
        self._held: list[str] = []
        self._linked = 0
        #: open elements: (tag, container or None, whether it is dropped: certain, doubtful or 0, start tag's number, what called() said, characters
        #: outside and in links before)
        self._open: list[tuple[str, Container | None, int, int, int, int, int]] = []
        self._tags: Counter = Counter()
        self._root = Container("", 0.1, None, 0)
        self._inside, self._dropped, self._links = self._root, 0, 0
        self.containers.append(self._root)
        self._read(source)

    def _read(self, source: str) -> None:
        at, n = 0, len(source)
        while at < n:
            m = _TOKEN.search(source, at)
            if m is None:
                self._text(source[at:])
                break
            if m.start() > at:
                self._text(source[at:m.start()])
            at = m.end()
            tag = m.group(2)
            if tag is None:
                continue
            tag = tag.lower()
            if m.group(1):
                self._end(tag)
                continue
            self._start(tag, m.group(3) or "")
            if tag in RAW:
                if tag not in _RAW_END:
                    _RAW_END[tag] = re.compile(rf"</{tag}(?=[\s/>])", re.I)
                end = _RAW_END[tag].search(source, at)
                if end is None:
                    break
                at = end.start()
        while self._open:
            self._pop()
        self._flush()
        self._root.last = len(self.blocks)
        for c in reversed(self.containers[1:]):  # from the leaves up
            c.parent.deeper += c.direct + c.deeper

    def _text(self, raw: str) -> None:
        if not self._certain and not raw.isspace():
            if self._links:
                self._inlinks += len(raw)
            else:
                self._unlinked += len(raw)
        if not self._dropped:
            text = html.unescape(raw) if "&" in raw else raw
            self._held.append(text)
            if self._links:
                self._linked += len(text)

    def _flush(self) -> None:
        """End the block that is being read."""
        if not self._held:
            return
        text = " ".join("".join(self._held).split())
        if text:
            self.blocks.append(text)
            self._inside.direct += max(0, len(text) - 2 * self._linked)
        self._held, self._linked = [], 0

    def _start(self, tag: str, raw: str) -> None:
        if tag == "br":
            if not self._dropped:
                self._held.append(" ")
            return
        if tag in BLOCKS:
            self._flush()
            self._close_open({"p"}, _set("table button") | {"article", "section", "div", "body"})
        if tag in CLOSES:
            self._close_open(CLOSES[tag], SCOPE - CLOSES[tag])
        if tag in VOID or tag in ("html", "body") and any(x[0] == tag for x in self._open):
            return
        self._number += 1
        if len(self._open) >= MAX_DEPTH:
            return
        attrs = attributes(raw) if raw.strip() else {}
        boilerplate, remarks, content = called(tag, attrs) if attrs else (0, False, False)
        own, drop = None, 0
        if is_boilerplate(tag, attrs) or remarks and not content:
            drop = DROP
        elif boilerplate and not content and self._number not in self._kept:
            drop = DOUBT
        if drop:
            self._dropped += 1
            self._certain += drop == DROP
        elif tag in CONTAINERS and not self._dropped:
            classes = sorted(_DIGITS.sub("#", c) for c in attrs.get("class", "").split())
            weight = WEIGHT.get(tag, 1.0)
            if weight == 1.0 and words(f"{attrs.get('class', '')} {attrs.get('id', '')}") & CONTENT:
                weight = 1.6
            if boilerplate:
                weight *= DOUBTFUL
            own = Container(".".join([tag, *classes]), weight, self._inside, len(self.blocks))
            self.containers.append(own)
            self._inside = own
        if tag == "a":
            self._links += 1
        self._open.append((tag, own, drop, self._number, boilerplate, self._unlinked, self._inlinks))
        self._tags[tag] += 1

    def _pop(self) -> None:
        tag, own, drop, number, boilerplate, unlinked, inlinks = self._open.pop()
        self._tags[tag] -= 1
        if own is not None or tag in BLOCKS:
            self._flush()
        if own is not None:
            own.last = len(self.blocks)
            self._inside = own.parent
        if drop:
            self._dropped -= 1
            self._certain -= drop == DROP
        if drop == DOUBT and not self._certain:
            self._doubtful.append((number, boilerplate, self._unlinked - unlinked, self._inlinks - inlinks))
        if tag == "a":
            self._links -= 1

    def _close_open(self, tags, stop) -> None:
        """Close the nearest open element of ``tags``, unless one of ``stop`` is nearer."""
        if not any(self._tags[t] > 0 for t in tags):
            return
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i][0] in tags:
                while len(self._open) > i:
                    self._pop()
                return
            if self._open[i][0] in stop:
                return

    def _end(self, tag: str) -> None:
        if tag in ("html", "body") or tag == "br":
            return
        # an inline end tag does not reach out of the container it stands in
        stop = frozenset() if tag in BLOCKS or tag in DROPPED else SCOPE
        self._close_open({tag}, stop)

    def scores(self) -> dict[bytes, tuple[float, Container]]:
        """The score of each path, by its key, with a container that has it."""
        found: dict[bytes, tuple[float, Container]] = {}
        for c in self.containers:
            score = c.weight * (c.direct + 0.6 * c.deeper)
            if score > 0 and c.last > c.first:
                key = c.key.digest()
                found[key] = (found[key][0] + score if key in found else score, c)
        return found

    @staticmethod
    def _top(own: dict[bytes, tuple[float, Container]]) -> bytes:
        most = max(score for score, _ in own.values())
        return max((k for k, (score, _) in own.items() if score == most), key=lambda k: own[k][1].path)

    def best(self) -> str | None:
        """The path with the highest score, or None if no container has any."""
        own = self.scores()
        return own[self._top(own)][1].path if own else None

    def text(self, paths: list[str]) -> str:
        """The blocks of all outermost containers with the best-scored of ``paths``, if it is comparable to the page's
        best path; else of that. On a page without any score (links only), of the first of ``paths`` that holds text."""
        own, keys = self.scores(), [path_key(p) for p in paths]
        if not own:
            return next(filter(None, map(self._of, keys)), "")
        best = self._top(own)
        listed = [k for k in keys if k in own and own[k][0] >= COMPARABLE * own[best][0]]
        return self._of(max(listed, key=lambda k: own[k][0], default=best))

    def _of(self, key: bytes) -> str:
        taken, done = [], 0
        for c in self.containers:
            if c.last > max(c.first, done) and c.key.digest() == key:
                taken += self.blocks[max(c.first, done):c.last]
                done = c.last
        return "\n".join(taken)


def host(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, votes): the pages of (host, html) whose best container has the path."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            for part in slices(b, "html"):
                out = {}
                for name, source in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    path = Page(source or "").best()
                    if path is not None:
                        out[name, path] = out.get((name, path), 0) + 1
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in out], pa.string()),
                                                  pa.array([k[1] for k in out], pa.string()),
                                                  pa.array(out.values(), pa.int64())], ["host", "path", "votes"])

    return (pages.select("host", "html").mapInArrow(run, "host string, path string, votes bigint")
            .groupBy("host", "path").agg(F.sum("votes").alias("votes")))


def host_paths(pages: DataFrame, least_share: float = LEAST_SHARE) -> DataFrame:
    """(host, paths): the paths of each host with at least two votes and ``least_share`` of all, most votes first;
    ties by path. A single vote is that of a page whose own best container it is anyway."""
    counted = stored(votes(pages), "host-votes")
    total = counted.groupBy("host").agg(F.sum("votes").alias("total"))
    listed = counted.where("votes >= 2").join(total, "host").where(F.col("votes") >= F.col("total") * F.lit(least_share))
    # at most 1 / least_share paths of each host
    return (listed.groupBy("host").agg(F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("v"), "path"))).alias("p"))
            .select("host", F.col("p.path").alias("paths")))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            least_share: float = LEAST_SHARE) -> DataFrame:
    """(page_id, url, text): the main text of every page."""
    src = pick(pages, page_id=id_col, url=url_col, html=html_col).withColumn("host", host(F.col("url")))
    paths = stored(host_paths(src, least_share), "host-paths")
    held = paths.agg(F.sum(F.octet_length(F.concat_ws("", "paths")) + 64 * F.size("paths") + 256)).first()[0] or 0
    kept = F.broadcast(paths) if held <= BROADCAST_BYTES else paths
    kind = src.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            for part in slices(b, "html"):
                texts = [Page(source or "").text(found or []) for source, found in
                         zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())],
                                                 ["page_id", "url", "text"])

    return (src.join(kept, "host", "left").select("page_id", "url", "html", "paths")
            .mapInArrow(run, f"page_id {kind}, url string, text string"))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("bigint"))
