"""Main text of web pages by paths that the pages of a host agree on.

1. In each page the containers (elements that hold text blocks) are scored by the amount of prose
   in them, less links, and named by their generalised path: tags with classes, digits and ids left out.
2. Votes, the sums of scores by host and path, are added up in Spark; the path with most votes wins
   its host. They are added per task first, so a host with a third of all pages is a few rows.
3. Each page's text is then taken from the containers at its host's winning path; a page without
   that path falls back to its own best container.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yardline.llm.text import map_batches, materialise

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*)|[^>])*+)>""",
    re.DOTALL,
)
_CLASS = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_UNSEEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
#: Elements whose content is never text.
RAW = frozenset("script style noscript template svg math iframe object canvas audio video head select textarea".split())
#: Elements around an article rather than in it.
OUTSIDE = frozenset("nav header footer aside form menu dialog button fieldset".split())
#: Of these, those that some pages put around everything.
WRAPPERS = frozenset(["form", "fieldset"])
#: Those whose content is no markup: it ends with their own end tag only.
VERBATIM = frozenset("script style textarea iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
#: Blocks that another start of the same kind closes.
CLOSED_BY = {
    "p": frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
                   "h5 h6 header hr main menu nav ol p pre section table ul".split()),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option", "optgroup"]),
}
_SCOPES = frozenset("ul ol dl table div section article main body".split())
#: Words in class, id or role that tell parts around an article.
NOISE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation "
    "menu menubar breadcrumb breadcrumbs header masthead footer sidebar side aside complementary contentinfo comment "
    "comments disqus reply replies respond cookie cookies consent gdpr notice popup modal overlay newsletter subscribe "
    "signup share sharing social related recommended recommendations widget toolbar pagination pager search login form "
    "skip hidden tags tagcloud alert disclaimer announcement adsbygoogle taboola outbrain".split()
)
#: Of these, those that tell an advert even on an element within a line.
ADVERTS = frozenset("ad ads advert adverts advertisement adsbygoogle sponsored".split())
#: First parts of class names that say what an element has or lacks, not what it is.
_SAYS_OF = frozenset("no not has have with without is show hide".split())
#: Largest share of a page's prose that an element of a noise tag or class may hold and still be left out; less where the
#: class only has the word as a part. Beyond it, the element is a wrapper around the page.
NOISE_SHARE, PART_SHARE = 0.85, 0.5
#: Elements that usually hold articles, with the weight of their votes.
FAVOURED = {"article": 3.0, "main": 2.0}
_FAVOURED_WORDS = frozenset("article content entry main post story body text".split())
_NO_HOLDER = frozenset("p h1 h2 h3 h4 h5 h6 li pre blockquote".split())
_SPACE = re.compile(r"\s+")
_WORDS = re.compile(r"[a-z]+")
#: Levels from which a path is named by a digest of its levels, so that names stay short at any depth.
_SPELLED = 40


def _names(attributes: str) -> tuple[str, frozenset[str], int]:
    """First class without digits, all words of class, id and role, and how surely they tell noise: 0, 1 or 2."""
    first, words, noise = "", [], 0
    for kind, *values in _CLASS.findall(attributes):
        value = next((v for v in values if v), "").lower()
        tokens = value.split()
        if kind.lower() == "class" and tokens:
            first = re.sub(r"\d+", "", tokens[0])
        for token in tokens:
            parts = _WORDS.findall(token)
            words += parts
            if token in NOISE:
                noise = 2
            elif parts and parts[0] not in _SAYS_OF and not NOISE.isdisjoint(parts):
                noise = max(noise, 1)
    return first, frozenset(words), noise


def _hidden(attributes: str) -> bool:
    """By attributes named so, not by what others say."""
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "").strip().lower()
        if name == "hidden" and value != "false" or name == "aria-hidden" and value == "true" or name == "style" and _UNSEEN.search(value):
            return True
    return False


class Page:
    """Text blocks of a page and the elements around them, read in one pass.

    Every step takes time and memory in proportion to the source, however deep or broken it is.
    """

    def __init__(self, source: str):
        #: (text, innermost element that is no inline one, characters of link text)
        self.blocks: list[tuple[str, int, int]] = []
        # Per element: the one around it, its tag and path, weight of its votes, how surely it is noise, whether nothing of it is text.
        self._parent, self._tag, self._path = [-1], [""], [""]
        self._favour, self._noise, self._cut = [1.0], [0], [False]
        self._depth = [0]
        #: Open elements; (element, the innermost that is no inline one).
        self._stack = [(0, 0)]
        #: Places in the stack of elements that others may close, and of those that end the search for them.
        self._marks: list[int] = []
        self._open: dict[str, int] = defaultdict(int)
        self._parts: list[str] = []
        self._linked = 0
        self._read(source)
        self._leave_out()

    # -- reading

    def _flush(self) -> None:
        if self._parts:
            text = _SPACE.sub(" ", html.unescape("".join(self._parts))).strip()
            if text:
                self.blocks.append((text, self._stack[-1][1], self._linked))
            self._parts, self._linked = [], 0

    def _pop(self, to: int) -> None:
        for node, _ in self._stack[to:]:
            self._open[self._tag[node]] -= 1
        del self._stack[to:]
        while self._marks and self._marks[-1] >= to:
            self._marks.pop()

    def _start(self, tag: str, attributes: str) -> None:
        if tag not in INLINE or tag == "br":
            self._flush()
            if tag == "body" and self._open["head"]:
                self._end("head")
            for k in reversed(self._marks):
                other = self._tag[self._stack[k][0]]
                if tag in CLOSED_BY.get(other, ()):
                    self._pop(k)
                    break
                if other in _SCOPES:
                    break
        if tag in VOID or attributes.rstrip().endswith("/") and tag not in ("p", "div", "a", "span"):
            return
        first, words, noise = _names(attributes) if "=" in attributes else ("", frozenset(), 0)
        above, holder = self._stack[-1]
        node, inline, around = len(self._tag), tag in INLINE, tag in ("html", "body")
        if inline:
            noise = 2 if words & ADVERTS and noise == 2 else 0
        elif not around:
            # The heading of an article is part of it, unlike the page's.
            heads = bool(words & _FAVOURED_WORDS) or self._open["article"] > 0
            if heads and words & NOISE == {"header"}:
                noise = 0
            if tag in ("article", "main") or words & {"article", "main"}:
                noise = 0
            if tag in OUTSIDE and not (tag == "header" and heads):
                noise = 2 if tag in WRAPPERS else 3
        self._parent.append(above)
        self._tag.append(tag)
        self._cut.append(self._cut[above] or not around and (tag in RAW or bool(attributes) and _hidden(attributes)))
        self._noise.append(0 if around else noise)
        self._favour.append(max(FAVOURED.get(tag, 1.0), 1.5 if words & _FAVOURED_WORDS and not around else 1.0))
        self._depth.append(self._depth[above] + (not inline))
        if inline:
            self._path.append(self._path[above])
        else:
            path = f"{self._path[above]}/{tag}.{first}" if first else f"{self._path[above]}/{tag}"
            self._path.append(path if self._depth[node] <= _SPELLED else "#" + hashlib.md5(path.encode()).hexdigest())
        if tag in CLOSED_BY or tag in _SCOPES:
            self._marks.append(len(self._stack))
        self._stack.append((node, holder if inline else node))
        self._open[tag] += 1

    def _end(self, tag: str) -> None:
        if tag not in INLINE:
            self._flush()
        if not self._open[tag]:
            return
        for k in range(len(self._stack) - 1, 0, -1):
            other = self._tag[self._stack[k][0]]
            if other == tag:
                self._pop(k)
                return
            if tag in INLINE and other not in INLINE:
                return

    def _text(self, data: str) -> None:
        if data and not self._cut[self._stack[-1][0]] and not (self._noise[self._stack[-1][0]] and self._tag[self._stack[-1][0]] in INLINE):
            self._parts.append(data)
            if self._open["a"]:
                self._linked += len(data)

    def _read(self, source: str) -> None:
        at, last = 0, source.rfind(">")  # what has no end after it is no tag
        while at <= last and (found := _TOKEN.search(source, at)):
            self._text(source[at : found.start()])
            at = found.end()
            tag = found[2]
            if tag is None:
                if found[0].startswith("<![CDATA["):
                    self._text(found[0][9:-3])
                continue
            tag = tag.lower()
            if found[1]:
                self._end(tag)
                continue
            self._start(tag, found[3])
            if tag in VERBATIM and not found[3].rstrip().endswith("/"):
                close = _closing(tag).search(source, at)
                at = close.end() if close else len(source)
                self._pop(len(self._stack) - 1)
        self._text(source[at:])
        self._flush()

    # -- choosing

    def _sums(self, values: list[float]) -> list[float]:
        """Of each element, the values of all elements in it, itself included."""
        total = values[:]
        for node in range(len(total) - 1, 0, -1):
            total[self._parent[node]] += total[node]
        return total

    def _leave_out(self) -> None:
        """Drop blocks in elements that are noise by tag or class, but for wrappers that hold most of the page.

        An element that is surely noise goes whatever it holds if the page has an article element with prose beside it.
        """
        count = len(self._tag)
        prose, praised = [0.0] * count, [0.0] * count
        for text, node, linked in self.blocks:
            prose[node] += max(len(text) - linked, 0)
        inside = self._sums(prose)
        for node in range(1, count):
            if self._favour[node] > 1 and self._noise[node] < 2 and inside[node] > 0 and self._tag[node] not in INLINE:
                praised[node] = 1.0
        held = self._sums(praised)
        whole, gone = max(inside[0], 1.0), [False] * count
        for node in range(1, count):
            sure = self._noise[node]
            share = inside[node] / whole
            gone[node] = gone[self._parent[node]] or self._tag[node] not in INLINE and (
                sure == 3 or sure == 2 and (share < NOISE_SHARE or not held[node] and held[0] > 0) or sure == 1 and share < PART_SHARE
            )
        self.blocks = [b for b in self.blocks if not gone[b[1]]]

    def scores(self) -> dict[str, float]:
        """Score of each container path: its prose weighed by nearness, favoured elements and links."""
        count = len(self._tag)
        value, titled = [0.0] * count, set()
        seen = [False] * count
        for text, node, linked in self.blocks:
            worth = len(text) - 1.5 * linked
            if len(text) < 25 and text[-1] not in ".!?…:;":
                worth *= 0.3  # headings and single words say little
            value[node] += worth
            if self._tag[node] == "h1":
                while node > 0 and not seen[node]:
                    seen[node] = True
                    titled.add(self._path[node])
                    node = self._parent[node]
        total: dict[str, float] = defaultdict(float)
        held = self._sums([float(v != 0) for v in value])
        for node in range(count - 1, 0, -1):
            if not held[node]:
                continue
            tag = self._tag[node]
            holder = tag not in INLINE and tag not in _NO_HOLDER
            if holder:
                total[self._path[node]] += value[node] * self._favour[node] * (1.3 if self._path[node] in titled else 1.0)
            # An inner container is better than what it lies in, as long as it holds as much.
            value[self._parent[node]] += value[node] * (0.9 if holder else 1.0)
        return total

    def text(self, path: str | None) -> str:
        """Blocks inside the containers of a path, in page order; of the page's best one if it has none."""
        found = self._inside(path) if path is not None else []
        if not found and self.blocks:
            scores = self.scores()
            best = min(scores, key=lambda p: (-scores[p], p)) if scores else None
            found = self.blocks if best is None else self._inside(best)
        return " ".join(text for text, _, _ in found)

    def _inside(self, path: str) -> list[tuple[str, int, int]]:
        within = [False] * len(self._tag)
        for node in range(1, len(within)):
            within[node] = within[self._parent[node]] or self._path[node] == path and self._tag[node] not in INLINE
        return [b for b in self.blocks if within[b[1]]]


@cache
def _closing(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}\s*>", re.I)


def votes(pages: DataFrame, *, url: str, source: str) -> DataFrame:
    """host, path, score: summed over the pages of each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: dict[tuple[str, str], float] = defaultdict(float)
            for host, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                scores = Page(text or "").scores()
                most = sum(len(p) for p in scores) and max(scores.values())
                for path, score in scores.items():
                    # Pages vote alike, whatever their length, and with most of their vote for their
                    # best path: a container around everything must not win as everyone's second choice.
                    if most > 0 and score > 0:
                        total[host, path] += (score / most) ** 4
            keys = list(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                 pa.array([round(total[k] * 1_000_000) for k in keys], pa.int64())],
                names=["host", "path", "score"],
            )

    return map_batches(pages.select(host_of(url), F.col(f"`{source}`").cast("string")), run, "host string, path string, score bigint")


def host_of(url: str) -> Column:
    """Lower-case host of an address; empty if there is none."""
    host = F.regexp_extract(F.lower(F.coalesce(F.col(f"`{url}`").cast("string"), F.lit(""))), r"^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)", 1)
    return F.regexp_replace(host, r"^.*@|:\d*$", "").alias("host")


def winning_paths(pages: DataFrame, *, url: str = "url", source: str = "html") -> DataFrame:
    """host, path: for each host the path with the largest sum of votes (of equal ones the first)."""
    sums = votes(pages, url=url, source=source).groupBy("host", "path").agg(F.sum("score").alias("score"))
    best = sums.groupBy("host").agg(F.min(F.struct((-F.col("score")).alias("s"), "path"))["path"].alias("path"))
    return best


def main_text(pages: DataFrame, *, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """Per row: key, url, text, n_chars and the host's winning path.

    A null or empty page gives an empty text; very long, deep and unclosed pages take time in proportion to their length; pages without host form one host; null keys and repeated
    rows stay as they are; empty tables give none; other columns are not read.
    Paths are written first, so that their size decides whether they are broadcast or shuffled.
    """
    paths = materialise(winning_paths(pages, url=url, source=source), "paths").withColumnRenamed("path", "__path")
    chosen = pages.select(F.col(f"`{key}`"), F.col(f"`{url}`"), F.col(f"`{source}`").cast("string").alias("__html"), host_of(url))
    joined = chosen.join(paths, "host", "left").select(f"`{key}`", f"`{url}`", "__path", "__html")
    kinds = [f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in (key, url)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                Page(source or "").text(path)
                for path, source in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), batch.column(2)],
                names=[key, url, "text", "n_chars", "path"],
            )

    return map_batches(joined, run, ", ".join([*kinds, "text string", "n_chars bigint", "path string"]))
