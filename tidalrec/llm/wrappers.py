"""Main text of pages through union-free wrappers of their hosts.

A page is read as a stream of slots: the text blocks in page order, each named
by the path of tags and classes it stands in and by a mark.  A host's wrapper is
a union-free regular expression over slots, inferred from its pages: runs of
equal groups inside a stream become repeated groups, and streams are aligned one
after the other, where a mismatch makes what only one side has optional.
Streams are made distinct per host first, so what is aligned is the host's page
forms, not its pages; they are aligned in groups of about ``WIDTH``, and the
groups' wrappers again, so a host of any size is never one task's work.

Every page is then matched against its host's wrapper, which gives each of its
texts a slot of the wrapper, and its text is what stands in the slots that hold
main text:

- slots in an article or main element, where the page has any;
- else the slots of the container that holds most of the host's varying text:
  the deepest element with ``SHARE`` of the characters of its different texts.
  Every block of the container stays, headings that are the same on all pages
  included; only before the first and behind the last varying slot are slots
  left out that hold links, or one text on more than half of the pages.

Slots in menus, headers, footers, sidebars, notices, adverts, forms and comments
never hold main text.  A class word tells such an element where it is the whole
name, its last part, or its first (``user-comments``, ``cookie-box``), not behind
``no-``, ``with-`` and the like; where it stands in the middle, or starts a name
that may as well be prose (``related-work``), the element is left out if its slot
holds mostly links over the whole host.  An element marked by a class word or a
form that encloses the page's only article or main element does not count.

Defined cases: null and empty html give an empty text; pages cut off anywhere
are read up to the cut; pages without a url form one host; rows that share an id
are read each by its own html, and equal pages of a host count once as evidence;
an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalrec.llm.common import Scratch, load
from tidalrec.operators.skew import lookup_join

#: HTML element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre
section summary table tbody td tfoot th thead title tr ul""".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
APART = frozenset("""head title nav menu header footer aside button select textarea fieldset dialog noscript
template iframe object svg math canvas audio video script style""".split())
APART_WORDS = frozenset("""ad ads advert adverts advertisement advertising adbox adsense banner sponsor sponsored promo
promoted promotion nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidenav footer header masthead
topbar toolbar cookie cookies consent gdpr notice notices notification alert disclaimer newsletter subscribe
subscription signup login register paywall share sharing social comment comments commentlist reply replies disqus
respond discussion related recommended recommendations popup modal overlay widget search pagination pager
complementary contentinfo tags foot copyright""".split())
COMMENT_WORDS = frozenset("comment comments commentlist reply replies disqus respond discussion".split())
UNSURE_FIRST = frozenset("related recommended search share sharing social tags".split())
STATES = frozenset("no not non without with has".split())
CONTENT = frozenset({"article", "main"})
CONTENT_NAMES = frozenset({"main", "main-content", "maincontent"})
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HOLDERS = frozenset("body center div main section td".split())   # elements that may hold bare text beside blocks

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|noscript|iframe|template|xmp)\b[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)", re.S | re.I)
_ATTR = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.I)


@dataclass(frozen=True)
class Slot:
    path: str        # tags and classes from the outside in
    text: str
    mark: str        # "!" in a menu, notice, form and the like; "=" in an article or main element; "~" links will tell
    linked: int      # characters inside links

    @property
    def name(self) -> str:
        return self.mark + (re.sub(r"[\s()]", "_", self.path) or "_")


@dataclass(frozen=True)
class _Open:
    tag: str = ""
    name: str = ""
    apart: bool = False      # whatever it encloses
    soft: bool = False       # unless it encloses the page's main text
    content: bool = False
    unsure: bool = False     # links will tell


def apart_word(name: str) -> str:
    """What a class, id or role says of its element: "!" apart, "!!" reader comments, "~" unsure, "" nothing."""
    parts = [x for x in re.split(r"[^a-z]+", name) if x]
    if not parts or APART_WORDS.isdisjoint(parts) or (len(parts) > 1 and parts[0] in STATES):
        return ""
    if parts[-1] in APART_WORDS or (parts[0] in APART_WORDS and parts[0] not in UNSURE_FIRST):
        return "!!" if parts[-1] in COMMENT_WORDS or parts[0] in COMMENT_WORDS else "!"
    return "~"


def slots(page: str) -> list[Slot]:
    """Text blocks of a page in order; character references decoded, white space single."""
    out: list[Slot] = []
    stack: list[_Open] = []
    parts: list[str] = []
    links = linked = 0

    def mark() -> str:
        top = stack[-1] if stack else _Open()
        if top.apart or (top.soft and not top.content):
            return "!"
        return "%" if top.soft else "~" * top.unsure + "=" * top.content

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append(Slot(">".join(s.name for s in stack if s.tag in BLOCK), text, mark(), linked))
            parts.clear()
        linked = 0

    def close(tags: set[str] | frozenset[str], within: frozenset[str]) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].tag in tags:
                del stack[i:]
                return
            if stack[i].tag in within:
                return

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            piece = page[at:m.start()]
            parts.append(piece)
            if links:
                linked += len(piece)
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        if tag in BLOCK:
            flush()
        elif tag == "br":
            parts.append(" ")
        if m["end"] or m["end2"]:
            if tag == "a":
                links = max(0, links - 1)
            if any(s.tag == tag for s in stack):
                close({tag}, frozenset())
            continue
        if tag in VOID:
            continue
        if tag == "a":
            links += 1
        if tag in CLOSES:
            close(CLOSES[tag], frozenset({"ul", "ol", "dl", "table", "div", "article", "section", "main"}))
        elif tag in BLOCK:
            close({"p"}, frozenset({"div", "td", "li", "article", "section", "main", "body"}))
        attrs = m["attrs"] or m["attrs2"] or ""
        said, names, name = set(), set(), tag
        if attrs:
            for key, *values in _ATTR.findall(attrs):
                value = sorted(next((x for x in values if x), "").lower().split())
                names.update(value)
                if key.lower() == "class":
                    name = f"{tag}.{'.'.join(value)}"
            if tag not in ("html", "body", "article", "main"):
                said = set(map(apart_word, names))
        up = stack[-1] if stack else _Open()
        soft = "!" in said or tag == "form"
        stack.append(_Open(
            tag, name,
            up.apart or (tag in APART and not (tag == "header" and up.content)) or "!!" in said
            or (soft and up.content) or bool(attrs and _HIDDEN.search(attrs)),
            up.soft or soft, up.content or tag in CONTENT or not names.isdisjoint(CONTENT_NAMES),
            up.unsure or "~" in said))
    if at < len(page):
        parts.append(page[at:])
    flush()
    other = "!" if any(s.mark in ("=", "~=") for s in out) else "="     # an article in an element marked apart
    return [replace(s, mark=other) if s.mark == "%" else s for s in out]


# -- wrappers: tuples of items; an item is (kind, body): "" one slot, "?" optional, "+" repeated, body a tuple or a path

Item = tuple


def fold(items: tuple[Item, ...]) -> tuple[Item, ...]:
    """Runs of equal groups of items become one repeated group, short groups first."""
    out = list(items)
    size = 0
    while 2 * (size := size + 1) <= len(out):
        number: dict[Item, int] = {}
        codes = np.array([number.setdefault(x, len(number)) for x in out])
        apart = np.flatnonzero(np.concatenate([[True], codes[size:] != codes[:-size], [True]]))
        if np.diff(apart).max() <= size:        # no run of ``size`` items that are equal to those a group on
            continue
        i, done = 0, []
        while i < len(out):
            group = out[i:i + size]
            n = 1
            while len(group) == size and out[i + n * size:i + (n + 1) * size] == group:
                n += 1
            if n > 1:
                done.append(group[0] if size == 1 and group[0][0] == "+" else ("+", tuple(group)))
                i += n * size
            else:
                done.append(out[i])
                i += 1
        out = done
    return tuple(out)


def _core(item: Item) -> object:
    """What an item stands for, whether or not it is optional or repeated."""
    while item[0] and len(item[1]) == 1:
        item = item[1][0]
    return item[1] if not item[0] else tuple(_core(x) for x in item[1])


def _merge(a: Item, b: Item) -> Item:
    """One item for two of the same core: repeated or optional if either is, and so are the items inside."""
    kinds, bodies = set(), []
    for x in (a, b):
        while x[0]:
            kinds.add(x[0])
            if len(x[1]) != 1:
                break
            x = x[1][0]
        bodies.append(x[1] if x[0] else (x,))
    body = bodies[0] if len(bodies[0]) == 1 else tuple(map(_merge, *bodies))
    out: Item = ("+", body) if "+" in kinds else body[0] if len(body) == 1 else ("?", body)
    return ("?", (out,)) if "?" in kinds and out[0] != "?" else out


def align(a: tuple[Item, ...], b: tuple[Item, ...]) -> tuple[Item, ...]:
    """The least general wrapper of both: a longest common subsequence, the rest optional."""
    if a == b:
        return a
    ca, cb = [_core(x) for x in a], [_core(x) for x in b]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if ca[i] == cb[j] else max(best[i + 1][j], best[i][j + 1])
    out: list[Item] = []
    i = j = 0

    def maybe(x: Item) -> Item:
        return x if x[0] == "?" else ("?", (x,))

    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and ca[i] == cb[j]:
            out.append(_merge(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == len(b) or (i < len(a) and best[i + 1][j] >= best[i][j + 1]):
            out.append(maybe(a[i]))
            i += 1
        else:
            out.append(maybe(b[j]))
            j += 1
    return fold(tuple(out))


def show(items: tuple[Item, ...]) -> str:
    """The wrapper as a regular expression over slot paths."""
    return " ".join(x[1] if not x[0] else f"({show(x[1])}){x[0]}" for x in items)


def parse(form: str) -> tuple[Item, ...]:
    """Inverse of ``show``."""
    stack: list[list[Item]] = [[]]
    for token in re.findall(r"\(|\)[?+]?|[^\s()]+", form):
        if token == "(":
            stack.append([])
        elif token[0] == ")":
            body = tuple(stack.pop())
            stack[-1].append((token[1:], body))
        else:
            stack[-1].append(("", token))
    return tuple(stack[0])


class Wrapper:
    """A wrapper as an automaton that names the wrapper's slot of each slot of a page."""

    def __init__(self, form: str):
        # nodes from the end to the start; a node has a slot name or several ways on; node 0 is the end
        self._name: list[str | None] = [None]
        self._next: list[list[int]] = [[]]
        self._entry = self._build(parse(form), 0)
        leaves = [i for i, name in enumerate(self._name) if name is not None]
        self._place = {i: len(leaves) - 1 - at for at, i in enumerate(leaves)}
        self.names = [self._name[i] for i in reversed(leaves)]      # by place, in page order
        self._reach: dict[int, frozenset[int]] = {}
        self._steps: dict[tuple[frozenset[int], str], tuple[list[int], frozenset[int]]] = {}

    def _node(self, name: str | None, *ways: int) -> int:
        self._name.append(name)
        self._next.append(list(ways))
        return len(self._name) - 1

    def _build(self, items: tuple[Item, ...], after: int) -> int:
        for kind, body in reversed(items):
            if kind == "?":
                after = self._node(None, self._build(body, after), after)
            elif kind == "+":
                again = self._node(None, after)
                after = self._build(body, again)
                self._next[again].insert(0, after)
            else:
                after = self._node(body, after) if isinstance(body, str) else self._build(body, after)
        return after

    def _from(self, node: int) -> frozenset[int]:
        """Slots, or the end, that may come next at a node."""
        if node not in self._reach:
            seen, todo = set(), [node]
            while todo:
                i = todo.pop()
                if i not in seen:
                    seen.add(i)
                    if self._name[i] is None:
                        todo += self._next[i]
            self._reach[node] = frozenset(i for i in seen if i == 0 or self._name[i] is not None)
        return self._reach[node]

    def match(self, names: list[str]) -> list[int] | None:
        """The place in the wrapper of every slot; None if the page is not of the wrapper."""
        if len(self._steps) > 20_000:
            self._steps.clear()
        state, hits = self._from(self._entry), []
        for name in names:
            step = self._steps.get((state, name))
            if step is None:
                hit = sorted((i for i in state if self._name[i] == name), reverse=True)
                step = self._steps[state, name] = hit, frozenset(chain.from_iterable(
                    self._from(self._next[i][0]) for i in hit))
            hits.append(step[0])
            state = step[1]
        at, out = 0, []
        for hit in reversed(hits):      # from the end, the first place from which the rest can be reached
            at = next((i for i in hit if at in self._from(self._next[i][0])), -1)
            if at < 0:
                return None
            out.append(self._place[at])
        return out[::-1] if names or 0 in state else None


@lru_cache(maxsize=256)
def wrapper_of(form: str) -> Wrapper:
    return Wrapper(form)


def form_of(page_slots: list[Slot]) -> str:
    return show(fold(tuple(("", s.name) for s in page_slots)))


def _needs_evidence(found: list[Slot]) -> bool:
    """Whether a page's main text depends on the other pages of its host."""
    return not any(s.mark == "=" for s in found) or any(s.mark[:1] == "~" for s in found)


def page_forms(pages: DataFrame) -> DataFrame:
    """(host, form, needs) of (host, html)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [slots(page or "") for page in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(form_of, found), pa.string()),
                 pa.array([bool(x) and _needs_evidence(x) for x in found], pa.bool_())], names=["host", "form", "needs"])
    return pages.select("host", "html").mapInArrow(run, "host string, form string, needs boolean")


WIDTH = 64       # forms that are aligned together


def infer(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, wrapper, needs) of (host, form, needs): groups of forms are aligned, then the groups' wrappers."""
    def fold_all(t: pa.Table) -> pa.Table:
        wrapper: tuple[Item, ...] | None = None
        for form in sorted(t["form"].to_pylist(), key=lambda f: (len(f), f)):
            wrapper = parse(form) if wrapper is None else align(wrapper, parse(form))
        return pa.table({"host": [t["host"][0].as_py()], "form": [show(wrapper or ())],
                         "needs": [any(t["needs"].to_pylist())]})
    level = scratch.put(forms.groupBy("host", "form").agg(F.max("needs").alias("needs")))
    while True:
        sizes = level.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
        if (sizes.agg(F.max("n")).first()[0] or 1) == 1:
            return level.withColumnRenamed("form", "wrapper")
        part = F.pmod(F.xxhash64("form"), F.ceil(F.col("n") / WIDTH))
        level = scratch.put(level.join(sizes, "host").withColumn("part", part).groupBy("host", "part").applyInArrow(
            fold_all, "host string, form string, needs boolean"))


def evidence(pages: DataFrame) -> DataFrame:
    """(host, stats) of (host, html, wrapper): for each slot of the wrapper the pages it is on, its different texts,
    the pages of its most frequent text, and its characters and linked characters over different texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, page, form in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = slots(page or "")
                if found and _needs_evidence(found):
                    own = xxhash.xxh3_64_intdigest(page) - 2**63
                    for s, place in zip(found, wrapper_of(form).match([s.name for s in found]) or ()):
                        if s.mark in ("", "~", "~="):
                            rows.append((host, place, xxhash.xxh3_64_intdigest(s.text) - 2**63, own, len(s.text), s.linked))
            cols = list(zip(*rows)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), *(pa.array(c, pa.int64()) for c in cols[1:])],
                names=["host", "place", "digest", "page", "chars", "linked"])
    seen = pages.select("host", "html", "wrapper").mapInArrow(
        run, "host string, place long, digest long, page long, chars long, linked long").distinct()
    texts = seen.groupBy("host", "place", "digest").agg(
        F.count_distinct("page").alias("n"), F.max("chars").alias("chars"), F.max("linked").alias("linked"))
    per = texts.groupBy("host", "place").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("different"), F.max("n").alias("top"),
        F.sum("chars").alias("chars"), F.sum("linked").alias("linked"))
    return per.groupBy("host").agg(F.sort_array(F.collect_list(  # one entry for each slot of the wrapper at most
        F.struct("place", "n", "different", "top", "chars", "linked"))).alias("stats"))


SHARE = 0.6      # of the varying text that the container of the main text holds


def _container(mass: dict[str, int]) -> str:
    """The deepest element that holds SHARE of the characters, of characters by path."""
    total, held = sum(mass.values()), {"": 0}
    for path, chars in mass.items():
        names = path.split(">")
        if re.split(r"[.]", names[-1], maxsplit=1)[0] not in HOLDERS:
            names.pop()
        for i in range(1, len(names) + 1):
            held[">".join(names[:i])] = held.get(">".join(names[:i]), 0) + chars
    deep = [x for x, chars in held.items() if x and chars >= SHARE * total]
    return max(sorted(deep), key=lambda x: x.count(">"), default="")


@lru_cache(maxsize=256)
def main_places(form: str, stats: tuple[tuple[int, ...], ...]) -> tuple[frozenset[int], frozenset[int]]:
    """Places of a wrapper that hold main text: of pages with an article or main element, and of the others."""
    names = wrapper_of(form).names
    listed = {place for place, _, _, _, chars, linked in stats if 2 * linked > chars}
    article = frozenset(i for i, x in enumerate(names) if x[:1] == "=" or (x[:2] == "~=" and i not in listed))
    path = {place: names[place].lstrip("~").removeprefix("_") for place, *_ in stats
            if names[place][:2] != "~=" and not (names[place][:1] == "~" and place in listed)}
    varying = {place: chars for place, n, different, _, chars, _ in stats
               if place in path and place not in listed and (different > 1 or n == 1)}
    varying = varying or {place: chars for place, _, _, _, chars, _ in stats if place in path and place not in listed}
    mass: dict[str, int] = {}
    for place, chars in varying.items():
        mass[path[place]] = mass.get(path[place], 0) + chars
    inside = _container(mass)
    held = {i for i, x in path.items() if not inside or x == inside or x.startswith(inside + ">")}
    same = {place for place, n, _, top, _, _ in stats if n >= 3 and 2 * top > n}
    body = [i for i in held if i in varying and i not in same] or [i for i in held if i in varying]
    frame = {i for i in held if body and not min(body) <= i <= max(body) and (
        i in listed or (i in same and re.split("[.]", path[i].rpartition(">")[2])[0] not in HEADINGS))}
    return article, frozenset(held - frame)


def chosen(found: list[Slot], form: str, stats: tuple[tuple[int, ...], ...]) -> list[str]:
    """Texts of a page's slots that match slots of main text in its host's wrapper."""
    places = wrapper_of(form).match([s.name for s in found]) or []
    article, other = main_places(form, stats)
    return ([s.text for s, i in zip(found, places) if i in article]
            or [s.text for s, i in zip(found, places) if i in other])


def _host_of(url):
    rest = F.coalesce(F.element_at(F.split(url, "://", 2), -1), F.lit(""))
    return F.lower(F.regexp_extract(rest, r"^[^/?]*", 0))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, wrapper."""
    scratch = Scratch(pages.sparkSession, "wrappers")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                        _host_of(F.col(url_col)).alias("host"))
    wrappers = infer(page_forms(rows), scratch)
    unsure = wrappers.where("needs").select("host", "wrapper", F.lit(True).alias("needed"))
    asked = lookup_join(rows.select("host", "html"), unsure, "host").where("needed")
    known = scratch.put(wrappers.select("host", "wrapper").join(scratch.put(evidence(asked)), "host", "left"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, form, stats in zip(*(batch.column(c).to_pylist() for c in ("html", "wrapper", "stats"))):
                stats = tuple(tuple(x.values()) for x in stats or ())
                texts.append("\n".join(chosen(slots(page), form, stats)) if page else "")
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                              batch.column("wrapper")], names=["page_id", "url", "text", "wrapper"])
    return lookup_join(rows, known, "host").select("page_id", "url", "html", "wrapper", "stats").mapInArrow(
        run, f"page_id {dict(rows.dtypes)['page_id']}, url string, text string, wrapper string")


def op1_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_text(load(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
