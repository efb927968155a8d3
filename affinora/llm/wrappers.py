"""Main text of web pages by union-free regular expressions, inferred per host.

A page is read as a stream of tokens: block tags with their first class and id, and text slots between them (inline tags belong to their
text; end tags that HTML lets out are put back). Runs of equal siblings, one to three kinds long, fold into repeated groups. The
wrapper of a host is what is left of all its pages after aligning their streams one after the other: tokens that both sides have
stay, others become optional, repeated on either side stays repeated, text becomes a slot. Alignment goes group by group, so a
mismatch deep in one place leaves the rest alone. An expression has no unions; a level whose order varies without end is
written as optional repeated groups in order of appearance (`LONGEST`).

For each slot the wrapper keeps the number of pages, texts, characters, characters in links, and a sketch of how many different texts it
held. What a slot is follows from its place in the expression: fixed (every page has it) or optional, single or repeated; and from its texts: a slot
is template text if at least four different pages have it and its texts hardly differ. Template slots don't hold main text. Within
an article (or main) part a slot must be fixed there and hold the same texts on every page to be one: values that
recur, and remarks on some pages, stay. Elsewhere a tenth as many different texts as expected of its pages, each with as many
texts as a repeated slot has on a page, makes template text, and slots of links don't hold main text either.

Names break the ties: navigation, headers, footers, side columns, forms, scripts, adverts, notices and comments (by tag, class or id) never
hold main text; names that an article may use for paragraphs of its own (`WEAK`) leave the decision to the expression there, and count as
the former if it can't tell (fewer than four different pages). If a page has an article part, its slots are the main text, with a
heading (h1) before or after it if the article has none; otherwise all other slots are. An article of template text alone keeps
it, and a page that would come out empty keeps its other text outside such parts.

Pages are parsed where they lie; wrappers are merged per task, then per host and part, then per host, so that a large host is no large group.
Defined results: null or empty html has no text; a null or odd url is the host ''; a page cut off anywhere is read as if its elements ended
there, a broken last tag is dropped; pages that repeat count as they stand. Columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinora.llm import text as tx
from affinora.llm.cut import bounded_batches, cut

#: Items of one level of a wrapper before its order is given up.
LONGEST = 60
#: Smallest hashes of a slot's texts that are kept: exact counts of different texts up to here.
SKETCH = 48
#: Hosts that a task holds before it hands their wrappers on, and parts of a host's wrappers that are merged first.
HOSTS, PARTS = 2000, 64
#: Largest size of all hosts' slots that is broadcast; beyond it each host's pages are dealt to `SALTS` tasks.
BROADCAST_BYTES, SALTS = 32 << 20, 32

# Tags and words of names.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data dfn del em font i img ins kbd label mark q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe noembed noframes xmp svg math".split())
NOT_TEXT = frozenset("head nav header footer aside form button select option dialog menu object audio video canvas map".split()) | RAW
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": set(), "tbody": {"thead", "tr", "td", "th"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "thead", "tbody", "tfoot"}, "td": {"tr"}, "th": {"tr"}, "option": {"select"}, "tbody": {"table"}}
MAIN_NAMES = frozenset(("main", "article", "post-content", "entry-content", "article-body", "articlebody", "post-body", "story-body"))
NOISE = re.compile(
    r"(?:^|[-_ ])(?:ads?|advert\w*|adsense|adslot|sponsor\w*|promo\w*|banner|sidebar|widget\w*|nav\w*|menu\w*|breadcrumb\w*|footer|header|masthead|topbar|toolbar|"
    r"comments?|commentlist|replies|reply|respond|disqus\w*|cookies?|consent|gdpr|notices?|popup|modal|overlay|newsletter|subscribe|signup|login|"
    r"share|sharing|related|recommend\w*|pagination|pager|paywall|copyright|skip\w*|hidden)(?:$|[-_ ])")
WEAK = re.compile(r"(?:^|[-_ ])(?:side|rail|foot|discussion|alert|search\w*|social|legal|disclaimer|tags?)(?:$|[-_ ])")
HEADING = re.compile(r"/h1(?:[.#][^/]*)?$")

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?P<shut>>|\Z)|<[!?][^>]*(?:>|\Z)|<[a-zA-Z/][^>]*(?:>|\Z)|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def signature(name: str, rest: str, inside: bool = False) -> str:
    """Tag with its first class and id (runs of digits as one 0), behind the mark of its names: ! is never main text, * a main part, ~ a weak
    name inside a main part."""
    names = {k.lower(): (a or b or c).lower().split() for k, a, b, c in ATTRIBUTE.findall(rest)} if rest else {}
    out = name
    for kind, mark in (("class", "."), ("id", "#")):
        if names.get(kind):
            out += mark + re.sub(r"\d+", "0", names[kind][0])
    role = names.get("role", [""])[0]
    called = [n for kind in ("class", "id") for n in names.get(kind, [])]
    weak = any(WEAK.search(n) for n in called)
    noise = any(NOISE.search(n) for n in called) or weak and not inside or role in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert")
    main = name in ("article", "main") or role in ("main", "article") or any(n in MAIN_NAMES for n in called)
    return ("!" if noise or name in NOT_TEXT else "~" if weak else "*" if main else "") + out


class Page:
    """The stream of a page: a tree of [signature, children], texts as (path, text, characters in links) in order."""

    def __init__(self, source: str | None) -> None:
        self.root: list = ["", []]
        self.texts: list[tuple[str, str, int]] = []
        self._stack: list[tuple[str, list, str]] = [("", self.root, "")]
        self._run: list[str] = []
        self._links = self._open_links = 0
        if source:
            self._read(source)

    def _flush(self) -> None:
        if self._run:
            body = " ".join(entities.unescape("".join(self._run)).split())
            if body:
                _, node, path = self._stack[-1]
                if not node[1] or node[1][-1] != "#":
                    node[1].append("#")
                self.texts.append((path, body, self._links))
            self._run = []
        self._links = 0

    def _pop_to(self, depth: int) -> None:
        self._flush()
        del self._stack[depth:]

    def _close(self, names: set[str] | frozenset[str], scope: set[str]) -> None:
        """Ends the nearest of these elements, unless one of the scope stands before it."""
        for depth in range(len(self._stack) - 1, 0, -1):
            if self._stack[depth][0] in names:
                self._pop_to(depth)
                return
            if self._stack[depth][0] in scope:
                return

    def _read(self, source: str) -> None:
        at = 0
        while at < len(source):
            m = TOKEN.match(source, at)
            at = m.end()
            name = m["name"]
            if name is None:
                if m[0][0] != "<" or len(m[0]) == 1:
                    self._run.append(m[0])
                    if self._open_links:
                        self._links += len(m[0].strip())
                continue
            if not m["shut"]:
                break  # a tag that the end of the page cuts
            name = name.lower()
            if name in INLINE:
                if name == "a":
                    self._open_links = 0 if m["end"] else 1
                elif name == "br":
                    self._run.append(" ")
                continue
            if m["end"]:
                if any(s[0] == name for s in self._stack):
                    self._close({name}, set())
                continue
            self._flush()
            self._open_links = 0
            if name in RAW and not m["rest"].endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
                at = end.end() if end else len(source)
                continue
            if name in VOID:
                continue
            if name in CLOSES_P:
                self._close({"p"}, {"table", "td", "div", "article", "section", "li", "blockquote"})
            if name in SIBLINGS:
                for _ in range(2):
                    self._close(SIBLINGS[name], SCOPES.get(name, set()))
            _, node, path = self._stack[-1]
            sig = signature(name, m["rest"], "/*" in path)
            child: list = [sig, []]
            node[1].append(child)
            self._stack.append((name, child, f"{path}/{sig}"))
        self._pop_to(0)


# A wrapper: [kind, items]; an item is "#" (a slot) or [optional, repeated, wrapper]; a group of several kinds has the kind "(".

def _key(item) -> str:
    if item == "#":
        return "#"
    kind, items = item[2]
    return kind if kind != "(" else "(" + " ".join(_key(i) for i in items)


def _fold(items: list) -> list:
    """Runs of equal keys, one to three long, become repeated groups."""
    for period in (1, 2, 3):
        out: list = []
        at = 0
        while at < len(items):
            keys = [_key(i) for i in items[at:at + period]]
            n = 1
            while len(keys) == period and [_key(i) for i in items[at + n * period:at + (n + 1) * period]] == keys:
                n += 1
            if n == 1 or keys == ["#"]:
                out.append(items[at])
                at += 1
                continue
            first = items[at:at + period]
            for k in range(1, n):
                first = [merge_items(a, b) for a, b in zip(first, items[at + k * period:at + (k + 1) * period])]
            if period == 1:
                out.append([first[0][0], True, first[0][2]])
            else:
                out.append([False, True, ["(", first]])
            at += n * period
        items = out
    return items


def of_tree(node: list) -> list:
    kind, children = node
    return [kind, _fold([c if c == "#" else [False, False, of_tree(c)] for c in children])]


def merge_items(a, b):
    return "#" if a == "#" else [a[0] or b[0], a[1] or b[1], merge(a[2], b[2])]


def _optional(item):
    return item if item == "#" else [True, item[1], item[2]]


def merge(a: list, b: list) -> list:
    """The narrowest expression of this form for what either side describes."""
    if a == b:
        return a
    left, right = a[1], b[1]
    ka, kb = [_key(i) for i in left], [_key(i) for i in right]
    n, m = len(ka), len(kb)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if ka[i] == kb[j] else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    out: list = []
    while i < n or j < m:
        if i < n and j < m and ka[i] == kb[j]:
            out.append(merge_items(left[i], right[j]))
            i, j = i + 1, j + 1
        elif j == m or i < n and best[i + 1][j] >= best[i][j + 1]:
            out.append(_optional(left[i]))
            i += 1
        else:
            out.append(_optional(right[j]))
            j += 1
    folded = _fold(out)
    if len(folded) > LONGEST:
        kinds: dict[str, list] = {}
        for item in folded:
            key = _key(item)
            kinds[key] = "#" if item == "#" else [True, True, merge(kinds[key][2], item[2]) if key in kinds else item[2]]
        folded = list(kinds.values())
    return [a[0], folded]


def expression(wrapper: list) -> str:
    """The wrapper as a regular expression over tags, with # for text."""
    kind, items = wrapper
    inner = "".join("#" if i == "#" else (f"({expression(i[2])})" if i[0] or i[1] else expression(i[2])) + ("*" if i[0] and i[1] else "?" if i[0] else "+" if i[1] else "") for i in items)
    return inner if kind in ("", "(") else f"<{kind.lstrip('!*~')}>{inner}</>"


class Host:
    """Wrapper of a host and what its slots held: path to [pages, characters, in links, smallest hashes of texts, and of pages, texts]."""

    def __init__(self, wrapper: list | None = None, pages: int = 0, slots: dict[str, list] | None = None) -> None:
        self.wrapper, self.pages, self.slots = wrapper, pages, slots or {}

    def read(self, page: Page) -> None:
        tree = of_tree(page.root)
        self.wrapper = tree if self.wrapper is None else merge(self.wrapper, tree)
        self.pages += 1
        seen = set()
        whole = xxhash.xxh32_intdigest("\n".join(f"{path} {body}" for path, body, _ in page.texts if "/!" not in path))
        for path, body, links in page.texts:
            slot = self.slots.setdefault(path, [0, 0, 0, [], [], 0])
            slot[0] += path not in seen
            slot[1] += len(body)
            slot[2] += min(links, len(body))
            slot[5] += 1
            seen.add(path)
            _remember(slot[3], xxhash.xxh32_intdigest(body))
            _remember(slot[4], whole)

    def add(self, other: Host) -> None:
        self.wrapper = other.wrapper if self.wrapper is None else merge(self.wrapper, other.wrapper) if other.wrapper else self.wrapper
        self.pages += other.pages
        for path, (pages, chars, links, hashes, wholes, texts) in other.slots.items():
            slot = self.slots.setdefault(path, [0, 0, 0, [], [], 0])
            slot[0], slot[1], slot[2], slot[5] = slot[0] + pages, slot[1] + chars, slot[2] + links, slot[5] + texts
            for h in hashes:
                _remember(slot[3], h)
            for h in wholes:
                _remember(slot[4], h)

    def dumps(self) -> str:
        return json.dumps([self.wrapper, self.pages, self.slots], separators=(",", ":"))

    @classmethod
    def loads(cls, stored: str) -> Host:
        return cls(*json.loads(stored))

    def marks(self) -> dict[str, tuple[bool, bool]]:
        """Every slot that the expression leads to, as a path: whether all its places are optional (within its main part, if it is in one), and
        whether one is repeated."""
        out: dict[str, tuple[bool, bool]] = {}

        def walk(wrapper: list, path: str, optional: bool, repeated: bool) -> None:
            for item in wrapper[1]:
                if item == "#":
                    before = out.get(path, (True, False))
                    out[path] = (before[0] and optional, before[1] or repeated)
                    continue
                kind = item[2][0]
                main = kind.startswith("*")
                walk(item[2], path if kind == "(" else f"{path}/{kind}", (optional or item[0]) and not main, (repeated or item[1]) and not main)

        if self.wrapper:
            walk(self.wrapper, "", False, False)
        return out

    def main_slots(self) -> dict[str, int]:
        """What slots hold: 2 main text of an article or main part, 3 a heading outside, 1 main text elsewhere; -2 template text of a main part,
        -1 what stands under a weak name there and isn't main text."""
        out: dict[str, int] = {}
        for p, (optional, repeated) in self.marks().items():
            if "/!" in p or p not in self.slots:
                continue
            pages, chars, links, hashes, wholes, texts = self.slots[p]
            different, kinds = _different(wholes), _different(hashes)  # copies of a page are one page
            on_a_page = texts / pages if repeated else 1
            same = kinds <= max(1, on_a_page)
            alike = kinds <= max(1, on_a_page, different * on_a_page // 10)
            if "/~" in p:
                out[p] = 2 if different >= 4 and not alike and links * 2 <= chars else -1
            elif "/*" in p:
                out[p] = -2 if different >= 4 and same and not optional else 2
            elif not (different >= 4 and alike) and links * 2 <= chars:
                out[p] = 3 if HEADING.search(p) else 1
        return out


def _remember(hashes: list[int], h: int) -> None:
    if h not in hashes:
        hashes.append(h)
        if len(hashes) > SKETCH:
            hashes.remove(max(hashes))


def _different(hashes: list[int]) -> float:
    return len(hashes) if len(hashes) < SKETCH else (SKETCH - 1) * 2.0 ** 32 / max(max(hashes), 1)


_PARTIAL = pa.schema([("host", pa.string()), ("wrapper", pa.string())])


def _infer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hosts: dict[str, Host] = {}
    for batch in batches:
        for host, source in tx.rows(batch, "host", "html"):
            if source:
                hosts.setdefault(host, Host()).read(Page(source))
            if len(hosts) > HOSTS:
                yield from tx.in_batches(((h, w.dumps()) for h, w in hosts.items()), _PARTIAL)
                hosts = {}
    yield from tx.in_batches(((h, w.dumps()) for h, w in hosts.items()), _PARTIAL)


def _combine(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
    out = Host()
    for stored in sorted(group.column("wrapper").to_pylist()):
        out.add(Host.loads(stored))
    return pa.Table.from_pylist([{"host": key[0].as_py(), "wrapper": out.dumps()}], schema=_PARTIAL)


def _with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"), F.col("html"), host.alias("host"))


def host_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper), the wrapper stored as JSON."""
    partial = _with_host(pages).select("host", "html").mapInArrow(_infer, "host string, wrapper string")
    part = F.pmod(F.xxhash64("wrapper"), F.lit(PARTS)).alias("part")
    merged = partial.select("host", "wrapper", part).groupBy("host", "part").applyInArrow(_combine, "host string, wrapper string")
    return merged.groupBy("host").applyInArrow(_combine, "host string, wrapper string")


def main_text(source: str | None, slots: dict[str, int]) -> str:
    """Blocks of a page in its host's main slots, those in an article alone if it has one; else all outside noise."""
    blocks = [(slots.get(path, 0), path, body) for path, body, _ in Page(source).texts if "/!" not in path]
    found = {k for k, _, _ in blocks}
    if 2 in found:
        titled = any(k == 2 and HEADING.search(path) for k, path, _ in blocks)
        kept = {2} if titled else {2, 3}
    else:
        kept = {-2} if -2 in found else {1, 3} if found & {1, 3} else {0}
    return "\n".join(body for k, _, body in blocks if k in kept)


def extract(pages: DataFrame) -> DataFrame:
    """Per row of pages: page_id, url, text, n_chars."""
    bounded_batches(pages)
    slots = cut(host_wrappers(pages).withColumn("slots", F.pandas_udf(_slots, "string")("wrapper")).select("host", "slots"))
    size = slots.agg(F.sum(F.octet_length("host") + F.octet_length("slots"))).first()[0] or 0
    rows = _with_host(pages)
    if size <= BROADCAST_BYTES:
        rows = rows.join(F.broadcast(slots), "host", "left")
    else:  # a host of many pages meets its slots in several tasks
        salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(slots.withColumn("salt", F.explode(salts)), ["host", "salt"], "left")
    rows = rows.select("page_id", "url", F.pandas_udf(_extract, "string")("html", "slots").alias("text"))
    return rows.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def _slots(wrappers: pd.Series) -> pd.Series:
    return wrappers.map(lambda w: json.dumps(Host.loads(w).main_slots()))


def _extract(sources: pd.Series, slots: pd.Series) -> pd.Series:
    read: dict[str | None, dict[str, int]] = {None: {}}
    out = []
    for source, stored in zip(sources, slots):
        if stored not in read:
            if len(read) > HOSTS:
                read = {None: {}}
            read[stored] = json.loads(stored)
        out.append(main_text(source, read[stored]))
    return pd.Series(out, dtype=object)
