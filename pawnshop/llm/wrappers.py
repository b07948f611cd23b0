"""Main text of web pages by wrappers: union-free regular expressions over same-host pages.

A page is a stream of text blocks, each under the path of its structural
elements.  The streams of one host are aligned one after the other.  Where they
agree, the wrapper keeps a block; a mismatch of texts becomes a text slot, a
block or stretch that repeats becomes a repeated group, one that some pages lack
becomes optional - never an alternative, so the expression stays union-free.
The finished wrapper tells, with the evidence of all pages of the host, which
element holds the article; each page is then read through its host's wrapper.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from pawnshop.llm.frames import settled

#: Wrappers that one task aligns one after the other; more are aligned in further rounds.
ALIGNED_TOGETHER = 64
#: Blocks in the longest stretch whose repetition is folded.
LONGEST_REPEAT = 4

# Elements of HTML and how they read.
_RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "xmp", "noembed", "object", "canvas", "title")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
 figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select
 summary table tbody td tfoot th thead tr ul""".split())
# Elements whose text is not the article's.
_ASIDE = frozenset("head nav header footer aside form menu dialog button select fieldset search dir".split())
_ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_ASIDE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments
 cookie cookies consent disqus footer header masthead menu modal nav navbar navigation newsletter notice notices notification pagination
 popup promo promoted promotion recommended related replies respond share sharing sidebar signup skip social sponsor sponsored subscribe
 subscription toolbar widget""".split())
_HOLDS = frozenset("no not has have with without".split())
_MAIN = ("article", "main")
# Elements that hold a piece of an article, never all of it.
_PIECES = frozenset("p h1 h2 h3 h4 h5 h6 li pre dt dd td th tr tbody thead table ul ol dl figure figcaption blockquote address summary details caption".split())
_CLOSES_ITSELF = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"),
                  "option": ("select",)}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|</?([a-zA-Z][^\s/>]*)((?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)>?""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style|itemprop)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_NUMBER = re.compile(r"[0-9]+")
_END_RAW = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in _RAW}
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m.group(1).lower() if m else ""


def _element(name: str, attributes: str) -> tuple[str, bool, bool]:
    """(name with its class, whether its text is not the article's, whether its class words say so)."""
    aside, marked, kind = name in _ASIDE, False, ""
    for m in _ATTRIBUTE.finditer(attributes) if attributes else ():
        key, value = m.group(1).lower(), (m.group(2) or m.group(3) or m.group(4) or "").lower()
        if key in ("class", "id"):
            # numbers tell pages apart, not places in a page
            kind = kind or _NUMBER.sub("0", value.split(" ")[0])
            # "has-header" and "no-sidebar" speak of what the element holds or lacks
            own = (re.split(r"[^a-z]+", v) for v in value.split())
            marked |= any(words[0] not in _HOLDS and not _ASIDE_WORDS.isdisjoint(words) for words in own)
        elif key == "role":
            aside |= value in _ASIDE_ROLES
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            aside |= name not in ("body", "html")
    return (f"{name}.{kind}" if kind else name), aside, marked


class _Marked:
    """An open element whose class words tell of an aside, with what it turns out to hold."""

    def __init__(self):
        self.holds_main = self.holds_title = False
        self.chars = 0

    def aside(self, total: int) -> bool:
        """Whether the words hold: not for a frame around the article, such as "page header-large".

        A frame holds the page's first main or article element, or a title with
        most of the page's text.
        """
        return not (self.holds_main or self.holds_title and 2 * self.chars > total)


def blocks(page: str) -> Iterator[tuple[tuple[str, ...], bool, str]]:
    """(path, aside, text) of each block of a page, in order; blank blocks are left out.

    The path names the open structural elements; ``aside`` tells whether one of
    them marks text outside the article (menus, headers, forms, adverts, ...) by
    its name, role or class words (see ``_Marked``).
    """
    found = list(_parsed(page))
    total = sum(len(text) for _, aside, _, text in found if not aside)
    for path, aside, marks, text in found:
        yield path, aside or any(m.aside(total) for m in marks), text


def _parsed(page: str) -> Iterator[tuple[tuple[str, ...], bool, tuple[_Marked, ...], str]]:
    """(path, aside by name or role, elements with class words, text) of each block.

    Open paragraphs end where a block begins; stray end tags are ignored.
    """
    stack: list[tuple[str, str, bool, _Marked | None]] = []
    parts: list[str] = []
    at = 0
    met_main = False

    def flush():
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        parts.clear()
        if text:
            aside, marks = any(s[2] for s in stack), tuple(s[3] for s in stack if s[3])
            if not aside:
                for m in marks:
                    m.chars += len(text)
            yield tuple(s[1] for s in stack), aside, marks, text

    while True:
        m = _TOKEN.search(page, at)
        parts.append(page[at:m.start()] if m else page[at:])
        if not m:
            break
        at = m.end()
        if not m.group(1):
            continue
        name = m.group(1).lower()
        closing = page[m.start() + 1] == "/"
        if name in _END_RAW and not closing:
            if not m.group(2).endswith("/") or name not in ("svg", "math"):
                end = _END_RAW[name].search(page, at)
                at = end.start() if end else len(page)
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name not in _BLOCK:
            continue
        if closing:
            if any(s[0] == name for s in stack):
                yield from flush()
                while stack.pop()[0] != name:
                    pass
            elif name == "p":
                yield from flush()
            continue
        yield from flush()
        if name in _VOID:
            continue
        while stack and stack[-1][0] == "p":
            stack.pop()
        if name in _CLOSES_ITSELF:
            names = [s[0] for s in stack]
            for k in range(len(names) - 1, -1, -1):
                if names[k] in _CLOSES_ITSELF[name]:
                    break
                if names[k] == name or {names[k], name} <= {"dt", "dd"} or {names[k], name} <= {"td", "th"}:
                    del stack[k:]
                    break
        if name in ("html", "body"):
            stack.clear()
            continue
        if name != "head" and stack and stack[0][0] == "head":
            stack.clear()
        signature, aside, marked = _element(name, m.group(2))
        begins = not met_main and (name == "main" or name == "article" and not marked)
        met_main |= begins
        for s in stack:
            if s[3]:
                s[3].holds_main |= begins
                s[3].holds_title |= name == "h1"
        # inside an article's own name such as "article-header" the words still count, but never for the article itself
        stack.append((name, signature, aside, _Marked() if marked and name not in ("article", "main") else None))
    yield from flush()


# A wrapper is a list of nodes [path, text code or null for a slot, pages that have it, blocks, characters, repeated, aside] or
# [nodes, null, pages, ...] for a repeated group of several blocks.


def _key(node: list) -> str:
    return node[0] if isinstance(node[0], str) else "(" + "|".join(_key(n) for n in node[0]) + ")"


def _joined(a: list, b: list, same_page: bool) -> list:
    """One node for two that match: texts that differ make a slot; within a page they also make a repetition."""
    inner = a[0] if isinstance(a[0], str) else [_joined(x, y, same_page) for x, y in zip(a[0], b[0], strict=True)]
    return [inner, a[1] if a[1] == b[1] else None, a[2] if same_page else a[2] + b[2], a[3] + b[3], a[4] + b[4], a[5] or b[5] or same_page, a[6]]


def fold(nodes: list[list]) -> list[list]:
    """Fold repeated neighbours, first single blocks, then stretches, into repeated groups."""
    for period in range(1, LONGEST_REPEAT + 1):
        out: list[list] = []
        keys: list[str] = []
        for node in nodes:
            out.append(node)
            keys.append(_key(node))
            while len(out) >= 2 * period and keys[-period:] == keys[-2 * period:-period]:
                both = [_joined(x, y, True) for x, y in zip(out[-2 * period:-period], out[-period:], strict=True)]
                out[-2 * period:], keys[-2 * period:] = both, keys[-period:]
            if period > 1 and len(out) > period and isinstance(out[-period - 1][0], list) and keys[-period - 1] == "(" + "|".join(keys[-period:]) + ")":
                group = out[-period - 1]
                group[0] = [_joined(x, y, True) for x, y in zip(group[0], out[-period:], strict=True)]
                del out[-period:], keys[-period:]
        nodes = out
    return nodes


def page_wrapper(page: str) -> list[list]:
    return fold([["/".join(path), zlib.crc32(text.encode()), 1, 1, len(text), False, aside] for path, aside, text in blocks(page)])


def align(a: list[list], b: list[list]) -> list[list]:
    """The wrapper of two: the longest common sequence of their nodes matches, what one side lacks is kept as optional."""
    ka, kb = [_key(n) for n in a], [_key(n) for n in b]
    if ka == kb:
        return [_joined(x, y, False) for x, y in zip(a, b, strict=True)]
    lo = 0
    while lo < min(len(ka), len(kb)) and ka[lo] == kb[lo]:
        lo += 1
    hi = 0
    while hi < min(len(ka), len(kb)) - lo and ka[-1 - hi] == kb[-1 - hi]:
        hi += 1
    ma, mb = ka[lo:len(ka) - hi], kb[lo:len(kb) - hi]
    best = [[0] * (len(mb) + 1) for _ in range(len(ma) + 1)]
    for i in range(len(ma) - 1, -1, -1):
        for j in range(len(mb) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if ma[i] == mb[j] else max(best[i + 1][j], best[i][j + 1])
    out = [_joined(x, y, False) for x, y in zip(a[:lo], b[:lo], strict=True)]
    i = j = 0
    while i < len(ma) or j < len(mb):
        if i < len(ma) and j < len(mb) and ma[i] == mb[j]:
            out.append(_joined(a[lo + i], b[lo + j], False))
            i, j = i + 1, j + 1
        elif j == len(mb) or i < len(ma) and best[i + 1][j] >= best[i][j + 1]:
            out.append(a[lo + i])
            i += 1
        else:
            out.append(b[lo + j])
            j += 1
    out += [_joined(x, y, False) for x, y in zip(a[len(a) - hi:], b[len(b) - hi:], strict=True)] if hi else []
    return fold(out)


def expression(wrapper: list[list], pages: int) -> str:
    """The wrapper as a union-free regular expression: #text slots, ( )+ repetitions, ( )? optional parts."""
    parts = []
    for n in wrapper:
        if isinstance(n[0], str):
            core = f"<{n[0]}>" + ("#text" if n[1] is None else f"'{n[1]:08x}'")
        else:
            core = expression(n[0], n[2]).strip()
        core = f"({core})+" if n[5] else core
        parts.append(f"({core})?" if n[2] < pages else core)
    return " ".join(parts)


def _leaves(wrapper: list[list]) -> Iterator[list]:
    for n in wrapper:
        if isinstance(n[0], str):
            yield n
        else:
            yield from _leaves(n[0])


def container(wrapper: list[list]) -> str:
    """The path of the element that holds the article, by the text of all pages the wrapper was made from.

    An article or main element where there is one that holds text; else the
    deepest element, paragraphs, lists and the like apart, that still holds
    three fifths of the text that is not aside.
    """
    chars: Counter = Counter()
    total = 0
    for path, _, _, _, n, _, aside in _leaves(wrapper):
        if aside:
            continue
        total += n
        names = path.split("/") if path else []
        for k in range(len(names) + 1):
            chars["/".join(names[:k])] += n
    for main in _MAIN:
        own = [p for p in chars if p and p.split("/")[-1].split(".")[0] == main]
        if own:
            top = [p for p in own if not any(p.startswith(o + "/") for o in own)]
            return max(top, key=lambda p: (chars[p], p))
    if not total:
        return ""
    whole = [p for p, n in chars.items() if n >= 0.6 * total and p.split("/")[-1].split(".")[0] not in _PIECES]
    return max(whole, key=lambda p: (p.count("/") + bool(p), -chars[p], p)) if whole else ""


def main_text(page: str, where: str) -> str:
    """Blocks of the page inside the container and not aside, joined by line ends.

    A page that lacks the host's container is read through a wrapper of its own.
    """
    found = list(blocks(page))
    inside = [("/".join(path), aside, text) for path, aside, text in found]
    for place in (where, None):
        if place is None:
            place = container([[p, 0, 1, 1, len(t), False, a] for p, a, t in inside])
        hit = [t for p, a, t in inside if not a and (not place or p == place or p.startswith(place + "/"))]
        if hit:
            return "\n".join(hit)
    return ""


_PART = "host string, part long, pages long, wrapper string"


def _partial(batches):
    """One wrapper for each host of an Arrow batch."""
    part = TaskContext.get().partitionId() << 32
    for batch in batches:
        own: dict[str, list] = {}
        for url, page in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
            host, w = host_of(url), page_wrapper(page or "")
            if host in own:
                own[host] = [own[host][0] + 1, align(own[host][1], w)]
            else:
                own[host] = [1, w]
        yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.string()), pa.array([part + k for k in range(len(own))], pa.int64()),
                                          pa.array([n for n, _ in own.values()], pa.int64()),
                                          pa.array([json.dumps(w, separators=(",", ":")) for _, w in own.values()], pa.string())],
                                         ["host", "part", "pages", "wrapper"])
        part += len(own)


def _merge(key, frame):
    import pandas as pd

    frame = frame.sort_values("part")
    whole = None
    for w in frame["wrapper"]:
        w = json.loads(w)
        whole = w if whole is None else align(whole, w)
    return pd.DataFrame({"host": [key[0]], "part": [frame["part"].min()], "pages": [frame["pages"].sum()],
                         "wrapper": [json.dumps(whole, separators=(",", ":"))]})


def infer(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, pages, wrapper, expression, container) of each host.

    Each task aligns its own pages to one wrapper a host; these are aligned in
    rounds of ``ALIGNED_TOGETHER`` until each host has one.  A host with any
    share of the pages is thus spread over all tasks.
    """
    src = pages.select(F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    parts = settled(src.mapInArrow(_partial, _PART), "wrappers")
    while True:
        most = parts.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            break
        groups = -(-most // ALIGNED_TOGETHER)
        parts = settled(parts.withColumn("group", F.pmod(F.xxhash64("part"), F.lit(groups)))
                        .groupBy("host", "group").applyInPandas(_merge, _PART), "wrappers")

    @F.pandas_udf("expression string, container string")
    def read(wrapper, pages):
        import pandas as pd

        loaded = [json.loads(w) for w in wrapper]
        return pd.DataFrame({"expression": [expression(w, n) for w, n in zip(loaded, pages, strict=True)],
                             "container": [container(w) for w in loaded]})

    return parts.withColumn("r", read("wrapper", "pages")).select("host", "pages", "wrapper", "r.expression", "r.container")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text): the main text of each page, read through its host's wrapper.

    Character references are decoded, white space within a block is one space,
    blocks are joined by one line end.  Null and empty pages, and pages without
    an article, have the empty text; pages without a host share one wrapper;
    null and repeated ids are kept; other columns are ignored, whatever their
    names; an empty table gives an empty result.
    """
    rules = settled(infer(pages, url_col, html_col).select("host", "container"), "containers")

    @F.pandas_udf("string")
    def text_in(page, where):
        import pandas as pd

        return pd.Series([main_text(p or "", w or "") for p, w in zip(page, where, strict=True)])

    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), _HOST.pattern, 1))
    src = pages.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url"), F.col(html_col).cast("string").alias("__html"), host.alias("__host"))
    joined = src.join(rules, F.col("__host") == F.col("host"), "left")
    return joined.select(F.col("__id").alias(id_col), F.col("__url").alias(url_col), text_in("__html", "container").alias("text"))
