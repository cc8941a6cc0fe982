"""Main text of web pages by a site style tree.

The DOMs of a host's pages are merged: elements that are presented alike (same tags and
classes along the path from the root) form one style node. A node's content importance is one
minus the mean entropy of its distinct contents over the host's pages: content found on one page
only has entropy 0, content on all pages entropy 1. Presentation importance comes first: an
element made for navigation, adverts, comments and the like has none, the text of an ``article``
or ``main`` has all. Content importance decides the rest. Branches whose importance is below the
threshold are left out of each page.

Classes, ids and forms: a branch named as a whole word for menus, adverts, sidebars, footers, notices,
sharing and so on, or a form, has no presentation importance, nor has an article that is so named or
lies below. That doesn't hold for a branch that holds the page's only article, or most of its
text (names also used for wrappers: over half; others: four fifths, or over half with the article;
reader comments: never). A name of which the word is only a part, and such names on a paragraph, a
heading or inline text (for wrapper names), only mark: the branch goes if its content importance is
low, too. A mark on ``html`` or ``body`` says nothing, and none of these marks reaches an ``article``
or ``main`` below it.

A host with few pages says little, so its importance is drawn towards that of the same style
node over all hosts (as ``PRIOR_PAGES`` pages would). Statistics cover all pages; pages of equal
html count each. They are gathered per (host, node, content) with partial sums, so no host is
held by one task; the low nodes go back to the pages as a broadcast of checked size, or by a
join on the host.

Defined results: a null or empty html gives an empty text; a page without an ``article`` or
``main`` is judged by importance alone; unclosed tags are closed by their parents; text outside
any tag belongs to the root. A null url counts as an empty host. Repeated rows get a text each.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import escape, unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalloy.llm.common import SLICE_CHARS, col, cut

PRIOR_PAGES = 20
THRESHOLD = 0.4
NAMED_THRESHOLD = 0.8  # below a class or id that is a noise word as a whole
# Low nodes are sent to executors whole up to this number, else joined by host.
MAX_SENT_NODES = 200_000
SALTS = 32

# Elements by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noscript template iframe svg".split())
NEVER = frozenset("head title script style noscript template iframe svg select option button textarea canvas".split())
NOISE_TAGS = frozenset("nav footer aside menu dialog header".split())
COMMENT_WORDS = frozenset("comment comments commentlist reply replies respond disqus".split())
PLAIN_WORDS = frozenset(
    "ad ads advert advertisement advertising banner sponsor sponsored promo promotion sidebar side nav navbar navigation menu "
    "breadcrumb breadcrumbs footer masthead notice notices cookie cookies consent gdpr alert newsletter subscribe subscription "
    "signup login share sharing related recommended pagination pager toolbar copyright".split())
WRAPPER_WORDS = frozenset("header social widget popup modal overlay".split())
NOISE_WORDS = COMMENT_WORDS | PLAIN_WORDS | WRAPPER_WORDS
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
CONTENT_TAGS = frozenset("article main".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 hgroup blockquote pre figcaption address dt dd".split())
CLOSES = {  # a start tag closes an open element of these, up to the nearest of the stops
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table", "thead", "tbody", "tfoot")), "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")), "tbody": (("thead", "tbody", "tr", "td", "th"), ("table",)),
    "tfoot": (("thead", "tbody", "tr", "td", "th"), ("table",)), "option": (("option",), ("select",)),
}
CLOSE_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre section table ul".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[a-zA-Z/!?][^>]*+(?:>|\Z)|([^<]++|<)""",
    re.DOTALL)
_ATTR = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=\s|/|$)""", re.IGNORECASE)
_SPLIT = re.compile(r"[^a-z0-9]+")


# Marks: part of a name, a whole name that only marks, and branches named as noise.
PART, WHOLE, COMMENTS, PLAIN, WRAPPER = 3, 4, 10, 11, 12


class _Node:
    """An open element: its style path, its role, the named branches it lies in and whether it starts a block."""

    __slots__ = ("tag", "path", "role", "content", "named", "block")

    def __init__(self, tag: str, path: int, role: int, content: bool, named: tuple[int, ...], block: bool = True):
        self.tag, self.path, self.role, self.content, self.named, self.block = tag, path, role, content, named, block


def _mark(tag: str, words: set[str]) -> int:
    """Mark of whole names: comments before plain before wrapper words."""
    kind = COMMENTS if words & COMMENT_WORDS else PLAIN if words & PLAIN_WORDS else WRAPPER if words & WRAPPER_WORDS else 0
    return WHOLE if kind and (tag in INLINE or kind == WRAPPER and tag in PARAGRAPHS) else kind


def _look(tag: str, attrs: str) -> tuple[str, bool, int, bool]:
    """(presentation, noise, mark, hidden) of an element by its tag, classes, id and role."""
    label, noise, hidden = tag, tag in NOISE_TAGS, False
    marks = {WRAPPER} if tag == "form" else set()
    for name, value in _ATTR.findall(attrs) if attrs else ():
        name, value = name.lower(), unescape(value.strip("\"'")).lower()
        if name in ("class", "role"):
            label += "." + " ".join(sorted(value.split()))
        if name == "hidden" or name == "aria-hidden" and value == "true":
            hidden = True
        elif name == "role":
            noise = noise or value in NOISE_ROLES
            marks |= {WRAPPER} if value == "form" else set()
        elif tag not in ("html", "body"):  # their names are the whole page's
            marks.add(_mark(tag, set(value.split())))
            if tag not in CONTENT_TAGS and not NOISE_WORDS.isdisjoint(_SPLIT.split(value)):
                marks.add(PART)
    strong = [m for m in marks if m >= COMMENTS]
    mark = min(strong) if strong else max(marks, default=0)
    return f"{label}!{mark}" if mark else label, noise, mark, hidden


def blocks(html: str) -> list[tuple[int, int, bool, str]]:
    """Blocks of a page in order: (style node, role, in content, text).

    Role: 0 neutral, 1 noise, 2 never text, 3 and 4 marked (part of a name, a whole one). Texts are decoded
    and their white space is single. A block is the text between two block boundaries under one style node of the nearest block.
    """
    out: list[tuple[int, int, bool, str, tuple[int, ...]]] = []
    root = _Node("", 0, 0, False, ())
    kinds: list[int] = []  # of the named branches
    stack, text, looks = [root], [], {}
    at, n = 0, len(html)

    def block_node() -> _Node:
        for node in reversed(stack):
            if node.block:
                return node
        return root

    owner = root

    def flush() -> None:
        if text:
            words = unescape("".join(text)).split()
            text.clear()
            if words:
                out.append((owner.path, owner.role, owner.content, " ".join(words), owner.named))

    def close(k: int) -> None:
        nonlocal owner
        flush()
        del stack[k:]
        owner = block_node()

    while at < n:
        m = _TOKEN.match(html, at)
        if not m:
            break
        at = m.end()
        run = m.group(7)
        if run is not None:
            text.append(run)
            continue
        tag = m.group(2) or m.group(5)
        if tag is None:
            continue  # a comment, declaration or instruction
        tag = tag.lower()
        if m.group(1) or m.group(4):  # an end tag closes the nearest open element of its name
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    if not any(x.block for x in stack[k:]):
                        del stack[k:]
                    else:
                        close(k)
                    break
                if tag in INLINE and stack[k].tag not in INLINE:
                    break  # an inline end tag doesn't close blocks
            continue
        if tag == "br":
            text.append("\n")
            continue
        attrs = m.group(3) or m.group(6) or ""
        if tag in CLOSE_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag not in INLINE:
                    break
        if tag in CLOSES:
            names, stops = CLOSES[tag]
            low = None
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in stops:
                    break
                if stack[k].tag in names:
                    low = k
            if low is not None:
                close(low)
        if tag in VOID:
            if tag not in INLINE:
                flush()
            continue
        key = (tag, attrs)
        look = looks.get(key)
        if look is None:
            look = looks[key] = _look(tag, attrs)
        label, noise, mark, hidden = look
        up = stack[-1]
        if tag == "header" and up.content and noise:
            noise = _look("div", attrs)[1]  # the header of an article, not of the page
        content, above, named = up.content, up.role, up.named
        if mark >= COMMENTS:
            kinds.append(mark)
            named = (*named, len(kinds) - 1)
        elif tag in CONTENT_TAGS and not noise and above not in (1, 2):
            content, above = True, 0
        role = 2 if above == 2 or hidden or tag in NEVER else 1 if above == 1 or noise else max(above, mark if mark in (PART, WHOLE) else 0)
        if tag in RAW:  # its content is no markup
            end = re.compile(rf"</{tag}\s*>|\Z", re.IGNORECASE).search(html, at)
            inside = html[at:end.start()]
            at = end.end()
            flush()
            if tag == "xmp" and role != 2:
                text.append(escape(inside, quote=False))
                flush()
            continue
        if tag in INLINE and not (noise or mark or hidden):
            stack.append(_Node(tag, up.path, role, content, named, block=False))
            continue
        flush()
        path = xxhash.xxh3_64_intdigest(f"{up.path}>{label}".encode("utf-8", "surrogatepass"))
        owner = _Node(tag, path, role, content, named)
        stack.append(owner)
    flush()
    return _decided(out, kinds)


def _decided(found: list[tuple[int, int, bool, str, tuple[int, ...]]], kinds: list[int]) -> list[tuple[int, int, bool, str]]:
    """Blocks of named branches become noise, but for branches that hold the page's article or most of its text."""
    noise: set[int] = set()
    if kinds:
        chars, holds = [0] * len(kinds), [False] * len(kinds)
        total, free = 0, False
        for _, role, content, t, named in found:
            if role in (1, 2):
                continue
            total += len(t)
            free = free or content and not named
            for b in named:
                chars[b] += len(t)
                holds[b] = holds[b] or content
        for b, kind in enumerate(kinds):
            half, most = 2 * chars[b] > total, 5 * chars[b] >= 4 * total
            spared = kind == WRAPPER and (half or holds[b]) or kind == PLAIN and (most or half and holds[b])
            if free or not spared:
                noise.add(b)
    return [(path, 1 if role != 2 and not noise.isdisjoint(named) else role, content, t) for path, role, content, t, named in found]


def content_key(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def kept(role: int, content: bool, low: bool, has_content: bool) -> bool:
    """Whether a block stays. ``low``: its importance is below the threshold.

    Presentation decides where it speaks: elements made for menus, adverts, comments and the
    like never pass, and an ``article`` or ``main`` states what its text is, but for branches
    whose mark is confirmed. Elsewhere content importance decides, unless the page has stated its
    article: the rest then is none of it.
    """
    if role in (1, 2):
        return False
    if content:
        return not (role and low)
    return not (low or has_content)


def _pages(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    html = [h or "" for h in batch.column(batch.schema.get_field_index("html")).to_pylist()]
    at = chars = 0
    for i, h in enumerate(html):
        if i > at and chars + len(h) > SLICE_CHARS:
            yield batch.slice(at, i - at), html[at:i]
            at, chars = i, 0
        chars += len(h)
    if at < len(html):
        yield batch.slice(at), html[at:]


def _host(url: str | None) -> str:
    return re.split(r"[/?#]", url.partition("://")[2], maxsplit=1)[0].lower() if url else ""


def style_statistics(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(host, node, open, pages, contents, logs), and the same per node over all hosts.

    ``pages`` counts pages that hold the node, ``contents`` its distinct contents, ``logs`` the
    sum of ln(pages that hold a content); ``open`` is 1 for nodes that presentation leaves open, 2
    for those named as noise, 0 for decided ones.
    """
    schema = T.StructType([T.StructField("host", T.StringType()), T.StructField("node", T.LongType()),
                           T.StructField("open", T.IntegerType()), T.StructField("content", T.LongType()),
                           T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, html in _pages(batch):
                seen: Counter = Counter()
                hosts = [_host(u) for u in part.column(part.schema.get_field_index("url")).to_pylist()]
                for host, h in zip(hosts, html, strict=True):
                    own = {(node, _open(role, content), content_key(text)) for node, role, content, text in blocks(h) if role != 2}
                    seen.update((host, *x) for x in own)
                    seen.update((host, *x, None) for x in {x[:2] for x in own})  # the page itself
                cols = list(zip(*seen, strict=True)) if seen else [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.string()), pa.array([_signed(x) for x in cols[1]], pa.int64()), pa.array(cols[2], pa.int32()),
                     pa.array(cols[3], pa.int64()), pa.array(list(seen.values()), pa.int64())], names=schema.names)

    counts = cut(pages.mapInArrow(run, schema).groupBy("host", "node", "open", "content").agg(F.sum("n").alias("n")))

    def fold(*keys: str) -> DataFrame:
        per = counts.groupBy(*keys, "content").agg(F.sum("n").alias("n"))
        return per.groupBy(*keys).agg(
            F.max(F.when(F.col("content").isNull(), F.col("n"))).alias("pages"), F.count("content").alias("contents"),
            F.sum(F.when(F.col("content").isNotNull(), F.log(F.col("n").cast("double")))).alias("logs"))

    return fold("host", "node", "open"), fold("node", "open")


def low_nodes(pages: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(host, node) of the open style nodes whose importance is below the threshold."""
    host, everywhere = style_statistics(pages)

    def score(p: str) -> Column:
        n, c, logs = F.col(f"{p}pages"), F.col(f"{p}contents"), F.col(f"{p}logs")
        return F.when((n <= 1) | (c == 0), 1.0).otherwise(1.0 - logs / (c * F.log(n.cast("double"))))

    every = everywhere.where("open > 0").select("node", "open", *(F.col(c).alias(f"all_{c}") for c in ("pages", "contents", "logs")))
    drawn = (F.col("pages") * score("") + PRIOR_PAGES * score("all_")) / (F.col("pages") + PRIOR_PAGES)
    bound = F.when(F.col("open") == 2, float(max(threshold, NAMED_THRESHOLD))).otherwise(float(threshold))
    return cut(host.where("open > 0").join(every, ["node", "open"]).where(drawn < bound).select("host", "node").distinct())


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            threshold: float = THRESHOLD) -> DataFrame:
    """(page_id, url, text, n_chars) of each page; one parse for the statistics, one for the text."""
    src = pages.select(col(id_col).alias("page_id"), col(url_col).cast("string").alias("url"), col(html_col).alias("html"))
    low = low_nodes(src.select("url", "html"), threshold)
    sent = None
    if low.count() <= MAX_SENT_NODES:
        table: dict[str, set[int]] = {}
        for r in low.collect():
            table.setdefault(r.host, set()).add(r.node)
        sent = src.sparkSession.sparkContext.broadcast(table)
        rows = src.withColumn("low", F.lit(None).cast("array<bigint>"))
    else:
        host = F.lower(F.regexp_extract(F.regexp_extract("url", r"(?s)^.*?://(.*)$", 1), r"^([^/?#]*)", 1))
        # a host's pages are dealt to several tasks, each with the host's list
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        lists = low.groupBy("host").agg(F.collect_list("node").alias("low")).select("host", "low", salts)
        own = src.withColumns({"host": F.coalesce(host, F.lit("")), "salt": F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(SALTS)).cast("int")})
        rows = own.join(lists, ["host", "salt"], "left").drop("host", "salt")
    kind = [f for f in src.schema.fields if f.name != "html"]
    schema = T.StructType([*kind, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, html in _pages(batch):
                texts = []
                urls = part.column(part.schema.get_field_index("url")).to_pylist()
                lists = part.column(part.schema.get_field_index("low")).to_pylist()
                for url, h, own in zip(urls, html, lists, strict=True):
                    drop = sent.value.get(_host(url), ()) if sent is not None else set(own or ())
                    found = blocks(h)
                    stated = any(content and not role for _, role, content, _ in found)
                    texts.append(" ".join(t for node, role, content, t in found if kept(role, content, _signed(node) in drop, stated)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index("page_id")), part.column(part.schema.get_field_index("url")),
                     pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=schema.names)

    return rows.mapInArrow(run, schema)


def _open(role: int, content: bool) -> int:
    return {0: int(not content), 3: 1, 4: 2}.get(role, 0)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x
