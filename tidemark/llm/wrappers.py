"""Main text of pages by wrappers: regular expressions without unions, inferred for each host.

A page is a stream of tags and texts. Repeated runs are folded into groups, then the pages of a
host are aligned one after the other: texts that differ become slots, parts that some pages
lack become optional, and runs of different lengths one repeated group. What is left is the
host's wrapper. A wrapper says which texts all pages of a host share, which is its furniture,
and where the texts that vary lie.

A page is then read block by block. Blocks within furniture, by their tags and names or by
the wrapper, are left out, and so is what lies beside the part that holds the article. Within an
article a text is furniture if nearly all different pages of the host have it at one place of the
wrapper; in a bare body some pages suffice. Copies of a page are aligned once, so a page that was
copied often makes nothing furniture.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise
from tidemark.llm.warc import capture_key
from tidemark.session import broadcast_within

#: longest run of tokens that is looked for as a repeated group
GROUP = 16
#: different pages that must have a text at a place, all the same, before it counts as furniture
FURNITURE_PAGES = 8
#: within an article also this share of the host's different pages
FURNITURE_SHARE = 0.9
#: digests of different pages that are sent to all tasks, some 100 bytes each
MAX_BROADCAST_PAGES = 1_000_000
#: hosts a task holds before it sends their wrappers on, and parts the wrappers of a host are merged in first
HOSTS, SALTS = 256, 16

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(script|style|noscript|template|svg|iframe|textarea|select)\b"
    r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style|type)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: tags whose text is never the article's
NEVER = set("head title nav aside footer form button label fieldset dialog menu option input legend".split())
ROLES = set("navigation banner complementary contentinfo search form dialog alert alertdialog menu menubar".split())
#: classes and ids that name furniture: whole ones, also with a number or a common ending behind
NAMES = re.compile(
    r"(?:^|\s)(?:(?:site|page|main|top|bottom|left|right|global|post|article|user|reader|cookie|social|breaking)[-_])?(?:nav|navbar|navigation|menu|breadcrumbs?|header|masthead|footer|sidebar|side|aside|widget|rail|ads?|adv|advert\w*|"
    r"banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|social|"
    r"comments?|commentlist|disqus|replies|reply|respond|related|recommend\w*|more-links|pagination|pager|toolbar|skip|copyright|legal)"
    r"(?:[-_]?(?:\d+|bar|box|block|wrapper|container|area|section|list|links|menu|widget|banner|notice|form|inner|outer|content|slot|unit))*(?=$|\s)",
    re.I,
)
#: furniture that may stand in an article as its own part: a heading above it is the article's
HEADINGS = re.compile(r"(?:^|\s)(?:\w+[-_])?(?:header|masthead|banner)(?=$|\s)", re.I)
#: within an article a section or heading is judged by its classes only: its id names its subject
SUBJECTS = set("section h1 h2 h3 h4 h5 h6".split())


def tokens(page: str) -> list[tuple[str, str, str]]:
    """(kind, name, attributes or text): kind is "<" for a tag that opens, ">" for one that closes, "#" for a text."""
    out, at = [], 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            out.append(("#", "", page[at : m.start()]))
        at = m.end()
        if m[3]:
            out.append((">" if m[2] else "<", m[3].lower(), m[4]))
        elif m[0].startswith("<![CDATA["):
            out.append(("#", "", entities.escape(m[0][9:].removesuffix("]]>"))))
    if at < len(page):
        rest = page[at:]
        cut = re.search(r"<[a-zA-Z/!?][^<]*\Z", rest)  # a tag that never ends
        out.append(("#", "", rest[: cut.start()] if cut else rest))
    return out


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'").lower() for k, v in ATTRIBUTE.findall(text)} if text else {}


def squeeze(text: str) -> str:
    return " ".join(entities.unescape(text).split())


# ---- wrappers ----------------------------------------------------------------------
# A node is ["t", tag], ["#", text or None for a slot, pages], ["+", nodes] or ["?", nodes].


def _shape(node: list) -> str:
    if node[0] == "t":
        return node[1]
    if node[0] == "#":
        return "#"
    return node[0] + "(" + " ".join(map(_shape, node[1])) + ")"


def _fold(nodes: list[list]) -> list[list]:
    """Adjacent runs of equal shape become one repeated group."""
    shapes = [_shape(n) for n in nodes]
    for length in range(1, GROUP + 1):
        out, names, i = [], [], 0
        while i < len(nodes):
            run = shapes[i : i + length]
            n = 1
            while len(run) == length and shapes[i + n * length : i + (n + 1) * length] == run:
                n += 1
            if n > 1 and not (length == 1 and (run[0] == "#" or run[0][0] == "+")):
                group = ["+", [_slot(x) for x in nodes[i : i + length]]]
                out.append(group)
                names.append(_shape(group))
                i += n * length
            else:
                out.append(nodes[i])
                names.append(shapes[i])
                i += 1
        nodes, shapes = out, names
    return nodes


def _slot(node: list) -> list:
    """The node with its texts open."""
    if node[0] == "#":
        return ["#", None, node[2]]
    return node if node[0] == "t" else [node[0], [_slot(x) for x in node[1]]]


def page_nodes(page: str) -> list[list]:
    """A page as a wrapper of its own: its block tags, and the texts between them."""
    nodes: list[list] = []
    for kind, name, rest in tokens(page):
        if kind == "#":
            if text := squeeze(rest):
                if nodes and nodes[-1][0] == "#":
                    nodes[-1][1] += " " + text
                else:
                    nodes.append(["#", text, 1])
        elif name in BLOCKS and kind == "<":
            a = _attributes(rest)
            named = "".join(f".{x}" for x in (a.get("class", "") + " " + a.get("role", "")).split()[:3])
            nodes.append(["t", f"<{name}{named}>"])
        elif name in BLOCKS:
            nodes.append(["t", f"</{name}>"])
    return _fold(nodes)


def _items(nodes: list[list]) -> list[list[list]]:
    """A stretch in parts: one for each block that opens in it, and one for each group."""
    out: list[list[list]] = []
    for n in nodes:
        if n[0] in "?+" or not out or out[-1][0][0] in "?+" or n[0] == "t" and n[1][1] != "/":
            out.append([n])
        else:
            out[-1].append(n)
    return out


def _gather(nodes: list[list]) -> list[list]:
    """Neighbours that may lack or repeat, with one of them twice, become one group of all that may stand there.

    That keeps a wrapper as short as there are kinds of blocks on a site, whatever their order.
    """
    out: list[list] = []
    i = 0
    while i < len(nodes):
        to = i
        while to < len(nodes) and nodes[to][0] in "?+":
            to += 1
        parts: list[list[list]] = []
        for n in nodes[i:to]:
            while n[0] == "?" and len(n[1]) == 1 and n[1][0][0] in "?+":
                n = n[1][0]
            several = n[0] == "+" and all(x[0] == "?" for x in n[1])
            parts += [x[1] for x in n[1]] if several else [n[1]]
        by_shape: dict[str, list[list]] = {}
        for part in parts:
            name = " ".join(map(_shape, part))
            by_shape[name] = [_merge(x, y) for x, y in zip(by_shape[name], part)] if name in by_shape else part
        if to - i > 1 and len(by_shape) < len(parts):
            out.append(["+", [["?", part] for part in by_shape.values()]])
        else:
            out += nodes[i:to]
        out += nodes[to : to + 1]
        i = to + 1
    return out


def _merge(a: list, b: list) -> list:
    """Two nodes of the same shape, or a group and what it repeats."""
    if a[0] == "#":
        return ["#", a[1] if a[1] == b[1] else None, a[2] + b[2]]
    return a if a[0] == "t" else [a[0], [_merge(x, y) for x, y in zip(a[1], b[1])]]


def align(a: list[list], b: list[list]) -> list[list]:
    """The wrapper that both wrappers are cases of."""

    def core(node: list) -> str:  # an optional or repeated part aligns with the bare one
        while node[0] in "?+" and len(node[1]) == 1:
            node = node[1][0]
        return _shape(node) if node[0] not in "?+" else "(" + " ".join(map(_shape, node[1])) + ")"

    def bare(node: list) -> tuple[str, list]:
        marks = ""
        while node[0] in "?+" and len(node[1]) == 1 and node[1][0][0] in "?+":
            marks, node = marks + node[0], node[1][0]
        return marks, node

    names_a, names_b = [core(n) for n in a], [core(n) for n in b]
    out: list[list] = []
    for what, i, i_to, j, j_to in SequenceMatcher(None, names_a, names_b, autojunk=False).get_opcodes():
        if what == "equal":
            for x, y in zip(a[i:i_to], b[j:j_to]):
                (_, x), (_, y) = bare(x), bare(y)
                if x[0] == y[0] or x[0] not in "?+" and y[0] not in "?+":
                    out.append(_merge(x, y))
                else:  # one is bare, or one repeats where the other may lack
                    inner_x = x[1] if x[0] in "?+" else [x]
                    inner_y = y[1] if y[0] in "?+" else [y]
                    mark = "+" if "+" in (x[0], y[0]) else "?"
                    group = [mark, [_merge(p, q) for p, q in zip(inner_x, inner_y)]]
                    out.append(["?", [group]] if mark == "+" and "?" in (x[0], y[0]) else group)
        else:
            for part in _items(a[i:i_to]) + _items(b[j:j_to]):
                out.append(part[0] if part[0][0] == "?" else ["?", part])
    return _gather(_fold(out))


def furniture(nodes: list[list], least: int = FURNITURE_PAGES) -> set[str]:
    """Texts that at least ``least`` pages have at one place, none with another text there.

    None for a host whose pages vary nowhere: they are copies of one page.
    """
    fixed: set[str] = set()
    varying = False

    def walk(part: list[list]) -> None:
        nonlocal varying
        for n in part:
            if n[0] == "#" and n[2] >= least:
                varying |= n[1] is None
                fixed.update([n[1]] if n[1] is not None else [])
            elif n[0] in "?+":
                walk(n[1])

    walk(nodes)
    return fixed if varying else set()


def everywhere(nodes: list[list], pages: int, least: int = FURNITURE_PAGES, share: float = FURNITURE_SHARE) -> set[str]:
    """Texts that nearly all of a host's ``pages`` have at one place, which is no repeated group.

    None for a host with too few pages, or whose pages vary nowhere.
    """
    needed = max(least, share * pages)

    def walk(part: list[list]) -> Iterator[str]:
        for n in part:
            if n[0] == "#" and n[1] is not None and n[2] >= needed:
                yield n[1]
            elif n[0] == "?":
                yield from walk(n[1])

    return set(walk(nodes)) if furniture(nodes, least) else set()


def infer(pages: DataFrame) -> DataFrame:
    """``host``, ``wrapper`` (its nodes as JSON) and ``pages`` from all different pages of ``host`` and ``html``.

    Of equal pages of a host the one with the least ``url`` is aligned, where there is such a column.
    """

    def joined(rows: Iterator[tuple[str, str | None]]) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = {}
        salt = TaskContext.get().partitionId() % SALTS

        def sent() -> pd.DataFrame:
            out = [(h, salt, json.dumps(w), n) for h, (w, n) in held.items()]
            held.clear()
            return pd.DataFrame(out, columns=["host", "salt", "wrapper", "pages"])

        met: set[tuple[str, int]] = set()
        for host, page in rows:
            if (host, hash(page)) in met:  # a row that came twice
                continue
            met.add((host, hash(page)))
            nodes = page_nodes(page or "")
            held[host] = [align(held[host][0], nodes), held[host][1] + 1] if host in held else [nodes, 1]
            if len(held) >= HOSTS:
                yield sent()
        if held:
            yield sent()

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from joined((h, p) for b in batches for h, p in zip(b["host"], b["html"]))

    def again(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("wrapper")  # arrival has no order
        wrapper = json.loads(b["wrapper"].iloc[0])
        for w in b["wrapper"].iloc[1:]:
            wrapper = align(wrapper, json.loads(w))
        return pd.DataFrame({"host": [b["host"].iloc[0]], "wrapper": [json.dumps(wrapper)], "pages": [b["pages"].sum()]})

    # of copies those with the least address stay; what they have in common is not moved for it
    marked = pages.select("host", "html", (F.coalesce("url", F.lit("")) if "url" in pages.columns else F.lit("")).alias("address"), F.xxhash64("html").alias("a"), F.hash("html").alias("b"))
    one = materialise(marked.groupBy("host", "a", "b").agg(F.min("address").alias("address")), "different-pages")
    marked = marked.join(broadcast_within(one, MAX_BROADCAST_PAGES), ["host", "a", "b", "address"], "left_semi")
    parts = marked.select("host", "html").mapInPandas(first, "host string, salt int, wrapper string, pages long")
    parts = parts.groupBy("host", "salt").applyInPandas(again, "host string, wrapper string, pages long")
    return parts.groupBy("host").applyInPandas(again, "host string, wrapper string, pages long")


# ---- reading -----------------------------------------------------------------------


def _excluded(name: str, rest: str, within_article: bool) -> bool:
    if name in NEVER or name == "header" and not within_article:
        return True
    a = _attributes(rest)
    if not a or name in ("body", "html", "article", "main"):
        return False
    if "hidden" in a or a.get("aria-hidden") == "true" or re.search(r"display:\s*none", a.get("style", "")):
        return True
    names = a.get("class", "") if within_article and name in SUBJECTS else f"{a.get('class', '')} {a.get('id', '')}"
    if within_article:
        names = HEADINGS.sub(" ", names)
    return a.get("role") in ROLES or bool(NAMES.search(names))


def main_text(page: str | None, known: frozenset[str] | set[str] = frozenset(), everywhere: frozenset[str] | set[str] = frozenset()) -> str:
    """The blocks of the article, joined by an empty line.

    The article is what lies in ``article``, else in ``main`` or a part with that role, else the
    whole body. Tags and names tell furniture anywhere. ``known``, what the wrapper found on several pages
    of the host, is left out of a bare body only, since an article's own words may be on some pages;
    ``everywhere``, what it found on nearly all, is left out of articles too, unless nothing else is there.
    The empty text for a page without an article.
    """
    blocks: list[tuple[int, str]] = []  # (2 in an article, 1 in a main part, 0 elsewhere; text)
    open_: list[tuple[str, bool, int]] = []  # (tag, excluded, rank)
    now: list[str] = []

    def state() -> tuple[bool, int]:
        return (open_[-1][1], open_[-1][2]) if open_ else (False, 0)

    def flush() -> None:
        excluded, rank = state()
        if now and not excluded and (text := squeeze("".join(now))) and (rank or text not in known):
            blocks.append((rank, text))
        now.clear()

    for kind, name, rest in tokens(page or ""):
        if kind == "#":
            if not state()[0]:
                now.append(rest)
            continue
        if name == "br":
            now.append(" ")
            continue
        excluded, rank = state()
        if name in BLOCKS:
            flush()
        if kind == ">":
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] == name:
                    # inline tags left open inside don't hold; nothing closes past the article but itself
                    del open_[i:]
                    break
                if open_[i][0] in ("article", "main", "body", "nav", "aside", "footer", "td") and name not in ("body", "html", "article", "main", "nav", "aside", "footer", "table", "div", "section"):
                    break
            continue
        if name in VOID or rest.rstrip().endswith("/") and name not in BLOCKS:
            continue
        if name in BLOCKS:  # a block ends the paragraph it stands in, with all inline tags left open in it
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] == "p" or name in ("li", "dt", "dd", "td", "th", "tr") and open_[i][0] in ((name,) if name in ("li", "td", "th", "tr") else ("dt", "dd")):
                    del open_[i:]
                    break
                if open_[i][0] in BLOCKS:
                    break
            excluded, rank = state()
        out = _excluded(name, rest, rank == 2)
        was = excluded
        if name == "article" and not was:
            rank = 2
        elif (name == "main" or "role" in rest and _attributes(rest).get("role") == "main") and rank < 2:
            rank = 1
        open_.append((name, was or out, rank))
    flush()
    best = max((r for r, _ in blocks), default=0)
    found = [t for r, t in blocks if r == best]
    return "\n\n".join([t for t in found if t not in everywhere] or found)


def extract(pages: DataFrame, least: int = FURNITURE_PAGES, share: float = FURNITURE_SHARE) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row of ``page_id``, ``url`` and ``html``.

    White space inside a block is one space, blocks are trimmed and joined by an empty line in
    page order. Furniture of the same shape as the article's blocks and right beside them folds into one group
    with these, so only tags and names can tell it. A null or empty html gives the empty text. Pages with a null url, or one without
    a host, share a wrapper. Other columns are ignored; repeated rows repeat. An empty table
    gives no rows.
    """
    host = F.pandas_udf(lambda urls: urls.map(lambda u: capture_key(u).partition(")")[0], na_action=None), "string")
    pages = pages.select("page_id", "url", "html")
    # One pass over the pages ends in wrappers; only their furniture goes back to the pages.
    found = materialise(infer(pages.withColumn("host", host("url"))), "wrappers")

    def shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            wrappers = [json.loads(w) for w in b["wrapper"]]
            known = [sorted(furniture(w, least)) for w in wrappers]
            yield pd.DataFrame({"host": b["host"], "known": known, "anywhere": [sorted(everywhere(w, n, least, share)) for w, n in zip(wrappers, b["pages"])]})

    known = found.mapInPandas(shared, "host string, known array<string>, anywhere array<string>").where(F.size("known") > 0)
    known = materialise(known, "furniture")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sets = ([frozenset(x) if x is not None else frozenset() for x in b[c]] for c in ("known", "anywhere"))
            texts = [main_text(p, k, e) for p, k, e in zip(b["html"], *sets)]
            yield b[["page_id", "url"]].assign(text=texts, n_chars=[len(t) for t in texts])

    # ids travel as text: in pandas numbers beside a null are floats
    id_type = pages.schema["page_id"].dataType
    joined = pages.withColumn("host", host("url")).join(known, "host", "left").select(F.col("page_id").cast("string"), "url", "html", "known", "anywhere")
    texts = joined.mapInPandas(read, "page_id string, url string, text string, n_chars long")
    return texts.withColumn("page_id", F.col("page_id").cast(id_type))
