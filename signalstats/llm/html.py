"""Main text of web pages by wrapper induction over the pages of a host."""

from __future__ import annotations

import functools
import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalstats.llm.common import pieces, stored

_RAW = "script|style|template|textarea|iframe|svg"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})\b.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*>"
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9-]*)(?P<attributes>(?:[^<>"']|"[^"]*"|'[^']*')*)>""",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_BLOCKS = frozenset(
    "html head title body nav header footer aside main article section div form fieldset menu dialog button select "
    "option p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre address "
    "figure figcaption details summary hr".split()
)
_HOLLOW = frozenset(("hr",))
#: A start tag ends open elements of these kinds, up to the nearest of the second.
_ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table", "thead", "tbody", "tfoot")),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
#: Parts of a page that are never article text, by tag and by names in class, id or role.
_ASIDE_TAGS = frozenset("head nav footer aside form fieldset menu dialog button select".split())
_ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo nav navigation navbar menu menubar breadcrumb "
    "breadcrumbs sidebar footer cookie cookies consent notice notices banner popup modal newsletter subscribe login "
    "search share sharing social related comment comments commentlist disqus respond reply replies pagination pager".split()
)
#: First words of names that tell of a state, and last words that tell of a part of what is named before.
_STATE_WORDS = frozenset("has no not is with without".split())
_PART_WORDS = frozenset(
    "area bar block body box button buttons container content form group holder inner item items link links list "
    "outer panel row section slot text title toggle widget widgets wrap wrapper".split()
)
_HEADING_WORDS = frozenset(("header", "masthead"))
#: Their ids are often made from their own words.
_TITLES = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements of running text; inside an article they are text even where all pages agree.
_RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th figcaption".split())


@dataclass
class Tree:
    """A page's block elements; like-labelled children of one parent are one node."""

    labels: list[str] = field(default_factory=lambda: [""])
    parents: list[int] = field(default_factory=lambda: [-1])
    children: list[dict[str, int]] = field(default_factory=lambda: [{}])

    def child(self, node: int, label: str) -> int:
        found = self.children[node].get(label)
        if found is None:
            found = self.children[node][label] = len(self.labels)
            self.labels.append(label)
            self.parents.append(node)
            self.children.append({})
        return found

    def text(self) -> str:
        """The tree on one line; :func:`tree` reads it."""
        return "\n".join(f"{p} {label}" for p, label in zip(self.parents[1:], self.labels[1:], strict=True))


@functools.lru_cache(4096)
def tree(text: str) -> Tree:
    found = Tree()
    for line in text.split("\n") if text else ():
        parent, label = line.split(" ", 1)
        found.child(int(parent), label)
    return found


@functools.lru_cache(4096)
def _label(tag: str, attributes: str) -> str:
    names = set()
    for m in _ATTRIBUTE.finditer(attributes):
        for name in (m[2] or m[3] or m[4] or "").lower().split():
            names.add("-".join(re.findall("[a-z]+", name)))
    return ".".join([tag, *sorted(names - {""})])


def parse(page: str) -> tuple[Tree, list[tuple[int, str]]]:
    """The tree and the blocks of text in page order: node, text in one line."""
    found, blocks = Tree(), []
    stack: list[tuple[str, int]] = [("", 0)]
    held: list[str] = []

    def flush() -> None:
        if held:
            text = "".join(held)
            held.clear()
            if "&" in text:
                text = entities.unescape(text)
            text = " ".join(text.split())
            if text:
                blocks.append((stack[-1][1], text))

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in _BLOCKS:
            if tag == "br":
                held.append("\n")
            continue
        if m["end"]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    flush()
                    del stack[depth:]
                    break
            continue
        flush()
        if stack[-1][0] == "p":
            stack.pop()
        own, scope = _ENDS.get(tag, ((), ()))
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in scope:
                break
            if stack[depth][0] in own:
                del stack[depth:]
                break
        if tag not in _HOLLOW:
            stack.append((tag, found.child(stack[-1][1], _label(tag, m["attributes"]))))
    held.append(page[at:])
    flush()
    return found, blocks


def _head(name: str) -> str:
    """The word that says what is named: ``notice`` of ``cookie-notice``, ``share`` of ``share-buttons``."""
    words = name.split("-")
    if words[0] in _STATE_WORDS:
        return ""
    while len(words) > 1 and words[-1] in _PART_WORDS:
        words.pop()
    return words[-1]


def _is_aside(label: str, in_article: bool, needed: bool) -> bool:
    tag, *names = label.split(".")
    if tag in _ASIDE_TAGS:
        return True
    if tag in ("html", "body", "main") or tag in _TITLES or needed:
        return False
    if tag in _RUNNING and in_article:
        return bool(_ASIDE_WORDS.intersection(names))
    if tag == "article":
        return bool(_ASIDE_WORDS.intersection(names))
    heads = set(map(_head, names))
    if _ASIDE_WORDS & heads:
        return True
    return not in_article and (tag == "header" or bool(_HEADING_WORDS & heads))


def _is_article(label: str) -> bool:
    tag, *names = label.split(".")
    if tag in ("article", "main"):
        return tag == "main" or not _ASIDE_WORDS.intersection(names)
    words = {word for name in names for word in name.split("-")}
    return "main" in words and not _ASIDE_WORDS & words


def _needed(found: Tree) -> list[bool]:
    """Whether a node holds a main element or all articles of the page, other than comments."""
    mains, articles = [0] * len(found.labels), [0] * len(found.labels)
    for i in range(len(found.labels) - 1, 0, -1):
        tag, *names = found.labels[i].split(".")
        p = found.parents[i]
        mains[p] += mains[i] + (tag == "main")
        articles[p] += articles[i] + (tag == "article" and not _ASIDE_WORDS.intersection(map(_head, names)))
    return [mains[i] > 0 or 0 < articles[i] == articles[0] for i in range(len(mains))]


@functools.lru_cache(4096)
def _roles(text: str) -> tuple[frozenset[int], frozenset[int]]:
    """Nodes that may hold article text, and those of them that constant text does not exclude."""
    found = tree(text)
    aside, article, needed = [False], [False], _needed(found)
    for i in range(1, len(found.labels)):
        p = found.parents[i]
        inside = article[p]
        aside.append(aside[p] or _is_aside(found.labels[i], inside, needed[i]))
        article.append(inside or (not aside[-1] and _is_article(found.labels[i])))
    named = any(article)
    kept = frozenset(i for i in range(len(aside)) if not aside[i] and (article[i] or not named))
    return kept, frozenset(i for i in kept if article[i] and found.labels[i].split(".")[0] in _RUNNING)


def _best_increasing(places: list[int], weights: list[int], width: int) -> tuple[int, list[int]]:
    """The heaviest choice of numbers whose places increase: its weight and members."""
    best, last = [0] * (width + 1), [-1] * (width + 1)
    total, before = [0] * len(places), [-1] * len(places)
    for i, (place, weight) in enumerate(zip(places, weights, strict=True)):
        at, top, member = place, 0, -1
        while at > 0:  # the best of all smaller places, by sums over powers of two
            if best[at] > top:
                top, member = best[at], last[at]
            at &= at - 1
        total[i], before[i] = top + weight, member
        at = place + 1
        while at <= width:
            if total[i] > best[at]:
                best[at], last[at] = total[i], i
            at += at & -at
    i = max(range(len(places)), key=total.__getitem__, default=-1)
    weight, chosen = (total[i], []) if places else (0, [])
    while i >= 0:
        chosen.append(i)
        i = before[i]
    return weight, chosen[::-1]


def tree_match(a: Tree, b: Tree) -> dict[int, int]:
    """Simple tree matching: the largest order-preserving map of nodes of ``a`` to nodes
    of ``b`` with equal labels and mapped parents.

    Children of a node have different labels, so a child has one candidate at most: the
    pairs form a tree, walked without recursion, and the children of a pair are aligned in
    ``k log k`` steps.
    """
    pairs, parts = [(0, 0)], [[]]
    at = 0
    while at < len(pairs):
        x, y = pairs[at]
        others = b.children[y]
        for label, u in a.children[x].items():
            if label in others:
                parts[at].append(len(pairs))
                pairs.append((u, others[label]))
                parts.append([])
        at += 1
    size, kept = [1] * len(pairs), [[] for _ in pairs]
    for at in range(len(pairs) - 1, -1, -1):
        if parts[at]:
            order = {v: i for i, v in enumerate(b.children[pairs[at][1]].values())}
            places = [order[pairs[c][1]] for c in parts[at]]
            weight, chosen = _best_increasing(places, [size[c] for c in parts[at]], len(order))
            size[at] += weight
            kept[at] = [parts[at][i] for i in chosen]
    found, waiting = {}, [0]
    while waiting:
        at = waiting.pop()
        found[pairs[at][0]] = pairs[at][1]
        waiting += kept[at]
    return found


def _key(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - 2**63


def _host(url: str | None) -> str:
    m = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?(?:www\.)?([^/?#:]+)", url or "")
    return m[1].lower() if m else ""


def _skeletons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page the host, the tree and of every node with text its hash and length, and the
    hashes of its blocks if it has several."""
    fields = [("node", pa.int32()), ("h", pa.int64()), ("chars", pa.int64()), ("blocks", pa.list_(pa.int64()))]
    kind = pa.list_(pa.struct(fields))
    for piece in pieces(batches, "html"):
        hosts, trees, nodes = [], [], []
        for url, page in zip(piece.column("url").to_pylist(), piece.column("html").to_pylist(), strict=True):
            found, blocks = parse(page or "")
            texts: dict[int, list[str]] = {}
            for node, text in blocks:
                texts.setdefault(node, []).append(text)
            hosts.append(_key(_host(url)))
            trees.append(found.text())
            nodes.append(
                [
                    {
                        "node": node,
                        "h": _key("\n".join(own)),
                        "chars": sum(map(len, own)),
                        "blocks": sorted(set(map(_key, own))) if len(own) > 1 else [],
                    }
                    for node, own in texts.items()
                ]
            )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(hosts, pa.int64()),
                pa.array([_key(t) for t in trees], pa.int64()),
                pa.array(trees, pa.string()),
                pa.array(nodes, kind),
            ],
            ["host", "skeleton", "tree", "nodes"],
        )


@functools.lru_cache(4096)
def _aligned_pair(own: str, reference: str) -> tuple[list[int], list[int]]:
    found = tree_match(tree(own), tree(reference))
    return list(found), list(found.values())


def _alignments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of each tree and the nodes of the host's reference tree that they match."""
    for batch in batches:
        hosts, skeletons, nodes, slots = [], [], [], []
        columns = (batch.column(c).to_pylist() for c in ("host", "skeleton", "tree", "reference"))
        for host, skeleton, own, reference in zip(*columns, strict=True):
            left, right = _aligned_pair(own, reference)
            hosts += [host] * len(left)
            skeletons += [skeleton] * len(left)
            nodes += left
            slots += right
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(x, pa.int64()) for x in (hosts, skeletons)), *(pa.array(x, pa.int32()) for x in (nodes, slots))],
            ["host", "skeleton", "node", "slot"],
        )


def induce_wrappers(pages: DataFrame, min_pages: int = 4, min_percent: int = 60) -> DataFrame:
    """Rows ``(host, skeleton, template, constant)``: for a host's pages with one tree the
    nodes that hold template text, and of other nodes the blocks (node and hash) that are
    template. Trees without either have no row.

    Every page counts. The host's most frequent tree is its reference; every other
    tree of the host is aligned with it by simple tree matching, once per tree and
    not per page. A slot (matched node) whose text is the same on ``min_percent`` % of
    the host's pages, ``min_pages`` at least, is template; the slot with the most text
    never is. Like-labelled siblings share a slot; where such a slot varies as a whole, the
    siblings are aligned by equal text, and those that recur on as many pages are template.
    """
    seen = stored(
        pages.select("url", "html").mapInArrow(
            _skeletons,
            "host bigint, skeleton bigint, tree string, "
            "nodes array<struct<node:int,h:bigint,chars:bigint,blocks:array<bigint>>>",
        ),
        "page-trees",
    )
    trees = stored(
        seen.groupBy("host", "skeleton").agg(F.count("*").alias("n"), F.first("tree").alias("tree")), "host-trees"
    )
    hosts = trees.groupBy("host").agg(
        F.sum("n").alias("pages"), F.max_by("tree", F.struct("n", "skeleton")).alias("reference")
    ).where(F.col("pages") >= min_pages)
    aligned = stored(
        trees.join(hosts, "host")
        .select("host", "skeleton", "tree", "reference")
        .mapInArrow(_alignments, "host bigint, skeleton bigint, node int, slot int"),
        "aligned-trees",
    )
    texts = stored(
        seen.select("host", "skeleton", F.explode("nodes").alias("x"))
        .groupBy("host", "skeleton", "x.node", "x.h")
        .agg(F.count("*").alias("n"), F.sum("x.chars").alias("chars")),
        "node-texts",
    )
    slots = (
        texts.join(aligned, ["host", "skeleton", "node"])
        .groupBy("host", "slot", "h")
        .agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"))
        .groupBy("host", "slot")
        .agg(F.max("n").alias("top"), F.sum("chars").alias("chars"))
    )
    bodies = slots.groupBy("host").agg(F.max_by("slot", F.struct("chars", "slot")).alias("body"))
    template = (
        slots.join(hosts.select("host", "pages"), "host")
        .join(bodies, "host")
        .where((100 * F.col("top") >= min_percent * F.col("pages")) & (F.col("slot") != F.col("body")))
        .select("host", "slot")
    )
    blocks = (
        seen.select("host", "skeleton", F.explode("nodes").alias("x"))
        .select("host", "skeleton", "x.node", F.explode("x.blocks").alias("block"))
        .groupBy("host", "skeleton", "node", "block")
        .agg(F.count("*").alias("n"))
        .join(aligned, ["host", "skeleton", "node"])
        .groupBy("host", "slot", "block")
        .agg(F.sum("n").alias("n"))
        .join(hosts.select("host", "pages"), "host")
        .where(100 * F.col("n") >= min_percent * F.col("pages"))
        .join(slots.select("host", "slot", "top"), ["host", "slot"])
        .where(100 * F.col("top") < min_percent * F.col("pages"))
        .select("host", "slot", "block")
    )
    whole = (
        aligned.join(template, ["host", "slot"])
        .groupBy("host", "skeleton")
        .agg(F.sort_array(F.collect_set("node")).alias("template"))
    )
    parts = (
        aligned.join(blocks, ["host", "slot"])
        .groupBy("host", "skeleton")
        .agg(F.sort_array(F.collect_set(F.struct("node", "block"))).alias("constant"))
    )
    return whole.join(parts, ["host", "skeleton"], "full")


def _text(
    blocks: list[tuple[int, str]], own: str, template: set[int], constant: frozenset[tuple[int, int]] = frozenset()
) -> str:
    kept, running = _roles(own)
    dropped = template - running
    some = {node for node, _ in constant} - running
    return "\n".join(
        text
        for node, text in blocks
        if node in kept and node not in dropped and not (node in some and (node, _key(text)) in constant)
    )


def _pairs(constant: list | None) -> frozenset[tuple[int, int]]:
    return frozenset((c["node"], c["block"]) for c in constant or ())


def _extracted(wrappers):
    """Adds ``text``; templates come from a broadcast, or from a column if there is none."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = wrappers.value if wrappers is not None else None
        for piece in pieces(batches, "html"):
            texts = []
            names = ("url", "html", "template", "constant") if known is None else ("url", "html")
            columns = [piece.column(c).to_pylist() for c in names]
            for url, page, *wrapper in zip(*columns, strict=True):
                found, blocks = parse(page or "")
                own = found.text()
                if known is not None:
                    wrapper = known.get((_key(_host(url)), _key(own)), (None, frozenset()))
                template, constant = wrapper
                constant = constant if known is not None else _pairs(constant)
                texts.append(_text(blocks, own, set(template or ()), constant))
            yield pa.RecordBatch.from_arrays(
                [piece.column("page_id"), piece.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    return rows


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, "html"):
        columns = zip(piece.column("url").to_pylist(), piece.column("html").to_pylist(), strict=True)
        keys = [(_key(_host(url)), _key(parse(page or "")[0].text())) for url, page in columns]
        yield pa.RecordBatch.from_arrays(
            [*piece.columns, pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64())],
            [*piece.schema.names, "host", "skeleton"],
        )


def extract_text(pages: DataFrame, max_broadcast_rows: int = 100_000, **induction: int) -> DataFrame:
    """One row per row of ``pages`` (``page_id, url, html``): ``page_id, url, text, n_chars``.

    The page's block elements form a tree. Menus, headers, footers, sidebars, notices,
    adverts, forms and reader comments are known by their tags and the head words of the
    names in their class, id or role, an article and running text in it by whole names
    only; headings, main elements and what holds one, or all articles of the page, are kept
    whatever their names. Where the page has an article or main element, text outside it
    is left out. What the host's wrapper (:func:`induce_wrappers`) calls template is
    left out too, whole nodes and single blocks, except for running text of an article: an
    article that a host shows on many pages stays. Character references are decoded, white space in a block
    becomes one space, and the blocks are joined by line feeds in page order.

    Null or empty html: empty text. Null url: the host ''. Unclosed elements end with
    their parents or the page. Pages are judged one by one, so repeated rows and null
    ids do not matter. Other columns are not used.

    Pages are read twice and not shuffled, as long as the wrappers that leave
    something out are at most ``max_broadcast_rows`` with ten times as many nodes and
    blocks; more of them are joined to the pages by host and tree.
    """
    spark = pages.sparkSession
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    wrappers = stored(induce_wrappers(pages, **induction), "wrappers")
    schema = T.StructType(
        [
            T.StructField("page_id", T.LongType()),
            T.StructField("url", T.StringType()),
            T.StructField("text", T.StringType()),
        ]
    )
    entries = F.coalesce(F.size("template"), F.lit(0)) + F.coalesce(F.size("constant"), F.lit(0))
    size = wrappers.agg(F.count("*").alias("n"), F.sum(entries).alias("entries")).first()
    if size.n <= max_broadcast_rows and (size.entries or 0) <= 10 * max_broadcast_rows:
        known = spark.sparkContext.broadcast(
            {(r.host, r.skeleton): (r.template, _pairs(r.constant)) for r in wrappers.collect()}
        )
        found = pages.mapInArrow(_extracted(known), schema)
    else:
        keyed = pages.mapInArrow(
            _keyed, "page_id bigint, url string, html string, host bigint, skeleton bigint"
        )
        found = keyed.join(wrappers, ["host", "skeleton"], "left").mapInArrow(_extracted(None), schema)
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
