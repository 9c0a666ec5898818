"""Main text of web pages by wrappers: union-free regular expressions inferred per host.

Pages of one host come from few templates. A page is a stream of open tags, close tags and
texts; runs that repeat are folded into repeated groups. The distinct streams of a host are
aligned with the wrapper so far: what both have in the same containers stays, what only one
has becomes an optional group, and a text becomes a slot. All streams count, whole: those
of a large host are aligned in parts, and the wrappers of the parts with one another. So the
wrapper matches every page and names the places of all texts (their path of containers); a
place is content or not by its containers, and on pages without an article by whether its
text differs between such pages of the host.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from riskweave.session import materialize

#: Bound on the distinct streams per host that a wrapper is inferred from, the most frequent
#: first; by default there is none. Labels of places outside an article come from all pages
#: of the host that have none in any case.
STREAMS_PER_HOST: int | None = None
#: Streams, or wrappers of parts of a host, that are aligned in one place.
ALIGNED = 64
#: Cells of an alignment whose rows of bits are kept; larger ones are halved.
KEPT_CELLS = 1 << 28
#: Wrappers up to this many hosts are broadcast; more are joined by shuffle.
BROADCAST_HOSTS = 5_000

# --- fixed values: HTML names and what pages call the parts around an article ---------
RAW = ("script", "style", "noscript", "template", "textarea", "svg", "iframe", "object", "math")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "wbr")
BLOCKS = (
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog",
    "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5",
    "h6", "head", "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre",
    "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul",
)
#: Elements that a following one of the same kind, or a larger block, ends.
SELF_ENDING = ("p", "li", "dt", "dd", "tr", "td", "th", "option")
NOT_CONTENT = (
    "head", "title", "nav", "menu", "aside", "footer", "form", "button", "select", "dialog", "label",
)
ARTICLE = ("article", "main")
PART_WORDS = (
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo",
    "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal",
    "newsletter", "subscribe", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs",
    "sidebar", "footer", "comment", "comments", "reply", "replies", "disqus", "share", "sharing", "social",
    "related", "search", "login", "pagination", "pager", "header", "masthead", "widget", "toolbar",
)
#: What may stand beside one of them in a name such as ``related-posts``.
BESIDE_PARTS = (
    "container", "wrapper", "wrap", "box", "block", "section", "area", "bar", "list", "item", "items",
    "link", "links", "button", "buttons", "btn", "post", "posts", "article", "articles", "entry", "site",
    "page", "main", "top", "bottom", "left", "right", "inline", "unit", "slot", "title", "body", "text",
    "content", "form", "signup", "icon", "icons", "media", "tools", "inner", "outer", "primary",
    "secondary", "global", "mobile", "desktop", "thread", "reader", "user", "author", "meta", "policy",
)
#: Elements that hold a piece of text, not a part of the page.
TEXT_ELEMENTS = ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dd", "dt", "td", "th", "pre", "blockquote", "span")
PART_ROLES = ("navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "form")
# ---------------------------------------------------------------------------------------

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW)})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(?P<end>/?>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PARTS, _ROLES = frozenset(PART_WORDS), frozenset(PART_ROLES)
#: An article's own header is part of it.
_PARTS_INSIDE = _PARTS - {"header", "masthead"}
_BESIDE = _PARTS | frozenset(BESIDE_PARTS)


def _is_part(tag: str, attrs: str, inside: bool) -> bool:
    """Whether class, id or role name a part around the article.

    Inside an article, and on an element of text, a name counts only as a whole: its words
    are those of parts and of what stands beside them, so ``related-posts`` is a part and
    ``share-price`` and ``ad-hoc`` are not. On other elements one such word is enough.
    """
    whole = inside or tag in TEXT_ELEMENTS
    parts = _PARTS_INSIDE if whole else _PARTS
    for kind, *values in _ATTRIBUTE.findall(attrs):
        value = "".join(values).lower()
        if kind.lower() == "role":
            if value.strip() in _ROLES:
                return True
            continue
        for name in value.split():
            words = [w for w in re.split(r"[^a-z0-9]+", name) if w]
            if not parts.isdisjoint(words):
                if not whole or all(w in _BESIDE or w.isdigit() for w in words):
                    return True
    return False


#: Containers that a path spells out; deeper ones are one digest of all that follow.
DEEP = 64


@dataclass(frozen=True)
class Place:
    """A chain of open containers, in bounded space however deep it is.

    Beyond ``DEEP`` shapes only a digest goes on, with what decides about content: whether
    an article began (``article``) and whether a part that is not content did (``~!``).
    """

    path: str = ""
    depth: int = 0
    deep: int = 0
    inside: bool = False
    dropped: bool = False

    def into(self, shape: str) -> Place:
        name = shape.rstrip("!")
        dropped = self.dropped or _drops(shape, self.inside)
        inside = self.inside or name in ARTICLE
        if self.depth < DEEP:
            path = f"{self.path}/{shape}" if self.depth else shape
            return Place(path, self.depth + 1, 0, inside, dropped)
        return Place(self.path, self.depth + 1, hash_text(f"{self.deep}/{shape}"), inside, dropped)

    def __str__(self) -> str:
        if self.depth <= DEEP:
            return self.path
        flags = "/article" * self.inside + "/~!" * self.dropped
        return f"{self.path}/~{self.deep & 0xFFFFFFFFFFFFFFFF:x}{flags}"


@dataclass(frozen=True)
class Block:
    path: str
    text: str


def blocks(page: str) -> tuple[list[Block], list[str]]:
    """The text blocks of a page in order, and its stream of container tags and texts.

    A path is the open containers; ``!`` marks one whose attributes name a part around the
    article. Character references are decoded after the tags are gone, white space becomes
    one space, and blocks without text are left out.
    """
    out: list[Block] = []
    stream: list[str] = []
    stack: list[tuple[str, str, Place]] = []
    opened: dict[str, list[int]] = {}
    held: list[str] = []
    outside = Place()

    def flush() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append(Block(str(stack[-1][2] if stack else outside), text))
            stream.append("#")

    def close(at: int) -> None:
        flush()
        while len(stack) > at:
            name, shape, _ = stack.pop()
            opened[name].pop()
            stream.append(f"</{shape}>")

    done = 0
    for token in _TOKEN.finditer(page):
        held.append(page[done : token.start()])
        done = token.end()
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            held.append(" ")
        place = stack[-1][2] if stack else outside
        part = not token["close"] and _is_part(tag, token["attrs"], place.inside)
        if token["close"]:
            if opened.get(tag):
                close(opened[tag][-1])
            elif tag in _BLOCK_SET:
                flush()
        elif tag in _BLOCK_SET or part or tag in NOT_CONTENT:
            flush()
            if tag in _BLOCK_SET and stack and stack[-1][0] in SELF_ENDING:
                inner = stack[-1][0]
                if inner == tag or inner == "p":
                    close(len(stack) - 1)
            if tag not in VOID and token["end"] != "/>":
                shape = tag + "!" * part
                place = stack[-1][2] if stack else outside
                opened.setdefault(tag, []).append(len(stack))
                stack.append((tag, shape, place.into(shape)))
                stream.append(f"<{shape}>")
    rest = page[done:]
    held.append(rest)
    close(0)
    return out, stream


_BLOCK_SET = frozenset(BLOCKS)


def _drops(shape: str, inside: bool) -> bool:
    name = shape.rstrip("!")
    if shape.endswith("!") and name not in ("html", "body", *ARTICLE):
        return True
    return name in NOT_CONTENT or (name == "header" and not inside)


def is_boilerplate(path: str) -> bool:
    """Whether a container on the path is not content: a menu, an advert, comments and so on.

    A header outside an article is the page's; inside, it belongs to the article.
    """
    inside = False
    for shape in path.split("/"):
        if _drops(shape, inside):
            return True
        inside = inside or shape.rstrip("!") in ARTICLE
    return False


def in_article(path: str) -> bool:
    return any(shape.rstrip("!") in ARTICLE for shape in path.split("/"))


# A wrapper is a list of nodes: a token, ("?", nodes) or ("+", nodes).
Node = str | tuple[str, list]


def fold(stream: list[Node], longest: int = 12) -> list[Node]:
    """Adjacent equal runs folded into repeated groups, short runs first."""
    out = list(stream)
    for size in range(1, longest + 1):
        before, out, at = out, [], 0
        while at < len(before):
            body, end = before[at : at + size], at + size
            while end < len(before) and before[end : end + size] == body:
                end += size
            if end > at + size and _balanced(body):
                out.append(body[0] if size == 1 and _is_group(body[0]) else ("+", body))
                at = end
            else:
                out.append(before[at])
                at += 1
    return out


def _is_group(node: Node) -> bool:
    return isinstance(node, tuple)


def _balanced(body: list[Node]) -> bool:
    """Whether every tag opened in the run is closed in it."""
    depth = 0
    for node in body:
        if isinstance(node, str) and node.startswith("</"):
            depth -= 1
        elif isinstance(node, str) and node.startswith("<"):
            depth += 1
        if depth < 0:
            return False
    return depth == 0


def _flat(nodes: list[Node]) -> list[tuple[Node, int | None]]:
    """The nodes with those of optional groups one by one, and the group of each."""
    out: list[tuple[Node, int | None]] = []
    for k, node in enumerate(nodes):
        inside = _is_group(node) and node[0] == "?"
        out += [(x, k) for x in node[1]] if inside else [(node, None)]
    return out


def _generalise(flat: list, other: list) -> list:
    """Single runs that the other side knows as repeated groups, folded as such."""
    bodies = {json.dumps(n): n[1] for n, _ in other if _is_group(n)}
    for body in bodies.values():
        before, flat, at = flat, [], 0
        while at < len(before):
            run = before[at : at + len(body)] if before[at][0] == body[0] else []
            if [n for n, _ in run] == body and len({group for _, group in run}) == 1:
                flat.append((("+", body), run[0][1]))
                at += len(body)
            else:
                flat.append(before[at])
                at += 1
    return flat


def _keys(flat: list) -> list[tuple[str, str]]:
    """What is aligned: nodes with the containers that they stand in."""
    out: list[tuple[str, str]] = []
    stack: list[tuple[str, Place]] = []
    for node, _ in flat:
        place = stack[-1][1] if stack else Place()
        out.append((str(place), node if isinstance(node, str) else json.dumps(node)))
        _step(stack, node)
    return out


def _step(stack: list[tuple[str, Place]], node: Node) -> None:
    """The open containers after a node."""
    if not isinstance(node, str) or node == "#":
        return
    if node.startswith("</"):
        if stack and stack[-1][0] == node[2:-1]:
            stack.pop()
    else:
        place = stack[-1][1] if stack else Place()
        stack.append((node[1:-1], place.into(node[1:-1])))


def _bit_rows(a: list, b: list) -> Iterator[int]:
    """For every start of ``a``: a zero at each place of ``b`` that makes the common part longer."""
    at: dict = {}
    for k, key in enumerate(b):
        at[key] = at.get(key, 0) | 1 << k
    row = full = (1 << len(b)) - 1
    for key in a:
        hit = row & at.get(key, 0)
        row = ((row + hit) | (row - hit)) & full
        yield row


def _lengths(a: list, b: list) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and every start of ``b``."""
    row = (1 << len(b)) - 1
    for row in _bit_rows(a, b):
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")
    return np.concatenate([[0], np.cumsum(bits[: len(b)] == 0)])


def common(a: list, b: list) -> list[tuple[int, int]]:
    """The places of a longest common subsequence in both, in space that ``KEPT_CELLS`` bounds."""
    front = 0
    while front < min(len(a), len(b)) and a[front] == b[front]:
        front += 1
    back = 0
    while back < min(len(a), len(b)) - front and a[-1 - back] == b[-1 - back]:
        back += 1
    x, y = a[front : len(a) - back], b[front : len(b) - back]
    middle: list[tuple[int, int]] = []
    if x and y and (len(x) == 1 or len(x) * len(y) <= KEPT_CELLS):
        rows = list(_bit_rows(x, y))
        i, j = len(x), len(y)
        while i and j:
            if rows[i - 1] >> (j - 1) & 1:
                j -= 1
                continue
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                j -= 1
                middle.append((i, j))
        middle.reverse()
    elif x and y:
        half = len(x) // 2
        cut = int(np.argmax(_lengths(x[:half], y) + _lengths(x[half:][::-1], y[::-1])[::-1]))
        middle = common(x[:half], y[:cut])
        middle += [(i + half, j + cut) for i, j in common(x[half:], y[cut:])]
    ends = [(len(a) - k, len(b) - k) for k in range(back, 0, -1)]
    return [(k, k) for k in range(front)] + [(i + front, j + front) for i, j in middle] + ends


def align(wrapper: list[Node], page: list[Node]) -> list[Node]:
    """The wrapper that matches what ``wrapper`` and ``page``, which may be one too, match.

    What only one side has becomes optional. Nodes are one optional group only as long as
    they were there or not together. Between two nodes that both sides have, both are back
    in the same containers, so every slot of the outcome stands where it stood.
    """
    flat = _flat(wrapper), _flat(page)
    a, b = _generalise(*flat), _generalise(*reversed(flat))
    made: list[tuple[Node, tuple | None]] = []
    i = j = 0
    for x, y in [*common(_keys(a), _keys(b)), (len(a), len(b))]:
        made += [(node, ("a", group)) for node, group in a[i:x]]
        made += [(node, ("b", group)) for node, group in b[j:y]]
        if x < len(a):
            both = a[x][1], b[y][1]
            made.append((a[x][0], None if both == (None, None) else both))
        i, j = x + 1, y + 1
    out: list[Node] = []
    for option, run in groupby(made, key=lambda m: m[1]):
        nodes = [node for node, _ in run]
        out += nodes if option is None else [("?", nodes)]
    return out


def pattern(nodes: list[Node]) -> str:
    """The wrapper as a regular expression over tags; ``#`` is a text slot."""
    return "".join(n if isinstance(n, str) else f"({pattern(n[1])}){n[0]}" for n in nodes)


def merge(parts: list[list[Node]]) -> list[Node]:
    """The wrapper of the wrappers, aligned one after the other."""
    wrapper = parts[0]
    for part in parts[1:]:
        if part != wrapper:
            wrapper = align(wrapper, part)
    return wrapper


def infer(streams: list[list[Node]]) -> list[Node]:
    """The wrapper of the streams, aligned one after the other."""
    return merge([fold(stream) for stream in streams])


def slot_paths(nodes: list[Node]) -> set[str]:
    """The paths of all text slots of a wrapper."""
    out: set[str] = set()
    stack: list[tuple[str, Place]] = []

    def walk(part: list[Node]) -> None:
        for node in part:
            if _is_group(node):
                walk(node[1])
            elif node == "#":
                out.add(str(stack[-1][1] if stack else Place()))
            else:
                _step(stack, node)

    walk(nodes)
    return out


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def has_article(found: list[Block]) -> bool:
    """Whether a page has text in an article; a host may have pages of both kinds."""
    return any(in_article(b.path) and not is_boilerplate(b.path) for b in found)


def labels(nodes: list[Node], constant: set[str], varied: set[str] = frozenset()) -> dict[str, bool]:
    """Content or not, for the path of every slot of a wrapper.

    Inside an article what is no boilerplate is content. Outside, ``constant`` and
    ``varied`` are the paths that the host's pages without an article have: a text that
    differs between them is content, and one that is always the same is template. Other
    paths outside an article are content only on a host without any article.
    """
    paths = slot_paths(nodes)
    articles = any(in_article(p) for p in paths)
    return {
        p: not is_boilerplate(p)
        and (in_article(p) or p in varied or (not articles and p not in constant))
        for p in paths
    }


def wrappers(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(host, wrapper, labels): one row per host, labels as JSON from path to content or not.

    Streams and texts are reduced to one row per host and distinct value by map-side
    aggregation first, so a host with very many pages is no large group. A host with more
    than ``ALIGNED`` distinct streams is dealt into parts, in as many rounds as it takes.
    """

    @arrow_udf("struct<stream:string,texts:array<struct<path:string,hash:bigint>>>")
    def scanned(batch: pa.Array) -> pa.Array:
        out = []
        for source in batch:
            found, stream = blocks(source.as_py() or "")
            out.append(
                {
                    "stream": json.dumps(fold(stream)),
                    "texts": [
                        {"path": b.path, "hash": hash_text(b.text)}
                        for b in ([] if has_article(found) else found)
                        if not in_article(b.path) and not is_boilerplate(b.path)
                    ],
                }
            )
        return pa.array(
            out,
            pa.struct(
                [
                    ("stream", pa.string()),
                    ("texts", pa.list_(pa.struct([("path", pa.string()), ("hash", pa.int64())]))),
                ]
            ),
        )

    scanned = scanned.asNondeterministic()
    seen = materialize(
        pages.select(host_of(F.col(url)).alias("host"), scanned(F.col(page)).alias("_s")).select("host", "_s.*"),
        "page-streams",
    )
    streams = seen.groupBy("host", "stream").agg(F.count("*").alias("n"))
    if STREAMS_PER_HOST is not None:
        ranked = Window.partitionBy("host").orderBy(F.desc("n"), "stream")
        streams = streams.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") <= STREAMS_PER_HOST)

    def aligned(join) -> Column:
        @arrow_udf("string")
        def made(parts: pa.Array) -> pa.Array:
            joined = (join([_nodes(json.loads(x)) for x in own.as_py()]) for own in parts)
            return pa.array([json.dumps(nodes) for nodes in joined], pa.string())

        return made.asNondeterministic()(F.col("_parts.stream"))

    join, most = infer, ALIGNED + 1
    while most > 1:
        level = materialize(streams, "streams")
        sizes = level.groupBy("host").agg(F.count("*").alias("_size"))
        most = sizes.agg(F.max("_size")).first()[0] or 0
        parts = F.ceil(F.col("_size") / ALIGNED)
        streams = (
            level.join(sizes, "host")
            .groupBy("host", F.pmod(F.xxhash64("stream"), parts).alias("_part"))
            .agg(
                F.sum("n").alias("n"),
                F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "stream"))).alias("_parts"),
            )
            .select("host", "n", aligned(join).alias("stream"))
        )
        join, most = merge, -(-most // ALIGNED)
    constant = (
        seen.select("host", F.explode("texts").alias("t"))
        .groupBy("host", F.col("t.path").alias("path"))
        .agg(F.min("t.hash").alias("a"), F.max("t.hash").alias("b"), F.count("*").alias("n"))
        .withColumn("same", F.expr("a = b and n > 1"))
        .groupBy("host")
        .agg(
            F.collect_list(F.when(F.col("same"), F.col("path"))).alias("_constant"),
            F.collect_list(F.when(~F.col("same"), F.col("path"))).alias("_varied"),
        )
    )

    @arrow_udf("struct<wrapper:string,labels:string>")
    def labelled(wrapper: pa.Array, constant: pa.Array, varied: pa.Array) -> pa.Array:
        out = []
        for own, same, other in zip(wrapper, constant, varied, strict=True):
            made = _nodes(json.loads(own.as_py()))
            same, other = set(same.as_py() or ()), set(other.as_py() or ())
            # Pages without an article are judged by all their paths, also where the streams
            # of the wrapper are bounded.
            known = labels(made, same, other) | dict.fromkeys(same, False) | dict.fromkeys(other, True)
            out.append({"wrapper": pattern(made), "labels": json.dumps(known, sort_keys=True)})
        return pa.array(out, pa.struct([("wrapper", pa.string()), ("labels", pa.string())]))

    return (
        streams.join(constant, "host", "left")
        .select("host", labelled(F.col("stream"), F.col("_constant"), F.col("_varied")).alias("_w"))
        .select("host", "_w.*")
    )


def _nodes(value) -> list[Node]:
    """Nodes as JSON keeps them, with groups as tuples again."""
    return [n if isinstance(n, str) else (n[0], _nodes(n[1])) for n in value]


def hash_text(text: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def main_text(page: str, known: dict[str, bool]) -> str:
    """The content blocks of a page, by the wrapper's labels or else by their containers."""
    found, _ = blocks(page)
    articles = has_article(found)

    def stays(path: str) -> bool:
        if articles and not in_article(path):
            return False
        if path in known and (articles or known[path]):
            return known[path]
        return not is_boilerplate(path) and (articles or path not in known)

    return "\n".join(b.text for b in found if stays(b.path))


def extract(
    spark: SparkSession, pages: DataFrame, url: str = "url", page: str = "html", into: str = "text"
) -> DataFrame:
    """``pages`` with ``into``: the main text of the whole page, empty if there is none.

    A null page is empty; pages without a host form one host. A column that is already
    called ``into`` is replaced.
    """
    own = [c for c in pages.columns if c != into]
    made = materialize(wrappers(pages, url, page), "wrappers").select("host", "labels")
    few = made.count() <= BROADCAST_HOSTS

    @arrow_udf("string")
    def extracted(batch: pa.Array, known: pa.Array) -> pa.Array:
        parsed: dict[str | None, dict[str, bool]] = {}
        out: Iterator[str] = []
        for source, label in zip(batch, known, strict=True):
            key = label.as_py()
            if key not in parsed:
                parsed[key] = json.loads(key) if key else {}
            out.append(main_text(source.as_py() or "", parsed[key]))
        return pa.array(out, pa.string())

    hosted = pages.select(*own, host_of(F.col(url)).alias("_host"))
    named = made.select(F.col("host").alias("_host"), F.col("labels").alias("_labels"))
    joined = hosted.join(F.broadcast(named) if few else named, "_host", "left")
    return joined.select(*own, extracted(F.col(page), F.col("_labels")).alias(into))


def op6(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    made = extract(spark, pages.select("page_id", "url", "html"))
    return made.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
