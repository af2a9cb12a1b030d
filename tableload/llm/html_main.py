"""Main text of web pages by consensus paths of their host.

Each page scores its containers (text of their blocks, less links) and names the best one by
its path of tags and classes, numbers generalised.  Spark adds the votes up per host; paths
with enough of their host's votes win.  Every page is then read again and its text taken
from the element at the first winning path it has; a page without one uses its own best
container.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import md5
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: a path wins if it has this share of its host's votes
MIN_VOTE_SHARE = 0.05
#: a link list is a menu if that share of its host's pages, and so many different ones, have it
MIN_LIST_PAGES = 3
_LIST = "link list "

# fixed values: the elements of HTML by their role
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: left out with all they hold; of these, text elements go on to the end of the page if unclosed
RAW = frozenset("script style noscript template textarea title iframe svg canvas audio video".split())
TEXT_ONLY = frozenset("script style textarea title iframe".split())
BOILERPLATE = frozenset("head nav header footer aside form button select menu dialog fieldset label noframes".split())
BLOCKS = frozenset(("address article aside blockquote body caption center dd details div dl dt fieldset figcaption "
                    "figure h1 h2 h3 h4 h5 h6 hr html li main ol p pre section summary table tbody td tfoot th thead "
                    "tr ul").split())
CONTAINERS = frozenset("article main section div td body html center blockquote".split())
#: an opening tag ends these open elements (up to the nearest of the second set)
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"})}
ENDS_P = BLOCKS - {"body", "html", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NOISE = frozenset(("nav navbar navigation menu submenu header masthead footer foot sidebar aside breadcrumb breadcrumbs ad ads "
                   "adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies "
                   "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
                   "share sharing social related recommended recommendations comment comments commentlist disqus "
                   "replies reply respond discussion pagination pager toolbar widget skip copyright legal "
                   "disclaimer search form paywall").split())
BODY = frozenset("article articlebody content post entry body story text main maincontent".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)\]\]>|<[!?][^>]*>|"""
                  r"""<(?P<end>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                  r"""|</?[A-Za-z][^>]*>""", re.S)
_ATTR = re.compile(r"""([A-Za-z_:][-A-Za-z0-9_:.]*+)\s*+(?:=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?+""")
_TOKEN = re.compile(r"[a-z]+")
_NUMBER = re.compile(r"[0-9]+")


class Node:
    __slots__ = ("name", "parent", "path", "score", "weight", "noise", "open_at", "links", "texts")

    def __init__(self, name, parent, label, noise, weight):
        self.name, self.parent, self.noise, self.weight = name, parent, noise, weight
        self.path = label if parent is None else f"{parent.path}>{label}"
        self.score, self.links, self.texts = 0.0, 0, 0


def _look(name: str, attrs: str) -> tuple[str, bool, float]:
    """Generalised label of an element, whether it is noise, and its weight as a container."""
    weight = {"article": 1.6, "main": 1.3}.get(name, 1.0)
    if not attrs or attrs.isspace():
        return name, name in BOILERPLATE, weight
    classes, noise, label = [], name in BOILERPLATE, ""
    for key, a, b, c in _ATTR.findall(attrs):
        key, value = key.lower(), (a or b or c)
        if key in ("class", "id"):
            low = value.lower()
            if key == "class":
                classes = sorted(_NUMBER.sub("0", x) for x in low.split())
            tokens = set(_TOKEN.findall(low))
            if tokens & NOISE and not tokens & BODY:
                noise = True
            if tokens & BODY and name in CONTAINERS:
                weight = max(weight, 1.3)
        elif key == "itemprop" and value.lower() == "articlebody":
            weight = max(weight, 1.6)
        elif key == "role":
            noise = noise or value.lower() in ROLES
            if value.lower() in ("main", "article"):
                weight = max(weight, 1.3)
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") \
                or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
            noise = True
    label = name + "".join("." + x for x in classes)
    if name in ("body", "html", "article", "main"):
        noise = False
    return label, noise, weight


def blocks(html: str) -> list[tuple[str, Node, list[Node], float]]:
    """The page's blocks outside noise, in order: text, innermost element, the elements it
    stands in (outermost first) and the share of its text in links."""
    out: list = []
    stack: list[Node] = []
    buffer: list[str] = []
    state = {"noise": 0, "a": 0, "linked": 0, "size": 0}

    def flush():
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text and stack:
                out.append((text, stack[-1], list(stack), state["linked"] / max(state["size"], 1)))
        state["linked"] = state["size"] = 0

    def say(raw: str):
        if state["noise"] or not raw:
            return
        text = unescape(raw) if "&" in raw else raw
        buffer.append(text)
        size = len(text) - text.count(" ")
        state["size"] += size
        if state["a"]:
            state["linked"] += size

    def close(k: int):
        for node in reversed(stack[k:]):
            if node.name in BLOCKS:
                flush()
            if node.noise:
                state["noise"] -= 1
            if node.name == "a":
                state["a"] -= 1
            stack.pop()

    def opened(name: str, attrs: str):
        if name in BLOCKS and name in ENDS_P:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].name == "p":
                    close(k)
                    break
                if stack[k].name in CONTAINERS or stack[k].name in ("table", "li", "ul", "ol"):
                    break
        if name in IMPLIED_END:
            ends, stop = IMPLIED_END[name]
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].name in stop:
                    break
                if stack[k].name in ends:
                    close(k)
                    break
        if name in BLOCKS:
            flush()
        label, noise, weight = _look(name, attrs)
        stack.append(Node(name, stack[-1] if stack else None, label, noise, weight))
        state["noise"] += noise
        state["a"] += name == "a"

    stack.append(Node("html", None, "html", False, 1.0))
    at, n = 0, len(html)
    while at < n:
        m = _TAG.search(html, at)
        if m is None:
            say(html[at:])
            break
        say(html[at:m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if m["cdata"]:
            say(m["cdata"].replace("&", "&amp;"))
        if not name:
            continue
        if m["end"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    close(k)
                    break
                if stack[k].name in ("table", "article", "body") and name not in ("body", "html", "article", "main", "table"):
                    break
            if name == "p":
                flush()
            continue
        if name == "br":
            say(" ")
            continue
        if name == "hr":
            flush()
            continue
        if name in VOID or name == "html":
            continue
        if name == "body" and any(x.name == "body" for x in stack):
            continue
        if name == "body":
            close(1)
        if name in RAW:
            end = re.compile(f"</{name}\\s*>", re.I).search(html, at) if not m["attrs"].endswith("/") else m
            if end:
                at = end.end()
            elif name in TEXT_ONLY:
                at = n
            continue                                     # else the tag alone is passed over
        opened(name, m["attrs"])
        if m["attrs"].endswith("/") and name not in BLOCKS:
            close(len(stack) - 1)
    flush()
    return out


def _link_lists(found: list) -> dict[int, str]:
    """Lists in which almost all text is links, by element, with a digest of their text."""
    lists: dict[int, list] = {}
    for text, _, chain, linked in found:
        for node in reversed(chain):
            if node.name in ("ul", "ol"):
                seen = lists.setdefault(id(node), [0, 0, 0.0, []])
                seen[0] += 1
                seen[1] += len(text)
                seen[2] += linked * len(text)
                seen[3].append(text)
                break
    return {k: _LIST + md5("\n".join(texts).encode(errors="replace")).hexdigest()
            for k, (items, size, linked, texts) in lists.items() if items >= 3 and linked >= 0.9 * size}


def _content(found: list, menus) -> list:
    """Blocks outside the given lists."""
    return [b for b in found if not menus or not any(id(x) in menus for x in b[2])]


def best_path(found: list) -> tuple[str, float] | None:
    """Path and score of the page's best container."""
    scored: dict[int, Node] = {}
    for text, _, chain, linked in found:
        worth = len(text) * (1 - linked)
        if len(text) < 25:
            worth *= 0.3
        share = 1.0
        for node in reversed(chain):
            if node.name in CONTAINERS:
                scored[id(node)] = node
                node.score += worth * share
                share *= 0.8
    if not scored:
        return None
    top = min(scored.values(), key=lambda x: (-x.score * x.weight, x.path))
    return (top.path, top.score) if top.score > 0 else (top.path, 1e-9)


def extract(html: str, winners: list[str], menus: list[str] | None = None) -> str:
    """Text of the elements at the first winning path the page has, blocks joined by blank lines.

    ``menus`` are the link lists that many pages of the host repeat; they are dropped, other
    link lists inside the element are part of it.  None: the host has too few pages to tell,
    and the link lists before the element's first other block are dropped.
    """
    every = blocks(html)
    lists = _link_lists(every)
    found = _content(every, lists)
    paths = {node.path for _, _, chain, _ in found for node in chain}
    path = next((p for p in winners if p in paths), None)
    if path is None:
        top = best_path(found)
        path = top[0] if top else None
    inside = [b for b in every if any(node.path == path for node in b[2])]
    if menus is None:
        first = next((k for k, b in enumerate(inside) if not any(id(x) in lists for x in b[2])), len(inside))
        gone = {id(x) for b in inside[:first] for x in b[2] if id(x) in lists}
    else:
        gone = {k for k, digest in lists.items() if digest in menus}
    return "\n\n".join(b[0] for b in _content(inside, gone))


def host_of(url: Column) -> Column:
    """Lower-cased host of a URL without user and port; null without one."""
    return F.lower(F.nullif(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def votes(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path, votes): each page's vote for its best container, added up, and (host, digest,
    different pages) of the link lists."""
    source = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ballots: dict = {}
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1)):
                html = html.as_py() or ""
                found = blocks(html)
                lists = _link_lists(found)
                top = best_path(_content(found, lists))
                if top:
                    ballots[host, top[0], None] = ballots.get((host, top[0], None), 0) + 1
                if lists:
                    page = md5(html.encode(errors="replace")).digest()
                    ballots.update({(host, digest, page): 1 for digest in lists.values()})
            columns = list(zip(*ballots)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()),
                                              pa.array(columns[2], pa.binary()), pa.array(list(ballots.values()), pa.int64())],
                                             ["host", "path", "page", "votes"])
    return source.mapInArrow(run, "host string, path string, page binary, votes bigint") \
        .groupBy("host", "path", "page").agg(F.sum("votes").alias("votes")) \
        .groupBy("host", "path").agg(F.sum(F.when(F.col("page").isNull(), F.col("votes")).otherwise(1)).alias("votes"))


def winning_paths(ballots: DataFrame, min_share: float = MIN_VOTE_SHARE) -> DataFrame:
    """(host, winners, menus): paths with at least ``min_share`` of their host's votes, most votes
    first, ties by path, at most 1 / ``min_share`` of them; and the link lists on as large a
    share of pages and ``MIN_LIST_PAGES`` or more, null on hosts with fewer pages."""
    is_list = F.col("path").startswith(_LIST)
    total = ballots.groupBy("host").agg(F.sum(F.when(~is_list, F.col("votes"))).alias("total")).withColumnRenamed("host", "_host")
    won = ballots.join(total, F.col("host").eqNullSafe(F.col("_host"))).where(F.col("votes") >= min_share * F.col("total")) \
        .where(~is_list | (F.col("votes") >= MIN_LIST_PAGES))
    entry = F.struct((-F.col("votes")).alias("v"), "path")
    return won.groupBy("host").agg(F.sort_array(F.collect_list(F.when(~is_list, entry))).alias("w"),
                                   F.sort_array(F.collect_list(F.when(is_list, F.col("path")))).alias("menus"),
                                   F.max("total").alias("total")) \
        .select("host", F.col("w.path").alias("winners"), F.when(F.col("total") >= MIN_LIST_PAGES, F.col("menus")).alias("menus"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              min_share: float = MIN_VOTE_SHARE) -> DataFrame:
    """One row per page: id, url, ``text`` (empty if there is none) and ``n_chars``.

    Character references are decoded, white space inside a block becomes one space, blocks
    are joined in page order by two line feeds.  Null html counts as empty; pages without a
    host vote together; repeated rows stay; an empty table gives an empty result; other
    columns are not read.  Lists of links do not score; those inside the main element stay
    unless many pages of the host repeat them (on hosts of one or two pages: unless they
    stand before the element's other text).  A host with a third of all pages is split by the engine's skew
    join (its few paths are copied to every part).
    """
    source = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    won = winning_paths(votes(pages, url_col, html_col), min_share) \
        .select(F.coalesce("host", F.lit("")).alias("host"), "winners", "menus")
    both = source.withColumn("host", F.coalesce(host_of(F.col("url")), F.lit(""))).join(won, "host", "left") \
        .select("id", "url", "html", "winners", "menus")
    schema = T.StructType([source.schema["id"], T.StructField("url", T.StringType()), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(html.as_py() or "", won.as_py() or [], menus.as_py())
                     for html, won, menus in zip(batch.column(2), batch.column(3), batch.column(4))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["id", "url", "text"])
    out = both.mapInArrow(run, schema)
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text",
                      F.char_length("text").cast("long").alias("n_chars"))
