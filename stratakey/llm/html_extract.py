"""Main-text extraction by consensus paths of a host.

Each page's candidates are html, body, main, article, section, div and the root; lists, tables and quotes are blocks in them.
Spark counts on how many different pages of a host each block of text stands; blocks that stand on most of them are the host's frame and score
nothing. A candidate scores the text of the blocks below it, more of it outside links than inside, and a page votes for the innermost
candidate that reaches the whole page's score, by its generalised path (tags with their classes, numbers replaced). Then every page is read
again and yields the text below its host's winning path where that holds MOST of the page's score, or
below its own candidate. Counts and votes are summed before the shuffle, so a hot host is no burden; the winners are one row a host,
with at most twice as many frame blocks as its pages have blocks on average. Up to
BROADCAST_HOSTS of them, some ten MB, go to the pages; more are joined by a shuffle. Paths are kept as one tree a page, so the time
grows with the page's length, however deeply it is nested.

Names of classes and ids are a weak sign: an element of a telling name goes, unless it holds most of the text
outside links of a page whose article and main elements have none, and is neither a form nor comments; where the host's winning container has
text on the page, it always goes.

Defined cases: null or empty html gives an empty text; null urls form a host of their own; a page cut off inside a tag
keeps what came before; elements never closed end with the page; repeated rows give repeated results; of paths with as many votes the
one with more text wins, then the greater; a very long page is read in one task; columns named as the operator's own are kept as they
are, except main_text, which it replaces; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Collection, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import materialise
from .url_filter import host_and_path

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][\w:-]*)((?:[^<>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z|(?=<))", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
# What the elements of HTML are.
TO_THE_END = {"script", "style", "textarea", "title"}  # take the rest of the page if they are not closed
RAW = TO_THE_END | {"noscript", "template", "svg", "iframe", "object"}
SKIPPED = {"head", "nav", "footer", "aside", "form", "menu", "dialog", "select", "button", "audio", "video", "canvas", "map"}
CONTAINERS = {"html", "body", "main", "article", "section", "div", "td", "table", "tr", "ul", "ol", "dl", "blockquote", "header", "center", "details"}
CANDIDATES = {"html", "body", "main", "article", "section", "div"}
BLOCKS = CONTAINERS | SKIPPED | {"p", "br", "hr", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "pre", "figure", "figcaption", "th", "tbody", "thead", "caption", "address", "fieldset", "summary", "hgroup", "option"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
NOISE = (
    "ads?|adverts?|advertisements?|advertising|sponsor|sponsors|sponsored|promos?|promotions?|promoted|banners?|comments?|discussion|replies|respond|disqus|menus?|nav|navigation|navbar|breadcrumbs?"
    "|notices?|cookies?|consent|gdpr|foot|footer|header|masthead|share|sharing|social|related|recommended|recommendations?|subscribe|subscription|newsletters?|popup|modal|overlay|alerts?|login|signup"
    "|search|widgets?|pagination|pager|toolbar|contentinfo|complementary|side-?bars?"
)
#: Words that say where or how something stands, not what it is.
PLACE = "left|right|top|bottom|main|page|site|user|users|box|block|list|area|section|wrapper|wrap|container|inner|outer|text|links?|bar"
# a class or id is noise if one of its words is and the others are of PLACE: not "commentary", "cookie-recipes", "has-sidebar"
WORD = re.compile(rf"(?:{PLACE}|[a-z]|\d+)?(?P<noise>{NOISE})?(?:{PLACE}|\d+)?")
#: Containers of the text itself are never noise, whatever their classes say of the page.
WHOLE = {"html", "body", "main", "article"}
NAMED = (CONTAINERS - WHOLE) | {"p", "li", "span"}


class Block:
    """A block of text: its place in the tree of paths, its pieces, how much of it is linked, and the innermost doubt about it."""

    __slots__ = ("node", "parts", "linked", "doubt")

    def __init__(self) -> None:
        self.node, self.parts, self.linked, self.doubt = 0, [], 0, -1


class Paths:
    """The generalised paths of a page's candidates as a tree; node 0 is the root, and parents come before their children."""

    def __init__(self) -> None:
        self.parents, self.names, self.children = [0], [""], {}

    def child(self, node: int, name: str) -> int:
        found = self.children.get((node, name))
        if found is None:
            found = self.children[node, name] = len(self.parents)
            self.parents.append(node)
            self.names.append(name)
        return found

    def find(self, path: str) -> int | None:
        node = 0
        for name in path.split(">") if path else ():
            node = self.children.get((node, name))
            if node is None:
                return None
        return node

    def path(self, node: int) -> str:
        out = []
        while node:
            out.append(self.names[node])
            node = self.parents[node]
        return ">".join(reversed(out))

    def sums(self, own: list[int]) -> list[int]:
        """own, with what is below each node added."""
        total = own[:]
        for node in range(len(total) - 1, 0, -1):
            total[self.parents[node]] += total[node]
        return total

    def below(self, node: int) -> list[bool]:
        """Whether each node is node or below it."""
        out = [node == 0] * len(self.parents)
        for i in range(1, len(out)):
            out[i] = i == node or out[self.parents[i]]
        return out


class Doubt:
    """An element whose name alone doesn't tell whether it is noise; its contents do, and, outside an article, its share of the page."""

    __slots__ = ("parent", "size", "linked", "items", "form", "comments", "inside")

    def __init__(self, parent: int, comments: bool, inside: bool):
        self.parent, self.size, self.linked, self.items, self.form, self.comments, self.inside = parent, 0, 0, 0, False, comments, inside

    def noise(self, whole: float) -> bool:
        """Mostly links, a form, or a list of comments; outside an article also comments of any form, and less than most of the page."""
        return self.form or 2 * self.linked > self.size or (self.comments and (self.items > 1 or not self.inside)) or (not self.inside and 2 * (self.size - self.linked) <= whole)


def rejected(doubts: list[Doubt], whole: float) -> list[bool]:
    """Whether each doubt, or one around it, is noise on a page of so much text outside links. What lies inside counts for those around."""
    for d in reversed(doubts):
        if d.parent >= 0:
            outer = doubts[d.parent]
            outer.size, outer.linked, outer.items, outer.form = outer.size + d.size, outer.linked + d.linked, outer.items + d.items, outer.form or d.form
    out: list[bool] = []
    for d in doubts:
        out.append(d.noise(whole) or (d.parent >= 0 and out[d.parent]))
    return out


def generalised(tag: str, attributes: str) -> str:
    named = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
    classes = sorted(re.sub(r"\d+", "0", c.lower()).replace(">", "") for c in named.get("class", "").split())[:2]
    return ".".join([tag, *classes])


def noise_name(value: str) -> bool:
    for name in value.lower().split():
        words = [WORD.fullmatch(w) for w in re.split(r"[-_]+", name.replace("side-bar", "sidebar")) if w]
        if words and all(words) and any(m["noise"] for m in words):
            return True
    return False


def noisy(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element is noise, or, inside an article, may be."""
    if tag in SKIPPED:
        return True
    if tag == "header" and not inside:
        return True
    return tag in NAMED and any(noise_name(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes))


class Open:
    """An open element: its tag, whether its text is skipped, and the path and doubt that hold inside it."""

    __slots__ = ("tag", "skipped", "node", "doubt")

    def __init__(self, tag: str, skipped: bool, node: int, doubt: int):
        self.tag, self.skipped, self.node, self.doubt = tag, skipped, node, doubt


def blocks(page: str, names_decide: bool = False) -> tuple[list[Block], Paths]:
    """The page's text blocks outside menus, adverts and the like, in page order, and their paths. With names_decide no share of the page saves an element from its name."""
    stack, opened, paths, doubts = [Open("", False, 0, -1)], Counter(), Paths(), []
    out, links, at, skip, endless, articles = [Block()], 0, 0, 0, set(), False

    def text(s: str) -> None:
        nonlocal articles
        if s and not skip:
            articles = articles or (opened["article"] + opened["main"] > 0 and not s.isspace())
            out[-1].parts.append(s)
            out[-1].linked += len(s) if links else 0
            if stack[-1].doubt >= 0:
                d, size = doubts[stack[-1].doubt], len(s.strip())
                d.size += size
                d.linked += size if links else 0

    def close() -> int:
        top = stack.pop()
        opened[top.tag] -= 1
        return top.skipped

    n = len(page)
    while at < n:
        m = TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at, tag = m.end(), (m[2] or "").lower()
        if not tag:
            continue
        before = stack[-1].doubt
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            if opened[tag] and (tag in CONTAINERS or tag in SKIPPED or stack[-1].tag == tag):
                while stack[-1].tag != tag:
                    skip -= close()
                skip -= close()
        else:
            if before >= 0:
                doubts[before].items += tag in ("li", "article")
                doubts[before].form |= tag in ("form", "textarea", "input", "select", "button")
            if tag in RAW:
                end = None if tag in endless else re.compile(rf"</{tag}\s*>?", re.I).search(page, at)
                if end is None:
                    endless.add(tag)
                    at = n if tag in TO_THE_END else at
                else:
                    at = end.end()
                continue
            if tag not in VOID:
                links += tag == "a"
                if stack[-1].tag == tag and tag in ("p", "li"):  # the next one closes it
                    skip -= close()
                if tag == "body":  # closes what the head left open
                    while len(stack) > 1 and stack[-1].tag != "html":
                        close()
                    skip = 0
                inside = opened["article"] + opened["main"] > 0
                s = noisy(tag, m[3], inside)
                if s or tag in CONTAINERS or tag in SKIPPED:
                    # a header outside an article goes by its tag
                    doubtful = s and tag not in SKIPPED and (inside or tag != "header")
                    node, doubt = stack[-1].node, stack[-1].doubt
                    if doubtful:
                        doubts.append(Doubt(doubt, re.search("comment|discussion|replies|respond|disqus", m[3], re.I) is not None, inside))
                        doubt = len(doubts) - 1
                    if tag in CANDIDATES:
                        node = paths.child(node, generalised(tag, m[3]))
                    stack.append(Open(tag, s and not doubtful, node, doubt))
                    opened[tag] += 1
                    skip += s and not doubtful
        if tag in BLOCKS or stack[-1].doubt != before:
            if out[-1].parts:
                out.append(Block())
            out[-1].node, out[-1].doubt = stack[-1].node, stack[-1].doubt
    # where an article or main element has text, no other element can be the page's text against its name
    whole = float("inf") if articles or names_decide else sum(sum(map(len, map(str.strip, b.parts))) - b.linked for b in out)
    bad = rejected(doubts, whole)
    return [b for b in out if b.doubt < 0 or not bad[b.doubt]], paths


def clean(b: Block) -> str:
    return " ".join(entities.unescape("".join(b.parts)).split())


#: The part of a page's text that its host's winner must hold.
MOST = 0.8


def worth(b: Block) -> int:
    """The text of a block that isn't a list of links."""
    size = sum(len(t.strip()) for t in b.parts)
    return size if size > 2 * b.linked else 0


def block_hash(b: Block) -> int:
    return int.from_bytes(hashlib.blake2b(clean(b).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def worths(found: list[Block], paths: Paths, frame: Collection[int] = ()) -> list[int]:
    """The score of each node: the worth of all blocks below it but the host's frame; of a page of nothing else, of all; of a page of links only, their sizes."""
    own = [0] * len(paths.parents)
    if len(frame):
        for b in found:
            if (w := worth(b)) and block_hash(b) not in frame:
                own[b.node] += w
    if not any(own):
        for b in found:
            own[b.node] += worth(b)
    if not any(own):
        for b in found:
            own[b.node] += sum(map(len, b.parts))
    return paths.sums(own)


def best_node(total: list[int]) -> int:
    """The innermost candidate that holds all blocks of text: those that do lie inside each other, and parents come first."""
    return max(i for i, t in enumerate(total) if t == total[0]) if total[0] else 0


def extract(page: str | None, winner: str | None, frame: Collection[int] = ()) -> str:
    # where the host's own container has text, names decide about the rest
    for names_decide in (True, False) if winner and winner.rsplit(">", 1)[-1].split(".")[0] not in ("html", "body") else (False,):
        found, paths = blocks(page or "", names_decide)
        total = worths(found, paths, frame)
        node = paths.find(winner) if winner else None
        if node and total[node]:
            break
    if node is None or total[node] < max(1, MOST * total[0]):
        node = best_node(total)
    below = paths.below(node)
    return " ".join(t for b in found if below[b.node] and (t := clean(b)))


def host_frames(pages: DataFrame) -> DataFrame:
    """(frame_host, frame): the hashes of the blocks that stand on most different pages of a host. pages has host and html."""

    @F.pandas_udf("array<long>")
    def hashes(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield pd.Series([sorted({block_hash(b) for b in blocks(page or "")[0] if worth(b)}) for page in s], dtype=object)

    # copies of one page count once: what they share is no frame
    each = pages.select(F.col("host").alias("frame_host"), F.xxhash64("html").alias("page"), hashes("html").alias("hashes")).groupBy("frame_host", "page").agg(F.first("hashes").alias("hashes"))
    # a null stands for the page itself
    stood = each.select("frame_host", F.explode(F.concat(F.array(F.lit(None).cast("long")), "hashes")).alias("hash"))
    counts = stood.groupBy("frame_host", "hash").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.where("hash is null").select(F.col("frame_host").alias("__h"), F.col("n").alias("__pages"))
    many = counts.where((F.col("hash").isNotNull()) & (F.col("n") >= FRAME_PAGES)).join(sizes, F.col("frame_host").eqNullSafe(F.col("__h"))).where("2 * n > __pages")
    return many.groupBy("frame_host").agg(F.array_sort(F.collect_list("hash")).alias("frame"))


def host_paths(pages: DataFrame) -> DataFrame:
    """(voted_host, winner): each host's path with most votes. pages has host, html and, where it is known, frame."""
    if "frame" not in pages.columns:
        pages = pages.withColumn("frame", F.lit(None).cast("array<long>"))

    @F.pandas_udf("struct<path:string, score:double>")
    def vote(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for htmls, frames in parts:
            rows = []
            for page, frame in zip(htmls, frames):
                found, paths = blocks(page or "")
                total, score = worths(found, paths, as_set(frame)), float(sum(map(worth, found)))
                rows.append((paths.path(best_node(total)) if score else None, score))  # "" is the root
            yield pd.DataFrame(rows, columns=["path", "score"])

    votes = pages.select(F.col("host").alias("voted_host"), vote("html", "frame").alias("v")).select("voted_host", "v.path", "v.score").where("path is not null")
    counts = votes.groupBy("voted_host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("score"))
    return counts.groupBy("voted_host").agg(F.max_by("path", F.struct("n", "score", "path")).alias("winner"))


def as_set(frame: Sequence[int] | None) -> frozenset[int]:
    return frozenset() if frame is None else frozenset(map(int, frame))


BROADCAST_HOSTS = 100_000
#: A block of a host's frame stands on so many pages at least, and on most.
FRAME_PAGES = 4


def by_host(pages: DataFrame, host: Column, side: DataFrame, key: str) -> DataFrame:
    """pages with a row of side for their host, or nulls."""
    side = F.broadcast(side) if side.count() <= BROADCAST_HOSTS else side
    return pages.join(side, host == F.col(key), "left")


def extract_pages(pages: DataFrame) -> DataFrame:
    """pages with the column main_text."""

    @F.pandas_udf("string")
    def main_text(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for htmls, winners, frames in parts:
            yield pd.Series([extract(h, w, as_set(f)) for h, w, f in zip(htmls, winners, frames)], dtype=object)

    host = host_and_path(F.col("url"))[0]
    short = pages.select(host.alias("host"), "html")
    frames = materialise(host_frames(short), "host-frames")
    voters = by_host(short, F.col("host"), frames, "frame_host")
    winners = materialise(host_paths(voters), "host-paths").withColumnsRenamed({"voted_host": "__voted_host", "winner": "__winner"})
    frames = frames.withColumnsRenamed({"frame_host": "__frame_host", "frame": "__frame"})
    joined = by_host(by_host(pages, host, winners, "__voted_host"), host, frames, "__frame_host")
    return joined.select(*[c for c in pages.columns if c != "main_text"], main_text("html", "__winner", "__frame").alias("main_text"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return out.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))
