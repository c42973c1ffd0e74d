"""Main text of web pages by templates that equivalence classes reveal.

Pages of a host are made from a template. A page is read as tokens: elements with
their path of tags, ids and classes, and text nodes with their path and content. A
token's occurrence vector says how often each page of the host has it; tokens with
the same vector form a class (vectors are compared by a combined hash, so no task
holds a vector). A class is valid if it is frequent (at least half of the host's
different pages have it) and large (two tokens or more). Valid classes nest by path;
what they leave open are the slots.

Two things are taken from a host's template: the container, an element that occurs
once per page and whose slots hold the bulk of the host's running text (an article or
main element if it holds half, else the deepest with nine tenths); and the constant
texts, text nodes that are on every page or, outside articles, with half of the host's
articles. Articles are counted by the running text in the container, so pages that
carry copies of one article are one; a host with fewer than ``FEW`` has no constant texts.
Running text in the container is never dropped for being constant, links there are.
A page's text is what its container holds, less constant texts and less elements that
are never article text: menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments, told by tag, or by a class, id or role that says
nothing else (a has-sidebar is none). Names don't count on articles and headings, nor if the
template speaks against them: an element that holds nine tenths of the host's running text is the container,
whatever it is called. A page that does not fit (or whose host has too few pages) is read by its own elements:
its article or main elements, or else its body.

Character references are decoded, white space inside a block becomes one space,
blocks are trimmed and joined by an empty line.

Edge cases: a null or empty html gives an empty text; a null url has no host and is
read on its own; pages that repeat count once for the template and are each returned;
a tag that never ends is left out; a quote that is never closed is a letter of its value. Time is
linear in the page, whatever its tags, quotes, comments and depth.
"""

from __future__ import annotations

import html as chars
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.common import by_batch, pick
from rowtide.session import materialise

FEW = 10

# How HTML elements behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr br img".split()
)
DROPPED = frozenset(
    "script style noscript template head title nav footer aside form button select option textarea input label svg math "
    "iframe object embed canvas audio video dialog menu".split()
)
# Words of id, class and role that name what is not article text.
NAMED = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs footer sidebar aside cookie cookies consent notice alert banner "
    "ad ads advert adverts advertisement advertising promo promotion sponsor sponsored comment comments reply replies "
    "discussion disqus share sharing social related recommended newsletter subscribe subscription login signup search "
    "pagination pager widget popup modal toolbar skip copyright contentinfo complementary gdpr paywall".split()
)
# Words that leave a name's meaning as it is. Any other word changes it.
_NEUTRAL = frozenset(
    "area article articles bar block body box btn button buttons column container content div entry form global google gpt group "
    "holder icons inner item items left link links list main media mobile outer page panel post posts primary privacy reader "
    "readers right secondary section site slot stories text thread top bottom unit user users wrap wrapper".split()
)
_PAGE_HEAD = frozenset(["header", "masthead", "topbar"])  # headers of pages, not of articles
_WHOLE = frozenset(["html", "body", "main"])
_NEVER_NAMED = frozenset("article h1 h2 h3 h4 h5 h6".split())

_RAW = frozenset("script style textarea title noscript template iframe".split())
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in _RAW}
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_GAP = re.compile(r"[\s/]*")
_ATTRIBUTE = re.compile(r"[^\s/>][^\s/>=]*")
_EQUALS = re.compile(r"\s*=\s*")
_BARE = re.compile(r"[^\s>]*")
_TELLING = frozenset(["class", "id", "role"])


class _Scanner:
    """Reads tags from left to right; every search goes on from the last one, and one that failed is not made again."""

    def __init__(self, html: str) -> None:
        self.html = html
        self.missing: set[str] = set()

    def find(self, what: str, at: int) -> int:
        if what in self.missing:
            return -1
        found = self.html.find(what, at)
        if found < 0:
            self.missing.add(what)
        return found

    def after(self, what: str, at: int) -> int:
        found = self.find(what, at)
        return len(self.html) if found < 0 else found + len(what)

    def comment(self, at: int) -> int:
        """The end of a comment that begins at ``at`` with <!--; <!--> and <!---> are whole ones."""
        for short in ("<!-->", "<!--->"):
            if self.html.startswith(short, at):
                return at + len(short)
        ends = [found for mark in ("-->", "--!>") if (found := self.find(mark, at + 4)) >= 0]
        return self.html.index(">", min(ends)) + 1 if ends else len(self.html)

    def attributes(self, at: int) -> tuple[int, list[tuple[str, str]], bool]:
        """(end of the tag or -1 if it has none, class, id and role, whether it closes itself)."""
        html, found = self.html, []
        while True:
            at = _GAP.match(html, at).end()
            if at >= len(html):
                return -1, found, False
            if html[at] == ">":
                return at + 1, found, html[at - 1] == "/"
            name = _ATTRIBUTE.match(html, at)
            at = name.end()
            equals = _EQUALS.match(html, at)
            if not equals:
                continue
            at, value = equals.end(), ""
            quote = html[at : at + 1]
            if quote in ("'", '"') and (end := self.find(quote, at + 1)) >= 0:
                value, at = html[at + 1 : end], end + 1
            else:  # a quote that is never closed is a letter like others
                bare = _BARE.match(html, at)
                value, at = bare[0], bare.end()
            if (lower := name[0].lower()) in _TELLING:
                found.append((lower, value))


def tags(html: str) -> Iterator[tuple[str, str, list[tuple[str, str]], bool]]:
    """(kind, what, attributes, closes itself): ``text`` and its text, ``open`` and ``end`` and their tag.

    Elements whose content is no text for readers (scripts, styles, ..) are left out with all they hold. A tag that
    never ends is left out, as is a comment's rest; a < that begins no tag is text.
    """
    scan, at, n = _Scanner(html), 0, len(html)
    while at < n:
        begin = scan.find("<", at)
        if begin < 0:
            yield "text", html[at:], [], False
            return
        kind = html[begin + 1 : begin + 2]
        is_end = kind == "/"
        name = _NAME.match(html, begin + 1 + is_end)
        if not name and kind not in ("!", "?", "/"):
            yield "text", html[at : begin + 1], [], False
            at = begin + 1
            continue
        if begin > at:
            yield "text", html[at:begin], [], False
        if not name:
            at = scan.comment(begin) if html.startswith("<!--", begin) else scan.after(">", begin)
            continue
        tag = name[0].lower()
        at, attributes, closed = scan.attributes(name.end())
        if at < 0:
            return
        if is_end:
            yield "end", tag, [], False
        elif tag in _RAW:
            end = _RAW_END[tag].search(html, at)
            if not end:
                return
            at = scan.after(">", end.end())
        else:
            yield "open", tag, attributes, closed


_PARTS = re.compile(r"[^a-z0-9]+")
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"


class Node:
    """An open element: its path hash, depth and what holds for its text.

    ``gone``: dropped by a tag; ``by_name``: a name drops it; ``first_named`` and ``n_named``: the outermost element around, itself
    included, that a name drops, and how many do; ``inside``: it is the container or in it.
    """

    __slots__ = ("tag", "path", "depth", "gone", "by_name", "first_named", "n_named", "article", "link", "holds", "inside")

    def __init__(self, tag: str, path: int, top: Node | None, gone: bool, by_name: bool, article: bool, holds: bool, inside: bool):
        self.tag, self.path, self.gone, self.by_name = tag, path, gone, by_name
        self.article, self.holds, self.inside = article, holds, inside
        self.depth = top.depth + 1 if top else 0
        self.n_named = (top.n_named if top else 0) + by_name
        self.first_named = top.first_named if top and top.n_named else path
        self.link = bool(top and top.link) or tag == "a"

    @property
    def dropped(self) -> bool:
        return self.gone or self.n_named > 0


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _gone(tag: str, in_article: bool) -> bool:
    return tag not in _WHOLE and (tag in DROPPED or tag == "header" and not in_article)


def _named(names: list[list[str]], in_article: bool) -> bool:
    """Whether one of the names (as words) says what is not article text, and nothing else."""
    telling = NAMED if in_article else NAMED | _PAGE_HEAD
    for words in names:
        said = {w for w in words if not w[0].isdigit()}
        if said & telling and said <= telling | _NEUTRAL:
            return True
    return False


def walk(html: str, container: int | None = None) -> Iterator[tuple[list[Node], str | None]]:
    """(open elements, text) per text node; text None where an element opens or a block ends.

    No name drops the element whose path is ``container``.
    """
    stack = [Node("", 0, None, False, False, False, False, False)]
    opened: Counter[str] = Counter()

    def cut(i: int) -> None:
        for node in stack[i:]:
            opened[node.tag] -= 1
        del stack[i:]

    for kind, tag, attributes, closed in tags(html):
        if kind == "text":
            yield stack, tag
            continue
        if kind == "end":
            if opened[tag]:
                cut(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
            if tag not in INLINE:
                yield stack, None
            continue
        if tag == "br":
            yield stack, " "
            continue
        block = tag not in INLINE
        closes = ("p",) if tag != "li" else ("p", "li")
        if block and any(opened[c] for c in closes):  # a paragraph or list item ends where the next block begins, with what it left open
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in closes:
                    cut(i)
                    break
                if stack[i].tag not in INLINE:
                    break
        top = stack[-1]
        names, label = [], tag
        for name, value in attributes:
            words = [w for w in _PARTS.split(value.lower()) if w]
            names += [own for n in value.lower().split() if (own := [w for w in _PARTS.split(n) if w])]
            label += f" {name}={' '.join(w for w in words if not w.isdigit())}"
        holds = tag in ("article", "main") or "role=main" in label
        in_article = top.article or holds
        path = _hash(f"{top.path}>{label}")
        by_name = not (holds or tag in _WHOLE or tag in _NEVER_NAMED or path == container) and _named(names, in_article)
        inside = top.inside or path == container
        node = Node(tag, path, top, top.gone or _gone(tag, in_article), by_name, in_article, holds, inside)
        if tag in VOID or closed and tag in ("svg", "path"):
            if block:
                yield stack, None
            continue
        stack.append(node)
        opened[tag] += 1
        if block:
            yield stack, None


def plain(text: str) -> str:
    return " ".join(chars.unescape(text).split())


_TOKENS = pa.list_(
    pa.struct([("token", pa.int64()), ("kind", pa.string()), ("depth", pa.int32()), ("times", pa.int64()), ("volume", pa.int64()), ("digest", pa.int64())])
)


def _kind(node: Node) -> str:
    if node.by_name:
        return "n"
    return "a" if node.holds else "e"


def page_tokens(html: str) -> list[dict]:
    """Tokens of a page; elements (e), article elements (a), elements that a name drops (n), texts in articles (t)
    and elsewhere (o).

    ``volume`` of an element is the running text inside it that no rule drops (other than its own name, if one
    drops it), ``digest`` the sum of that text's hashes. Both are what the page has gathered between
    the element's begin and its end, so depth costs nothing.
    """
    found: dict[int, list] = {}
    opened: set[int] = set()
    around: list[tuple[Node, int, int]] = []  # open elements, with what was gathered before them
    volume = digest = 0

    def settle(stack: list[Node]) -> None:
        """Close what is no longer open, and note what is."""
        while around and (len(around) > len(stack) or stack[len(around) - 1] is not around[-1][0]):
            node, volume_before, digest_before = around.pop()
            if not node.n_named and (row := found.get(node.path)):
                row[3] += volume - volume_before
                row[4] = (row[4] + digest - digest_before) % (1 << 63)
        for node in stack[len(around) :]:
            around.append((node, volume, digest))

    for stack, text in walk(html):
        settle(stack)
        top = stack[-1]
        if text is None:
            if id(top) not in opened and top.depth:
                opened.add(id(top))
                row = found.setdefault(top.path, [_kind(top), top.depth, 0, 0, 0, []])
                row[2] += 1
                row[5].append(top)  # keeps the object, so that its id stays its own
            continue
        content = plain(text)
        if not content or top.gone:
            continue
        if top.n_named:
            if top.n_named == 1 and not top.link and (row := found.get(top.first_named)):
                row[3] += len(content)
                row[4] = (row[4] + _hash(content)) % (1 << 63)
            continue
        row = found.setdefault(_hash(f"{top.path}|{content}"), ["t" if top.article else "o", top.depth + 1, 0, 0, 0, []])
        row[2] += 1
        if not top.link:
            volume += len(content)
            digest += _hash(content)
    settle([])
    names = ("kind", "depth", "times", "volume", "digest")
    return [{"token": k, **dict(zip(names, v, strict=False))} for k, v in found.items()]


def extract(html: str, container: int | None, constant: frozenset[int] | set[int]) -> str:
    """The main text; ``container`` and ``constant`` come from the host's template."""
    kept: dict[str, list[str]] = {"container": [], "article": [], "body": []}
    block: dict[str, list[str]] = {name: [] for name in kept}

    def close() -> None:
        for name, parts in block.items():
            if text := plain("".join(parts)):
                kept[name].append(text)
            parts.clear()

    def decoded(text: str) -> str:  # a reference is decoded once, so what it gives is protected
        return chars.unescape(text).replace("&", "&amp;")

    for stack, text in walk(html, container):
        if text is None:
            close()
            continue
        top = stack[-1]
        if top.dropped:
            continue
        inside = container is not None and top.inside
        if constant and (top.link or not inside) and _hash(f"{top.path}|{plain(text)}") in constant:
            continue
        piece = decoded(text)
        block["body"].append(piece)
        if top.article:
            block["article"].append(piece)
        if inside:
            block["container"].append(piece)
    close()
    for name in ("container", "article", "body"):
        if kept[name]:
            return "\n\n".join(kept[name])
    return ""


def _tokens(batch: pa.RecordBatch) -> pa.RecordBatch:
    pages = batch.column("html").to_pylist()
    content = pa.array([xxhash.xxh3_128_digest(p.encode("utf-8", "surrogatepass")) for p in pages], pa.binary())
    tokens = pa.array([page_tokens(p) for p in pages], _TOKENS)
    return pa.RecordBatch.from_arrays([batch.column("host"), content, tokens], names=["host", "content", "tokens"])


def templates(pages: DataFrame) -> DataFrame:
    """Per host: the container's path and the constant texts. ``pages`` has host and html."""
    kind = "struct<token:bigint, kind:string, depth:int, times:bigint, volume:bigint, digest:bigint>"
    per_page = by_batch(
        pages.filter(F.col("host").isNotNull() & (F.length("html") > 0)).select("host", "html"),
        _tokens,
        f"host string, content binary, tokens array<{kind}>",
    )
    different = materialise(per_page.groupBy("host", "content").agg(F.first("tokens").alias("tokens")), "html-pages")
    sizes = different.groupBy("host").agg(F.count("*").alias("pages"))
    vectors = (
        different.select("host", "content", F.explode("tokens").alias("t"))
        .groupBy("host", "t.token")
        .agg(
            F.min("t.kind").alias("kind"),
            F.min("t.depth").alias("depth"),
            F.count("*").alias("support"),
            F.max("t.times").alias("times"),
            F.sum("t.volume").alias("volume"),
            F.bit_xor(F.xxhash64("content", "t.times")).alias("vector"),
        )
    )
    frequent = vectors.join(sizes, "host").filter((F.col("pages") > 1) & (2 * F.col("support") >= F.col("pages")))
    frequent = materialise(frequent, "html-vectors")
    classes = frequent.groupBy("host", "vector").agg(F.count("*").alias("members")).filter("members > 1")
    valid = frequent.join(classes, ["host", "vector"])
    most = F.max(F.when(F.col("kind").isin("a", "e"), F.col("volume"))).over(Window.partitionBy("host"))
    ranked = valid.withColumn("most", most)
    once = (F.col("times") == 1) & (10 * F.col("support") >= 9 * F.col("pages"))
    semantic = F.when((F.col("kind") == "a") & once & (2 * F.col("volume") >= F.col("most")), F.struct("volume", "token"))
    deep = F.when(
        (F.col("kind") == "e") & once & (10 * F.col("volume") >= 9 * F.col("most")), F.struct("depth", "token")
    )
    bulk = 10 * F.col("volume") >= 9 * (F.col("volume") + F.coalesce("most", F.lit(0)))
    misnamed = F.when((F.col("kind") == "n") & once & bulk & (F.col("volume") > 0), F.struct("volume", "token"))
    best = F.coalesce(F.max(misnamed)["token"], F.max(semantic)["token"], F.max(deep)["token"])
    containers = ranked.groupBy("host").agg(best.alias("container"))
    containers = materialise(containers, "html-containers")
    # Constant texts are counted over different articles, told by what the container holds.
    tokens = different.select("host", "content", F.explode("tokens").alias("t")).select("host", "content", "t.token", "t.digest")
    held = tokens.join(containers.withColumnRenamed("container", "token"), ["host", "token"])
    held = materialise(held.select("host", "content", F.col("digest").alias("article")), "html-articles")
    articles = held.groupBy("host").agg(F.count_distinct("article").alias("articles")).filter(F.col("articles") >= FEW)
    everywhere = (F.col("support") == F.col("pages")) & (F.col("times") == 1)
    likely = valid.filter(F.col("kind").isin("t", "o") & (F.col("pages") >= FEW) & (everywhere | (F.col("kind") == "o")))
    likely = likely.join(articles, "host").select("host", "token", "articles", everywhere.alias("everywhere"))
    likely = materialise(likely, "html-likely")
    seen = tokens.join(likely, ["host", "token"]).join(held, ["host", "content"])
    seen = seen.groupBy("host", "token", "articles", "everywhere").agg(F.count_distinct("article").alias("support"))
    constant = seen.filter(F.col("everywhere") | (2 * F.col("support") >= F.col("articles")))
    constant = constant.groupBy("host").agg(F.collect_set("token").alias("constant"))
    return containers.join(constant, "host", "left")


def _extract(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = zip(*[batch.column(c).to_pylist() for c in ("html", "container", "constant")], strict=True)
    out = [extract(html, container, set(constant or ())) if html else "" for html, container, constant in rows]
    names = ["page_id", "url", "text", "n_chars"]
    data = [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())]
    return pa.RecordBatch.from_arrays(data, names=names)


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    host = F.nullif(F.lower(F.regexp_extract("url", _HOST, 1)), F.lit(""))
    read = pick(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host")
    )
    found = materialise(templates(read), "html-templates")
    joined = read.join(found, "host", "left").select("page_id", "url", "html", "container", "constant")
    return by_batch(joined, _extract, "page_id bigint, url string, text string, n_chars bigint")
