"""Main text of web pages by site template removal.

Pass 1 parses every page and hashes its element subtrees; Spark counts, per
host and hash, the parent subtrees that hold it.  Copies of a page or of an
article have the parent in common and count once.  Subtrees that recur in many
parents of a host are its template, whatever their length; they are joined to
the pages that hold them.  Pass 2 parses again, deletes template subtrees and
elements that by tag or naming are not article text, picks the article, and
joins its blocks.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicscan.llm.common import as_long, map_arrow, materialize

#: A subtree is template if it stands in so many different parents on the host's
#: pages, and in ROOT_SHARE times the root of the number of different pages: 3
#: of 36, 50 of 10,000, 500 of 1,000,000.
MIN_PAGES = 3
ROOT_SHARE = 0.5
#: Inside an article only groups of blocks that most pages share are template.
ARTICLE_SHARE = 0.5
# Elements by kind, and words of class, id and role names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math object xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby "
                   "s samp small span strike strong sub sup time tt u var wbr".split())
DROPPED = frozenset("head nav footer aside form button select option fieldset dialog menu datalist canvas audio video map".split()) | RAW
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                     "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
NAMES = frozenset("ad ads adv advert advertisement advertising adbox adslot banner billboard sponsor sponsored promo promotion "
                  "promoted nav navbar navigation menu submenu breadcrumb breadcrumbs footer header masthead sidebar sidebars aside "
                  "widget widgets cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter "
                  "subscribe subscription signup login register paywall share sharing social related recommended recommendations "
                  "comment comments discussion disqus reply replies respond responses feedback search searchform toolbar pagination "
                  "pager tags skip copyright legal disclaimer contentinfo complementary".split())
KEPT = frozenset("html body main article".split())

#: Names that readers' comments go by.
COMMENTS = frozenset("comment comments discussion disqus reply replies respond responses".split())
#: An element goes for its name, or as a form, only if it holds no more than this share of the page's words.
NAME_SHARE = 0.5
#: Comments may be longer than what they are about.
COMMENTS_SHARE = 0.9

_MARK = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*+)|(!--)|(!\[CDATA\[)|[!?])")
# the rest of a tag: a quote counts only where a value begins; possessive, so a broken tag costs no backtracking
_REST = re.compile(r"""((?:[\s/]++|(?:=[^\s/>=]*+|[^\s/>=]++)\s*+(?:=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+)*+)>""")
_NAMING = re.compile(r"""(?<![\w-])(class|id|role|hidden|aria-hidden|aria-label|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[a-z]+")
_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)[^>]*>?", re.I) for t in RAW}
_COMMENTS = re.compile(r"(?:\d+\s+)?(?:reader\s+)?comments?(?:\s*\(\d+\))?|leave a (?:reply|comment)|kommentare?|commentaires?|comentarios?", re.I)


class Node:
    __slots__ = ("tag", "names", "items", "hash", "words", "linked", "core")

    def __init__(self, tag: str, names: frozenset[str] = frozenset()) -> None:
        self.tag, self.names, self.items = tag, names, []
        self.hash, self.words, self.linked = 0, 0, 0
        self.core = False  # whether it is or holds what the page is about


def _names(attributes: str) -> frozenset[str]:
    """Words of class, id and role; ``-hidden`` for what isn't shown."""
    out: set[str] = set()
    if "=" not in attributes and "hidden" not in attributes.lower():
        return frozenset()
    for m in _NAMING.finditer(attributes):
        value = (m[2] or m[3] or m[4] or "").lower()
        name = m[1].lower()
        if name in ("class", "id", "role"):
            spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", " ", m[2] or m[3] or m[4] or "").lower()
            out.update(_WORD.findall(spaced))
            out.update(_WORD.findall(value))
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            out.add("-hidden")
    return frozenset(out)


def parse(page: str) -> Node:
    """The page's element tree; text items are strings with references decoded.
    Unclosed elements end with their parent, a stray end tag is ignored."""
    root = Node("#")
    stack, at = [root], 0
    opened: Counter = Counter()  # elements on the stack by tag

    def close(i: int) -> None:
        opened.subtract(x.tag for x in stack[i:])
        del stack[i:]

    def text(s: str) -> None:
        if s:
            stack[-1].items.append(entities.unescape(s) if "&" in s else s)

    while (m := _MARK.search(page, at)) is not None:
        text(page[at:m.start()])
        if m[2] is None:
            stop = "-->" if m[3] else "]]>" if m[4] else ">"
            end = page.find(stop, m.start() + 2 if m[3] else m.end())
            end = len(page) if end < 0 else end
            if m[4]:
                text(page[m.end():end])
            at = min(len(page), end + len(stop))
            continue
        rest = _REST.match(page, m.end())
        if rest is None:  # a tag that never ends takes the rest of the page
            at = len(page)
            break
        at, tag, attributes = rest.end(), m[2].lower(), rest[1]
        if m[1]:
            for i in range(len(stack) - 1 if opened[tag] else 0, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
                # an inline or paragraph end tag doesn't close what holds it
                if (tag in INLINE or tag == "p") and stack[i].tag not in INLINE and stack[i].tag != "p":
                    break
            continue
        if tag in CLOSES_P or tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            # a new block ends an open paragraph; a list item or cell ends the one before
            same = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}.get(tag, ("p",))
            i = len(stack) - 1
            while i > 0 and (stack[i].tag in INLINE or stack[i].tag == "p" and same != ("p",)):
                i -= 1
            if stack[i].tag in same:
                close(i)
                if tag == "tr" and stack[-1].tag == "tr":
                    close(len(stack) - 1)
        node = Node(tag, _names(attributes) if attributes else frozenset())
        stack[-1].items.append(node)
        if tag in VOID or attributes.endswith("/") and tag in ("svg", "math"):
            continue
        if tag in RAW:
            end = _END[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        stack.append(node)
        opened[tag] += 1
    text(page[at:])
    return root


def measure(root: Node) -> None:
    """Hash, word count and linked words of every subtree, children first."""
    order, todo = [], [root]
    while todo:
        n = todo.pop()
        order.append(n)
        todo.extend(x for x in n.items if not isinstance(x, str))
    for n in reversed(order):
        parts = [n.tag.encode(), *sorted(x.encode() for x in n.names)]
        for x in n.items:
            if isinstance(x, str):
                w = x.split()
                n.words += len(w)
                if w:
                    parts.append(b"\x01" + " ".join(w).encode("utf-8", "replace"))
            elif x.tag not in RAW:
                n.words += x.words
                n.linked += x.linked
                parts.append(b"\x02" + x.hash.to_bytes(8, "little"))
        if n.tag == "a":
            n.linked = n.words
        n.hash = xxhash.xxh64_intdigest(b"\x00".join(parts))


def subtrees(root: Node) -> dict[int, int]:
    """Hashes of the subtrees that hold text and may be template, each with the
    hash of its parent (the smallest, if it stands in several)."""
    out: dict[int, int] = {}
    todo = [(root, 0)]
    while todo:
        n, parent = todo.pop()
        if n.words and n.tag not in ("#", "html", "body", "article", "main") and n.tag not in INLINE:
            out[n.hash] = min(out.get(n.hash, parent), parent)
        todo.extend((x, n.hash) for x in n.items if not isinstance(x, str) and x.words)
    return out


def mark_core(root: Node) -> Node | None:
    """Mark the elements that hold an article (not a reader's comment), a main
    element or a first heading.  On a page without article and main, the
    element with the most words in paragraphs of its own is returned."""
    order: list[tuple[Node, Node | None, bool]] = []
    todo: list[tuple[Node, Node | None, bool]] = [(root, None, False)]
    marked, best, most = False, None, 0
    while todo:
        n, parent, off = todo.pop()
        off = off or n.tag in DROPPED - {"form"}
        order.append((n, parent, off))
        own = 0
        for x in n.items:
            if not isinstance(x, str):
                todo.append((x, n, off))
                own += x.words if x.tag in ("p", "blockquote", "pre") else 0
        if own > most and not off and n.tag not in ("#", "html", "body") and not n.names & COMMENTS:
            best, most = n, own
    for n, parent, off in reversed(order):
        if not off and (n.tag == "main" or n.tag == "article" and not _unwanted_article(n)):
            n.core = marked = True
        elif n.tag == "h1" and n.words and not off:
            n.core = True
        if n.core and parent is not None and n.tag != "header":
            parent.core = True
    return None if marked else best


def _unwanted_article(n: Node) -> bool:
    return bool(n.names & (COMMENTS | {"teaser", "related", "promo", "ad", "sponsored"}))


def _unwanted(n: Node, page_words: int) -> bool:
    if "-hidden" in n.names or n.tag in DROPPED and n.tag != "form":
        return True
    if n.tag in KEPT:
        # pages name their body and article after all sorts of things; readers' comments may be articles
        return n.tag == "article" and _unwanted_article(n)
    if n.tag == "form" or n.names & NAMES:
        # one word of a name says little about an element that holds the article or most of the page
        return not n.core and (n.words <= NAME_SHARE * page_words or bool(n.names & COMMENTS) and n.words <= COMMENTS_SHARE * page_words)
    return False


def _heading(n: Node) -> str:
    return " ".join(x for x in n.items if isinstance(x, str)).strip()


def prune(root: Node, template: dict[int, float]) -> None:
    """Delete what is not article text; inside an article (or a main element,
    or what stands for one) only groups of blocks that most pages share."""
    text = mark_core(root)
    todo = [(root, False)]
    while todo:
        n, inside = todo.pop()
        kept: list = []
        skip = False
        for x in n.items:
            if isinstance(x, str):
                kept.append(x)
                continue
            if re.fullmatch("h[1-6]", x.tag):
                skip = x.tag != "h1" and _COMMENTS.fullmatch(_heading(x)) is not None
            share = template.get(x.hash, 0) if x.words else 0
            if skip or x.tag == "header" and not inside or _unwanted(x, root.words):
                continue
            if share and (not inside or share >= ARTICLE_SHARE and x.tag not in INLINE and not re.fullmatch("p|h[1-6]|blockquote|li|pre|td", x.tag)):
                continue
            kept.append(x)
            todo.append((x, inside or x.tag in ("article", "main") or x is text))
        n.items = kept


def _words(n: Node) -> int:
    total, todo = 0, [n]
    while todo:
        for x in todo.pop().items:
            if isinstance(x, str):
                total += len(x.split())
            else:
                todo.append(x)
    return total


def _find(n: Node, tag: str) -> list[Node]:
    """Outermost elements of a tag, in page order."""
    out, todo = [], [n]
    while todo:
        x = todo.pop()
        if x.tag == tag:
            out.append(x)
        else:
            todo.extend(y for y in reversed(x.items) if not isinstance(y, str))
    return out


def _menus(n: Node) -> None:
    """Outside articles: delete lists and sections that are mostly links."""
    todo = [n]
    while todo:
        x = todo.pop()
        x.items = [y for y in x.items if isinstance(y, str) or y.tag not in ("ul", "ol", "div", "section", "table", "p")
                   or not y.words or y.linked < 0.6 * y.words]
        todo.extend(y for y in x.items if not isinstance(y, str))


def joined(n: Node) -> str:
    """Text of the blocks in page order; only block ends separate, inline elements don't."""
    pieces: list[str] = []
    todo: list = [n]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            pieces.append(x)
            continue
        block = x.tag not in INLINE
        if block:
            pieces.append(" ")
            todo.append(" ")
        todo.extend(reversed(x.items))
    return " ".join("".join(pieces).split())


def main_text(page: str | None, template: dict[int, float]) -> str:
    """The article of a page as one line of text; empty if there is none."""
    if not page:
        return ""
    root = parse(page)
    measure(root)
    prune(root, template)
    everything = _words(root)
    for tag in ("article", "main"):
        found = [(x, _words(x)) for x in _find(root, tag)]
        best = max(found, key=lambda f: f[1], default=None)
        # parts of one article may be articles; short ones beside a long one are teasers
        parts = [x for x, w in found if best and w and 4 * w >= best[1]]
        if best and best[1] and 4 * sum(_words(x) for x in parts) >= everything:
            return " ".join(t for t in map(joined, parts) if t)
    _menus(root)
    return joined(root)


def host_of(url_col: str):
    return F.lower(F.coalesce(F.regexp_extract(url_col, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#\s]*)", 1), F.lit("")))


def _pages(df: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """``host, page, t`` and what ``df`` has; ``page`` hashes the host and the bytes."""
    return df.withColumns({"host": host_of(url_col), "t": F.col(html_col).cast("binary")}).withColumn("page", F.xxhash64("host", "t"))


def templates(df: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page, hashes, shares)``: the template subtrees on each page that has
    any.  Hashes are joined to pages in rows, so a host's template has no bound.
    A key is a subtree's hash XOR the host's; 0 stands for the page itself."""

    def run(c):
        out: dict[str, list] = {"page": [], "host": [], "body": [], "keys": [], "parents": []}
        seen = set()
        for host, page, t in zip(c["host"], c["page"], c["t"]):
            if not t or page in seen:
                continue
            seen.add(page)
            root = parse(t.decode("utf-8", "replace"))
            measure(root)
            found, h = subtrees(root), xxhash.xxh64_intdigest(host.encode())
            out["page"].append(page)
            out["host"].append(h)
            out["body"].append(root.hash)
            out["keys"].append(np.array([x ^ h for x in found], np.uint64).view(np.int64))
            out["parents"].append(np.array(list(found.values()), np.uint64).view(np.int64))
        return {"page": pa.array(out["page"], pa.int64()), "host": as_long(np.array(out["host"], np.uint64)),
                "body": as_long(np.array(out["body"], np.uint64)), "keys": pa.array(out["keys"], pa.list_(pa.int64())),
                "parents": pa.array(out["parents"], pa.list_(pa.int64()))}

    rows = _pages(df.select(url_col, html_col), url_col, html_col).select("host", "page", "t")
    held = materialize(map_arrow(rows, run, "page long, host long, body long, keys array<long>, parents array<long>", rows=1024), "page-subtrees")
    single = held.select("host", F.explode(F.arrays_zip(F.col("keys").alias("key"), F.col("parents").alias("parent"))).alias("x"))
    single = single.select("host", "x.key", "x.parent").unionByName(held.select("host", F.col("host").alias("key"), F.col("body").alias("parent")))
    # distinct rows first, so neither a host nor a subtree is a hot group
    counts = single.distinct().groupBy("host", "key").agg(F.count("*").alias("n"))
    counts = materialize(counts.filter((F.col("key") == F.col("host")) | (F.col("n") >= MIN_PAGES)), "page-counts")
    pages = counts.filter("key = host").select("host", F.col("n").alias("pages"))
    many = (counts.filter("key <> host").join(pages, "host").filter(F.col("n") >= ROOT_SHARE * F.sqrt("pages"))
            .select("key", "host", (F.col("n") / F.col("pages")).alias("share")))
    # what is template grows with the hosts, so no broadcast
    on = held.select("page", "host", F.explode("keys").alias("key")).join(many.hint("merge"), ["host", "key"])
    found = on.groupBy("page").agg(F.collect_set(F.struct(F.col("key").bitwiseXOR(F.col("host")).alias("hash"), "share")).alias("x"))
    return materialize(found.select("page", F.col("x.hash").alias("hashes"), F.col("x.share").alias("shares")), "page-templates")


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id, url, text, n_chars)`` of every page.

    A null or empty page gives an empty text; a null url counts as the host
    with the empty name.  Repeated rows are returned as they come.  An empty
    table gives an empty result.  Other columns are not looked at.
    """
    template = templates(df, url_col, html_col)

    def run(c):
        texts = []
        for hashes, shares, t in zip(c["hashes"], c["shares"], c["t"]):
            known = {h & (1 << 64) - 1: s for h, s in zip(hashes or (), shares or ())}
            texts.append(main_text(t.decode("utf-8", "replace") if t else None, known))
        return {"id": pa.array(c["id"], pa.int64()), "url": pa.array(c["url"], pa.string()), "text": texts,
                "n_chars": pa.array([len(t) for t in texts], pa.int64())}

    rows = _pages(df.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")), "url", "html")
    with_template = rows.select("id", "url", "page", "t").join(template.hint("merge"), "page", "left")
    return map_arrow(with_template.select("id", "url", "hashes", "shares", "t"), run, "id long, url string, text string, n_chars long")
