"""HTML extraction: the main text of pages, without what a site repeats.

Element subtrees are hashed and counted per host in Spark; those that recur across many pages of a host are its template
and are deleted. Elements that say by tag, role or name what they are (menus, adverts, comments) go as well.

Pages are read in one pass: no step looks further ahead than to what it then skips, and where open elements of each name
lie is remembered, so the time grows with the page alone, however broken it is.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ionloom.llm.shared import bytes_of, kept, record_batch, small_batches

#: A subtree is template from so many different pages of its host on, and from this share of them on.
LEAST_PAGES, LEAST_SHARE = 3, 0.05
#: The same for blocks of text, such as paragraphs: they recur in plain writing as well.
LEAST_TEXT_PAGES, LEAST_TEXT_SHARE = 20, 0.25
#: A subtree that holds more than this share of a page's text is never template.
MOST_OF_PAGE = 0.5
#: Templates of all hosts are broadcast up to this size; beyond it they are joined by salted host.
BROADCAST_BYTES, SALTS = 8 << 20, 64

# Element and attribute names of HTML.
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead tr ul caption".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style textarea title noscript iframe xmp noframes noembed".split()
DROPPED = set("nav footer aside form head menu dialog noscript template iframe button select datalist".split()) | set(RAW)
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
NAMES = set("ad ads adv advert adverts advertisement advertising adsense adslot banner promo promotion sponsor sponsored sidebar menu nav navbar navigation breadcrumb breadcrumbs footer cookie cookies consent gdpr notice newsletter subscribe subscription signup login share sharing social related recommended recommendations comment comments discussion replies disqus respond popup modal overlay widget pagination pager skip toolbar".split())
OUTER_NAMES = set("header masthead topbar".split())

#: Words that stand beside those in a name without telling what an element is.
BESIDE = set("area bar block body bottom box btn button buttons col column container content controls count entries entry field fixed form global group head heading icon icons image inline inner item items js left link links list main mini nav outer page panel post posts primary right row secondary section sidebar site slot small sticky tag tags text title top unit view wrap wrapper".split())

_TAG = re.compile(r"[a-zA-Z][^\s/>]*")
_PLAIN = re.compile(r"[^'\">]*")
_RAW_END = {name: re.compile(f"</{name}(?=[\\s/>])[^>]*>?", re.I) for name in RAW}
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_READ = {"class", "id", "role", "hidden", "aria-hidden"}
_PART = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "tbody": {"tr", "tbody", "thead"}, "tfoot": {"tr", "tbody", "thead"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "tbody": {"table"}, "tfoot": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}
_TEXT_BLOCKS = set("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt tr figcaption".split())


class Node:
    __slots__ = ("tag", "attrs", "parts", "size", "key")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.parts, self.size, self.key = tag, attrs, [], 0, 0


class _Open:
    """The elements that are open, and where those of each name lie among them."""

    def __init__(self, root: Node):
        self.stack, self.places, self.blocks, self.fences = [root], {}, [], []

    def push(self, node: Node) -> None:
        at = len(self.stack)
        self.stack.append(node)
        self.places.setdefault(node.tag, []).append(at)
        if node.tag in BLOCKS or node.tag in ("td", "th"):
            self.blocks.append(at)
        if node.tag in _FENCES:
            self.fences.append(at)

    def last(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def close(self, at: int) -> None:
        """The element at a place, and all within it."""
        while len(self.stack) > at:
            tag = self.stack.pop().tag
            self.places[tag].pop()
            for held in (self.blocks, self.fences):
                if held and held[-1] == len(self.stack):
                    held.pop()


_FENCES = {"article", "body", "main", "table"}


def _tag_end(text: str, at: int, unclosed: set[str]) -> int:
    """Where the tag's > lies, from a place after its name; -1 without one. A quote after = runs to the next one of its kind."""
    while True:
        at = _PLAIN.match(text, at).end()
        if at == len(text):
            return -1
        c = text[at]
        if c == ">":
            return at
        k = at - 1
        while text[k].isspace():
            k -= 1
        shut = text.find(c, at + 1) if text[k] == "=" and c not in unclosed else -1
        if shut < 0 and text[k] == "=":
            unclosed.add(c)  # none further on either
        at = max(at, shut) + 1


def parse(text: str) -> Node:
    """A tree of elements and texts (character references still in them). Never fails: what doesn't close, closes at the end.

    A tag that the page ends in is no tag and no text; so is a comment.
    """
    root = Node("", {})
    held = _Open(root)
    stack = held.stack
    at, n = 0, len(text)
    unclosed: set[str] = set()
    while at < n:
        here = text.find("<", at)
        if here < 0:
            stack[-1].parts.append(text[at:])
            break
        after = text[here + 1 : here + 2]
        close = after == "/"
        name = _TAG.match(text, here + 1 + close)
        if not name and after not in ("!", "?", "/"):  # no tag, but text
            stack[-1].parts.append(text[at : here + 1])
            at = here + 1
            continue
        if here > at:
            stack[-1].parts.append(text[at:here])
        if not name:
            if text.startswith("<!--", here):
                end = text.find("-->", here + 2)
                at = n if end < 0 else end + 3
            else:
                end = text.find(">", here)
                at = n if end < 0 else end + 1
            continue
        end = _tag_end(text, name.end(), unclosed)
        if end < 0:
            break
        inside = text[name.end() : end]
        tag, at = name[0].lower(), end + 1
        if close:
            if tag == "br":
                stack[-1].parts.append(Node("br", {}))
                continue
            k = held.last((tag,))
            if k and (tag in BLOCKS or not held.fences or held.fences[-1] <= k):
                held.close(k)
            continue
        if tag in _RAW_END:
            shut = _RAW_END[tag].search(text, at)  # no part of any text
            at = shut.end() if shut else n
            continue
        if tag in BLOCKS and held.blocks and stack[held.blocks[-1]].tag == "p":
            held.close(held.blocks[-1])
        if tag in _CLOSES:
            k = held.last(_CLOSES[tag])
            if k and k > held.last(_SCOPE[tag]):
                held.close(k)
        attrs = {}
        if inside and not inside.isspace():
            for a in _ATTRIBUTE.finditer(inside):
                if (key := a[1].lower()) in _READ:
                    attrs.setdefault(key, a[2] or a[3] or a[4] or "")
        node = Node(tag, attrs)
        stack[-1].parts.append(node)
        if tag not in VOID and (tag in BLOCKS or not inside.endswith("/")):  # a slash doesn't close an HTML element
            held.push(node)
    return root


def _named(value: str, words: set[str]) -> bool:
    """A name of which all parts are among the words, or stand beside one that is."""
    for name in value.split():
        parts = {p.lower() for p in _PART.findall(name)}
        if parts & words and parts <= words | BESIDE:
            return True
    return False


def unwanted(node: Node, inside: bool) -> bool:
    """By tag, role or name. inside: within an article."""
    if node.tag in DROPPED or "hidden" in node.attrs or node.attrs.get("aria-hidden") == "true":
        return True
    if not node.attrs:
        return node.tag == "header" and not inside
    if node.attrs.get("role", "").lower() in ROLES or node.tag == "header" and not inside:
        return True
    if node.tag in ("body", "html", "main", "article") and "comment" not in node.attrs.get("class", "").lower():
        return False
    names = f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}"
    return _named(names, NAMES) or not inside and _named(names, OUTER_NAMES)


def measure(root: Node) -> None:
    """Gives every element the length of its text and a hash of its subtree. Without recursion: pages nest as they like."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(p for p in node.parts if type(p) is Node)
    for node in reversed(order):
        h = xxhash.xxh3_64(f"<{node.tag} {node.attrs.get('class', '')}>")
        size = 0
        for p in node.parts:
            if type(p) is Node:
                size += p.size
                h.update(p.key.to_bytes(8, "little"))
            else:
                words = p.split()
                size += sum(map(len, words))
                h.update(" ".join(words))
        node.size, node.key = size, h.intdigest()


def main_parts(root: Node) -> list[Node]:
    """Outermost articles; without any, the main element; without that, the whole page."""
    for wanted in (lambda n: n.tag == "article", lambda n: n.tag == "main" or n.attrs.get("role", "").lower() == "main"):
        found, todo = [], [root]
        while todo:
            node = todo.pop()
            if wanted(node):
                if node.size and not unwanted(node, True):
                    found.append(node)
                continue
            if not unwanted(node, False):
                todo.extend(p for p in reversed(node.parts) if type(p) is Node)
        if found:
            return found
    return [root]


def candidates(root: Node) -> tuple[int, set[int], set[int]]:
    """A hash of the main part, and hashes of subtrees that may be template: containers in it; blocks of text where no article is marked."""
    parts = main_parts(root)
    total = sum(p.size for p in parts)
    marked = parts[0] is not root
    found, blocks, todo = set(), set(), list(parts)
    while todo:
        node = todo.pop()
        for p in node.parts:
            if type(p) is Node and p.size and not unwanted(p, marked):
                if p.tag in BLOCKS and p.size <= MOST_OF_PAGE * total and not (marked and p.tag in _TEXT_BLOCKS):
                    (blocks if p.tag in _TEXT_BLOCKS else found).add(p.key)
                todo.append(p)
    page = xxhash.xxh3_64(b"".join(k.to_bytes(8, "little") for k in (*(p.key for p in parts), *sorted(found), *sorted(blocks)))).intdigest()
    return page, found, blocks


def extract(text: str, templates: set[int]) -> str:
    """Blocks of the main part in page order, two line breaks between them."""
    root = parse(text)
    measure(root)
    parts = main_parts(root)
    total, marked = sum(p.size for p in parts), parts[0] is not root
    blocks: list[str] = []
    line: list[str] = []

    def close() -> None:
        if line:
            words = entities.unescape("".join(line)).split()
            if words:
                blocks.append(" ".join(words))
            line.clear()

    todo: list = list(reversed(parts))
    whole = {id(p) for p in parts}
    while todo:
        p = todo.pop()
        if p is None:
            close()
        elif type(p) is str:
            line.append(p)
        elif p.tag in ("br", "td", "th") and not p.parts:
            line.append(" ")
        elif id(p) not in whole and (unwanted(p, marked) or p.key in templates and p.tag in BLOCKS and p.size <= MOST_OF_PAGE * total and not (marked and p.tag in _TEXT_BLOCKS)):
            line.append(" ")
        else:
            block = p.tag in BLOCKS or p.tag == ""
            if block:
                close()
                todo.append(None)
            elif p.tag in ("td", "th"):
                line.append(" ")
                todo.append(" ")
            todo.extend(reversed(p.parts))
    close()
    return "\n\n".join(blocks)


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def templates(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """host, templates: hashes of subtrees that recur on enough different pages of the host. Their number is bounded by what a page holds over least_share.

    Pages whose main parts are alike are one page: what copies of an article share isn't template.
    """
    schema = pa.schema([("host", pa.string()), ("page", pa.int64()), ("found", pa.list_(pa.int64())), ("blocks", pa.list_(pa.int64()))])
    signed = lambda k: k - (1 << 64) if k >> 63 else k

    def run(batches):
        for batch in batches:
            pages, found, blocks = [], [], []
            for raw in batch.column("html").to_pylist():
                root = parse(raw or "")
                measure(root)
                page, some, others = candidates(root)
                pages.append(signed(page))
                found.append([signed(k) for k in sorted(some)])
                blocks.append([signed(k) for k in sorted(others)])
            yield record_batch(schema, host=batch.column("host"), page=pages, found=found, blocks=blocks)

    own = pages.select(host_of(F.col("url").cast("string")).alias("host"), F.col("html").cast("string")).where("host != ''")
    different = own.mapInArrow(run, "host string, page long, found array<long>, blocks array<long>").groupBy("host", "page").agg(F.first("found").alias("found"), F.first("blocks").alias("blocks"))
    named = lambda name, text: F.transform(name, lambda x: F.struct(x.alias("key"), F.lit(text).alias("text")))
    lone = F.array(F.struct(F.lit(None).cast("long").alias("key"), F.lit(False).alias("text")))
    counted = different.select("host", F.explode(F.concat(lone, named("found", False), named("blocks", True))).alias("x")).groupBy("host", "x.key", "x.text").agg(F.count("*").alias("n"))
    enough = F.col("n") >= F.when(F.col("text"), max(least_pages, LEAST_TEXT_PAGES)).otherwise(least_pages)
    counted = kept(counted.where(F.col("key").isNull() | enough), "html-counts")
    per_host = counted.where("key is null").select("host", F.col("n").alias("pages"))  # the row without a key counts the host's pages
    often = F.col("n") >= F.col("pages") * F.when(F.col("text"), max(least_share, LEAST_TEXT_SHARE)).otherwise(least_share)
    return counted.where("key is not null").join(per_host, "host").where(often).groupBy("host").agg(F.collect_list("key").alias("templates"))


def main_text(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages.

    Null and empty html give an empty text. A page whose url is null or names no host has no template; the rest holds for
    it too. Pages of a host with the same main part count once for its template. Extra columns play no part. No rows give no rows.
    """
    own = small_batches(pages).select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).withColumn("host", host_of(F.col("url")))
    known = kept(templates(pages, least_pages, least_share), "html-templates")
    if bytes_of(known) <= BROADCAST_BYTES:
        met = own.join(F.broadcast(known), "host", "left")
    else:
        salted = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = own.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(salted.hint("merge"), ["host", "salt"], "left")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def run(batches):
        for batch in batches:
            known = [{k & ((1 << 64) - 1) for k in x or ()} for x in batch.column("templates").to_pylist()]
            found = [extract(raw or "", t) for raw, t in zip(batch.column("html").to_pylist(), known, strict=True)]
            yield record_batch(schema, page_id=batch.column("page_id"), url=batch.column("url"), text=found)

    out = met.select("page_id", "url", "html", "templates").mapInArrow(run, "page_id long, url string, text string")
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
