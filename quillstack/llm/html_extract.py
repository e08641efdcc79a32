"""Main text of web pages by consensus host paths.

1. Each page's containers are scored: text of blocks, less for link text, without what is never
   main text (menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles,
   comments). The page's choice is its only ``main`` with half of the score, or its only
   ``article`` with ``ALONE`` of it; without these, the smallest container with all of the score.
2. A container is named by its generalised path, the tags and classes from the body down with
   runs of digits replaced. Spark adds up, for each host, which blocks outside articles stand in the
   same container, but for numbers, beside different text on ``LEAST_PAGES`` pages or more: such blocks
   repeat. A container of which ``REPEATED`` of the host's text repeats is furniture whatever its name,
   and its repeated blocks are left out on all pages. Copies of a page have the same text beside a
   block and count once, and a container with much text of its own loses none, however often
   some of its lines come again.
3. Spark adds up the votes of each host's pages for the paths of their choices; of equal ones the
   last in the order of code points wins. Hosts with furniture vote once more, without it.
4. Every page is read again with its host's winning path. Where that is on the page, holding ``USE``
   of the page's score, all blocks in it are taken, and of the rest of the page's own choice those
   that are not mostly links; else all blocks of the page's own choice. A headline before an
   article without one, and what follows it up to the article, are taken too.

What is dropped: tags and roles that say so, hidden parts, and parts whose class or id says so. A
name counts if all of its words are those of page furniture (``cookie-notice``); with other words
too (``social-history``) the part is dropped only if it is mostly links. Wrappers and forms that hold the
headline or the article stay. The fallback texts of objects, audio, video and canvas are text, those of
``noscript`` are notices; CDATA sections are comments, as in HTML.

Text: character references decoded, white space within a block turned into one space, blocks
joined by line feeds in page order. Null or empty html, or pages without text: empty text. Null
urls and those without ``://`` share the empty host. Repeated rows and page ids are judged row
by row. Further columns are not looked at. An empty table gives an empty result. Pages are read
whole, however long or deep.
"""

from __future__ import annotations

import html as _html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, checkpoint
from .url_filter import host_and_path

#: Winning paths are broadcast up to so many characters of hosts and paths together, and joined by a shuffle beyond.
BROADCAST_CHARS = 16_000_000
#: The share of the page's score that an article must hold to be the choice by itself, and a host's path to be used.
ALONE, USE = 0.8, 0.5
#: Blocks and parts with more of their text in links than this are mostly links.
LINKED = 0.5
#: A block repeats on so many pages with different text, and in furniture so much of a host's text does.
LEAST_PAGES, REPEATED = 4, 0.9
#: Longer paths are named by a hash of the parent's name and their last part.
LONGEST_PATH = 1000

_ATTRIBUTES = r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    rf"|<title\b{_ATTRIBUTES}>[^<]*(?:</title\s*>)?"
    rf"|<(script|style)\b{_ATTRIBUTES}>.*?(?:</\1\s*>|\Z)"
    rf"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)({_ATTRIBUTES})>",
    re.S | re.I,
)
#: Elements left out with all they hold, where they are closed.
_SILENT = frozenset("noscript template textarea svg iframe select annotation annotation-xml".split())
_FALLBACK = frozenset("object audio video canvas".split())
_LOWER = {c: c + 32 for c in range(65, 91)}
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_DIGITS = re.compile(r"\d+")
_SPLIT_NAME = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_DROP = frozenset("nav footer aside form button menu dialog head label datalist fieldset legend map noscript select textarea".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th"
    " thead tr ul".split()
)
_CONTAINER = frozenset("html article main section div td body table tbody tr center blockquote".split())
_DROP_WORDS = frozenset(
    "nav navbar navigation menu menus submenu masthead topbar footer foot sidebar sidebars aside widget widgets ad ads adv advert"
    " adverts advertisement advertisements advertising adsense banner banners promo promos promotion promotions sponsor sponsored"
    " sponsors cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup paywall"
    " share sharing social related recommended recommendations comment comments commentlist disqus reply replies respond"
    " breadcrumb breadcrumbs pagination pager login search searchbox toolbar skip copyright hidden alert toast teaser teasers"
    " outbrain taboola topnav sidenav leftnav rightnav mainnav subnav sitenav mainmenu adbox adslot adunit commentbox commentform"
    " sitefooter pagefooter".split()
)
_DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
_KEEP_WORDS = frozenset("article post entry story content main body".split())
#: Words that say what a wrapper has rather than what it is, as in ``with-sidebar``.
_WRAPPER_WORDS = frozenset("with has no without wrapper layout container page site row grid columns".split())
_WRAPPER_FIRST = frozenset("with has no without layout".split())
#: Words that drop words go together with in the names of page furniture.
_FURNITURE = _DROP_WORDS | frozenset(
    "list bar box wrap wrapper block area links link items item buttons button btn icons icon panel top bottom left right site page"
    " global inner outer slot unit posts post articles stories news more thread count meta holder primary secondary tertiary mobile"
    " desktop fixed sticky message messages msg strip zone group col column columns row rows main header head container section content"
    " text title media social us by on off js module region tools tool float floating sub super mini big small large full"
    " user users reader readers blog the for your my ext id el component shell layer frame feed line lines tags tag article entry entries story body".split()
)
#: Parts that may hold headings of their own and are dropped even so.
_FIRM_WORDS = frozenset("comment comments commentlist disqus replies respond ad ads advert adverts advertisement related recommended modal popup".split())


class _Node:
    __slots__ = ("tag", "path", "parent", "drop", "soft", "guess", "text", "links")

    def __init__(self, tag, path, parent, drop, soft=False, guess=False):
        self.tag, self.path, self.parent, self.drop, self.soft, self.guess = tag, path, parent, drop, soft, guess
        self.text = self.links = 0


def _attributes(raw: str) -> dict:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(raw)} if "=" in raw else {}


def _names(value: str) -> list[str]:
    return [w for w in _SPLIT_NAME.split(_CAMEL.sub(r"\1 \2", value).lower()) if w]


def _dropped(tag: str, attributes: dict, raw: str, inside: bool) -> tuple[bool, bool, bool]:
    """Whether a node is no main text, whether that goes by its names only, and whether its names leave it open."""
    if tag in _DROP or tag == "header" and not inside:
        return True, tag == "form", False  # some pages are one form
    if not raw.strip():
        return False, False, False
    if attributes.get("role", "").lower() in _DROP_ROLES or attributes.get("aria-hidden", "").lower() == "true":
        return True, False, False
    if "display:none" in attributes.get("style", "").replace(" ", "").lower() or re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", raw):
        return True, False, False
    if tag in ("body", "html", "main", "article"):
        words = _names(attributes.get("class", "") + " " + attributes.get("id", ""))
        return tag == "article" and any(w in _FIRM_WORDS or w in ("reply", "teaser") for w in words), False, False
    guess = False
    for name in (attributes.get("class", "") + " " + attributes.get("id", "")).split():
        words = {w.strip("0123456789") for w in _names(name)} - {""}
        if words & _WRAPPER_WORDS and not words <= _FURNITURE:
            continue
        if words & _DROP_WORDS and not words & _WRAPPER_FIRST:
            if words <= _FURNITURE:
                return True, not words & _FIRM_WORDS, False
            guess = True
        elif words & {"header", "head"} and not inside and not words & _KEEP_WORDS:
            return True, True, False
    return False, False, guess


def _lowered(page: str) -> str:
    """The page with A-Z in small letters, all places as they were."""
    return page.translate(_LOWER)


def read(page: str) -> tuple[list[_Node], list[tuple[_Node, str, float]]]:
    """The page's nodes in order, and its blocks of text outside dropped nodes, each with its node and its share of links."""
    root = _Node("html", "", None, False)
    nodes, stack, blocks, buffer = [root], [root], [], []
    link_depth = 0
    at = 0
    small = None

    def say(raw: str) -> None:
        if raw and not stack[-1].drop:
            buffer.append((raw, link_depth > 0))

    def flush() -> None:
        nonlocal buffer
        if not buffer:
            return
        joined = "".join(x for x, _ in buffer)
        text = " ".join((_html.unescape(joined) if "&" in joined else joined).split())
        if text:
            node = stack[-1]
            linked = sum(len(x) for x, is_link in buffer if is_link)
            share = min(1.0, linked / max(1, len(joined)))
            node.text += len(text)
            node.links += int(len(text) * share)
            blocks.append((node, text, share))
        buffer = []

    closers: dict[str, int] = {}
    for m in _TOKEN.finditer(page):
        if m.start() < at:
            continue  # within an element that is left out
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            if m[1]:
                say(" ")
            continue
        tag = tag.lower()
        if tag in _SILENT:
            if not m[2] and closers.get(tag, 0) >= 0:
                small = small or _lowered(page)
                closers[tag] = small.find(f"</{tag}", at)
                if closers[tag] >= 0:
                    at = page.find(">", closers[tag]) + 1 or len(page)
            say(" ")
            continue
        if tag in _FALLBACK:
            say(" ")
            continue
        if tag in _VOID:
            if tag in ("br", "hr", "wbr", "img"):
                if tag == "hr":
                    flush()
                elif tag != "wbr":
                    say(" ")
            continue
        closing = bool(m[2])
        if tag == "a":
            link_depth = max(0, link_depth - 1) if closing else 1
            continue
        if tag not in _BLOCK and tag not in _DROP and tag not in ("span", "ins") and "-" not in tag:
            continue  # inline marks neither end a block nor hold one, so unclosed ones do no harm
        if closing:
            depth = len(stack) - 1
            while depth > 0 and stack[depth].tag != tag:
                depth -= 1
            if depth > 0:
                if tag in _BLOCK:
                    flush()
                    link_depth = 0
                elif any(n.tag in _BLOCK for n in stack[depth + 1 :]):
                    continue
                del stack[depth:]
            elif tag in _BLOCK:
                flush()
            continue
        if tag in ("html", "body") and any(n.tag == tag for n in stack[1:]):
            continue
        if tag in _BLOCK:
            flush()
            link_depth = 0
            for ends, stop in _IMPLIED.get(tag, _IMPLIED["*"]):
                depth = len(stack) - 1
                while depth > 0 and stack[depth].tag not in ends and stack[depth].tag not in stop:
                    depth -= 1
                if depth > 0 and stack[depth].tag in ends:
                    del stack[depth:]
        parent = stack[-1]
        raw = m[4] or ""
        attributes = _attributes(raw)
        inside = any(n.tag in ("article", "main") for n in stack)
        drop, soft, guess = _dropped(tag, attributes, raw, inside)
        if tag in ("h1", "main", "article") and not drop and parent.drop and not any(n.drop and not n.soft for n in stack):
            for n in stack:  # what holds the headline is the page after all
                n.drop = n.soft = False
        name = tag
        if "class" in attributes:
            name += "." + ".".join(sorted(_DIGITS.sub("#", attributes["class"].lower()).split()))
        path = parent.path if tag == "html" else f"{parent.path}/{name}"
        if len(path) > LONGEST_PATH:
            path = f"~{xxhash.xxh64_hexdigest(path.encode('utf-8', 'surrogatepass'))}"
        node = _Node(tag, path, parent, drop or parent.drop, soft if drop and not parent.drop else not drop and parent.soft, guess)
        if node.drop and not parent.drop and tag not in _BLOCK:
            say(" ")
        if not m[0].endswith("/>") or tag in _BLOCK:
            stack.append(node)
            nodes.append(node)
    if at < len(page):
        rest = page[at:]
        cut = rest.rfind("<")
        say(rest if cut < 0 or not re.match(r"</?[a-zA-Z!]", rest[cut:]) else rest[:cut])
    flush()
    if any(n.guess for n in nodes):
        blocks = _without_link_lists(nodes, blocks)
    return nodes, blocks


def _without_link_lists(nodes: list[_Node], blocks: list) -> list:
    """Drops the parts whose names leave it open and that are mostly links."""
    text, links = {id(n): n.text for n in nodes}, {id(n): n.links for n in nodes}
    for n in reversed(nodes):
        if n.parent is not None:
            text[id(n.parent)] += text[id(n)]
            links[id(n.parent)] += links[id(n)]
    for n in nodes:
        n.drop = n.drop or n.parent is not None and n.parent.drop or n.guess and links[id(n)] > LINKED * text[id(n)]
    return [b for b in blocks if not b[0].drop]


_SECTIONING = frozenset("div article section main aside nav header footer body td th table form blockquote figure fieldset details".split())
_IMPLIED = {
    "li": [(frozenset(["li"]), frozenset(["ul", "ol", "menu"]) | _SECTIONING - {"div"})],
    "dt": [(frozenset(["dt", "dd"]), frozenset(["dl"]))],
    "dd": [(frozenset(["dt", "dd"]), frozenset(["dl"]))],
    "tr": [(frozenset(["tr"]), frozenset(["table"]))],
    "td": [(frozenset(["td", "th"]), frozenset(["tr", "table"]))],
    "th": [(frozenset(["td", "th"]), frozenset(["tr", "table"]))],
    "option": [(frozenset(["option"]), frozenset(["select"]))],
    "*": [(frozenset(["p"]), _SECTIONING | {"li", "dd", "dt", "ul", "ol"})],
}


def _scores(nodes: list[_Node]) -> dict[int, float]:
    """The score of each node: its text, less one and a half times what lies in links."""
    total: dict[int, float] = {}
    for node in reversed(nodes):
        own = total.get(id(node), 0.0) + max(0.0, node.text - 1.5 * node.links)
        total[id(node)] = own
        if node.parent is not None and not node.drop:
            total[id(node.parent)] = total.get(id(node.parent), 0.0) + own
    return total


def choose(nodes: list[_Node]) -> tuple[_Node | None, dict[int, float]]:
    """The page's main or article if there is one such, else the smallest container with all of the text; and all scores."""
    total = _scores(nodes)
    at = nodes[0]
    if total[id(at)] <= 0:
        return None, total
    for tag, share in (("main", 0.5), ("article", ALONE)):
        own = [n for n in nodes if n.tag == tag and not n.drop and total[id(n)] > 0 and not _within(n.parent, tag)]
        own = [n for n in own if _within(n, at)]
        if len(own) == 1 and total[id(own[0])] >= share * total[id(at)]:
            at = own[0]
    children: dict[int, list[_Node]] = {}
    for n in nodes[1:]:
        if not n.drop:
            children.setdefault(id(n.parent), []).append(n)
    while at.tag != "article":
        inner = max(children.get(id(at), []), key=lambda n: total[id(n)], default=None)
        if inner is None or total[id(inner)] < total[id(at)] - 1e-6 or inner.tag not in _CONTAINER:
            break
        at = inner
    return at, total


def _within(node: _Node | None, top) -> bool:
    """Whether a node is top, or below it; top is a node or the name of a tag."""
    while node is not None:
        if node is top or node.tag == top:
            return True
        node = node.parent
    return False


def _container(node: _Node) -> _Node:
    while node.parent is not None and node.tag not in _CONTAINER:
        node = node.parent
    return node


def _outside(node: _Node) -> bool:
    return not _within(node, "article") and not _within(node, "main")


def _key(text: str) -> int:
    """A signed 64-bit hash."""
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


def _block_key(node: _Node, text: str) -> int:
    """What names a block on its host: its container's path and its text but for numbers and capitals."""
    return _key(f"{_container(node).path}\n{_DIGITS.sub('#', text.lower())}")


def _without_furniture(blocks: list, furniture: frozenset[int] | set[int]) -> list:
    """The blocks that are not a host's furniture, whose text no longer counts for its nodes."""
    kept = []
    for node, text, share in blocks:
        if _outside(node) and _block_key(node, text) in furniture:
            node.text -= len(text)
            node.links -= int(len(text) * share)
        else:
            kept.append((node, text, share))
    return kept


def vote(page: str | None, furniture=frozenset()) -> tuple[str, float]:
    """The generalised path of the page's own choice and its score."""
    return look(page, furniture)[0] if page else ("", 0.0)


def look(page: str, furniture=frozenset()) -> tuple[tuple[str, float], int, list[tuple[int, int, int]]]:
    """(vote, a hash of the longest block, the blocks outside articles as (key of the container, key, characters)) of a page."""
    nodes, blocks = read(page)
    if furniture:
        blocks = _without_furniture(blocks, furniture)
    node, total = choose(nodes)
    if node is None:
        return ("", 0.0), 0, []
    longest = max((text for _, text, _ in blocks), key=len)
    return (node.path, total[id(node)]), _key(longest), [(_key(_container(n).path), _block_key(n, text), len(text)) for n, text, _ in blocks if _outside(n)]


def extract(page: str | None, path: str | None, furniture=frozenset()) -> str:
    """The page's main text without its host's furniture, by its host's path where that holds enough of it."""
    if not page:
        return ""
    nodes, blocks = read(page)
    if furniture:
        blocks = _without_furniture(blocks, furniture)
    own, total = choose(nodes)
    if own is None:
        return ""
    certain = []
    if path and path != own.path:
        there = [n for n in nodes if n.path == path and not n.drop]
        if there and sum(total[id(n)] for n in there) >= USE * total[id(own)]:
            certain = there
    wanted = [any(_within(node, t) for t in certain) or _within(node, own) and not (certain and share > LINKED) for node, _, share in blocks]
    if own.tag in ("main", "article") and True in wanted and not any(w and _within(node, "h1") for w, (node, *_) in zip(wanted, blocks)):
        first = wanted.index(True)
        before = [k for k in range(first) if _within(blocks[k][0], "h1")]
        for k in range(before[-1] if before else first, first):
            wanted[k] = blocks[k][2] <= LINKED
    return "\n".join(text for w, (_, text, _) in zip(wanted, blocks) if w)


_SEEN = "host string, path string, score double, beside long, container long, block long, chars long"


def _seen(batches):
    """A row with the vote of each page, and one for each of its blocks outside articles."""
    for batch in batches:
        rows = []
        for k, (page, furniture) in enumerate(zip(batch.column("html").to_pylist(), batch.column("furniture").to_pylist())):
            if not page:
                continue
            (path, score), beside, blocks = look(page, frozenset(furniture or ()))
            rows.append((k, path, score, None, None, None, None))
            rows += [(k, None, None, beside, *block) for block in blocks]
        at, *columns = zip(*rows) if rows else [()] * 7
        kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays([batch.column("host").take(pa.array(at, pa.int64())), *arrays], names=["host", "path", "score", "beside", "container", "block", "chars"])


def _texts(batches):
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("html", "path", "furniture")]
        texts = [extract(h, p, frozenset(f or ())) for h, p, f in zip(*columns)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def _hosted(pages: DataFrame, url: str) -> DataFrame:
    host, _ = host_and_path(F.col(f"`{url}`"))
    return pages.withColumn("__host", F.coalesce(host, F.lit("")))


def _furniture(seen: DataFrame) -> DataFrame:
    """(host, furniture): the keys of the repeated blocks of each host's furniture; hosts without any are left out."""
    # a block stands beside the longest one of its page, and beside itself if it is that: copies count once, and so do pages of one block
    each = seen.where("block IS NOT NULL").groupBy("host", "container", "block").agg(F.countDistinct("beside").alias("pages"), F.sum("chars").alias("chars"))
    each = checkpoint(each.withColumn("repeats", F.col("pages") >= LEAST_PAGES))
    share = each.groupBy("host", "container").agg((F.sum(F.when(F.col("repeats"), F.col("chars")).otherwise(0)) / F.sum("chars")).alias("share"))
    kept = each.where("repeats").join(share.where(F.col("share") >= REPEATED), ["host", "container"], "left_semi")
    return kept.groupBy("host").agg(F.collect_set("block").alias("furniture"))


def _paths(seen: DataFrame) -> DataFrame:
    """(host, path): the path with the most votes of each host; a page votes with the log of its score."""
    counted = seen.where("path != ''").groupBy("host", "path").agg(F.sum(F.log1p("score").cast("decimal(38,6)")).alias("votes"))
    return counted.groupBy("host").agg(F.max_by("path", F.struct("votes", "path")).alias("path"))


def consensus(pages: DataFrame, url="url", html="html") -> DataFrame:
    """(host, path, furniture): what each host's pages agree on."""
    rows = _hosted(pages, url).select(F.col("__host").alias("host"), F.col(f"`{html}`").alias("html"))
    none = F.array().cast("array<bigint>")
    seen = checkpoint(rows.select("host", "html", none.alias("furniture")).mapInArrow(_seen, _SEEN))
    furniture = checkpoint(_furniture(seen))
    size = furniture.agg(F.sum(F.length("host") + 8 * F.size("furniture"))).first()[0] or 0
    if not size:
        return _paths(seen).withColumn("furniture", none)
    furniture = broadcast_if_small(furniture, size, BROADCAST_CHARS)
    again = rows.join(furniture, "host").select("host", "html", "furniture").mapInArrow(_seen, _SEEN)
    votes = seen.where("path IS NOT NULL").join(furniture.select("host"), "host", "left_anti").select("host", "path", "score")
    return _paths(votes.unionByName(again.where("path IS NOT NULL").select("host", "path", "score"))).join(furniture, "host", "left")


def host_paths(pages: DataFrame, url="url", html="html") -> DataFrame:
    """(host, path): the winning path of each host."""
    return consensus(pages, url, html).select("host", "path")


def extract_pages(pages: DataFrame, id_col="page_id", url="url", html="html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row of pages."""
    agreed = checkpoint(consensus(pages, url, html))
    rows = _hosted(pages, url).select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"), F.col("__host").alias("host")
    )
    size = agreed.agg(F.sum(F.length("host") + F.length("path") + 8 * F.coalesce(F.size("furniture"), F.lit(0)))).first()[0] or 0
    joined = rows.join(broadcast_if_small(agreed, size, BROADCAST_CHARS), "host", "left")
    return joined.select("page_id", "url", "html", "path", "furniture").mapInArrow(
        _texts, "page_id long, url string, text string, n_chars long"
    )
