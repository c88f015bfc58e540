"""Main text of web pages by wrappers: union-free regular expressions inferred per host.

A page is a stream of block tags and text. Streams of one host are aligned one after the other: equal tags unify,
neighbours that repeat become a repeated element or group, tags that only some pages have become optional, and texts
become slots with the number of pages that have them, their characters and whether they ever differ between pages.

The finished wrapper says which slots are the article. Text that stays the same over the host's pages is template. From the
page down, the wrapper is followed into the block that holds most of the text that varies, until none does; that block is
the article, without elements that HTML or their names mark as menus, notices and the like. Constant text stays where it stands
between text that varies; before the first and behind the last such text it is template, but headings and quotations stay,
and in an article element everything but constant elements that are no block of text. Every page is then matched against its host's wrapper and its slots are read.

Each task aligns the pages that it reads into one wrapper per host; only wrappers are shuffled, first over salted
hosts, so a host with a third of all pages is neither collected nor read by one task. A wrapper holds no texts, only digests.

Defined cases: null and empty pages and pages without an article's text give an empty text; pages with a null or
odd url share the host ''; unclosed, misnested and cut-off markup is closed as HTML's rules imply; elements nested deeper
than DEPTH are taken as neighbours at that depth, still outside or inside an article as their ancestors are; on hosts of
fewer than TEMPLATE_PAGES pages, or whose pages are all the same, nothing is taken for constant; repeated rows give
repeated results; an empty table gives no rows; other columns pass through, one named text is replaced; a very long page is
read whole, in time that grows with its blocks.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, staged

# What HTML calls void or raw, tags that do not break a block, tags and names of what is no article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|iframe|textarea|title"
MEDIA = frozenset("svg math object canvas audio video template picture map".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
OUTSIDE = MEDIA - {"picture", "map"} | frozenset("head nav header footer aside form button select option dialog menu".split())
OUTSIDE_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies footer header login menu modal nav navbar navigation newsletter"
    " notice notices popup promo promoted reactions related replies share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
#: Elements that hold one block of text: only a name of their own, not a part of one, marks them.
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption dt dd td th caption".split())
#: At an edge of an article these stay although every page has them.
KEPT = frozenset("h1 h2 h3 h4 h5 h6 blockquote pre figcaption".split())
#: Words of a name that say nothing of what an element holds.
PLAIN_NAMES = frozenset(
    "0 area bar block body bottom box btn button buttons card col column container content group inner item items layer left line link links list main media module outer panel"
    " right row section site slot text title top unit wrap wrapper zone".split()
)
ARTICLE_NAMES = frozenset("article articlebody content entry main post story".split())
CLOSED_BY = {
    "p": frozenset(
        "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
    ),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option", "optgroup"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "thead": frozenset(["tbody", "tfoot"]), "tbody": frozenset(["tbody", "tfoot"]), "head": frozenset(["body"]),
}

DEPTH = 100
#: Longest repeated group of neighbours.
GROUP = 4
#: Streams up to so many keys, by so many, are aligned by their longest common runs; in longer ones a key is looked for so far ahead.
NEAR = 400
#: Hosts' wrappers go to as many tasks before they meet.
SALTS = 32
#: Hosts whose wrappers a task keeps while it reads pages.
HOSTS = 2000
#: Wrappers of up to so many characters in all are sent to every executor; more are joined by host.
BROADCAST_CHARS = 16_000_000
#: Hosts need so many pages before a text counts as constant; it must stand on half of them, too.
TEMPLATE_PAGES = 3
#: Share of a block's varying text that one of its elements must hold to stand for all of it.
DENSE = 0.7

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<raw>{RAW})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*>?|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|</?[a-z][^>]*(?:>|\Z)",
    re.I | re.S,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

# A node is [key, many, optional, pages, children]; a text slot has the key "#", whether it is content for pages, and
# [pages, characters, digest or None once texts differ between pages] for children; a repeated group has the key
# "(". The root's pages are all of the host's. Pages have plain strings for text nodes.


def _key(tag: str, attrs: str) -> str:
    names = " ".join(x for m in _NAMES.findall(attrs) for x in m if x) if "=" in attrs else ""
    return " ".join([tag, *dict.fromkeys(re.sub(r"\d+", "0", names.lower()).split())])


def _marks(name: str) -> bool:
    """Whether a name is one of the list, or made of one and of words that say nothing else: what it ends with, or what it begins
    with before plain words only, so comment-list and site-header count, and notice-of-method does not."""
    words = [w for w in re.split(r"[-_]+", name) if w]
    while len(words) > 1 and words[-1] in PLAIN_NAMES:
        words.pop()
    return name in OUTSIDE_NAMES or (bool(words) and words[-1] in OUTSIDE_NAMES)


def outside(key: str) -> bool:
    """Whether HTML or its names mark an element as no part of an article."""
    tag, *names = key.split(" ")
    return tag in OUTSIDE or (not OUTSIDE_NAMES.isdisjoint(names) if tag in TEXTUAL else any(map(_marks, names)))


def _digest(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=9).hexdigest()


def page_tree(html: str | None) -> list:
    """A page as nested [key, children]; children are such lists and texts (one string a block, references decoded)."""
    root: list = ["", []]
    stack, text, at = [root], [], 0
    html = html or ""
    kinds = [""]  # of the open elements: what they and their ancestors make of their text
    closed: dict[str, int] = {}

    def flush() -> None:
        if text and (block := " ".join(entities.unescape("".join(text)).split())):
            stack[-1][1].append(block)
        text.clear()

    for m in _TOKEN.finditer(html):
        text.append(html[at : m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            if m["raw"] and m["raw"].lower() not in ("script", "style"):  # these show nothing, not even a gap
                text.append(" ")
            continue
        if m["end"]:
            if tag in INLINE and not any(x[0].split(" ", 1)[0] == tag for x in stack[-1:]):
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0].split(" ", 1)[0] == tag:
                    flush()
                    del stack[k:], kinds[k:]
                    break
            continue
        key = _key(tag, m["attrs"])
        if tag in MEDIA and tag not in closed:
            closed[tag] = html.lower().rfind(f"</{tag}")
        # media that close themselves, or that nothing closes, hold nothing
        if tag in VOID or (tag in MEDIA and (m["attrs"].endswith("/") or closed[tag] < at)):
            text.append(" ")
            continue
        if tag in INLINE and not outside(key):
            continue
        flush()
        while len(stack) > 1 and tag in CLOSED_BY.get(stack[-1][0].split(" ", 1)[0], ()):
            stack.pop()
            kinds.pop()
        kind = kinds[-1] or ("aside" if outside(key) else "")
        kind = "article" if not kind and tag == "article" else kind
        kind = "aside" if kind == "article" and outside(key) else kind
        node: list = [key if len(stack) < DEPTH else kind or key, []]
        (stack[-1] if len(stack) < DEPTH else stack[DEPTH - 1])[1].append(node)
        stack.append(node)
        kinds.append(kind)
    text.append(html[at:])
    flush()
    return root


def _lift(children: list) -> list:
    """A page's children as wrapper nodes, repeats folded."""
    return _fold([["#", 0, 0, 0, [1, len(c), _digest(c)]] if isinstance(c, str) else [c[0], 0, 0, 1, _lift(c[1])] for c in children])


def _keys(nodes: list) -> list:
    return [n[0] if n[0] != "(" else ("(", *_keys(n[4])) for n in nodes]


def _unify(a: list, b: list, within: bool = False) -> list:
    """One node that covers both; within: they are neighbours on the same pages, so a slot's digest is of both texts."""
    many, optional = a[1] | b[1], a[2] | b[2]
    pages = max if within else int.__add__
    if a[0] == "#":
        (n, c, t), (m, d, u) = a[4], b[4]
        text = _digest(t + u) if within and t and u else t if t == u else None
        return ["#", many, optional, 0, [pages(n, m), c + d, text]]
    return [a[0], many, optional, pages(a[3], b[3]), _align(a[4], b[4], within)]


def _fold(nodes: list) -> list:
    """Neighbours with equal keys become one repeated element, then neighbouring groups one repeated group."""
    out: list = []
    for n in nodes:
        if out and out[-1][0] == n[0] != "(":
            out[-1] = _unify(out[-1], n, True)
            out[-1][1] = 1
        else:
            out.append(n)
    for size in range(2, GROUP + 1):
        k, keys, rest = 0, _keys(out), []
        while k < len(out):
            if k + 2 * size <= len(out) and keys[k : k + size] == keys[k + size : k + 2 * size] and not any(n[0] == "(" for n in out[k : k + size]):
                group = ["(", 1, 0, 1, out[k : k + size]]
                upto = k + size
                while keys[upto : upto + size] == keys[k : k + size]:
                    group[4] = [_unify(a, b, True) for a, b in zip(group[4], out[upto : upto + size], strict=True)]
                    upto += size
                rest.append(group)
                k = upto
            else:
                rest.append(out[k])
                k += 1
        out = rest
    return out


def _grouped(nodes: list, others: list) -> list:
    """Runs that another stream has as a repeated group become such a group here."""
    wanted = {tuple(_keys(n[4])) for n in others if n[0] == "("}
    sizes = sorted({len(w) for w in wanted}, reverse=True)
    if not sizes:
        return nodes
    keys, out, k = _keys(nodes), [], 0
    while k < len(nodes):
        size = next((s for s in sizes if tuple(keys[k : k + s]) in wanted), 0)
        out.append(["(", 0, 0, 1, nodes[k : k + size]] if size else nodes[k])
        k += size or 1
    return out


def _matches(a: list, b: list) -> list[tuple[int, int]]:
    """Places of equal keys in two streams, ascending in both. Ends that agree are matched first; what is left, if it is long,
    goes on with the nearest equal key, up to NEAR places ahead, so that time grows with the length."""
    first, last = 0, 0
    while first < min(len(a), len(b)) and a[first] == b[first]:
        first += 1
    while last < min(len(a), len(b)) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    x, y = a[first : len(a) - last], b[first : len(b) - last]
    pairs = [(k, k) for k in range(first)]
    if len(x) * len(y) <= NEAR**2:
        pairs += [(first + m.a + k, first + m.b + k) for m in SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks() for k in range(m.size)]
    else:
        at: dict = {}
        for j, key in enumerate(y):
            at.setdefault(key, []).append(j)
        after = 0
        for i, key in enumerate(x):
            places = at.get(key, [])
            k = bisect_left(places, after)
            if k < len(places) and places[k] < after + NEAR:
                pairs.append((first + i, first + places[k]))
                after = places[k] + 1
    return pairs + [(len(a) - k, len(b) - k) for k in range(last, 0, -1)]


def _align(a: list, b: list, within: bool) -> list:
    """One stream that covers both: what matches unifies, what doesn't is optional."""
    a, b = _grouped(a, b), _grouped(b, a)
    out, i, j = [], 0, 0
    for x, y in [*_matches(_keys(a), _keys(b)), (len(a), len(b))]:
        out += [[n[0], n[1], 1, n[3], n[4]] for n in (*a[i:x], *b[j:y])]
        if x < len(a):
            out.append(_unify(a[x], b[y], within))
        i, j = x + 1, y + 1
    return out if len(out) == len(a) == len(b) else _fold(out)


def infer(wrapper: list | None, tree: list) -> list:
    """The wrapper after one more page."""
    page = ["", 0, 0, 1, _lift(tree[1])]
    return page if wrapper is None else _unify(wrapper, page)


def _articlelike(key: str) -> bool:
    return key.split(" ", 1)[0] in ("article", "main") or not ARTICLE_NAMES.isdisjoint(key.split()[1:])


def mark(wrapper: list) -> list:
    """Sets for every slot whether it is content."""
    pages = wrapper[3]

    def part_of_template(n: list) -> bool:
        tag = n[0].split(" ", 1)[0]
        # a name that one page alone has says something about its article, not about the template
        return n[0] not in ("", "(") and outside(n[0]) and (tag in OUTSIDE or n[3] > 1 or pages < TEMPLATE_PAGES)

    def fixed(slot: list) -> bool:
        return pages >= TEMPLATE_PAGES and slot[2] is not None and slot[0] >= TEMPLATE_PAGES and 2 * slot[0] >= pages

    def mass(n: list, constant: bool) -> int:
        """Characters outside menus and the like that vary, or with constant=True all of them."""
        if n[0] == "#":
            return 0 if fixed(n[4]) and not constant else n[4][1]
        return 0 if part_of_template(n) else sum(mass(c, constant) for c in n[4])

    constant = mass(wrapper, False) == 0
    block, total = wrapper, mass(wrapper, constant)
    while total and not (block[0].split(" ", 1)[0] == "article"):
        parts = [c for n in block[4] for c in ([n] if n[0] != "(" else n[4])]
        held = [(mass(c, constant), c) for c in parts]
        most, best = max(held, key=lambda x: (x[0], _articlelike(x[1][0])), default=(0, None))
        rest = [c for m, c in held if m and c is not best]
        whole = any(c[0] == "#" or c[0].split(" ", 1)[0] in TEXTUAL or _articlelike(c[0]) for c in rest)
        named = best is not None and _articlelike(best[0]) and best[0].split(" ", 1)[0] in ("article", "main")
        if best is None or best[0] == "#" or best[0].split(" ", 1)[0] in TEXTUAL | {"ul", "ol", "dl", "li", "table"}:
            # an article element counts although something else is longer
            best = next((c for m, c in held if m and c[0].split(" ", 1)[0] == "article"), None)
            if best is None:
                break
        elif not named and (most < DENSE * total or whole):
            best = next((c for m, c in held if m and c[0].split(" ", 1)[0] in ("article", "main")), None)
            if best is None:
                break
        block, total = best, mass(best, constant)

    slots: list[tuple[list, str, bool]] = []  # of the block in order, with the element that holds them and whether that is the block

    def put(n: list, tag: str, direct: bool, inside: bool, out: bool) -> None:
        if n[0] == "#":
            n[3] = 0
            if inside and not out:
                slots.append((n, tag, direct))
            return
        if n[0] != "(":
            tag, direct = n[0].split(" ", 1)[0], n is block
        for c in n[4]:
            put(c, tag, direct, inside or n is block, out or part_of_template(n))

    def template(tag: str, direct: bool) -> bool:
        named = block[0].split(" ", 1)[0] == "article"
        return not direct and tag not in TEXTUAL if named else tag not in KEPT

    put(wrapper, "", True, False, False)
    varies = [k for k, (n, *_) in enumerate(slots) if not fixed(n[4])]
    for k, (n, tag, direct) in enumerate(slots):
        edge = not constant and not varies[0] <= k <= varies[-1] if varies else False
        n[3] = int(not (edge and template(tag, direct)))
    return wrapper


def _read(children: list, nodes: list, out: list[str]) -> bool:
    """Matches a page's children against wrapper nodes and reads the content slots. False where nothing matches."""
    flat = [m for n in nodes for m in ([n] if n[0] != "(" else n[4])]
    at: dict[str, list[int]] = {}
    for k, n in enumerate(flat):
        at.setdefault(n[0], []).append(k)
    k, good = 0, True
    for c in children:
        places = at.get("#" if isinstance(c, str) else c[0])
        if not places:
            good = False
            continue
        k = next((p for p in places if p >= k), places[-1])
        n = flat[k]
        if isinstance(c, str):
            if n[3]:
                out.append(c)
        else:
            good &= _read(c[1], n[4], out)
    return good


def extract(tree: list, wrapper: list | None) -> str:
    """A page's article by its host's wrapper; by its own where the wrapper does not cover it or reads nothing."""
    out: list[str] = []
    if wrapper is None or not _read(tree[1], wrapper[4], out) or not out:
        out = []
        _read(tree[1], mark(infer(None, tree))[4], out)
    return " ".join(out)


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


WRAPPER = "host string, wrapper string"


def _frame(held: dict[str, list]) -> pd.DataFrame:
    return pd.DataFrame({"host": list(held), "wrapper": [json.dumps(w) for w in held.values()]}, dtype=object)


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One wrapper per host of what a task reads in the order of hosts; one host is held at a time."""
    held: dict[str, list] = {}
    for batch in batches:
        for host, w in zip(batch["host"], batch["wrapper"], strict=True):
            if held and host not in held:
                yield _frame(held)
                held = {}
            w = json.loads(w)
            held[host] = w if host not in held else _unify(held[host], w)
    if held:
        yield _frame(held)


def host_wrappers(pages: DataFrame) -> DataFrame:
    """pages: host and html. Gives host and wrapper (JSON, marked)."""

    def induce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = {}
        for batch in batches:
            for host, page in zip(batch["host"], batch["html"], strict=True):
                held[host] = infer(held.get(host), page_tree(page))
            if len(held) > HOSTS:
                yield _frame(held)
                held = {}
        if held:
            yield _frame(held)

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _joined(batches):
            yield batch.assign(wrapper=[json.dumps(mark(json.loads(w))) for w in batch["wrapper"]])

    parts = pages.select("host", "html").mapInPandas(induce, WRAPPER)
    met = parts.repartition("host", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS))).sortWithinPartitions("host").mapInPandas(_joined, WRAPPER)
    return met.repartition("host").sortWithinPartitions("host").mapInPandas(finish, WRAPPER)


def main_texts(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """Replaces html by text, the article's."""
    kept = [c for c in pages.columns if c not in (html, "text")]
    host, stated, salt = (fresh(x, pages.columns) for x in ("host", "wrapper", "salt"))
    hosted = pages.select(*kept, html).withColumn(host, host_of(F.col(url)))
    wrappers = staged(host_wrappers(hosted.select(F.col(host).alias("host"), F.col(html).alias("html"))), "wrappers")
    schema = T.StructType([*(pages.schema[c] for c in kept), T.StructField("text", T.StringType())])
    held = wrappers.agg(F.coalesce(F.sum(F.length("wrapper")), F.lit(0))).first()[0]
    if held <= BROADCAST_CHARS:
        shared = pages.sparkSession.sparkContext.broadcast({r[0]: r[1] for r in wrappers.toLocalIterator()})
        joined, given = hosted, shared
    else:
        spread = wrappers.select(F.col("host").alias(host), F.col("wrapper").alias(stated), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(salt))
        joined = hosted.withColumn(salt, F.pmod(F.xxhash64(html), F.lit(SALTS)).cast("int")).join(spread, [host, salt], "left")
        given = None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, list | None] = {}
        for batch in batches:
            found = batch[stated] if given is None else batch[host].map(given.value.get)
            texts = []
            for name, page, w in zip(batch[host], batch[html], found, strict=True):
                if name not in known:
                    if len(known) > HOSTS:
                        known.clear()
                    known[name] = json.loads(w) if isinstance(w, str) else None
                texts.append(extract(page_tree(page), known[name]))
            yield batch[kept].assign(text=texts)

    return joined.mapInPandas(run, schema)
