"""Main-text extraction with union-free regular-expression wrappers, inferred per host.

Pages of one host mostly come from one template.  All different pages of a host are turned into
a wrapper: page by page, each is aligned with what the others gave, element by
element (the common elements of most text are paired).  Equal elements are unified; consecutive equal siblings fold into a repeated
group ``(...)+``; elements that one side lacks become optional ``(...)?``; texts that differ
become slots, texts that never do stay constants.  No alternatives arise, so the wrapper
is a union-free regular expression.  Its main container is found from the slots: from the root on, the
child with more than half of the text in slots (an ``article`` or ``main`` needs a third, and ends the
search), parts that are never article text (menus, forms, adverts, comments, ...) left aside.
Every page of the host is then cut with the wrapper: what its slots and groups hold in the container stays,
and blocks that are constants of the wrapper, the same in all of the host's ``LEAST`` or more different
pages, go (headings stay).  A page in which the main container is missing gets a wrapper of
its own, without constants.  Outside the container, names of classes tell what is no article
text; within it only those of adverts, comments, menus and the like do: a ``related-work`` section stays.

The wrapper does not depend on how Spark deals the pages.  A page's tree travels alone, its texts as 64-bit
hashes; a host's trees meet in groups of about ``GROUP`` by the pages' hashes, in their order, and the groups'
wrappers in groups of ``FAN``, so a host with a third of all pages is in no task as a whole.  A wrapper grows with the
template, not with the pages: an element's children that every page has are no more than the smallest page has, and where more than
``WIDEST`` others gather, equal ones become one optional repeated group (by tag alone, ``tag.*``, where that is not enough).

Blocks are the runs of text between block-level tags; ``<br>`` is white space.

Defined cases: null or empty html gives an empty text; broken markup is read as far as it
goes (unclosed elements end with their parent); a null url, or one without a host, is host
''; equal rows give equal rows; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import copy
import hashlib
import html as entities
import json
import pickle
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch, sketch
from .text import U64

GROUP = 256       # pages of a host that are aligned in one go, about
FAN = 16          # wrappers of such groups that are aligned in one go
WIDEST = 64       # optional children of an element before equal ones are taken together
MOST_CELLS = 40_000  # of an alignment table; longer lists of children are matched by their longest blocks
LEAST = 3
SALT = 32
MOST_DEPTH = 100  # the wrapper has deeper elements' children at this depth; pages are cut at any depth

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?|</?([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?",
                    re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
#: HTML's elements by kind.
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "object", "xmp"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
          "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup",
          "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot",
          "th", "thead", "tr", "ul"}
_ENDS_P = _BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "body", "html", "head"}
_NEVER = {"nav", "footer", "aside", "form", "button", "select", "option", "input", "label", "head", "menu", "dialog", "audio",
          "video", "canvas", "map"}
_LEAF = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "pre", "blockquote", "dt", "dd", "td", "th", "tr", "b", "i", "em", "strong",
         "span", "a", "u", "font", "ul", "ol", "dl", "figcaption", "#"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar", "form"}
_PARTS = (r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|cookies?|consent|gdpr|sidebar|widget|comments?|reply|replies|"
          r"disqus|nav\w*|menu\w*|breadcrumbs?|masthead|topbar|toolbar|share|sharing|social|newsletter|subscri\w+|signup|"
          r"login|popup|modal|overlay|pagination|pager|skip")
#: Words that an article's own sections may be named by.
_OUTSIDE = (r"banner|side|respond|discussion|foot|footer|header|related|recommend\w*|notices?|alert|copyright|legal|"
            r"disclaimer|search")
_NAMES, _ALL_NAMES = (re.compile(rf"(?:^|[\s_-])(?:{x})(?:$|[\s_-])", re.I) for x in (_PARTS, f"{_PARTS}|{_OUTSIDE}"))
ANYWHERE, OUTSIDE = 2, 1  # where a part is no article text


def _signature(tag: str, attributes: str) -> tuple[str, int]:
    """(tag with its classes and id, where it is no article text: 0 for nowhere)."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if attributes else {}
    found["class"] = re.sub(r"\b(?:article|entry|post|content)[-_]header\b", "", found.get("class", ""))
    names = " ".join(sorted(found.get("class", "").split()) + [f"#{x}" for x in found.get("id", "").split()])
    never = 0
    if (tag in _NEVER or found.get("role", "").lower() in _ROLES or "hidden" in found
            or found.get("aria-hidden", "").lower() == "true"):
        never = ANYWHERE
    elif tag not in ("html", "body", "article", "main") and names:
        plain = names.replace("#", " ")
        never = ANYWHERE if _NAMES.search(plain) else OUTSIDE if _ALL_NAMES.search(plain) else 0
    return f"{tag}.{re.sub(r'[0-9]+', '0', names)}" if names else tag, never


def events(page: str) -> Iterator[tuple[str, str, int]]:
    """("open", signature, never) / ("close", tag, 0) / ("text", text, 0), elements properly nested."""
    stack: list[str] = []
    count: Counter[str] = Counter()  # of the open elements

    def close(tag: str) -> Iterator[tuple[str, str, int]]:
        while stack:
            last = stack.pop()
            count[last] -= 1
            yield "close", last, False
            if last == tag:
                break

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            yield "text", entities.unescape(page[at:stop]), False
        if not m:
            return
        at = m.end()
        if m[1] is None:
            continue
        tag = m[1].lower()
        if page[m.start() + 1] == "/":
            if count[tag]:
                yield from close(tag)
            elif tag in _BLOCK or tag == "br":
                yield "text", "\n" if tag == "br" else "", False
                if tag in _BLOCK:
                    yield "cut", tag, False
            continue
        if tag in _RAW:
            if not m[0].endswith("/>"):
                done = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
                at = (page.find(">", done.start()) + 1 or end) if done else end
            continue
        if tag in _ENDS_P and count["p"]:
            inner = next(t for t in reversed(stack) if t in _BLOCK)
            if inner == "p":
                yield from close("p")
        for same in ({"li"} if tag == "li" else {"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th")
                     else {"tr"} if tag == "tr" else ()):
            if stack and stack[-1] == same:
                yield from close(same)
        signature, never = _signature(tag, m[2])
        if tag in _VOID:
            yield ("cut", tag, False) if tag == "hr" else ("text", "\n", False)
            continue
        stack.append(tag)
        count[tag] += 1
        yield "open", signature, never
        if m[0].endswith("/>") and tag not in _BLOCK:
            yield from close(tag)
    while stack:
        yield "close", stack.pop(), False


class Element:
    """A node of a page's tree or of a wrapper: signature, children, how often, texts."""

    __slots__ = ("sig", "never", "kids", "optional", "repeated", "text", "varies", "chars", "size", "texts")

    def __init__(self, sig: str, never: int = 0, text: str | bytes = "", chars: int = 0):
        self.sig, self.never, self.kids, self.text = sig, never, [], text
        self.optional = self.repeated = self.varies = False
        self.chars = self.size = chars  # its own, and with its children's
        self.texts = frozenset((text,) if text else ())  # that every page has here


def tree(page: str, name: Callable[[str], str | bytes] = str) -> Element:
    """``name``: what stands for a text."""
    root = Element("")
    path = [root]
    for kind, what, never in events(page):
        if kind == "open":
            if len(path) > MOST_DEPTH:
                path.append(path[-1])
                continue
            path[-1].kids.append(Element(what, never))
            path.append(path[-1].kids[-1])
        elif kind == "close":
            path.pop()
        elif kind == "text" and what.strip():
            text = " ".join(what.split())
            path[-1].kids.append(Element("#", 0, name(text), len(text)))
    return _fold(root)


def _fold(e: Element) -> Element:
    """Consecutive equal siblings become one repeated group, from the leaves up."""
    kids: list[Element] = []
    for kid in map(_fold, e.kids):
        if kids and kids[-1].sig == kid.sig and kids[-1].never == kid.never:
            kids[-1] = unify(kids[-1], kid, True)
            kids[-1].repeated = True
        else:
            kids.append(kid)
    e.kids, e.size = kids, e.chars + sum(k.size for k in kids)
    return e


def _aligned(a: list[Element], b: list[Element]) -> list[tuple[int, int]]:
    """Places of equal elements, in order on both sides; of all ways the one with most text in them."""
    left, right = [x.sig for x in a], [x.sig for x in b]
    if left == right:
        return [(i, i) for i in range(len(a))]
    if len(a) * len(b) > MOST_CELLS:
        return [(m.a + k, m.b + k) for m in SequenceMatcher(None, left, right, False).get_matching_blocks() for k in range(m.size)]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        here, below = best[i], best[i + 1]
        for j in range(len(b) - 1, -1, -1):
            most = below[j] if below[j] >= here[j + 1] else here[j + 1]
            if left[i] == right[j]:
                most = max(most, a[i].size + b[j].size + 1 + below[j + 1])
            here[j] = most
    pairs, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if left[i] == right[j] and best[i][j] == a[i].size + b[j].size + 1 + best[i + 1][j + 1]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs


def _as_optional(e: Element) -> Element:
    if not e.optional:
        e = copy.copy(e)
        e.optional = True
    return e


def _gathered(kids: list[Element]) -> list[Element]:
    """Not more than ``WIDEST`` optional children where equal signatures, or else equal tags, allow it."""
    for general in (False, True):
        if sum(k.optional for k in kids) <= WIDEST:
            break
        out: list[Element] = []
        place: dict[tuple[str, int], int] = {}
        for k in kids:
            sig = f"{k.sig.split('.')[0]}.*" if general else k.sig
            at = place.setdefault((sig, k.never), len(out)) if k.optional else len(out)
            if at == len(out):
                out.append(k)
            else:
                out[at] = unify(out[at], k)
                out[at].sig, out[at].repeated = sig, True
        kids = out
    return kids


def unify(a: Element, b: Element, one_page: bool = False) -> Element:
    """The smallest wrapper that matches what ``a`` and ``b`` match; both have one signature.

    ``one_page``: they repeat within a page, which has the texts of both.
    """
    out = Element(a.sig, min(a.never, b.never), a.text)
    out.optional, out.repeated = a.optional or b.optional, a.repeated or b.repeated
    out.varies, out.chars, out.size = a.varies or b.varies or a.text != b.text, a.chars + b.chars, a.size + b.size
    out.texts = a.texts | b.texts if one_page else a.texts & b.texts
    i = j = 0
    for k, m in [*_aligned(a.kids, b.kids), (len(a.kids), len(b.kids))]:
        out.kids += map(_as_optional, a.kids[i:k] + b.kids[j:m])
        if k < len(a.kids) and m < len(b.kids):
            out.kids.append(unify(a.kids[k], b.kids[m], one_page))
        i, j = k + 1, m + 1
    out.kids = _gathered(out.kids)
    return out


def expression(e: Element) -> str:
    """The wrapper as a union-free regular expression."""
    if e.sig == "#":
        inner = "#TEXT" if e.varies or e.repeated else e.text
    else:
        inner = f"<{e.sig}>" + "".join(map(expression, e.kids)) + f"</{e.sig.split('.')[0]}>" if e.sig else "".join(
            map(expression, e.kids))
    mark = {(False, False): "", (True, False): "?", (False, True): "+", (True, True): "*"}[e.optional, e.repeated]
    return f"({inner}){mark}" if mark else inner


def infer(pages: list[str]) -> Element:
    wrapper = tree(pages[0])
    for page in pages[1:]:
        wrapper = unify(wrapper, tree(page))
    return wrapper


def _mass(e: Element, only_slots: bool) -> int:
    if e.never or e.sig.split(".")[0] == "header":
        return 0
    if e.sig == "#":
        return e.chars if e.varies or e.repeated or not only_slots else 0
    return sum(_mass(k, only_slots) for k in e.kids)


def _named(e: Element, tags: tuple[str, ...], path: list[str]) -> list[str] | None:
    if e.never:
        return None
    here = [*path, e.sig] if e.sig else path
    if e.sig.split(".")[0] in tags:
        return here
    found = [(p, k) for k in e.kids if (p := _named(k, tags, here))]
    return max(found, key=lambda x: _mass(x[1], False))[0] if found else None


def main_path(wrapper: Element) -> list[str]:
    """Signatures from the root to the main container."""
    slots = _mass(wrapper, True) > 0
    path: list[str] = []
    here = wrapper
    while here.sig.split(".")[0] not in ("article", "main"):
        total = _mass(here, slots)
        mass = [_mass(k, slots) for k in here.kids]
        named = [bool(_named(k, ("article", "main"), [])) for k in here.kids]
        share = [(3 if n else 2) * m for m, n in zip(mass, named, strict=True)]
        best = max(range(len(share)), key=lambda k: (share[k], named[k]), default=None)
        if best is None or not total or here.kids[best].sig.split(".")[0] in _LEAF or share[best] < total or share[best] == total and not named[best]:
            break
        if here.kids[best].sig.endswith(".*"):  # several elements, none of them the container
            break
        here = here.kids[best]
        path.append(here.sig)
    return path


def constants(wrapper: Element, path: list[str], pages: int) -> list[str]:
    """Texts within the main container that all of the wrapper's different pages have, but headings.

    Where there are few pages, or more constant text than text in slots (copies of one page), none.
    """
    here = wrapper
    for sig in path:
        here = next(k for k in here.kids if k.sig == sig)
    found: list[str] = []

    def walk(e: Element) -> None:
        for k in e.kids:
            if k.optional or re.match(r"h[1-6]\b", k.sig):
                continue
            if k.sig == "#":
                found.extend(k.texts)
            else:
                walk(k)

    walk(here)
    few = pages < LEAST or pages * sum(map(len, found)) >= _mass(here, True)
    return [] if few else sorted(set(found))


def _suffix(open_: list[str], path: list[str]) -> bool:
    return len(open_) >= len(path) and open_[-len(path):] == path if path else True


def cut(page: str, path: list[str], without: Iterable[str] = ()) -> tuple[list[str], bool]:
    """(blocks of article text in containers at ``path``, was there one); ``without`` these constant blocks."""
    open_: list[str] = []
    inside = left_out = 0   # depth at which the container, or a part left out, began
    head = 0                # depth of a header within the container: only its headings are text
    blocks: list[str] = []
    run: list[str] = []
    met = not path
    whole_page = not path or path[-1].split(".")[0] in ("html", "body")  # then a header may be the site's

    def done() -> None:
        text = " ".join("".join(run).split())
        if text and (text not in without or any(re.match(r"h[1-6]\b", t) for t in open_)):
            blocks.append(text)
        run.clear()

    for kind, what, never in events(page):
        if kind == "open":
            open_.append(what)
            tag = what.split(".")[0]
            if tag in _BLOCK:
                open_.pop()
                done()
                open_.append(what)
            if not inside and not left_out and path and _suffix(open_, path):
                inside, met = len(open_), True
            elif (never == ANYWHERE or never and not inside) and not left_out:
                left_out = len(open_)
            elif tag == "header" and not left_out and not head:
                if whole_page and not any(t.split(".")[0] in ("article", "main") for t in open_):
                    left_out = len(open_)
                else:
                    head = len(open_)
        elif kind == "close":
            if what in _BLOCK:
                done()
            depth = len(open_)
            inside, left_out, head = (0 if x == depth else x for x in (inside, left_out, head))
            open_.pop()
        elif kind == "cut":
            done()
        elif (inside or not path) and not left_out:
            if not head or any(re.match(r"h[1-6]\b", t) for t in open_[head:]):
                run.append(what)
    done()
    return blocks, met


def main_text(page: str | None, path: list[str] | None, without: Iterable[str] = ()) -> str:
    if not page:
        return ""
    blocks, met = cut(page, path, without) if path is not None else ([], False)
    if not met:
        blocks, _ = cut(page, main_path(infer([page])))
    return "\n".join(blocks)


def _name(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest()


def _packed(e: Element) -> tuple:
    return (e.sig, e.never, e.optional, e.repeated, e.varies, e.text, e.chars, e.size, b"".join(sorted(e.texts)),
            [_packed(k) for k in e.kids])


def _unpacked(row: tuple) -> Element:
    e = Element(row[0], row[1])
    e.optional, e.repeated, e.varies, e.text, e.chars, e.size = row[2:8]
    e.texts = frozenset(row[8][i:i + 8] for i in range(0, len(row[8]), 8))
    e.kids = [_unpacked(k) for k in row[9]]
    return e


_TREES = "host string, bucket long, k binary, pages long, h long, html string, tree binary"


def _trees(wanted: object, bits: object) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each page's tree, once a batch; those that may be their host's first page keep their html."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(1).to_numpy().view(U64)
            found: dict[tuple[str, bytes], tuple] = {}
            for host, h, first, page in zip(batch.column(0).to_pylist(), hashes.tolist(), wanted.value.may(hashes).tolist(),
                                            batch.column(2).to_pylist(), strict=True):
                k = hashlib.blake2b(page.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                if (host, k) not in found:
                    found[host, k] = (host, h >> (64 - bits.value.get(host, 0)), k, 1, h, page if first else None,
                                      pickle.dumps(_packed(tree(page, _name)), 5))
            host, bucket, k, one, h, html, trees = zip(*found.values(), strict=True) if found else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(host, pa.string()), pa.array(bucket, pa.int64()), pa.array(k, pa.binary()), pa.array(one, pa.int64()),
                 pa.array(np.array(h, U64).view(np.int64)), pa.array(html, pa.string()), pa.array(trees, pa.binary())],
                ["host", "bucket", "k", "pages", "h", "html", "tree"])
    return run


def _together(group: pd.DataFrame) -> pd.DataFrame:
    """One wrapper of a group's different pages, or of its wrappers."""
    group = group.drop_duplicates("k").sort_values("k")
    wrapper = None
    for row in group["tree"]:
        one = _unpacked(pickle.loads(row))
        wrapper = one if wrapper is None else unify(wrapper, one)
    first = group.iloc[[int(group["h"].argmin())]]
    return first.assign(k=group["k"].iloc[0], pages=int(group["pages"].sum()), tree=pickle.dumps(_packed(wrapper), 5))


def _with_texts(e: Element, texts: dict[bytes, str]) -> Element:
    e.text = texts.get(e.text, "#TEXT") if e.text else ""
    e.texts = frozenset(texts[x] for x in e.texts if x in texts)
    e.kids = [_with_texts(k, texts) for k in e.kids]
    return e


def _wrapper_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Constants are in every page, so one page has their texts."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            texts = {_name(text): text for kind, what, _ in events(row["html"] or "") if kind == "text" and (text := " ".join(what.split()))}
            wrapper = _with_texts(_unpacked(pickle.loads(row["tree"])), texts)
            path = main_path(wrapper)
            rows.append((row["host"], json.dumps(path), constants(wrapper, path, row["pages"]), expression(wrapper)))
        kinds = (pa.string(), pa.string(), pa.list_(pa.string()), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
                                         ["host", "path", "constants", "wrapper"])


def wrappers(pages: DataFrame, group: int = GROUP) -> DataFrame:
    """host, path (of the main container, JSON), constants and wrapper of every host, from all its pages (but empty ones)."""
    context = pages.sparkSession.sparkContext
    rows = pages.select(*_page(pages)).filter("html != ''").select("host", F.xxhash64("html").alias("h"), "html")
    hosts = scratch.stored(rows.select("host", "h").distinct().groupBy("host").agg(
        F.count("*").alias("pages"), F.min("h").alias("h")), "hosts")
    wanted = context.broadcast(sketch.members(hosts, "h", hosts.count()))
    large = {r["host"]: (-(-r["pages"] // group) - 1).bit_length() for r in hosts.filter(F.col("pages") > group).collect()}
    found = rows.mapInArrow(_trees(wanted, context.broadcast(large)), _TREES)
    for level in range(1 + -(-max(large.values(), default=0) // (FAN - 1).bit_length())):
        if level:
            found = found.withColumn("bucket", F.shiftright("bucket", (FAN - 1).bit_length()))
        found = found.groupBy("host", "bucket").applyInPandas(_together, _TREES)
    return found.select("host", "pages", "html", "tree").mapInArrow(
        _wrapper_rows, "host string, path string, constants array<string>, wrapper string")


def _page(pages: DataFrame) -> list:
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return [F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
            F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), host.alias("host")]


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page, json.loads(path) if path else None, frozenset(without or ()))
                 for page, path, without in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"])


def op5_html_extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    A host's pages meet its wrapper in ``SALT`` parts, so a host with a third of all pages is no hot key.
    """
    found = wrappers(pages).select("host", "path", "constants", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    rows = pages.select(*_page(pages)).withColumn("salt", F.pmod(F.xxhash64("page_id", "html"), F.lit(SALT)).cast("int"))
    return rows.join(found, ["host", "salt"], "left").select("page_id", "url", "html", "path", "constants").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long")
