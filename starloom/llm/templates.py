"""Main text of web pages, by site template removal.

Every element subtree of a page, outside the paragraphs of its article, gets a
hash of its tags, classes and text. Spark counts with how many different main
texts of a host each hash occurs; subtrees that recur in many of them are the
host's template and are deleted with all that is in them. What remains is filtered by the elements'
kinds (menus, page headers and footers, side bars, notices, adverts, forms,
scripts, styles, reader comments), and the article's blocks, or the body's
where no article is marked, are joined.
"""

from __future__ import annotations

import html as htmllib
import re
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import arrow_map, no_null, table

#: Elements whose content is not parsed, empty elements, elements that start a block.
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre section select summary table "
                   "tbody td tfoot th thead tr ul caption").split())
#: Elements and class or id words of what is no main text.
DROP_TAGS = frozenset("head nav header footer aside form button select option script style noscript template iframe svg canvas object "
                      "embed textarea input label fieldset dialog menu title noembed noframes audio video map math".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
DROP_WORDS = frozenset(("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
                        "notification alert popup modal overlay nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar side aside "
                        "rail widget widgets footer foot header masthead topbar toolbar comment comments disqus replies respond "
                        "share sharing social related recommended recommendations newsletter subscribe subscription signup login "
                        "search pagination pager copyright legal disclaimer skip").split())
#: Elements that box other blocks; inside an article they are counted, its own paragraphs and headings are not.
BOXES = frozenset("div section ul ol dl dir center table details".split())
#: A paragraph ends where one of these starts.
ENDS_P = BLOCK - {"body", "html", "td", "th", "tr", "li", "dd", "dt", "option", "optgroup", "tbody", "thead", "tfoot", "caption"}
SAME_LEVEL = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",),
              "option": ("select",)}
#: Elements nested deeper than this become siblings, as in browsers.
MAX_DEPTH = 512
#: A subtree that recurs with so many different main texts of a host, and this share of all it has, at least, is its template.
MIN_PAGES, MIN_SHARE = 3, 0.3

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|(?=<)|\Z)", re.S)
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I) for t in RAW}
_SPACE = re.compile(r"\s+")


@dataclass
class Element:
    tag: str
    words: frozenset
    children: list = field(default_factory=list)  # Elements and strings
    hidden: bool = False
    digest: int = 0


def _element(tag: str, attrs: str) -> Element:
    words, hidden = set(), False
    if attrs and ("=" in attrs or "hidden" in attrs):
        for k, a, b, c in _ATTR.findall(attrs):
            k, v = k.lower(), htmllib.unescape(a or b or c).lower()
            if k in ("class", "id"):
                words.update(re.split(r"[^a-z0-9]+", v))
                words.update(v.split())
            elif k == "role" and v in DROP_ROLES or k == "hidden" or k == "aria-hidden" and v == "true" or k == "style" and re.search(r"display\s*:\s*none", v):
                hidden = True
    return Element(tag, frozenset(words), hidden=hidden)


def parse(page: str) -> Element:
    """A tree of elements and decoded strings; unclosed and stray tags are mended as browsers do in the common cases."""
    root = Element("html", frozenset())
    stack, at = [root], 0
    add = lambda s: stack[-1].children.append(htmllib.unescape(s) if "&" in s else s)
    while (lt := page.find("<", at)) >= 0:
        m = _TOKEN.match(page, lt)
        if m is None:  # a bare less-than sign is text
            add(page[at:lt + 1])
            at = lt + 1
            continue
        if lt > at:
            add(page[at:lt])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "p" and not any(e.tag == "p" for e in stack[1:]):
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in ("article", "main", "body") and tag not in ("html", "body", "article", "main", "section", "div"):
                    break  # a stray end tag does not close the article
            continue
        if tag in ENDS_P or tag in SAME_LEVEL:
            stop = SAME_LEVEL.get(tag, ())
            for i in range(len(stack) - 1, 0, -1):
                t = stack[i].tag
                if t == "p" and tag in ENDS_P or stop and t == tag or {t, tag} in ({"dt", "dd"}, {"td", "th"}):
                    del stack[i:]
                    break
                if t in stop or t in BLOCK and not (tag in SAME_LEVEL and t in ("p", "div")):
                    break
        if tag in ("html", "body") and any(e.tag == tag for e in stack):
            continue
        e = _element(tag, m[3])
        stack[-1].children.append(e)
        if tag in RAW:
            end = _RAW_END[tag].search(page, at)
            at = end.start() if end else len(page)
            close = page.find(">", at)
            at = len(page) if close < 0 else close + 1
        elif tag not in VOID and not m[3].endswith("/") and len(stack) < MAX_DEPTH:
            stack.append(e)
    if at < len(page):
        add(page[at:])
    return root


def hash_subtrees(root: Element) -> None:
    """Sets every element's digest: tag, class words and the children's digests and texts."""
    order, todo = [], [root]
    while todo:
        e = todo.pop()
        order.append(e)
        todo += [c for c in e.children if isinstance(c, Element)]
    for e in reversed(order):
        h = xxhash.xxh3_64(e.tag.encode())
        h.update("\0".join(sorted(e.words)).encode())
        for c in e.children:
            h.update(b"\x01" + c.digest.to_bytes(8, "little") if isinstance(c, Element)
                     else b"\x02" + _SPACE.sub(" ", c).strip().encode("utf-8", "replace"))
        e.digest = h.intdigest()


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def is_noise(e: Element) -> bool:
    return e.tag in DROP_TAGS or e.hidden or bool(e.words & DROP_WORDS)


def content_root(root: Element) -> tuple[list[Element], bool]:
    """The outermost articles outside noise; else the main elements; else the page. True if the page marks its article."""
    for tag in ("article", "main"):
        found, todo = [], [root]
        while todo:
            e = todo.pop()
            if e.tag == tag:
                found.append(e)
            elif not (e.tag in DROP_TAGS or e.words & {"comment", "comments", "related", "sidebar", "recommended"}):
                todo += [c for c in reversed(e.children) if isinstance(c, Element)]
        if found:
            return found, True
    return [root], False


def template_digests(root: Element, mains: list[Element], marked: bool) -> tuple[set[int], set[int]]:
    """Digests of the subtrees the page adds to its host's counts, and of those that the main text may stand in.

    Where the article is marked, its own paragraphs are the author's text and
    no template, however often they are copied: neither they nor what holds
    the article is counted. Noise and boxes inside it are.
    """
    stop = {id(e) for e in mains} if marked else set()
    holders, todo = set(), [(root, ())]
    while todo:  # elements that hold a main element
        e, above = todo.pop()
        if id(e) in stop:
            holders.update(above)
        else:
            todo += [(c, (*above, id(e))) for c in e.children if isinstance(c, Element)] if stop else []
    tops, boxes, todo2 = [], [], [root]
    while todo2:  # the largest subtrees to hash
        e = todo2.pop()
        if id(e) in stop:
            inner = [c for c in e.children if isinstance(c, Element)]
            while inner:
                x = inner.pop()
                if is_noise(x):
                    tops.append(x)
                elif x.tag in BOXES:
                    boxes.append(x)
                else:
                    inner += [c for c in x.children if isinstance(c, Element)]
        elif e is root or id(e) in holders or e.tag in ("html", "body"):
            todo2 += [c for c in e.children if isinstance(c, Element)]
        else:
            tops.append(e)
    found: set[int] = set()
    for top in tops:
        hash_subtrees(top)
        todo2 = [top]
        while todo2:
            e = todo2.pop()
            if e.tag in BLOCK or is_noise(e):
                found.add(_signed(e.digest))
            todo2 += [c for c in e.children if isinstance(c, Element)]
    boxed: set[int] = set()
    for box in boxes:
        hash_subtrees(box)
        todo2 = [box]
        while todo2:
            e = todo2.pop()
            if is_noise(e):
                found.add(_signed(e.digest))
            elif e.tag in BOXES:
                boxed.add(_signed(e.digest))
            todo2 += [c for c in e.children if isinstance(c, Element)]
    return found | boxed, boxed if marked else found


def blocks(page: str) -> list[tuple[str, list[int]]]:
    """(text, digests of the counted subtrees it stands in) of each block of the main text."""
    return read(page)[0]


def read(page: str) -> tuple[list[tuple[str, list[int]]], set[int]]:
    """The blocks, and the digests of all counted subtrees."""
    root = parse(page)
    mains, marked = content_root(root)
    counted, inner = template_digests(root, mains, marked)
    out: list[tuple[str, list[int]]] = []
    run: list[str] = []

    def flush(path: tuple[int, ...]) -> None:
        text = _SPACE.sub(" ", "".join(run)).strip()
        run.clear()
        if text:
            out.append((text, [d for d in path if d in inner]))

    for top in mains:
        # (node, digests of the blocks around it, its end?); a block's start and end both end a run of text
        walk: list[tuple[Element | str, tuple[int, ...], bool]] = [(top, (), False)]
        while walk:
            node, path, end = walk.pop()
            if isinstance(node, str):
                run.append(node)
            elif end:
                flush(path)
            elif node is not top and is_noise(node):
                if node.tag in BLOCK:
                    flush(path)
            elif node.tag == "br":
                run.append(" ")
            elif node.tag in BLOCK:
                flush(path)
                own = (*path, _signed(node.digest))
                walk.append((node, own, True))
                walk += [(c, own, False) for c in reversed(node.children)]
            else:
                walk += [(c, path, False) for c in reversed(node.children)]
    return out, counted


def page_key(host: str, found: list[tuple[str, list[int]]]) -> int:
    """A 64-bit name of a main text on a host."""
    h = xxhash.xxh3_64(host.encode() + b"\0")
    for t, _ in found:
        h.update(t.encode("utf-8", "replace") + b"\n")
    return _signed(h.intdigest())


def of_host(host: str, digest: int) -> int:
    """A 64-bit name of a subtree on a host: all that the shuffles carry of both."""
    return _signed(xxhash.xxh3_64_intdigest(host.encode() + b"\0" + digest.to_bytes(8, "little", signed=True)))


_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/?#:]*)"


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """page_id, url, text, n_chars for every row.

    Null or empty html gives an empty text; a null url's pages count as one
    host; repeated rows and pages of the same main text count once when subtrees are
    counted, and each gets its text; an empty table gives an empty result.
    Other columns of ``pages`` are not read.
    """
    host = F.lower(F.regexp_extract(no_null(F.col("url").cast("string")), _HOST, 1))
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       host.alias("host"), no_null(F.col("html").cast("string")).alias("html"))

    def seen(b: pa.RecordBatch) -> pa.RecordBatch:
        keys, hosts, marks = [], [], []
        for h, x in zip(*(b.column(i).to_pylist() for i in range(2)), strict=True):
            text, counted = read(x)
            whole = of_host(h, 0)
            found = [whole, *(of_host(h, d) for d in sorted(counted))]  # a host is a subtree of all its pages
            keys += [page_key(h, text)] * len(found)
            hosts += [whole] * len(found)
            marks += found
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (keys, hosts, marks)], ["key", "host", "subtree"])

    def cut_up(b: pa.RecordBatch) -> pa.RecordBatch:
        keys, got = [], []
        for h, x in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            text = blocks(x)
            keys.append(page_key(h, text))
            got.append([{"text": t, "within": [of_host(h, d) for d in w]} for t, w in text])
        kind = pa.list_(pa.struct([("text", pa.string()), ("within", pa.list_(pa.int64()))]))
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keys, pa.int64()), pa.array(got, kind)],
                                          ["page_id", "url", "key", "blocks"])

    subtrees = arrow_map(src.select("host", "html"), seen, "key long, host long, subtree long").distinct()
    counts = subtrees.groupBy("subtree").agg(F.count("*").alias("n"), F.min("host").alias("host"))
    hosts = counts.where(F.col("subtree") == F.col("host")).select("host", F.col("n").alias("pages"))
    templates = (counts.where((F.col("n") >= min_pages) & (F.col("subtree") != F.col("host"))).join(hosts, "host")
                 .where(F.col("n") >= min_share * F.col("pages")))
    gone = (subtrees.join(templates.select("subtree"), "subtree", "left_semi")
            .groupBy("key").agg(F.collect_set("subtree").alias("gone")))  # a main text's own subtrees at most
    parts = arrow_map(src.select("page_id", "url", "host", "html"), cut_up,
                      "page_id long, url string, key long, blocks array<struct<text: string, within: array<bigint>>>")
    kept = F.filter("blocks", lambda b: ~F.arrays_overlap(b["within"], F.coalesce("gone", F.array().cast("array<bigint>"))))
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n")
    return (parts.join(gone, "key", "left")
            .select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars")))


def op8_template_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
