"""Main text of web pages by equivalence-class template deduction.

A page is a stream of tokens: tags and whole runs of text between tags, each
named with the structural path it stands under.  Tokens of one host that occur
equally often on every page share an occurrence vector and form an equivalence
class.  A class is part of the host's template when it is large (``MIN_SIZE``
tokens), frequent (``MIN_SHARE`` of the host's pages and at least ``MIN_PAGES``),
holds a tag (passages that copies of an article share form classes of text alone
and are content) and its tokens stand in one order on every page.  The valid classes
are nested by their places into the template.  What the template doesn't hold are its
slots; the text of the slots of the article is extracted, and blocks inside it that
are all template text (share lines, standing notices) go with the template.

The article is the ``article`` or ``main`` element the template holds (or, on hosts
with too few pages for a template, the page); pages without one use the whole
body.  Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles
and reader comments are left out by element and by whole class names or ids; where a
name can also be an article's own, if the template holds the tag.  A block ends
where a block-level element starts or ends; ``br`` is white space.

Occurrence vectors are compared by an XOR of hashes of (page, count), so they need one
map-side-combined aggregate and no page list; a host with a third of all pages is no
hot group.  Templates are small next to pages: Spark broadcasts their table when its
size allows, and splits the skewed join otherwise.

Support is counted over distinct articles: of the pages of a host with equal or
near-equal articles (``_copies``) one counts, so copies never make an article a template.

Null or empty html gives an empty text.  A null url is a host of its own.  Pages
that repeat each get their text.  Long pages are read whole.  Other columns are
not used.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import ship, stored

MIN_SIZE, MIN_SHARE, MIN_PAGES = 3, 0.3, 5
#: Share of an article's text that stands on other pages as well, from which it is a copy.
NEAR = 0.8

# Fixed values of HTML: elements by what they do to text.
RAW = frozenset("script style title textarea noscript iframe template svg math select object canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
STRUCTURE = frozenset("html head body nav header footer main article section aside form div table ul ol dl".split())
MAIN = frozenset(("article", "main"))
OUT = frozenset("head nav footer aside form button dialog menu".split())
OUT_WORDS = frozenset("ad ads advert adverts advertisement sponsor sponsored promo nav navbar navigation menu sidebar aside "
                      "footer breadcrumb breadcrumbs pagination pager cookie cookies consent gdpr notice notices banner alert "
                      "newsletter subscribe subscription signup login share sharing social related comment comments "
                      "commentlist disqus respond popup modal widget toolbar".split())
COMMENTS = frozenset("comment comments commentlist disqus respond".split())
# Words that only say where or how, and words that also name parts of an article.
QUALIFIERS = frozenset("site page main post article reader user top bottom left right primary secondary list area section "
                       "wrapper wrap container box block buttons button links link bar posts articles form item items".split())
WEAK = frozenset("notice notices alert banner promo share sharing social related menu modal popup widget toolbar".split())
TEXT_ELEMENTS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption caption".split())
# In a tag, a quote opens a value only after "="; any other is a character like others.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|\Z)?",
                   re.S)
#: One attribute: its name and its value, quoted or not.
ATTR = re.compile(r"([^\s=/>\"'][^\s=/>]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
TOLD = frozenset("class id role hidden aria-hidden".split())


def tokens(page: str | None) -> Iterator[tuple[str, str, str]]:
    """(kind, name, detail): open and close tags with their class, id and role, and
    text with its character references still in it.  Comments and raw elements are skipped."""
    page = page or ""
    at = 0
    while True:
        m = TOKEN.search(page, at)
        text = page[at:m.start() if m else len(page)]
        if text:
            yield "text", "", text
        if not m:
            return
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            yield "close", name, ""
            continue
        attrs = m[3] or ""
        yield "open", name, " ".join(f"{k.lower()}={v.strip('\"' + chr(39)).lower()}" for k, v in ATTR.findall(attrs)
                                     if k.lower() in TOLD)
        if name in RAW and not attrs.rstrip().endswith("/"):
            end = re.compile(rf"</{re.escape(name)}\b", re.I).search(page, at)
            at = end.start() if end else len(page)


def _hash(x: str) -> int:
    return xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) - (1 << 63)


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per page: each distinct token, its count and first place, its text's length within
    the article, and the hash of the whole article."""
    for b in batches:
        rows = []
        for host, page, page_html in zip(b["host"], b["page"], b["html"]):
            seen: dict[int, list[int]] = {}
            text: set[int] = set()
            article: list[str] = []
            at = 0
            for kind, name, detail, path, within in _scoped(page_html):
                words = " ".join(html.unescape(detail).split()) if kind == "text" else ""
                if kind == "text" and not words:
                    continue
                h = _hash(f"t|{path}|{words}") if words else _hash(f"{kind}|{path}|{name}|{detail}")
                one = seen.setdefault(h, [0, at, 0])
                one[0] += 1
                at += 1
                if words:
                    text.add(h)
                    if within:
                        one[2] += len(words)
                        article.append(words)
            body = _hash("\n".join(article))
            rows += [(host, page, h, h in text, n, at, chars, body) for h, (n, at, chars) in seen.items()]
        yield pd.DataFrame(rows, columns=["host", "page", "token", "is_text", "n", "place", "chars", "body"])


def _copies(seen: DataFrame) -> DataFrame:
    """(host, page) of all but one of the pages with an equal or near-equal article.  Articles
    of which ``NEAR`` stands on other pages too are near-equal if their longest such run is."""
    inside = seen.where("chars > 0")
    again = stored(inside.groupBy("host", "token").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= MIN_PAGES)
                   .select("host", "token", F.lit(True).alias("again")), "repeated-runs")
    per_page = inside.join(again, ["host", "token"], "left").groupBy("host", "page").agg(
        F.sum("chars").alias("all"), F.sum(F.when(F.col("again"), F.col("chars"))).alias("known"),
        F.max(F.when(F.col("again"), F.struct("chars", "token")))["token"].alias("longest"), F.max("body").alias("body"))
    bodies = stored(per_page.select("host", "page", F.when(F.col("known") >= NEAR * F.col("all"), F.col("longest"))
                                    .otherwise(F.col("body")).alias("body")), "page-bodies")
    first = bodies.groupBy("host", "body").agg(F.min("page").alias("first"))
    return stored(bodies.join(first, ["host", "body"]).where("page <> first").select("host", "page"), "page-copies")


def _nested(key: tuple, t: pd.DataFrame) -> pd.DataFrame:
    """One host's valid classes, most frequent first: a class joins the template when
    all its tokens lie in one slot of each class that is in already."""
    taken: list[tuple[int, list[float]]] = []
    out = []
    groups = sorted(t.groupby(["support", "sig"]), key=lambda g: (-g[0][0], g[1]["place"].min()))
    for k, (_, g) in enumerate(groups):
        places = sorted(g["place"])
        fits = all(len({sum(p < x for p in other) for x in places}) == 1 or
                   len({sum(p < x for p in places) for x in other}) == 1 for _, other in taken)
        if fits:
            taken.append((k, places))
            out += g["token"].tolist()
    return pd.DataFrame({"host": [key[0]], "template": [out]})


def templates(pages: DataFrame) -> DataFrame:
    """(host, template): the template's token hashes, from (host, page, html)."""
    every = stored(pages.mapInPandas(_counted, "host string, page long, token long, is_text boolean, n long, place long, "
                                               "chars long, body long"), "page-tokens")
    copies = _copies(every)
    seen = every.join(copies, ["host", "page"], "left_anti")
    size = pages.groupBy("host").agg(F.count(F.lit(1)).alias("rows")) \
        .join(copies.groupBy("host").agg(F.count(F.lit(1)).alias("gone")), "host", "left") \
        .select("host", (F.col("rows") - F.coalesce("gone", F.lit(0))).alias("pages"))
    vectors = seen.groupBy("host", "token", "is_text").agg(
        F.count(F.lit(1)).alias("support"), F.bit_xor(F.xxhash64("page", "n")).alias("sig"), F.avg("place").alias("place"))
    often = stored(vectors.join(size, "host").where((F.col("support") >= MIN_PAGES)
                                                    & (F.col("support") >= MIN_SHARE * F.col("pages"))).drop("pages"),
                   "frequent-tokens")
    classes = often.groupBy("host", "support", "sig").agg(F.count(F.lit(1)).alias("size"), F.min("is_text").alias("no_tag"))
    large = often.join(classes.where((F.col("size") >= MIN_SIZE) & ~F.col("no_tag")).select("host", "support", "sig"),
                       ["host", "support", "sig"])
    # In one order on every page: the places on a page rise as the mean places do.
    on_page = seen.select("host", "page", "token", F.col("place").alias("at")).join(large, ["host", "token"])
    ordered = on_page.groupBy("host", "support", "sig", "page").agg(
        F.array_sort(F.collect_list(F.struct("place", "at"))).alias("p")) \
        .select("host", "support", "sig", F.forall(F.transform("p", lambda x, i: F.coalesce(
            F.get(F.col("p"), i + 1)["at"] > x["at"], F.lit(True))), lambda ok: ok).alias("ok")) \
        .groupBy("host", "support", "sig").agg(F.min("ok").alias("ok")).where("ok").drop("ok")
    return large.join(ordered, ["host", "support", "sig"]).groupBy("host") \
        .applyInPandas(_nested, "host string, template array<long>")


def _words_out(name: str, detail: str, in_main: bool) -> str:
    """What an element's class, id and role say: "" (nothing), "comments", "out" or, where
    the template has to confirm it, "weak".  A name counts as a whole: all of its words."""
    if not detail or name in ("html", "body"):
        return ""
    names: set[str] = set()
    key = ""
    for part in detail.split():
        m = re.match(r"(class|id|role|hidden|aria-hidden)=", part)
        key, part = (m[1], part[m.end():]) if m else (key, part)
        if key == "hidden" or (key == "aria-hidden" and part == "true"):
            return "out"
        names.add(part)
    words = OUT_WORDS | {"hidden"} if in_main else OUT_WORDS | {"hidden", "header"}
    said = ""
    for n in names:
        parts = set(re.split(r"[^a-z0-9]+", n)) - {""}
        if not parts & words or not parts <= words | QUALIFIERS:
            continue
        if parts & COMMENTS:
            return "comments"
        if name not in TEXT_ELEMENTS and (len(parts) > 1 or not parts & WEAK):
            said = "out"
        said = said or "weak"
    return said


def _walked(toks: list[tuple[str, str, str]], template: frozenset[int], kept: frozenset[int] | None
            ) -> tuple[list[tuple[str, str, str, str, bool]], dict[int, tuple[str, int]], int]:
    """The tokens as ``_scoped`` gives them; what the elements say that are left out by their
    words, by place, and how much text each holds; the length of the text within.  With
    ``kept`` null, words leave nothing out; else they do but at the places in it."""
    has_main = any(k == "open" and n in MAIN for k, n, _ in toks)
    stack: list[tuple[str, bool, bool, int]] = []     # name, left out, in the article, place
    path: list[str] = []
    under = ""
    out_tokens = []
    said: dict[int, tuple[str, int]] = {}
    length = 0

    def closed(elements: list[tuple[str, bool, bool, int]]) -> None:
        for _, _, _, place in elements:
            if place in said:
                said[place] = said[place][0], length - said[place][1]

    for place, (kind, name, detail) in enumerate(toks):
        out, inside = (stack[-1][1], stack[-1][2]) if stack else (False, False)
        within = kind == "text" and not out and (inside or not has_main)
        out_tokens.append((kind, name, detail, under, within))
        if kind == "text":
            length += len(" ".join(detail.split())) if within else 0
            continue
        if kind == "open":
            if name not in VOID and name not in INLINE and name not in RAW:
                in_main = inside
                if name in MAIN and not inside:        # an element that was never closed doesn't hold the article
                    out, inside = False, True
                words = _words_out(name, detail, in_main or name in MAIN)
                if words == "weak" and (template or name in TEXT_ELEMENTS) \
                        and _hash(f"{kind}|{under}|{name}|{detail}") not in template:
                    words = ""
                if words:
                    said[place] = words, length
                    out = out or (kept is not None and place not in kept)
                stack.append((name, out or name in OUT or (name == "header" and not in_main), inside, place))
            if name in STRUCTURE:
                path.append(name)
                under = "/".join(path)
        else:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    closed(stack[i:])
                    del stack[i:]
                    break
            if name in path:
                del path[len(path) - 1 - path[::-1].index(name):]
                under = "/".join(path)
    closed(stack)
    return out_tokens, said, length


def _scoped(page: str | None, template: frozenset[int] = frozenset()) -> list[tuple[str, str, str, str, bool]]:
    """(kind, name, detail, path, within) of a page's tokens: the structural path they stand
    under and, for text, whether it belongs to the article.  An element that holds most of
    the text (readers' comments: all of it) is never left out by its words."""
    toks = list(tokens(page))
    every, said, length = _walked(toks, template, None)
    if not said:
        return every
    kept = frozenset(place for place, (words, held) in said.items() if 2 * held > length and words != "comments")
    some, _, left = _walked(toks, template, kept)
    return some if left else every


def main_text(page: str | None, template: frozenset[int] = frozenset()) -> str:
    """The text of the article's slots of one page."""
    blocks: list[str] = []
    now: list[tuple[str, bool]] = []                  # text, part of the template

    def close_block() -> None:
        words = " ".join("".join([t for t, _ in now]).split())
        if words and not all(known for t, known in now if t.strip()):
            blocks.append(words)
        now.clear()

    for kind, name, detail, path, within in _scoped(page, template):
        if kind == "text":
            if within:
                text = html.unescape(detail)
                words = " ".join(text.split())
                now.append((text, bool(words and template) and _hash(f"t|{path}|{words}") in template))
        elif name == "br":
            now.append((" ", False))
        elif name not in INLINE:
            close_block()
    close_block()
    return "\n".join(blocks)


def _extracted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[str, frozenset[int]] = {}
    for b in batches:
        texts = []
        for host, page, t in zip(b["host"], b["html"], b["template"]):
            if host not in known:
                if len(known) > 10_000:
                    known.clear()
                known[host] = frozenset() if t is None else frozenset(int(x) for x in t)
            texts.append(main_text(page, known[host]))
        yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": texts,
                            "n_chars": [len(t) for t in texts]})


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page_html: str = "html") -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars (code points)."""
    ship(pages.sparkSession)
    # Ids are strings on their way through Python, where numbers and nulls in one column lose digits.
    p = pages.select(F.col(f"`{key}`").cast("long").cast("string").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                     F.col(f"`{page_html}`").cast("string").alias("html")) \
        .withColumn("host", F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/?#:]*)", 1)),
                                       F.lit("")))
    # Rows that repeat get numbers of their own; the numbers are read back from a stored table.
    numbered = p.withColumn("page", F.monotonically_increasing_id())
    t = stored(templates(numbered.select("host", "page", "html")), "templates")
    return p.join(t, "host", "left").select("page_id", "url", "html", "host", "template") \
        .mapInPandas(_extracted, "page_id string, url string, text string, n_chars long") \
        .withColumn("page_id", F.col("page_id").cast("long"))
