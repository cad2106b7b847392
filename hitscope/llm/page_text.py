"""Main text of web pages by site template removal (operator 1).

Every page is parsed into elements. Each subtree gets a hash of its tag, attributes and content, menus
and footers as well as the article and what is in it; Spark counts, per host, in how many different pages a
subtree occurs, and recurring ones are deleted as template on every page, before any rule about names:
those found in a ``SHARE`` of the host's pages, and in ``MIN_PAGES`` at least, and beside an article or
main element those found in ``MIN_PAGES`` (a site's sections have menus of their own). Pages with equal content count once, and so do, for the subtrees inside it,
pages with an equal main part (the article or main with the most text, else the innermost container
with more than half of the page's text), so copies do not make content a template, whatever
stands around them. An article or main that would lose more than half of its text is a copy of
others rather than made of template, and loses nothing. What the counts leave goes by rules: containers that say what they are (menus, footers, sidebars, forms,
adverts, notices, comments, ...) unless they hold the main part, and if the page has an article
or main element, all beside it. ``removed`` tells how many subtrees went by counts and how many by rules.

Only hashes are shuffled. The templates of a host are one row, and Spark broadcasts that table while
it is small; the pages are shuffled by host only if it is not.

The blocks of what remains are joined in page order.

Defined results: null or empty html gives empty text; a null url is a host of its own; rows are
independent, so a repeated row gives its result again; broken markup is closed the way browsers
do for paragraphs and list items, unknown end tags are ignored; a page of any length or depth is read whole
in time linear in its length; an empty table gives an empty
table; only page_id, url and html are read, so extra columns never clash.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitscope.llm.textio import slices
from hitscope.session import scratch_path

#: Share of a host's different pages that a subtree must occur in to be template, and the least number of them.
SHARE = 0.5
MIN_PAGES = 3

# Element names by what they mean for the main text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
NEVER = set(
    "script style noscript template head title nav footer aside button select option textarea iframe object svg canvas audio video dialog menu map".split()
)
MAIN = {"article", "main"}
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "body": {"head"},
}
SCOPE = set("ul ol dl table tr article main section div body html aside nav header footer blockquote form".split())
CONTAINERS = set("div section form fieldset center table tbody tr td".split())
# Words in a class, id or role that mark a container as not part of the article.
BOILERPLATE = set(
    "ad ads advert adverts advertisement advertising advertorial banner breadcrumb breadcrumbs captcha comment comments complementary consent contentinfo"
    " cookie cookies copyright disclaimer disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices pager pagination paywall"
    " popup promo promoted promotion recommended related respond search share sharing sidebar signup skip social sponsor sponsored subscribe teaser toolbar"
    " tooltip widget widgets".split()
)
MAIN_EXCEPT = {"ad", "advert", "comment", "comments", "promo", "related", "sponsored", "teaser"}

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_SPECIAL = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PART = re.compile(r"[a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Tags:
    """The tags of a page in order, in time linear in its length: what was looked at in vain is not looked at again."""

    def __init__(self, markup: str):
        self.markup = markup
        self.last = markup.rfind(">")
        self.open_quotes: set[int] = set()  # quotes after which no tag ends

    def _end(self, at: int) -> int:
        """Where the tag whose name ends at ``at`` has its ``>``: quoted ones do not count, unless a quote is never closed."""
        seen, where = [], at
        while (special := _SPECIAL.search(self.markup, where)) and special.start() not in self.open_quotes:
            if special[0] == ">":
                return special.start()
            seen.append(special.start())
            where = self.markup.find(special[0], special.end()) + 1
            if not where:
                break
        self.open_quotes.update(seen)
        return self.markup.find(">", at)

    def after(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """Start, end, whether it closes, name and attributes of the first tag from ``at`` on; comments have no name."""
        markup = self.markup
        while (at := markup.find("<" if at <= self.last else "<!--", at)) >= 0:
            if markup.startswith("<!--", at):
                end = markup.find("-->", at + 4)
                return at, end + 3 if end >= 0 else len(markup), False, "", ""
            if markup[at + 1 : at + 2] in ("!", "?") and at < self.last:
                return at, markup.find(">", at) + 1, False, "", ""
            name = _NAME.match(markup, at) if at < self.last else None
            if name and name.end() <= self.last:
                end = self._end(name.end())
                return at, end + 1, bool(name[1]), name[2].lower(), markup[name.end() : end]
            at += 1
        return None


#: Where a subtree stands, in the two lowest bits of its hash: beside a main part without a name, inside one, beside an article or main element.
_PLACE, _IN_MAIN, _BESIDE_NAMED = 3, 1, 2


@dataclass
class Element:
    name: str
    attributes: str
    inside_main: bool
    dropped: bool
    parts: list[bytes]
    number: int


@dataclass
class Page:
    """Blocks of text with the number of the element around them, each element's parent (a smaller number), the hash of
    elements that may be template (the lowest bits tell where it stands), the outermost elements that rules take
    off, and hashes of all content and of the main part."""

    blocks: list[tuple[str, int, bool]]
    parent: list[int]
    hashes: dict[int, int]
    ruled: set[int]
    key: int
    main_key: int | None

    def counted(self) -> list[tuple[int, int]]:
        """Each hash with the content that it counts once for; 0 and 1 stand for the pages and main parts themselves."""
        out = {(h, self.main_key if h & _PLACE == _IN_MAIN else self.key) for h in self.hashes.values()}
        return [(0, self.key), *([] if self.main_key is None else [(1, self.main_key)]), *out]


def _down(parent: list[int], starts: Iterable[int]) -> list[bool]:
    """Which elements are one of ``starts`` or inside one."""
    out = [False] * len(parent)
    for n in starts:
        out[n] = True
    for n in range(1, len(parent)):
        out[n] |= out[parent[n]]
    return out


def _never(name: str, rest: str, inside_main: bool) -> bool:
    """An element that is not part of the text, whatever it holds."""
    if name in NEVER or name == "header" and not inside_main:
        return True
    for key, *values in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), "".join(values)
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and _HIDDEN.search(value):
            return True
    return name in MAIN and _is_beside(_marks(rest))


def _marks(rest: str) -> set[str]:
    """The words of the class, id and role."""
    marks: set[str] = set()
    for key, *values in _ATTRIBUTE.findall(rest):
        if key.lower() in ("class", "id", "role"):
            marks |= set(_PART.findall("".join(values).lower()))
    return marks


def _is_beside(marks: set[str]) -> bool:
    return bool(marks) and marks <= MAIN_EXCEPT


def parse(markup: str) -> Page:
    blocks: list[tuple[str, int, bool]] = []
    hashes: dict[int, int] = {}
    root = Element("", "", False, False, [], 0)
    stack = [root]
    opened: Counter[str] = Counter()
    buffer: list[str] = []
    articles: set[int] = set()
    marked: dict[int, set[str]] = {}
    containers: set[int] = set()
    dropped: set[int] = set()
    parent = [0]
    at = 0

    def flush() -> None:
        if buffer:
            text = " ".join(html.unescape("".join(buffer)).split())
            buffer.clear()
            top = stack[-1]
            if text:
                top.parts.append(text.encode("utf-8", "surrogatepass"))
                blocks.append((text, top.number, top.inside_main))

    def pop() -> None:
        done = stack[-1]
        if done.name not in INLINE:
            flush()
        stack.pop()
        opened[done.name] -= 1
        if done.name in INLINE:
            return
        value = xxhash.xxh3_64_digest("\x00".join((done.name, done.attributes)).encode("utf-8", "surrogatepass") + b"\x01" + b"\x02".join(done.parts))
        stack[-1].parts.append(value)
        if done.parts and done.name not in ("html", "body"):
            hashes[done.number] = int.from_bytes(value, "big", signed=True)

    tags = Tags(markup)
    while tag := tags.after(at):
        start, end, closes, name, rest = tag
        if start > at:
            buffer.append(markup[at:start])
        at = end
        if not name:
            continue
        if closes:
            if name == "br":
                buffer.append(" ")
            elif opened[name]:
                while stack[-1].name != name:
                    pop()
                pop()
            elif name not in INLINE:
                flush()
            continue
        if name in VOID:
            if name in ("br", "hr"):
                buffer.append(" ")
            continue
        if name not in INLINE:
            flush()
            while stack[-1].name in INLINE:
                opened[stack.pop().name] -= 1
            if stack[-1].name == "p":
                pop()
            for i in range(len(stack) - 1, 0, -1) if any(opened[n] for n in CLOSES.get(name, ())) else ():
                if stack[i].name in CLOSES.get(name, ()):
                    while len(stack) > i:
                        pop()
                    break
                if stack[i].name in SCOPE:
                    break
        top = stack[-1]
        count = len(parent)
        parent.append(top.number)
        plain = not rest.strip(" /")
        gone = top.dropped or (name in NEVER or name == "header" and not top.inside_main if plain else _never(name, rest, top.inside_main))
        if not gone and name not in MAIN and name not in ("html", "body"):
            marks = set() if plain else _marks(rest)
            if name == "form" or marks & BOILERPLATE:
                marked[count] = marks
        inside = not gone and (top.inside_main or name in MAIN)
        if inside and name in MAIN:
            articles.add(count)
        if name in CONTAINERS:
            containers.add(count)
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(markup, at)
            content = markup[at : close.start() if close else len(markup)]
            top.parts.append(f"<{name}{rest}>{content}".encode("utf-8", "surrogatepass")) if name not in ("script", "style", "title") else None
            at = markup.find(">", close.start()) + 1 if close else len(markup)
            at = at or len(markup)
            continue
        if rest.endswith("/") and name not in INLINE and name in ("path", "use", "circle", "rect"):
            continue
        if (gone or count in marked) and name in INLINE and not top.dropped:
            flush()
        if gone and not top.dropped:
            dropped.add(count)
        stack.append(Element(name, " ".join(rest.split()), inside, gone, [], count))
        opened[name] += 1
    if at < len(markup):
        buffer.append(markup[at:])
    while len(stack) > 1:
        pop()
    flush()
    key = int.from_bytes(xxhash.xxh3_64_digest(b"\x02".join(root.parts)), "big", signed=True)
    return _with_main_part(blocks, parent, hashes, articles, containers, marked, dropped, key)


def _with_main_part(
    blocks: list[tuple[str, int, bool]], parent: list[int], hashes: dict[int, int], articles: set[int], containers: set[int], marked: dict[int, set[str]], dropped: set[int], key: int
) -> Page:
    """The page with its main part; marked containers (number: words) that hold the main part are not taken off."""
    length, held = [0] * len(parent), [False] * len(parent)
    gone = _down(parent, dropped)
    for text, n, _ in blocks:
        if not gone[n]:
            length[n] += len(text)
            held[n] = True
    for n in range(len(parent) - 1, 0, -1):
        length[parent[n]] += length[n]
        held[parent[n]] |= held[n]
    other = _down(parent, (n for n, marks in marked.items() if _is_beside(marks)))
    perhaps = _down(parent, (n for n, marks in marked.items() if marks & MAIN_EXCEPT))

    def may_be_main(n: int) -> bool:
        return held[n] and not other[n] and (2 * length[n] > length[0] or not perhaps[n])

    shown = [n for n in articles if may_be_main(n)]
    if shown:
        main = max(shown, key=lambda n: (length[n], n))
        inside = _down(parent, [main])
        main = max(n for n in shown if inside[n] and 2 * length[n] > length[main])
    else:
        main = max((n for n in containers if 2 * length[n] > length[0] and may_be_main(n)), default=0)
    whole, n = {0, main}, main
    while n:
        n = parent[n]
        whole.add(n)
    ruled = dropped | (marked.keys() - whole)
    inside = _down(parent, [main] if main else [])
    place = _BESIDE_NAMED if shown else 0
    # what holds the main part is no template
    own = {n: h & ~_PLACE | (_IN_MAIN if inside[n] else place) for n, h in hashes.items() if n not in whole}
    return Page(blocks, parent, own, ruled, key, hashes.get(main))


def main_text(page: Page, template: set[int]) -> str:
    """The blocks that stay, joined by one space: first without template, then without what rules take off."""
    gone = _down(page.parent, (n for n, h in page.hashes.items() if h in template))
    ruled = _down(page.parent, page.ruled)
    whole = [b for b in page.blocks if not ruled[b[1]]]
    kept = [b for b in whole if not gone[b[1]]]
    article = [b for b in whole if b[2]]
    if article:
        left = [b for b in kept if b[2]]
        kept = left if 2 * sum(len(b[0]) for b in left) >= sum(len(b[0]) for b in article) else article
    return " ".join(b[0] for b in kept)


def removed(page: Page, template: set[int]) -> tuple[int, int]:
    """Outermost subtrees that the counts delete, and those that they leave to the rules."""
    gone = _down(page.parent, (n for n, h in page.hashes.items() if h in template))
    outer = sum(gone[n] and not gone[page.parent[n]] for n in range(1, len(gone)))
    return outer, sum(not gone[n] for n in page.ruled if n in page.hashes)


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in slices(batches, "html"):
        at, hashes, keys = [], [], []
        for i, markup in enumerate(rows.column("html").to_pylist()):
            own = parse(markup or "").counted()
            at += [i] * len(own)
            hashes += [h for h, _ in own]
            keys += [k for _, k in own]
        yield pa.RecordBatch.from_arrays([rows.column("host").take(pa.array(at, pa.int64())), pa.array(hashes, pa.int64()), pa.array(keys, pa.int64())], ["host", "hash", "key"])


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in slices(batches, "html"):
        found = [removed(parse(m), set(t or ())) for m, t in zip(rows.column("html").to_pylist(), rows.column("template").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([rows.column("page_id"), *(pa.array(c, pa.int64()) for c in (zip(*found, strict=True) if found else ((), ())))], ["page_id", "by_counts", "by_rules"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in slices(batches, "html"):
        templates = rows.column("template").to_pylist()
        found = [main_text(parse(markup), set(t or ())) for markup, t in zip(rows.column("html").to_pylist(), templates, strict=True)]
        yield pa.RecordBatch.from_arrays([rows.column("page_id"), rows.column("url"), pa.array(found, pa.string())], ["page_id", "url", "text"])


def _with_templates(pages: DataFrame, min_pages: int, share: float) -> DataFrame:
    """page_id, url, html and the hashes of the templates of its host of every page."""
    spark = pages.sparkSession
    source = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"))
    host = F.regexp_extract(F.lower(F.coalesce("url", F.lit(""))), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    source = source.withColumn("host", F.xxhash64(host))
    subtrees = source.select("host", "html").mapInArrow(_subtrees, "host long, hash long, key long")
    counts = subtrees.distinct().groupBy("host", "hash").count().where(F.col("count") >= min_pages)
    path = scratch_path(spark, "page_subtrees")
    counts.write.parquet(path)
    counts = spark.read.parquet(path)
    itself = F.col("hash").isin(0, 1)
    place = F.col("hash").bitwiseAND(F.lit(_PLACE).cast("long"))
    sizes = counts.where(itself).select("host", F.col("hash").alias("place"), F.col("count").alias("size"))
    many = counts.where(~itself).withColumn("place", place)
    named = many.where(F.col("place") == _BESIDE_NAMED).select("host", "hash")
    shared = many.where(F.col("place") != _BESIDE_NAMED).join(sizes, ["host", "place"]).where(F.col("count") >= share * F.col("size")).select("host", "hash")
    path = scratch_path(spark, "page_templates")
    named.union(shared).groupBy("host").agg(F.collect_list("hash").alias("template")).write.parquet(path)
    # read again, so that its size is known when the join is planned
    return source.join(spark.read.parquet(path), "host", "left").select("page_id", "url", "html", "template")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """page_id, url, text (main text), n_chars of every page."""
    texts = _with_templates(pages, min_pages, share).mapInArrow(_texts, "page_id long, url string, text string")
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def removals(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """page_id, by_counts, by_rules: outermost subtrees that go as template, and those left to the rules about names."""
    return _with_templates(pages, min_pages, share).mapInArrow(_removed, "page_id long, by_counts long, by_rules long")
