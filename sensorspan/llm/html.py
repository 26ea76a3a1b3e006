"""Main text of web pages by template deduction over the pages of a host.

A page is a sequence of tokens: its tags, each with the tags around it, and
its runs of text. Tokens of a host that occur equally often on each of its
pages share an occurrence vector and form an equivalence class. Classes that
span enough different pages are valid; together, nested as their
tags are, they are the template that the host's pages were made from. What
lies between template tokens are slots, and the article is what the slots of
the article's place hold; names of elements only choose between slots. Text of
the template inside an article, such as a notice on most pages, is no slot.

No vector is gathered. A vector is represented by sums over pages that
aggregate like any others: two independent 64-bit fingerprints and the
number of pages, so a host with a third of all pages is no more than many rows
of a partial aggregation.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved
from .urls import host_of

# Names of HTML elements and of the parts of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "noembed", "noframes", "xmp")
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section"
    " summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Tags that end an open paragraph, and tags that end an open tag of their own kind.
ENDS_P = BLOCK - frozenset("body caption dd dt head html legend option optgroup tbody td tfoot th thead tr".split()) | frozenset(["dd", "dt", "li"])
SIBLINGS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tr", "td", "th", "thead", "tbody"), "thead": ("tr", "td", "th"),
    "tfoot": ("tr", "td", "th", "thead", "tbody"),
}
SCOPES = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",)}
NOT_TEXT = frozenset(
    "script style textarea title noscript template iframe noembed noframes xmp head nav footer aside button select"
    " option svg math object canvas audio video map dialog menu datalist label input".split()
)
PAGE_HEADER = "header"
NOT_TEXT_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist".split()
)
NOT_TEXT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored promo promos promotion"
    " banner banners cookie cookies consent gdpr notice notices alert alerts popup popups modal overlay newsletter"
    " subscribe subscription signup login sidebar sidebars menu menus nav navs navbar navigation breadcrumb breadcrumbs"
    " pagination pager footer footers masthead topbar comment comments commentlist discussion disqus replies respond"
    " share sharing social related recommended recommendations widget widgets toolbar skip hidden noprint teaser".split()
)
COMMENT_NAMES = frozenset("comment comments commentlist discussion disqus replies respond".split())
OUTSIDE_NAMES = frozenset(["header", "headers", "toc"])
# Words that say only where such a part stands or what form it has.
QUALIFIERS = frozenset(
    "site page main top bottom left right primary secondary global local user reader post posts article articles list"
    " item items box block container wrapper wrap area section bar link links slot unit inner outer body form text title"
    " group panel row holder placeholder button buttons icons".split()
)
ARTICLE = ("article", "main")
ARTICLE_NAMES = frozenset("article content main post entry story maincontent articlebody postcontent entrycontent".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAMES = re.compile(r"[A-Za-z][a-z]*")
SPACES = re.compile(r"\s+")
RAW_END = {name: re.compile(rf"</{name}\b", re.I) for name in RAW}

MIN_PAGES = 3
LINKED = 0.5
# Template text makes up less than this share of an article; pages that share more are versions of one article.
MOST_TEMPLATE = 0.5


@dataclass
class Block:
    """A block of text, where it stands, and what its place says of it."""

    text: str
    token: int  # the hash of its path and its text
    article: int  # 0: outside, 1: by the name of an element, 2: in main, 3: in article
    holder: int  # the hash of the path of the element that says so
    linked: int  # characters inside links
    heading: bool
    removed: bool  # inside an element that is no article text
    part: _Part | None


@dataclass(eq=False)
class _Part:
    """An element that its name, or a form's tag, takes out of the text, unless it turns out to hold the article."""

    above: _Part | None
    form: bool
    holds: bool = False

    def stands(self) -> bool:
        return not (self.form and self.holds)


@dataclass(eq=False)
class _Open:
    tag: str
    path: xxhash.xxh64  # of the tags from the root to here, so that no path is held as text
    token: int
    removed: bool
    article: int
    holder: int
    link: bool
    blocks: bool
    block: _Open | None  # the nearest element around that makes a block; None: itself
    part: _Part | None


@dataclass(frozen=True)
class _Kind:
    """What a tag says by itself."""

    label: bytes
    removed: bool
    named_part: bool
    named_comment: bool
    outside: bool
    article: int


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)} if text.strip() else {}


def _whole(names: list[frozenset[str]], wanted: frozenset[str]) -> bool:
    """Whether a name says one of ``wanted`` and nothing else; `has-sidebar` is not a sidebar."""
    return any(n & wanted and n <= wanted | NOT_TEXT_NAMES | OUTSIDE_NAMES | QUALIFIERS for n in names)


@lru_cache(maxsize=1 << 14)
def _kind(tag: str, text: str) -> _Kind:
    own = _attributes(text)
    names = [frozenset(w.lower() for w in NAMES.findall(n)) for n in f"{own.get('class', '')} {own.get('id', '')}".split()]
    words = frozenset().union(*names)
    role = own.get("role", "").lower()
    page = tag in ("html", "body")  # a class there describes the page
    removed = tag in NOT_TEXT or role in NOT_TEXT_ROLES or "hidden" in own or own.get("aria-hidden", "").lower() == "true"
    removed |= bool(re.search(r"display\s*:\s*none", own.get("style", ""), re.I))
    article = 3 if tag == "article" else 2 if tag == "main" or role == "main" else int(not page and bool(words & ARTICLE_NAMES))
    return _Kind(
        f"/{tag}{'.' if words else ''}{'.'.join(sorted(words))}".encode("utf-8", "surrogatepass"),
        removed and not page,
        not page and _whole(names, NOT_TEXT_NAMES),
        not page and _whole(names, COMMENT_NAMES),
        not page and (tag == PAGE_HEADER or _whole(names, OUTSIDE_NAMES)),
        article,
    )


def _opened(tag: str, text: str, above: _Open) -> _Open:
    """The element that a tag opens inside ``above``."""
    kind = _kind(tag, text)
    path = above.path.copy()
    path.update(kind.label)
    token = path.intdigest() - (1 << 63)
    removed = above.removed or kind.removed or tag == PAGE_HEADER and not above.article
    part = above.part
    if not removed:
        # The names of an article say little of it, but inside another one they tell comments and teasers.
        if kind.article == 3 and above.article < 3:
            named = kind.named_comment and above.article == 2
        else:
            named = kind.article < 2 and (kind.named_part or kind.outside and not above.article) or kind.article == 3 and kind.named_part
        if named or tag == "form":
            part = _Part(part, not named)
        if kind.article >= 2 and above.article < 3:
            holder = part
            while holder and not holder.holds:
                holder.holds = True
                holder = holder.above
    article = max(above.article, 0 if removed else kind.article)
    blocks = tag in BLOCK
    around = None if blocks else above.block or above
    return _Open(
        tag, path, token, removed, article, token if article > above.article else above.holder, above.link or tag == "a", blocks, around, part
    )


def parse(page: str | None) -> tuple[list[Block], list[int]]:
    """The blocks of text of a page and the hashes of its tags' paths, both in order.

    Time is in proportion to the page, however deep its tags are nested.
    """
    page = page or ""
    stack = [_Open("", xxhash.xxh64(), 0, False, 0, 0, False, True, None, None)]
    places: dict[str, list[int]] = {}  # where on the stack the open elements of a tag are
    blocks: list[Block] = []
    tags: list[int] = []
    run: list[str] = []
    linked = 0
    at = 0

    def around() -> _Open:
        return stack[-1].block or stack[-1]

    def flush() -> None:
        nonlocal linked
        if run:
            text = SPACES.sub(" ", entities.unescape("".join(run))).strip()
            if text:
                place = around()
                token = place.path.copy()
                token.update(f"\n{text}".encode("utf-8", "surrogatepass"))
                hashed = token.intdigest() - (1 << 63)
                heading = place.tag in HEADINGS
                blocks.append(Block(text, hashed, place.article, place.holder, linked, heading, place.removed, place.part))
            run.clear()
        linked = 0

    def close(index: int) -> None:
        """End the element at ``index`` and all inside it."""
        if any(x.blocks for x in stack[index:]):
            flush()
        for x in stack[index:]:
            places[x.tag].pop()
        del stack[index:]

    def innermost(names: tuple[str, ...]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    def last(names: tuple[str, ...], stop: tuple[str, ...] = ()) -> int:
        """Where the innermost open element of ``names`` is, if none of ``stop`` is inside it, else 0."""
        index = innermost(names)
        return index if index > innermost(tuple(n for n in stop if n not in names)) else 0

    def add(text: str) -> None:
        nonlocal linked
        # What is removed inside a line leaves the line as it is.
        own, place = stack[-1], around()
        if text and (place.removed or not own.removed and own.part is place.part):
            run.append(text)
            if stack[-1].link:
                linked += len(text.strip())

    while True:
        found = TAG.search(page, at)
        add(page[at : found.start() if found else len(page)])
        if not found:
            break
        at = found.end()
        name = found[2]
        if name is None:
            continue  # a comment or a declaration
        tag = name.lower()
        if found[1]:
            if tag == "p" and not last(("p",)):
                flush()
            if index := last((tag,)):
                close(index)
            continue
        if tag in ENDS_P and (index := last(("p",), ("table", "td", "th", "button", "object"))):
            close(index)
        if tag in SIBLINGS:
            while index := last(SIBLINGS[tag], SCOPES.get(tag, ("table",))):
                close(index)
        if tag in HEADINGS and stack[-1].tag in HEADINGS:
            close(len(stack) - 1)
        element = _opened(tag, found[3] or "", stack[-1])
        tags.append(element.token)
        if tag in VOID or (found[3] or "").rstrip().endswith("/") and tag not in BLOCK:
            if tag == "br" or tag == "wbr":
                run.append(" " if tag == "br" else "")
            elif element.blocks:
                flush()
            continue
        if element.blocks:
            flush()
        places.setdefault(tag, []).append(len(stack))
        stack.append(element)
        if tag in RAW:
            end = RAW_END[tag].search(page, at)
            at = end.start() if end else len(page)  # its content is no text of the page
    flush()
    _take_out(blocks)
    return blocks, tags


def _take_out(blocks: list[Block]) -> None:
    """Remove the blocks in parts that are no article text.

    A part inside which another holds the article holds it too, so the innermost part decides. A form that holds the
    article stays; a part named otherwise only where no article would be left without it.
    """
    without = [b.removed or b.part is not None and b.part.stands() for b in blocks]
    left = any(b.article >= 2 and not gone for b, gone in zip(blocks, without))
    for b, gone in zip(blocks, without):
        b.removed = gone and (b.removed or left or not b.part.holds)


def key(text: str) -> int:
    """A signed 64-bit hash."""
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def article_text(blocks: list[Block], template: set[int], common: set[int] = frozenset()) -> str:
    """The blocks of the article's slots, joined by empty lines.

    ``template`` has the tokens of the page that are template, ``common`` those of them that stand on half of the
    host's pages or more. Names choose the slots: those inside a template element
    whose name says article, by the strongest name used; on a host without a template, or if no
    template element says so, the page's own elements decide. Text that is ``common`` is no part of a
    slot, unless it is a heading or makes up half of the slots. On a page that names no article, the slots
    are all places without template text that are not mostly links.
    """
    kept = [b for b in blocks if not b.removed]
    named = [b for b in kept if b.article]
    if not named:
        return "\n\n".join(b.text for b in kept if b.token not in template and b.linked < LINKED * len(b.text))
    placed = [b for b in named if b.holder in template] or named
    best = max(b.article for b in placed)
    own = [b for b in placed if b.article == best]
    fixed = [b for b in own if b.token in common and not b.heading]
    if sum(len(b.text) for b in fixed) < MOST_TEMPLATE * sum(len(b.text) for b in own):
        own = [b for b in own if b.token not in common or b.heading]
    return "\n\n".join(b.text for b in own)


def page_tokens(pages: DataFrame) -> DataFrame:
    """Of pages (page_id, host, html), a row each: page_id, host, body, token, n, is_text.

    A token is the hash of a tag's path or of a text and its path, n how often
    the page has it; is_text tells them apart; the three are lists. The texts are those of all blocks
    that are not taken out. body is a hash of all blocks of the page, equal for pages that are copies.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, tokens, counts, kinds = [], [], [], []
            for source in batch.column("html"):
                blocks, tags = parse(source.as_py())
                of_tags, of_texts = Counter(tags), Counter(b.token for b in blocks if not b.removed)
                tokens.append([*of_tags, *of_texts])
                counts.append([*of_tags.values(), *of_texts.values()])
                kinds.append([False] * len(of_tags) + [True] * len(of_texts))
                bodies.append(key("\n".join(b.text for b in blocks)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("host"),
                    pa.array(bodies, pa.int64()),
                    pa.array(tokens, pa.list_(pa.int64())),
                    pa.array(counts, pa.list_(pa.int32())),
                    pa.array(kinds, pa.list_(pa.bool_())),
                ],
                ["page_id", "host", "body", "token", "n", "is_text"],
            )

    return pages.mapInArrow(
        run, "page_id long, host string, body long, token array<long>, n array<int>, is_text array<boolean>"
    )


def deduce_templates(tokens: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """The template of each host: host, token, is_text, n_pages, class_id, common (on half of its pages or more).

    ``tokens`` are page tokens; copies of a page count once. Tokens with the same occurrence vector share a class_id.
    A class is valid if it spans at least ``min_pages`` pages and nests into
    the template: it holds a tag, or it stands on at least half of the pages of the host.
    """
    once = (
        tokens.groupBy("host", "body").agg(F.min(F.struct("token", "n", "is_text")).alias("p"))
        .select("host", "body", F.explode(F.arrays_zip("p.token", "p.n", "p.is_text")).alias("t"))
        .select("host", "body", F.col("t.token"), F.col("t.n"), F.col("t.is_text"))
    )
    at = F.xxhash64("body", "n")
    vectors = once.groupBy("host", "token", "is_text").agg(
        F.count("*").alias("n_pages"),
        F.bit_xor(at).alias("_v1"),
        F.bit_xor(F.xxhash64(at, F.lit("second"))).alias("_v2"),
    )
    valid = vectors.where(F.col("n_pages") >= min_pages)
    classes = valid.withColumn("class_id", F.xxhash64("host", "n_pages", "_v1", "_v2"))
    pages = once.groupBy("host").agg(F.count_distinct("body").alias("_pages"))
    nested = classes.where("not is_text").select("class_id").distinct().withColumn("_tag", F.lit(True))
    template = classes.join(pages, "host").join(nested, "class_id", "left")
    template = template.withColumn("common", F.col("n_pages") * 2 >= F.col("_pages"))
    return template.where(F.col("_tag") | F.col("common")).select("host", "token", "is_text", "n_pages", "class_id", "common")


def extract_text(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """The main text of every row of ``pages`` (page_id, url, html).

    Returns page_id, url, text, n_chars. Blocks are in page order with an
    empty line between; character references are decoded, white space inside a
    block is one space. Null and empty html give an empty text, as does a page without an
    article. Pages with a null url, or one without `://`, count as of one
    host. Broken html is read like a browser would: open tags end where they must. Repeated rows are
    rows of their own; rows with one page_id share their template tokens. No rows give
    no rows. Other columns are ignored; html is read whole.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.col("html").cast("string").alias("html"))
    hosted = rows.select("page_id", host_of(F.col("url")).alias("host"), "html")
    tokens = saved(page_tokens(hosted))
    template = deduce_templates(tokens, min_pages).select("host", "token", "common")
    found = (
        tokens.select("page_id", "host", F.explode("token").alias("token"))
        .join(template, ["host", "token"]).groupBy(F.col("page_id").alias("_id"))
        .agg(F.collect_set("token").alias("template"), F.collect_set(F.when(F.col("common"), F.col("token"))).alias("common"))
    )  # fmt: skip  # a set is no larger than its page
    parsed = page_blocks(rows)
    joined = parsed.join(found, parsed["page_id"].eqNullSafe(found["_id"]), "left").drop("_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for blocks, template, common in zip(batch.column("blocks"), batch.column("template"), batch.column("common")):
                kept = [Block(*b, removed=False, part=None) for b in json.loads(zlib.decompress(blocks.as_py()))]
                out.append(article_text(kept, set(template.as_py() or ()), set(common.as_py() or ())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def page_blocks(pages: DataFrame) -> DataFrame:
    """Of pages (page_id, url, html), a row each: page_id, url and the blocks that may be article text.

    Only these are moved to where the page's template tokens are, not the html; packed, since
    texts of a page compress better together than rows do.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = []
            for source in batch.column("html"):
                kept = [b for b in parse(source.as_py())[0] if not b.removed]
                named = [b for b in kept if b.article]
                fields = [(b.text, b.token, b.article, b.holder, b.linked, b.heading) for b in named or kept]
                blocks.append(zlib.compress(json.dumps(fields, ensure_ascii=False).encode()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(blocks, pa.binary())], ["page_id", "url", "blocks"]
            )

    return pages.mapInArrow(run, "page_id long, url string, blocks binary")
