"""Main text of web pages by equivalence-class template deduction.

Every page gives tokens: its opening tags, told apart by the elements around them, and its text
blocks. A token's occurrence vector is how often each page of the host has it. Tokens with equal
vectors form an equivalence class; vectors are compared by a sum of hashes over (page, count), so a
host's pages never come together in a task. Classes that cover at least half of a host's pages, and
three, are its template. What lies between the template's tokens are the slots.

Which slot is the article's is decided for the whole host: of the template's elements, the innermost
that holds more than half of the text that varies from page to page, links not counted. On a page,
the template's classes are nested: one that crosses the gaps of a class already placed is not valid
there. The blocks inside the chosen element are the page's text, but for inner elements of fixed text
alone, which nearly all pages of the host repeat.

Words of tags, roles and names break ties: menus, headers, footers, sidebars, notices, adverts, forms
and comments differ from page to page too, so text in elements so called neither counts for the choice
nor is kept, and an article element is never cut into. A host of fewer than three pages has no template,
and a page without the chosen element does not follow it: there, these words alone decide.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecare.llm.common import ship
from lakecare.llm.urlfilter import host_of
from lakecare.session import stage

SUPPORT, LEAST_PAGES = 0.5, 3
#: Share of the varying text that the article's slot must exceed; share of pages, and pages, that fixed text is on.
MAJORITY = 0.5
FIXED_SHARE, FIXED_PAGES = 0.9, 5
#: Parts that a host's tokens are dealt to.
HOST_PARTS = 64

#: Elements whose content is no article text.
EXCLUDED_TAGS = frozenset(
    "head title script style template noscript nav aside footer form button select textarea input iframe svg canvas"
    " object dialog menu audio video map".split()
)
EXCLUDED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog form menu menubar".split())
#: Words of class names and ids of adverts, notices, menus, sidebars, comments and the like.
EXCLUDED_NAMES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies"
    " consent gdpr notice notification newsletter subscribe subscription signup popup modal overlay paywall sidebar menu"
    " nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments disqus respond replies related"
    " recommended share sharing social widget toolbar pagination pager login search".split()
)
CONTAINERS = frozenset(
    "html body main article section div header ul ol li dl table thead tbody tr td th blockquote figure details fieldset"
    " center address".split()
)
BLOCKS = CONTAINERS - {"td", "th"} | frozenset(
    "p h1 h2 h3 h4 h5 h6 pre hr dt dd figcaption caption summary legend option optgroup".split()
)
SPACES = frozenset("br td th img input".split())
ARTICLE = frozenset(["article", "main"])
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|<(?P<loose>/?)(?P<looser>[a-z][^\s/>]*)(?P<loosest>[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.I | re.S,
)
NAMED = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORD = re.compile(r"[A-Za-z]+")


@dataclass
class Element:
    tag: str
    path: str
    excluded: bool
    article: bool
    header: bool
    token: int = 0
    chain: tuple[int, ...] = ()  # tokens of the elements around it and its own, down to the outermost article
    unnamed: dict[str, int] = field(default_factory=dict)  # children without a name, by tag


@dataclass
class Block:
    text: str
    size: int  # code points outside links
    excluded: bool
    article: bool
    token: int
    chain: tuple[int, ...]
    element: Element  # the innermost one


@dataclass
class Page:
    tokens: list[int] = field(default_factory=list)  # in page order
    blocks: list[Block] = field(default_factory=list)


def _token(text: str) -> int:
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >= 1 << 63 else value


def read_page(html: str) -> Page:
    """Tokens and text blocks of a page; broken markup closes with what surrounds it."""
    page, stack, parts, linked = Page(), [Element("", "", False, False, False)], [], []
    heading = link = False

    def add(text: str) -> None:
        parts.append(text)
        if link:
            linked.append(text)

    def close_block() -> None:
        text = " ".join("".join(parts).split())
        links = " ".join("".join(linked).split())
        parts.clear()
        linked.clear()
        if text:
            top = stack[-1]
            excluded = top.excluded or (top.header and not (top.article and heading))
            token = _token(f"{top.path}|{text}")
            page.tokens.append(token)
            page.blocks.append(Block(text, max(len(text) - len(links), 0), excluded, top.article, token, top.chain, top))

    last = 0
    for found in MARKUP.finditer(html):
        add(markup.unescape(html[last : found.start()]))
        last = found.end()
        tag = (found["tag"] or found["looser"] or "").lower()
        if not tag:
            parts.append(" " if found["raw"] else "")
            continue
        ending = bool(found["end"] or found["loose"])
        if tag in SPACES:
            parts.append(" ")
        if tag in BLOCKS or tag in EXCLUDED_TAGS:
            close_block()
        if tag in HEADINGS:
            heading = not ending
        if tag == "a":
            link = not ending
        if tag not in CONTAINERS and tag not in EXCLUDED_TAGS or tag == "input":
            if not ending:
                page.tokens.append(_token(f"{stack[-1].path}>{tag}"))
            continue
        if ending:
            if any(e.tag == tag for e in stack):
                while stack.pop().tag != tag:
                    pass
            continue
        if tag in ("li", "tr", "td", "th") and stack[-1].tag == tag:
            stack.pop()
        _open(page, stack, tag, found["rest"] or found["loosest"] or "")
    add(markup.unescape(html[last:]))
    close_block()
    return page


def _open(page: Page, stack: list[Element], tag: str, rest: str) -> None:
    named = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in NAMED.finditer(rest)} if rest else {}
    names = {w.lower() for key in ("class", "id") for w in WORD.findall(named.get(key, ""))}
    above = stack[-1]
    article = above.article or tag in ARTICLE or named.get("itemprop") == "articleBody"
    body = tag in ("html", "body") or tag in ARTICLE and not above.article and "comment" not in names
    excluded = above.excluded or not body and bool(
        tag in EXCLUDED_TAGS or named.get("role", "").lower() in EXCLUDED_ROLES or names & EXCLUDED_NAMES
    )
    header = above.header or tag == "header" or not body and "header" in names
    shown = tag + "".join(f".{n}" for n in sorted(names))
    if tag in ("div", "section") and not names:  # told apart by their order
        above.unnamed[tag] = above.unnamed.get(tag, 0) + 1
        shown += f"[{above.unnamed[tag]}]"
    token = _token(f"{above.path}>{shown}")
    chain = above.chain if above.article else (*above.chain, token)
    stack.append(Element(tag, f"{above.path}/{shown}", excluded, article, header, token, chain))
    page.tokens.append(token)


# Template deduction ---------------------------------------------------------------------


SEEN = "host string, page long, token long, times int, size int, chain array<long>"


def host_templates(pages: DataFrame) -> DataFrame:
    """(host, template, main): each host's template as a list of (class, token, fixed), and the article's element.

    A template has fewer tokens than twice the mean of the host's pages, so the list is bounded by page
    length, not by the number of pages. ``main`` is null if no element holds most of the varying text.
    """

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
        names = [part.split()[0] for part in SEEN.split(", ")]
        for batch in batches:
            rows: list[tuple] = []
            for h, k, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                page = read_page(text)
                counts: dict[int, int] = {0: 1}
                for t in page.tokens:
                    counts[t] = counts.get(t, 0) + 1
                blocks = {b.token: b for b in page.blocks}
                for t, times in counts.items():
                    block = blocks.get(t)
                    counted = block is not None and not block.excluded
                    rows.append((h, k, t, times, block.size if counted else None, block.chain if counted else None))
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    keyed = pages.select("host", F.xxhash64("url", "html").alias("page"), F.coalesce("html", F.lit("")).alias("html"))
    seen = keyed.mapInArrow(tokens, SEEN)
    vectors = seen.groupBy("host", "token").agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum(F.xxhash64("page", "times").cast("decimal(38,0)")).alias("vector"),
        F.sum(F.col("times") * F.col("size")).alias("chars"),
        F.max("chain").alias("chain"),
    )
    vectors = stage(vectors, "html-vectors")
    # each host's number of pages meets its tokens in several parts, as one host may hold a third of them
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(HOST_PARTS - 1).cast("long")))
    total = vectors.where("token = 0").select("host", F.col("pages").alias("total"), parts.alias("part"))
    part = F.pmod("token", F.lit(HOST_PARTS).cast("long"))
    known = vectors.where("token <> 0").withColumn("part", part).join(total, ["host", "part"]).drop("part")
    covers = (F.col("pages") >= LEAST_PAGES) & (F.col("pages") >= F.col("total") * SUPPORT)
    frequent = stage(
        known.where(covers).select(
            "host",
            "token",
            F.xxhash64("pages", "vector").alias("class"),
            ((F.col("pages") >= FIXED_PAGES) & (F.col("pages") >= F.col("total") * FIXED_SHARE)).alias("fixed"),
        ),
        "html-frequent",
    )
    varying = known.where(~covers & (F.col("chars") > 0))
    inside = varying.select("host", "chars", F.posexplode("chain").alias("depth", "token"))
    held = inside.groupBy("host", "token").agg(F.sum("chars").alias("chars"), F.max("depth").alias("depth"))
    whole = varying.groupBy("host").agg(F.sum("chars").alias("all_chars"))
    main = (
        held.join(frequent.select("host", "token"), ["host", "token"])
        .join(whole, "host")
        .where(F.col("chars") > F.col("all_chars") * MAJORITY)
        .groupBy("host")
        .agg(F.max_by("token", "depth").alias("main"))
    )
    template = frequent.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("class", "token", "fixed"))).alias("template"))
    return template.join(main, "host", "left")


def valid_classes(page: Page, template: dict[int, int]) -> set[int]:
    """Tokens of the template's classes that nest on this page, larger classes first."""
    places: dict[int, list[int]] = {}
    for at, token in enumerate(page.tokens):
        if token in template:
            places.setdefault(template[token], []).append(at)
    order = sorted(places, key=lambda c: (-len({page.tokens[p] for p in places[c]}), places[c][0]))
    gap_of = [0] * (len(page.tokens) + 1)  # which slot of the classes placed so far a token lies in
    valid = set()
    for name in order:
        spots = places[name]
        spans = len({gap_of[p] for p in spots}) == 1
        if spans or not valid or _repeats(spots, gap_of):
            valid.add(name)
            for k, p in enumerate(spots):
                for q in range(p, spots[k + 1] if k + 1 < len(spots) else p + 1):
                    gap_of[q] = hash((gap_of[q], name, k))
    return {t for t in set(page.tokens) if template.get(t) in valid}


def _repeats(spots: list[int], gap_of: list[int]) -> bool:
    """Whether a class fills each slot that it touches with one run, as a repeated record does."""
    runs = [gap_of[a] for i, a in enumerate(spots) if i == 0 or gap_of[a] != gap_of[spots[i - 1]]]
    return len(runs) == len(set(runs))


@dataclass(frozen=True)
class Template:
    """Class of each token, the tokens that nearly all pages have, and the article's element."""

    classes: dict[int, int] = field(default_factory=dict)
    fixed: frozenset[int] = frozenset()
    main: int | None = None


def article_text(page: Page, template: Template) -> str:
    """The blocks of the article's slot; by the names of elements alone where the page does not follow the template."""
    kept = [b for b in page.blocks if not b.excluded]
    inside = [b for b in kept if template.main in b.chain]
    if template.main is not None and inside:
        valid = valid_classes(page, template.classes) & template.fixed
        varying = {id(b.element) for b in page.blocks if b.token not in valid}
        kept = [b for b in inside if id(b.element) in varying or b.element.token == template.main]
    elif any(b.article for b in kept):
        kept = [b for b in kept if b.article]
    return "\n\n".join(b.text for b in kept)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages(page_id, url, html)``.

    A null or empty page has an empty text. White space of any kind inside a block becomes one
    space. Pages whose URL has no host form one group. Equal pages get equal texts and count as
    often as they come. Of two classes of equal size the one that begins first on the page is placed
    first. Pages of any length are read whole, one at a time; an empty table gives no rows. Other
    columns are not read.
    """
    ship(pages.sparkSession)
    hosted = pages.select("page_id", "url", "html", host_of(F.coalesce("url", F.lit(""))).alias("host"))
    templates = stage(host_templates(hosted), "html-templates")
    joined = hosted.join(templates, "host", "left").select("page_id", "url", "html", "template", "main")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, known = [], {}
            for html, listed, main in zip(batch.column(2), batch.column(3), batch.column(4).to_pylist(), strict=True):
                rows = listed.as_py() or []
                name = hash((main, tuple((r["class"], r["token"]) for r in rows)))
                if name not in known:
                    fixed = frozenset(r["token"] for r in rows if r["fixed"])
                    known[name] = Template({r["token"]: r["class"] for r in rows}, fixed, main)
                source = html.as_py()
                texts.append(article_text(read_page(source), known[name]) if source else "")
            found = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *found], ["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
