"""Main text of web pages by the template that recurs on the pages of a host.

Tokens are containers, by their path (tag, id, classes; figures in names are ignored), and blocks of text, by the path
of their container and their words. Tokens that stand on the same pages of a host (equal occurrence vectors) form an
equivalence class; classes on enough pages, of more than one token, nest into the template of the host. Containers must keep
their order too.

The slot that holds the article is chosen once per host: an article or main element of the template, or else the deepest
container with most of the text. What pages have there is their main text, without the blocks that are in the template
themselves and without the parts whose element or name says that they are something else.

Support comes from aggregations that combine before they shuffle, however many pages a host has. Pages are read twice and
never shuffled unless there are very many hosts.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from foldboard.llm.common import col, table
from foldboard.scratch import written

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|svg(?![^>]*/>)|iframe|annotation(?:-xml)?)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-z][^\s/>]*)(?P<rest2>[^>]*)>"
    r"|<[!?][^>]*>",
    re.I | re.S,
)
#: One attribute, so that what looks like one in the value or the name of another is not read.
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAMING = frozenset(["id", "class", "role"])
PART = re.compile(r"[^a-z]+")

CONTAINERS = frozenset("html head body div section article main header footer nav aside form".split())
#: Other elements that begin and end a block of text.
BLOCKS = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tfoot tr td th caption "
    "figure figcaption hr address details summary fieldset legend dialog menu center title "
    "select option button label hgroup search".split()
)
VOID = frozenset("br hr img input meta link area base col embed source track wbr param".split())
#: Elements without text of the page, and those that are no part of an article they lie in or beside.
HIDDEN = frozenset("head select option button label title".split())
NEVER = frozenset("nav footer aside form dialog menu search".split())
OUTSIDE = frozenset(["header"])
#: Whole classes and ids that say so, and the elements that may go by them: no headings, tables or paragraphs.
NEVER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsored promo "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar aside widget widgets footer "
    "site-nav main-nav site-menu main-menu site-footer page-footer side-bar "
    "cookie cookies consent gdpr cookie-notice cookie-banner cookie-consent cookie-bar popup modal "
    "newsletter newsletter-signup subscribe signup login share-buttons social-share sharing social "
    "related-posts related-articles recommended comments comment-list comment-form comments-area comments-section comment-section "
    "user-comments reader-comments disqus_thread "
    "skip-link contentinfo complementary".split()
)
OUTSIDE_NAMES = frozenset("header masthead topbar site-header page-header".split())
NAMED = frozenset("div section ul ol dl center details".split())
#: Begins the name of a container that is left out of the articles around it.
ASIDE = "~"
ARTICLE = frozenset(["article", "main"])

MIN_SUPPORT = 0.5
#: Different pages that a block of text must stand on before it can be part of a template.
MIN_PAGES = 5
#: Share of the text of a host that a slot without an article element must hold.
MAIN_SHARE = 0.7
#: Tokens that an equivalence class of text must have; the page itself is one of those on every page.
MIN_CLASS = 2
BROADCAST_HOSTS = 100_000


@dataclass
class Element:
    tag: str
    name: str
    hidden: bool
    inside: bool
    #: Path of the container around the innermost element that is left out, if there is one.
    aside: str | None
    #: Path of containers down to this element, if it is one.
    path: str = ""


@dataclass
class Block:
    path: str
    text: str
    #: Articles at this path or above it leave the block out.
    aside: str | None = None

    def of(self, slot: str) -> bool:
        """Whether the block lies in ``slot``, and in nothing there that is left out."""
        return within(self.path, slot) and not (self.aside is not None and within(self.aside, slot))

    @property
    def token(self) -> int:
        """Path and text as one number; the text tokens of a host are counted by it."""
        joined = f"{self.path}\n{self.text}".encode("utf-8", "replace")
        return xxhash.xxh64_intdigest(joined) - (1 << 63)


def within(path: str, slot: str) -> bool:
    """The empty slot is the whole page."""
    return not slot or path == slot or path.startswith(slot + ">")


@dataclass
class Page:
    #: Path of every container in the order of its start.
    opened: list[str] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)


def parse(source: str | None) -> Page:
    """Containers and the blocks of text that could be an article; unclosed and stray tags are tolerated."""
    page = Page()
    stack: list[Element] = []
    text: list[str] = []

    def end_block() -> None:
        joined = " ".join(html.unescape("".join(text)).split())
        text.clear()
        if joined and not (stack and stack[-1].hidden):
            page.blocks.append(Block(path(), joined, stack[-1].aside if stack else None))

    def path() -> str:
        return next((e.path for e in reversed(stack) if e.path), "")

    def open_element(tag: str, rest: str) -> None:
        given = [
            (match[1].lower(), (match[2] or match[3] or match[4] or "").lower())
            for match in ATTRIBUTE.finditer(rest)
            if match[1].lower() in NAMING
        ]
        # Ids of sections name their subject.
        words = {w for kind, value in given if (tag, kind) != ("section", "id") for w in value.split()}
        parts = {part for _, value in given for part in PART.split(value)} - {""}
        above = stack[-1] if stack else None
        inside = bool(above and above.inside) or tag in ARTICLE or "main" in words
        left_out = tag in NEVER or (tag in NAMED and bool(words & NEVER_NAMES))
        if not inside:
            left_out |= tag in OUTSIDE or (tag in NAMED and bool(words & OUTSIDE_NAMES))
        element = Element(
            tag,
            (ASIDE if left_out else "") + ".".join([tag, *sorted(parts)]),
            bool(above and above.hidden) or tag in HIDDEN,
            inside,
            path() if left_out else above.aside if above else None,
        )
        if tag in CONTAINERS:
            element.path = f"{path()}>{element.name}"
            page.opened.append(element.path)
        stack.append(element)

    def close_element(tag: str) -> None:
        for place in range(len(stack) - 1, -1, -1):
            if stack[place].tag == tag:
                del stack[place:]
                return
            # A stray end tag of a paragraph or item does not close containers.
            if tag not in CONTAINERS and stack[place].path:
                return

    source = source or ""
    at = 0
    for match in MARKUP.finditer(source):
        text.append(source[at : match.start()])
        at = match.end()
        tag = (match["tag"] or match["tag2"] or "").lower()
        if match["raw"] or tag in ("br", "img", "input", "wbr"):
            text.append(" ")
        elif tag in CONTAINERS or tag in BLOCKS:
            end_block()
            if match["close"] or match["close2"]:
                close_element(tag)
            elif tag not in VOID:
                if stack and stack[-1].tag == "head" and tag not in HIDDEN:
                    stack.pop()
                if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
                    _close_sibling(stack, tag)
                open_element(tag, match["rest"] or match["rest2"] or "")
    text.append(source[at:])
    end_block()
    return page


def _close_sibling(stack: list[Element], tag: str) -> None:
    """A paragraph, item or cell ends where the next one starts."""
    if stack and stack[-1].tag == tag:
        stack.pop()


def article(page: Page, slot: str | None, recurring: frozenset[int] = frozenset()) -> str:
    """Blocks in ``slot``; without one or without text there, those of the page's own article, or all.

    Blocks whose token is ``recurring`` are left out.
    """
    for want in (slot, *_own_slots(page), ""):
        if want is not None:
            found = [b for b in page.blocks if b.of(want)]
            if found:
                return joined(found, recurring)
    return ""


def joined(blocks: list[Block], recurring: frozenset[int]) -> str:
    return "\n\n".join(b.text for b in blocks if b.token not in recurring)


def _own_slots(page: Page) -> list[str | None]:
    """The first article and the first main element, first those that do not lie in something left out."""
    tags = lambda path: path.rpartition(">")[2].split(".")[0]
    plain = [p for p in page.opened if f">{ASIDE}" not in p]
    return [
        next((p for p in paths if tags(p) == tag), None) for paths in (plain, page.opened) for tag in ("article", "main")
    ]


def host_of(url: str | None) -> str:
    """Host without port and user, in lower case; empty for a missing one."""
    match = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", (url or "").lower())
    return match[1] if match else ""


def counted(pages: DataFrame) -> DataFrame:
    """Counts of containers per batch, and one row per page and text token (``text`` set), from (host, html).

    ``page`` is a hash of the page's text, so that copies of a page count once for text tokens.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums: dict[tuple[str, str], list[int]] = {}
            texts: set[tuple[str, int, int]] = set()
            for host, source in zip(batch["host"], batch["html"], strict=True):
                page = parse(source)
                first: dict[str, int] = {}
                times: dict[str, int] = {}
                for place, token in enumerate(page.opened):
                    first.setdefault(token, place)
                    times[token] = times.get(token, 0) + 1
                chars: dict[str, int] = {"": 0}
                for block in page.blocks:
                    token = block.path
                    # From the inside out, as far as the block belongs to its containers.
                    while block.of(token):
                        chars[token] = chars.get(token, 0) + len(block.text)
                        if not token:
                            break
                        token = token.rpartition(">")[0]
                whole = "\n".join(b.text for b in page.blocks).encode("utf-8", "replace")
                same = xxhash.xxh64_intdigest(whole) - (1 << 63)
                texts.update((host, b.token, same) for b in page.blocks)
                first[""], times[""] = -1, 1
                for token, n in times.items():
                    total = sums.setdefault((host, token), [0] * 4)
                    for k, more in enumerate((1, n, first[token], chars.get(token, 0))):
                        total[k] += more
            if sums:
                yield pd.DataFrame(
                    [(*key, *v) for key, v in sums.items()],
                    columns=["host", "token", "pages", "n", "places", "chars"],
                ).assign(text=0, page=0)
            if texts:
                yield pd.DataFrame(list(texts), columns=["host", "text", "page"]).assign(
                    token=None, pages=0, n=0, places=0, chars=0
                )

    return pages.mapInPandas(
        count,
        "host string, token string, pages long, n long, places long, chars long, text long, page long",
    )


def occurrences(counts: DataFrame) -> DataFrame:
    """Per host and container: pages, count, order and characters of text."""
    return counts.filter("token IS NOT NULL").groupBy("host", "token").agg(
        F.sum("pages").alias("pages"),
        F.sum("n").alias("n"),
        (F.sum("places") / F.sum("pages")).alias("place"),
        F.sum("chars").alias("chars"),
    )


def recurring_blocks(counts: DataFrame) -> DataFrame:
    """(host, recurring): the text tokens of the template of each host.

    Tokens on the same pages are an equivalence class. Classes belong to the template if they stand on MIN_SUPPORT of the
    different pages of the host that have text, and on MIN_PAGES at least, and have MIN_CLASS tokens: one block alone that some
    pages share is a quotation. So a host has at most 1 / MIN_SUPPORT times as many as a page has blocks.
    """
    places = written(counts.filter("token IS NULL").select("host", "text", "page").distinct(), "places")
    different = places.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("different"))
    # Pages are hashes, so their number and combination stand for the occurrence vector.
    vectors = places.groupBy("host", "text").agg(
        F.count("*").alias("support"), F.bit_xor(F.xxhash64("page")).alias("vector")
    )
    kept = vectors.filter(F.col("support") >= MIN_PAGES).join(different, "host")
    kept = kept.filter(F.col("support") >= MIN_SUPPORT * F.col("different"))
    classes = kept.groupBy("host", "different", "support", "vector").agg(F.collect_list("text").alias("texts"))
    size = F.size("texts") + (F.col("support") == F.col("different")).cast("int")
    return (
        classes.filter(size >= MIN_CLASS)
        .groupBy("host")
        .agg(F.flatten(F.collect_list("texts")).alias("recurring"))
    )


def templates(tokens: DataFrame) -> DataFrame:
    """The containers on MIN_SUPPORT of the pages in a steady order, with depth and the host's totals.

    The empty token stands for the page as a whole.
    """
    whole = tokens.filter("token = ''").select(
        "host", F.col("pages").alias("host_pages"), F.col("chars").alias("host_chars")
    )
    named = tokens.filter("token <> ''").join(whole, "host")
    frequent = named.filter(F.col("pages") >= MIN_SUPPORT * F.col("host_pages"))
    # Containers start before what they contain, on average over the same pages too, or there is no order.
    parent = F.regexp_replace("token", r">[^>]*$", "")
    outer = frequent.select(
        F.col("host").alias("_host"), F.col("token").alias("_token"), F.col("place").alias("_place")
    )
    same = (F.col("host") == F.col("_host")) & (parent == F.col("_token"))
    ordered = frequent.join(outer, same, "left").filter(
        F.col("_place").isNull() | (F.col("_place") <= F.col("place")) | (F.col("n") > F.col("pages"))
    )
    return ordered.drop("_host", "_token", "_place").withColumn(
        "depth", F.size(F.split("token", ">")) - 1
    )


def main_slots(template: DataFrame) -> DataFrame:
    """(host, slot): the container of the template that holds the article.

    An ``article`` that pages have once comes first, then ``main``, then one of these inside something left out if it has more
    text than is left of the page without it, then the deepest container with MAIN_SHARE of the text.
    """
    last = F.substring_index(F.substring_index("token", ">", -1), ".", 1)
    once = F.col("n") == F.col("pages")
    plain = ~F.contains("token", F.lit(f">{ASIDE}"))
    kind = (
        F.when((last == "article") & once & plain, 4)
        .when((last == "main") & once & plain, 3)
        .when(last.isin("article", "main") & once & (F.col("chars") > F.col("host_chars")), 2)
        .when(F.col("chars") >= MAIN_SHARE * F.col("host_chars"), 1)
        .otherwise(0)
    )
    best = F.max(
        F.struct(
            kind.alias("kind"),
            F.when(kind == 1, F.col("depth")).otherwise(-F.col("depth")).alias("depth"),
            "chars",
            "token",
        )
    )
    chosen = template.filter(F.col("chars") > 0).groupBy("host").agg(best.alias("best"))
    return chosen.filter("best.kind > 0").select("host", F.col("best.token").alias("slot"))


@pandas_udf(StringType())
def _article(sources: pd.Series, slots: pd.Series, recurring: pd.Series) -> pd.Series:
    found = [
        article(parse(source), slot, frozenset(() if tokens is None else (int(t) for t in tokens)))
        for source, slot, tokens in zip(sources, slots, recurring, strict=True)
    ]
    return pd.Series(found, dtype=object)


@pandas_udf(StringType())
def _host(urls: pd.Series) -> pd.Series:
    return pd.Series([host_of(u) for u in urls], dtype=object)


def main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per input row: page_id, url, text, n_chars.

    A missing or empty page, and one without an article, has empty text. Pages of any length are read whole. Pages without url or host form a host of their own.
    Repeated rows and missing ids stay rows; pages of equal text count once when recurring blocks are looked for. An
    empty table gives no rows; other columns are ignored.
    """
    rows = pages.select(
        col(id_col).alias("page_id"),
        col(url_col).alias("url"),
        col(html_col).alias("html"),
        _host(col(url_col)).alias("host"),
    )
    counts = written(counted(rows.select("host", "html")), "counts")
    template = templates(written(occurrences(counts), "tokens"))
    slots = main_slots(template).join(recurring_blocks(counts), "host", "full")
    slots = written(slots, "slots")
    if slots.count() <= BROADCAST_HOSTS:
        slots = F.broadcast(slots)
    return (
        rows.join(slots, "host", "left")
        .select("page_id", "url", _article("html", "slot", "recurring").alias("text"))
        .withColumn("n_chars", F.length("text").cast("long"))
    )


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return main_text(table(spark, sf_dir, "pages"))


QUERIES = {"op2_html_extraction": op2_html_extraction}
ORACLES: dict[str, str] = {}
