"""Main text of pages by template deduction.

Pages of a host are made from a template. A token of a page is a tag in its role (the path
of elements around it, with their classes) or the text of a block in its role. Tokens of a host
whose occurrence vectors (how often on which page) are equal form an equivalence class. Vectors are
never gathered: each is summed up in one number, a sum over pages of a hash of page and count, and
classes are found by grouping on host and number. Tokens that occur once on nearly all of a host's
pages, in a class of several or not on all pages, and blocks are the template; what stands between its
tokens are slots. Whether the tokens of a class nest within one another, in one order, is not tested, and no nested
template is built: the names of elements go first.

From the template follow the element whose slots hold the article (``<article>``, ``<main>`` or what
is named so; else the innermost one that holds nearly all text beside menus and the like), and the
blocks that are the same on nearly all pages outside of it. A page's text is what its slots there hold, and unless
it is an ``<article>`` or ``<main>`` what the other slots of the page hold (the lowest element around all of them), without
menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments.

A host with too few pages for a template uses that of all pages together, and a page without the
host's element its own ``<article>`` or ``<main>`` or else all slots.

White space inside a block becomes one space, blocks are joined by a line end, character references
are decoded. A null or empty html has an empty text; a null or odd URL has the empty host. Very long
pages are one row; a third of all pages on one host is no more than any other share, as nothing is
grouped by host but sums. Repeated rows give repeated results. Only ``page_id``, ``url`` and
``html`` are read.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotline.llm.common import small_batches, staged
from slotline.llm.url_rules import LOWER, UPPER

#: Pages of a host from which a template can be told, and the share of them that it must be on.
LEAST_PAGES = 5
SHARE = 0.9
#: The innermost element with this share of the text is taken for the article.
MOST_TEXT = 0.85
SALTS = 16
LONGEST_TOKEN = 200

_LEXER = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(script|style|noscript|template|textarea|title|svg|iframe|select)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
ASIDE = frozenset("nav header footer aside form button menu dialog head object".split())
ARTICLE = frozenset(("article", "main"))
#: Elements that an opening of themselves or of another block ends.
CLOSED_BY_BLOCK = frozenset(("p",))
SELF_CLOSING = frozenset("li dt dd tr td th option p".split())
#: Words of classes, ids and roles that say what an element is for.
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments contentinfo cookie "
    "cookies consent dialog disqus footer gdpr hidden masthead menu modal nav navbar navigation newsletter notice notices "
    "notification overlay pager pagination popup promo promotion related respond search share sharing sidebar signup "
    "skyscraper social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
ARTICLE_WORDS = frozenset("article content entry main post story".split())


@dataclass
class Element:
    name: str
    token: str
    path: str
    aside: bool
    article: bool
    text: int = 0


@dataclass
class Page:
    """The elements of a page in order, and its blocks: the open elements and the text of each."""

    elements: list[Element] = field(default_factory=list)
    blocks: list[tuple[tuple[int, ...], bool, str]] = field(default_factory=list)


def _names(attributes: str) -> tuple[str, frozenset[str]]:
    """What an element's class, id and role read, and their words."""
    found = {}
    for name, *values in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            found.setdefault(name.lower(), next((x for x in values if x), ""))
    if not found:
        return "", frozenset()
    read = " ".join(f"{name}={references.unescape(found[name])}" for name in sorted(found))
    values = " ".join(_CAMEL.sub(" ", references.unescape(x)) for x in found.values())
    return re.sub(r"\d+", "0", read)[:LONGEST_TOKEN], frozenset(_WORDS.findall(values.lower()))


def parsed(html: str | None) -> Page:
    """Elements and blocks of a page, however badly it nests."""
    page, html = Page(), html or ""
    open_: list[int] = []
    text: list[str] = []

    def end_block() -> None:
        words = " ".join(references.unescape("".join(text)).split())
        text.clear()
        if words:
            page.blocks.append((tuple(open_), any(page.elements[x].aside for x in open_), words))
            for x in open_:
                page.elements[x].text += len(words)

    def close(name: str, within: frozenset[str]) -> None:
        """End the innermost open element of that name, if no element of ``within`` is in between."""
        for at in range(len(open_) - 1, -1, -1):
            found = page.elements[open_[at]].name
            if found == name:
                del open_[at:]
                return
            if found in within:
                return

    last = 0
    for match in _LEXER.finditer(html):
        if match.start() > last:
            text.append(html[last : match.start()])
        last = match.end()
        slash, name, attributes = match.group(2), match.group(3), match.group(4)
        if name is None:
            if match.group(1):
                end_block()
            continue
        name = name.lower()
        if name in INLINE:
            read, words = _names(attributes) if attributes and not slash else ("", frozenset())
            if not (words & ASIDE_WORDS) and name != "label":
                continue
        if slash:
            end_block()
            close(name, ASIDE | ARTICLE if name in SELF_CLOSING else frozenset())
            continue
        end_block()
        if name in VOID:
            continue
        read, words = _names(attributes) if attributes else ("", frozenset())
        if name in SELF_CLOSING:
            close(name, frozenset(("ul", "ol", "dl", "table", "div", "section", "article", "main", *ASIDE)))
        elif name not in INLINE:
            close("p", frozenset(("div", "section", "article", "main", "td", "li", *ASIDE)))
        above = page.elements[open_[-1]].path if open_ else ""
        token = f"<{name} {read}>" if read else f"<{name}>"
        article = name in ARTICLE or "role=main" in read or bool(words & ARTICLE_WORDS)
        aside = name in ASIDE and not (name == "header" and any(page.elements[x].name in ARTICLE for x in open_))
        aside = aside or (bool(words & ASIDE_WORDS) and name not in ("html", "body", "main", "article"))
        page.elements.append(Element(name, token, f"{above}{token}"[-LONGEST_TOKEN * 4 :], aside, article))
        open_.append(len(page.elements) - 1)
        if attributes.endswith("/") and name in ("div", "span", "p"):
            open_.pop()
    if last < len(html):
        text.append(html[last:])
    end_block()
    return page


def tokens(page: Page) -> dict[str, tuple[int, int, int]]:
    """For each token in its role: how often it occurs, its place among elements, and the text in it."""
    found: dict[str, tuple[int, int, int]] = {}
    plain = [0] * len(page.elements)
    for inside, aside, words in page.blocks:
        if not aside:
            for x in inside:
                plain[x] += len(words)
    for at, element in enumerate(page.elements):
        count, place, text = found.get(element.path, (0, at, 0))
        found[element.path] = (count + 1, place, text + plain[at])
    for inside, _, words in page.blocks:
        role = page.elements[inside[-1]].path if inside else ""
        key = f"{role}\t{words[:LONGEST_TOKEN]}\t{len(words)}"
        count, place, text = found.get(key, (0, len(page.elements), 0))
        found[key] = (count + 1, place, text)
    return found


def _hosted(pages: DataFrame) -> DataFrame:
    host = F.translate(F.coalesce(F.regexp_extract("url", r"://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)
    return pages.select("page_id", "url", "html", host.alias("host"))


def occurrences(hosted: DataFrame) -> DataFrame:
    """For each host and token, and for all hosts as host null: pages, the vector's number, and sums."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["host", "token", "pages", "vector", "most", "place", "text"]
        sums: dict[tuple[str | None, str], list[int]] = {}
        for batch in batches:
            for page_id, host, html in zip(batch["page_id"], batch["host"], batch["html"]):
                for token, (times, place, text) in tokens(parsed(html)).items():
                    vector = ((page_id ^ (times * 0x9E3779B1)) * 0x2545F4914F6CDD1D >> 20) & 0x7FFFFFFF
                    # Texts of blocks are told apart from each other on their host only.
                    for key in ((host, token),) if "\t" in token else ((host, token), (None, token)):
                        old = sums.get(key)
                        if old is None:
                            sums[key] = [1, vector, times, place, text]
                        else:
                            old[0] += 1
                            old[1] += vector
                            old[2] = max(old[2], times)
                            old[3] += place
                            old[4] += text
            if len(sums) > 100_000:
                yield pd.DataFrame([(*key, *value) for key, value in sums.items()], columns=names)
                sums.clear()
        yield pd.DataFrame([(*key, *value) for key, value in sums.items()], columns=names)

    schema = "host string, token string, pages long, vector long, most long, place long, text long"
    small_batches(hosted.sparkSession, 500)
    keyed = hosted.select(F.xxhash64("page_id", "url", "html").alias("page_id"), "host", "html")
    return (
        keyed.mapInPandas(count, schema).groupBy("host", "token")
        .agg(F.sum("pages").alias("pages"), F.sum("vector").alias("vector"), F.max("most").alias("most"),
             F.sum("place").alias("place"), F.sum("text").alias("text"))
    )


def templates(seen: DataFrame, totals: DataFrame, share: float = SHARE, least_pages: int = LEAST_PAGES) -> DataFrame:
    """host, container (the path of the element with the article, or null) and fixed (blocks of the template)."""
    of_host = seen.join(totals, F.equal_null(seen["host"], totals["host"])).drop(totals["host"])
    usual = of_host.filter((F.col("pages") >= share * F.col("held")) & (F.col("held") >= least_pages))
    # Equivalence classes: tokens of a host with one vector. Nearly all pages, once each.
    classes = Window.partitionBy("host", "vector", "pages")
    in_class = usual.filter("most = 1").withColumn("class_size", F.count(F.lit(1)).over(classes))
    valid = in_class.filter((F.col("class_size") > 1) | (F.col("pages") < F.col("held")) | F.col("token").contains("\t"))
    is_block = F.col("token").contains("\t")
    named = F.lower("token").rlike(r"<(article|main)[^<]*>$|role=main[^<]*>$|<[a-z]+ [^<]*\b(article|content|entry|main|post|story)\b[^<]*>$")
    plain_name = F.lower("token").rlike(r"<(article|main)[^<]*>$|role=main[^<]*>$")
    apart = F.lower("token").rlike(r"<(nav|header|footer|aside|form|head|menu|dialog)\b")
    depth = F.length("token")
    body = F.max(F.when(~is_block & F.col("token").endswith("<body>"), F.col("text"))).over(Window.partitionBy("host"))
    weighed = valid.withColumn("whole", F.coalesce(body, F.max(F.when(~is_block, F.col("text"))).over(Window.partitionBy("host"))))
    holds = ~is_block & ~apart & (F.col("text") >= MOST_TEXT * F.col("whole")) & (F.col("whole") > 0)
    # A name for the article goes first; else the innermost element that holds nearly all the text.
    rank = F.struct(F.when(plain_name, 2).when(named, 1).otherwise(0), depth, "place", "token")
    return weighed.groupBy("host").agg(
        F.max_by(F.when(holds, F.col("token")), F.when(holds, rank)).alias("container"),
        F.collect_set(F.when(is_block, F.col("token"))).alias("fixed"),
    )


def main_text(html: str | None, container: str | None, fixed: frozenset[str]) -> str:
    """The text of a page in its template's slots."""
    page = parsed(html)
    within = {x for x, e in enumerate(page.elements) if e.path == container}
    if within and page.elements[min(within)].name not in ARTICLE:
        own = {x for x, e in enumerate(page.elements) if e.name in ARTICLE}
        held = sum(len(words) for inside, _, words in page.blocks if own & {*inside})
        within = own if held else within
    if not within:
        within = {x for x, e in enumerate(page.elements) if e.name in ARTICLE and not e.aside}
    if not within:
        within = {x for x, e in enumerate(page.elements) if e.article and not e.aside}
    # Where nothing is named for the article, what all pages of the host say is the template's.
    named = any(page.elements[x].article for x in within)
    # An <article> or <main> holds all there is of the article. Of any other element that isn't sure: text beside it
    # is the article's too (a title, a lead), unless it is the template's.
    whole = any(page.elements[x].name in ARTICLE or "role=main" in page.elements[x].token for x in within)
    kept = []
    for inside, aside, words in page.blocks:
        inner = [x for x in inside if x in within]
        if not named or (not inner and not whole):
            role = page.elements[inside[-1]].path if inside else ""
            if f"{role}\t{words[:LONGEST_TOKEN]}\t{len(words)}" in fixed:
                continue
        if inner:
            beyond = [x for x in inside if x > inner[-1]]
            outer = [x for x in inside if x < inner[-1] and page.elements[x].name not in ("html", "body")]
            if any(page.elements[x].aside for x in beyond) or any(page.elements[x].name in ASIDE for x in outer):
                continue
        elif whole or aside:
            continue
        kept.append(words)
    return "\n".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    hosted = _hosted(pages)
    totals = staged(hosted.rollup("host").agg(F.count(F.lit(1)).alias("held")), "page-hosts")
    found = staged(templates(staged(occurrences(hosted), "page-tokens"), totals), "page-templates")
    common = found.filter("host is null").select(F.col("container").alias("common"), F.lit(1).alias("one"))
    # One row, and one for each host and salt: hosts' pages are dealt over SALTS tasks where these are joined by shuffle.
    salted = found.filter("host is not null").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = hosted.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    rows = rows.join(salted, ["host", "salt"], "left").withColumn("one", F.lit(1)).join(F.broadcast(common), "one", "left")

    @F.pandas_udf("string")
    def text(html: pd.Series, container: pd.Series, fixed: pd.Series) -> pd.Series:
        return pd.Series([
            main_text(h, c, frozenset(f) if f is not None else frozenset()) for h, c, f in zip(html, container, fixed)
        ], dtype=object)

    small_batches(pages.sparkSession, 500)
    out = rows.select("page_id", "url", text("html", F.coalesce("container", "common"), "fixed").alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
