"""Main text of web pages by a site style tree.

The elements of a host's pages are merged where their tag paths agree. An element whose
children are laid out alike on all pages has little presentation importance, one whose text
recurs from page to page has little content importance. Both come from entropies over the
pages that have the element. In each page the two are composed from the leaves up, and
branches of low composite importance go.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmargin.llm.common import stored, table

# Branches under this composite importance are removed.
THRESHOLD = 0.15
# Weight that composite importance loses with every child an element has.
DECAY = 0.9

# The roles of HTML elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp noembed noframes iframe".split())
UNSEEN = RAW | set("head noscript template svg math object canvas audio video select option button datalist".split())
CHROME = set("nav footer aside form dialog menu fieldset".split())
BLOCKS = set(
    "address article aside blockquote body br caption dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - {"br", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html"}
PROSE = set("p h1 h2 h3 h4 h5 h6 blockquote pre b i em strong a span code table tbody tr td th ul ol li dl dt dd".split())
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "tbody": {"tbody", "thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
SCOPES = set("table ul ol dl td th article main section div body html".split())
CHROME_NAMES = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "sidebar menu nav navbar navigation navi breadcrumb breadcrumbs footer masthead cookie cookies "
    "consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social comment comments commentlist reply replies respond disqus related "
    "recommended widget pagination pager skip toolbar copyright legal disclaimer search".split()
)
# Furniture whatever the share of the text; in classes also as the first part of a name.
REMARKS = set("comment comments commentlist reply replies respond disqus related recommended".split())
# What may hold the whole page; names and roles don't remove it.
WRAPPERS = set("html body main article".split())
CHROME_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?/][^>]*>|[^<]+|<",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NOT_SHOWN = re.compile(r"(?<![\w-])display\s*:\s*none", re.I)
_NAMES = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "sidebar menu nav navbar navigation navi breadcrumb breadcrumbs footer masthead cookie cookies "
    "consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social comment comments commentlist reply replies respond disqus related "
    "recommended widget pagination pager skip toolbar copyright legal disclaimer search".split()
)
# Furniture whatever the share of the text; in classes also as the first part of a name.
REMARKS = set("comment comments commentlist reply replies respond disqus related recommended".split())
# What may hold the whole page; names and roles don't remove it.
WRAPPERS = set("html body main article".split())
CHROME_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?/][^>]*>|[^<]+|<",
    re.S,
)
_NAMING = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?<![\w-])hidden(?![\w-])|display\s*:\s*none", re.I)
_NAMES = re.compile(r"[a-z]+")


@dataclass
class Page:
    """Elements in page order (parents first) and the pieces of text between them."""

    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    paths: list[int] = field(default_factory=list)
    chrome: list[bool] = field(default_factory=list)
    named: list[bool] = field(default_factory=list)  # furniture unless most of the text is in it
    children: list[list[int]] = field(default_factory=list)
    pieces: list[tuple[int, str]] = field(default_factory=list)  # element, text


def _label(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """Name of an element in the tree, and whether it is page furniture by its own account.

    The second is certain, the third holds unless most of the text is in it.
    """
    chrome, named = tag in CHROME and tag != "form", tag == "form"
    names: list[str] = []
    if attributes and ("=" in attributes or "hidden" in attributes.lower()):
        for kind, *values in _ATTRIBUTE.findall(attributes):
            kind, value = kind.lower(), "".join(values).lower()
            if kind == "hidden" or (kind == "style" and _NOT_SHOWN.search(value)):
                chrome = True
            elif kind in ("class", "id", "role"):
                names += _NAMES.findall(value)
                if tag in WRAPPERS:
                    continue
                tokens = value.split()
                known = CHROME_ROLES if kind == "role" else CHROME_NAMES
                named = named or any(t in known for t in tokens)
                if kind == "class":
                    tokens = [re.split("[-_]", t, maxsplit=1)[0] for t in tokens]
                chrome = chrome or (kind != "role" and any(t in REMARKS for t in tokens))
    return " ".join([tag, *sorted(set(names))]), chrome, named


def parse(source: str | None) -> Page:
    """The elements of a page; unclosed and misnested tags are mended like browsers do."""
    page, text, at = Page(), source or "", 0
    page.tags.append("")
    page.parents.append(-1)
    page.paths.append(0)
    page.chrome.append(False)
    page.named.append(False)
    page.children.append([])
    stack = [0]
    while at < len(text):
        match = _TOKEN.match(text, at)
        if match[0] == "<" and (text[at + 1 : at + 2].isalpha() or text[at + 1 : at + 2] == "/"):
            end = text.find(">", at)  # a tag with an open quote, or one that never ends
            at = len(text) if end < 0 else end + 1
            continue
        at = match.end()
        tag = match[2]
        if tag is None:
            token = match[0]
            if token[0] != "<" or token == "<":
                page.pieces.append((stack[-1], html.unescape(token) if "&" in token else token))
            continue
        tag = tag.lower()
        if match[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if page.tags[stack[depth]] == tag:
                    del stack[depth:]
                    break
            if tag in BLOCKS:
                page.pieces.append((stack[-1], " "))
            continue
        _close_implied(page, stack, tag)
        label, chrome, named = _label(tag, match[3])
        parent = stack[-1]
        number = len(page.tags)
        page.tags.append(tag)
        page.parents.append(parent)
        page.paths.append(xxhash.xxh64_intdigest(label.encode(), seed=page.paths[parent]))
        page.chrome.append(chrome)
        page.named.append(named)
        page.children.append([])
        page.children[parent].append(number)
        if tag in BLOCKS:
            page.pieces.append((parent, " "))
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(text, at)
            at = end.end() if end else len(text)
        elif tag not in VOID and not match[3].endswith("/"):
            stack.append(number)
    return page


def _close_implied(page: Page, stack: list[int], tag: str) -> None:
    if tag in CLOSES_P:
        _close(page, stack, {"p"}, SCOPES)
    if tag in SIBLINGS:
        _close(page, stack, SIBLINGS[tag], SCOPES - SIBLINGS[tag])


def _close(page: Page, stack: list[int], tags: set[str], scopes: set[str]) -> None:
    """Close the outermost open element of ``tags`` within the innermost of ``scopes``."""
    found = None
    for depth in range(len(stack) - 1, 0, -1):
        open_tag = page.tags[stack[depth]]
        if open_tag in tags:
            found = depth
        elif open_tag in scopes:
            break
    if found is not None:
        del stack[found:]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def page_facts(page: Page) -> Iterator[tuple[int, bool, int]]:
    """(path, is content, hash) of a page: each element's layout and each of its own texts."""
    layouts: dict[int, xxhash.xxh64] = {}
    for number in range(1, len(page.tags)):
        last, found = None, layouts.setdefault(page.paths[number], xxhash.xxh64())
        for child in page.children[number]:
            if page.paths[child] != last:
                last = page.paths[child]
                found.update(last.to_bytes(8, "little"))
        found.update(b"|")
    for path, found in layouts.items():
        yield path, False, found.intdigest()
    seen = set()
    for element, text in page.pieces:
        if element and not text.isspace():
            fact = (page.paths[element], xxhash.xxh64_intdigest(" ".join(text.split()).encode()))
            if fact not in seen:
                seen.add(fact)
                yield fact[0], True, fact[1]


def composite(page: Page, importance: dict[int, tuple[float, float]]) -> list[float]:
    """Composite importance of every element: its own layout, its texts and its children."""
    n = len(page.tags)
    texts = [0] * n
    for element, text in page.pieces:
        if not text.isspace():
            texts[element] += 1
    out = [0.0] * n
    total, count = [0.0] * n, [0] * n
    for number in range(n - 1, -1, -1):
        layout, content = importance.get(_signed(page.paths[number]), (1.0, 1.0))
        if texts[number]:
            total[number] += content
            count[number] += 1
        if count[number]:
            kept = DECAY ** len(page.children[number])
            out[number] = (1 - kept) * layout + kept * total[number] / count[number]
        parent = page.parents[number]
        if parent >= 0 and count[number]:
            total[parent] += out[number]
            count[parent] += 1
    return out


def best_within(page: Page, score: list[float]) -> list[float]:
    """Largest importance in each branch: a branch is noise only if everything in it is."""
    best = list(score)
    for number in range(len(best) - 1, 0, -1):
        parent = page.parents[number]
        best[parent] = max(best[parent], best[number])
    return best


def furniture(page: Page) -> list[bool]:
    """Which elements are furniture by their own account, given where the text is."""
    if not any(page.named):
        return page.chrome
    n = len(page.tags)
    unseen, length = [False] * n, [0] * n
    for number in range(1, n):
        unseen[number] = (
            unseen[page.parents[number]] or page.tags[number] in UNSEEN or page.chrome[number]
        )
    for element, text in page.pieces:
        if not unseen[element]:
            length[element] += len(text.strip())
    for number in range(n - 1, 0, -1):
        length[page.parents[number]] += length[number]
    most = length[0] / 2
    return [c or (m and x <= most) for c, m, x in zip(page.chrome, page.named, length, strict=True)]


def main_text(page: Page, importance: dict[int, tuple[float, float]]) -> str:
    """Text of the branches that stay.

    Furniture by its own name or role and branches of low importance go, but a name removes no
    element with most of the text. Prose in an article stays even where all pages of a host
    repeat it, and inline elements go with their block. If the page has articles or a main
    element outside of what goes, only what is in them counts.
    """
    n = len(page.tags)
    chrome = furniture(page)
    score = best_within(page, composite(page, importance))
    state = [0] * n  # 0 outside of an article, 1 inside, 2 removed, 3 never shown
    for number in range(1, n):
        tag, parent = page.tags[number], state[page.parents[number]]
        if parent == 3 or tag in UNSEEN:
            state[number] = 3
        elif tag in ("article", "main") and parent != 2 and not chrome[number]:
            state[number] = 1
        elif parent == 2 or chrome[number] or (tag == "header" and parent == 0):
            state[number] = 2
        elif tag in BLOCKS and score[number] < THRESHOLD and not (parent == 1 and tag in PROSE):
            state[number] = 2
        else:
            state[number] = parent
    wanted = 1 if 1 in state else 0
    # A removed element still ends the block around it.
    return " ".join(
        "".join(t if state[e] == wanted else " " * (t == " ") for e, t in page.pieces).split()
    )


def host_of(url: Column) -> Column:
    """Host of an address in lower case, '' for null or none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, paths, layouts, contents): importance of the elements of each host's style tree.

    Facts are counted per batch of pages, then by Spark with partial sums, so a host with most
    of the pages is no bottleneck. A host's row holds its distinct tag paths, not its pages.
    """

    def facts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: Counter = Counter()
            for host, source in zip(batch["host"], batch["html"], strict=True):
                for path, content, value in page_facts(parse(source)):
                    found[host, _signed(path), content, _signed(value)] += 1
            yield pd.DataFrame(
                [(*key, count) for key, count in found.items()],
                columns=["host", "path", "content", "value", "pages"],
            )

    counted = (
        pages.select("host", "html")
        .mapInPandas(facts, "host string, path long, content boolean, value long, pages long")
        .groupBy("host", "path", "content", "value")
        .agg(F.sum("pages").cast("double").alias("c"))
    )
    sums = counted.groupBy("host", "path").agg(
        F.sum(F.when(~F.col("content"), F.col("c"))).alias("m"),
        F.sum(F.when(~F.col("content"), F.col("c") * F.log("c"))).alias("layout"),
        F.avg(F.when(F.col("content"), F.log("c"))).alias("content"),
    )
    several = F.col("m") > 1
    layout = F.when(several, 1 - F.col("layout") / (F.col("m") * F.log("m"))).otherwise(1.0)
    content = F.when(several, 1 - F.col("content") / F.log("m")).otherwise(1.0)
    return (
        sums.select(
            "host", "path", layout.alias("layout"), F.coalesce(content, F.lit(1.0)).alias("content")
        )
        .groupBy("host")
        .agg(
            F.collect_list("path").alias("paths"),
            F.collect_list("layout").alias("layouts"),
            F.collect_list("content").alias("contents"),
        )
    )


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html).

    A null or empty page has the text ''. Pages without a host share one tree. Repeated rows
    count as pages each and give a row each. Other columns are ignored.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            trees: dict[str, dict[int, tuple[float, float]]] = {}
            texts = []
            for host, source, paths, layouts, contents in zip(
                *(batch[c] for c in ("host", "html", "paths", "layouts", "contents")), strict=True
            ):
                if host not in trees:
                    known = paths is not None
                    values = zip(layouts.tolist(), contents.tolist(), strict=True) if known else ()
                    trees[host] = dict(zip(paths.tolist(), values, strict=True)) if known else {}
                texts.append(main_text(parse(source), trees[host]))
            yield pd.DataFrame(
                {
                    "page_id": batch["page_id"].astype("Int64"),
                    "url": batch["url"],
                    "text": texts,
                    "n_chars": [len(t) for t in texts],
                }
            )

    pages = pages.select(
        F.col("page_id").cast("long"), "url", "html", host_of(F.col("url")).alias("host")
    )
    # Stored, its size is known when the join is planned: small trees are broadcast and the pages
    # stay where they are, larger ones are joined by host, where AQE splits a hot one.
    joined = pages.join(stored(style_tree(pages), "style-tree"), "host", "left")
    return joined.select("page_id", "url", "html", "host", "paths", "layouts", "contents").mapInPandas(
        cut, "page_id long, url string, text string, n_chars long"
    )


def op2_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_main_text(table(spark, sf_dir, "pages"))
