"""Main text of web pages by site style trees.

The pages of a host are merged into one style tree: a node is a path of block elements, each with tag,
class and id. For every node the pages of different text that have it are counted, with the presentation styles it takes
(the sequence of its children) and the content found under it. A node is important if it is presented
in varied ways or holds content that differs from page to page; a branch that looks and reads the same
all over the site is removed from each of its pages. What the mark-up itself declares as menu, header,
footer, form, advert and the like is left out from the start, and where a page declares its article,
only that counts.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import partial
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import cut, map_batches, pieces

#: A comment, a declaration, or a tag: (closing, name, attributes). Possessive, so it never backtracks.
MARKUP = re.compile(
    r"""<!--(?:.*?-->|.*)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+>?)""", re.S
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
# Element names of the HTML standard by how they behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes svg math select".split())
BLOCK = frozenset(
    "html body head address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre search "
    "section summary table caption colgroup tbody thead tfoot tr td th ul".split()
)
ENDS_PARAGRAPH = BLOCK - frozenset("html body head option optgroup caption colgroup tbody thead tfoot tr td th".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"}, "body": {"head"},
}
SCOPE = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}
APART = frozenset("nav footer aside form menu dialog button head search fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
#: Words that, alone or joined with one another, are a label (class or id) of a part beside the article.
BESIDE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted sidebar "
    "sidenav menu menubar nav navbar navigation breadcrumb breadcrumbs topbar masthead header footer copyright cookie cookies "
    "consent gdpr notice notices notification alert popup popover modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations comment comments commentlist disqus reply replies respond "
    "discussion feedback widget toolbar pagination pager paywall skip hidden".split()
)
#: Words that say where or in what such a part stands, and nothing by themselves.
AROUND = frozenset("area bar block box button buttons container list site slot unit wrap wrapper".split())
#: Of these, the words of readers' comments, and of what stands inside articles as well: adverts and sharing.
COMMENTS = frozenset("comment comments commentlist disqus".split())
WITHIN = COMMENTS | frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo cookie cookies consent gdpr newsletter "
    "subscribe share sharing social".split()
)
WHOSE = frozenset("article page post reader section user".split())


class Block(NamedTuple):
    """A run of text: the nodes it stands under, whether it is part of the article, the text."""

    nodes: tuple[int, ...]
    article: bool
    text: str


def _beside(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether the mark-up declares the element to stand beside the article."""
    if name in APART or (name == "header" and not in_article):
        return True
    if attributes.get("role", "").lower() in ROLES or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    return "display:none" in attributes.get("style", "").replace(" ", "").lower()


def _labelled(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether a whole label of the element says that it stands beside the article; in an article,
    whether it says so of a part that may stand there: comments, adverts, sharing."""
    if name in ("html", "body", "article", "main"):
        return False
    telling = WITHIN if in_article else BESIDE
    for value in (attributes.get("class", ""), attributes.get("id", "")):
        for label in value.split():
            words = set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", label).lower()))
            rest = words - telling - AROUND
            if words & telling and (not rest or (words & COMMENTS and rest <= WHOSE)):
                return True
    return False


MAIN, ARTICLE = 1, 2
IN_FORM, BESIDE_IT = 1, 2


def _declares_article(name: str, attributes: dict[str, str]) -> int:
    """MAIN of the main part of a page, ARTICLE of an article, else 0."""
    role = attributes.get("role", "").lower()
    if name == "article" or role == "article" or attributes.get("itemprop") == "articleBody":
        return ARTICLE
    return MAIN if name == "main" or role == "main" else 0


def parse(html: str) -> tuple[list[Block], dict[int, int]]:
    """The blocks of text of a page that are not declared to stand beside the article, in page order,
    and the presentation style of every node: a hash of its children.

    A label does not say so of a branch with most of the text or with all the articles that the page
    declares; inside an article, only labels of comments, adverts and sharing do, others are left to the
    style tree. A form around a declared article or main part, as servers render it, is no form beside it."""
    blocks: list[Block] = []
    styles: dict[int, list[str]] = {}
    # open elements: name, node, beside (in a form only, or otherwise), in an article (or in the main part of
    # the page), labelled branches
    stack: list[tuple[str, int, int, int, tuple[int, ...]]] = [("", 0, 0, 0, ())]
    texts: list[str] = []
    branches: list[tuple[int, ...]] = []  # of each block
    letters: dict[int, int] = {}  # under each labelled branch

    def flush() -> None:
        if texts:
            text = " ".join(unescape("".join(texts)).split())
            texts.clear()
            if text and not stack[-1][2]:
                nodes = tuple(dict.fromkeys(x[1] for x in stack))
                blocks.append(Block(nodes, stack[-1][3] > 0, text))
                branches.append(stack[-1][4])
                for x in stack[-1][4]:
                    letters[x] = letters.get(x, 0) + len(text)

    def close(names: set[str], until: set[str]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in names:
                flush()
                del stack[depth:]
                return
            if stack[depth][0] in until or stack[depth][0] in ("table", "article", "main", "body"):
                return

    at, size = 0, len(html)
    while at < size:
        found = MARKUP.search(html, at)
        if not found:
            texts.append(html[at:])
            break
        if found.start() > at:
            texts.append(html[at : found.start()])
        at = found.end()
        if not found[2]:
            continue
        name = found[2].lower()
        if found[1]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
            if depth:
                if name in BLOCK or any(x[0] in BLOCK for x in stack[depth:]):
                    flush()
                del stack[depth:]
            continue
        if name in RAW and not found[3].endswith("/>"):
            end = re.compile(rf"</{name}\s*>?", re.I).search(html, at)
            at = end.end() if end else size
            texts.append(" ")
            continue
        if name in VOID:
            if name == "hr":
                flush()
            texts.append(" ")
            continue
        block = name in BLOCK
        if block:
            if name in ENDS_PARAGRAPH:
                close({"p"}, set())
            if name in CLOSES:
                close(CLOSES[name], SCOPE.get(name, {"table"}))
            flush()
        plain = found[3] in (">", "")
        attributes = {} if plain else {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(found[3].rstrip("/>"))}
        _, node, beside, article, under = stack[-1]
        if block:
            label = name if plain else re.sub(r"\d+", "0", f"{name}.{attributes.get('class', '')}#{attributes.get('id', '')}")
            children = styles.setdefault(node, [])
            if not children or children[-1] != label:
                children.append(label)
            node = xxhash.xxh64_intdigest(label, node) >> 1
        if block or not plain:
            if _beside(name, attributes, article > 0):
                form = name == "form" or attributes.get("role", "").lower() == "form"
                beside = max(beside, IN_FORM if form and not article else BESIDE_IT)
            if not plain and _labelled(name, attributes, article == ARTICLE):
                under = (*under, found.start())
        declared = _declares_article(name, attributes)
        if declared and beside == IN_FORM:
            beside = 0
        stack.append((name, node, beside, max(article, declared), under))
    flush()
    total = sum(len(x.text) for x in blocks)
    dropped = {x for x, size in letters.items() if 2 * size <= total}
    # where all declared articles stand in labelled branches, the labels above them are wrong
    if not any(x.article and dropped.isdisjoint(y) for x, y in zip(blocks, branches)):
        dropped -= {z for x, y in zip(blocks, branches) if x.article for z in y}
    blocks = [x for x, y in zip(blocks, branches) if dropped.isdisjoint(y)]
    return blocks, {node: xxhash.xxh64_intdigest("\0".join(x)) >> 1 for node, x in styles.items()}


def main_text(blocks: list[Block], unimportant: frozenset[int] | set[int] = frozenset()) -> str:
    """The article's blocks, or all where no article is declared, without those under unimportant nodes
    (unless that would leave nothing: then the page is all the site has to say)."""
    chosen = [x for x in blocks if x.article] or blocks
    kept = [x for x in chosen if not unimportant.intersection(x.nodes)] or chosen
    return "\n\n".join(x.text for x in kept)


PRESENTATION, CONTENT = 0, 1


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each page its host, a hash of the text it would have by its mark-up alone, and what it adds to the
    style tree: the style of each node and the contents under it, packed."""
    for batch in pieces(batches, "html"):
        contents, trees = [], []
        for html in batch.column("html").to_pylist():
            blocks, styles = parse(html or "")
            under = {(node, CONTENT, xxhash.xxh64_intdigest(x.text) >> 1) for x in blocks for node in x.nodes}
            found = under | {(node, PRESENTATION, styles.get(node, 0)) for node, *_ in under}
            contents.append(xxhash.xxh64_intdigest(main_text(blocks)) >> 1)
            trees.append(zlib.compress(np.array(sorted(found, key=lambda x: x[::-1]), np.int64).reshape(-1, 3).T.tobytes(), 1))
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(contents, pa.int64()), pa.array(trees, pa.binary())], ["host", "content", "tree"])


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "tree", 1 << 18):
        trees = [np.frombuffer(zlib.decompress(x), np.int64).reshape(3, -1) for x in batch.column("tree").to_pylist()]
        node, kind, feature = np.concatenate(trees, axis=1)
        hosts = batch.column("host").take(pa.array(np.repeat(np.arange(len(trees)), [x.shape[1] for x in trees])))
        yield pa.RecordBatch.from_arrays([hosts, pa.array(node), pa.array(kind.astype(np.int32)), pa.array(feature)], ["host", "node", "kind", "feature"])


def with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host.alias("host"), F.col("html").cast("string").alias("html"))


def importance(pages: DataFrame, share: float = 0.5) -> DataFrame:
    """(host, node, pages, importance) of every node of the hosts' style trees; pages as of `with_host`.

    Pages of a host that have the same text are one page here: copies of an article are no evidence of a
    template. With m pages that have the node, presentation importance is the entropy of its styles to base m,
    content importance one less the mean entropy of the contents under it (0 for one found on a single
    page, 1 for one on all of them); `share` weighs the two. A node of a single page counts 1.
    """
    trees = map_batches(pages, _trees, "host string, content long, tree binary").groupBy("host", "content").agg(F.min("tree").alias("tree"))
    found = map_batches(trees.select("host", "tree"), _nodes, "host string, node long, kind int, feature long")
    counts = found.groupBy("host", "node", "kind", "feature").agg(F.count("*").alias("n"))
    shown = F.col("kind") == PRESENTATION
    sums = counts.groupBy("host", "node").agg(
        F.sum(F.when(shown, F.col("n"))).alias("pages"),
        F.sum(F.when(shown, F.col("n") * F.log("n"))).alias("style_logs"),
        F.avg(F.when(~shown, F.log("n"))).alias("content_log"),
    )
    m = F.log(F.col("pages").cast("double"))
    style = (m - F.col("style_logs") / F.col("pages")) / m
    content = F.lit(1.0) - F.col("content_log") / m
    value = F.when(F.col("pages") > 1, share * style + (1 - share) * content).otherwise(1.0)
    return sums.select("host", "node", "pages", value.alias("importance"))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "html"):
        texts = [main_text(parse(html or "")[0], set(low or ())) for html, low in zip(batch.column("html").to_pylist(), batch.column("low").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


#: Rows of unimportant nodes up to which they are broadcast; more are joined by host and salt.
BROADCAST_ROWS = 20_000
SALTS = 16


def extract(pages: DataFrame, least: float = 0.25, sure_pages: int = 8) -> DataFrame:
    """(page_id, url, text) per row of `pages` (page_id, url, html): the main text, its blocks joined by
    an empty line, character references decoded, white space in a block made one space.

    Branches of importance under `least` are removed, from two pages of a host on. Under `sure_pages` pages
    the limit is smaller, by the cube of the ratio of their logarithms (0.009 at 2, 0.07 at 4, 0.2 at 7): on
    few pages only what hardly differs at all is sure to be a template.
    Null and empty pages have empty text; pages without a host share the host ''; repeated rows repeat,
    and count once as all pages of the same text do; other columns are not looked at. A host's unimportant nodes are few (templates,
    not pages, make them); they are broadcast if their number says so, else joined by host and salt.
    """
    hosted = with_host(pages)
    limit = least * F.least(F.lit(1.0), F.log("pages") / math.log(sure_pages)) ** 3
    low = importance(hosted).filter((F.col("pages") > 1) & (F.col("importance") < limit))
    low = cut(low.groupBy("host").agg(F.collect_list("node").alias("low")))
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).alias("salt")
    if (low.agg(F.sum(F.size("low"))).first()[0] or 0) <= BROADCAST_ROWS:
        known = hosted.join(F.broadcast(low), "host", "left")
    else:
        salted = low.select("host", "low", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).cast("long").alias("salt"))
        known = hosted.select("*", salt).join(salted, ["host", "salt"], "left")
    return map_batches(known.select("page_id", "url", "html", "low"), _extract, "page_id long, url string, text string")
