"""Main text of web pages with site style trees."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.llm.ship import map_batches
from loomwork.session import stage

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"']+)))?""")
_NAME_PARTS = re.compile(r"[a-z]+|[0-9]+").findall

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe textarea title svg annotation select object".split())
# Of these a browser reads on to the end of the page if the end tag is missing.
_ENDLESS = frozenset("script style textarea title iframe noscript".split())
_BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
    "optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
# What an opening tag closes first, up to the nearest of the scopes.
_CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "tr": {"td", "th", "tr"},
    "option": {"option"},
}
_SCOPE = frozenset("html body article aside div section main table td th ul ol dl form nav header footer blockquote".split())

# Hints that a part is not the article: element, role, and class or id.
_NOISE_TAGS = frozenset("head nav footer aside form menu dialog button search fieldset".split())
_NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar".split()
)
_NOISE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar footer cookie cookies consent gdpr notice notices "
    "notification alert popup modal overlay newsletter subscribe subscription signup login share sharing "
    "social related recommended comment comments reply replies respond disqus pagination pager toolbar "
    "widget widgets masthead skip".split()
)
# A page header is noise, the header of an article holds its title.
_HEADER_NAMES = frozenset("header topbar".split())
_MAIN_NAMES = frozenset("article content main post entry story".split())
# Elements of running text: inside an article only a whole class or id hints there.
_TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# A hint does not count for a part that holds this many times the text outside
# of hinted parts; text in an article or main element outside counts tenfold.
_MOST, _MARKED = 2, 10


@dataclass(frozen=True)
class Style:
    """Parameters of pruning: pages that must show a path before it is judged,
    the importance under which both content and presentation of a noisy branch
    lie, how far a branch may fall behind the site's main branch in their mean,
    the words up to which a block is described by each of them, and whether
    names of elements, roles, classes and ids count as hints.  Nothing can be
    told from one page."""

    least_pages: int = 2
    threshold: float = 0.4
    behind: float = 0.2
    short_words: int = 12
    names: bool = True


@dataclass
class Block:
    """A run of text: its style path and that of its parent, whether it is known
    to be noise or part of the main text (3 article, 2 main, 1 by name), and its
    characters outside of links."""

    path: str
    parent: str
    text: str
    noise: bool
    level: int
    weight: int = 0


@dataclass
class _Node:
    """An open element; ``hint`` numbers the innermost one around that hints at noise."""

    tag: str
    path: str
    hint: int
    level: int
    link: bool
    children: list[str]


def parse(html: str, by_name: bool = True) -> tuple[list[Block], list[tuple[str, str]]]:
    """Blocks of a page in order, and the child styles of each element.

    Any input gives a result: unclosed elements end with their surroundings,
    stray end tags are ignored, an unfinished tag at the end is dropped.  A
    drawing or a selection without an end tag loses its tag alone.  Without
    ``by_name`` no name hints at noise or at the article.
    """
    root = _Node("", "", 0, 0, False, [])
    stack, blocks, styles, pieces = [root], [], [], []
    # Hinted elements by number: the hinted one around each, and the hint of each block.
    around, hints, loose = [0], [], 0

    def flush() -> None:
        nonlocal loose
        text = " ".join(unescape("".join(pieces)).split()) if pieces else ""
        pieces.clear()
        if text:
            node = next(n for n in reversed(stack) if n.tag in _BLOCK or n is root)
            parent = node.path.rpartition("/")[0]
            blocks.append(Block(node.path, parent, text, False, stack[-1].level, min(loose, len(text))))
            hints.append(stack[-1].hint)
        loose = 0

    def say(text: str) -> None:
        nonlocal loose
        pieces.append(text)
        if not stack[-1].link:
            loose += len(text.strip())

    def pop(depth: int) -> None:
        while len(stack) > depth:
            node = stack.pop()
            if node.children:
                styles.append((node.path, " ".join(node.children)))

    def close_first(wanted: set[str]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            tag = stack[depth].tag
            if tag in wanted:
                pop(depth)
                return
            if tag in _SCOPE:
                return

    at, end = 0, len(html)
    while at < end:
        found = _TAG.search(html, at)
        if found is None:
            say(html[at:])
            break
        say(html[at : found.start()])
        at = found.end()
        closing = found[1] if found[2] else found[4]
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        if closing:
            if tag in _BLOCK:
                flush()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    if tag in _BLOCK or not any(n.tag in _BLOCK for n in stack[depth:]):
                        pop(depth)
                    break
            continue
        attributes = _attributes(found[3] or found[6] or "")
        if tag in _BLOCK:
            flush()
            close_first({"p"})
            if tag in _CLOSES:
                close_first(_CLOSES[tag])
        elif tag == "br":
            pieces.append(" ")
        if tag in _RAW:
            if (found[3] or found[6] or "").endswith("/") and tag not in _ENDLESS:
                continue
            over = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(html, at)
            if over is None and tag in _ENDLESS:
                break
            at = over.start() if over else at
            # The end tag itself is skipped as a stray one.
            continue
        if tag in _VOID:
            continue
        above = stack[-1]
        hinted, level = _judged(tag, attributes, above) if by_name else (False, 0)
        hint = above.hint
        if hinted:
            around.append(hint)
            hint = len(around) - 1
        link = tag == "a" or (above.link and tag not in _BLOCK)
        if tag in _BLOCK:
            style = tag + "".join("." + c for c in _names(attributes.get("class")))
            inner = next(n for n in reversed(stack) if n.tag in _BLOCK or n is root)
            inner.children.append(style)
            path = f"{above.path}/{style}"
        else:
            path = above.path
        stack.append(_Node(tag, path, hint, level, link, []))
    flush()
    pop(1)
    _settle(blocks, hints, around)
    return blocks, styles


def _settle(blocks: list[Block], hints: list[int], around: list[int]) -> None:
    """Make noise of hinted blocks, but of no part that holds most of the page's text.

    Parts are freed from the one of most text on, a part before those inside it,
    as long as they outweigh what is free; links do not count as text.
    """
    direct, free = [0] * len(around), 0
    for b, hint in zip(blocks, hints):
        if hint:
            direct[hint] += b.weight
        free += 0 if hint else b.weight * (_MARKED if b.level > 1 else 1)
    whole = direct[:]
    for hint in range(len(around) - 1, 0, -1):
        whole[around[hint]] += whole[hint]
    freed = {0}
    for hint in sorted(range(1, len(around)), key=lambda k: -whole[k]):
        if whole[hint] <= _MOST * free:
            break
        if around[hint] in freed:
            freed.add(hint)
            free += direct[hint]
    for b, hint in zip(blocks, hints):
        b.noise = hint not in freed


def _attributes(source: str) -> dict[str, str]:
    if not source or source.isspace():
        return {}
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(source)}


def _names(value: str | None) -> list[str]:
    """Words of a class or id; numbers are one name, as they often count pages."""
    return ["0" if p.isdigit() else p for p in _NAME_PARTS(unescape(value).lower())] if value else []


def _judged(tag: str, attributes: dict[str, str], above: _Node) -> tuple[bool, int]:
    """Whether an element hints at noise, and the level of its text."""
    level = above.level
    if not attributes and tag not in _NOISE_TAGS and tag not in ("article", "main", "header"):
        return False, level
    names = {*_names(attributes.get("class")), *_names(attributes.get("id"))}
    role = attributes.get("role", "").lower()
    noise = tag in _NOISE_TAGS or role in _NOISE_ROLES or "hidden" in attributes
    hints = names
    if level > 1 and tag in _TEXT_TAGS:
        hints = {*attributes.get("class", "").lower().split(), attributes.get("id", "").lower()}
    noise = noise or (tag not in ("html", "body") and bool(hints & _NOISE_NAMES))
    noise = noise or (not level and (tag == "header" or bool(names & _HEADER_NAMES)))
    if tag == "article" or role == "article" or "articlebody" in attributes.get("itemprop", "").lower():
        level = 3
    elif tag == "main" or role == "main":
        level = max(level, 2)
    elif tag not in ("html", "body") and names & _MAIN_NAMES:
        level = max(level, 1)
    return noise, level


def main_text(blocks: list[Block], noisy: set[int], behind: set[int] = frozenset()) -> str:
    """Blocks of the article, one a line.

    The branches that the site's style tree calls noise go from every page.  If
    nothing would be left they stay: a site of copies has no other text.
    Branches far behind the main one go too, but for headings and what a page
    marks as its article, and unless they hold most of the page's text.  Of
    what is left, the part that a page marks as its article counts if it holds
    half of the text or more: the narrowest such part, with all inside it.
    """
    usable = [b for b in blocks if not b.noise]
    left = [b for b in usable if _mark(b.path) not in noisy] if noisy else usable
    left = left or usable
    if behind:
        kept = [b for b in left if b.level or _is_heading(b) or _mark(b.path) not in behind]
        if sum(b.weight for b in left) <= (_MOST + 1) * sum(b.weight for b in kept):
            left = kept or left
    whole = sum(b.weight for b in left)
    for level in sorted({b.level for b in left}, reverse=True):
        part = [b for b in left if b.level >= level]
        if 2 * sum(b.weight for b in part) >= whole:
            return "\n".join(b.text for b in part)
    return ""


def _is_heading(block: Block) -> bool:
    return block.path.rpartition("/")[2].partition(".")[0] in _HEADINGS


def _mark(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def host_of(url: Column) -> Column:
    """Lower-case host of a URL; null if there is none."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return F.when(host != "", host)


def features(text: str, short_words: int) -> list[str]:
    """What describes a block in the tree: the words of a short one, else its text.

    Menus, adverts and notices are short and vary in some words; of running text
    single words tell nothing, as most pages share them.
    """
    words = text.split()
    return words if len(words) <= short_words else [text]


def style_nodes(pages: DataFrame, style: Style = Style()) -> DataFrame:
    """The style tree of every host: ``host, path, parent, kind, item, pages, total, spread``.

    One row per content feature (``kind`` 1), child style (2) or the node itself
    (0, ``item`` the kind it stands for) at a style path; all blocks count,
    whatever their names hint.  ``total`` counts occurrences, for a node of
    contents its characters outside of links and hinted parts, and ``spread`` is
    the sum of c ln c over counts c per page, which give the entropy over pages.
    A page sends each item once and tasks combine them, so a host with a third
    of the pages costs no task more than its distinct items.
    """
    names, short_words = style.names, style.short_words

    def run(batch: pa.RecordBatch):
        hosts, rows = batch.column(0).to_pylist(), []
        for host, html in zip(hosts, batch.column(1).to_pylist()):
            blocks, styles = parse(html or "", names)
            found, texts = Counter(), Counter()
            for b in blocks:
                path, parent = _mark(b.path), _mark(b.parent)
                found.update((path, parent, 1, _mark(item)) for item in features(b.text, short_words))
                texts[path, parent, 0, 1] += 0 if b.noise else b.weight
            shown = [(_mark(path), 0, 2, _mark(layout)) for path, layout in styles]
            found.update(shown)
            found.update({(key[0], key[1], 0, 2): 1 for key in shown})
            found.update(texts)
            rows += [(host, *key, n) for key, n in found.items()]
        if rows:
            host, path, parent, kind, item, n = zip(*rows)
            count = np.array(n, np.float64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(host),
                    pa.array(path, pa.int64()),
                    pa.array(parent, pa.int64()),
                    pa.array(kind, pa.int32()),
                    pa.array(item, pa.int64()),
                    pa.array(count),
                    pa.array(count * np.log(np.maximum(count, 1))),
                ],
                names=["host", "path", "parent", "kind", "item", "n", "spread"],
            )

    schema = "host string, path bigint, parent bigint, kind int, item bigint, n double, spread double"
    sent = map_batches(pages.select(host_of(F.col("url")).alias("host"), "html").where("host IS NOT NULL"), run, schema)
    return sent.groupBy("host", "path", "parent", "kind", "item").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("n").alias("total"), F.sum("spread").alias("spread")
    )


def noisy_paths(pages: DataFrame, style: Style = Style()) -> DataFrame:
    """``host, paths, behind``: style paths whose branch is of low importance.

    A content node over m pages has importance 1 minus the mean entropy, to
    base m + 1, of its features over pages: a word that all pages share tells
    nothing.  An element has the entropy, to base m + 1, of its child styles: one
    layout for all pages tells nothing either.  The page more that is counted, as
    one that shares nothing, asks the more agreement the fewer pages there are:
    of two pages nearly all contents must agree.  A branch is noise (``paths``)
    if both its contents and the element that holds it fall under the
    threshold.  It is ``behind`` if the mean of both lies that far under the
    mean of the branch that holds most of the site's text: menus and adverts of
    other words on every page still keep one layout, articles do not.
    """
    nodes = style_nodes(pages, style)
    content, node = F.col("kind") == 1, F.col("kind") == 0
    entropy = F.ln("total") - F.col("spread") / F.col("total")
    by_path = stage(
        nodes.groupBy("host", "path", "parent").agg(
            F.avg(F.when(content, entropy)).alias("entropy"),
            F.max(F.when(node & (F.col("item") == 1), F.col("pages"))).alias("m"),
            F.max(F.when(node & (F.col("item") == 1), F.col("total"))).alias("chars"),
            F.max(F.when(node & (F.col("item") == 2), F.col("pages"))).alias("ms"),
            F.sum(F.when(F.col("kind") == 2, F.col("total"))).alias("styles"),
            F.sum(F.when(F.col("kind") == 2, F.col("total") * F.ln("total"))).alias("styles_ln"),
        ),
        "style-tree",
    )
    shown = by_path.where("ms IS NOT NULL").select(
        F.col("host").alias("_host"),
        F.col("path").alias("_path"),
        ((F.ln("styles") - F.col("styles_ln") / F.col("styles")) / F.ln(F.col("ms") + 1)).alias("look"),
    )
    leaves = (
        by_path.where(F.col("m") >= style.least_pages)
        .join(shown, (F.col("host") == F.col("_host")) & (F.col("parent") == F.col("_path")), "left")
        .select(
            "host",
            "path",
            "chars",
            (1 - F.col("entropy") / F.ln(F.col("m") + 1)).alias("told"),
            F.coalesce("look", F.lit(0.0)).alias("look"),
        )
        .withColumn("importance", (F.col("told") + F.col("look")) / 2)
    )
    best = F.max_by("importance", F.struct("chars", "path"))
    main = leaves.where("chars > 0").groupBy("host").agg(best.alias("main"))
    low = (F.col("told") < style.threshold) & (F.col("look") < style.threshold)
    behind = F.col("importance") < F.col("main") - style.behind
    judged = leaves.join(main, "host", "left").select("host", "path", low.alias("low"), (~low & behind).alias("far"))
    return (
        judged.where("low OR far")
        .groupBy("host")
        .agg(
            F.collect_set(F.when(F.col("low"), F.col("path"))).alias("paths"),
            F.collect_set(F.when(F.col("far"), F.col("path"))).alias("behind"),
        )
    )


def extract(pages: DataFrame, style: Style = Style()) -> DataFrame:
    """Main text of every page: ``page_id, url, text, n_chars``.

    The pages of a host are merged into a style tree and its branches of low
    importance are cut from each page, whether it marks its article or not; where
    it marks none, so are those far behind the main branch.
    Elements that state their role come first: menus, headers, footers,
    sidebars, forms, adverts, notices and reader comments go by element, role,
    class or id, but none that holds most of a page's text: there the tree
    decides.  Of what it leaves, the part marked as article counts if it holds
    half of the text or more.  Scripts, styles and markup go; character
    references are decoded; white space inside a block becomes one space.

    A null html is empty; a page without text gives an empty text; a null or
    odd url has no host, so only the page itself counts; null ids and repeated
    rows are kept; other columns are ignored; an empty table gives no rows.
    """
    noise = stage(noisy_paths(pages, style), "noisy-paths")
    kind = pages.schema["page_id"].dataType.simpleString()

    names = style.names

    def run(batch: pa.RecordBatch):
        texts = []
        for html, noisy, behind in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4))):
            texts.append(main_text(parse(html or "", names)[0], set(noisy or ()), set(behind or ())))
        lengths = pa.array([len(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), lengths],
            names=["page_id", "url", "text", "n_chars"],
        )

    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host")).join(noise, "host", "left")
    return map_batches(
        rows.select("page_id", "url", "html", "paths", "behind"), run, f"page_id {kind}, url string, text string, n_chars bigint"
    )
