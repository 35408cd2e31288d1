"""Main text of web pages by wrapper induction: pages of one host share a template, what varies is content.

1. Pages are grouped by host and layout (which landmark elements they have, in order). The shortest page
   of a group, by a hash where several are, is its seed; one tree a group, whatever the group's size.
2. `evidence`: every page's tree is aligned with its seed's by simple tree matching (`dom.Matcher`), where
   the page is, and each task counts how often a seed node met a partner with the same text. Pages whose
   article is the seed's own prove nothing about it and are left out, so copies of a page do not turn
   it into a template. Only counts per seed node are ever brought together.
3. A seed node whose text stays the same in `share` percent of at least `least` pages is template, all
   other text is a slot. Inside an article or main element it takes `inside_share` percent of at least `inside_least`
   pages, since near copies of articles share most of their paragraphs.
4. `extracted`: each page is aligned again. A block is dropped if all of its text stands in template nodes
   with the template's text. The other blocks of the content region are the main text. The region is the
   page's articles (those in its main element, if it has one), else the main element, else the page.

Menus, headers, footers, sidebars, notices, adverts, forms and comments mostly hold slots too (other links,
another advert). They are known by their elements, roles and words of class and id (`NOISE`). A page without
article and main element also loses blocks that are mostly links (`linked` percent of their characters).

Text: character references decoded, white space inside a block (a line break element too) made one space,
trimmed; blocks in page order with \\n between them; cells of a table row make one block.

Defined cases: a null or empty html, or one without such text, gives an empty text; a null url has no
host, so its page is judged without a template; repeated rows give repeated rows; nesting beyond
`dom.DEEPEST` is flattened without losing text; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter, OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.dom import BLOCK, Matcher, Node, parse
from millrace.llm.tables import written


@dataclass(frozen=True)
class Induction:
    """Percent of the pages and pages that make a text template, outside and inside articles; percent of
    linked characters that make a block of a page without landmarks a menu."""

    share: int = 50
    least: int = 3
    inside_share: int = 90
    inside_least: int = 8
    linked: int = 60


#: Seeds of up to so many bytes together, and sizes of so many groups, are sent to all executors; more are
#: joined by key.
BROADCAST_BYTES, BROADCAST_ROWS = 32 << 20, 200_000
#: Counts a task holds before it sends them on, and trees of seeds it keeps.
HELD_COUNTS, HELD_SEEDS = 200_000, 256

_LANDMARKS = r"(?i)<(article|main|aside|header|footer|nav|section|form)\b"
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
_WORD = re.compile(r"[a-z]+")

#: Elements without article text.
NO_TEXT = frozenset(
    "head title script style noscript template iframe noembed noframes xmp textarea nav aside footer form button select datalist menu dialog "
    "svg canvas object audio video map search".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert status menu menubar toolbar form".split())
#: Words of class and id that mark what is not the article.
NOISE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion menu menus nav navbar navigation breadcrumb breadcrumbs "
    "sidebar cookie cookies consent gdpr banner notice popup modal overlay newsletter subscribe subscription comment comments disqus "
    "respond replies footer masthead share sharing social related recommended recommendations pagination pager login signup toolbar widget".split()
)
#: Of those, the ones that count on an article or main element itself, as a whole class.
OWN_NOISE = frozenset("comment comments ad ads advert advertisement sponsored promo related teaser".split())
HEADERS = frozenset("header topbar".split())


@lru_cache(maxsize=50_000)
def _dropped(tag: str, hints: str, inside: bool) -> bool:
    """Whether an element is no part of an article; `inside` an article its header is."""
    if tag in NO_TEXT or (tag == "header" and not inside):
        return True
    if not hints:
        return False
    role = re.search(r"role=(\S*)", hints)
    if (role and role[1] in ROLES) or re.search(r"(?:^| )(?:hidden=(?!until-found)|aria-hidden=true)", hints):
        return True
    names = " ".join(re.findall(r"(?:class|id)=((?:(?! (?:class|id|role|itemprop|hidden|aria-hidden)=).)*)", hints))
    if tag in ("article", "main", "html", "body"):
        return not OWN_NOISE.isdisjoint(names.split())
    words = set(_WORD.findall(names))
    return not NOISE.isdisjoint(words) or (not inside and not HEADERS.isdisjoint(words))


def _is_article(node: Node) -> bool:
    return node.tag == "article" or "itemprop=articlebody" in node.hints or "role=article" in node.hints


def regions(root: Node) -> tuple[list[Node], bool]:
    """The elements that hold the article, and whether they are landmarks."""
    articles: list[tuple[Node, bool]] = []
    mains: list[Node] = []
    waiting = [(root, False)]
    while waiting:
        node, within = waiting.pop()
        main = node.tag == "main" or "role=main" in node.hints
        if main:
            mains.append(node)
        if _is_article(node):
            articles.append((node, within))
            continue
        waiting.extend((c, within or main) for c in reversed(node.nodes) if not _dropped(c.tag, c.hints, False))
    chosen = [n for n, within in articles if within] or [n for n, _ in articles] or mains[:1]
    return (chosen, True) if chosen else ([root], False)


def blocks(region: Node, inside: bool) -> list[tuple[str, set[int], int]]:
    """(text, numbers of the elements it stands in, linked characters) of the blocks of a region."""
    found: list[tuple[str, set[int], int]] = []
    pieces: list[tuple[str, int, bool]] = []

    def flush() -> None:
        text = " ".join("".join(p[0] for p in pieces).split())
        if text:
            owners = {number for piece, number, _ in pieces if piece.strip()}
            found.append((text, owners, sum(len(piece) for piece, _, linked in pieces if linked)))
        pieces.clear()

    def walk(node: Node, linked: bool) -> None:
        if node.tag in BLOCK:
            flush()
        for child in node.children:
            if type(child) is str:
                pieces.append((child, node.number, linked))
            elif child.tag == "br":
                pieces.append((" ", node.number, linked))
            elif _dropped(child.tag, child.hints, inside):
                if child.tag in BLOCK:
                    flush()
            else:
                cell = child.tag in ("td", "th")
                if cell:
                    pieces.append((" ", node.number, linked))
                walk(child, linked or child.tag == "a")
                if cell:
                    pieces.append((" ", node.number, linked))
        if node.tag in BLOCK:
            flush()

    walk(region, False)
    flush()
    return found


def same_article(a: Node, b: Node) -> bool:
    return [n.whole for n in regions(a)[0]] == [n.whole for n in regions(b)[0]]


def template(seed: Node, pages: int, equal: dict[int, int], spec: Induction) -> dict[int, str]:
    """Number and text of the seed's nodes that are template."""
    chosen, landmark = regions(seed)
    inside: set[int] = set()
    for region in chosen if landmark else ():
        inside.update(range(region.number, region.number + region.size))
    out, waiting = {}, [seed]
    while waiting:
        node = waiting.pop()
        waiting.extend(node.nodes)
        share, least = (spec.inside_share, spec.inside_least) if node.number in inside else (spec.share, spec.least)
        if node.own and pages >= least and 100 * equal.get(node.number, 0) >= share * pages:
            out[node.number] = node.own
    return out


def main_text(page: Node, seed: Node | None, known: dict[int, str], matcher: Matcher, spec: Induction) -> str:
    """The text of a page's content region without the template's blocks."""
    constant: set[int] = set()
    if seed is not None and known and seed.label == page.label:
        constant = {y.number for x, y in matcher.pairs(seed, page) if known.get(x.number) == y.own}
    chosen, landmark = regions(page)
    kept = []
    for region in chosen:
        for text, owners, linked in blocks(region, landmark):
            menu = not landmark and 100 * linked >= spec.linked * len(text)
            if not menu and not owners <= constant:
                kept.append(text)
    return "\n".join(kept)


class _Seeds:
    """Trees of the seeds a task has met lately."""

    def __init__(self):
        self._held: OrderedDict[tuple, tuple] = OrderedDict()

    def get(self, key: tuple, make: Callable[[], tuple]) -> tuple:
        if key not in self._held:
            if len(self._held) >= HELD_SEEDS:
                self._held.popitem(last=False)
            self._held[key] = make()
        self._held.move_to_end(key)
        return self._held[key]


def _evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many pages of each group a partition has, and in how many each seed node has the same text; pages
    are counted under node -1."""
    seeds, matcher = _Seeds(), Matcher()
    counts: Counter[tuple[str, str, int]] = Counter()

    def flush() -> pa.RecordBatch:
        rows = list(counts.items())
        counts.clear()
        columns = [[host for (host, _, _), _ in rows], [layout for (_, layout, _), _ in rows], [node for (_, _, node), _ in rows], [n for _, n in rows]]
        kinds = [pa.string(), pa.string(), pa.int32(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["host", "layout", "node", "n"])

    for batch in batches:
        for host, layout, html, seed in zip(*(batch.column(c) for c in ("host", "layout", "html", "seed")), strict=True):
            host, layout = host.as_py(), layout.as_py()
            tree, own = seeds.get((host, layout), lambda s=seed: (parse(t := s.as_py()), t))
            html = html.as_py()
            if html == own:
                continue
            page = parse(html)
            if same_article(tree, page):
                continue
            counts[host, layout, -1] += 1
            counts.update((host, layout, x.number) for x, y in matcher.pairs(tree, page) if x.own and x.own == y.own)
            if len(counts) > HELD_COUNTS:
                yield flush()
    yield flush()


def _extracted(spec: Induction) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds, matcher = _Seeds(), Matcher()

        def known(seed: pa.Scalar, pages: pa.Scalar, equal: pa.Scalar) -> tuple:
            if not seed.is_valid or not pages.is_valid:
                return None, {}
            tree = parse(seed.as_py())
            return tree, template(tree, pages.as_py(), {e["node"]: e["n"] for e in equal.as_py()}, spec)

        for batch in batches:
            texts = []
            for host, layout, html, *rest in zip(*(batch.column(c) for c in ("host", "layout", "html", "seed", "pages", "equal")), strict=True):
                tree, constant = seeds.get((host.as_py(), layout.as_py()), lambda r=rest: known(*r))
                texts.append(main_text(parse(html.as_py()), tree, constant, matcher, spec))
            made = pa.array(texts, pa.string())
            lengths = pa.array(map(len, texts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), made, lengths], ["page_id", "url", "text", "n_chars"])

    return run


def keyed(pages: DataFrame) -> DataFrame:
    """page_id, url and html with host and layout."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    layout = F.array_join(F.transform(F.array_distinct(F.regexp_extract_all(html, F.lit(_LANDMARKS), F.lit(1))), F.lower), " ")
    host = F.lower(F.coalesce(F.regexp_extract(F.col("url").cast("string"), _HOST, 1), F.lit("")))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"), host.alias("host"), layout.alias("layout"))


def seeds_of(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """(host, layout, seed): the shortest page of each group, found by lengths and hashes alone."""
    group = ["host", "layout"]
    size = F.struct(F.length("html").alias("length"), F.xxhash64("html").alias("hash"))
    sized = rows.where("host <> ''").withColumn("size", size)
    least = written(spark, sized.groupBy(*group).agg(F.min("size").alias("size")), "least")
    near = F.broadcast(least) if least.count() <= BROADCAST_ROWS else least
    found = sized.join(near, [*group, "size"]).groupBy(*group).agg(F.min("html").alias("seed"))
    return written(spark, found, "seeds")


def _beside(rows: DataFrame, seeds: DataFrame, how: str) -> DataFrame:
    """Pages with what is known of their group, which goes to the pages if it is small."""
    size = seeds.agg(F.sum(F.length("seed"))).first()[0] or 0
    return rows.join(F.broadcast(seeds) if size <= BROADCAST_BYTES else seeds, ["host", "layout"], how)


def extracted(spark: SparkSession, pages: DataFrame, spec: Induction = Induction()) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page."""
    rows = keyed(pages)
    seeds = seeds_of(spark, rows)
    met = _beside(rows.where("host <> ''"), seeds, "inner").select("host", "layout", "html", "seed")
    counts = met.mapInArrow(_evidence, "host string, layout string, node int, n long").groupBy("host", "layout", "node").agg(F.sum("n").alias("n"))
    paged, equal = F.sum(F.when(F.col("node") == -1, F.col("n"))), F.collect_list(F.when(F.col("node") >= 0, F.struct("node", "n")))
    summed = counts.groupBy("host", "layout").agg(paged.alias("pages"), equal.alias("equal"))
    wrappers = written(spark, seeds.join(summed, ["host", "layout"], "left"), "wrappers")
    shape = "page_id long, url string, text string, n_chars long"
    return _beside(rows, wrappers, "left").mapInArrow(_extracted(spec), shape)
