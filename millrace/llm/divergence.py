"""How far the sources of a language differ, term by term: every pair of them, and each against its language.

A term is a run of letters (any character beyond U+007F counts as one), with only A to Z lower-cased. A
language keeps the terms that stand in at least `least` of its documents. Each of its sources, and the
language itself, gives a kept term the smoothed share p = 1 + floor(10^9 * (count + 5) / (N + 5 * V)).

1. `term_counts`: the terms of whole texts, counted where they are; one shuffle by (language, term) gives
   counts per source, documents per language and the kept terms.
2. `row_sums`: Gustavson's row-wise product. The term-major index is cut into cells of whole terms. In a
   cell, each source walks its own terms, and each term's postings are scattered into one dense
   accumulator over the peers; no pair of postings is ever emitted, a cell gives one row of sums a source.
   Absent terms are not stored, though they weigh z = p of count 0. So a row starts from what it would
   be if no peer had any of its terms (from sorted shares and their prefix sums), and the scatter
   corrects that baseline where a peer has the term:
       sum over all terms |p_a - p_b| = R(a, b) + R(b, a) + V * |z_a - z_b|,
       R(a, b) = sum over a's terms (|p_a - z_b| - |z_a - z_b|)
               + if b comes after a, over common terms (|p_a - p_b| - |p_a - z_b| - |z_a - p_b| + |z_a - z_b|).
3. `audit`: sums of all cells added up and ranked; and the terms a source has above its language.

All sums are of whole numbers. The source list of each language reaches the cells as rows of their
own, before the postings, so nothing is broadcast; a cell holds about `cell` postings.

Defined cases: null text, lang and source read as ''; a group without any kept term still has its
pairs; where a language keeps no term all values are 0; a language of one source has no pairs; repeated
rows count as often as they stand there; an empty table gives an empty result. Other columns, ids among
them, are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.tables import written

_TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
_BETWEEN = re.compile(rb"[^A-Za-z\x80-\xff]")


@dataclass(frozen=True)
class Audit:
    """Documents a kept term stands in, added to each count, unit of the shares, terms reported of a
    group, postings of a cell."""

    least: int = 30
    smooth: int = 5
    unit: int = 1_000_000_000
    top: int = 50
    cell: int = 250_000


#: Counted terms a task holds before it sends them on, and text bytes cut into terms at once.
HELD_TERMS, PIECE_BYTES = 250_000, 4 << 20
COUNTED = "lang string, source string, term string, n long, docs long"


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text in pieces, cut between terms."""
    at = 0
    while len(text) - at > PIECE_BYTES:
        cut = _BETWEEN.search(text, at + PIECE_BYTES)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:] if at else text


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of every term of each group in a partition, in a few instalments."""
    times: dict[tuple, Counter] = defaultdict(Counter)
    docs: dict[tuple, Counter] = defaultdict(Counter)

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in times.items():
            terms = pa.array(counts, pa.binary()).cast(pa.string())
            some = docs[lang, source]
            columns = [pa.repeat(pa.scalar(lang, pa.string()), len(counts)), pa.repeat(pa.scalar(source, pa.string()), len(counts)), terms]
            columns += [pa.array(counts.values(), pa.int64()), pa.array([some[t] for t in counts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])
        times.clear()
        docs.clear()

    held = 0
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts, strict=True):
            counts, seen = times[lang, source], set()
            before = len(counts)
            for piece in _pieces(text.as_py().lower()):
                found = _TERM.findall(piece)
                counts.update(found)
                seen.update(found)
            docs[lang, source].update(seen)
            held += len(counts) - before
            if held > HELD_TERMS:
                yield from flush()
                held = 0
    yield from flush()


def term_counts(docs: DataFrame, audit: Audit = Audit()) -> DataFrame:
    """(lang, source, term, n, lang_n, first) of the kept terms: occurrences in the source and in the
    language; `first` marks one row of each term of a language."""
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    # Dealt by term and language once: sums per source, and over a language's sources, need no other shuffle.
    parts = rows.mapInArrow(_counted, COUNTED).repartition("lang", "term")
    sums = parts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    sums = sums.withColumns(
        {
            "first": F.row_number().over(term.orderBy("source")) == 1,
            "lang_n": F.sum("n").over(term),
            "lang_docs": F.sum("docs").over(term),
        }
    )
    return sums.where(F.col("lang_docs") >= audit.least).select("lang", "source", "term", "n", "lang_n", "first")


def share(count: Column | str, total: str, terms: str, audit: Audit) -> Column:
    """The smoothed share of a term, by whole numbers of any size; null where no term is kept."""
    count = F.col(count) if isinstance(count, str) else count
    above = F.lit(audit.unit).cast("decimal(10,0)") * (count + audit.smooth).cast("decimal(20,0)")
    below = (F.col(total) + audit.smooth * F.col(terms)).cast("decimal(20,0)")
    return 1 + F.call_function("div", above, F.nullif(below, F.lit(0).cast("decimal(20,0)")))


def groups_of(docs: DataFrame, counts: DataFrame, audit: Audit) -> DataFrame:
    """Every occurring group with its place among its language's sources, its sizes and z."""
    pair = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    sizes = counts.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    langs = counts.where("first").groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_size"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    known = docs.select(*pair).distinct().withColumn("place", place).join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    filled = known.fillna(0, ["size", "terms", "lang_size"])
    return filled.withColumn("z", F.coalesce(share(F.lit(0), "size", "terms", audit), F.lit(0)))


def accumulate(place: np.ndarray, p: np.ndarray, first: np.ndarray, z: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """R(a, b) of every source a over all its peers b, for the terms of one cell.

    `place` and `p` are the postings, term after term and by source within a term; `first` has the first
    posting of each term, end included; `z` the share of an absent term in each source.
    """
    end = np.repeat(first[1:], np.diff(first))  # of each posting's term
    order = np.argsort(place, kind="stable")
    cuts = np.searchsorted(place[order], np.arange(len(z) + 1))
    for a in range(len(z)):
        mine = order[cuts[a] : cuts[a + 1]]
        if not len(mine):
            continue
        shares = np.sort(p[mine])
        sums = np.concatenate(([0], np.cumsum(shares)))
        below = np.searchsorted(shares, z)
        row = z * below - sums[below] + (sums[-1] - sums[below]) - z * (len(mine) - below)
        row -= len(mine) * np.abs(z[a] - z)
        later = end[mine] - mine - 1
        peers = np.arange(later.sum()) - np.repeat(np.cumsum(later) - later, later) + np.repeat(mine + 1, later)
        b, theirs, own = place[peers], p[peers], np.repeat(p[mine], later)
        gain = np.abs(own - theirs) - np.abs(own - z[b]) - np.abs(z[a] - theirs) + np.abs(z[a] - z[b])
        np.add.at(row, b, gain)
        yield a, row


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of a cell: first come all groups, then the cell's postings by language and term."""
    zs: dict[str, list[int]] = defaultdict(list)
    waiting: list[pa.RecordBatch] = []
    whole = False  # whether this is the cell that also speaks for groups without postings

    def done() -> Iterator[pa.RecordBatch]:
        if not waiting:
            return
        rows = pa.Table.from_batches(waiting).combine_chunks()
        waiting.clear()
        lang, term = rows.column("lang")[0].as_py(), rows.column("term").combine_chunks()
        change = np.flatnonzero(pc.not_equal(term[1:], term[:-1]).to_numpy(zero_copy_only=False)) + 1
        first = np.concatenate(([0], change, [len(term)]))
        z = np.array(zs[lang], np.int64)
        found = dict(accumulate(rows.column("place").to_numpy().astype(np.int64), rows.column("value").to_numpy(), first, z))
        yield from sent(lang, found)

    def sent(lang: str, found: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for a, row in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang]), pa.array([a], pa.int32()), pa.array([row], pa.list_(pa.int64()))], ["lang", "place", "sums"]
            )

    for batch in batches:
        posts = batch.column("term").is_valid().to_numpy(zero_copy_only=False)
        mine = int(len(posts) - posts.sum())
        for lang, z in zip(batch.column("lang").slice(0, mine).to_pylist(), batch.column("value").slice(0, mine).to_pylist(), strict=True):
            zs[lang].append(z)
        whole = whole or bool(batch.num_rows and batch.column("cell")[0].as_py() == 0)
        rest = batch.slice(mine)
        langs = rest.column("lang")
        change = np.flatnonzero(pc.not_equal(langs[1:], langs[:-1]).to_numpy(zero_copy_only=False)) + 1 if rest.num_rows else []
        for low, high in zip([0, *change], [*change, rest.num_rows], strict=True):
            piece = rest.slice(low, high - low)
            if waiting and piece.num_rows and waiting[0].column("lang")[0] != piece.column("lang")[0]:
                yield from done()
            if piece.num_rows:
                waiting.append(piece)
    yield from done()
    if whole:
        for lang, z in zs.items():
            nothing = np.zeros(len(z), np.int64)
            yield from sent(lang, dict.fromkeys(range(len(z)), nothing))


def row_sums(postings: DataFrame, groups: DataFrame, cells: int) -> DataFrame:
    """(lang, place, sums): for each source and cell the dense row R; every group has at least one row."""
    cell = F.pmod(F.xxhash64("lang", "term"), F.lit(cells)).cast("int")
    spoken = groups.select(
        F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("cell"), "lang", F.lit(None).cast("string").alias("term"), "place", F.col("z").alias("value")
    )
    posted = postings.select(cell.alias("cell"), "lang", "term", "place", F.col("p").alias("value"))
    dealt = spoken.unionByName(posted).repartitionById(cells, "cell")
    ordered = dealt.sortWithinPartitions(F.col("term").isNotNull(), "lang", "term", "place")
    return ordered.mapInArrow(_rows, "lang string, place int, sums array<long>")


def audit(spark: SparkSession, docs: DataFrame, spec: Audit = Audit()) -> DataFrame:
    """lang, source, part, item, value, rank: of each group its peers by divergence (`pair`), and its first
    terms above the language's share (`term`)."""
    counts = written(spark, term_counts(docs, spec), "term-counts")
    groups = written(spark, groups_of(docs, counts, spec), "groups")
    shares = counts.join(groups, ["lang", "source"]).select(
        "lang", "source", "place", "term", share("n", "size", "terms", spec).alias("p"), share("lang_n", "lang_size", "terms", spec).alias("q")
    )

    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    over = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = over.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= spec.top)

    cells = max(1, -(-counts.count() // spec.cell))
    rows = row_sums(shares, groups, cells).select("lang", "place", F.posexplode("sums").alias("peer", "sum"))
    low, high = F.least("place", "peer").alias("low"), F.greatest("place", "peer").alias("high")
    sums = rows.where("place <> peer").groupBy("lang", low, high).agg(F.sum("sum").alias("sum"))
    one, two = (
        groups.select("lang", F.col("place").alias(name), F.col("source").alias(f"{name}_source"), F.col("z").alias(f"{name}_z"), F.col("terms").alias(f"{name}_terms"))
        for name in ("low", "high")
    )
    both = sums.join(one, ["lang", "low"]).join(two, ["lang", "high"])
    value = F.col("sum") + F.col("low_terms") * F.abs(F.col("low_z") - F.col("high_z"))
    ways = F.array(*(F.struct(F.col(f"{a}_source").alias("source"), F.col(f"{b}_source").alias("item")) for a, b in (("low", "high"), ("high", "low"))))
    pairs = both.select("lang", value.alias("value"), F.explode(ways).alias("way")).select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value")
    pairs = pairs.withColumn("rank", F.row_number().over(ranked))
    return pairs.unionByName(terms)
