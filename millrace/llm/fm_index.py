"""Substring dedup: a compressed FM-index per shard, searched backward by streamed fragments.

A window is a run of words. Words covered by a window that also starts in a document with a smaller
id are removed. Every window belongs to one anchor, the least hash among its word k-grams, so equal
windows have equal anchors. Neighbouring windows with the same anchor place make a fragment.

1. `spans`: the anchors of all texts, packed into buckets by their hash, show which occur in more
   than one document. Anchors that a block of texts already shows twice are sent once per block.
2. `fragments`: the words of the fragments of such anchors, distinct ones with their first document.
3. `firsts`: shards of whole anchors. Each shard's distinct fragments are laid end to end, a wavelet
   matrix holds their Burrows-Wheeler transform, and all windows are searched backward at once. A
   window's interval of suffixes gives its first document. An interval of one suffix is unique to
   its fragment and leaves the search early (its match is below the threshold elsewhere).
4. The windows found go back to the documents, which are written without the covered words.

An anchor with more than `most` distinct fragments is dealt out by single windows instead, so that
no shard outgrows a task.

Defined cases: a null text has no words; a row with a null id keeps all words and removes nothing
elsewhere; rows with the same id do not remove each other's words; repeated rows give repeated rows;
an empty table gives an empty result. Only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.tables import spread, written
from millrace.llm.words import SPACE, mixed, span_hashes, text_blocks, windows, word_spans


@dataclass(frozen=True)
class Repeat:
    """Words of a window, words of an anchor, distinct fragments an anchor may have in one shard."""

    window: int = 13
    gram: int = 5
    most: int = 20_000


#: Text bytes whose anchors make one bucket, documents whose spans are gathered together, and symbols
#: of one shard's index.
BUCKET_BYTES, GROUP_DOCS, SHARD_SYMBOLS = 128 << 20, 512, 1 << 20


class WaveletMatrix:
    """Symbols in bit planes with rank directories: occurrences before a place in O(bits)."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.n = len(symbols)
        self.planes, self.directory, self.zeros, self.shifts = [], [], [], []
        for shift in range(max(1, int(size - 1).bit_length()) - 1, -1, -1):
            bits = (symbols >> shift) & 1
            words = np.packbits(np.concatenate((bits, np.zeros(-self.n % 64 + 64, bits.dtype))).astype(np.uint8), bitorder="little")
            words = words.view(np.uint64)
            counts = np.bitwise_count(words).astype(np.int32)
            self.planes.append(words)
            self.directory.append(np.concatenate((np.zeros(1, np.int32), np.cumsum(counts, dtype=np.int32)[:-1])))
            self.zeros.append(self.n - int(bits.sum()))
            self.shifts.append(shift)
            symbols = np.concatenate((symbols[bits == 0], symbols[bits == 1]))

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Occurrences of `symbol` before `place`, plus where the symbol's run starts in the last plane."""
        for words, directory, zeros, shift in zip(self.planes, self.directory, self.zeros, self.shifts, strict=True):
            block = place >> 6
            below = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
            ones = directory[block] + np.bitwise_count(words[block] & below)
            place = np.where((symbol >> shift) & 1 == 1, zeros + ones, place - ones)
        return place


class FMIndex:
    """Suffixes of a text of symbols, sorted by their first `depth` symbols, and their backward search."""

    def __init__(self, text: np.ndarray, size: int, depth: int):
        self.size = size
        rank, length = text.astype(np.int64), 1
        n = len(text)
        while length < depth:
            after = np.zeros(n, np.int64)
            after[: n - length] = rank[length:] + 1
            key = rank * (int(rank.max()) + 2 if n else 1) + after
            order = np.argsort(key, kind="stable")
            fresh = np.concatenate(([0], np.cumsum(key[order[1:]] != key[order[:-1]])))
            rank = np.empty(n, np.int64)
            rank[order] = fresh
            length *= 2
            if n and fresh[-1] == n - 1:
                break
        self.suffixes = np.argsort(rank, kind="stable")
        before = text[self.suffixes - 1]  # the text is a ring; its last symbol is a separator
        self.wavelet = WaveletMatrix(before, size)
        self.base = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=size))))
        self.start = self.wavelet.rank(np.arange(size), np.zeros(size, np.int64))

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that begin with `symbol` and go on as those of each interval."""
        base = self.base[symbol] - self.start[symbol]
        return base + self.wavelet.rank(symbol, low), base + self.wavelet.rank(symbol, high)


def least_of_ranges(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least value of every non-empty range, from a sparse table."""
    out = np.empty(len(low), values.dtype)
    level = np.frexp((high - low).astype(np.float64))[1] - 1
    table = values
    for k in range(int(level.max()) + 1 if len(level) else 0):
        now = level == k
        out[now] = np.minimum(table[low[now]], table[high[now] - (1 << k)])
        if len(table) > 1 << k:
            table = np.minimum(table[: -(1 << k)], table[1 << k :])
    return out


def first_documents(texts: list[str], docs: np.ndarray, window: int) -> list[np.ndarray]:
    """For every window of every fragment, the smallest document among all fragments that hold it."""
    words = [t.split(" ") for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    known: dict[str, int] = {}
    flat = np.array([known.setdefault(x, len(known) + 1) for w in words for x in w], np.int64)
    of = np.repeat(np.arange(len(words)), sizes)
    text = np.insert(flat, np.cumsum(sizes), 0)
    owner = np.insert(of, np.cumsum(sizes), np.arange(len(words)))
    index = FMIndex(text, len(known) + 1, window)
    by_suffix = docs[owner[index.suffixes]]

    count = np.maximum(sizes - window + 1, 0)
    start = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    of_window = np.repeat(np.arange(len(words)), count)
    at = np.arange(count.sum()) - np.repeat(np.concatenate(([0], np.cumsum(count)[:-1])), count)
    at = at + start[of_window] + window - 1  # last word of each window
    first = docs[of_window].copy()
    live = np.arange(len(at))
    last = text[at]
    low, high = index.base[last], index.base[last + 1]
    for back in range(1, window):
        more = high - low > 1
        live, low, high = live[more], low[more], high[more]
        if not len(live):
            break
        low, high = index.step(text[at[live] - back], low, high)
    if len(live):
        first[live] = least_of_ranges(by_suffix, low, high)
    return np.split(first, np.cumsum(count)[:-1])


def anchored(hashes: np.ndarray, words: np.ndarray, spec: Repeat) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, anchor hash, first window (in words of the block) and number of windows of every fragment."""
    grams = windows(hashes, spec.gram)
    reach = spec.window - spec.gram + 1
    n = len(hashes) - spec.window + 1
    if n <= 0:
        empty = np.zeros(0, np.int64)
        return empty, grams[:0], empty, empty
    least, place = grams[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, reach):
        better = grams[j : j + n] < least
        least[better] = grams[j : j + n][better]
        place[better] = j
    size = np.diff(words)
    of = np.repeat(np.arange(len(size)), size)[:n]
    ahead = np.arange(n)
    ok = np.flatnonzero(ahead + spec.window <= words[1:][of])
    place = place[ok] + ok
    cut = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (of[ok[1:]] != of[ok[:-1]])))) if len(ok) else ok
    return of[ok[cut]], least[ok[cut]], ok[cut], np.diff(np.concatenate((cut, [len(ok)])))


_ENTRY = np.dtype([("anchor", np.uint64), ("doc", np.int64), ("part", np.int64), ("at", np.uint32), ("n", np.uint8), ("seen", np.bool_)])


def _packed(spec: Repeat, buckets: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, raw, first in text_blocks(batch):
                starts, ends, words = word_spans(raw, first)
                of, anchor, at, n = anchored(span_hashes(raw, starts, ends), words, spec)
                if not len(of):
                    continue
                entries = np.zeros(len(of), _ENTRY)
                ids = rows.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                entries["doc"], entries["anchor"], entries["n"] = ids[of], anchor, n
                entries["part"] = rows.column(1).to_numpy(zero_copy_only=False).astype(np.int64)[of]
                entries["at"] = at - words[of]
                order = np.lexsort((entries["doc"], anchor))
                entries = entries[order]
                new = np.concatenate(([True], entries["anchor"][1:] != entries["anchor"][:-1]))
                other = np.concatenate(([False], ~new[1:] & (entries["doc"][1:] != entries["doc"][:-1])))
                group = np.cumsum(new) - 1
                entries["seen"] = np.bincount(group, other)[group] > 0
                # An anchor that this block has shown to be repeated is settled here: its fragments
                # go anywhere, and only one of them tells its bucket that the anchor is in use.
                where = (mixed(entries["anchor"]) % np.uint64(buckets)).astype(np.int64)
                settled = entries["seen"] & ~new
                where[settled] = (entries["doc"][settled] + np.arange(int(settled.sum()))) % buckets
                order = np.argsort(where, kind="stable")
                cuts = np.flatnonzero(np.concatenate(([True], np.diff(where[order]) > 0, [True])))
                entries, where = entries[order], where[order]
                blobs = [entries[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([pa.array(where[cuts[:-1]]), pa.array(blobs, pa.binary())], names=["bucket", "entries"])

    return run


_SPAN = np.dtype([("anchor", np.uint64), ("at", np.uint32), ("n", np.uint8)])


def _repeated(groups: int) -> Callable[[pa.Table], pa.Table]:
    """Of a bucket: the entries whose anchor stands in several documents, packed by group of documents."""

    def run(table: pa.Table) -> pa.Table:
        entries = np.concatenate([np.frombuffer(b.as_py(), _ENTRY) for b in table.column("entries").combine_chunks()])
        entries = entries[np.lexsort((entries["doc"], entries["anchor"]))]
        new = np.concatenate(([True], entries["anchor"][1:] != entries["anchor"][:-1]))
        other = np.concatenate(([False], ~new[1:] & (entries["doc"][1:] != entries["doc"][:-1])))
        anchor = np.cumsum(new) - 1
        entries = entries[np.bincount(anchor, other | entries["seen"])[anchor] > 0]
        group = (mixed(entries["doc"].view(np.uint64)) % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        entries, group = entries[order], group[order]
        cuts = np.flatnonzero(np.concatenate(([True], np.diff(group) > 0, [True]))) if len(group) else np.zeros(1, np.int64)
        blobs = [entries[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
        return pa.table({"group": pa.array(group[cuts[:-1]]), "entries": pa.array(blobs, pa.binary())})

    return run


def _by_document(table: pa.Table) -> pa.Table:
    """Of a group of documents: one row for each with all its spans."""
    entries = np.concatenate([np.frombuffer(b.as_py(), _ENTRY) for b in table.column("entries").combine_chunks()])
    entries = entries[np.lexsort((entries["at"], entries["part"], entries["doc"]))]
    spans = np.zeros(len(entries), _SPAN)
    for name in _SPAN.names:
        spans[name] = entries[name]
    changed = (np.diff(entries["doc"]) != 0) | (np.diff(entries["part"]) != 0)
    cuts = np.flatnonzero(np.concatenate(([True], changed, [True])))
    blobs = [spans[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
    return pa.table({
        "doc_id": pa.array(entries["doc"][cuts[:-1]]),
        "part": pa.array(entries["part"][cuts[:-1]]),
        "spans": pa.array(blobs, pa.binary()),
    })


def _fragment_key(text: bytes) -> bytes:
    return xxhash.xxh3_128_digest(text)


def _cut(spec: Repeat) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (doc_id, part, text, spans) -> a row for each fragment; its words are sent once for each
    batch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sent: set[bytes] = set()
            for rows, raw, first in text_blocks(batch):
                starts, ends, words = word_spans(raw, first)
                plain, offset = joined_words(raw, starts, ends)
                out: list[list] = [[], [], [], [], [], []]
                lists = rows.column(3).to_pylist()
                ids, parts = rows.column(0).to_pylist(), rows.column(1).to_pylist()
                for i, (low, blob) in enumerate(zip(words[:-1].tolist(), lists, strict=True)):
                    spans = np.frombuffer(blob, _SPAN)
                    begin = offset[low + spans["at"]]
                    end = offset[low + spans["at"] + spans["n"] + spec.window - 1] - 1
                    for a, b, at, anchor in zip(begin.tolist(), end.tolist(), spans["at"].tolist(), spans["anchor"].view(np.int64).tolist(), strict=True):
                        text = plain[a:b]
                        key = _fragment_key(text)
                        for column, value in zip(out, (anchor, key, ids[i], parts[i], at, None if key in sent else text), strict=True):
                            column.append(value)
                        sent.add(key)
                kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
                arrays = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
                arrays[5] = arrays[5].cast(pa.string())
                yield pa.RecordBatch.from_arrays(arrays, names=["anchor", "fragment", "doc_id", "part", "at", "words"])

    return run


def joined_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The words of a block with one space after each, and where each begins (end included)."""
    keep = ~SPACE[raw]
    size = ends - starts
    offset = np.concatenate(([0], np.cumsum(size + 1)))
    plain = np.full(int(offset[-1]), 32, np.uint8)
    inside = np.ones(len(plain), bool)
    inside[offset[1:] - 1] = False
    plain[inside] = raw[keep]
    return plain.tobytes(), offset


def _singled(spec: Repeat) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Fragments cut into their single windows, each an anchor of its own."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                words = row["words"].split(" ")
                for i in range(len(words) - spec.window + 1):
                    text = " ".join(words[i : i + spec.window])
                    key = _fragment_key(text.encode())
                    anchor = int.from_bytes(key[:8], "little", signed=True)
                    out.append({"anchor": anchor, "fragment": key, "doc_id": row["doc_id"], "part": row["part"], "at": row["at"] + i, "words": text})
            yield pa.RecordBatch.from_pylist(out, schema=batch.schema)

    return run


def _searched(spec: Repeat) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (anchor, fragment, first, words) sorted by anchor -> (fragment, firsts), shard by shard."""

    def shard(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        docs = table.column("first").to_numpy()
        texts = table.column("words").to_pylist()
        _, group, sizes = np.unique(table.column("anchor").to_numpy(), return_inverse=True, return_counts=True)
        # A fragment that is the only one of its anchor shares its windows with no other.
        firsts = [np.full(t.count(" ") + 2 - spec.window, d) for t, d in zip(texts, docs.tolist(), strict=True)]
        several = np.flatnonzero(sizes[group] > 1)
        if len(several):
            found = first_documents([texts[i] for i in several], docs[several], spec.window)
            for i, f in zip(several.tolist(), found, strict=True):
                firsts[i] = f
        lists = pa.array([f.tolist() for f in firsts], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([table.column("fragment").combine_chunks(), lists], names=["fragment", "firsts"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, symbols = [], 0
        for batch in batches:
            while len(batch):
                text, first = batch.column(3), 0
                if symbols >= SHARD_SYMBOLS:  # only cut where the anchor changes
                    last = held[-1].column(0)[len(held[-1]) - 1].as_py()
                    others = np.flatnonzero(batch.column(0).to_numpy() != last)
                    first = int(others[0]) if len(others) else len(batch)
                    if first:
                        held.append(batch.slice(0, first))
                    if first < len(batch):
                        yield shard(held)
                        held, symbols = [], 0
                    batch = batch.slice(first)
                    continue
                take = min(len(batch), 4096)
                held.append(batch.slice(0, take))
                symbols += sum(len(t) for t in text.slice(0, take).to_pylist()) // 6
                batch = batch.slice(take)
        if held:
            yield shard(held)

    return run


def _without(spec: Repeat) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (doc_id, part, text, list of runs of windows) -> n_words, n_removed and the text kept."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, raw, first in text_blocks(batch):
                starts, ends, words = word_spans(raw, first)
                plain, offset = joined_words(raw, starts, ends)
                kept, n_removed = [], []
                for low, high, places in zip(words[:-1].tolist(), words[1:].tolist(), rows.column(3).to_pylist(), strict=True):
                    edge = np.zeros(high - low + 1, np.int64)
                    at = np.array([p for run in places or () for p in run], np.int64)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + spec.window, -1)
                    stay = np.cumsum(edge[:-1]) == 0
                    n_removed.append(int((~stay).sum()))
                    flips = np.flatnonzero(np.diff(np.concatenate(([0], stay.astype(np.int8), [0])))) + low
                    pieces = [plain[offset[a] : offset[b] - 1] for a, b in zip(flips[::2], flips[1::2], strict=True)]
                    kept.append(b" ".join(pieces))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(rows.column(i) for i in (0, 1)),
                        pa.array(np.diff(words), pa.int64()),
                        pa.array(n_removed, pa.int64()),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "part", "n_words", "n_removed", "kept_text"],
                )

    return run


def keyed(docs: DataFrame) -> tuple[DataFrame, int, int]:
    """`doc_id`, `part`, `text`, the bytes of all texts and the number of ids. `part` tells rows with the same id apart;
    it is 0 throughout where no id repeats."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids = rows.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    most, size, count = ids.agg(F.max("n"), F.sum("bytes"), F.count("*")).first()
    part = F.xxhash64("text") if (most or 0) > 1 else F.lit(0).cast("long")
    return rows.select("doc_id", part.alias("part"), "text"), size or 0, count


def removable(spark: SparkSession, rows: DataFrame, size: int, count: int, spec: Repeat = Repeat()) -> DataFrame:
    """`doc_id`, `part`, `windows`: the places of windows that a smaller document holds too."""
    buckets = max(spread(spark), -(-size // BUCKET_BYTES))
    known = rows.where("doc_id IS NOT NULL AND text IS NOT NULL")
    packed = known.mapInArrow(_packed(spec, buckets), "bucket long, entries binary")
    groups = max(spread(spark), -(-count // GROUP_DOCS))
    found = packed.groupBy("bucket").applyInArrow(_repeated(groups), "group long, entries binary")
    spans = found.groupBy("group").applyInArrow(_by_document, "doc_id long, part long, spans binary")
    texts = known.join(written(spark, spans, "spans"), ["doc_id", "part"]).select("doc_id", "part", "text", "spans")
    shape = "anchor long, fragment binary, doc_id long, part long, at int, words string"
    places = written(spark, texts.mapInArrow(_cut(spec), shape), "fragments")

    def distinct(rows: DataFrame) -> DataFrame:
        return rows.groupBy("anchor", "fragment").agg(F.min("doc_id").alias("first"), F.max("words").alias("words"))

    fragments = written(spark, distinct(places), "distinct")
    hot = written(spark, fragments.groupBy("anchor").count().where(F.col("count") > spec.most).select("anchor"), "hot")
    places = places.select("anchor", "fragment", "doc_id", "part", "at")
    if not hot.isEmpty():
        words = fragments.join(hot, "anchor", "left_semi").select("fragment", "words")
        crowded = places.join(hot, "anchor", "left_semi").join(words, "fragment").select(*places.columns, "words")
        single = written(spark, crowded.mapInArrow(_singled(spec), shape), "windows")
        fragments = fragments.join(hot, "anchor", "left_anti").unionByName(distinct(single))
        places = places.join(hot, "anchor", "left_anti").unionByName(single.select(*places.columns))
    shards = fragments.repartition(spread(spark), "anchor").sortWithinPartitions("anchor")
    searched = shards.select("anchor", "fragment", "first", "words").mapInArrow(_searched(spec), "fragment binary, firsts array<long>")
    searched = written(spark, searched, "firsts")
    hits = places.join(searched, "fragment").withColumn(
        "windows", F.expr("transform(filter(sequence(0, size(firsts) - 1), i -> firsts[i] < doc_id), i -> at + i)")
    )
    return hits.where(F.size("windows") > 0).groupBy("doc_id", "part").agg(F.collect_list("windows").alias("windows"))


def without_repeats(spark: SparkSession, docs: DataFrame, spec: Repeat = Repeat()) -> DataFrame:
    """`doc_id`, `n_words`, `n_removed`, `kept_text` of every document."""
    rows, size, count = keyed(docs)
    found = written(spark, removable(spark, rows, size, count, spec), "removable")
    joined = rows.join(found, ["doc_id", "part"], "left").select("doc_id", "part", "text", "windows")
    shape = "doc_id long, part long, n_words long, n_removed long, kept_text string"
    return joined.mapInArrow(_without(spec), shape).drop("part")

