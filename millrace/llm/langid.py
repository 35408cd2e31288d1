"""Language identification by interpolated Kneser-Ney models over characters.

Texts are lowered; runs of characters that are no letters count as one space, and every text begins
with spaces. One pass counts the n-grams of the highest order in all training texts. The lower orders
follow from the distinct n-grams, as Kneser-Ney has it, and every table of the model (continuation counts,
discounts, probabilities, back-off weights) is made by Spark over all n-grams: none is left out, however many
there are. The language with the least cross-entropy per character wins; its score is a softmax of the
entropies with a fitted temperature, and a text whose entropy is beyond what training texts of that language
reach is marked as not accepted.

For scoring, the tables become sorted arrays of hashed n-grams. Everything that an n-gram `abcd` needs, from
its own probability down to that of `cd`, hangs on the characters `b` and `c`, so the model is cut along
(c, b) into parts of about `part` entries; single characters are in every part. One part is broadcast if
that is all. Otherwise the texts are scored once with each part, every n-gram by the part that has it, and the
bits are added up per text.

Defined cases: a null text, or one without a letter, is `und` with score 0, as is every text if
nothing was learned; rows with a null language are not learned from; a null id counts as empty
text in the fold; ties go to the language first in code point order; repeated rows give repeated
rows; an empty table gives an empty result. Only id, text and language are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.tables import fold, written
from millrace.llm.words import mixed, text_blocks

ORDER = 4
#: Entries of one part of the model, 14 bytes each in a task: bounds what is collected and broadcast at once.
PART_ENTRIES = 2_000_000
#: Temperatures that training tries.
TEMPERATURES = [2.0**k for k in range(-4, 7)]
UNKNOWN = "und"
_SHIFT = np.uint64(21)  # bits of a code point


def _letter_table() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def characters(texts: pa.Array, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised code points of all texts, each text after ORDER - 1 spaces, and the first one of each text, end
    included."""
    low = pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))
    size = pc.utf8_length(low).to_numpy(zero_copy_only=False).astype(np.int64)
    codes = np.frombuffer("".join(low.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.concatenate(([0], np.cumsum(size)))
    letter = letters[codes]
    begin = np.zeros(len(codes) + 1, bool)
    begin[first] = True
    before = np.concatenate(([False], letter[:-1])) & ~begin[:-1] if len(codes) else letter
    keep = letter | before
    values = np.where(letter, codes, np.uint32(0x20))[keep]
    kept = np.concatenate(([0], np.cumsum(keep)))[first]
    pad = ORDER - 1
    out = np.full(len(values) + pad * len(size), 0x20, np.uint32)
    where = np.arange(len(values)) + np.repeat(pad * np.arange(1, len(size) + 1), np.diff(kept))
    out[where] = values
    return out, kept + pad * np.arange(len(kept))


def hashed(codes: np.ndarray) -> np.ndarray:
    """64-bit names of n-grams, the rows of a table of code points."""
    out = np.full(len(codes), codes.shape[1], np.uint64)
    for column in codes.T:
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + column)
    return out


def grams(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last character's place of every n-gram of the highest order, and each text's first n-gram, end included."""
    size = np.maximum(np.diff(first) - (ORDER - 1), 0)
    inside = np.concatenate(([0], np.cumsum(size)))
    return np.repeat(first[:-1] + ORDER - 1, size) + np.arange(inside[-1]) - np.repeat(inside[:-1], size), inside


def distinct(values: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams as rows of code points, which of them each one is, and their names."""
    table = np.stack([values[ends - i] for i in range(ORDER - 1, -1, -1)], axis=1)
    names, at, back = np.unique(hashed(table), return_index=True, return_inverse=True)
    return table[at], back, names


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of a partition, merged by language in between."""
    letters = _letter_table()
    held: dict[str, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}

    def merged(lang: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        names, at, back = np.unique(np.concatenate([h[0] for h in held[lang]]), return_index=True, return_inverse=True)
        n = np.bincount(back, np.concatenate([h[2] for h in held[lang]])).astype(np.int64)
        return names, np.concatenate([h[1] for h in held[lang]])[at], n

    def out(lang: str) -> pa.RecordBatch:
        _, codes, n = merged(lang)
        texts = np.ascontiguousarray(codes).view(f"<U{ORDER}").ravel()
        columns = [pa.repeat(pa.scalar(lang, pa.string()), len(n)), pa.array(texts, pa.string()), pa.array(n)]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])

    for batch in batches:
        for part, _, _ in text_blocks(batch):
            langs = np.array(part.column(1).to_pylist(), object)
            for lang in sorted(set(langs)):
                values, first = characters(part.column(0).filter(pa.array(langs == lang)), letters)
                codes, back, names = distinct(values, grams(values, first)[0])
                held.setdefault(lang, []).append((names, codes, np.bincount(back, minlength=len(names))))
                if sum(len(h[0]) for h in held[lang]) > 1_000_000:
                    held[lang] = [merged(lang)]
                    if len(held[lang][0][0]) > 500_000:
                        yield out(lang)
                        del held[lang]
    for lang in held:
        yield out(lang)


def counted(rows: DataFrame) -> DataFrame:
    """(lang, gram, n): the n-grams of the highest order of all rows (`text`, `lang`)."""
    parts = rows.select("text", "lang").mapInArrow(_counted, "lang string, gram string, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def tables(spark: SparkSession, counts: DataFrame) -> DataFrame:
    """(back, size, lang, gram, value) of the whole model: log2 probabilities of n-grams of each size, and with
    `back` the log2 weights that contexts of each size leave to the order below."""
    levels = {ORDER: written(spark, counts, "grams")}
    for k in range(ORDER - 1, 0, -1):  # one for each distinct left neighbour
        shorter = levels[k + 1].groupBy("lang", F.substring("gram", 2, k).alias("gram"))
        levels[k] = written(spark, shorter.agg(F.count(F.lit(1)).alias("n")), f"grams-{k}")
    alphabet = levels[1].agg(F.count_distinct("gram")).first()[0] + 1
    out = []
    below: DataFrame | None = None
    for k in range(1, ORDER + 1):
        once, twice = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
        discount = F.when((once > 0) & (twice > 0), once / (once + 2 * twice)).otherwise(0.5)
        discounts = levels[k].groupBy("lang").agg(discount.alias("discount"))  # a row per language
        context = Window.partitionBy("lang", "context")
        rows = levels[k].withColumn("context", F.substring("gram", 1, k - 1)).join(discounts, "lang")
        rows = rows.withColumns({"total": F.sum("n").over(context), "kinds": F.count(F.lit(1)).over(context)})
        rest = F.col("discount") * F.col("kinds") / F.col("total")
        rows = rows.withColumns({"rest": rest, "direct": F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total")})
        if k == 1:
            lower = F.lit(1.0 / alphabet)
        else:
            rows = rows.withColumn("suffix", F.substring("gram", 2, k - 1)).join(below, ["lang", "suffix"])
            lower = F.col("lower")
        rows = written(spark, rows.select("lang", "gram", "context", "rest", (F.col("direct") + F.col("rest") * lower).alias("p")), f"order-{k}")
        below = rows.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("lower"))
        out.append(rows.select(F.lit(False).alias("back"), F.lit(k).alias("size"), "lang", "gram", F.log2("p").alias("value")))
        weights = rows.groupBy("lang", "context").agg(F.max("rest").alias("rest"))
        left = F.log2(F.col("rest") / alphabet) if k == 1 else F.log2("rest")  # of a character never seen
        out.append(weights.select(F.lit(True).alias("back"), F.lit(k - 1).alias("size"), "lang", F.col("context").alias("gram"), left.alias("value")))
    whole = out[0]
    for rows in out[1:]:
        whole = whole.unionByName(rows)
    return whole


class HashArray:
    """Rows found by key: keys hashed and sorted, with a directory of their leading bits."""

    def __init__(self, keys: np.ndarray):
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.bits = max(1, int(len(keys)).bit_length())
        heads = (self.keys >> np.uint64(64 - self.bits)).astype(np.int64)
        self.begin = np.searchsorted(heads, np.arange((1 << self.bits) + 1)).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """First place of every key in `keys`, -1 if it is not there."""
        head = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.begin[head], self.begin[head + 1]
        out = np.full(len(keys), -1, np.int64)
        live = np.flatnonzero(at < end)
        while len(live):
            here = at[live]
            same = self.keys[here] == keys[live]
            out[live[same]] = here[same]
            live = live[~same]
            at[live] += 1
            live = live[at[live] < end[live]]
        return out


class Table:
    """n-grams (or contexts) of one size and what each language has under them."""

    def __init__(self, names: np.ndarray, langs: np.ndarray, values: np.ndarray):
        kinds, back = np.unique(names, return_inverse=True)
        order = np.argsort(back, kind="stable")
        self.index = HashArray(kinds)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(back, minlength=len(kinds)))))
        self.langs, self.values = langs[order], values[order].astype(np.float32)

    def entries(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the names have entries, for which language, and the values."""
        place = self.index.find(names)
        some = np.flatnonzero(place >= 0)
        low, high = self.first[place[some]], self.first[place[some] + 1]
        size = high - low
        at = np.repeat(low, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        return np.repeat(some, size), self.langs[at], self.values[at]


@dataclass
class Part:
    """The tables of one range of (c, b) by size: `seen` from 1 on, `back` of contexts from 1 on."""

    number: int
    cuts: np.ndarray
    seen: list[Table]
    back: list[Table]
    floor: np.ndarray

    def mine(self, codes: np.ndarray) -> np.ndarray:
        """Rows of n-grams that this part has the tables for."""
        return np.searchsorted(self.cuts, _range_key(codes), "right") == self.number

    def logs(self, codes: np.ndarray) -> np.ndarray:
        """log2 probability of the last character of every n-gram, a column for each language."""
        out = np.tile(self.floor, (len(codes), 1))
        for size in range(1, ORDER + 1):
            if size > 1:
                row, lang, weight = self.back[size - 2].entries(hashed(codes[:, ORDER - size : ORDER - 1]))
                out[row, lang] += weight
            row, lang, value = self.seen[size - 1].entries(hashed(codes[:, ORDER - size :]))
            out[row, lang] = value
        return out


def _range_key(codes: np.ndarray) -> np.ndarray:
    """The characters c and b of n-grams `abcd` as one number."""
    return (codes[:, ORDER - 2].astype(np.int64) << 21) | codes[:, ORDER - 3]


@dataclass
class Model:
    """Languages, the model's tables in Spark, and where they are cut; temperature and limits of acceptance."""

    langs: list[str]
    rows: DataFrame
    cuts: list[int]
    temperature: float = 1.0
    limits: tuple[float, ...] = ()
    shared: dict = field(default_factory=dict)

    def part(self, spark: SparkSession, number: int):
        """One part as a broadcast; a few entries over PART_ENTRIES at most."""
        if number not in self.shared:
            low = self.cuts[number - 1] if number else None
            high = self.cuts[number] if number < len(self.cuts) else None
            of = F.lit(True)
            if low is not None:
                of = of & (F.col("last") >= low)
            if high is not None:
                of = of & (F.col("first") < high)
            found = self.rows.where(of).select("back", "size", "lang", "name", "value").toArrow()
            back, size = (found.column(c).to_numpy(zero_copy_only=False) for c in ("back", "size"))
            lang, name, value = (found.column(c).to_numpy() for c in ("lang", "name", "value"))
            name = name.view(np.uint64)

            def table(held: bool, k: int) -> Table:
                some = (back == held) & (size == k)
                return Table(name[some], lang[some], value[some])

            floor = np.zeros(len(self.langs), np.float32)
            rest = (back == True) & (size == 0)  # noqa: E712
            floor[lang[rest]] = value[rest]
            made = Part(number, np.array(self.cuts, np.int64), [table(False, k) for k in range(1, ORDER + 1)], [table(True, k) for k in range(1, ORDER)], floor)
            self.shared[number] = spark.sparkContext.broadcast(made)
        return self.shared[number]


def _named(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Model rows with the names of their n-grams and the range of (c, b) they belong to."""
    for batch in batches:
        size = batch.column("size").to_numpy()
        back = batch.column("back").to_numpy(zero_copy_only=False)
        padded = np.array(batch.column("gram").to_pylist(), f"<U{ORDER}") if batch.num_rows else np.zeros(0, f"<U{ORDER}")
        codes = np.ascontiguousarray(padded).view(np.uint32).reshape(-1, ORDER)
        names = np.zeros(len(codes), np.uint64)
        first, last = np.full(len(codes), -1, np.int64), np.full(len(codes), 1 << 62, np.int64)
        for k in np.unique(size):
            rows = np.flatnonzero(size == k)
            names[rows] = hashed(codes[rows, :k]) if k else 0
            for context in (False, True):
                some = rows[back[rows] == context]
                c, b = (k - 1, k - 2) if context else (k - 2, k - 3)  # places of c and b in the n-gram
                if c >= 0:
                    first[some] = codes[some, c].astype(np.int64) << 21
                    last[some] = first[some] | ((1 << 21) - 1)
                    if b >= 0:
                        first[some] |= codes[some, b]
                        last[some] = first[some]
        columns = [batch.column("back"), batch.column("size"), batch.column("lang"), pa.array(names.view(np.int64)), batch.column("value"), pa.array(first), pa.array(last)]
        yield pa.RecordBatch.from_arrays(columns, ["back", "size", "lang", "name", "value", "first", "last"])


def fitted(spark: SparkSession, counts: DataFrame, part: int = PART_ENTRIES) -> Model | None:
    """A model from the counts of the highest order, cut into parts; None if there are no counts."""
    whole = tables(spark, counts)
    langs = [r[0] for r in whole.where("back AND size = 0").select("lang").distinct().orderBy("lang").collect()]
    if not langs:
        return None
    place = F.array_position(F.array(*map(F.lit, langs)), F.col("lang")) - 1
    rows = whole.select("back", "size", place.cast("int").alias("lang"), "gram", F.col("value").cast("float").alias("value"))
    shape = "back boolean, size int, lang int, name long, value float, first long, last long"
    rows = written(spark, rows.mapInArrow(_named, shape), "model")
    parts = -(-rows.count() // part)
    cuts: list[int] = []
    if parts > 1:
        steps = [i / parts for i in range(1, parts)]
        found = rows.where("first = last").agg(F.percentile_approx("first", F.array(*map(F.lit, steps)), F.lit(10 * parts))).first()[0]
        cuts = sorted(set(found or []))
    return Model(langs, rows, cuts)


def _sums(shared) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (row, text) -> the sum of bits under each language of the n-grams of one part, and the number of all."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: Part = shared.value
        letters = _letter_table()
        columns = len(part.floor)
        for batch in batches:
            for piece, _, _ in text_blocks(batch):
                values, first = characters(piece.column(piece.schema.get_field_index("text")), letters)
                ends, inside = grams(values, first)
                codes, back, _ = distinct(values, ends)
                logs = np.zeros((len(codes), columns), np.float32)
                mine = np.flatnonzero(part.mine(codes)) if len(part.cuts) else np.arange(len(codes))
                step = max(1, (8 << 20) // max(columns, 1))
                for low in range(0, len(mine), step):
                    logs[mine[low : low + step]] = part.logs(codes[mine[low : low + step]])
                bits = np.zeros((len(inside) - 1, columns))
                full = np.flatnonzero(np.diff(inside))
                if len(full):
                    for lang in range(columns):
                        bits[full, lang] = -np.add.reduceat(logs[back, lang].astype(np.float64), inside[:-1][full])
                lists = pa.FixedSizeListArray.from_arrays(pa.array(bits.ravel()), columns).cast(pa.list_(pa.float64()))
                rest = [piece.column(i) for i in range(piece.num_columns - 1)]
                names = piece.schema.names[:-1]
                yield pa.RecordBatch.from_arrays([*rest, lists, pa.array(np.diff(inside))], names=[*names, "bits", "chars"])

    return run


def entropies(spark: SparkSession, rows: DataFrame, model: Model) -> DataFrame:
    """Rows (others, `text` last) with, in place of the text, `bits` per character under each language and `chars`."""
    kept = rows.columns[:-1]
    ways = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    shape = f"{ways}, bits array<double>, chars long"
    if not model.cuts:
        summed = rows.mapInArrow(_sums(model.part(spark, 0)), shape)
    else:
        numbered = written(spark, rows.select(F.monotonically_increasing_id().alias("_row"), *kept, rows.columns[-1]), "numbered-texts")
        parts = [
            numbered.select("_row", *rows.columns).mapInArrow(_sums(model.part(spark, number)), f"_row long, {shape}")
            for number in range(len(model.cuts) + 1)
        ]
        union = parts[0]
        for more in parts[1:]:
            union = union.unionByName(more)
        places = range(len(model.langs))
        bits = F.array(*(F.sum(F.col("bits")[i]) for i in places)).alias("bits")
        first = [F.first(c).alias(c) for c in kept]
        summed = union.groupBy("_row").agg(*first, bits, F.first("chars").alias("chars")).drop("_row")
    return summed.withColumn("bits", F.transform("bits", lambda b: b / F.greatest(F.col("chars"), F.lit(1))))


def train(spark: SparkSession, rows: DataFrame, part: int = PART_ENTRIES) -> Model | None:
    """A model of all rows (`doc_id`, `text`, `lang`), or None if no text with a language has a letter."""
    known = learned(rows).select("lang", "text")
    model = fitted(spark, counted(known), part)
    if model is not None:
        calibrate(model, entropies(spark, known, model))
    return model


def learned(rows: DataFrame) -> DataFrame:
    return rows.where("lang IS NOT NULL AND text IS NOT NULL")


def calibrate(model: Model, scored: DataFrame) -> None:
    """Temperature of the highest likelihood over all training texts (`lang`, `bits`, `chars`); per language the
    entropy that its own texts hardly exceed. One aggregate, with a row for each language."""
    place = F.array_position(F.array(*map(F.lit, model.langs)), F.col("lang")).cast("int")
    rows = scored.where("chars > 0").withColumns({"place": place, "least": F.array_min("bits")}).where("place > 0")
    rows = rows.withColumn("own", F.element_at("bits", F.col("place")))

    def cost(t: float) -> Column:  # of the right language in bits, that is minus log2 of its score
        powers = F.transform("bits", lambda b: F.pow(F.lit(2.0), (F.col("least") - b) * t))
        return (F.col("own") - F.col("least")) * t + F.log2(F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))

    costs = [F.sum(cost(t)).alias(f"cost{i}") for i, t in enumerate(TEMPERATURES)]
    found = rows.groupBy("place").agg(F.count("own").alias("n"), F.avg("own").alias("mean"), F.stddev_pop("own").alias("std"), *costs).collect()
    limits = [float("inf")] * len(model.langs)
    for r in found:
        if r["n"] > 1:
            limits[r["place"] - 1] = r["mean"] + 6 * r["std"] + 0.5
    model.limits = tuple(limits)
    if found:
        totals = [math.fsum(r[f"cost{i}"] for r in found) for i in range(len(TEMPERATURES))]
        model.temperature = TEMPERATURES[totals.index(min(totals))]


def predict(spark: SparkSession, rows: DataFrame, model: Model | None) -> DataFrame:
    """`doc_id`, `lang_pred`, `score`, `bits_per_char`, `accepted` of every text."""
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model is None:
        return unknown(rows)
    return judged(entropies(spark, rows, model), model)


def unknown(rows: DataFrame) -> DataFrame:
    """The answers where nothing was learned."""
    blank = [F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("bits_per_char")]
    return rows.select("doc_id", *blank, F.lit(False).alias("accepted"))


def judged(scored: DataFrame, model: Model) -> DataFrame:
    """The answers from `doc_id`, `bits`, `chars` of every text."""

    def of(values: list, place: Column) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), place)

    some = F.col("chars") > 0
    scored = scored.withColumn("least", F.array_min("bits"))
    scored = scored.withColumn("place", F.array_position("bits", F.col("least")).cast("int"))
    gaps = F.transform("bits", lambda b: F.pow(F.lit(2.0), (F.col("least") - b) * model.temperature))
    score = 1 / F.aggregate(gaps, F.lit(0.0), lambda a, b: a + b)
    return scored.select(
        "doc_id",
        F.when(some, of(model.langs, F.col("place"))).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(some, score).otherwise(0.0).alias("score"),
        F.when(some, F.col("least")).otherwise(0.0).alias("bits_per_char"),
        F.when(some, F.col("least") <= of(list(model.limits), F.col("place"))).otherwise(False).alias("accepted"),
    )


def held_out_predictions(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Learn from the folds other than 2, predict every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "lang")
    model = fitted(spark, counted(learned(rows.where(fold(F.col("doc_id")) != 2))))
    if model is None:
        out = unknown(rows)
    else:  # every text is scored once: the answers and what is fitted to the training texts come from the same bits
        known = F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id")) != 2)
        scored = written(spark, entropies(spark, rows.select("doc_id", F.when(known, F.col("lang")).alias("lang"), "text"), model), "entropies")
        calibrate(model, scored.where("lang IS NOT NULL"))
        out = judged(scored, model)
    return out.withColumn("held_out", fold(F.col("doc_id")) == 2)
