"""Time-varying mixing of sources: targets, the words each document gives, training positions.

A source's weight changes linearly over the training, from `start` to `end` times its base weight.
The integral of that schedule is the source's cumulative demand. A document takes its place where
the demand, inverted, reaches the words of its source that stand before it in a keyed order; a
source whose target exceeds its size goes round again. The running sums are taken in two steps
(buckets of the keyed order, then rows inside one bucket), so no source is ever one group.

Defined cases: a null text has size 0 and takes 0; a null source is a source of its own, placed
last; null and repeated ids are ordered by their other columns and each row counts; where all sizes
are 0 all targets are 0; an empty table gives an empty result. The columns of the documents travel
in one struct, so no name can clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.tables import WORD, written
from millrace.operators.ordering import number_rows


@dataclass(frozen=True)
class Mix:
    """Weights by place of the source, repeating; intensities at the start and end of training."""

    weights: tuple[int, ...] = (3, 1, 2)
    start: tuple[float, ...] = (1.0, 1.0, 1.0)
    end: tuple[float, ...] = (1.5, 0.5, 1.0)
    share: float = 1.5
    most_passes: int = 2
    seed: str = "mix-1"


#: Documents a bucket of the keyed order should hold, and the finest cut (16 ** digits buckets).
BUCKET_DOCS, MOST_DIGITS = 2_000, 5


def _by_place(values: tuple, place: Column) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (place % len(values)).cast("int") + 1)


def sized(docs: DataFrame, payload: bool = False) -> DataFrame:
    """`doc_id`, `source`, `size` in words, and with `payload` the whole row as one struct."""
    columns = [
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    ]
    if payload:
        columns.append(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    return docs.select(*columns)


def targets(spark: SparkSession, sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per source: `source`, `place`, `source_size`, `target`.

    The excess over a source's limit is shared again by weight until no target is above its limit;
    every round reads only this table of one row per source and brings back two sums.
    """
    totals = written(spark, sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs")), "totals")
    ordered = totals.withColumn("_last", F.col("source").isNull().cast("int"))
    placed = number_rows(ordered, ["_last", "source"], "place").drop("_last")
    rows = written(
        spark,
        placed.withColumns(
            {
                "weight": _by_place(mix.weights, F.col("place")).cast("long"),
                "limit": F.col("source_size") * mix.most_passes,
            }
        ),
        "sources",
    )
    whole = (rows.agg(F.sum("source_size")).first()[0] or 0) * mix.share
    per_weight, held = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(per_weight) > F.col("limit")
        full, open_weight, n = rows.agg(
            F.sum(F.when(above, F.col("limit"))), F.sum(F.when(~above, F.col("weight"))), F.count(F.when(above, 1))
        ).first()
        if n == held or not open_weight:
            break
        held, per_weight = n, (whole - (full or 0)) / open_weight
    target = F.least(F.col("limit").cast("double"), F.col("weight") * F.lit(float(per_weight)))
    return rows.select("source", "place", "docs", "source_size", target.alias("target"))


def placed(spark: SparkSession, rows: DataFrame, mix: Mix = Mix(), sizes: DataFrame | None = None) -> DataFrame:
    """Each row with its source's numbers, the words before it (`ahead`) and the words `taken`.

    `sizes` may hold `source` and `size` of the same documents, written before; rows are then read
    only where they are dealt out.
    """
    sizes = rows.select("doc_id", "source", "size") if sizes is None else sizes
    goals = written(spark, targets(spark, sizes, mix), "targets")
    docs = goals.agg(F.sum("docs")).first()[0] or 0
    digits = 0
    while digits < MOST_DIGITS and docs > BUCKET_DOCS * 16**digits:
        digits += 1

    def keyed(items: DataFrame) -> DataFrame:
        key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{mix.seed}")))
        return items.withColumns({"_key": key, "_bucket": F.substring(key, 1, digits) if digits else F.lit("")})

    sums = keyed(sizes).groupBy("source", "_bucket").agg(F.sum("size").alias("_in_bucket"))
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("_start", F.coalesce(F.sum("_in_bucket").over(before), F.lit(0)))
    known = starts.join(goals, starts["source"].eqNullSafe(goals["source"]), "left").select(
        starts["source"].alias("_source"), starts["_bucket"].alias("_b"), "_start", "place", "source_size", "target"
    )
    inside = Window.partitionBy("source", "_bucket").orderBy("_key", "doc_id", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    items = keyed(rows).withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    items = items.join(known, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_bucket") == F.col("_b")), "left")
    ahead = F.col("_start") + F.col("_inside")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.round(F.col("target") - F.col("_passes") * F.col("source_size")).cast("long")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("ahead")))
    return (
        items.withColumn("ahead", ahead)
        .withColumn("_passes", passes)
        .withColumn("taken", (F.col("_passes") * F.col("size") + part).cast("long"))
        .drop("_source", "_b", "_start", "_inside", "_key", "_bucket")
    )


def position(mix: Mix, words: Column) -> Column:
    """When, from 0 to 1, the demand of a row's source reaches `words` of its target."""
    start, end = _by_place(mix.start, F.col("place")), _by_place(mix.end, F.col("place"))
    z = F.when(F.col("target") > 0, F.least(F.lit(1.0), words / F.col("target"))).otherwise(0.0) * (start + end) / 2
    return 2 * z / (start + F.sqrt(F.greatest(F.lit(0.0), start * start + 2 * (end - start) * z)))


def mixed(spark: SparkSession, docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """`doc_id`, `size`, `source_size`, `target`, `taken`, and the `first_position` in the training
    (null where nothing is taken), sorted along it over all partitions."""
    rows = written(spark, sized(docs), "sizes")
    out = placed(spark, rows, mix)
    first = F.when(F.col("taken") > 0, position(mix, F.col("ahead")))
    out = written(spark, out.select("doc_id", "size", "source_size", "target", "taken", first.alias("first_position")), "mix")
    return out.repartitionByRange("first_position", "doc_id").sortWithinPartitions("first_position", "doc_id")


def training_order(spark: SparkSession, docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The documents as the mix takes them, sorted along the training over all partitions.

    One row for each pass of a document, with its columns, `words_taken` of that pass and
    `position`; where a source ends inside a document, its text is cut to the words taken. Where the
    documents have a column of one of these names, the new one gets `_` behind it.
    """
    sizes = written(spark, sized(docs), "sizes")
    rows = placed(spark, sized(docs, payload=True), mix, sizes)
    words = F.greatest(F.lit(0), F.least(F.col("size"), F.col("taken") - F.col("_pass") * F.col("size")))
    passes = rows.withColumn("_pass", F.explode(F.sequence(F.lit(0), F.lit(mix.most_passes))))
    passes = passes.withColumn("words_taken", words.cast("long")).where("words_taken > 0")
    passes = passes.withColumn("position", position(mix, F.col("_pass") * F.col("source_size") + F.col("ahead")))
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col("row.text"), F.lit(f"({WORD})")), 1, F.col("words_taken")), " ")
    columns = [
        (F.when(F.col("words_taken") < F.col("size"), cut).otherwise(F.col("row.text")).alias(c) if c == "text" else F.col("row").getField(c).alias(c))
        for c in docs.columns
    ]
    new = {name: _free(name, docs.columns) for name in ("words_taken", "position")}
    out = passes.select(*columns, *(F.col(name).alias(free) for name, free in new.items()))
    along = [F.col(f"`{name}`") for name in (new["position"], "doc_id")]
    return out.repartitionByRange(*along).sortWithinPartitions(*along)


def _free(name: str, taken: list[str]) -> str:
    """The name, with as many `_` behind it as no column of this name needs."""
    held = {c.lower() for c in taken}
    while name.lower() in held:
        name += "_"
    return name
