"""Quality classifier from weak labels: EM over labellers' votes, then a hashed linear scorer.

Heuristic labellers and the table of human labels vote bad, good or nothing on two questions: is a
text of low quality, and is it abusive. Votes of all documents are counted by pattern (at most
3 ** labellers rows), and expectation-maximisation finds each labeller's accuracies without truth,
starting from accuracies a labeller is expected to have. The posterior labels of a bounded sample
train a sparse logistic scorer over hashed features (words, word beginnings, classes of the numbers),
which then scores every whole text.

Defined cases: a null or empty text has no features beyond its numbers and is scored by them; human
labels with null ids or values are no vote, and of several labels of one id the worst counts; a null id has
no human vote; repeated rows give repeated rows; with no document, or only one class, the scorer
stays at the prior; empty tables give an empty result. Only id and text, and from the labels
doc_id, quality and toxic, are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.quality_rules import NUMBERS, SCRIPT_NUMBERS, _measured_any, script_numbers, text_numbers
from millrace.llm.tables import hashed_sample, written
from millrace.llm.words import NOT_WORD, flat_bytes, mixed, span_hashes, text_blocks, word_spans
from millrace.llm.decontaminate import lowered

#: Votes: SQL over the numbers and the human labels; 1 bad, 0 good, null no vote. With each labeller the
#: accuracy of its votes to start from, and what this belief is worth as a share of all its votes. Rules
#: see one kind of fault each, so a silent rule says nothing; texts without any fault have a voter of
#: their own.
Labeller = tuple[str, float, float]
FAULTS = {
    "symbols": "100 * n_symbols > 2 * word_chars",
    "repetition": "2 * n_repeat_words > n_words",
    "capitals": "2 * n_capitals > n_letters",
    "shouts": "10 * n_shouts > n_words",
    "lines": "n_dup_lines >= 3",
}
QUESTIONS: dict[str, dict[str, Labeller]] = {
    "low_quality": {
        **{name: (f"CASE WHEN n_words > 0 AND {test} THEN 1 END", 0.8, 0.02) for name, test in FAULTS.items()},
        "empty": ("CASE WHEN n_words = 0 THEN 1 END", 0.9, 0.02),
        "faultless": (f"CASE WHEN n_words >= 20 AND NOT ({' OR '.join(FAULTS.values())}) THEN 0 END", 0.8, 0.02),
        "human": ("CASE WHEN quality = 0 THEN 1 WHEN quality = 1 THEN 0 END", 0.9999, 1000.0),
    },
    "abusive": {
        "lexicon": ("CASE WHEN n_abuse > 0 THEN 1 END", 0.9, 0.02),
        "density": ("CASE WHEN 100 * n_abuse > n_words THEN 1 END", 0.9, 0.02),
        "quiet": ("CASE WHEN n_abuse = 0 THEN 0 END", 0.8, 0.02),
        "human": ("CASE WHEN toxic = 1 THEN 1 WHEN toxic = 0 THEN 0 END", 0.9999, 1000.0),
    },
}


@dataclass(frozen=True)
class Fit:
    """Texts of each posterior class the scorer is fitted on, hash bits, features kept, least texts of
    a feature, penalty, steps, and the chance of bad where nothing can be learned."""

    texts: int = 4_000
    bits: int = 18
    kept: int = 2_048
    least: int = 4
    penalty: float = 1e-3
    steps: int = 200
    prior: float = 0.1


@dataclass
class Beliefs:
    """Share of bad texts, and of each labeller the chance that a vote of its is right."""

    bad: float
    accuracy: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Chance of bad for rows of votes (1 bad, 0 good, -1 none)."""
        weight = np.log(self.accuracy / (1 - self.accuracy))
        odds = np.log(self.bad / (1 - self.bad)) + np.where(votes < 0, 0, 2 * votes - 1) @ weight
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def expectation_maximisation(votes: np.ndarray, n: np.ndarray, labellers: list[Labeller], rounds: int = 200) -> Beliefs:
    """Accuracies of overlapping labellers from counted vote patterns.

    A vote is right with its labeller's accuracy, whatever the others say. What a vote is worth is learned
    where labellers overlap: it is judged by the other votes on the same texts, both classes
    taken as likely, so a labeller of a rare fault is neither confirmed nor refuted by texts that it
    alone speaks of. No labeller is believed to be worse than chance.
    """
    start = np.array([x[1] for x in labellers])
    sign = np.where(votes < 0, 0, 2 * votes - 1).astype(np.float64)
    shared = (votes >= 0) & ((votes >= 0).sum(1) > 1)[:, None]
    cast = shared * n[:, None]
    worth = np.array([x[2] for x in labellers]) * cast.sum(0) + 1
    now = Beliefs(0.1, start)
    for _ in range(rounds):
        share = n @ now.posterior(votes)
        weight = np.log(now.accuracy / (1 - now.accuracy))
        others = (sign @ weight)[:, None] - sign * weight
        # What the others expect, from -1 to 1. A vote of accuracy a agrees with it by (2a - 1) t * t.
        expect = np.tanh(np.clip(others, -500, 500) / 2)
        agreed, certain = (cast * sign * expect).sum(0), (cast * expect**2).sum(0)
        found = 0.5 + 0.5 * np.clip(agreed / np.maximum(certain, 1e-9), 0, 0.9998)
        accuracy = np.clip((cast.sum(0) * found + worth * start) / (cast.sum(0) + worth), 0.5, 0.9999)
        new = Beliefs(float(np.clip((share + 1) / (n.sum() + 10), 0.001, 0.5)), accuracy)
        moved = np.abs(new.accuracy - now.accuracy).max() + abs(new.bad - now.bad)
        now = new
        if moved < 1e-6:
            break
    return now


def features(texts: pa.Array, bits: int, used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Text and hashed feature of every distinct feature of a text, sorted; only `used` ones if given."""
    low, first = flat_bytes(lowered(texts))
    starts, ends, words = word_spans(low, first, NOT_WORD)
    kinds = [span_hashes(low, starts, ends)]
    for length in (4, 6, 8):
        kinds.append(span_hashes(low, starts, np.minimum(ends, starts + length)) + np.uint64(length))
    shift = np.uint64(64 - bits)
    of = np.repeat(np.arange(len(texts)), np.diff(words))
    keys = []

    def note(text: np.ndarray, hashes: np.ndarray) -> None:
        slots = (mixed(hashes) >> shift).astype(np.int64)
        if used is not None:
            known = used[slots]
            text, slots = text[known], slots[known]
        keys.append(text << bits | slots)

    for hashes in kinds:
        note(of, hashes)
    raw, whole = flat_bytes(texts.cast(pa.large_string()).fill_null(""))
    found = text_numbers(raw, whole) | script_numbers(raw, whole)
    n_words, chars = np.maximum(found["n_words"], 1), np.maximum(found["word_chars"], 1)
    numbers = {
        "symbols": 100 * found["n_symbols"] // chars, "repeats": 10 * found["n_repeat_words"] // n_words, "lines": found["n_dup_lines"],
        "upper": 10 * found["n_capitals"] // np.maximum(found["n_letters"], 1),
        "shouts": 10 * found["n_shouts"] // n_words, "words": found["n_words"], "length": chars // n_words,
    }
    for i, value in enumerate(numbers.values()):
        level = np.frexp(value.astype(np.float64))[1]  # 0, 1, 2-3, 4-7, ...
        note(np.arange(len(texts)), (level + 100 * (i + 1)).astype(np.uint64))
    found_keys = np.unique(np.concatenate(keys))
    return found_keys >> bits, found_keys & ((1 << bits) - 1)


@dataclass
class Scorer:
    """Sparse weights over hashed features; the last entry is the intercept."""

    weights: np.ndarray

    def scores(self, of: np.ndarray, slots: np.ndarray, texts: int) -> np.ndarray:
        sums = np.bincount(of, self.weights[slots], texts) + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(sums, -500, 500)))


def fitted(rows: list[np.ndarray], target: np.ndarray, fit: Fit) -> Scorer:
    """Logistic regression with an L1 penalty on the features that depend most on the target."""
    weights = np.zeros((1 << fit.bits) + 1)
    weights[-1] = np.log(fit.prior / (1 - fit.prior))
    if not rows or target.max() - target.min() < 0.5:
        return Scorer(weights)
    n, size = len(rows), 1 << fit.bits
    of = np.repeat(np.arange(n), [len(r) for r in rows])
    flat = np.concatenate(rows)
    held = np.bincount(flat, minlength=size).astype(np.float64)
    bad = np.bincount(flat, target[of], minlength=size)
    share = target.mean()
    spread = np.maximum(held * (1 - held / n), 1e-9)
    chi = np.where((held >= fit.least) & (held < n), (bad - held * share) ** 2 / spread, 0)
    used = np.sort(np.argsort(-chi, kind="stable")[: fit.kept])
    used = used[chi[used] > 0]
    if not len(used):
        return Scorer(weights)
    column = np.full(size, -1)
    column[used] = np.arange(len(used))
    table = np.zeros((n, len(used)), np.float32)
    inside = column[flat] >= 0
    table[of[inside], column[flat[inside]]] = 1
    scale = 1 / np.sqrt(np.maximum(table.mean(0) * (1 - table.mean(0)), 1e-4))
    center = table.mean(0)
    balance = np.where(target > 0.5, 0.5 / share, 0.5 / (1 - share))

    def sums(w: np.ndarray) -> np.ndarray:
        return table @ (w * scale).astype(np.float32) - (center * scale) @ w

    def back(e: np.ndarray) -> np.ndarray:
        return (e.astype(np.float32) @ table - e.sum() * center) * scale / n

    probe = np.ones(len(used)) / np.sqrt(len(used))
    for _ in range(12):  # largest curvature, by power iteration
        probe = back(balance * sums(probe))
        largest = np.linalg.norm(probe)
        probe /= max(largest, 1e-12)
    rate = 1 / max(0.25 * 1.1 * largest, 1e-6)
    now, ahead, intercept, momentum = np.zeros(len(used)), np.zeros(len(used)), 0.0, 1.0
    for _ in range(fit.steps):
        error = balance * (1 / (1 + np.exp(-np.clip(sums(ahead) + intercept, -500, 500))) - target)
        step = ahead - rate * back(error)
        new = np.sign(step) * np.maximum(np.abs(step) - rate * fit.penalty, 0)
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead, now, momentum = new + (momentum - 1) / after * (new - now), new, after
        intercept -= error.mean()
    weights[used], weights[-1] = now * scale, intercept - (center * scale) @ now
    return Scorer(weights)


def human_labels(labels: DataFrame) -> DataFrame:
    rows = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_labelled"))
    return rows.agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))


def keyed(docs: DataFrame) -> DataFrame:
    """`doc_id`, `text`, and `key`, a name of the two: an id may stand on many rows."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.withColumn("key", F.xxhash64("doc_id", "text"))


def votes(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id`, `key` and a string of votes for each question: `0` good, `1` bad, `-` none."""
    packed = keyed(docs).select(F.struct("doc_id", "key").alias("id"), "text")
    numbers = ", ".join(f"{name} long" for name in (*NUMBERS, *SCRIPT_NUMBERS))
    book = packed.mapInArrow(_measured_any, f"id struct<doc_id:bigint,key:bigint>, {numbers}").withColumn("doc_id", F.col("id.doc_id"))
    joined = book.join(human_labels(labels), book["doc_id"] == F.col("_labelled"), "left")
    columns = [
        F.concat(*(F.coalesce(F.expr(test).cast("string"), F.lit("-")) for test, *_ in labellers.values())).alias(question)
        for question, labellers in QUESTIONS.items()
    ]
    return joined.select("doc_id", F.col("id.key").alias("key"), *columns)


def coded(patterns: list[str]) -> np.ndarray:
    return np.array([[-1 if c == "-" else int(c) for c in p] for p in patterns], np.int64)


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> tuple[dict[str, Scorer], dict[str, Beliefs], DataFrame]:
    """Scorers and beliefs by question, and the votes of all documents."""
    cast = written(spark, votes(docs, labels), "votes")
    rows = keyed(docs)
    scorers, beliefs = {}, {}
    for question, labellers in QUESTIONS.items():
        counted = cast.groupBy(question).agg(F.count("*").alias("n")).orderBy(question).collect()  # at most 3 ** labellers
        if not counted:
            scorers[question] = fitted([], np.zeros(0), fit)
            beliefs[question] = expectation_maximisation(np.zeros((0, len(labellers)), np.int64), np.zeros(0), list(labellers.values()))
            continue
        patterns, n = coded([r[question] for r in counted]), np.array([r["n"] for r in counted], np.float64)
        belief = beliefs[question] = expectation_maximisation(patterns, n, list(labellers.values()))
        chance = belief.posterior(patterns)
        known = [(r[question], float(c), r["n"]) for r, c in zip(counted, chance, strict=True)]
        table = spark.createDataFrame([k[:2] for k in known], f"{question} string, chance double")
        judged = cast.join(F.broadcast(table), question).where("doc_id IS NOT NULL")  # at most 3 ** labellers rows
        # The sample: of each posterior class the texts with a human vote first, as they tell most.
        picked = cast.select("key", F.lit(0.0).alias("chance")).limit(0)
        for low, high in ((0.8, 1.0), (0.0, 0.2)):
            left = fit.texts
            for human in (True, False):
                count = sum(n for p, c, n in known if low <= c <= high and (p[-1] != "-") == human)
                if left <= 0 or not count:
                    continue
                side = judged.where(F.col("chance").between(low, high) & ((F.substring(question, -1, 1) != "-") == human))
                picked = picked.unionByName(hashed_sample(side, F.col("doc_id"), left, count, question).select("key", "chance"))
                left -= count
        # At most 8 * fit.texts rows: bounded for the broadcast and for the driver. Repeated rows, of one name and
        # one vote, count once.
        picked = picked.groupBy("key").agg(F.max("chance").alias("chance"))
        texts = rows.join(F.broadcast(picked), "key").groupBy("key").agg(F.first("text").alias("text"), F.first("chance").alias("chance"))
        sample = texts.mapInArrow(_featured(fit.bits), "chance double, features array<int>")
        held = sample.toArrow()
        lists = held.column("features").combine_chunks()
        if isinstance(lists, pa.ChunkedArray):
            lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], lists.type)
        split = np.split(lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()[1:-1] - lists.offsets[0].as_py())
        # The classes weigh the same in the fit; their real shares come in afterwards.
        scorers[question] = fitted(split if len(lists) else [], held.column("chance").to_numpy(), fit)
        if np.any(scorers[question].weights[:-1]):
            scorers[question].weights[-1] += np.log(belief.bad / (1 - belief.bad))
    return scorers, beliefs, cast


def _featured(bits: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, _ in text_blocks(batch):
                of, slots = features(part.column(part.schema.get_field_index("text")), bits)
                ends = np.searchsorted(of, np.arange(len(part) + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(slots, pa.int32()))
                chance = part.column(part.schema.get_field_index("chance"))
                yield pa.RecordBatch.from_arrays(
                    [chance, lists], names=["chance", "features"]
                )

    return run


def _scored(shared, bits: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers: dict[str, Scorer] = shared.value
        used = np.any([scorers[q].weights[:-1] != 0 for q in QUESTIONS], axis=0)
        for batch in batches:
            for part, _, _ in text_blocks(batch):
                found = features(part.column(1), bits, used)
                scores = [pa.array(scorers[q].scores(*found, len(part))) for q in QUESTIONS]
                yield pa.RecordBatch.from_arrays([part.column(0), *scores], names=["doc_id", *QUESTIONS])

    return run


def scored(spark: SparkSession, docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """`doc_id`, the chance of `low_quality` and of `abusive`, their `score` (chance of a good text) and `kept`."""
    scorers, _, _ = train(spark, docs, labels, fit)
    shared = spark.sparkContext.broadcast(scorers)  # 2 ** bits numbers per question
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(_scored(shared, fit.bits), "doc_id long, " + ", ".join(f"{q} double" for q in QUESTIONS))
    good = F.lit(1.0)
    for question in QUESTIONS:
        good = good * (1 - F.col(question))
    kept = F.lit(True)
    for question in QUESTIONS:
        kept = kept & (F.col(question) < 0.5)
    return out.withColumn("score", good).withColumn("kept", kept)
