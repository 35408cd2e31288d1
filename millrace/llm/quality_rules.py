"""Rule ledger: every rule is evaluated once per text and its failures are kept as bits.

`measure` reads whole texts and gives numbers, `ledger` turns them into one bit per failed rule, and
a `Policy` is a versioned mask over those bits, so a new policy or an ablation reads the ledger and
never the texts. Defined cases: a null or empty text has all numbers 0 (it fails `few_words`), a
null id is carried as it is, repeated rows give repeated rows, an empty table gives an empty ledger,
and of the input only the id and the text are read, so further columns cannot clash.

The rules of the query's ledger are those of its SQL and know ASCII letters and words between spaces. The
ledger of documents (`scripts`) has bits for further rules too: letters of all scripts are counted, two letters
of a script written without spaces are taken as a word, and abuse is seen as a share of the words. Documents are
kept by `ANY_SCRIPT`, a policy over that ledger.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.words import (
    NOT_WORD,
    SPACE,
    lower_ascii,
    mixed,
    separators,
    span_hashes,
    text_blocks,
    windows,
    word_spans,
)

#: Words counted as abuse.
ABUSE = (
    "clown", "clowns", "disgusting", "idiot", "idiots", "loser", "losers", "moron", "morons", "pathetic",
    "scum", "stupid", "trash", "worthless",
)

NUMBERS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_lower", "n_shouts", "n_abuse",
)

#: Counts over all scripts: letters, capitals, and letters of scripts written without spaces.
SCRIPT_NUMBERS = ("n_letters", "n_capitals", "n_unspaced")

#: Rule -> condition under which a text fails it, over the numbers; the place in this list is the bit.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 2 * word_chars",
    "repeated_lines": "n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines",
    "upper_case": "n_upper > n_lower",
    "shouting": "100 * n_shouts > 10 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "abuse": "n_abuse >= 2 OR 200 * n_abuse > n_words",
}
#: The same for texts of any script, over the script numbers too.
_WORDS = "(n_words + n_unspaced DIV 2)"
SCRIPT_RULES: dict[str, str] = {
    "few_words_any": f"{_WORDS} < 50",
    "capitals": "2 * n_capitals > n_letters",
    "shouting_any": f"100 * n_shouts > 10 * {_WORDS}",
    "long_words_any": f"word_chars > 20 * {_WORDS}",
    "abuse_share": f"n_abuse >= 2 AND 200 * n_abuse > {_WORDS}",
}
BITS = {name: 1 << i for i, name in enumerate(RULES)}
#: Those of the ledger of documents; the first ones are the same.
ALL_BITS = {name: 1 << i for i, name in enumerate(RULES | SCRIPT_RULES)}


@dataclass(frozen=True)
class Policy:
    """A text is rejected if any of these rules failed."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(ALL_BITS[r] for r in self.rules)

    def keeps(self, bits: Column) -> Column:
        return bits.bitwiseAND(F.lit(self.mask)) == 0


POLICIES = (
    Policy("base", 1, ("few_words", "repeated_words")),
    Policy("web", 1, ("few_words", "repeated_words", "symbols", "repeated_lines")),
    Policy("web", 2, tuple(RULES)),
)
PRODUCTION = POLICIES[-1]
#: For documents of any script: over a ledger made with `scripts`.
ANY_SCRIPT = Policy("web", 3, ("repeated_words", "symbols", "repeated_lines", *SCRIPT_RULES))


def _sums(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))[first])


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every key: whether an equal one stands before it, and whether one stands anywhere else."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    earlier, anywhere = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    earlier[order[1:]] = same
    anywhere[order[1:]] = same
    anywhere[order[:-1]] |= same
    return earlier, anywhere


_SALT = np.uint64(0xC2B2AE3D27D4EB4F)
_LINE = np.zeros(256, bool)
_LINE[10] = True
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))


def text_numbers(raw: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    """The numbers of every text of a block."""
    texts = len(first) - 1
    starts, ends, words = word_spans(raw, first)
    n_words = np.diff(words)
    hashes = span_hashes(raw, starts, ends)
    own = np.repeat(np.arange(texts, dtype=np.uint64), n_words) * _SALT

    repeat = np.zeros(len(starts), bool)
    three = windows(hashes, 3)
    inside = own[:-2] == own[2:]
    at = np.flatnonzero(inside) if len(three) else np.zeros(0, np.int64)
    if len(at):
        found = at[_repeats(mixed(three[at] + own[at]))[1]]
        for i in range(3):
            repeat[found + i] = True

    line_starts, line_ends, lines = word_spans(raw, first, _LINE)
    worded = np.searchsorted(starts, line_starts) < np.searchsorted(starts, line_ends)
    line_of = np.repeat(np.arange(texts), np.diff(lines))[worded]
    line_hash = span_hashes(raw, line_starts, line_ends)[worded]
    earlier = _repeats(mixed(line_hash + line_of.astype(np.uint64) * _SALT))[0]

    low = lower_ascii(raw)
    plain_starts, plain_ends, plain = word_spans(low, first, NOT_WORD)
    known = np.frombuffer(" ".join(ABUSE).encode(), np.uint8)
    abuse = span_hashes(known, *word_spans(known, np.array([0, len(known)]))[:2])
    abused = np.isin(span_hashes(low, plain_starts, plain_ends), abuse)
    return {
        "n_words": n_words,
        "word_chars": _sums(~SPACE[raw] & ((raw & 0xC0) != 0x80), first),
        "n_symbols": _sums(_SYMBOL[raw], first),
        "n_dup_lines": np.bincount(line_of[earlier], minlength=texts),
        "n_repeat_words": _sums(repeat, words),
        "n_lines": np.bincount(line_of, minlength=texts),
        "n_upper": _sums(raw != low, first),
        "n_lower": _sums((raw >= 97) & (raw <= 122), first),
        "n_shouts": _sums(raw == 33, first),
        "n_abuse": _sums(abused, plain),
    }


#: Blocks of scripts written without spaces: Thai, Lao, Tibetan, Myanmar, Khmer, Tai Le and New Tai Lue,
#: Tai Tham, kana, Han, Yi, Javanese, Myanmar and Tai Viet extensions.
_UNSPACED = (
    (0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x3005, 0x3007),
    (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA000, 0xA48F), (0xA980, 0xA9DF),
    (0xA9E0, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9D), (0x1B000, 0x1B16F), (0x20000, 0x323AF),
)
_LAST = 0x323B0  # no letter from here on


@cache
def _script_table() -> np.ndarray:
    """Of every character: 1 a letter, 2 a capital, 4 a letter of a script without spaces."""
    table = np.array([(c := chr(i)).isalpha() + 2 * c.isupper() * c.isalpha() for i in range(_LAST + 1)], np.uint8)
    for low, high in _UNSPACED:
        table[low : high + 1] |= (table[low : high + 1] & 1) << 2
    return table


def script_numbers(raw: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    """The script numbers of every text of a block."""
    table = _script_table()
    flags = np.where(raw < 128, table[raw], 0)
    at = np.flatnonzero(raw >= 0xC0)
    if len(at):
        lead = raw[at].astype(np.int32)
        size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
        code = lead & (0x7F >> size)
        for i in (1, 2, 3):
            inside = size > i
            code[inside] = code[inside] << 6 | raw[np.minimum(at[inside] + i, len(raw) - 1)] & 0x3F
        flags[at] = table[np.minimum(code, _LAST)]
    return {name: _sums(flags & bit != 0, first) for name, bit in zip(SCRIPT_NUMBERS, (1, 2, 4), strict=True)}


def _measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, raw, first in text_blocks(batch):
            found = text_numbers(raw, first)
            columns = [part.column(0), *(pa.array(found[name], pa.int64()) for name in NUMBERS)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *NUMBERS])


def _measured_any(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = (*NUMBERS, *SCRIPT_NUMBERS)
    for batch in batches:
        for part, raw, first in text_blocks(batch):
            found = text_numbers(raw, first) | script_numbers(raw, first)
            columns = [part.column(0), *(pa.array(found[name], pa.int64()) for name in names)]
            yield pa.RecordBatch.from_arrays(columns, names=[part.schema.names[0], *names])


def measure(docs: DataFrame, *, id: str = "doc_id", text: str = "text", scripts: bool = False) -> DataFrame:
    """`doc_id` and the numbers of every text, with `scripts` the script numbers too, read once."""
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    names = ("doc_id", *NUMBERS, *(SCRIPT_NUMBERS if scripts else ()))
    return rows.mapInArrow(_measured_any if scripts else _measured, ", ".join(f"{name} long" for name in names))


def failed(scripts: bool = False) -> Column:
    """The bits of all rules that fail, over the numbers."""
    tests = RULES | SCRIPT_RULES if scripts else RULES
    return sum((F.expr(f"IF({test}, {ALL_BITS[name]}L, 0L)") for name, test in tests.items()), F.lit(0).cast("long"))


def ledger(docs: DataFrame, scripts: bool = False, **names: str) -> DataFrame:
    """The numbers and `failed_bits`: the bit of a rule is set if it failed. With `scripts` the rules for all
    scripts have theirs too."""
    return measure(docs, scripts=scripts, **names).withColumn("failed_bits", failed(scripts))


def verdicts(book: DataFrame, policy: Policy = PRODUCTION) -> DataFrame:
    """The ledger with `base_failed` and the policy's `kept`."""
    base = F.col("failed_bits").bitwiseAND(F.lit(POLICIES[0].mask)) != 0
    return book.withColumns({"base_failed": base, "kept": ~base & policy.keeps(F.col("failed_bits"))})


def ablations(book: DataFrame, policies: Iterable[Policy] = POLICIES) -> DataFrame:
    """For each policy and rule: texts that fail it, texts it alone rejects, texts kept without it.

    The ledger is reduced to one row per set of failed rules first; there are at most 2 ** rules.
    """
    asked = [(p.name, p.version, rule, p.mask, ALL_BITS[rule]) for p in policies for rule in p.rules]
    rules = book.sparkSession.createDataFrame(asked, "policy string, version int, rule string, mask long, bit long")
    patterns = book.groupBy("failed_bits").agg(F.count("*").alias("n"))
    each = F.array(*(F.struct(*(F.lit(v).alias(c) for v, c in zip(row, rules.columns, strict=True))) for row in asked))
    held = patterns.withColumn("asked", F.explode(each)).select("failed_bits", "n", "asked.*")
    bits, bit, mask = F.col("failed_bits"), F.col("bit").cast("long"), F.col("mask").cast("long")

    def texts(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))

    counts = held.groupBy("policy", "version", "rule").agg(
        texts(bits.bitwiseAND(bit) != 0).alias("fails"),
        texts(bits.bitwiseAND(mask) == bit).alias("only_here"),
        texts(bits.bitwiseAND(mask.bitwiseAND(F.bitwise_not(bit))) == 0).alias("kept_without"),
    )
    out = rules.join(counts, ["policy", "version", "rule"], "left").fillna(0)
    return out.select("policy", "version", "rule", "fails", "only_here", "kept_without")


def kept_documents(docs: DataFrame, policy: Policy = ANY_SCRIPT) -> DataFrame:
    """The documents a policy keeps, with their columns.

    Verdicts are taken where the rows are: the text is measured beside the other columns, so
    nothing is shuffled and null or repeated ids need no care.
    """
    names = docs.columns
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col("text").cast("string").alias("text"))
    numbers = (*NUMBERS, *SCRIPT_NUMBERS)
    shape = T.StructType([packed.schema["row"], *(T.StructField(n, T.LongType()) for n in numbers)])
    measured = packed.mapInArrow(_measured_any, shape)
    return measured.where(policy.keeps(failed(scripts=True))).select(*(F.col("row").getField(c).alias(c) for c in names))
