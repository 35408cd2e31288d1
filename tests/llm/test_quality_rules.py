import pytest
from brute import words

from millrace.llm import quality_rules
from millrace.llm.quality_rules import BITS, POLICIES, PRODUCTION, RULES


def numbers(text):
    text = text or ""
    found = words(text)
    three = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    repeated = {i + k for i, t in enumerate(three) if three.count(t) > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if words(line)]
    return {
        "n_words": len(found),
        "word_chars": sum(map(len, found)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
        "n_lines": len(lines),
    }


TEXTS = [
    None,
    "",
    "a a a a",
    "one two three four one two three",
    "line\nline\n line\nline \n\n\nother\nline",
    "### $$$ a|b <c>\x0b\x0cd\te",
    "é\u0085b   c é",
    "stop\rstart\r\nstop",
    "IDIOT, idiot! you are the idiot",
    " ".join(f"w{i}" for i in range(80)),
    "x " * 300,
]


def test_numbers(spark, corpus):
    rows = list(enumerate(TEXTS))
    got = {r.doc_id: r for r in quality_rules.measure(corpus(rows, extra=["n_words", "kept"])).collect()}
    for doc, text in rows:
        assert {k: got[doc][k] for k in numbers(text)} == numbers(text), text
    assert got[8].n_abuse == 3


def test_odd_rows_and_verdicts(spark, corpus, odd_rows):
    book = quality_rules.verdicts(quality_rules.ledger(corpus(odd_rows)))
    rows = book.collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (r.failed_bits & PRODUCTION.mask == 0)


def test_empty_table(spark, corpus):
    assert quality_rules.ledger(corpus([])).count() == 0
    assert {r.fails for r in quality_rules.ablations(quality_rules.ledger(corpus([]))).collect()} == {0}


def test_stage_agrees_with_ledger(spark, documents, data):
    kept = {r.doc_id for r in quality_rules.verdicts(quality_rules.ledger(documents)).where("kept").collect()}
    out = quality_rules.kept_documents(documents)
    assert out.columns == documents.columns
    assert {r.doc_id for r in out.select("doc_id").collect()} == kept


def test_clean_documents_stay(spark, documents, data):
    labels = spark.read.parquet(f"{data}/labels.parquet")
    rows = quality_rules.verdicts(quality_rules.ledger(documents)).join(labels, "doc_id").collect()
    clean = [r for r in rows if r.quality == 1 and r.toxic == 0 and not r.base_failed]
    junk = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in clean) >= 0.99 * len(clean)
    assert sum(r.kept for r in junk) <= 0.05 * len(junk)


@pytest.mark.parametrize("policy", POLICIES)
def test_ablations(spark, documents, policy):
    book = quality_rules.ledger(documents)
    bits = [r.failed_bits for r in book.collect()]
    for r in quality_rules.ablations(book, [policy]).collect():
        bit, mask = BITS[r.rule], policy.mask
        assert r.fails == sum(b & bit != 0 for b in bits)
        assert r.only_here == sum(b & mask == bit for b in bits)
        assert r.kept_without == sum(b & mask & ~bit == 0 for b in bits)


def clean_texts():
    """Clean texts of scripts that ASCII rules misjudge, and a very long one with two listed words."""
    cyrillic = " ".join(f"слово{chr(0x430 + i % 30)}{chr(0x430 + i // 30)}" for i in range(90)) + " НАТО NATO"
    chinese = "，".join("".join(chr(0x4E00 + (37 * i + 11 * k) % 5_000) for k in range(12)) for i in range(40)) + "。 DNA!"
    long = " ".join(f"w{i}" for i in range(10_000)) + " trash " + " ".join(f"v{i}" for i in range(10_000)) + " stupid"
    return [cyrillic, chinese, "Ελληνικά " + " ".join(f"λέξη{chr(0x3B1 + i % 24)}{chr(0x3B1 + i // 24)}" for i in range(70)) + " NASA", long]


def test_clean_texts_of_any_script_stay(spark, corpus):
    rows = list(enumerate(clean_texts()))
    rows += [(10, clean_texts()[0].upper()), (11, "汉字！" * 5), (12, "x" * 5_000), (13, " ".join(f"w{i}" for i in range(60)) + " trash stupid")]
    kept = {r.doc_id for r in quality_rules.kept_documents(corpus(rows)).collect()}
    assert kept == {0, 1, 2, 3}


def test_script_numbers(spark, corpus):
    texts = [*TEXTS, *clean_texts(), "Ǆ ß Жж 漢字かな ไทย \U0001f600 \U00020000 \U00010400", "Ünï"]
    got = {r.doc_id: r for r in quality_rules.measure(corpus(list(enumerate(texts))), scripts=True).collect()}
    for doc, text in enumerate(texts):
        letters = [c for c in text or "" if c.isalpha()]
        assert got[doc].n_letters == len(letters), text
        assert got[doc].n_capitals == sum(c.isupper() for c in letters), text
    assert got[len(TEXTS) + 4].n_unspaced == 8


def test_bits_are_distinct():
    assert len(set(BITS.values())) == len(RULES)


def test_the_policy_for_all_scripts_reads_the_ledger(spark, documents):
    """Documents are kept by the bits of a ledger that any other policy can read as well."""
    book = quality_rules.ledger(documents, scripts=True)
    policy = quality_rules.ANY_SCRIPT
    kept = {r.doc_id for r in quality_rules.kept_documents(documents).collect()}
    bits = {r.doc_id: r.failed_bits for r in book.collect()}
    assert kept == {doc for doc, b in bits.items() if b & policy.mask == 0}
    assert {doc: b & 255 for doc, b in bits.items()} == {r.doc_id: r.failed_bits for r in quality_rules.ledger(documents).collect()}
    for r in quality_rules.ablations(book, [policy]).collect():
        bit = quality_rules.ALL_BITS[r.rule]
        assert (r.fails, r.only_here, r.kept_without) == (
            sum(b & bit != 0 for b in bits.values()), sum(b & policy.mask == bit for b in bits.values()), sum(b & policy.mask & ~bit == 0 for b in bits.values()),
        )
