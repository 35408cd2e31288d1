import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import surrogates

MENTIONS = {
    "email": ["anna.k-1@mail.example.com", "ANNA.K-1@MAIL.EXAMPLE.COM", "йот@почта.example"],
    "ip": ["10.2.33.254", "8.8.8.8"],
    "card": ["4785380592391139", "4111 1111 1111 1111", "4111-1111-1111-1111", "378282246310005"],
    "phone": ["+1 (743) 555-3824", "+49 30 1234567", "(743) 555-3824", "743-555-3824"],
    "ssn": ["123-45-6789"],
    "iban": ["DE89 3704 0044 0532 0130 00", "GB29NWBK60161331926819"],
    "secret": ["1eb9c654e721b4f812088970e66a6345cee33dd6", 'token = "c0ffee-Key_9'],
    "name": ["Mrs. Jane Smith", "Mr. John Smith", "HERR OTTO BAUER".title(), "Dr Kim Lee", "г-н Иван Петров", "г-жа Анна Петрова"],
}


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10


def result(spark, frame, key="k1"):
    return surrogates.with_surrogates(spark, frame, key).select("row.doc_id", "text", "mentions").collect()


@pytest.fixture(scope="module")
def made(spark, corpus):
    """{mention: (kind, surrogate)} of every mention in a sentence of its own."""
    flat = [m for group in MENTIONS.values() for m in group]
    rows = [(i, f"Ask, é {m}, and go.") for i, m in enumerate(flat)]
    out = {}
    for r in result(spark, corpus(rows)):
        assert len(r.mentions) == 1, rows[r.doc_id]
        found = r.mentions[0]
        assert found.mention == flat[r.doc_id]
        assert r.text == f"Ask, é {found.made}, and go."
        out[found.mention] = (found.what, found.made)
    return out


def test_kinds_and_formats(made):
    for what, group in MENTIONS.items():
        for mention in group:
            found, value = made[mention]
            assert found == what and value != mention, (mention, found, value)
            if what in ("card", "phone", "ssn", "iban", "secret"):
                shape = lambda s: re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", s)))
                assert len(value) == len(mention)
                assert what == "secret" or shape(value) == shape(mention)
            if what == "card":
                assert (luhn(re.sub(r"\D", "", value)) == 0) == (luhn(re.sub(r"\D", "", mention)) == 0)
                assert value[0] == mention[0]
            if what == "ip":
                assert all(0 < int(x) < 256 for x in value.split("."))
            if what == "email":
                assert re.fullmatch(r"\S+@\S+\.\S+", value) and value.isupper() == mention.isupper()
            if what == "secret":
                assert re.fullmatch(r'[0-9a-f]{40}|token = "[a-z]\d[a-z]{4}-[A-Z][a-z]{2}_\d', value)


def test_names_keep_gender_script_and_title(made):
    females = {n for (g, _), names in surrogates.GIVEN.items() if g == "f" for n in names}
    males = {n for (g, _), names in surrogates.GIVEN.items() if g == "m" for n in names}
    for mention, names in (("Mrs. Jane Smith", females), ("Mr. John Smith", males), ("г-жа Анна Петрова", females), ("г-н Иван Петров", males)):
        value = made[mention][1]
        assert value.split(" ")[0] == mention.split(" ")[0] and value.split(" ")[1] in names
        assert len(value.split(" ")) == 3
        assert bool(re.search("[а-я]{3}", value)) == bool(re.search("[а-я]{3}", mention))


def test_one_entity_one_surrogate(made):
    digits = lambda m: re.sub(r"\D", "", made[m][1])
    assert digits("4111 1111 1111 1111") == digits("4111-1111-1111-1111")
    assert made["anna.k-1@mail.example.com"][1].upper() == made["ANNA.K-1@MAIL.EXAMPLE.COM"][1]


def test_clean_texts_stay(spark, corpus):
    clean = ["12 3.5 2024-01-02 and 1,000,000", "a@b", "version 1.2.3", "Mr and Mrs", "the key is here", "x" * 100_000, "1 " * 5_000, "a.b.c" * 9_000, "+" * 20_000]
    out = result(spark, corpus(list(enumerate(clean))))
    assert {r.doc_id: r.text for r in out} == dict(enumerate(clean))


def test_given_table(spark, documents):
    pattern = re.compile(r"[\w.+-]+@[\w.-]+\w|\+1 \(\d+\) [\d-]+|(?:\d+\.){3}\d+|\d{13,}|[0-9a-f]{32,}")
    texts = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    entities = {m for t in texts.values() for m in pattern.findall(t)}
    out = result(spark, documents)
    whole = "\n".join(r.text for r in out)
    assert entities and not [e for e in entities if e in whole]
    assert all(r.text == texts[r.doc_id] for r in out if not r.mentions)
    pairs = {(m.what, m.mention.lower()): m.made.lower() for r in out for m in r.mentions}
    assert len(set(pairs.values())) == len(pairs)
    again = {r.doc_id: r.text for r in result(spark, documents.repartition(5))}
    assert again == {r.doc_id: r.text for r in out}
    assert again != {r.doc_id: r.text for r in result(spark, documents, "k2")}


def test_odd_rows(spark, corpus, odd_rows):
    rows = [*odd_rows, (None, "x@y.com 8.8.8.8"), (9, "8.8.8.8"), (9, "8.8.8.8"), (9, "x@y.com")]
    frame = corpus(rows, extra=["row", "mentions", "found"])
    out = surrogates.replaced(spark, frame)
    assert out.columns == frame.columns
    got = out.collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id, r.text) for r in got if r.doc_id and r.doc_id < 9) == sorted((d, t) for d, t in odd_rows if d) if all(t for _, t in odd_rows) else True
    assert {r.text for r in got if r.doc_id == 1} == {None} and {r.text for r in got if r.doc_id == 2} == {""}
    nine = [r.text for r in got if r.doc_id == 9]
    assert len(nine) == 3 and len(set(nine)) == 2 and not {"8.8.8.8", "x@y.com"} & set(nine)
    assert surrogates.replaced(spark, corpus([])).count() == 0


def test_values_that_meet_are_drawn_again(spark, monkeypatch):
    """With only 20 first draws, 12 entities meet often; all end up different and none is real."""
    real = surrogates.surrogate

    def narrow(what, name, attempt, key):
        few = F.concat(F.lit("n"), F.pmod(F.xxhash64(name), F.lit(20)).cast("string"))
        return F.when(attempt == 0, few).otherwise(real(what, name, attempt, key))

    monkeypatch.setattr(surrogates, "surrogate", narrow)
    names = [("secret", f"n{i}") for i in range(12)]
    rows = surrogates.distinct_surrogates(spark, spark.createDataFrame(names, "what string, name string")).collect()
    assert len(rows) == 12 and len({r.value for r in rows}) == 12
    assert not {r.value for r in rows} & {n for _, n in names}


def test_forms_too_small_are_refused(spark):
    names = [("ssn", str(i)) for i in range(10)]
    with pytest.raises(ValueError, match="too small"):
        surrogates.distinct_surrogates(spark, spark.createDataFrame(names, "what string, name string"))


@pytest.mark.parametrize(
    "names",
    [
        [("phone", f"{i:04d}") for i in range(0, 10_000, 2)] + [("phone", f"{i:04d}") for i in range(1, 4_001, 2)],  # over half
        [("ssn", f"{i:03d}") for i in range(490)],
        [("card", f"4{i:03d}") for i in range(300)],
        [("secret", f"{a}{b}-x") for a in "abcdefghijkl" for b in "ABCDEFGHIJKLMNOPQR"],
        [("email", f"{a}@b.org") for a in "abc"] + [("name", "f:jane smith"), ("name", "m:иван петров"), ("name", "n:o")] + [("ip", "1.2.3.4")],
    ],
)
def test_crowded_forms_get_free_values_by_rank(spark, monkeypatch, names):
    monkeypatch.setattr(surrogates, "MOST_ROUNDS", 1)
    draw = surrogates.surrogate
    few = lambda what, name, attempt, key: F.when(F.lit(len(names) < 10), F.lit("1")).otherwise(draw(what, name, attempt, key))
    monkeypatch.setattr(surrogates, "surrogate", few)
    rows = surrogates.distinct_surrogates(spark, spark.createDataFrame(names, "what string, name string")).collect()
    assert {(r.what, r.name) for r in rows} == set(names) and len(rows) == len(names)
    assert len({(r.what, r.value) for r in rows}) == len(names)
    assert not {(r.what, r.value) for r in rows} & set(names)
    for r in rows:
        if r.what in ("ssn", "card", "secret"):
            assert len(r.value) == len(r.name)
        if r.what == "card":
            assert r.value[0] == "4" and (luhn(r.value) == 0 or luhn(r.name) != 0)
        if r.what == "phone":
            assert re.fullmatch(r"\d{4,5}", r.value)


def test_scores_are_no_phone_numbers(spark, corpus):
    texts = ["it got +1234 votes", "a change of +12 345", "call +1234567 now", "+49 30 1234567", "+1 (743) 555-3824"]
    counts = {r.doc_id: len(r.mentions) for r in result(spark, corpus(list(enumerate(texts))))}
    assert counts == {0: 0, 1: 0, 2: 1, 3: 1, 4: 1}


def test_no_python_in_the_plan(spark, documents):
    plan = surrogates.replaced(spark, documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_a_name_is_replaced_in_all_its_writings(spark, corpus):
    text = "Mr. John Smith met us. Mr. Smith said so. Later John Smith left, and JOHN SMITH's car, Smith's and John. Johnson and Smithy stay; a smith too."
    (row,) = result(spark, corpus([(1, text)]))
    assert not re.search(r"\b(?:John|JOHN|Smith|SMITH)\b", row.text)
    assert "Johnson and Smithy stay; a smith too." in row.text
    given, family = row.mentions[0].made.split(" ")[1:]
    want = text
    for old, new in (("John", given), ("Smith", family), ("JOHN", given.upper()), ("SMITH", family.upper())):
        want = re.sub(rf"\b{old}\b", new, want)
    assert row.text == want


def brute_names(text, known):
    """Every capitalised word that is a name's word of the document, by a dictionary."""
    def one(match):
        word = match[0]
        for end in ("", "'s"):
            base = word[: len(word) - len(end)] if word.endswith(end) else word
            if base.lower() in known:
                value = known[base.lower()]
                return (value.upper() if base.isupper() and len(base) > 1 else value) + word[len(base) :]
        return word

    return re.sub(r"(?<![^\W_])[A-ZÀ-Þ][^\W\d_]*(?:['-][^\W\d_]+)*", one, text)


def test_names_against_a_dictionary(spark, corpus):
    """Several people, genders and orders; words of one document's names stay in another's text."""
    texts = [
        "Mrs. Jane Smith and Mr. John Smith: Jane, John, the Smiths and Smith.",
        "Jane and Smith without titles stay.",
        "Señora María García habló. María se fue; García también. María García-López no.",
        "Dr. Kim Lee wrote. Ms. Kim Lee signed. Kim Lee's book, Lee.",
        "Mr. Brown, Ms. Anna Brown-Miller, Prof. Miller: Brown-Miller, Miller, Brown, Anna.",
    ]
    rows = {r.doc_id: r for r in result(spark, corpus(list(enumerate(texts))))}
    assert rows[1].text == texts[1] and not rows[1].mentions
    words = {}
    for i in (0, 2, 3, 4):
        known = {}
        for m in rows[i].mentions:
            old, new = m.mention.split(" ")[1:], m.made.split(" ")[1:]
            assert len(old) == len(new) and m.made.split(" ")[0] == m.mention.split(" ")[0]
            known |= {o.lower(): n for o, n in zip(old, new)}
        assert rows[i].text == brute_names(texts[i], known), i
        for old, new in known.items():
            assert words.setdefault(old, new) == new
    assert len(set(words.values())) == len(words)  # different names stay different
    assert not set(words.values()) & {w.title() for w in words}
