"""Personal data replaced by keyed surrogates, with DataFrame functions only.

One pattern finds mentions of mail addresses, network addresses, card and account numbers, phone
numbers, secrets and names with a title. A mention is reduced to its entity (its digits, its lower-cased
address), so all writings of one entity share a surrogate throughout the corpus. The surrogate
comes from a keyed hash of the entity and keeps kind, length, script, gender, separators, case and
check digit. Entities whose surrogates meet, or meet a real entity, are drawn again; what still meets
after MOST_ROUNDS gets the free values of its form by rank. A phone number or name whose form is used up
gets a longer one; other kinds have a fixed form, and one without enough free values is refused.

Names are replaced word by word, so that the long and the short form of a person's name share their words: each
given name (with its gender) and each family name is an entity. A name found behind a title is then replaced in
its whole document, also where its words stand without a title, together or alone.

The key is a parameter; without it surrogates cannot be recomputed. Only mentions are shuffled, and
only documents that hold one meet them again, by a hash of the row's id and text.

Defined cases: null texts stay null, empty ones empty; null and repeated ids are carried (rows with
equal id and text get equal results); an empty table gives an empty result; the columns of the
documents travel in one struct, so no name can clash.
"""

from __future__ import annotations

import operator
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.tables import written
from millrace.operators.ordering import number_rows

DEFAULT_KEY = "surrogates-1"
MOST_ROUNDS = 20

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
MALE_TITLES = r"(?:Mr|Herr|Monsieur|M|Señor|Sr|Don|Signor)"
FEMALE_TITLES = r"(?:Mrs|Ms|Miss|Frau|Madame|Mme|Mademoiselle|Mlle|Señora|Sra|Doña|Signora)"
CYRILLIC_TITLES = r"(?:г-н|г-жа|господин|госпожа)"
_KEYWORD = r"(?:[Tt]oken|TOKEN|[Ss]ecret|SECRET|[Pp]assword|PASSWORD|[Kk]ey|KEY)[ \"']{0,2}[=:][ \"']{0,2}"
#: Kinds of entities and their patterns, in the order in which they are tried. Runs are possessive and
#: begin where no run can be going on, so that matching is linear in the text.
PATTERNS: dict[str, str] = {
    "email": r"(?<![\p{L}\d._+\-])[\p{L}\d._+\-]++@[\p{L}\d\-]++(?:\.[\p{L}\d\-]++){1,12}+",
    "secret": rf"{_KEYWORD}[A-Za-z\d_+/\-]{{8,}}+"
    r"|(?<![A-Za-z\d])(?:(?=[a-f]{0,127}\d)[\da-f]{32,128}+|(?=[A-F]{0,127}\d)[\dA-F]{32,128}+)(?![A-Za-z\d])",
    "iban": r"(?<![A-Za-z\d])[A-Z]{2}\d{2}(?: ?[A-Z\d]{4}){3,7}(?: ?[A-Z\d]{1,3})?(?![A-Za-z\d])",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "card": r"(?<![\d])(?:\d{4}[ \-]\d{4}[ \-]\d{4}[ \-]\d{1,7}|\d{4}[ \-]\d{6}[ \-]\d{5}|\d{13,19})(?!\d)",
    "phone": r"(?<![\p{L}\d])(?:\+(?=(?:[ .\-()]{0,2}\d){7})\d{1,3}[ .\-]?(?:\(\d{1,5}\)|\d{1,5})(?:[ .\-]?\d{2,5}){1,4}|\+\d{8,15}"
    r"|\(\d{3}\) ?\d{3}[ .\-]\d{4}|\d{3}[.\-]\d{3}[.\-]\d{4})(?!\d)",
    "name": rf"(?<![\p{{L}}])(?:(?:{MALE_TITLES}|{FEMALE_TITLES}|Dr|Prof|{CYRILLIC_TITLES})\.? )\p{{Lu}}[\p{{L}}'\-]++(?: \p{{Lu}}[\p{{L}}'\-]++){{0,2}}",
}


def _any_of(*kinds: str) -> str:
    return "|".join(f"(?:{PATTERNS[k]})" for k in kinds)


#: What must be in a text for some pattern to match, as plain searches, and the pattern to use then. A
#: pattern that cannot match is left out, which changes nothing but the time.
TITLES = re.findall(r"[^\W\d_][\w\-]*", "|".join((MALE_TITLES, FEMALE_TITLES, "Dr", "Prof", CYRILLIC_TITLES)))
WITHOUT_MAIL = _any_of(*(k for k in PATTERNS if k != "email"))
ANY = _any_of(*PATTERNS)


def may_hold(text: Column) -> Column:
    """Whether a text has what some pattern needs: an at sign, a digit, a keyword's sign or a title."""
    signs = [text.contains(sign) for sign in ("@", "=", ":")]
    titles = [text.contains(f"{t}{end}") for t in TITLES for end in (" ", ". ")]
    return F.coalesce(reduce(operator.or_, [*signs, text.rlike("[0-9]"), *titles]), F.lit(False))


#: Given names by gender and script for surrogates.
GIVEN = {
    ("f", "latin"): ("Alma", "Berta", "Clara", "Dora", "Edith", "Flora", "Greta", "Helga", "Irma", "Julia", "Karin", "Lydia"),
    ("m", "latin"): ("Anton", "Bruno", "Conrad", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Louis"),
    ("n", "latin"): ("Alex", "Charlie", "Dominique", "Eden", "Kim", "Lou", "Marion", "Noa", "Robin", "Sasha", "Toni", "Val"),
    ("f", "cyrillic"): ("Анна", "Вера", "Дарья", "Елена", "Зоя", "Ирина", "Лидия", "Мария", "Нина", "Ольга", "Раиса", "Софья"),
    ("m", "cyrillic"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Лев", "Максим", "Олег", "Павел"),
}
SYLLABLES = {
    "latin": ("ba", "den", "fer", "gol", "han", "kel", "lin", "mar", "nor", "per", "ros", "sen", "tal", "ven", "wick", "zer"),
    "cyrillic": ("ба", "ве", "гор", "дан", "жел", "зо", "ка", "ла", "мир", "но", "пет", "ров", "сол", "тим", "фед", "чер"),
}


def found(text: Column) -> Column:
    """The mentions of a text in their order."""
    every, some = (F.regexp_extract_all(text, F.lit(f"({p})"), F.lit(1)) for p in (ANY, WITHOUT_MAIL))
    return F.coalesce(F.when(text.contains("@"), every).otherwise(some), F.array().cast("array<string>"))


def between(text: Column) -> Column:
    """The parts of a text before, between and after its mentions."""
    return F.when(text.contains("@"), F.split(text, ANY, -1)).otherwise(F.split(text, WITHOUT_MAIL, -1))


def kind(mention: Column) -> Column:
    """Which pattern a mention was found by."""
    out = F.lit("secret")
    digits = F.length(F.regexp_replace(mention, r"\D", ""))
    tests = [
        ("email", mention.contains("@")),
        ("name", mention.rlike(rf"^(?:{MALE_TITLES}|{FEMALE_TITLES}|Dr|Prof|{CYRILLIC_TITLES})\.? \p{{Lu}}")),
        ("ip", mention.rlike(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$")),
        ("ssn", mention.rlike(r"^\d{3}-\d{2}-\d{4}$")),
        ("phone", mention.rlike(r"^[+(]|^\d{3}[.\-]\d{3}[.\-]\d{4}$")),
        ("card", mention.rlike(r"^\d[\d \-]*$") & (digits <= 19)),
        ("iban", mention.rlike(rf"^(?:{PATTERNS['iban']})$")),
    ]
    for name, test in reversed(tests):
        out = F.when(test, name).otherwise(out)
    return out


def title(mention: Column) -> Column:
    """The part of a name or secret that stays: its title, or its keyword."""
    return F.regexp_extract(mention, rf"^(\S+ (?=\p{{Lu}})|{_KEYWORD})", 1)


def gender(mention: Column) -> Column:
    """f or m by a name's title, empty where it does not say."""
    female, male = title(mention).rlike(rf"^(?:{FEMALE_TITLES}|г-жа|госпожа)\b"), title(mention).rlike(rf"^(?:{MALE_TITLES}|г-н|господин)\b")
    return F.when(female, "f").when(male, "m").otherwise("")


def entity(mention: Column, what: Column) -> Column:
    """What all writings of one entity, other than a name, have in common."""
    plain = F.regexp_replace(mention, r"[^\p{L}\d]", "")
    own = F.substr(mention, F.length(title(mention)) + 1)
    return (
        F.when(what == "email", F.lower(mention))
        .when(what == "ip", mention)
        .when(what == "secret", own)
        .otherwise(plain)
    )


def _like(value: Column, stream: Column, keep: int | Column = 0, hexadecimal: bool | Column = False) -> Column:
    """Every letter and digit replaced by one of its kind; `keep` leading characters stay."""
    hexadecimal = hexadecimal if isinstance(hexadecimal, Column) else F.lit(hexadecimal)
    keep = keep if isinstance(keep, Column) else F.lit(keep)

    def one(c: Column, i: Column) -> Column:
        number = F.conv(F.substr(stream, i * 2 + 1, F.lit(2)), 16, 10).cast("int")
        letter = F.substr(F.lit("abcdefghijklmnopqrstuvwxyz"), number % 26 + 1, F.lit(1))
        sixteen = F.substr(F.lit("0123456789abcdef"), number % 16 + 1, F.lit(1))
        digit = (number % 10).cast("string")
        cyrillic = F.substr(F.lit("абвгдежзиклмнопрстуф"), number % 20 + 1, F.lit(1))
        plain = (
            F.when(i < keep, c)
            .when(hexadecimal & c.rlike(r"[\da-fA-F]"), sixteen)
            .when(c.rlike(r"\d"), digit)
            .when(c.rlike(r"\p{IsCyrillic}"), cyrillic)
            .when(c.rlike(r"\p{L}"), letter)
            .otherwise(c)
        )
        return F.when((i >= keep) & c.rlike(r"\p{Lu}"), F.upper(plain)).otherwise(plain)

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _luhn(digits: Column) -> Column:
    """Sum of the Luhn rule over a string of digits, the last one counted single."""
    numbers = F.transform(F.reverse(F.split(digits, "")), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)
    ))
    return F.aggregate(numbers, F.lit(0), lambda a, b: a + b)


def _stream(key: str, what: Column, name: Column, attempt: Column, length: int = 8) -> Column:
    """Keyed hex digits: `length` blocks of 64."""
    parts = [F.sha2(F.concat_ws("|", F.lit(key), what, attempt.cast("string"), F.lit(str(i)), name), 256) for i in range(length)]
    return F.concat(*parts)


def surrogate(what: Column, name: Column, attempt: Column, key: str) -> Column:
    """The surrogate of an entity, in the entity's own normal form."""
    stream = _stream(key, what, name, attempt)
    local, domain = F.split_part(name, F.lit("@"), F.lit(1)), F.substr(stream, F.lit(500), F.lit(8))
    email = F.concat(_like(local, stream), F.lit("@m"), domain, F.lit(".example.org"))
    octets = [(F.conv(F.substr(stream, F.lit(4 * i + 1), F.lit(4)), 16, 10).cast("int") % 254 + 1).cast("string") for i in range(4)]
    body = _like(F.substr(name, F.lit(1), F.length(name) - 1), stream, 1)
    with_check = F.concat(body, ((10 - _luhn(F.concat(body, F.lit("0"))) % 10) % 10).cast("string"))
    card = F.when(_luhn(name) % 10 == 0, with_check).otherwise(_like(name, stream, 1))
    iban = _like(name, stream, 4)
    phone = _like(name, stream, F.greatest(F.lit(0), F.least(F.length(name) - 9, F.lit(3))))
    script = F.when(name.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")
    gender = F.substr(name, F.lit(1), F.lit(1))

    def number(at: int) -> Column:
        return F.conv(F.substr(stream, F.lit(at), F.lit(6)), 16, 10).cast("int")

    def pick(values: tuple[str, ...], at: int) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), number(at) % len(values) + 1)

    given, family = F.lit(None).cast("string"), F.lit(None).cast("string")
    for (g, s), names in GIVEN.items():
        given = F.when((gender == g) & (script == s), pick(names, 1)).otherwise(given)
    for s, parts in SYLLABLES.items():
        family = F.when(script == s, F.initcap(F.concat(*(pick(parts, 7 + 6 * i) for i in range(5))))).otherwise(family)
    # A given name of the list, then two of them, then one with a made-up ending.
    more = F.lit(None).cast("string")
    for (g, s), names in GIVEN.items():
        more = F.when((gender == g) & (script == s), pick(names, 60)).otherwise(more)
    ending = F.lit(None).cast("string")
    for s, parts in SYLLABLES.items():
        ending = F.when(script == s, F.concat(*(pick(parts, 70 + 6 * i) for i in range(3)))).otherwise(ending)
    given = F.when(attempt == 0, given).when(attempt < 4, F.concat(given, F.lit("-"), more)).otherwise(F.concat(given, ending))
    given = F.concat(gender, F.lit(":"), F.lower(given))
    hexadecimal = name.rlike(r"^[\da-f]+$|^[\dA-F]+$")
    return (
        F.when(what == "email", email)
        .when(what == "ip", F.concat_ws(".", *octets))
        .when(what == "card", card)
        .when(what == "iban", iban)
        .when(what == "given", given)
        .when(what == "family", F.lower(family))
        .when(what == "phone", phone)
        .when(what == "ssn", _like(name, stream))
        .otherwise(_like(name, stream, 0, hexadecimal))
    )


def written_as(mention: Column, what: Column, value: Column) -> Column:
    """A surrogate in the writing of a mention: its separators, title and case."""
    places = F.transform(F.split(mention, ""), lambda c: c.rlike(r"[\p{L}\d]").cast("int"))

    def one(c: Column, i: Column) -> Column:
        at = F.aggregate(F.slice(places, 1, i + 1), F.lit(0), lambda a, b: a + b)
        return F.when(c.rlike(r"[\p{L}\d]"), F.substr(value, at, F.lit(1))).otherwise(c)

    laid = F.array_join(F.transform(F.split(mention, ""), one), "")
    own = F.aggregate(places, F.lit(0), lambda a, b: a + b)
    laid = F.concat(laid, F.substr(value, own + 1))  # of a longer form
    shouted = F.upper(mention) == mention
    email = F.when(shouted & mention.rlike(r"\p{Lu}"), F.upper(value)).otherwise(value)
    secret = F.concat(title(mention), value)
    return F.when(what == "email", email).when(what == "ip", value).when(what == "secret", secret).otherwise(laid)


def word_as(word: Column, value: Column) -> Column:
    """A surrogate in the case of a name's word."""
    titled = F.array_join(F.transform(F.split(value, "-"), F.initcap), "-")
    return F.when((F.upper(word) == word) & (F.length(word) > 1), F.upper(value)).otherwise(titled)


def _strings(values) -> Column:
    """One literal, which keeps the plan small."""
    return F.split(F.lit("|".join(values)), r"\|")


DIGITS, HEX, LETTERS, CYRILLIC = "0123456789", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуф"


def _slots_like(value: Column, keep: Column, hexadecimal: Column) -> Column:
    """What `_like` may put at each place of a value."""

    def one(c: Column, i: Column) -> Column:
        plain = (
            F.when(i < keep, F.array(c))
            .when(hexadecimal & c.rlike(r"[\da-fA-F]"), _strings(HEX))
            .when(c.rlike(r"\d"), _strings(DIGITS))
            .when(c.rlike(r"\p{IsCyrillic}"), _strings(CYRILLIC))
            .when(c.rlike(r"\p{L}"), _strings(LETTERS))
            .otherwise(F.array(c))
        )
        return F.when((i >= keep) & c.rlike(r"\p{Lu}"), F.transform(plain, F.upper)).otherwise(plain)

    return F.transform(F.split(value, ""), one)


def form(what: Column, name: Column, extra: Column) -> Column:
    """The form of an entity's surrogates: what may stand at each place, a card's check digit left out.

    `extra` places more make a phone number or a name longer.
    """
    none, no = F.lit(0), F.lit(False)
    fixed = lambda text: F.array(F.array(F.lit(text)))
    repeated = lambda values, n: F.array_repeat(_strings(values), n)
    local = F.split_part(name, F.lit("@"), F.lit(1))
    email = F.concat(_slots_like(local, none, no), fixed("@m"), repeated(HEX, 8), fixed(".example.org"))
    octet = F.array(_strings(map(str, range(1, 255))))
    ip = F.concat(octet, *(x for _ in range(3) for x in (fixed("."), octet)))
    body = F.when(_luhn(name) % 10 == 0, F.substr(name, F.lit(1), F.length(name) - 1)).otherwise(name)
    kept = F.greatest(none, F.least(F.length(name) - 9, F.lit(3)))
    phone = F.concat(_slots_like(name, kept, no), repeated(DIGITS, extra))
    cyrillic, sex = name.rlike(r"\p{IsCyrillic}"), F.substr(name, F.lit(1), F.lit(1))
    given = F.array(F.array(F.lit("")))
    for (g, s), names in GIVEN.items():
        given = F.when((sex == g) & (cyrillic == F.lit(s == "cyrillic")), F.array(_strings(n.lower() for n in names))).otherwise(given)
    syllables = lambda n: F.when(cyrillic, repeated(SYLLABLES["cyrillic"], n)).otherwise(repeated(SYLLABLES["latin"], n))
    given = F.concat(F.array(F.array(F.concat(sex, F.lit(":")))), given, syllables(extra + 3))
    return (
        F.when(what == "email", email)
        .when(what == "ip", ip)
        .when(what == "card", _slots_like(body, F.lit(1), no))
        .when(what == "iban", _slots_like(name, F.lit(4), no))
        .when(what == "given", given)
        .when(what == "family", syllables(extra + 5))
        .when(what == "phone", phone)
        .when(what == "ssn", _slots_like(name, none, no))
        .otherwise(_slots_like(name, none, name.rlike(r"^[\da-f]+$|^[\dA-F]+$")))
    )


def _nth(slots: Column, number: Column) -> Column:
    """The value of a form with this number, the last place counting fastest."""

    def put(state: Column, slot: Column) -> Column:
        size = F.size(slot)
        text = F.concat(F.element_at(slot, (state["rest"] % size + 1).cast("int")), state["text"])
        return F.struct(F.floor(state["rest"] / size).cast("long").alias("rest"), text.alias("text"))

    start = F.struct(number.cast("long").alias("rest"), F.lit("").alias("text"))
    return F.aggregate(F.reverse(slots), start, put, lambda state: state["text"])


def _per_form(rows: DataFrame, order: str, name: str) -> DataFrame:
    """Rows numbered from 0 inside each form."""
    numbered = number_rows(rows, ["form", order], "_place")
    least = numbered.groupBy("form").agg(F.min("_place").alias("_least"))
    return numbered.join(least, "form").withColumn(name, F.col("_place") - F.col("_least")).drop("_place", "_least")


def ranked(spark: SparkSession, left: DataFrame, taken: DataFrame) -> DataFrame:
    """`what`, `name`, `value` for the entities of `left`: values of their forms that `taken` does not hold.

    Forms are gone through in growing stretches; the open entities and the free values of a stretch are
    numbered, and equal numbers go together. `taken` has distinct rows (`what`, `value`).
    """
    # The numbers of a form are counted in doubles, exact up to this.
    most = 1 << 50
    left = left.select("what", "name", F.lit(0).alias("extra"), F.lit(0).cast("long").alias("start"))
    out = spark.createDataFrame([], "what string, name string, value string")
    stretch = 2
    while True:
        slots = form(F.col("what"), F.col("name"), F.col("extra"))
        shaped = left.withColumn("slots", slots).withColumn("checked", (F.col("what") == "card") & (F.size("slots") < F.length("name")))
        shaped = shaped.withColumn("form", F.sha2(F.to_json(F.struct("what", "checked", "slots")), 256))
        shaped = written(spark, shaped, "open")
        if shaped.isEmpty():
            return out
        forms = shaped.groupBy("form").agg(
            F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("what", "checked", "slots", "start"))
        )
        space = F.aggregate("slots", F.lit(1.0), lambda a, s: F.least(a * F.size(s), F.lit(float(most)))).cast("long")
        forms = forms.withColumn("space", space).withColumn("end", F.least("space", F.col("start") + F.col("n") * stretch + 64))
        forms = written(spark, forms, "forms")
        # In two steps, so that no row holds a long list.
        parts = forms.where("start < end").withColumn("low", F.explode(F.sequence("start", F.col("end") - 1, F.lit(4096).cast("long"))))
        numbers = parts.withColumn("number", F.explode(F.sequence("low", F.least(F.col("low") + 4095, F.col("end") - 1))))
        check = ((10 - _luhn(F.concat("body", F.lit("0"))) % 10) % 10).cast("string")
        bodies = numbers.select("form", "what", "checked", _nth(F.col("slots"), F.col("number")).alias("body"))
        offers = bodies.select("form", "what", F.when(F.col("checked"), F.concat("body", check)).otherwise(F.col("body")).alias("value"))
        offers = offers.groupBy("what", "value").agg(F.min("form").alias("form")).join(taken, ["what", "value"], "left_anti")
        offers = written(spark, _per_form(written(spark, offers, "free").select("form", "value"), "value", "rank"), "offers")
        asking = _per_form(shaped.select("form", "what", "name", "extra"), "name", "rank")
        given = written(spark, asking.join(offers, ["form", "rank"], "left"), "ranked")
        new = given.where("value IS NOT NULL").select("what", "name", "value")
        out, taken = out.unionByName(new), taken.unionByName(new.select("what", "value"))
        still = given.where("value IS NULL").join(forms.select("form", "end", "space"), "form")
        used_up, longer = F.col("end") >= F.col("space"), F.col("what").isin("phone", "given", "family")
        if not still.where(used_up & ~longer).isEmpty():
            raise ValueError("the form of an entity is too small for distinct values: fewer of its values are free than are needed")
        left = still.select(
            "what", "name", (F.col("extra") + used_up.cast("int")).alias("extra"), F.when(used_up, 0).otherwise(F.col("end")).cast("long").alias("start")
        )
        stretch *= 2


def distinct_surrogates(spark: SparkSession, entities: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """`what`, `name`, `value` for a table of distinct entities (`what`, `name`), no two values alike.

    In each round, of the entities that share a value the smallest keeps it and the others draw again,
    as do those whose value is a real entity. Rounds only touch what met; the last open ones get free
    values by rank.
    """
    draw = surrogate(F.col("what"), F.col("name"), F.col("attempt"), key)
    entities = written(spark, entities, "entities")
    settled = written(spark, entities.withColumn("attempt", F.lit(0)).withColumn("value", draw), "surrogates")
    real = entities.select("what", F.col("name").alias("value"), F.lit(True).alias("real"))
    for turn in range(MOST_ROUNDS + 1):
        seen = settled.groupBy("what", "value").agg(F.count("*").alias("n"), F.min("name").alias("keeper"))
        met = seen.join(real, ["what", "value"], "left").where("n > 1 OR real")
        again = settled.join(met, ["what", "value"]).where("real OR name <> keeper").select("what", "name", "attempt")
        again = written(spark, again.withColumn("attempt", F.col("attempt") + 1).withColumn("value", draw), "again")
        if again.isEmpty():
            return settled.select("what", "name", "value")
        kept = settled.join(again.select("what", "name"), ["what", "name"], "left_anti")
        if turn == MOST_ROUNDS:
            break
        settled = written(spark, kept.unionByName(again.select(*settled.columns)), "surrogates")
    kept = kept.select("what", "name", "value")
    taken = kept.select("what", "value").unionByName(real.select("what", "value"))
    return kept.unionByName(ranked(spark, again, written(spark, taken.distinct(), "taken")))


def name_words(each: DataFrame) -> DataFrame:
    """`_row`, `word`, `what` (given or family), `name` and `plain` for the words of each document's names.

    A word that stands before another in some name of the document is a given name, any other a family name.
    A given name has the gender of its title, or else that of the document's other names with it. `plain`
    marks the entity that the word stands for without a title: one for each word.
    """
    own = F.substr("mention", F.length(title(F.col("mention"))) + 1)
    person = F.struct(gender(F.col("mention")).alias("gender"), F.split(F.lower(own), " ").alias("words"))
    rows = each.where("what = 'name'").groupBy("_row").agg(F.collect_set(person).alias("people"))
    # Lists of one document's names, as long as the document makes them.
    firsts = F.flatten(F.transform("people", lambda p: F.slice(p["words"], 1, F.size(p["words"]) - 1)))
    rows = rows.withColumn("given", F.array_distinct(firsts))
    lasts = F.transform("people", lambda p: F.element_at(p["words"], -1))
    rows = rows.withColumn("family", F.array_except(lasts, "given"))

    def says(word: Column, sex: str) -> Column:
        return F.exists("people", lambda p: (p["gender"] == sex) & F.array_contains(p["words"], word))

    def usual(word: Column) -> Column:
        unsaid = F.when(word.rlike(r"\p{IsCyrillic}"), "m").otherwise("n")
        return F.when(says(word, "m") & ~says(word, "f"), "m").when(says(word, "f") & ~says(word, "m"), "f").otherwise(unsaid)

    def one(word: Column, what: str, name: Column, plain: bool) -> Column:
        return F.struct(word.alias("word"), F.lit(what).alias("what"), name.alias("name"), F.lit(plain).alias("plain"))

    family = F.transform("family", lambda w: one(w, "family", w, True))
    rows = rows.withColumn("usual", F.transform("given", lambda w: one(w, "given", F.concat(usual(w), F.lit(":"), w), True)))
    titled = F.flatten(
        F.transform(
            F.filter("people", lambda p: p["gender"] != ""),
            lambda p: F.transform(F.array_intersect(p["words"], F.col("given")), lambda w: one(w, "given", F.concat(p["gender"], F.lit(":"), w), False)),
        )
    )
    more = F.filter(F.array_distinct(titled), lambda t: ~F.exists("usual", lambda u: u["name"] == t["name"]))
    return rows.select("_row", F.explode(F.concat(family, "usual", more)).alias("w")).select("_row", "w.*")


def _person(mention: Column) -> Column:
    """A titled name with the surrogates of its words, from its document's maps."""
    own = F.substr(mention, F.length(title(mention)) + 1)

    def one(word: Column) -> Column:
        usual = F.element_at(F.col("by_word"), F.lower(word))
        titled = F.try_element_at(F.col("by_name"), F.concat(gender(mention), F.lit(":"), F.lower(word)))
        value = F.when(usual["what"] == "given", F.coalesce(titled, usual["value"])).otherwise(usual["value"])
        return word_as(word, F.regexp_replace(value, r"^[fmn]:", ""))

    return F.concat(title(mention), F.array_join(F.transform(F.split(own, " "), one), " "))


#: A word that may be a name's, where no title says so.
CAPITALISED = r"(?<![\p{L}\d])\p{Lu}\p{L}*+(?:['\-]\p{L}++)*+"


def _untitled(part: Column) -> Column:
    """A part of a text between its mentions, with the surrogates of its document's names."""

    def one(word: Column) -> Column:
        bare = F.regexp_replace(word, r"'[sS]$", "")
        whole = F.try_element_at(F.col("by_word"), F.lower(word))["value"]
        owner = F.try_element_at(F.col("by_word"), F.lower(bare))["value"]
        plain = lambda value: F.regexp_replace(value, r"^[fmn]:", "")
        owned = F.concat(word_as(bare, plain(owner)), F.substr(word, F.length(bare) + 1))
        return F.coalesce(word_as(word, plain(whole)), owned, word)

    words = F.concat(F.transform(F.regexp_extract_all(part, F.lit(f"({CAPITALISED})"), F.lit(1)), one), F.array(F.lit("")))
    return F.array_join(F.zip_with(F.split(part, CAPITALISED, -1), words, lambda gap, word: F.concat(gap, word)), "")


def with_surrogates(spark: SparkSession, docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """`row` (the document), `mentions` (kind, original, surrogate, in their order) and the new `text`."""
    text = F.col("text").cast("string")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), text.alias("text"), F.col("doc_id").cast("string").alias("_id"))
    # The patterns run once, over the texts that may hold a mention; the others pass by.
    suspects = written(spark, rows.where(may_hold(F.col("text"))).withColumn("found", found(F.col("text"))), "suspects")
    name = F.sha2(F.concat_ws("|", F.coalesce("_id", F.lit("null")), F.col("text")), 256)
    held = suspects.where(F.size("found") > 0).withColumn("_row", name)
    each = held.select("_row", F.posexplode("found").alias("at", "mention"))
    each = each.withColumn("what", kind(F.col("mention"))).withColumn("name", entity(F.col("mention"), F.col("what")))
    each = written(spark, each.distinct(), "mentions")
    words = written(spark, name_words(each), "name-words")
    entities = each.where("what <> 'name'").select("what", "name").unionByName(words.select("what", "name"))
    known = distinct_surrogates(spark, entities.distinct(), key)
    made = each.where("what <> 'name'").join(known, ["what", "name"]).withColumn("made", written_as(F.col("mention"), F.col("what"), F.col("value")))
    valued = words.join(known, ["what", "name"])
    entry = F.struct("what", "name", "value")
    maps = valued.groupBy("_row").agg(
        F.map_from_entries(F.collect_set(F.struct("name", "value"))).alias("by_name"),
        F.map_from_entries(F.collect_list(F.when(F.col("plain"), F.struct(F.col("word"), entry)))).alias("by_word"),
    )
    maps = written(spark, maps, "names")
    people = each.where("what = 'name'").join(maps, "_row").withColumn("made", _person(F.col("mention")))
    columns = ["_row", "at", "what", "mention", "made"]
    every = made.select(*columns).unionByName(people.select(*columns))
    lists = every.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("at", "what", "mention", "made"))).alias("mentions"))
    joined = held.join(lists, "_row").join(maps.select("_row", "by_word"), "_row", "left")
    ends = F.concat(F.transform("mentions", lambda m: m["made"]), F.array(F.lit("")))
    parts = F.when(F.col("by_word").isNull(), between(F.col("text"))).otherwise(F.transform(between(F.col("text")), _untitled))
    new = F.array_join(F.zip_with(parts, ends, lambda p, e: F.concat(p, e)), "")
    changed = joined.select("row", "mentions", new.alias("text"))
    none = F.array().cast(changed.schema["mentions"].dataType).alias("mentions")
    clean = suspects.where(F.size("found") == 0).select("row", none, "text")
    others = rows.where(~may_hold(F.col("text"))).select("row", none, "text")
    return changed.unionByName(clean).unionByName(others)


def replaced(spark: SparkSession, docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """The documents with all personal data replaced, with their columns."""
    out = with_surrogates(spark, docs, key)
    return out.select(*(F.col("text").alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns))
