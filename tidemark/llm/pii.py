"""PII surrogates with DataFrame functions alone (operator 6).

Detected: e-mail addresses, phone numbers (also international ones), IPv4 and IPv6 addresses, IBANs, numbers of 13 to
19 digits (cards, accounts), numbers like 123-45-6789, and names after a title, also in capitals. A name's parts are entities of their own, so that a
surname alone and in a full name get one surrogate (coreference).

Surrogates: a keyed digest of kind and normalized value fills a pattern of the same type: digits stay
digits in the mention's format (a valid check digit stays valid), an address keeps its number of labels and
ends in the reserved ``example``, an IPv4 address goes to 10.0.0.0/8, an IPv6 address to 2001:db8::/32, an IBAN keeps its
country and stays valid, a name is built from syllables of its
script with an ending of its gender, in the mention's case.

Collision checks: over the distinct entities of the whole corpus, two entities with one surrogate, or a
surrogate that is itself an entity of its kind, make all but the least entity take the next digest, until
there is none. From the fourth digest on, a surrogate grows with each further one (letters before an address,
syllables of a name, a port or an extension behind numbers), so there are always more surrogates than
entities and the rounds end. Mentions then join the entity table; only texts with mentions are shuffled.

Nulls and edge cases: a null text stays null with 0 entities; repeated rows and null ids each get a result;
texts are scanned whole. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, table

KEY = "surrogates"
#: from this attempt on, each further one makes the surrogate longer
WIDER = 4

# fixed values: titles and the gender they tell
TITLES = {
    "m": ["Mr", "Herr", "Señor", "Monsieur", "Господин", "Κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Mme", "Госпожа", "Κυρία"],
    "n": ["Dr", "Prof"],
}
# fixed values: syllables by script, then endings by script, part and gender
SYLLABLES = {
    "latin": "ba be bo da de di ga go la le li lo ma me mi mo na ne ni no ra re ri ro sa se so ta te ti va vi".split(),
    "cyrillic": "ба бе бо да де ди га го ла ле ли ло ма ме ми мо на не ни но ра ре ри ро са се со та те ти ва ви".split(),
    "greek": "βα βε βο δα δε δι γα γο λα λε λι λο μα με μι μο να νε νι νο ρα ρε ρι ρο σα σε σο τα τε τι κα κι".split(),
}
ENDINGS = {
    ("latin", "given"): {"m": "rd", "f": "na", "n": "s"}, ("latin", "surname"): {"m": "n", "f": "n", "n": "n"},
    ("cyrillic", "given"): {"m": "слав", "f": "на", "n": "й"}, ("cyrillic", "surname"): {"m": "ков", "f": "кова", "n": "к"},
    ("greek", "given"): {"m": "ς", "f": "νη", "n": "ν"}, ("greek", "surname"): {"m": "κος", "f": "κου", "n": "κο"},
}

_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_IP = r"(?=\d)(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d)"
# each alternative first looks at the next character, so that it fails at once almost everywhere
_IP6 = (r"(?=[0-9A-Fa-f]{1,4}:)(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=(?:[0-9A-Fa-f]{0,4}:){3,7}[0-9A-Fa-f]{0,4}(?![\w:]))"
        r"(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:])")
_IBAN = r"(?=[A-Z]{2}\d)(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:(?: \d{4}){3,7}(?: \d{1,3})?|\d{11,30})(?![A-Za-z0-9])"
_ABROAD = r"\+(?<![\w+]\+)\d{1,3}(?:[ .-]\(?\d{1,12}\)?){1,5}(?![\w])"
_PHONE = r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w])"
_NUMBER = r"(?=\d)(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-]|\.\d)"
_ID = r"(?=\d)(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
_NAME = r"\p{Lu}[\p{L}'’-]*\p{L}"
_PERSON = r"(?=\p{Lu})(?<!\p{L})(?:%s)\.? %s(?: %s)?(?!\p{L})" % ("|".join(f"{t}|{t.upper()}" for ts in TITLES.values() for t in ts), _NAME, _NAME)
MENTION = "|".join((_EMAIL, _IP6, _IP, _PHONE, _IBAN, _NUMBER, _ID, _ABROAD, _PERSON))
_PART = "struct<text:string,kind:string>"


def _parts(m: Column) -> Column:
    """A mention as parts (text, kind): literal parts have no kind."""
    def part(text: Column, kind: Column) -> Column:
        return F.struct(text.alias("text"), kind.cast("string").alias("kind"))

    digits = F.length(F.regexp_replace(m, r"\D", ""))
    name = F.regexp_extract(m, rf"^(\p{{L}}+\.? )({_NAME})(?: ({_NAME}))?$", 0)
    title, one, two = (F.regexp_extract(name, rf"^(\p{{L}}+\.? )({_NAME})(?: ({_NAME}))?$", g) for g in (1, 2, 3))
    gender = F.when(title.rlike(f"^(?iu:{'|'.join(TITLES['m'])})(?!\\p{{L}})"), "m").when(
        title.rlike(f"^(?iu:{'|'.join(TITLES['n'])})(?!\\p{{L}})"), "n").otherwise("f")

    def of(text: Column, kind: str) -> Column:
        script = F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").when(text.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
        # Latin surnames are one for all genders
        told = F.when(script == "latin", "n").otherwise(gender) if kind == "surname" else gender
        return part(text, F.concat_ws(".", F.lit(kind), told, script))

    plain = (F.when(m.contains("@"), "email").when(m.rlike(r"^[0-9A-Fa-f]*:[0-9A-Fa-f:]*$"), "ip6")
             .when(m.rlike(r"^[A-Z]{2}\d{2}"), "iban").when(m.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), "ip")
             .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "id").when(digits >= 13, F.when(m.startswith("+"), "phone").otherwise("number"))
             .otherwise("phone"))
    literal = F.lit(None)
    # other international numbers: 8 digits at least, two of them the country's
    usual = m.rlike(r"^(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}$")
    plain = F.when(m.startswith("+") & ~usual, F.when(digits >= 8, "phone+")).otherwise(plain)
    return F.when((name == "") | m.contains("@"), F.array(part(m, plain))).when(
        two == "", F.array(part(title, literal), of(one, "surname"))).otherwise(
        F.array(part(title, literal), of(one, "given"), part(F.lit(" "), literal), of(two, "surname")))


def _normal(text: Column, kind: Column) -> Column:
    """What makes two mentions one entity: digits alone, or lower case."""
    return F.when(kind.isin("phone", "phone+", "number", "id"), F.regexp_replace(text, r"\D", "")).when(
        kind == "iban", F.replace(text, F.lit(" "), F.lit(""))).otherwise(F.lower(text))


def _byte(digest: Column, i: Column) -> Column:
    """The i-th (from 0) of 64 keyed bytes, as int."""
    return F.conv(F.substr(digest, F.pmod(i, F.lit(64)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _check_digit(digits: Column) -> Column:
    """Check digit that makes ``digits`` and it valid (every second digit from the right doubled)."""
    back = F.split(F.reverse(digits), "")
    total = F.aggregate(F.transform(back, lambda c, i: F.when(
        i % 2 == 0, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(
        c.cast("int"))), F.lit(0), lambda a, b: a + b)
    return F.pmod(F.lit(10) - F.pmod(total, F.lit(10)), F.lit(10)).cast("string")


def _pick(values: list[str], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (n % len(values)) + 1)


def surrogate(kind: Column, value: Column, attempt: Column, key: str = KEY) -> Column:
    """Surrogate (normalized) of an entity; expects a column ``digest`` of 128 hex digits, see ``_digests``."""
    digest = F.col("digest")

    def digit(c: Column, i: Column) -> Column:
        return F.when((i == 0) & (c != "0"), _byte(digest, i) % 9 + 1).otherwise(_byte(digest, i) % 10).cast("string")

    numbers = F.array_join(F.transform(F.split(value, ""), digit), "")
    body = F.concat(F.substr(value, F.lit(1), F.lit(1)), F.substr(numbers, F.lit(2), F.length(value) - 2))
    valid = _check_digit(F.substr(value, F.lit(1), F.length(value) - 1)) == F.substr(value, F.length(value), F.lit(1))
    card = F.when(valid, F.concat(body, _check_digit(body))).otherwise(F.concat(body, F.substr(numbers, F.length(value), F.lit(1))))
    wider = F.greatest(attempt - (WIDER - 1), F.lit(0))
    more_digits = F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(wider, F.lit(1))), lambda i: (
        _byte(digest, F.lit(40) + i) % 9 + 1).cast("string")), "")
    card, numbers = (F.when(wider > 0, F.concat(x, more_digits)).otherwise(x) for x in (card, numbers))
    ip = F.concat_ws(".", F.lit("10"), *[_byte(digest, F.lit(i)).cast("string") for i in range(3)])
    ip = F.when(wider > 0, F.concat(ip, F.lit(":"), more_digits)).otherwise(ip)
    groups = [F.lower(F.lpad(F.hex(_byte(digest, F.lit(2 * i)) * 256 + _byte(digest, F.lit(2 * i + 1))), 4, "0")) for i in range(6)]
    ip6 = F.concat_ws(":", F.lit("2001:db8"), *groups)
    # country and length stay; two check digits make the rest valid (remainders digit by digit, letters as two digits)
    country = F.substr(value, F.lit(1), F.lit(2))
    account = F.substr(numbers, F.lit(5), F.length(value) - 4)
    told = F.concat(*[(F.ascii(F.substr(country, F.lit(i), F.lit(1))) - 55).cast("string") for i in (1, 2)])
    rest = F.aggregate(F.split(F.concat(account, told, F.lit("00")), ""), F.lit(0), lambda a, c: F.pmod(a * 10 + c.cast("int"), F.lit(97)))
    iban = F.concat(country, F.lpad((F.lit(98) - rest).cast("string"), 2, "0"), account)

    def letter(c: Column, i: Column) -> Column:
        return (F.when(c.rlike("[a-z]"), F.char(_byte(digest, i) % 26 + 97))
                .when(c.rlike("[0-9]"), (_byte(digest, i) % 10).cast("string")).otherwise(c))

    stem = F.regexp_extract(value, r"^(.*\.)[^.]*$", 1)
    more_letters = F.when(wider > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(wider, F.lit(1))), lambda i: F.char(
        _byte(digest, F.lit(20) + i) % 26 + 97)), "")).otherwise("")
    email = F.concat(more_letters, F.array_join(F.transform(F.split(stem, ""), letter), ""), F.lit("example"))
    area = F.when(kind == "phone+", 2).otherwise(F.greatest(F.length(value) - 10, F.lit(0)))  # the country's digits stay
    phone = F.concat(F.substr(value, F.lit(1), area), F.substr(numbers, area + 1))
    out = F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "number", card).when(
        kind.isin("phone", "phone+"), phone).when(kind == "id", numbers).when(kind == "ip6", ip6).when(kind == "iban", iban)
    for script, syllables in SYLLABLES.items():
        stem = F.initcap(F.concat(*[_pick(syllables, _byte(digest, F.lit(i))) for i in range(4)]))
        more = F.when(wider > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(wider, F.lit(1))), lambda i: _pick(
            syllables, _byte(digest, F.lit(4) + i))), "")).otherwise("")
        for part in ("given", "surname"):
            for gender, ending in ENDINGS[script, part].items():
                out = out.when(kind == f"{part}.{gender}.{script}", F.lower(F.concat(stem, more, F.lit(ending))))
    return out


def _digests(entities: DataFrame, key: str) -> DataFrame:
    seed = F.concat_ws("\x00", F.lit(key), "kind", "value", F.col("attempt").cast("string"))
    return entities.withColumn("digest", F.concat(F.sha2(F.concat(seed, F.lit("0")), 256), F.sha2(F.concat(seed, F.lit("1")), 256)))


def entity_table(mentions: DataFrame, scratch: Scratch, key: str = KEY) -> DataFrame:
    """(kind, value, surrogate) of the distinct entities of ``mentions`` (kind, value), without collisions."""
    entities = mentions.distinct().withColumn("attempt", F.lit(0))
    while True:  # surrogates grow, see above
        made = _digests(entities, key).withColumn("surrogate", surrogate(F.col("kind"), F.col("value"), F.col("attempt"), key))
        made = scratch.write(made.drop("digest"), "entities")
        family = F.regexp_extract("kind", r"^([a-z]+)", 1)  # a surname never becomes another entity's surname
        shared = made.groupBy(family.alias("family"), "surrogate").agg(
            F.min(F.struct("kind", "value")).alias("winner"), F.count("*").alias("n")).where("n > 1")
        real = made.select(family.alias("family"), F.col("value").alias("surrogate")).distinct()
        lost = (made.withColumn("family", family).join(shared.select("family", "surrogate", "winner"), ["family", "surrogate"])
                .where(F.struct("kind", "value") != F.col("winner")).select("kind", "value"))
        taken = made.withColumn("family", family).join(real, ["family", "surrogate"], "left_semi").select("kind", "value")
        losers = scratch.write(lost.unionByName(taken).distinct(), "losers")
        if losers.isEmpty():
            return made.select("kind", "value", "surrogate")
        entities = scratch.write(made.select("kind", "value", "attempt").join(
            losers.withColumn("again", F.lit(1)), ["kind", "value"], "left").select(
            "kind", "value", (F.col("attempt") + F.coalesce("again", F.lit(0))).alias("attempt")), "attempts")


def _formatted(text: Column, kind: Column, new: Column) -> Column:
    """The surrogate in the format of the mention."""
    filled = F.array_join(F.transform(F.split(text, ""), lambda c, i: F.when(
        c.rlike("[0-9]"), F.substr(new, F.length(F.regexp_replace(F.substr(text, F.lit(1), i + 1), r"\D", "")), F.lit(1))
    ).otherwise(c)), "")
    held = F.length(F.regexp_replace(text, r"\D", ""))
    filled = F.when(F.length(new) > held, F.concat(filled, F.lit("x"), F.substr(new, held + 1))).otherwise(filled)
    cased = F.when(text == F.upper(text), F.upper(new)).when(kind.contains("."), F.initcap(new)).otherwise(new)
    spaced = F.when(text.contains(" "), F.rtrim(F.regexp_replace(new, "(.{4})", "$1 "))).otherwise(new)
    return F.when(kind.isin("phone", "phone+", "number", "id"), filled).when(kind == "ip", new).when(kind == "iban", spaced).otherwise(cased)


def pseudonymized(docs: DataFrame, key: str = KEY) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, text with surrogates, n_entities (long, mentions'
    entity parts), kinds (distinct, sorted)."""
    scratch = Scratch(docs.sparkSession, "pii")
    text = F.col("text")
    docs = docs.select("doc_id", "text")
    has = F.coalesce(text.rlike(MENTION), F.lit(False))
    found = docs.where(has).withColumn("mentions", F.regexp_extract_all(text, F.lit(MENTION), F.lit(0)))
    # gap, mention, gap, ...: the gaps are one more
    pieces = F.flatten(F.zip_with(F.split(text, MENTION, -1), F.transform("mentions", _parts), lambda gap, parts: F.concat(
        F.array(F.struct(gap.alias("text"), F.lit(None).cast("string").alias("kind"))),
        F.coalesce(parts, F.array().cast(f"array<{_PART}>")))))
    found = scratch.write(found.select(F.monotonically_increasing_id().alias("row"), "doc_id", pieces.alias("pieces")), "found")
    parts = found.select("row", "doc_id", F.posexplode("pieces").alias("at", "part")).select(
        "row", "doc_id", "at", "part.text", "part.kind").withColumn("value", F.when(
            F.col("kind").isNotNull(), _normal(F.col("text"), F.col("kind"))))
    entities = entity_table(parts.where("kind is not null").select("kind", "value"), scratch, key)
    named = parts.where("kind is not null").join(entities, ["kind", "value"])
    named = named.withColumn("text", _formatted(F.col("text"), F.col("kind"), F.col("surrogate")))
    columns = ["row", "doc_id", "at", "text", "kind"]
    whole = parts.where("kind is null").select(*columns).unionByName(named.select(*columns))
    # a group is one text
    rebuilt = whole.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct("at", "text"))).alias("parts"),
        F.count("kind").alias("n_entities"), F.array_sort(F.collect_set(F.regexp_extract("kind", "^([a-z]+)", 1))).alias("kinds"))
    rebuilt = rebuilt.select("doc_id", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"),
                             "n_entities", F.array_join("kinds", ",").alias("kinds"))
    rest = docs.where(~has).select("doc_id", "text", F.lit(0).cast("long").alias("n_entities"), F.lit("").alias("kinds"))
    return rest.unionByName(rebuilt)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymized(table(spark, sf_dir, "documents"))
