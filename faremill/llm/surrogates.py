"""Personal data replaced by surrogates of the same kind, in DataFrame functions only.

Entities are found by patterns: mail addresses, network addresses, phone, card, bank and
social-security numbers, secrets, and names: the whole run of capitalised words and initials
after a title or a known given name. What such a name is made of is also replaced where it stands
alone in the same document. A name that nowhere in its document follows a title or a known given
name is not found. The values are gathered once per corpus, not per document. Each gets a surrogate from a hash keyed by a
secret: the same value always gets the same one, in whatever spelling it stands, and so do the
parts of a name, so that who is meant stays clear. Surrogates keep the format: separators, length,
script and case, country and network prefixes, valid check digits, the gender of given names.

An initial becomes the next letter of its alphabet in an order drawn by the key: different
initials stay different and none stays as it is, after a title or before a bare mention of a
surname alike. It is not tied to the given name that it may stand for.

Collisions are checked against the whole corpus: a surrogate that equals a real value, or that
two values drew, is drawn again for all but one, until every value has its own.
"""

from __future__ import annotations

import functools
import hmac
import sys
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import written

ROUNDS = 40
WIDEN_AFTER = 6
GIVEN_ROUNDS = 3
# Different values are dealt to tasks of this many.
TASK_VALUES = 10_000

# Given names by script and gender, titles by gender, what may stand within a name, and syllables for surnames.
GIVEN = {
    ("latin", "f"): ["Alice", "Amelia", "Anna", "Carmen", "Charlotte", "Clara", "Elena", "Emily", "Emma", "Hannah", "Isabel",
                     "Julia", "Laura", "Louise", "Maria", "Marie", "Martha", "Olivia", "Sarah", "Sophie"],
    ("latin", "m"): ["Alexander", "Andrew", "Carlos", "Charles", "Daniel", "David", "Felix", "George", "Henry", "James", "John",
                     "Karl", "Lucas", "Martin", "Michael", "Paul", "Peter", "Robert", "Thomas", "William"],
    ("cyrillic", "f"): ["Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга"],
    ("cyrillic", "m"): ["Алексей", "Борис", "Виктор", "Дмитрий", "Иван", "Михаил", "Павел", "Сергей"],
}
TITLES = {"m": ["Mr", "Herr", "Sr"], "f": ["Mrs", "Ms", "Miss", "Frau", "Mme", "Sra"], "": ["Dr", "Prof"]}
PARTICLES = ["al", "bin", "da", "de", "del", "della", "den", "der", "di", "dos", "du", "el", "ibn", "la", "le", "ten", "ter", "van", "von", "zu"]
SYLLABLES = {
    "latin": ["bar", "cor", "dal", "fen", "gar", "hol", "kin", "lor", "mar", "nel", "pel", "ros", "sal", "tor", "vel", "wen"],
    "cyrillic": ["бар", "вор", "гал", "дем", "жур", "зим", "кор", "лаг", "мос", "нил", "пет", "рог", "сав", "тур", "фом", "хар"],
}
PLAIN = ["AZ", "ΑΩ", "АЯ"]
LETTERS = {
    "[a-z]": "abcdefghijklmnopqrstuvwxyz", "[A-Z]": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "[0-9]": "0123456789",
    r"[\p{IsCyrillic}&&\p{Ll}]": "абвгдежзийклмнопрстуфхцчшщъыьэюя", r"[\p{IsCyrillic}&&\p{Lu}]": "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
    r"[\p{IsGreek}&&\p{Ll}]": "αβγδεζηθικλμνξοπρστυφχψω", r"\p{Lu}": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", r"\p{L}": "abcdefghijklmnopqrstuvwxyz",
}

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
PATTERNS = {
    "mail": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]+(?:\.[\p{L}\p{N}\-]+)*\.\p{L}{2,}(?![\p{L}\p{N}])",
    "secret": r"(?<![\p{L}\p{N}])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128}|AKIA[0-9A-Z]{16})(?![\p{L}\p{N}])",
    "ip6": r"(?<![\p{L}\p{N}:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\p{L}\p{N}:])",
    "ip4": rf"(?<![\p{{L}}\p{{N}}.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\p{{L}}\p{{N}}]|\.[0-9])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ssn": r"(?<![\p{L}\p{N}\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}\-])",
    "phone": (r"(?<![\p{L}\p{N}+])(?:\+[0-9]{1,3}[ .\-]?(?:\([0-9]{1,5}\)[ .\-]?)?[0-9]{2,5}(?:[ .\-]?[0-9]{2,5}){1,4}"
              r"|\([0-9]{2,5}\)[ .\-]?[0-9]{3,4}[ .\-]?[0-9]{3,5}|[0-9]{3}[.\-][0-9]{3}[.\-][0-9]{4})(?![\p{L}\p{N}])"),
    "card": r"(?<![\p{L}\p{N}.\-])[0-9](?:[ \-]?[0-9]){12,18}(?![\p{L}\p{N}]|-[0-9])",
}
_ALL_GIVEN = [n for names in GIVEN.values() for n in names]
_TITLE = "|".join(t for titles in TITLES.values() for t in titles)
_GAP = r"[ \t\xa0]+"
# A word of a name: no title, with hyphens and apostrophes, without the ending of a possessive.
_WORD = (rf"(?!(?:{_TITLE})(?![\p{{L}}\p{{M}}]))\p{{Lu}}(?:[\p{{L}}\p{{M}}]+|['’]\p{{Lu}}[\p{{L}}\p{{M}}]+)"
         r"(?:(?:-|['’](?![sS](?![\p{L}\p{M}])))[\p{L}\p{M}]+)*")
_INITIALS = r"\p{Lu}\.(?:-?\p{Lu}\.)*"
_TITLED = rf"(?:(?:{_TITLE})\.?{_GAP})+"
# Loops over words are possessive: those run without recursion, however long the run.
_LEAD = rf"(?:{_INITIALS}(?:{_GAP})?|\p{{Lu}}{_GAP}|(?:{'|'.join(PARTICLES)}){_GAP})*+"
_RUN = rf"{_LEAD}{_WORD}(?:{_GAP}{_LEAD}{_WORD})*+"
NAME = (rf"(?=\p{{Lu}})(?<![\p{{L}}\p{{N}}])(?:{_TITLED}{_RUN}"
        rf"|(?:{'|'.join(_ALL_GIVEN)})(?:-\p{{Lu}}[\p{{L}}\p{{M}}]+)*{_GAP}{_RUN})")
_NAME_TOKENS = rf"{_INITIALS}|{_WORD}|[^\p{{Lu}}]+|(?s:.)"
_TEXT_TOKENS = (rf"(?<![\p{{L}}\p{{N}}])(?:{_INITIALS}(?:{_GAP})?)++(?={_WORD})"
                rf"|(?<![\p{{L}}\p{{N}}]){_WORD}(?![\p{{L}}\p{{N}}])|[^\p{{Lu}}]+|(?s:.)")
ENTITY = "|".join([*PATTERNS.values(), NAME])
_HINT = "[0-9@]"


@functools.cache
def _cycles(key: str) -> tuple[str, str]:
    """(letters, what each becomes): the capitals of every alphabet in a cycle drawn by the key, plain ones apart from accented."""
    alphabets: dict[tuple, list[str]] = {}
    for letter in filter(str.isupper, map(chr, range(sys.maxunicode + 1))):
        if unicodedata.category(letter) == "Lu":
            alphabet = unicodedata.name(letter, "").split(" ")[0]
            alphabets.setdefault((alphabet, any(first <= letter <= last for first, last in PLAIN)), []).append(letter)
    before, after = [], []
    for letters in alphabets.values():
        turned = sorted(letters, key=lambda x: hmac.digest(key.encode(), f"initial {x}".encode(), "sha256"))
        before += turned
        after += turned[1:] + turned[:1]
    return "".join(before), "".join(after)


def _turned(text: Column, key: str) -> Column:
    """Every capital as the next of its cycle."""
    return F.translate(text, *_cycles(key))


def _dealt(rows: DataFrame, values: int, *keys: str) -> DataFrame:
    """Rows over as many tasks as their number of different values needs; left alone, narrow rows are all merged into one."""
    return rows.repartition(-(-values // TASK_VALUES) or 1, *keys)


def entities_in(text: Column) -> Column:
    """The entities of a text in order, as they stand. Texts that can hold none are only skimmed."""
    return F.when(text.rlike(_HINT) | text.rlike(NAME), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _digits(raw: Column) -> Column:
    return F.regexp_replace(raw, "[^0-9]", "")


def _kind(raw: Column) -> Column:
    """The first pattern that covers the whole of what was found."""
    kind = F.lit("name")
    for name, pattern in reversed(PATTERNS.items()):
        kind = F.when(raw.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(kind)
    return kind


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).otherwise(F.lit("latin"))


def _surname_value(surname: Column) -> Column:
    """A surname without case and, in Cyrillic, without the ending of a woman's form."""
    low = F.lower(surname)
    return F.when(low.rlike("(?:ов|ев|ин)а$"), F.regexp_replace(low, "а$", "")).otherwise(low)


def _parts(raw: Column) -> Column:
    """The tokens of a name as (token, kind, value, gender): given, name, initial, or neither (title, space, particle)."""
    title = F.regexp_extract(raw, f"^({_TITLED})", 1)
    tokens = F.regexp_extract_all(F.substr(raw, F.length(title) + 1, F.length(raw)), F.lit(_NAME_TOKENS), F.lit(0))
    is_word = lambda t: t.rlike(f"^(?:{_WORD})$")
    titled = F.lit(None).cast("string")
    for gender in ("m", "f"):
        titled = F.when(title.rlike(rf"(?<!\p{{L}})(?:{'|'.join(TITLES[gender])})(?!\p{{L}})"), F.lit(gender)).otherwise(titled)
    listed = F.create_map(*(F.lit(x) for (_, gender), names in GIVEN.items() for n in names for x in (n.lower(), gender)))

    def part(cut: Column):
        words, first = cut["words"], cut["first"]

        def one(t: Column, i: Column) -> Column:
            known = F.element_at(listed, F.substring_index(F.lower(t), "-", 1))
            foremost = (i + 1 == first) & (first < F.size(words))
            kind = (F.when(~is_word(t), F.when(t.rlike(r"^\p{Lu}"), "initial"))
                    .when((i + 1 < F.size(words)) & F.lower(t).isin(PARTICLES), None)
                    .when(known.isNotNull() | foremost, "given").otherwise("name"))
            return F.struct(t.alias("token"), kind.alias("kind"),
                            F.when(kind == "given", F.lower(t)).when(kind == "name", _surname_value(t)).alias("value"),
                            F.when(kind == "given", F.coalesce(known, F.when(foremost, titled))).alias("gender"))

        return F.transform(words, one)

    # The tokens are named once, by an array of one, so that they are not cut again for every token.
    cut = F.transform(F.array(tokens), lambda words: F.struct(words.alias("words"), F.array_position(F.transform(words, is_word), True).alias("first")))
    parts = F.get(F.transform(cut, part), 0)
    none = F.lit(None).cast("string")
    return F.concat(F.array(F.struct(title.alias("token"), none.alias("kind"), none.alias("value"), none.alias("gender"))), parts)


def found_values(docs: DataFrame, text: str = "text") -> DataFrame:
    """raw, kind, value, parts of every different entity; value is the same for all spellings of one, names have parts."""
    raws = written(docs.select(F.explode(F.array_distinct(entities_in(docs[text]))).alias("raw")).distinct(), "raws")
    kinds = _dealt(raws, raws.count(), "raw").withColumn("kind", _kind(F.col("raw")))
    value = (
        F.when(F.col("kind") == "mail", F.lower("raw"))
        .when(F.col("kind").isin("card", "ssn"), _digits(F.col("raw")))
        .when(F.col("kind") == "phone", F.concat(F.when(F.col("raw").startswith("+"), "+").otherwise(""), _digits(F.col("raw"))))
        .when(F.col("kind") == "iban", F.regexp_replace("raw", " ", ""))
        .when(F.col("kind") == "ip6", F.lower("raw"))
        .when(F.col("kind") != "name", F.col("raw")))
    return kinds.withColumn("value", value).withColumn("parts", F.when(F.col("kind") == "name", _parts(F.col("raw"))))


def name_parts(found: DataFrame) -> DataFrame:
    """raw, token, kind, value of the different words of names. A given name is of one gender in the whole corpus (given_f, given_m)."""
    words = found.filter("kind = 'name'").select("raw", F.explode("parts").alias("part")).select("raw", "part.*").filter("value IS NOT NULL").distinct()
    genders = words.filter("kind = 'given'").groupBy("value").agg(F.min("gender").alias("known")).select(
        F.lit("given").alias("kind"), "value", F.coalesce("known", F.when(F.crc32(F.col("value")) % 2 == 0, "f").otherwise("m")).alias("known"))
    return words.drop("gender").join(genders, ["kind", "value"], "left").select(
        "raw", "token", F.concat("kind", F.coalesce(F.concat(F.lit("_"), "known"), F.lit(""))).alias("kind"), "value")


def _hash(key: str, attempt: int) -> Column:
    """256 hexadecimal digits drawn for a value."""
    return F.concat(*(F.sha2(F.concat_ws("\x01", F.lit(key), F.col("kind"), F.col("value"), F.lit(f"{attempt}.{i}")), 256) for i in range(4)))


def _draw(stream: Column, at: Column) -> Column:
    """A number in 0..255 at a place of the stream, which starts again at its end."""
    return F.conv(F.substr(stream, 2 * (at % 128) + 1, F.lit(2)), 16, 10).cast("int")


def _characters(text: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), lambda i: F.substr(text, i, F.lit(1)))


def _redrawn(text: Column, stream: Column) -> Column:
    """Letters and digits drawn anew within their script and case, everything else as it is."""
    def one(c: Column, i: Column) -> Column:
        new = c
        for pattern, letters in reversed(LETTERS.items()):
            new = F.when(c.rlike(pattern), F.substr(F.lit(letters), _draw(stream, i) % len(letters) + 1, F.lit(1))).otherwise(new)
        return new

    return F.array_join(F.transform(_characters(text), one), "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a string of digits, modulo 10."""
    def term(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return (total + F.when(i % 2 == 0, (2 * d).cast("int") % 10 + F.floor(2 * d / 10).cast("int")).otherwise(d)).cast("int")

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), term) % 10


def _mod97(iban: Column) -> Column:
    """The IBAN remainder of a bare account with its country and check digits moved to the end."""
    moved = F.concat(F.substr(iban, F.lit(5), F.length(iban)), F.substr(iban, F.lit(1), F.lit(4)))

    def term(rest: Column, c: Column) -> Column:
        number = F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return ((rest * F.when(number > 9, 100).otherwise(10) + number) % 97).cast("int")

    return F.aggregate(_characters(moved), F.lit(0), term)


def _drawn(key: str, attempt: int) -> Column:
    """The surrogate of (kind, value), in the form of the value."""
    s, value = _hash(key, attempt), F.col("value")
    number = lambda i: _draw(s, F.lit(i))
    wider = F.lit(str(attempt)) if attempt >= WIDEN_AFTER else F.lit("")
    local = F.substring_index(value, "@", 1)
    host, last = F.regexp_extract(value, r"@(.*)\.[^.]*$", 1), F.substring_index(value, ".", -1)
    mail = F.concat(_redrawn(local, s), wider, F.lit("@"), _redrawn(host, F.reverse(s)), F.lit("."), last)
    head = F.when(value.startswith("10."), F.lit("10")).otherwise((F.lit(11) + number(0) % 89).cast("string"))
    ip4 = F.when(value.startswith("192.168."), F.concat_ws(".", F.lit("192.168"), number(2), F.lit(1) + number(3) % 254)).otherwise(
        F.concat_ws(".", head, number(1), number(2), F.lit(1) + number(3) % 254))
    ssn = F.concat((F.lit(100) + (256 * number(0) + number(1)) % 566).cast("string"),
                   F.lpad((F.lit(1) + number(2) % 99).cast("string"), 2, "0"), F.lpad((F.lit(1) + (256 * number(3) + number(4)) % 9999).cast("string"), 4, "0"))
    code = F.when(value.rlike(r"^\+[17]"), 2).when(value.startswith("+"), 3).otherwise(0)
    phone = F.concat(F.substr(value, F.lit(1), code), _redrawn(F.substr(value, code + 1, F.length(value)), s))
    start = F.concat(F.substr(value, F.lit(1), F.lit(1)), _redrawn(F.substr(value, F.lit(2), F.length(value) - 2), s))
    check = (10 - _luhn(F.concat(start, F.lit("0")))) % 10
    chance = number(120) % 9
    last_digit = F.when(_luhn(value) == 0, check).otherwise((check + 1 + chance) % 10)
    card = F.concat(start, last_digit.cast("string"))
    country, account = F.substr(value, F.lit(1), F.lit(2)), _redrawn(F.substr(value, F.lit(5), F.length(value)), s)
    iban = F.concat(country, F.lpad((98 - _mod97(F.concat(country, F.lit("00"), account))).cast("string"), 2, "0"), account)
    ip6 = F.array_join(F.transform(F.split(value, ":"), lambda g, i: F.concat(
        F.substr(F.lit("123456789abcdef"), _draw(s, i) % 15 + 1, F.lit(1)), F.substr(s, 100 + 4 * i, F.length(g) - 1))), ":")
    secret = F.when(value.startswith("AKIA"), F.concat(F.lit("AKIA"), _redrawn(F.substr(value, F.lit(5), F.lit(16)), s))).otherwise(
        F.when(value.rlike("[A-F]"), F.upper(F.substr(s, F.lit(1), F.length(value)))).otherwise(F.substr(s, F.lit(1), F.length(value))))
    return (
        F.when(F.col("kind") == "mail", mail).when(F.col("kind") == "ip4", ip4).when(F.col("kind") == "ip6", ip6)
        .when(F.col("kind") == "ssn", ssn).when(F.col("kind") == "phone", phone).when(F.col("kind") == "card", card)
        .when(F.col("kind") == "iban", iban).when(F.col("kind") == "secret", secret)
        .when(F.col("kind") == "given_f", _given(s, "f", attempt)).when(F.col("kind") == "given_m", _given(s, "m", attempt))
        .otherwise(_surname(s, wider)))


def _given(s: Column, gender: str, attempt: int) -> Column:
    """A given name of the script and gender; once those of the list are taken, joined to a drawn second one."""
    def drawn(script: str) -> Column:
        names = F.array(*(F.lit(n.lower()) for n in GIVEN[script, gender]))
        name = F.get(names, (256 * _draw(s, F.lit(126)) + _draw(s, F.lit(127))) % len(GIVEN[script, gender]))
        return name if attempt < GIVEN_ROUNDS else F.concat(name, F.lit("-"), _surname(s, F.lit("" if attempt < WIDEN_AFTER else "wider")))

    return F.when(F.col("value").rlike(r"\p{IsCyrillic}"), drawn("cyrillic")).otherwise(drawn("latin"))


def _surname(s: Column, wider: Column) -> Column:
    def joined(script: str) -> Column:
        names = F.array(*(F.lit(x) for x in SYLLABLES[script]))
        count = F.when(wider == "", F.lit(3)).otherwise(F.lit(5))
        return F.array_join(F.transform(F.sequence(F.lit(0), count), lambda i: F.get(names, _draw(s, i) % 16)), "")

    return F.when(F.col("value").rlike(r"\p{IsCyrillic}"), F.concat(joined("cyrillic"), F.lit("ов"))).otherwise(joined("latin"))


def surrogates_of(values: DataFrame, key: str) -> DataFrame:
    """kind, value, surrogate: distinct within a kind, and never a value that occurs."""
    real = written(values.select("kind", "value").distinct(), "values")
    taken, waiting, left = None, real, real.count()
    for attempt in range(ROUNDS):
        drawn = _dealt(waiting, left, "kind", "value").withColumn("surrogate", _drawn(key, attempt))
        free = drawn.join(real.select("kind", F.col("value").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        if taken is not None:
            free = free.join(taken.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        won = free.groupBy("kind", "surrogate").agg(F.min("value").alias("value")).select("kind", "value", "surrogate")
        taken = written(won if taken is None else taken.unionByName(won), "taken")
        waiting = written(real.join(taken, ["kind", "value"], "left_anti"), "waiting")
        left = waiting.count()
        if not left:
            return taken
    raise RuntimeError(f"no free surrogates left after {ROUNDS} rounds; a kind has more values than its format allows")


def _poured(raw: Column, digits: Column) -> Column:
    """The digits put in the places of the digits of raw."""
    def one(c: Column, i: Column) -> Column:
        before = F.length(_digits(F.substr(raw, F.lit(1), i + 1)))
        return F.when(c.rlike("[0-9]"), F.substr(digits, before, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(_characters(raw), one), "")


def _cased(token: Column, new: Column) -> Column:
    """A drawn name in the case of what it replaces."""
    capital = F.regexp_replace(F.initcap(F.regexp_replace(new, "-", " ")), " ", "-")
    return F.when(token == F.upper(token), F.upper(new)).otherwise(capital)


def _feminine(token: Column, new: Column) -> Column:
    """A drawn surname in the woman's form, where it replaces one."""
    return F.when(F.lower(token).rlike("(?:ов|ев|ин)а$"), F.concat(new, F.lit("а"))).otherwise(new)


def replacements(found: DataFrame, parts: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    """raw, replacement, words: the surrogate in the spelling of what it replaces; words has (kind, value, surrogate) of a name."""
    raw, new, values = F.col("raw"), F.col("surrogate"), found.count()
    others = _dealt(found.select("raw", "kind", "value").join(chosen, ["kind", "value"]), values, "raw").select("raw", (
        F.when(F.col("kind").isin("card", "ssn", "phone"), _poured(raw, _digits(new)))
        .when(F.col("kind") == "iban", _grouped(raw, new)).otherwise(new)).alias("replacement"),
        F.lit(None).cast("array<struct<kind:string,value:string,surrogate:string>>").alias("words"))
    spelt = _cased(F.col("token"), F.when(F.col("kind") == "name", _feminine(F.col("token"), new)).otherwise(new))
    # A word that repeats in a name is one entry.
    short = F.substring_index("kind", "_", 1)
    words = parts.join(chosen, ["kind", "value"]).groupBy("raw").agg(
        F.map_from_entries(F.collect_set(F.struct(F.concat_ws(" ", short, "token"), spelt))).alias("spelt"),
        F.collect_set(F.struct(short.alias("kind"), "value", "surrogate")).alias("words"))

    def one(part: Column) -> Column:
        return F.when(part["kind"] == "initial", _turned(part["token"], key)).otherwise(F.coalesce(F.element_at("spelt", F.concat_ws(" ", part["kind"], part["token"])), part["token"]))

    names = _dealt(found.filter("kind = 'name'").select("raw", "parts").join(words, "raw"), values, "raw").select(
        "raw", F.array_join(F.transform("parts", one), "").alias("replacement"), "words")
    return others.unionByName(names)


def _grouped(raw: Column, new: Column) -> Column:
    """The characters of new with the spaces of raw."""
    def one(c: Column, i: Column) -> Column:
        before = F.length(F.regexp_replace(F.substr(raw, F.lit(1), i + 1), " ", ""))
        return F.when(c == " ", c).otherwise(F.substr(new, before, F.lit(1)))

    return F.array_join(F.transform(_characters(raw), one), "")


def _with_names(piece: Column, key: str) -> Column:
    """A piece of text with the words of the names of its document (given, name) replaced where they stand alone, with their initials."""
    def word(t: Column) -> Column:
        given, surname = F.element_at("given", F.lower(t)), F.element_at("name", _surname_value(t))
        return F.when(t.rlike(r"^\p{Lu}[^\p{Lu}.]|^\p{Lu}{2}"), _cased(t, F.coalesce(given, _feminine(t, surname))))

    def each(tokens: Column) -> Column:
        def one(t: Column, i: Column) -> Column:
            named = F.element_at("name", _surname_value(F.get(tokens, i + 1))).isNotNull()
            return F.coalesce(F.when(t.rlike(r"^\p{Lu}\."), F.when(named, _turned(t, key))).otherwise(word(t)), t)

        return F.transform(tokens, one)

    # The tokens are named once, by an array of one.
    tokens = F.array(F.regexp_extract_all(piece, F.lit(_TEXT_TOKENS), F.lit(0)))
    return F.array_join(F.flatten(F.transform(tokens, each)), "")


def with_surrogates(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """docs with the entities of the text replaced; all other columns and rows stay.

    Null and empty texts, and texts without entities, come back unchanged. Repeated rows get
    equal texts. No rows give no rows. Only documents with entities are shuffled.
    """
    found = written(found_values(docs, text), "entities")
    parts = written(name_parts(found), "name-parts")
    values = found.filter("kind <> 'name'").select("kind", "value").unionByName(parts.select("kind", "value"))
    table = written(replacements(found, parts, surrogates_of(values, key), key), "replacements")
    whole = docs.select(F.struct(*docs.columns).alias("row"), docs[text].alias("whole"))
    whole = whole.withColumn("found", entities_in(F.col("whole")))
    touched = whole.filter(F.size("found") > 0).withColumn("same", F.sha2("whole", 256))
    used = touched.select("same", F.explode("found").alias("raw")).distinct().join(table, "raw")
    maps = used.groupBy("same").agg(
        F.map_from_entries(F.collect_list(F.struct("raw", "replacement"))).alias("new"), F.flatten(F.collect_list("words")).alias("words"))
    maps = maps.select("same", "new", *(
        F.map_from_entries(F.array_distinct(F.transform(F.filter("words", lambda w: w["kind"] == kind), lambda w: F.struct(w["value"], w["surrogate"]))))
        .alias(kind) for kind in ("given", "name")))
    between = F.split("whole", ENTITY, -1)
    named = F.size("given") + F.size("name") > 0
    plain = F.when(named, F.transform(between, lambda piece: _with_names(piece, key))).otherwise(between)
    rebuilt = F.array_join(F.flatten(F.zip_with(
        plain, "found", lambda piece, raw: F.array(piece, F.coalesce(F.element_at(F.col("new"), raw), F.lit(""))))), "")
    changed = touched.join(maps, "same").select(F.col("row").withField(text, rebuilt).alias("row"))
    same = whole.filter(F.coalesce(F.size("found"), F.lit(0)) == 0).select("row")
    return same.unionByName(changed).select("row.*")
