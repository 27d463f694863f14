"""Keyed surrogates for personal data, with DataFrame functions only.

Entities are found by one pattern: e-mail addresses, international and national telephone numbers, IPv4 addresses,
card numbers, access keys, secrets after their names, and persons after a form of address, with any number of
given names, initials and surnames. In a text that holds a person, later bare words that are parts of that
person's name are replaced as well. A value gets the surrogate that a key and
a hash of the value select, in the form of the value: digits stay digits and letters letters of their case,
hexadecimal stays hexadecimal of its case, octets stay octets, a valid card number stays valid, country codes, top-level
domains, forms of address and key prefixes stay as they are, and each part of a name gets a made-up name of its
gender and script. Equal values get equal surrogates wherever they stand. Different values get different ones, and none that
stands in the texts as a value: all are checked, and those that clash try again, the smallest value first.

Names of secrets and forms of address count in any case. E-mail addresses, and secrets in hexadecimal, that
differ in case are one value; a secret is the same after any name. Null texts stay null; empty ones and texts without entities
stay as they are. Rows may repeat: a text's entities are looked up once. Every column of the documents is
kept, `text` is replaced. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.scratch import written

# Possessive: a shorter run is never followed by an @.
EMAIL = r"[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+"
ACCESS_KEY = r"\bAKIA[0-9A-Z]{16}\b"
SECRET_NAMES = ["password", "passwd", "token", "secret", "api_key", "apikey"]
_SECRET_NAME = rf"(?<![A-Za-z0-9])(?i:{'|'.join(SECRET_NAMES)})[\"']?\s{{0,3}}[=:]\s{{0,3}}[\"']?"
# Parts after a full stop belong to it, as those of a signed token do.
SECRET = _SECRET_NAME + r"[A-Za-z0-9+/_-]{12,}+(?:\.[A-Za-z0-9+/_-]+)*+"
IP = r"\b\d{1,3}(?:\.\d{1,3}){3}\b"
# International; in pairs; then national: area in brackets, 3-3-4, after a trunk 0, and that in pairs.
PHONE = (
    r"(?:\+\d{1,3}[ .-]?(?:\(0\) ?)?\(?\d{2,4}\)?[ .-]?\d{3,4}[ .-]?\d{3,4}\b|\+\d{1,3}[ .-]?\d(?:[ .-]?\d{2}){4}\b"
    r"|\(\d{2,5}\)[ .-]?\d{3,4}[ .-]?\d{3,4}\b|(?<!\d)(?<!\d[.-])(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}\b"
    r"|(?<!\d)(?<!\d[.-])0\d{1,4}[ /-]\d{3,4}[ .-]?\d{3,5}\b|(?<!\d)(?<!\d[.-])0\d(?:[ .-]\d{2}){4}\b)"
)
CARD = r"(?:\b\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}\b|\b\d{4}[ -]?\d{6}[ -]?\d{4,5}\b)"
#: Forms of address, by gender (fixed values).
MALE = ["Mr", "Mister", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Господин"]
FEMALE = ["Mrs", "Ms", "Miss", "Madam", "Frau", "Fräulein", "Madame", "Mademoiselle", "Mme", "Mlle", "Señora", "Señorita", "Sra", "Srta", "Госпожа"]
NEUTRAL = ["Mx", "Dr", "Doctor", "Prof", "Professor", "Доктор", "Профессор"]
TITLES = sorted(MALE + FEMALE + NEUTRAL, key=len, reverse=True)
#: Words in small letters inside a name, which stay (fixed values).
PARTICLES = ["von und zu", "von der", "von den", "van der", "van den", "von", "vom", "van", "zu", "de la", "de las", "de los", "de", "del", "della", "di", "da", "dos", "du", "bin", "ibn", "ten", "ter"]
_BLANK = r"[\s\xA0]"
_TITLE = rf"(?iu:{'|'.join(TITLES)})"
_ADDRESS = rf"(?<![\p{{L}}\p{{N}}_])(?:{_TITLE}(?:\.{_BLANK}{{0,2}}|{_BLANK}{{1,2}})){{1,4}}"
# A capital and letters, also with an apostrophe before a capital.
_WORD = rf"(?!{_TITLE}(?:\.|{_BLANK}))(?:[dDlLO]['’])?\p{{Lu}}[\p{{L}}\p{{M}}]+(?:['’]\p{{Lu}}[\p{{L}}\p{{M}}]+)*"
_LETTER = r"\p{Lu}\p{M}*(?![\p{L}\p{M}'’])"
# An initial without a full stop needs a word after it.
_ITEM = rf"(?:(?:{'|'.join(sorted(PARTICLES, key=len, reverse=True))}) )?(?:{_WORD}|\p{{Lu}}\p{{M}}*\.|{_LETTER}(?=[ \xA0]{{1,2}}\p{{Lu}}\p{{L}}))"
PERSON = _ADDRESS + rf"(?:{_ITEM}|{_LETTER})(?:(?:[ \xA0]{{1,2}}|[-‐‑]|(?<=\.)){_ITEM})*"
#: A word that may be a name of a person of the same text.
BARE = rf"(?<![\p{{L}}\p{{M}}\p{{N}}_]){_WORD}"
#: In this order, which decides where two could begin at one place.
KINDS = {"email": EMAIL, "access_key": ACCESS_KEY, "secret": SECRET, "person": PERSON, "ip": IP, "card": CARD, "phone": PHONE}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())

_LATIN = ["ba", "de", "fi", "go", "ku", "la", "me", "ni", "po", "ru", "sa", "te", "vi", "zo", "ha", "jo"]
_CYRILLIC = ["ба", "де", "фи", "го", "ку", "ла", "ме", "ни", "по", "ру", "са", "те", "ви", "зо", "ха", "жо"]


# Short forms of address stand in many words, so these are searched with what must be around them.
_SHORT = [t for t in TITLES if len(t) <= 3 or t in ("Mlle", "Srta")]
_SHORT_TITLE = rf"[{''.join(sorted({x for t in _SHORT for x in t[0].lower() + t[0].upper()}))}](?<![\p{{L}}\p{{N}}_].)(?i:{'|'.join(sorted({t[1:] for t in _SHORT}))})(?:\.|{_BLANK})"

#: PERSON, tried only where a form of address may begin.
_LED_PERSON = f"(?=[{''.join(sorted({x for t in TITLES for x in t[0].lower() + t[0].upper()}))}]){PERSON}"


def _holds(text: Column) -> Column:
    """Whether the pattern matches, kind by kind. Searches for what every match of a kind contains come first: they
    rule out most texts without trying its pattern at each place."""

    def has(lowered: Column, parts: list[str]) -> Column:
        found = F.lit(False)
        for part in sorted({p.lower() for p in parts}):
            found = found | lowered.contains(part)
        return found

    def by_word(lowered: Column) -> Column:
        titled = has(lowered, [t for t in TITLES if t not in _SHORT]) | text.rlike(_SHORT_TITLE)
        return (has(lowered, SECRET_NAMES) & text.rlike(SECRET)) | (titled & text.rlike(_LED_PERSON))

    numbers = text.rlike(r"\d[ .]?\d") & text.rlike(rf"(?=[+(\d])(?:{IP}|{CARD}|{PHONE})")
    # In an array, so that the text is put in lower case once.
    by_word = F.exists(F.array(F.lower(text)), by_word)
    return (text.contains("@") & text.rlike(EMAIL)) | (text.contains("AKIA") & text.rlike(ACCESS_KEY)) | numbers | by_word


def _by_entity(text: Column, cut: Callable[[str], Column]) -> Column:
    """`cut` by the pattern; in texts with persons also by all words that may be their names."""
    return F.when(text.rlike(_LED_PERSON), cut(f"{PATTERN}|(?:{BARE})")).otherwise(cut(PATTERN))


def kind_of(value: Column) -> Column:
    out = F.when(value.contains("@"), "email")
    for kind, pattern in KINDS.items():
        out = out if kind == "email" else out.when(value.rlike(f"^{pattern}$"), kind)
    return out.otherwise("word")


def _head(mention: Column) -> Column:
    """What of a mention is no part of its value and stays: the name of a secret."""
    return F.when(kind_of(mention) == "secret", F.regexp_extract(mention, f"^{_SECRET_NAME}", 0)).otherwise("")


def _rest(mention: Column) -> Column:
    return F.substr(mention, F.length(_head(mention)) + 1)


def _shouted(mention: Column) -> Column:
    """Whether it is a secret in upper-case hexadecimal."""
    return (kind_of(mention) == "secret") & _rest(mention).rlike("^[0-9A-F]*[A-F][0-9A-F]*$")


def canonical(mention: Column) -> Column:
    """What must be equal for two mentions to be one value."""
    kind = kind_of(mention)
    return F.when((kind == "email") | _shouted(mention), F.lower(_rest(mention))).otherwise(_rest(mention))


def _inserted(mention: Column, surrogate: Column) -> Column:
    """What stands for a mention in the text."""
    return F.concat(_head(mention), F.when(_shouted(mention), F.upper(surrogate)).otherwise(surrogate))


def _stream(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """64 hexadecimal digits that only the key's holder can tell."""
    inner = F.sha2(F.concat_ws("\n", F.lit(key), kind, attempt.cast("string"), value), 256)
    return F.sha2(F.concat(F.lit(key), inner), 256)


def _byte(stream: Column, i: Column) -> Column:
    # A long value takes more digits than one hash has.
    stream = F.when(i < 32, stream).otherwise(F.sha2(F.concat(stream, F.floor(i / 32).cast("string")), 256))
    return F.conv(F.substr(stream, (i * 2) % 64 + 1, F.lit(2)), 16, 10).cast("int")


def _turned(c: Column, stream: Column, i: Column, alphabet: str) -> Column:
    at = F.position(c, F.lit(alphabet)) - 1
    return F.substr(F.lit(alphabet), (at + _byte(stream, i)) % len(alphabet) + 1, F.lit(1))


_DIGITS = "0123456789"
_LOWER = "abcdefghijklmnopqrstuvwxyz"


def _scrambled(text: Column, stream: Column) -> Column:
    """Digits and ASCII letters turned within their kind; the rest as it is."""

    def one(c: Column, i: Column) -> Column:
        return (
            F.when(c.between("0", "9"), _turned(c, stream, i, _DIGITS))
            .when(c.between("a", "z"), _turned(c, stream, i, _LOWER))
            .when(c.between("A", "Z"), _turned(c, stream, i, _LOWER.upper()))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _hexadecimal(text: Column, stream: Column) -> Column:
    return F.array_join(F.transform(F.split(text, ""), lambda c, i: _turned(c, stream, i, "0123456789abcdef")), "")


def _octets(text: Column, stream: Column) -> Column:
    return F.array_join(F.transform(F.split(text, r"\."), lambda o, i: ((o.cast("int") + _byte(stream, i)) % 256).cast("string")), ".")


def _luhn(digits: Column) -> Column:
    """Luhn sum modulo 10 of a string of digits."""

    def weight(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when((F.length(digits) - i) % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(F.split(digits, ""), weight), F.lit(0), lambda a, x: a + x) % 10


def _card(text: Column, stream: Column) -> Column:
    rest = F.concat(F.substr(text, F.lit(1), F.lit(1)), _scrambled(F.substr(text, F.lit(2)), stream))
    body = F.substr(rest, F.lit(1), F.length(rest) - 1)
    digits = F.regexp_replace(F.concat(body, F.lit("0")), r"\D", "")
    valid = _luhn(F.regexp_replace(text, r"\D", "")) == 0
    return F.when(valid, F.concat(body, ((10 - _luhn(digits)) % 10).cast("string"))).otherwise(rest)


#: Endings tell a given name's gender and a family name; their last letters differ, so no two kinds share a name.
_ENDINGS = {"male": ("n", "н"), "female": ("na", "на"), "neutral": ("l", "л"), "family": ("ker", "ко")}


def _cyrillic(part: Column) -> Column:
    return part.rlike(r"^\p{IsCyrillic}")


def _stem(part: Column, stream: Column, syllables: int) -> Column:
    def made(choice: list[str]) -> Column:
        table = F.array(*[F.lit(s) for s in choice])
        return F.concat(*[F.get(table, _byte(stream, F.lit(k)) % len(choice)) for k in range(syllables)])

    return F.when(_cyrillic(part), made(_CYRILLIC)).otherwise(made(_LATIN))


def _ended(stem: Column, part: Column, ending: str) -> Column:
    latin, cyrillic = _ENDINGS[ending]
    return F.concat(stem, F.when(_cyrillic(part), cyrillic).otherwise(latin))


def _name(word: Column, kind: Column, gender: Column, stem: Column) -> Column:
    """The made-up name for a word of a person's name, in its case."""
    ending = F.when(kind == "family", "family").otherwise(gender)
    name = F.concat(*[F.when(ending == e, _ended(stem, word, e)).otherwise("") for e in _ENDINGS])
    return F.when(word == F.upper(word), F.upper(name)).otherwise(F.initcap(name))


def assign_names(parts: DataFrame, key: str, syllables: int = 8) -> DataFrame:
    """(kind, value, stem) for distinct name parts (kind given or family, value in lower case): distinct stems within
    a kind, none of which makes a name that is a value. Each attempt takes a syllable more, so there are always
    enough, and names of two attempts differ in length."""
    pending = written(parts.select("kind", "value"), "names")
    values = pending.select(F.col("value").alias("form")).distinct()
    accepted = None
    while accepted is None or not pending.isEmpty():
        stem = _stem(F.col("value"), _stream(key, F.col("kind"), F.col("value"), F.lit(syllables)), syllables)
        tried = written(pending.withColumn("stem", stem), "tried")
        first = tried.groupBy("kind", "stem").agg(F.min("value").alias("value"))
        # Whatever the kind: a name that stands for one part is not to be another part.
        forms = F.explode(F.array(*[_ended(F.col("stem"), F.col("value"), e) for e in _ENDINGS])).alias("form")
        known = first.select("kind", "stem", forms).join(values, "form", "left_semi").select("kind", "stem").distinct()
        good = written(first.join(known, ["kind", "stem"], "left_anti").select("kind", "value", "stem"), "stems")
        accepted = good if accepted is None else accepted.unionByName(good)
        pending = written(pending.join(good.select("kind", "value"), ["kind", "value"], "left_anti"), "pending")
        syllables += 1
    return accepted


def _initial(letter: Column, key: str) -> Column:
    """Latin and Cyrillic capitals turned by a number that the key selects; any other becomes X."""
    out = F.lit("X")
    for first, n in (("A", 26), ("А", 32)):
        alphabet = "".join(chr(ord(first) + i) for i in range(n))
        shift = int(hashlib.sha256(f"{key}\ninitial{n}".encode()).hexdigest(), 16) % (n - 1) + 1
        out = F.when(letter.between(alphabet[0], alphabet[-1]), F.translate(letter, alphabet, alphabet[shift:] + alphabet[:shift])).otherwise(out)
    return out


def _gender(mention: Column) -> Column:
    address = F.split(F.regexp_replace(F.lower(F.regexp_extract(mention, f"^{_ADDRESS}", 0)), rf"(?:\.|{_BLANK})+", " "), " ")
    held = lambda titles: F.arrays_overlap(address, F.array(*[F.lit(t.lower()) for t in titles]))
    return F.when(held(FEMALE), "female").when(held(MALE), "male").otherwise("neutral")


def _part_value(word: Column) -> Column:
    return F.lower(F.translate(word, "’", "'"))


_PARTS = rf"{_WORD}|{_LETTER}"


def _name_parts(mentions: DataFrame) -> DataFrame:
    """(mention, at, word, kind, value, gender) of the parts of distinct `mentions` of persons. What comes after the last
    blank is the family name. After a form of address without gender a name has that which it has elsewhere."""
    address = F.regexp_extract("mention", f"^{_ADDRESS}", 0)
    name = F.substr(F.col("mention"), F.length(address) + 1)
    given = F.size(F.regexp_extract_all(F.regexp_extract(name, r"^.*[ \xA0]", 0), F.lit(_PARTS), F.lit(0)))
    parts = mentions.select("mention", given.alias("given"), F.posexplode(F.regexp_extract_all(name, F.lit(_PARTS), F.lit(0))).alias("at", "word"))
    kind = F.when(F.col("word").rlike(f"^{_LETTER}$"), "initial").when(F.col("at") < F.col("given"), "given").otherwise("family")
    parts = parts.select("mention", "at", "word", kind.alias("kind"), _part_value(F.col("word")).alias("value"), _gender(F.col("mention")).alias("gender"))
    parts = written(parts, "name-parts")
    known = parts.where("kind = 'given' and gender != 'neutral'").groupBy("value").agg(F.min("gender").alias("low"), F.max("gender").alias("high"))
    known = known.where("low = high").select("value", F.lit("given").alias("kind"), F.lit("neutral").alias("gender"), F.col("low").alias("elsewhere"))
    both = parts.join(known, ["value", "kind", "gender"], "left")
    return written(both.select("mention", "at", "word", "kind", "value", F.coalesce("elsewhere", "gender").alias("gender")), "name-parts")


def persons(people: DataFrame, words: DataFrame, key: str) -> DataFrame:
    """(text_key, at, surrogate) for mentions of persons and other words with a capital, both (text_key, at, mention). Each
    part of a name has its surrogate by itself, so that a surname alone and with a given name stays one surname.
    A word after a mention of a person in the same text is that person's name if it is a part of it."""
    parts = _name_parts(people.select("mention").distinct())
    names = written(assign_names(parts.where("kind != 'initial'").select("kind", "value").distinct(), key), "names")
    named = parts.join(names, ["kind", "value"], "left")
    name = F.when(F.col("kind") == "initial", _initial(F.substr("word", F.lit(1), F.lit(1)), key)).otherwise(_name(F.col("word"), F.col("kind"), F.col("gender"), F.col("stem")))
    whole = named.groupBy("mention").agg(F.array_sort(F.collect_list(F.struct("at", name.alias("name")))).alias("names"))
    address = F.regexp_extract("mention", f"^{_ADDRESS}", 0)
    between = F.split(F.substr(F.col("mention"), F.length(address) + 1), _PARTS, -1)
    inserted = F.concat(F.col("names")["name"], F.array(F.lit("")))
    surrogate = F.concat(address, F.array_join(F.zip_with(between, inserted, lambda a, b: F.concat(a, b)), ""))
    full = people.join(whole.select("mention", surrogate.alias("surrogate")), "mention").select("text_key", "at", "surrogate")
    known = people.withColumnRenamed("at", "seen").join(parts.where("kind != 'initial'"), "mention")
    known = known.groupBy("text_key", "value").agg(F.min("seen").alias("seen"), F.min(F.struct("kind", "gender")).alias("as"))
    known = known.select("text_key", "value", "seen", "as.*")
    later = words.withColumn("value", _part_value(F.col("mention"))).join(known, ["text_key", "value"], "left").join(names, ["kind", "value"], "left")
    replaced = _name(F.col("mention"), F.col("kind"), F.col("gender"), F.col("stem"))
    surrogate = F.when(F.col("at") > F.col("seen"), replaced).otherwise(F.col("mention"))
    return full.unionByName(later.select("text_key", "at", surrogate.alias("surrogate")))


def surrogate(kind: Column, value: Column, key: str, attempt: Column) -> Column:
    # In an array, so that the value is hashed once, not for each of its characters.
    hashed = F.array(_stream(key, kind, value, attempt))
    return F.get(F.transform(hashed, lambda stream: _surrogate(kind, value, stream)), 0)


def _surrogate(kind: Column, value: Column, stream: Column) -> Column:
    domain = F.regexp_extract(value, r"\.[^.]*$", 0)
    country = F.regexp_extract(value, r"^(?:\+\d{1,3}|\(?0)", 0)
    after = lambda head: F.substr(value, F.length(head) + 1)
    return (
        F.when(kind == "email", F.concat(_scrambled(F.substr(value, F.lit(1), F.length(value) - F.length(domain)), stream), domain))
        .when(kind == "access_key", F.concat(F.lit("AKIA"), _scrambled(F.substr(value, F.lit(5)), stream)))
        .when(kind == "secret", F.when(value.rlike("^[0-9a-f]+$"), _hexadecimal(value, stream)).otherwise(_scrambled(value, stream)))
        .when(kind == "ip", _octets(value, stream))
        .when(kind == "phone", F.concat(country, _scrambled(after(country), stream)))
        .otherwise(_card(value, stream))
    )


def assign(values: DataFrame, key: str, attempts: int = 40) -> DataFrame:
    """(kind, value, surrogate) for distinct `values` (value, and kind if it does not show): distinct surrogates,
    none of which is a value."""
    kind = F.col("kind") if "kind" in values.columns else kind_of(F.col("value"))
    pending = written(values.select(kind.alias("kind"), "value"), "values")
    taken = pending.select(F.col("value").alias("surrogate"))
    accepted: list[DataFrame] = []
    for attempt in range(attempts):
        tried = pending.withColumn("surrogate", surrogate(F.col("kind"), F.col("value"), key, F.lit(attempt)))
        tried = written(tried, "tried")
        # The smallest value of a surrogate may keep it, if nothing else stands for it.
        first = tried.groupBy("surrogate").agg(F.min(F.struct("kind", "value")).alias("first")).select("surrogate", "first.*")
        good = written(first.join(taken, "surrogate", "left_anti").select("kind", "value", "surrogate"), "surrogates")
        accepted.append(good)
        taken = taken.unionByName(good.select("surrogate"))
        pending = written(pending.join(good.select("kind", "value"), ["kind", "value"], "left_anti"), "pending")
        if pending.isEmpty():
            break
    else:
        raise ValueError(f"no distinct surrogates after {attempts} attempts: there are too many values of one form")
    out = accepted[0]
    for more in accepted[1:]:
        out = out.unionByName(more)
    return out


def replace(documents: DataFrame, key: str) -> DataFrame:
    """The documents with surrogates in `text`."""
    entities = _by_entity(F.col("text"), lambda pattern: F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    holding = written(documents.where(_holds(F.col("text"))), "holding")
    # Equal texts have equal entities.
    found = holding.select(F.sha2("text", 256).alias("text_key"), entities.alias("mentions")).groupBy("text_key").agg(F.min("mentions").alias("mentions"))
    found = found.select("text_key", F.posexplode("mentions").alias("at", "mention"))
    found = written(found.select("*", kind_of(F.col("mention")).alias("kind"), canonical(F.col("mention")).alias("value")), "mentions")
    others = found.where("kind not in ('person', 'word')")
    names = assign(others.select("kind", "value").distinct(), key)
    named = others.join(names, ["kind", "value"]).select("text_key", "at", _inserted(F.col("mention"), F.col("surrogate")).alias("surrogate"))
    people, words = (found.where(F.col("kind") == k).select("text_key", "at", "mention") for k in ("person", "word"))
    named = named.unionByName(persons(people, words, key))
    by_text = named.groupBy("text_key").agg(F.array_sort(F.collect_list(F.struct("at", "surrogate"))).alias("named"))
    taken = {c.lower() for c in documents.columns}
    key_name = next(n for n in ("text_key" + "_" * i for i in range(len(taken) + 1)) if n not in taken)
    named_name = next(n for n in ("named" + "_" * i for i in range(len(taken) + 1)) if n not in taken)
    by_text = by_text.select(F.col("text_key").alias(key_name), F.col("named").alias(named_name))
    both = holding.withColumn(key_name, F.sha2("text", 256)).join(by_text, key_name)
    between = _by_entity(F.col("text"), lambda pattern: F.split("text", pattern, -1))
    inserted = F.concat(F.transform(F.col(named_name), lambda s: s["surrogate"]), F.array(F.lit("")))
    text = F.array_join(F.zip_with(between, inserted, lambda a, b: F.concat(a, b)), "")
    replaced = both.select(*[text.alias(c) if c == "text" else F.col(c) for c in documents.columns])
    return replaced.unionByName(documents.where(~F.coalesce(_holds(F.col("text")), F.lit(False))))
