"""PII surrogates: keyed, type-consistent replacements, in Spark SQL only.

Detected entities - e-mail and IPv4 addresses, phone, card and social security
numbers, IBANs, passwords and tokens, person names - are replaced by values of
the same type and format.  A replacement is a keyed permutation of the values of
one format: a Feistel network over the characters, in which every character
stays in its alphabet (digit, vowel, consonant; script and case kept) and the
shifts come from SHA-256 of the key, the type and the other half.

* Coreference: a value has the same replacement wherever it occurs, in any
  document and any run with the same key; given names and surnames, and an
  address's name and host, are replaced apart, so "Mr Smith" and "John Smith"
  stay one family and one host stays one host.
* Distinctness: a permutation gives two values two replacements without any
  table of what was seen, so there is nothing to shuffle or broadcast.  Where
  two formats could meet (known given names are permuted within the list of
  their gender; hex secrets within hex), a replacement that falls into the
  other format is a collision: it is permuted again until it does not
  (``WALK`` times at most; ``collisions`` reports the replacements that two
  different values of a corpus share - none, by construction).
* Format: separators, lengths, country codes, card issuer digit, the validity of
  Luhn and IBAN check digits and a name's gender stay.

Scale: a projection; documents without a trigger character or word are not
matched at all.

Defined results: a null text stays null; texts without entities are unchanged;
repeated rows get equal results; a very long text is one row like any other; an
empty table gives no rows; other columns, of whatever name, pass through.  Single letters
and digits have few replacements and may stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "corpus-surrogates"
ROUNDS = 6
WALK = 4

# Alphabets, one character class of one script and case each.
ALPHABETS = (
    "0123456789",
    "aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ",
    "àáâãäåæèéêëìíîïòóôõöøùúûü", "ÀÁÂÃÄÅÆÈÉÊËÌÍÎÏÒÓÔÕÖØÙÚÛÜ", "çðñþýÿß", "ÇÐÑÞÝ",
    "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "АЕЁИОУЫЭЮЯ", "БВГДЖЗЙКЛМНПРСТФХЦЧШЩ",
    "αεηιουω", "βγδζθκλμνξπρστφχψ", "ΑΕΗΙΟΥΩ", "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ",
)
# Titles, and common given names by gender and script.
TITLES = ("Mr", "Mrs", "Ms", "Miss", "Mister", "Herr", "Frau", "Monsieur", "Madame", "Mme", "Mlle", "Señor", "Señora",
          "Sra", "Doña", "Г-н", "Г-жа", "Господин", "Госпожа", "Κύριος", "Κυρία")
GIVEN = {
    "male": ("James", "John", "Robert", "Michael", "William", "David", "Richard", "Thomas", "Charles", "Daniel", "Peter",
             "Paul", "Hans", "Klaus", "Stefan", "Pierre", "Jean", "Luc", "Carlos", "Juan", "Pedro", "Miguel"),
    "female": ("Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Barbara", "Susan", "Jessica", "Sarah", "Karen",
               "Anna", "Emma", "Heidi", "Ursula", "Marie", "Sophie", "Claire", "Maria", "Carmen", "Lucia", "Elena", "Rosa"),
    "male, Cyrillic": ("Иван", "Пётр", "Сергей", "Алексей", "Дмитрий", "Николай", "Борис", "Олег"),
    "female, Cyrillic": ("Анна", "Мария", "Ольга", "Елена", "Наталья", "Татьяна", "Ирина", "Светлана"),
    "male, Greek": ("Γιώργος", "Νίκος", "Δημήτρης", "Κώστας"),
    "female, Greek": ("Μαρία", "Ελένη", "Κατερίνα", "Σοφία"),
}
_ALL_GIVEN = [n for names in GIVEN.values() for n in names]

_PRE, _POST = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
_NAME = r"\p{Lu}[\p{L}'’-]+"
_OCTET = r"(?:25[0-5]|2[0-4]\d|[01]?\d?\d)"
#: Patterns by type, tried in this order.
PATTERNS = {
    "secret": r"(?i:(?<![\p{L}\p{N}])(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)[\"']?\s{0,2}[=:]\s{0,2}[\"']?)"
              r"[A-Za-z0-9+/_.-]{6,}",
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[\p{L}\p{N}-]++\.)+\p{L}{2,}",
    "ipv4": r"(?<![\p{L}\p{N}.])(?:" + _OCTET + r"\.){3}" + _OCTET + r"(?!\.?\d)" + _POST,
    "iban": _PRE + r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _POST,
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}" + _POST,
    "phone": r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}"
             r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})" + _POST,
    "card": r"(?<![\p{L}\p{N}.-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})" + _POST,
    "name": _PRE + r"(?:(?:" + "|".join(sorted(TITLES, key=len, reverse=True)) + r")\.? " + _NAME + "(?: " + _NAME + ")?"
            r"|(?:" + "|".join(sorted(_ALL_GIVEN, key=len, reverse=True)) + ") " + _NAME + ")" + _POST,
}
_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What every entity has somewhere: cheap to look for.
_TRIGGER = (r"[0-9@]|[=:][\s\"']{0,5}[A-Za-z0-9+/_.-]{6}|(?=\p{Lu})" + _PRE + "(?:"
            + "|".join(sorted({*(t + "[. ]" for t in TITLES), *(n + " " for n in _ALL_GIVEN)})) + ")")


def _let(value: Column, fn) -> Column:
    """``fn(value)`` with the value computed once."""
    return F.transform(F.array(value), fn)[0]


def _alphabet(c: Column, hexadecimal: Column) -> Column:
    out = F.when(hexadecimal, F.lit("0123456789abcdef"))
    for a in ALPHABETS:
        out = out.when(F.instr(F.lit(a), c) > 0, F.lit(a))
    return out.otherwise(c)


def _shift(key: str, tag: str, *parts: Column) -> Column:
    """Keyed pseudo-random number below 2**48."""
    text = F.concat_ws("|", F.lit(key), F.lit(tag), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("long")


def _permuted(value: Column, key: str, tag: str, hexadecimal: Column | None = None) -> Column:
    """Another string of the same shape; different strings, different results."""

    def network(hexa: Column) -> Column:
        symbols = F.transform(F.split(value, ""), lambda c: _let(_alphabet(c, hexa), lambda a: F.struct(
            a.alias("a"), F.greatest(F.instr(a, c) - 1, F.lit(0)).cast("long").alias("i"))))

        def plain(part: Column) -> Column:
            return F.array_join(F.transform(part, lambda s: s["i"].cast("string")), ".")

        def round_(state: Column, r: Column) -> Column:
            half = F.floor(F.size(state) / 2).cast("int")
            left = r % 2 == 0
            other = F.when(left, plain(F.slice(state, half + 1, F.size(state)))).otherwise(plain(F.slice(state, F.lit(1), half)))
            return _let(F.struct(half.alias("h"), other.alias("o")), lambda x: F.transform(state, lambda s, pos: F.when(
                left == (pos < x["h"]),
                F.struct(s["a"].alias("a"), F.pmod(s["i"] + _shift(key, tag, r, pos, x["o"]), F.length(s["a"]).cast("long")).alias("i"))
            ).otherwise(s)))

        done = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), symbols, round_)
        return F.array_join(F.transform(done, lambda s: F.substr(s["a"], (s["i"] + 1).cast("int"), F.lit(1))), "")

    return _let(F.lit(False) if hexadecimal is None else hexadecimal, network)


def _apart(value: Column, key: str, tag: str, taken) -> Column:
    """``_permuted``, again while the result is a collision (``taken``)."""
    return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), _permuted(value, key, tag),
                       lambda v, _: F.when(taken(v), _permuted(v, key, tag)).otherwise(v))


_HEX = "^(?=.*[0-9])[0-9a-f]{12,}$"


def _secret(e: Column, key: str) -> Column:
    head = F.regexp_extract(e, r"^([^=:]*[=:]\s*[\"']?)", 1)
    return _let(head, lambda h: F.concat(h, _let(F.substr(e, F.length(h) + 1), lambda v: F.when(
        v.rlike(_HEX), _permuted(v, key, "secret", F.lit(True)))
        .otherwise(_apart(v, key, "secret", lambda x: x.rlike(_HEX))))))


def _email(e: Column, key: str) -> Column:
    host = F.substring_index(e, "@", -1)
    top = F.substring_index(host, ".", -1)
    return F.concat(_permuted(F.substring_index(e, "@", 1), key, "mailbox"), F.lit("@"),
                    _permuted(F.lower(F.substr(host, F.lit(1), F.length(host) - F.length(top) - 1)), key, "host"),
                    F.lit("."), top)


def _ipv4(e: Column, key: str) -> Column:
    octets = F.transform(F.split(e, r"\."), lambda o: o.cast("long"))
    pair = _let(octets, lambda o: F.struct((o[0] * 256 + o[1]).alias("a"), (o[2] * 256 + o[3]).alias("b")))
    done = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), pair, lambda s, r: F.struct(
        s["b"].alias("a"), F.pmod(s["a"] + _shift(key, "ipv4", r, s["b"]), F.lit(65536).cast("long")).alias("b")))
    return _let(done, lambda s: F.concat_ws(".", F.shiftright(s["a"], 8).cast("string"), (s["a"] % 256).cast("string"),
                                            F.shiftright(s["b"], 8).cast("string"), (s["b"] % 256).cast("string")))


def _luhn(body: Column) -> Column:
    """Check digit of a number without its last digit."""
    digits = F.split(F.reverse(F.regexp_replace(body, "[^0-9]", "")), "")
    twice = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0))
                        .otherwise(d.cast("int")))
    return F.pmod(-F.aggregate(twice, F.lit(0), lambda a, d: a + d), F.lit(10))


def _card(e: Column, key: str) -> Column:
    body = F.substr(e, F.lit(1), F.length(e) - 1)
    last = F.substring(e, -1, 1).cast("int")
    return _let(F.concat(F.substring(e, 1, 1), _permuted(F.substr(body, F.lit(2)), key, "card")), lambda new: F.concat(
        new, F.pmod(_luhn(new) + last - _luhn(body), F.lit(10)).cast("string")))


def _phone(e: Column, key: str) -> Column:
    country = F.regexp_extract(e, r"^(\+\d{1,3}(?=[ .(-]))?", 1)
    return _let(country, lambda c: F.concat(c, _permuted(F.substr(e, F.length(c) + 1), key, "phone")))


def _iban(e: Column, key: str) -> Column:
    def check(rest: Column) -> Column:
        """98 minus the remainder by 97 of rest, country and 00."""
        text = F.concat(F.regexp_replace(rest, " ", ""), F.substring(e, 1, 2), F.lit("00"))
        return 98 - F.aggregate(F.split(text, ""), F.lit(0), lambda a, c: F.when(
            c.rlike("[0-9]"), (a * 10 + F.coalesce(F.try_to_number(c, F.lit("9")).cast("int"), F.lit(0))) % 97)
            .otherwise((a * 100 + F.ascii(c) - 55) % 97))

    rest, given = F.substr(e, F.lit(5)), F.substring(e, 3, 2).cast("int")
    return _let(_permuted(rest, key, "iban"), lambda new: F.concat(
        F.substring(e, 1, 2), F.lpad(F.pmod(check(new) + given - check(rest), F.lit(100)).cast("string"), 2, "0"), new))


def _known(value: Column) -> Column:
    return value.isin(*_ALL_GIVEN)


def _given(value: Column, key: str) -> Column:
    out = F
    for kind, names in GIVEN.items():
        listed = F.array(*map(F.lit, names))
        n = len(names)
        step = 1 + _shift(key, "given, " + kind) % (n - 1)
        out = out.when(value.isin(*names), F.element_at(listed, (F.pmod(F.array_position(listed, value) - 1 + step, F.lit(n)) + 1).cast("int")))
    return out.otherwise(_apart(value, key, "name", _known))


def _name(e: Column, key: str) -> Column:
    """Titles stay; a known given name is replaced within its list, any other
    part by its letters."""
    words = F.split(e, " ")
    return F.array_join(F.transform(words, lambda w: F.when(F.regexp_replace(w, r"\.$", "").isin(*TITLES), w).otherwise(
        _given(w, key))), " ")


_BY_TYPE = {"secret": _secret, "email": _email, "ipv4": _ipv4, "iban": _iban, "ssn": lambda e, k: _permuted(e, k, "ssn"),
            "phone": _phone, "card": _card, "name": _name}


def entity_type(e: Column) -> Column:
    """Type of a detected entity."""
    out = F
    for kind, pattern in PATTERNS.items():
        out = out.when(e.rlike(f"^(?:{pattern})$"), F.lit(kind))
    return out


def surrogate(e: Column, key: str = KEY) -> Column:
    """Replacement of a detected entity."""
    return _let(entity_type(e), lambda kind: _choose(kind, e, key))


def _choose(kind: Column, e: Column, key: str) -> Column:
    out = F
    for k, fn in _BY_TYPE.items():
        out = out.when(kind == k, fn(e, key))
    return out.otherwise(e)


def entities(text: Column) -> Column:
    """array<string> of the detected entities, in order; empty for null."""
    found = F.regexp_extract_all(text, F.lit(_ANY), F.lit(0))
    return F.coalesce(F.when(text.rlike(_TRIGGER), found), F.array().cast("array<string>"))


def replaced(text: Column, found: Column, key: str = KEY) -> Column:
    """The text with each detected entity replaced."""
    between = F.split(text, _ANY, -1)
    new = F.transform(found, lambda e: surrogate(e, key))
    joined = F.array_join(F.flatten(F.zip_with(between, new, lambda b, n: F.array(b, F.coalesce(n, F.lit(""))))), "")
    return F.when(F.size(found) > 0, joined).otherwise(text)


def pseudonymise(docs: DataFrame, text_col: str = "text", key: str = KEY) -> DataFrame:
    """``docs`` with the entities in the text replaced, columns as they were."""
    names = [f"_c{i}" for i in range(len(docs.columns))]  # no name of the input can clash
    at = names[docs.columns.index(text_col)]
    found = docs.toDF(*names).select("*", entities(F.col(at)).alias("_found"))
    return found.select(*[replaced(F.col(c), F.col("_found"), key).alias(c) if c == at else F.col(c) for c in names]).toDF(*docs.columns)


def report(docs: DataFrame, key: str = KEY) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: the new text and n_entities."""
    found = docs.select("doc_id", "text", entities(F.col("text")).alias("found"))
    return found.select("doc_id", replaced(F.col("text"), F.col("found"), key).alias("text"),
                        F.size("found").cast("long").alias("n_entities"))


def collisions(docs: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, replacement, n): replacements shared by n different detected values."""
    values = docs.select(F.explode(entities(F.col("text"))).alias("e")).distinct()
    host = F.when(F.col("kind") == "email", F.concat(F.substring_index("e", "@", 1), F.lit("@"), F.lower(F.substring_index("e", "@", -1))))
    same = F.when(F.col("kind") == "ipv4", F.regexp_replace("e", r"(?<![0-9])0+(?=[0-9])", "")).otherwise(F.coalesce(host, "e"))
    return (values.select("e", entity_type(F.col("e")).alias("kind")).select("kind", "e", same.alias("value"))
            .select("kind", "value", surrogate(F.col("e"), key).alias("replacement"))
            .groupBy("kind", "replacement").agg(F.count_distinct("value").alias("n")).where("n > 1"))
