"""Format-preserving pseudonyms for personal data: keyed Feistel permutations as column expressions.

A value is found by its form, validated, and permuted inside its format: letters
stay letters of the same case, digits stay digits, separators stay in place. The
permutation depends only on the key and the kind, and acts on the value itself, not
on how it is written: an IBAN or a phone number with or without spaces, or a date in
another order, gets the same pseudonym in its own form. Equal values get equal
pseudonyms in all documents, and different values different ones.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
DEFAULT_KEY = "replace this key"
#: Session setting that holds the key.
KEY_SETTING = "spark.voidage.pseudonym.key"

#: What may stand between two digits of a phone number.
_BETWEEN = r"(?:[ .-]?\(|\)[ .-]?|[ .-])?"
#: The same, but no space after six digits in line or after a group that a dot or hyphen
#: joins: what follows it is a number of its own.
_WITHIN = (
    r"(?:[ .-]?\(|\)[ .-]?|[.-]|(?<![0-9]{6})"
    + "".join(rf"(?<![.-][0-9]{{{n}}})" for n in range(1, 6))
    + r" )?"
)
#: Countries whose numbers all have the same length, by the digits that follow the code.
_PHONE_DIGITS = {
    10: "1|7|30|44|52|57|90|91|92",
    9: "27|31|33|34|41|48|61|212|351|380|420|421|966",
    8: "45|47|65|852",
}
_FIXED_PHONE = "|".join(
    rf"\+(?:{codes})(?:{_BETWEEN}[0-9]){{{digits}}}(?![0-9A-Za-z])" for digits, codes in _PHONE_DIGITS.items()
)
#: Country codes of one and of two digits; all others have three.
_COUNTRY_1 = "[17]"
_COUNTRY_2 = "20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
#: 8 to 15 digits, as many as there are; from ten on a separate number is not taken in.
_ANY_PHONE = rf"\+[0-9](?:{_BETWEEN}[0-9]){{7,9}}(?:{_WITHIN}[0-9]){{0,5}}"

#: Signs of an IBAN by country, so that a word after it is not taken for its end.
_IBAN_SIGNS = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV",
    22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG",
    25: "AO|CV|GW|LY|MZ|PT|ST", 26: "DZ|IR|IS|TR", 27: "BI|CF|CG|CM|DJ|FR|GA|GQ|GR|IT|KM|MC|MG|MR|SM|TD",
    28: "AL|AZ|BF|BJ|BY|CI|CY|DO|GT|HN|HU|LB|MA|ML|NE|NI|PL|SN|SV|TG", 29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE",
    31: "MT|SC", 32: "LC", 33: "RU",
}


def _iban_form(signs: int, countries: str) -> str:
    groups, rest = divmod(signs - 4, 4)
    return rf"(?:{countries})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}" + (rf" ?[A-Z0-9]{{{rest}}}" if rest else "")


#: Of any other country without spaces, where its end is plain.
_IBAN = "|".join(
    [rf"(?:{_iban_form(n, c)})(?![0-9A-Za-z])" for n, c in _IBAN_SIGNS.items()] + [r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}"]
)

#: Forms of the values that are looked for. Each begins at a place that a longer run
#: of the same signs cannot precede, and has bounded repetition, so a search is
#: linear in the text.
FORMS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){1,8}",
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])",
    "iban": rf"(?<![0-9A-Za-z])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_IBAN})(?![0-9A-Za-z])",
    "phone": rf"(?<![0-9A-Za-z+])(?:{_FIXED_PHONE}|{_ANY_PHONE})(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    "date": r"(?<![0-9A-Za-z.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})(?![0-9A-Za-z]|[./-][0-9])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{1,7}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{1,7}"
    r"|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z])",
}
ANY = "|".join(f"(?:{form})" for form in FORMS.values())

FIRST_DAY, DAYS = "1900-01-01", 73_049  # to 2099-12-31


def _number(hexadecimal: Column) -> Column:
    return F.conv(hexadecimal, 16, 10).cast("long")


def _mixed(value: Column, radix_a: int, radix_b: int, key: Column) -> Column:
    """A permutation of 0 .. radix_a * radix_b - 1: halves in Z_a and Z_b, turned in alternation."""
    state = F.struct((value / F.lit(radix_b)).cast("long").alias("a"), (value % F.lit(radix_b)).cast("long").alias("b"))

    def turn(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        mixed = _number(
            F.substring(F.sha2(F.concat_ws(":", key, i.cast("string"), F.when(even, s["b"]).otherwise(s["a"]).cast("string")), 256), 1, 12)
        )
        return F.struct(
            F.when(even, (s["a"] + mixed) % radix_a).otherwise(s["a"]).alias("a"),
            F.when(even, s["b"]).otherwise((s["b"] + mixed) % radix_b).alias("b"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), state, turn, lambda s: s["a"] * radix_b + s["b"])


def _shifted(half: Column, other: Column, key: Column) -> Column:
    """``half`` with every sign moved on in its class by a stream that ``other`` and the key give."""
    stream = F.sha2(F.concat_ws(":", key, other), 512)

    def sign(c: Column, i: Column) -> Column:
        by = _number(F.substr(stream, (i % 64) * 2 + 1, F.lit(2)))
        code = F.ascii(c)
        turned = lambda base, n: F.char(F.lit(base) + (code - base + by) % n)
        return (
            F.when(c.rlike("^[0-9]$"), turned(48, 10))
            .when(c.rlike("^[a-z]$"), turned(97, 26))
            .when(c.rlike("^[A-Z]$"), turned(65, 26))
            .otherwise(c)
        )

    signs = F.when(F.length(half) > 0, F.transform(F.split(half, "(?!$)"), sign)).otherwise(F.array().cast("array<string>"))
    return F.array_join(signs, "")


def feistel(value: Column, kind: str, key: Column) -> Column:
    """A permutation of the strings of the same form as ``value``: its halves are turned in alternation."""
    middle = F.ceil(F.length(value) / 2).cast("int")
    state = F.struct(
        F.substr(value, F.lit(1), middle).alias("a"), F.substr(value, middle + 1, F.lit(1 << 30)).alias("b")
    )

    def turn(s: Column, i: Column) -> Column:
        round_key = F.concat_ws(":", key, F.lit(kind), i.cast("string"))
        even = i % 2 == 0
        return F.struct(
            F.when(even, _shifted(s["a"], s["b"], round_key)).otherwise(s["a"]).alias("a"),
            F.when(even, s["b"]).otherwise(_shifted(s["b"], s["a"], round_key)).alias("b"),
        )

    return F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)), state, turn, lambda s: F.concat(s["a"], s["b"])
    )


def _digit_sum(digits: Column, double_last: bool) -> Column:
    """Luhn's sum; ``double_last`` where the check digit is still to come."""
    values = F.transform(F.split(F.reverse(digits), "(?!$)"), lambda c: c.cast("int"))
    weighed = F.transform(
        values, lambda d, i: F.when(i % 2 == (0 if double_last else 1), F.floor(d * 2 / 10).cast("int") + d * 2 % 10).otherwise(d)
    )
    return F.aggregate(weighed, F.lit(0), lambda s, d: s + d)


def _refill(form: Column, signs: Column, those: str = "^[0-9]$") -> Column:
    """``form`` with its digits (or the signs that match ``those``), from the left, replaced by ``signs``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def sign(s: Column, c: Column) -> Column:
        is_one = c.rlike(those)
        return F.struct(
            F.concat(s["out"], F.when(is_one, F.substr(signs, s["at"], F.lit(1))).otherwise(c)).alias("out"),
            (s["at"] + F.when(is_one, 1).otherwise(0)).alias("at"),
        )

    return F.aggregate(F.split(form, "(?!$)"), start, sign, lambda s: s["out"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _card(value: Column, key: Column) -> Column:
    digits = _digits(value)
    body = feistel(F.substr(digits, F.lit(1), F.length(digits) - 1), "card", key)
    check = (10 - _digit_sum(body, True) % 10) % 10
    return _refill(value, F.concat(body, check.cast("string")))


def _is_card(value: Column) -> Column:
    digits = _digits(value)
    return F.length(digits).between(13, 19) & (_digit_sum(digits, False) % 10 == 0)


def _mod97(text: Column) -> Column:
    """Remainder by 97 of an IBAN's signs in check order, letters as two digits."""
    return F.aggregate(
        F.split(text, "(?!$)"),
        F.lit(0),
        lambda s, c: F.when(c.rlike("[0-9]"), (s * 10 + c.cast("int")) % 97).otherwise((s * 100 + F.ascii(c) - 55) % 97),
    )


def _is_iban(value: Column) -> Column:
    plain = F.replace(value, F.lit(" "), F.lit(""))
    return F.length(plain).between(15, 34) & (
        _mod97(F.concat(F.substr(plain, F.lit(5), F.lit(34)), F.substr(plain, F.lit(1), F.lit(4)))) == 1
    )


def _iban(value: Column, key: Column) -> Column:
    country = F.substr(value, F.lit(1), F.lit(2))
    body = feistel(F.substr(F.replace(value, F.lit(" "), F.lit("")), F.lit(5), F.lit(64)), "iban", key)
    check = 98 - _mod97(F.concat(body, country, F.lit("00")))
    return _refill(value, F.concat(country, F.lpad(check.cast("string"), 2, "0"), body), "^[0-9A-Z]$")


def _is_ip(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda o: (o.cast("int") <= 255) & (~o.rlike("^0[0-9]")))


def _ip(value: Column, key: Column) -> Column:
    number = F.aggregate(F.split(value, r"\."), F.lit(0).cast("long"), lambda s, o: s * 256 + o.cast("long"))
    moved = _mixed(number, 1 << 16, 1 << 16, F.concat(key, F.lit(":ip")))
    return F.aggregate(
        F.array(*[F.lit(x) for x in (24, 16, 8, 0)]),
        F.struct(F.lit("").alias("out"), moved.alias("n")),
        lambda s, by: F.struct(
            F.concat(
                s["out"],
                F.when(s["out"] == "", F.lit("")).otherwise(F.lit(".")),
                ((s["n"] / F.pow(F.lit(2), by)).cast("long") % 256).cast("string"),
            ).alias("out"),
            s["n"].alias("n"),
        ),
        lambda s: s["out"],
    )


def _day(value: Column, month_first: bool = False) -> Column:
    """The date that ``value`` writes, null if there is none such from 1900 to 2099."""
    parts = F.split(value, "[./-]")
    iso = value.rlike("^[0-9]{4}")
    year, month, day = (
        F.when(iso, parts[0]).otherwise(parts[2]),
        F.when(iso, parts[1]).otherwise(parts[0 if month_first else 1]),
        F.when(iso, parts[2]).otherwise(parts[1 if month_first else 0]),
    )
    date = F.try_to_date(F.concat_ws("-", year, month, day), "yyyy-MM-dd")
    return F.when(date.between(F.lit(FIRST_DAY).cast("date"), F.date_add(F.lit(FIRST_DAY).cast("date"), DAYS - 1)), date)


def _date(value: Column, key: Column, month_first: bool = False) -> Column:
    # 271 * 270 is the next product above the number of days: a result beyond the
    # last day is permuted again, so the days are permuted among themselves. So are those
    # after the 12th and those up to it: a date that can only be read month first stays one,
    # is none other's pseudonym, and has that of the same day in another order.
    secret = F.concat(key, F.lit(":date"))
    day_of = lambda n: F.date_add(F.lit(FIRST_DAY).cast("date"), n.cast("int"))
    day = _day(value, month_first)
    late = F.dayofmonth(day) > 12
    moved = F.aggregate(
        F.sequence(F.lit(1), F.lit(128)),
        _mixed(F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("long"), 271, 270, secret),
        lambda n, i: F.when((n < DAYS) & ((F.dayofmonth(day_of(n)) > 12) == late), n).otherwise(_mixed(n, 271, 270, secret)),
    )
    date = day_of(moved)
    if month_first:
        return F.when(value.contains("/"), F.date_format(date, "MM/dd/yyyy")).otherwise(F.date_format(date, "MM.dd.yyyy"))
    return (
        F.when(value.rlike("^[0-9]{4}"), F.date_format(date, "yyyy-MM-dd"))
        .when(value.contains("/"), F.date_format(date, "dd/MM/yyyy"))
        .otherwise(F.date_format(date, "dd.MM.yyyy"))
    )


def pseudonym(value: Column, key: Column) -> Column:
    """The pseudonym of a found value; the value itself where it fails its validation."""
    kind = lambda name: value.rlike(f"^(?:{FORMS[name]})$")
    at = F.instr(value, "@")
    domain = F.substr(value, at, F.lit(1 << 20))
    return (
        F.when(value.contains("@"), F.concat(feistel(F.substr(value, F.lit(1), at - 1), "email", key), domain))
        .when(kind("ip"), F.when(_is_ip(value), _ip(value, key)).otherwise(value))
        .when(kind("iban"), F.when(_is_iban(value), _iban(value, key)).otherwise(value))
        .when(
            kind("phone"),
            F.when(F.length(_digits(value)).between(8, 15), _phone(value, key)).otherwise(value),
        )
        .when(
            kind("ssn"),
            F.when(value.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"), _ssn(value, key)).otherwise(value),
        )
        .when(
            kind("date"),
            F.when(_day(value).isNotNull(), _date(value, key))
            .when(_day(value, True).isNotNull(), _date(value, key, True))
            .otherwise(value),
        )
        .when(kind("card"), F.when(_is_card(value), _card(value, key)).otherwise(value))
        .otherwise(value)
    )


def _phone(value: Column, key: Column) -> Column:
    """The country code stays, and a ``(0)`` after it; the rest is permuted, as in a number without a code."""
    digits = _digits(value)
    code = F.when(
        value.startswith("+"), F.regexp_extract(digits, rf"^(?:{_COUNTRY_1}|(?:{_COUNTRY_2})|[0-9]{{3}})", 0)
    ).otherwise("")
    trunk = F.when(F.regexp_extract(value, r"^\+([0-9]{1,3})[ .-]?\(0\)", 1) == code, F.lit("0")).otherwise("")
    trunk = F.when(code == "", F.lit("")).otherwise(trunk)
    kept = F.concat(code, trunk)
    return _refill(value, F.concat(kept, feistel(F.substr(digits, F.length(kept) + 1, F.lit(64)), "phone", key)))


def _ssn(value: Column, key: Column) -> Column:
    """Permuted again until the number is a valid one, so that valid numbers are permuted among themselves."""
    valid = "^(?!000|666|9)[0-9]{3}(?!00)[0-9]{2}(?!0000)[0-9]{4}$"
    moved = F.aggregate(
        F.sequence(F.lit(1), F.lit(24)),
        feistel(_digits(value), "ssn", key),
        lambda n, i: F.when(n.rlike(valid), n).otherwise(feistel(n, "ssn", key)),
    )
    return _refill(value, moved)


def session_key(docs: DataFrame) -> str:
    """The key that the session names in ``KEY_SETTING``; ``DEFAULT_KEY``, which is no secret, where it names none."""
    key = docs.sparkSession.conf.get(KEY_SETTING, None)
    if key is None:
        warnings.warn(f"{KEY_SETTING} is not set: pseudonyms are made with a key that is no secret", stacklevel=3)
    return key or DEFAULT_KEY


def pseudonymise(docs: DataFrame, key: str | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, personal data in ``text_col`` replaced, whole texts, no shuffle.

    Emails (local part), IPv4 addresses, IBANs, phone numbers, social security
    numbers, dates of 1900 to 2099 and card numbers. Numbers that fail their check
    (Luhn, remainder 97, octets, calendar) stay. Null texts stay null; every other
    column and every row stays, repeated ones too. Without a ``key`` it is the session's.
    Whether a day is after the 12th of its month shows in its pseudonym.
    """
    text, secret = docs[text_col], F.lit(session_key(docs) if key is None else key)
    found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    between = F.split(text, ANY, -1)
    tail = F.array(F.lit(""))
    joined = F.array_join(
        F.zip_with(between, F.concat(F.transform(found, lambda v: pseudonym(v, secret)), tail), lambda gap, v: F.concat(gap, v)),
        "",
    )
    # Most texts have no sign that every form needs; one cheap search tells.
    replaced = F.when(text.rlike("[0-9@]"), joined).otherwise(text)
    return docs.select(*[replaced.alias(c) if c == text_col else docs[c] for c in docs.columns])
