"""IBANs before other words and dates with the month first, written out by hand."""

from __future__ import annotations

import datetime as dt
import re

from making import make  # noqa: F401
from pyspark.sql import functions as F

from voidage.llm import pseudonyms as P

# Valid IBANs of 15, 16, 18, 20, 22, 24 and 28 signs.
IBANS = [
    "NO93 8601 1117 947", "BE68 5390 0754 7034", "NL91 ABNA 0417 1643 00", "AT61 1904 3002 3457 3201",
    "DE89 3704 0044 0532 0130 00", "ES91 2100 0418 4502 0005 1332", "SE45 5000 0000 0583 9825 7466",
    "CZ65 0800 0000 1920 0014 5399", "PL61 1090 1014 0000 0712 1981 2874", "BE68539007547034",
]
AFTER = ["", " EUR", " BIC", " USD", " BANK", " 2024", " 12", ".", " IBAN"]


def valid(iban: str) -> bool:
    signs = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in signs[4:] + signs[:4])) % 97 == 1


def test_an_iban_ends_where_its_country_says(make):
    assert all(map(valid, IBANS))
    texts = [f"to {iban}{after}" for iban in IBANS for after in AFTER]
    got = {r.doc_id: r.text for r in P.pseudonymise(make(texts), "k").collect()}
    for i, iban in enumerate(IBANS):
        alone = got[i * len(AFTER)][3:]
        assert alone != iban and valid(alone)
        assert re.sub("[0-9]", "0", re.sub("[A-Z]", "A", alone)) == re.sub("[0-9]", "0", re.sub("[A-Z]", "A", iban))
        assert [got[i * len(AFTER) + k] for k in range(len(AFTER))] == [f"to {alone}{after}" for after in AFTER]


def test_an_iban_after_a_word_like_one(make):
    (row,) = P.pseudonymise(make(["RE12 2024 DE89 3704 0044 0532 0130 00"]), "k").collect()
    assert row.text.startswith("RE12 2024 DE") and "3704 0044" not in row.text and valid(row.text[10:])


def test_month_first_where_day_first_is_no_date(make):
    texts = ["12/31/1999", "on 02/29/2024.", "02/29/2023", "13/32/2000", "12.31.1999", "31/12/1999"]
    got = {r.doc_id: r.text for r in P.pseudonymise(make(texts), "k").collect()}
    assert (got[2], got[3]) == (texts[2], texts[3])
    for i, form in ((0, "%m/%d/%Y"), (4, "%m.%d.%Y"), (5, "%d/%m/%Y")):
        assert got[i] != texts[i] and 1900 <= dt.datetime.strptime(got[i], form).year <= 2099
    assert re.fullmatch(r"on \d\d/\d\d/\d{4}\.", got[1]) and got[1] != texts[1]


def test_month_first_dates_are_permuted_among_themselves(spark):
    first = dt.date(1900, 1, 1)
    days = [d for d in (first + dt.timedelta(n) for n in range(P.DAYS)) if d.day > 12]
    given = spark.createDataFrame([(d.strftime("%m/%d/%Y"),) for d in days[::5]], "v string")
    out = [r.p for r in given.select(P._date(F.col("v"), F.lit("k"), True).alias("p")).collect()]
    assert len(set(out)) == len(out)
    assert set(out) <= {d.strftime("%m/%d/%Y") for d in days}
