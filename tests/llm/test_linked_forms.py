"""One value written in several forms has one pseudonym; written out by hand."""

from __future__ import annotations

import datetime as dt
import re
import warnings

import pytest
from making import make  # noqa: F401

from voidage.llm import pseudonyms as P

IBANS = [
    ("DE89370400440532013000", "DE89 3704 0044 0532 0130 00"),
    ("GB82WEST12345698765432", "GB82 WEST 1234 5698 7654 32"),
    ("BE68539007547034", "BE68 5390 0754 7034"),
]
# All with 30 1234567, or 212 555 0199, after the country code.
PHONES = [
    ("+49 30 1234567", "+49301234567", "+49 (0)30 1234567", "+49-30-1234567", "+49 (30) 123 4567"),
    ("+1 212 555 0199", "+12125550199", "+1 (212) 555-0199", "(212) 555-0199", "212-555-0199", "212.555.0199"),
    ("+358 9 1234567", "+35891234567"),
]
DAYS = [
    ("1999-12-31", "31.12.1999", "31/12/1999", "12/31/1999", "12.31.1999"),
    ("2024-02-29", "29.02.2024", "02/29/2024"),
    ("2001-04-05", "05.04.2001", "05/04/2001"),
]


def all_of(make, values):
    rows = P.pseudonymise(make([f"<{v}>" for v in values]), "k").collect()
    return [r.text[1:-1] for r in sorted(rows, key=lambda r: r.doc_id)]


@pytest.mark.parametrize("forms", IBANS)
def test_ibans(make, forms):
    got = all_of(make, forms)
    assert len({g.replace(" ", "") for g in got}) == 1 and got[0] != forms[0]
    assert [[i for i, c in enumerate(g) if c == " "] for g in got] == [[i for i, c in enumerate(f) if c == " "] for f in forms]
    signs = got[0]
    assert int("".join(str(int(c, 36)) for c in signs[4:] + signs[:4])) % 97 == 1


@pytest.mark.parametrize("forms", PHONES)
def test_phones(make, forms):
    got = all_of(make, forms)
    assert [re.sub("[0-9]", "0", g) for g in got] == [re.sub("[0-9]", "0", f) for f in forms]
    code = re.match(r"\+([0-9]+)", forms[0]).group(1)
    national = []
    for g in got:
        digits = re.sub("[^0-9]", "", g.replace("(0)", ""))
        assert digits.startswith(code) or not g.startswith("+")
        national.append(digits[len(code) :] if g.startswith("+") else digits)
    assert len(set(national)) == 1 and national[0] != re.sub("[^0-9]", "", forms[0])[len(code) :]


@pytest.mark.parametrize("forms", DAYS)
def test_days(make, forms):
    got = all_of(make, forms)
    day = dt.date.fromisoformat(got[0])
    was = dt.date.fromisoformat(forms[0])
    assert day != was and (day.day > 12) == (was.day > 12)
    for form, g in zip(forms[1:], got[1:]):
        month_first = was.day > 12 and form[:2] != f"{was.day:02}"
        assert g == day.strftime(f"%m{form[2]}%d{form[2]}%Y" if month_first else f"%d{form[2]}%m{form[2]}%Y")


def test_key_of_the_session(spark, make):
    docs = make(["4845168114407329"])
    with pytest.warns(UserWarning, match="no secret"):
        assert P.pseudonymise(docs).first().text == P.pseudonymise(docs, P.DEFAULT_KEY).first().text
    spark.conf.set(P.KEY_SETTING, "s")
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("error")
            assert P.pseudonymise(docs).first().text == P.pseudonymise(docs, "s").first().text
    finally:
        spark.conf.unset(P.KEY_SETTING)
