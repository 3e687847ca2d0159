from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import coding, identity, numbers, timestamps

TS = datetime.fromisoformat


def column(df, expression):
    return [row[0] for row in df.select(expression).collect()]


def test_hours_are_boundaries_crossed(frame):
    df = frame(
        "a timestamp, b timestamp",
        (TS("2026-08-01 10:59:00"), TS("2026-08-01 12:01:00")),
        (TS("2026-08-01 10:00:00"), TS("2026-08-01 10:59:59")),
        (TS("2026-08-01 12:01:00"), TS("2026-08-01 10:59:00")),
        (TS("1969-12-31 22:30:00"), TS("1970-01-01 01:10:00")),
        (TS("2026-08-01 12:01:00"), None),
    )
    assert column(df, timestamps.hours_between(F.col("a"), F.col("b"))) == [2, 0, -2, 3, None]


def test_calendar_days_ignore_the_time_of_day(frame):
    df = frame(
        "a timestamp, b timestamp",
        (TS("2026-08-01 23:59:00"), TS("2026-08-02 00:01:00")),
        (TS("2026-08-01 23:59:00"), TS("2026-08-01 01:00:00")),
    )
    assert column(df, timestamps.calendar_days(F.col("a"), F.col("b"))) == [1, 0]


@pytest.mark.parametrize(
    ("value", "digits", "expected"),
    [(3 / 24, 2, 0.12), (9 / 24, 2, 0.38), (2.5, 0, 2.0), (3.5, 0, 4.0), (-0.125, 2, -0.12)],
)
def test_ties_round_to_even(frame, value, digits, expected):
    assert column(frame("x double", (value,)), numbers.half_even(F.col("x"), digits)) == [expected]


def test_division_by_zero_is_null(frame):
    df = frame("a int, b int", (1, 0), (1, None), (1, 4))
    assert column(df, numbers.ratio(F.col("a"), F.col("b"))) == [None, None, 0.25]


def test_whole_numbers_from_numbers_and_text(frame):
    df = frame("x double, t string", (72.0, "72"), (72.5, "72.0"), (None, ""), (1e12, "99999999999"))
    assert column(df, numbers.int_from_number(F.col("x"))) == [72, None, None, None]
    assert column(df, numbers.int_from_text(F.col("t"))) == [72, None, None, None]


def test_numbers_as_text_have_no_trailing_zero(frame):
    df = frame("x float", (30.0,), (30.1,), (None,))
    assert column(df, numbers.number_text(F.col("x"))) == ["30", "30.1", None]


@pytest.mark.parametrize(
    "text",
    [
        "2026-08-01 06:23:00",
        " 2026-08-01T06:23:00 ",
        "2026-08-01 06:23:00.750",
        "2026/08/01 06:23",
        "01/08/2026 06:23:00",
        "20260801062300",
        "1785565380",
    ],
)
def test_timestamps_in_many_layouts(frame, text):
    df = frame("t string", (text,))
    assert column(df, timestamps.parse_timestamp(F.col("t"))) == [TS("2026-08-01 06:23:00")]


@pytest.mark.parametrize("text", ["not a date", "", "   ", None, "2026-13-45 00:00:00", "12"])
def test_unreadable_timestamps_are_null(frame, text):
    df = frame("t string", (text,))
    assert column(df, timestamps.parse_timestamp(F.col("t"))) == [None]


def test_sex_spellings(frame):
    spellings = ["m", "H", "Homme", "MALE", "femme", "Female", "f", "?", "", None]
    df = frame("s string", *[(s,) for s in spellings])
    codes = column(df, coding.normalise_code(F.col("s"), coding.SEX_SYNONYMS))
    assert codes == ["M", "M", "M", "M", "F", "F", "F", "", "", ""]


def test_age_bands(frame):
    df = frame("a int", (-3,), (0,), (9,), (10,), (99,), (100,), (130,), (None,))
    bands = column(df, coding.age_band(F.col("a")))
    assert bands == ["0-9", "0-9", "0-9", "10-19", "90-99", "100+", "100+", "inconnu"]


def test_pseudonyms_are_stable_and_distinct(frame):
    df = frame("id string", ("IPP0000001",), ("IPP0000001",), ("IPP0000002",))
    first, again, other = column(df, identity.pseudonym(F.col("id"), "a salt"))
    assert first == again != other
    assert len(first) == 16 and int(first, 16) >= 0


@pytest.mark.parametrize("salt", ["", None, "change-me", "change-me-now"])
def test_no_pseudonym_without_a_salt(frame, salt):
    with pytest.raises(identity.MissingSalt):
        identity.pseudonym(F.col("id"), salt)


def test_year_prefix(frame):
    df = frame("d string", ("2005-07-02",), (" 1999-01-01",), ("",), (None,))
    assert column(df, identity.year_prefix(F.col("d"))) == ["2005", "1999", "", ""]


def test_fingerprints_see_content_not_order(frame):
    rows = [("f1", "a", None), ("f1", "b", "x"), ("f2", "b", "x"), ("f2", "a", None)]
    rows += [("f3", None, "a"), ("f3", "b", "x"), ("f4", "a", None), ("f4", "b", "x"), ("f4", "b", "x")]
    df = frame("f string, p string, q string", *rows)
    prints = {r.f: (r.sha256, r.rows) for r in identity.fingerprint_groups(df, "f", ["p", "q"]).collect()}
    assert prints["f1"] == prints["f2"]
    assert len({prints[name][0] for name in ("f1", "f3", "f4")}) == 3
    assert prints["f4"][1] == 3
