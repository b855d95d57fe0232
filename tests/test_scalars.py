from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from remitwise.functions import scalars


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_safe_date(spark):
    cases = {
        "2026-01-05": dt.date(2026, 1, 5), " 2026-01-05 ": dt.date(2026, 1, 5),
        "2026-1-5": dt.date(2026, 1, 5), "2026-01-05 10:30": dt.date(2026, 1, 5),
        "2026-01-05T10:30:59.5": dt.date(2026, 1, 5), "2026": None, "2026-01": None,
        "today": None, "now": None, "0000-01-01": None, "2026-02-30": None, "2026-13-01": None,
        "2026/01/05": None, "20260105": None, "2026-01-05x": None, "2026-01-05\n": None,
        "": None, "   ": None, None: None, "2026-01-05 25:00": None,
    }
    assert values(spark, cases, scalars.safe_date("t")) == list(cases.values())


def test_safe_numeric(spark):
    cases = {
        "185.00": "185.00", " 185 ": "185.00", "-125.00": "-125.00", "+5.": "5.00", ".5": "0.50",
        "1e2": "100.00", "1E-1": "0.10", "0.005": "0.01", "NaN": None, "Infinity": None,
        "1,000": None, "$5": None, "1_000": None, "abc": None, "12 3": None, "": None, None: None,
        "99999999999999999": None, "185.00\n": None,
    }
    want = [None if v is None else Decimal(v) for v in cases.values()]
    assert values(spark, cases, scalars.safe_numeric("t")) == want


def luhn(npi):
    digits = [int(d) for d in "80840" + npi[:9]]
    total = sum(sum(divmod(d * 2, 10)) if i % 2 == 0 else d for i, d in enumerate(digits[::-1]))
    return (10 - total % 10) % 10 == int(npi[9])


def test_npi(spark):
    good = ["1234567893", "1311111102", "1540740739"]
    bad = ["1234567896", "123456789", "12345678931", "123456789X", "1234567893\n", " 1234567893",
           "", None]
    assert values(spark, good + bad, scalars.npi_is_valid("t")) == [True] * 3 + [False] * len(bad)


def test_npi_against_arithmetic(spark):
    numbers = [f"{1_000_000_000 + 7_654_321 * i}" for i in range(300)]
    assert values(spark, numbers, scalars.npi_is_valid("t")) == [luhn(n) for n in numbers]


@pytest.mark.parametrize(("pattern", "good", "bad"), [
    (scalars.CPT_TEXT, ["99213", "9921A"], ["ABCDE", "9921", "99213A", "9921a", "99213\n", ""]),
    (scalars.ICD10_TEXT, ["E11.9", "I10", "J45.909", "M54.50", "T88.7XXA"],
     ["U07.1", "E119", "XX999", "e11.9", "E11.", "E11.12345", "E11.9\n"]),
])
def test_code_formats(spark, pattern, good, bad):
    got = values(spark, good + bad, F.expr(scalars.sql_matches("t", pattern)))
    assert got == [True] * len(good) + [False] * len(bad)


def test_fill_prints_null_as_nothing(spark):
    df = spark.range(1).selectExpr("cast(null as string) as a", "date'2026-01-05' as d",
                                   "cast(5 as decimal(18,2)) as m")
    text = scalars.sql_fill("[{}] on {} for {}", "a", "d", "m")
    assert df.select(F.expr(text)).first()[0] == "[] on 2026-01-05 for 5.00"


def test_business_days_against_calendar(spark):
    def walk(day, n):
        while day.weekday() > 4:
            day -= dt.timedelta(1)
        while n:
            day += dt.timedelta(1)
            n -= day.weekday() < 5
        return day

    days = [dt.date(2026, 1, 1) + dt.timedelta(i) for i in range(21)]
    df = spark.createDataFrame([(d, n) for d in days for n in range(0, 12)], "d date, n int")
    for row in df.select("d", "n", F.expr(scalars.sql_add_business_days("d", "n")).alias("x"),
                         ).collect():
        assert row.x == walk(row.d, row.n), (row.d, row.n)


def test_rate_of_nothing_is_null(spark):
    rate = spark.range(1).select(F.expr(scalars.sql_rate("1L", "0L", 100, 3))).first()[0]
    assert rate is None
