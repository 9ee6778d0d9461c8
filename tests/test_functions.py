"""Column functions against small tables of input and expected output."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates, finance, keys, text


def one_by_one(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_wire_dates(spark):
    cases = {
        "/Date(1609459200000+0000)/": dt.datetime(2021, 1, 1),
        "/Date(1609459200000)/": dt.datetime(2021, 1, 1),
        "/Date(1609459200000+1300)/": dt.datetime(2021, 1, 1),
        "/Date(1700000000123+0000)/": dt.datetime(2023, 11, 14, 22, 13, 20, 123000),
        "2024-06-15T10:30:00": dt.datetime(2024, 6, 15, 10, 30),
        "2024-06-15": dt.datetime(2024, 6, 15),
        "2024-06-15T10:30:00+02:00": dt.datetime(2024, 6, 15, 8, 30),
        "": None, None: None, "not-a-date": None, "/Date(-1000)/": None, "10:30": None, "/Date(99999999999999999)/": None,
        "/Date(8640000000000001)/": None, "/Date(" + "9" * 40 + ")/": None, "/Date(253402300799999)/": dt.datetime(9999, 12, 31, 23, 59, 59, 999000),
    }
    assert one_by_one(spark, list(cases), dates.parse_wire_date) == list(cases.values())


def test_wire_date_round_trip(spark):
    moments = [dt.datetime(1995, 1, 1), dt.datetime(2024, 2, 29, 23, 59, 59, 999000)]
    back = one_by_one(spark, moments, lambda c: dates.parse_wire_date(dates.format_wire_date(c)), "timestamp_ntz")
    assert back == moments


def test_statement_dates(spark):
    d = dt.date
    cases = {
        "2025-03-15": d(2025, 3, 15), "15/03/2025": d(2025, 3, 15), "15-03-2025": d(2025, 3, 15),
        "15/03/2025 10:22": d(2025, 3, 15), "01 Jan 2025": d(2025, 1, 1), "03/04/2025": d(2025, 4, 3),
        "1 march 2025": d(2025, 3, 1), "Mar 5, 2025": d(2025, 3, 5), "2025/3/7": d(2025, 3, 7),
        "05-Jan-2024": d(2024, 1, 5), "5 Jan 24": d(2024, 1, 5), "05 Jan 2024 10:30": d(2024, 1, 5), "Tue, 5 Mar 2024": d(2024, 3, 5),
        "Mar 5 2024": d(2024, 3, 5), "2024-3-5": d(2024, 3, 5), "Sept. 7, 99": d(1999, 9, 7), "30 Feb 2024": None, "5 Foo 2024": None,
        "Tuesday 5 March 2024": d(2024, 3, 5), "31/02/2025": None, "2025-13-45": None, "soon": None, "Mar 2024": None, "": None, None: None,
    }
    assert one_by_one(spark, list(cases), dates.statement_date) == list(cases.values())


def test_report_amounts(spark):
    cases = {
        "1234.56": Decimal("1234.56"), "-99.00": Decimal("-99"), "1,234,567.89": Decimal("1234567.89"),
        "": None, "  ": None, None: None, "N/A": None, "0.00": Decimal(0), "12abc": Decimal(12), ".5": Decimal("0.5"),
        "1e3": Decimal(1000), "1.005": Decimal("1.01"),
    }
    assert one_by_one(spark, list(cases), text.report_amount) == list(cases.values())


def test_plain_number(spark):
    cases = {"100.00": "100", "100": "100", "-42.50": "-42.5", "0": "0", "0.00": "0", "0.000001": "0.000001", "1000": "1000"}
    assert one_by_one(spark, list(cases), lambda c: text.plain_number(c.cast("decimal(38,10)"))) == list(cases.values())


def test_slug_and_trim(spark):
    assert one_by_one(spark, ["MIDDLE EAST", "Acme & Co.", "--x--", "Café"], text.slugify) == [
        "middle-east", "acme-co-", "-x-", "caf-"]
    assert one_by_one(spark, ["  a b\t\n", "﻿x"], text.trim_ws) == ["a b", "x"]


@pytest.mark.parametrize("status,due,overdue,days", [
    ("AUTHORISED", dt.date(2025, 1, 1), True, 30), ("DRAFT", dt.date(2025, 1, 30), True, 1),
    ("AUTHORISED", dt.date(2025, 1, 31), False, None), ("PAID", dt.date(2025, 1, 1), False, None),
    ("AUTHORISED", None, False, None),
])
def test_overdue(spark, status, due, overdue, days):
    df = spark.createDataFrame([(status, due)], "s string, d date")
    as_of = dates.date_literal("2025-01-31")
    got = df.select(finance.is_overdue(F.col("s"), F.col("d"), as_of), finance.days_overdue(F.col("s"), F.col("d"), as_of)).first()
    assert tuple(got) == (overdue, days)


def test_ageing_buckets(spark):
    cases = [(Decimal(10), None), (Decimal(10), 0), (Decimal(10), 1), (Decimal(10), 30), (Decimal(10), 31), (Decimal(10), 60),
             (Decimal(10), 61), (Decimal(10), 90), (Decimal(10), 91), (Decimal(0), 91), (None, 91), (Decimal(-1), 5)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, a decimal(15,2), d int")
    got = [r[0] for r in df.orderBy("i").select(finance.ageing_bucket(F.col("a"), F.col("d"))).collect()]
    assert got == ["current", "current", "1-30", "1-30", "31-60", "31-60", "61-90", "61-90", "90+", "current", "90+", "current"]


def test_freshness_boundaries(spark):
    clock = dt.datetime(2024, 1, 31)
    hour = dt.timedelta(hours=1)
    moments = [clock - 0.5 * hour, clock - hour, clock - 25 * hour + dt.timedelta(microseconds=1), clock - 25 * hour, None]
    got = one_by_one(spark, moments, lambda c: finance.freshness_status(c, dates.ts_literal(clock)), "timestamp_ntz")
    assert got == ["fresh", "recent", "recent", "stale", "never_synced"]
    hours = one_by_one(spark, moments[:4], lambda c: dates.hours_between(dates.ts_literal(clock), c), "timestamp_ntz")
    assert hours == [Decimal("0.5"), Decimal("1.0"), Decimal("25.0"), Decimal("25.0")]


def test_hash_identity(spark):
    def hashes(amount):
        return one_by_one(spark, [amount], lambda c: keys.statement_hash(
            F.lit("t1"), dates.date_literal("2025-01-01"), F.lit("Test"), c.cast("decimal(38,10)")))[0]

    assert hashes("100") == hashes("100.00") != hashes("200")
    assert len(hashes("100")) == 32


def test_surrogate_keys_tell_missing_parts_apart(spark):
    parts = [("a", None, "b"), ("a", "b", None), ("a", "b", ""), ("a|b", None, ""), ("a", "b|", ""), ("a", "\\N", "b")]
    df = spark.createDataFrame(parts, "x string, y string, z string")
    ids = [r[0] for r in df.select(keys.surrogate_key("t", F.col("x"), F.col("y"), F.col("z"))).collect()]
    assert len(set(ids)) == len(parts)
    import hashlib
    plain = spark.createDataFrame([("a", "b")], "x string, y string").select(keys.surrogate_key("t", F.col("x"), F.col("y"))).first()[0]
    assert plain == hashlib.md5(b"t|a|b").hexdigest()
