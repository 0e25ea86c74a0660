"""Expressions, one case per rule that two readings are possible for."""

from __future__ import annotations

import calendar
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from parcelpay.functions import times as T
from parcelpay.functions.money import gain, loss, slab_price
from parcelpay.functions.workers import worker_model
from parcelpay.rules import SETTLEMENT_LABELS


def rows(spark, data, ddl, **columns):
    return [tuple(r) for r in spark.createDataFrame(data, ddl).select(*[c.alias(n) for n, c in columns.items()]).collect()]


def test_stamp_parses_like_its_format(spark):
    texts = [
        "05-02-2023 23:59:59", "31-12-1999 00:00:00", "29-02-2024 12:00:00", "31-02-2023 00:00:00", "29-02-2023 12:00:00",
        "00-01-2023 00:00:00", "01-13-2023 00:00:00", "01-01-2023 24:00:00", "01-01-2023 10:60:00", "01-01-2023 10:00:60",
        "2023-02-05 10:00:00", "05-02-2023", "5-2-2023 1:00:00", "05-02-2023 10:00:00 ", " 05-02-2023 10:00:00",
        "05-02-2023 10:00:00\n", "05/02/2023 10:00:00", "05-02-2023T10:00:00", "not recorded", "", None,
    ]
    by_format = F.try_to_timestamp(F.col("t"), F.lit("dd-MM-yyyy HH:mm:ss"))
    got = rows(spark, [(t,) for t in texts], "t string", at=T.parse_stamp(F.col("t")), want=by_format)
    assert [a for a, _ in got] == [b for _, b in got]
    assert got[0][0] == datetime(2023, 2, 5, 23, 59, 59)
    assert [a is not None for a, _ in got] == [True] * 3 + [False] * (len(texts) - 3)


def test_window_counts_all_elapsed_seconds_and_includes_its_end(spark):
    base = datetime(2023, 1, 31, 12)
    data = [
        (base + timedelta(seconds=172800), base),
        (base + timedelta(seconds=172801), base),
        (base + timedelta(days=3), base),  # its seconds field alone would be 0
        (base - timedelta(hours=5), base),
        (base, None),
        (None, base),
    ]
    got = rows(spark, data, "a timestamp, b timestamp", ok=T.within(F.col("a"), F.col("b"), 172800))
    assert [g[0] for g in got] == ["Yes", "No", "No", "Yes", "No", "No"]


def test_month_label_is_padded(spark):
    got = rows(spark, [(date(2023, 5, 1),), (date(2023, 9, 30),)], "d date", m=T.month_label(F.col("d")))
    assert got == [("May      ",), ("September",)]


def test_weekday_starts_at_sunday(spark):
    got = rows(spark, [(date(2023, 1, 1),), (date(2023, 1, 7),)], "d date", w=T.weekday_from_sunday(F.col("d")))
    assert got == [(0,), (6,)]


def test_working_days_equal_the_days_that_are_not_sundays(spark):
    months = [date(y, m, 15) for y in range(2020, 2027) for m in range(1, 13)]
    got = rows(spark, [(d,) for d in months], "d date", d=F.col("d"), n=T.month_working_days(F.col("d")))
    for day, n in got:
        length = calendar.monthrange(day.year, day.month)[1]
        sundays = sum(date(day.year, day.month, i).weekday() == 6 for i in range(1, length + 1))
        assert n == length - sundays


def test_availability_from_onboarding(spark):
    cases = [
        (date(2022, 12, 31), date(2023, 1, 10), "Yes", 26),  # an earlier year
        (date(2023, 1, 1), date(2023, 1, 10), "Yes", 26),  # the eve lies in an earlier year
        (date(2023, 2, 15), date(2023, 2, 20), "No", 12),
        (date(2023, 2, 26), date(2023, 2, 28), "No", 2),  # a Sunday
        (date(2023, 4, 30), date(2023, 4, 30), "No", 0),  # a Sunday and the month's last day
        (date(2023, 3, 15), date(2023, 2, 20), "Yes", 24),  # onboarded later, yet another month of the year
        (date(2024, 3, 15), date(2023, 2, 20), "No", None),
    ]
    got = rows(
        spark, [(a, b) for a, b, _, _ in cases], "a date, b date",
        full=T.full_month(F.col("a"), F.col("b")), n=T.available_working_days(F.col("a"), F.col("b")),
    )
    for (_, _, full, n), (got_full, got_n) in zip(cases, got, strict=True):
        assert got_full == full
        if n is not None:
            assert got_n == n


def test_week_of_month_may_be_negative_in_january(spark):
    days = [date(2023, 1, 1), date(2023, 1, 2), date(2023, 3, 31), date(2023, 2, 28)]
    got = rows(spark, [(d,) for d in days], "d date", w=T.week_of_month(F.col("d")))
    iso = [d.isocalendar().week for d in days]
    # One month before 31 January is 31 December, before 31 March the clamped 28 February, before 28 February 28 January.
    earlier = [52, 52, date(2023, 2, 28).isocalendar().week, date(2023, 1, 28).isocalendar().week]
    assert [g[0] for g in got] == [a - b for a, b in zip(iso, earlier, strict=True)]


def test_distinct_days(spark):
    data = [("a", date(2023, 1, 1)), ("a", date(2023, 1, 1)), ("a", date(2023, 1, 31)), ("a", None), ("b", None)]
    df = spark.createDataFrame(data, "k string, d date").groupBy("k").agg(T.distinct_days(F.col("d")).alias("n"))
    assert {tuple(r) for r in df.collect()} == {("a", 2), ("b", 0)}


def test_missing_percent_counts_as_zero(spark):
    got = rows(spark, [(5.0,), (-5.0,), (None,)], "p double", up=gain(F.col("p")), down=loss(F.col("p")))
    assert got == [(5.0, 0.0), (0.0, -5.0), (0.0, 0.0)]


def test_slab_price_inside_at_the_end_and_beyond(spark):
    data = [(20.0, 20.0, 200.0, 5.0, 500.0), (20.5, 20.0, 200.0, 5.0, 500.0), (9.0, 20.0, 200.0, None, None),
            (21.0, 20.0, 200.0, 0.0, 500.0)]
    got = rows(
        spark, data, "w double, hi double, amount double, step double, pay double",
        price=slab_price(*[F.col(c) for c in ("w", "hi", "amount", "step", "pay")]),
    )
    assert got == [(200.0,), (300.0,), (200.0,), (None,)]


def test_worker_model(spark):
    data = [("NO", "na"), ("yes", "yes"), ("yes", "Na"), ("no", "yes"), (None, "NO")]
    got = rows(
        spark, data, "a string, b string", m=worker_model(F.col("a"), F.col("b"), SETTLEMENT_LABELS)
    )
    labels = SETTLEMENT_LABELS
    assert [g[0] for g in got] == [labels.biker, labels.vehicle_with_boy, labels.vehicle_without_boy, None, None]
