"""The state of a rider's day and what is rolled up from it."""

from __future__ import annotations

from datetime import date, datetime

from parcelpay.plans import hygiene
from parcelpay.rules import HygieneRules

DDL = (
    "pc_code string, biker_code string, vendor_category string, onboarding_date date, model string, consignment string, "
    "delivery_datetime timestamp, handover_datetime timestamp, delivery_date date"
)


def rows(spark):
    """A rider under two master rows: a consignment in time, one late, one late and read twice, one without a number and
    one without times; a day later another late one; and a delivery without a day."""
    first, second = date(2023, 2, 7), date(2023, 2, 8)
    early, late = datetime(2023, 2, 7, 9), datetime(2023, 2, 1, 9)
    found = []
    for category, start in (("A", date(2022, 1, 5)), ("B", date(2023, 2, 3))):
        who = ("P1", "R1", category, start, "BIKER COMMERCIALS")
        found += [
            (*who, "C1", early, early, first), (*who, "C2", early, late, first), (*who, "C2", early, late, first),
            (*who, None, early, late, first), (*who, "C3", early, None, first), (*who, "C4", datetime(2023, 2, 8, 9), late, second),
            (*who, "C5", None, None, None),
        ]
    return spark.createDataFrame(found, DDL)


def test_a_consignment_fails_once_whatever_the_number_of_master_rows(spark):
    days = {r["delivery_date"]: r for r in hygiene.rider_days(rows(spark), HygieneRules.biker()).collect()}
    # C2, the one without a number, and C3, whose closure is unknown
    assert {d: r["failures"] for d, r in days.items()} == {date(2023, 2, 7): 3, date(2023, 2, 8): 1}
    assert {d: sorted(p["vendor_category"] for p in r["profiles"]) for d, r in days.items()} == dict.fromkeys(days, ["A", "B"])
    assert {r["pay_out_month"] for r in days.values()} == {2}


def test_months_add_up_the_days(spark):
    days = hygiene.rider_days(rows(spark), HygieneRules.biker())
    assert [tuple(r) for r in hygiene.closure_failures(days).collect()] == [("P1", "R1", 2, 4)]


def test_only_master_rows_of_whole_months_attend(spark):
    rules = HygieneRules.biker()
    days = hygiene.rider_days(rows(spark), rules)
    weeks = hygiene.rider_weeks(days, rules).collect()
    wanted = {r["vendor_category"] for r in weeks}
    assert wanted <= {"A"}  # B started within the month
