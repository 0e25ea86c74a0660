"""Date and time expressions, all built-in columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: layout of the date-time texts in the fact and remittance tables, day-month-year and time of day.
STAMP_PATTERN = r"^\d{2}-\d{2}-\d{4} \d{2}:\d{2}:\d{2}\z"
# A Sunday; weeks are counted from it.
FIRST_SUNDAY = "1970-01-04"


def parse_stamp(text: Column) -> Column:
    """Timestamp of a date-time text, NULL when it does not parse.

    Casting the reordered text takes half the time of parsing it by a format; the pattern admits what the format would.
    """
    day, month, year, time = [F.substring(text, at, n) for at, n in ((1, 2), (4, 2), (7, 4), (11, 9))]
    ordered = F.concat(year, F.lit("-"), month, F.lit("-"), day, time)
    return F.when(text.rlike(STAMP_PATTERN), ordered.try_cast("timestamp"))


def elapsed_seconds(later: Column, earlier: Column) -> Column:
    """Whole seconds from `earlier` to `later`, days included."""
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def within(later: Column, earlier: Column, seconds: int) -> Column:
    """'Yes' when `later` follows `earlier` by at most `seconds`; NULL on either side gives 'No'."""
    return F.when(elapsed_seconds(later, earlier) <= seconds, "Yes").otherwise("No")


def month_label(day: Column) -> Column:
    """English month name padded to nine characters."""
    return F.rpad(F.date_format(day, "MMMM"), 9, " ")


def month_number(day: Column) -> Column:
    return F.month(day).cast("long")


def year_number(day: Column) -> Column:
    return F.year(day).cast("long")


def weekday_from_sunday(day: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(day) - 1


def days_in_month(day: Column) -> Column:
    return F.dayofmonth(F.last_day(day))


def sundays_between(after: Column, until: Column) -> Column:
    """Number of Sundays later than `after` and not later than `until`."""

    def weeks(day: Column) -> Column:
        return F.floor(F.datediff(day, F.lit(FIRST_SUNDAY).cast("date")) / 7)

    return weeks(until) - weeks(after)


def month_working_days(day: Column) -> Column:
    """Days of the month of `day` without Sundays."""
    end = F.last_day(day)
    length = days_in_month(day)
    return (length - sundays_between(F.date_sub(end, length), end)).cast("long")


def full_month(onboarded: Column, day: Column) -> Column:
    """'Yes' when the day before onboarding lies in an earlier year, or in another month of the same year."""
    eve = F.date_sub(onboarded, 1)
    other_month = (F.year(eve) == F.year(day)) & (F.month(eve) != F.month(day))
    return F.when(other_month | (F.year(eve) < F.year(day)), "Yes").otherwise("No")


def available_working_days(onboarded: Column, day: Column) -> Column:
    """Working days of the month, counted from onboarding when the month is not a full one."""
    end = F.last_day(day)
    tail = F.dayofmonth(end) - F.dayofmonth(onboarded) + 1 - sundays_between(F.date_sub(onboarded, 1), end)
    return F.when(full_month(onboarded, day) == "Yes", month_working_days(day)).otherwise(tail.cast("long"))


def week_of_month(day: Column) -> Column:
    """ISO week less the ISO week one month before the month end; negative in early January."""
    return (F.weekofyear(day) - F.weekofyear(F.add_months(F.last_day(day), -1))).cast("long")


def distinct_days(day: Column) -> Column:
    """Aggregate: distinct days within a group that lies in one month.

    One bit per day of the month merges in the map-side aggregate, so no second DISTINCT is planned.
    """
    bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.dayofmonth(day)))
    return F.coalesce(F.bit_count(bits), F.lit(0)).cast("long")
