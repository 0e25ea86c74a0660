"""Pieces shared by the oracle texts."""

from __future__ import annotations

from collections.abc import Sequence

from parcelpay.sources.fixture_sql import DUCKDB, with_clause

STAMP = "'%d-%m-%Y %H:%M:%S'"


def stamp(text: str) -> str:
    return f"try_strptime({text}, {STAMP})"


def month_label(day: str) -> str:
    return f"rpad(monthname({day}), 9, ' ')"


def as_long(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def as_double(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def sundays(after: str, until: str) -> str:
    """Sundays later than one day and up to another, by whole weeks since a Sunday."""
    return (
        f"(CAST(floor(date_diff('day', DATE '1970-01-04', {until}) / 7.0) AS BIGINT)"
        f" - CAST(floor(date_diff('day', DATE '1970-01-04', {after}) / 7.0) AS BIGINT))"
    )


def query(inputs: Sequence[str], steps: Sequence[tuple[str, str]], final: str) -> str:
    """One statement: the input tables, the named steps and the final SELECT."""
    text = with_clause(DUCKDB, inputs)
    for name, sql in steps:
        text += f",\n{name} AS ({sql})"
    return f"{text}\n{final}"
