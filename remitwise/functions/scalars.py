"""Expressions of the audit: casts that never fail, format rules, text assembly.

Functions named `sql_*` return Spark SQL text, which one parser call turns into an expression; the
others wrap the same text as a Column. Arguments are column names or SQL text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from remitwise.schemas import MONEY, TOTAL

# ISO date with an optional time. Java's `$` also matches before a final newline, `\z` does not.
DATE_TEXT = (r"^[1-9][0-9]{3}-[0-9]{1,2}-[0-9]{1,2}"
             r"([ T]([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9](\.[0-9]{1,6})?)?)?\z")
NUMBER_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,2})?\z"

# Format rules of the code fields. The ICD-10 rule shuts out the letter U only.
NPI_TEXT = r"^[0-9]{10}\z"
CPT_TEXT = r"^[0-9]{4}[0-9A-Z]\z"
ICD10_TEXT = r"^[A-TV-Z][0-9][0-9A-Z](\.[0-9A-Z]{1,4})?\z"
NPI_PREFIX = "80840"

ZERO = f"cast(0 as {MONEY})"


def sql_matches(c: str, pattern: str) -> str:
    return f"{c} rlike r'{pattern}'"


def sql_blank_to_null(c: str) -> str:
    return f"nullif(trim({c}), '')"


def sql_safe_date(c: str) -> str:
    return f"case when {sql_matches(f'trim({c})', DATE_TEXT)} then try_cast(trim({c}) as date) end"


def sql_safe_numeric(c: str) -> str:
    return (f"case when {sql_matches(f'trim({c})', NUMBER_TEXT)} "
            f"then try_cast(trim({c}) as {MONEY}) end")


def sql_npi_is_valid(c: str) -> str:
    return (f"coalesce({sql_matches(c, NPI_TEXT)} and luhn_check(concat('{NPI_PREFIX}', {c})), "
            "false)")


def sql_money(c: str) -> str:
    """Derived amount rounded half up to cents."""
    return f"cast(round({c}, 2) as {TOTAL})"


def sql_zero(c: str) -> str:
    """Amount with NULL as zero."""
    return f"coalesce({c}, {ZERO})"


def sql_rate(numerator: str, denominator: str, factor: int, digits: int) -> str:
    """`factor * numerator / denominator` rounded to `digits`, NULL when the denominator is 0."""
    share = (f"{factor} * cast({numerator} as decimal(18,0)) "
             f"/ nullif(cast({denominator} as decimal(18,0)), 0)")
    return f"cast(round({share}, {digits}) as decimal(18,{digits}))"


def sql_fill(template: str, *values: str) -> str:
    """`template` with each `{}` replaced by the next value as text; NULL prints as nothing."""
    pieces = template.split("{}")
    parts = [f"'{pieces[0]}'"]
    for value, piece in zip(values, pieces[1:], strict=True):
        parts += [f"coalesce(cast({value} as string), '')", f"'{piece}'"]
    return f"concat({', '.join(parts)})"


def sql_any(conditions: list[str]) -> str:
    """True when one condition is true; a NULL condition counts as false."""
    return "(" + " or ".join(f"coalesce({c}, false)" for c in conditions) + ")"


def sql_sorted_list(c: str, separator: str) -> str:
    """A set as sorted text, NULL for an empty set."""
    return f"nullif(array_join(sort_array({c}), '{separator}'), '')"


def blank_to_null(c: str) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.expr(sql_blank_to_null(c))


def safe_date(c: str) -> Column:
    """ISO date text as a date, NULL for anything else."""
    return F.expr(sql_safe_date(c))


def safe_numeric(c: str) -> Column:
    """Number text as money, NULL for anything else."""
    return F.expr(sql_safe_numeric(c))


def npi_is_valid(c: str) -> Column:
    """True for ten digits whose last is the Luhn check digit over the prefixed number."""
    return F.expr(sql_npi_is_valid(c))


def sql_add_business_days(day: str, days: str) -> str:
    """The date `days` weekdays after `day`; a weekend day counts from the Friday before it."""
    start = f"date_sub({day}, greatest(weekday({day}) - 4, 0))"
    weekends = f"cast(floor((least(weekday({day}), 4) + {days}) / 5) as int)"
    return f"date_add({start}, {days} + 2 * {weekends})"
