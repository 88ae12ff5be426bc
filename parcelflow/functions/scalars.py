"""Column helpers that pin down semantics where engines differ."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_scaled(value: Column, digits: int) -> Column:
    """Round half away from zero on the scaled double: scale, round, unscale.

    `F.round(x, k)` rounds the decimal text of the double instead, so 1.005 gives 1.01 there and 1.0 here.
    """
    scale = F.lit(float(10**digits))
    return F.round(value.cast("double") * scale) / scale


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    """`100 * part / whole` as a rounded double; NULL where `whole` is 0."""
    return round_scaled(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits)


def rate(part: Column, whole: Column) -> Column:
    """`part / whole` as an unrounded double; NULL where `whole` is 0."""
    return part.cast("double") / F.nullif(whole, F.lit(0))


def week_start(day: Column) -> Column:
    """Monday of the week of a date."""
    return F.trunc(day, "week")


def day_of_week(day: Column) -> Column:
    """Day number with Sunday = 0."""
    return F.dayofweek(day) - F.lit(1)


def days_between(start: Column, end: Column) -> Column:
    """Whole days from `start` to `end`."""
    return F.datediff(end, start)


def fixed_bin(value: Column, size: int, peg: int = 0) -> Column:
    """Lower bound of the fixed-width bin that holds `value`."""
    return (F.floor((value - F.lit(peg)) / F.lit(float(size))) * size + peg).cast("int")


def is_blank(value: Column) -> Column:
    return value.isNull() | (F.trim(value) == "")


def blank_to_null(value: Column) -> Column:
    return F.when(~is_blank(value), value)


def hash_unit(key: Column, salt: str) -> Column:
    """Stable number in [0, 1) per key and salt: the first 32 bits of an md5."""
    head = F.substring(F.md5(F.concat(F.lit(salt), key)), 1, 8)
    return F.conv(head, 16, 10).cast("double") / F.lit(4294967296.0)


def pick_weighted(unit: Column, choices) -> Column:
    """Choose from `(value, weight)` pairs by a number in [0, 1).

    Weights need not sum to 1 and may be columns; the last choice takes what is left.
    """
    choices = list(choices)
    total = sum(weight for _, weight in choices)
    picked, running = None, 0.0
    for value, weight in choices[:-1]:
        running = running + weight
        below = unit * total < running
        picked = F.when(below, value) if picked is None else picked.when(below, value)
    last = choices[-1][0]
    return F.lit(last) if picked is None else picked.otherwise(last)


def has_member(joined: Column, member: str | Column, separator: str = ";") -> Column:
    """Exact membership in a separated list, so `A_1` is not found in `A_10`."""
    return F.array_contains(F.split(joined, separator), member)


def as_percent_text(value: Column) -> Column:
    text = F.format_string("%.2f%%", round_scaled(value * 100.0, 2))
    return F.when(value.isNotNull(), text).otherwise("n/a")


def as_count_text(value: Column) -> Column:
    return F.coalesce(F.format_number(value, 0), F.lit("n/a"))


def as_decimal_text(value: Column, digits: int = 4) -> Column:
    text = F.format_string(f"%.{digits}f", round_scaled(value, digits))
    return F.when(value.isNotNull(), text).otherwise("n/a")
