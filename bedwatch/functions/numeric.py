"""Rounding, ranking and time arithmetic shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F


def round_to(value: Column, digits: int) -> Column:
    """Round half up on the decimal value.

    Going through DECIMAL first removes binary noise such as 1.005 = 1.00499…;
    NaN and infinity become null instead of failing the job.
    """
    return F.round(value.try_cast("decimal(38,10)"), digits).cast("double")


def rank_of(value: Column, ascending: Sequence[str]) -> Column:
    """Position of ``value`` in an ordered enumeration; unknown or null gives null."""
    chain = F.when(value == ascending[0], F.lit(0))
    for position, name in enumerate(ascending[1:], start=1):
        chain = chain.when(value == name, F.lit(position))
    return chain


def worst_of(ascending: Sequence[str], *values: Column) -> Column:
    """The highest of several ordered values; nulls and unknowns are skipped, the floor is the lowest."""
    top = F.greatest(F.lit(0), *[F.coalesce(rank_of(v, ascending), F.lit(0)) for v in values])
    return F.element_at(F.array(*[F.lit(name) for name in ascending]), top + 1)


def lookup(value: Column, table: Mapping[str, str]) -> Column:
    items = iter(table.items())
    key, result = next(items)
    chain = F.when(value == key, F.lit(result))
    for key, result in items:
        chain = chain.when(value == key, F.lit(result))
    return chain


def seconds_between(start: Column, end: Column) -> Column:
    """Exact seconds as a double, keeping fractions."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000.0)


def whole_units_since(start: Column, ts: Column, unit_seconds: float) -> Column:
    """Time since ``start`` in units (minutes by default model), on whole seconds."""
    return (F.unix_timestamp(ts) - F.unix_timestamp(start)) / F.lit(float(unit_seconds))


def age_seconds(ts: Column, as_of: Column) -> Column:
    """Whole seconds of age, never negative; null when there is no data."""
    return F.when(
        ts.isNotNull(),
        F.greatest(F.lit(0), F.floor(seconds_between(ts, as_of))).cast("long"),
    )


def render_time(ts: Column) -> Column:
    from bedwatch.config import TIME_FORMAT

    return F.date_format(ts, TIME_FORMAT)
