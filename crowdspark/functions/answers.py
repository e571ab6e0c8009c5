"""Answer values: ordinal counts, rounding and 0/1 answers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from crowdspark.defaults import COUNT_ORDINALS


def count_to_ordinal(count: Column, ordinals: Mapping[str, int] = COUNT_ORDINALS) -> Column:
    """Count answer as a number; ranges take their ordinal."""
    mapped = F.create_map(*[F.lit(x) for pair in ordinals.items() for x in pair])
    return F.coalesce(F.try_element_at(mapped, count), count.try_cast("int"))


def ordinal_to_count(number: Column, ordinals: Mapping[str, int] = COUNT_ORDINALS) -> Column:
    """The inverse of ``count_to_ordinal``; no answers at all give the empty text."""
    mapped = F.create_map(*[F.lit(x) for name, value in ordinals.items() for x in (value, name)])
    return F.coalesce(F.try_element_at(mapped, number.cast("int")), number.cast("int").cast("string"), F.lit(""))


def binary_answer(value: Column) -> Column:
    """1 from one half upwards, 0 below and for text."""
    return F.coalesce(F.floor(value.try_cast("double") + 0.5).cast("int"), F.lit(0))


def rounded_answer(value: Column) -> Column:
    """A number rounded half to even, other text unchanged."""
    return F.coalesce(F.rint(value.try_cast("double")).cast("bigint").cast("string"), value)


def half_up_answer(value: Column) -> Column:
    """A number rounded half up, the empty text unchanged."""
    return F.coalesce(F.floor(value.try_cast("double") + 0.5).cast("string"), value)


def two_decimals(number: Column) -> Column:
    """Decimal text with two places, as the exports print shares."""
    return F.when(number.isNotNull(), F.format_string("%.2f", F.bround(number, 2)))
