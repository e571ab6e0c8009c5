"""Repeatable pseudo-random functions of an identifier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_to_unit(value: Column) -> Column:
    """The first six hex digits of the md5, scaled to 0..1."""
    return F.conv(F.substring(F.md5(value.cast("string")), 1, 6), 16, 10).cast("double") / F.lit(float(0xFFFFFF))


def shuffle_key(seed: int | str, value: Column) -> Column:
    """A repeatable random order: equal seeds give equal orders."""
    return F.md5(F.concat(F.lit(f"{seed}:"), value.cast("string")))


def assign_split(unit: Column, shares: Sequence[float], names: Sequence[str]) -> Column:
    """The split whose cumulative share covers ``unit``; the last split takes the rest."""
    total, split = 0.0, None
    for share, name in zip(shares, names):
        total += share
        split = (F if split is None else split).when(unit <= F.lit(total), F.lit(name))
    return split.otherwise(F.lit(names[-1]))


def anonymous_id(value: Column) -> Column:
    return F.sha1(value.cast("string"))
