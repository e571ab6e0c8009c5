"""EXIF tag maps with ``group:tag`` keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from crowdspark.defaults import (
    EXIF_DATETIME_FORMAT, EXIF_EXCLUDED_TAGS, EXIF_GROUPS, EXIF_TIMESTAMP_TAGS, TAG_PREFIX,
)
from crowdspark.functions.text import empty_to_null


def select_tags(tags: Column, groups: Sequence[str] = EXIF_GROUPS, excluded: Sequence[str] = EXIF_EXCLUDED_TAGS,
                prefix: str = TAG_PREFIX) -> Column:
    """Tags of the given groups without the excluded ones, their names prefixed."""
    def wanted(key: Column, _: Column) -> Column:
        in_group = F.lit(False)
        for group in groups:
            in_group = in_group | key.startswith(group)
        return in_group & ~key.isin(list(excluded))

    return F.transform_keys(F.map_filter(tags, wanted), lambda key, _: F.concat(F.lit(prefix), key))


def exif_datetime(tags: Column, fields: Sequence[str] = EXIF_TIMESTAMP_TAGS, fmt: str = EXIF_DATETIME_FORMAT) -> Column:
    """The first timestamp tag that parses."""
    return F.coalesce(*[F.try_to_timestamp(F.try_element_at(tags, F.lit(f)), F.lit(fmt)) for f in fields]).cast(
        "timestamp_ntz")


def tag_checks(tags: Column) -> dict[str, Column]:
    """``corrupt_exif`` without a tag map, ``empty_exif`` with an empty one."""
    return {
        "image_check__corrupt_exif": tags.isNull().cast("int"),
        "image_check__empty_exif": F.coalesce(F.size(tags) == 0, F.lit(False)).cast("int"),
    }


def best_datetime(exif: Column, file_creation: Column) -> Column:
    """The EXIF time, else the file's time, else empty (all as text)."""
    return F.coalesce(empty_to_null(exif), empty_to_null(file_creation), F.lit(""))
