"""Text functions: identifiers, file names and naming rules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def filled(column: Column) -> Column:
    """Missing text as the empty string."""
    return F.coalesce(column.cast("string"), F.lit(""))


def empty_to_null(column: Column) -> Column:
    return F.when(column != "", column)


def lookup(mapping: Mapping[str, str], key: Column, default: Column | None = None) -> Column:
    """The mapped value, or the default (the key itself, if not given) where it is not mapped."""
    default = key if default is None else default
    if not mapping:
        return default
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(table, key), default)


def capture_id(season="season", site="site", roll="roll", capture="capture") -> Column:
    return F.concat_ws("#", *[F.col(c).cast("string") for c in (season, site, roll, capture)])


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def join_path(directory: Column, name: Column) -> Column:
    return F.when(directory == "", name).otherwise(F.concat_ws("/", directory, name))


def extension(name: Column) -> Column:
    """The part after the last dot."""
    return F.element_at(F.split(name, "\\."), -1)


def image_name(rank: Column, original: Column) -> Column:
    """``<season>_<site>_R<roll>_IMAG<rank>.<ext>``; the rank has at least four digits."""
    return F.format_string("%s_%s_R%s_IMAG%04d.%s", F.col("season"), F.col("site"), F.col("roll"),
                           rank.cast("int"), extension(original))


def season_path(path: Column, season: Column) -> Column:
    """Prefix a relative path by its season unless its first part already is the season."""
    first = F.regexp_extract(path, "^([^/]*)", 1)
    return F.when((first == season) | path.startswith("/"), path).otherwise(F.concat_ws("/", season, path))


def correct_image_name(path: Column) -> Column:
    """Prefix the file name of ``season/site/site_roll/file`` by season and roll folder.

    File names of four ``_`` parts already have the prefix; two-part names lose their ``_``.
    """
    parts = F.split(path, "/")
    name = F.element_at(parts, -1)
    n_parts = F.size(F.split(name, "_"))
    name = F.when(n_parts == 2, F.replace(name, F.lit("_"), F.lit(""))).otherwise(name)
    third = F.try_element_at(parts, F.lit(3))
    # the fourth part is the file name unless the path is deeper
    fourth = F.when(F.size(parts) == 4, name).otherwise(F.try_element_at(parts, F.lit(4)))
    renamed = F.concat(parent(path), F.lit("/"), F.concat_ws("_", parts[0], third, fourth))
    return F.when(~path.contains("/") | (n_parts == 4), path).otherwise(renamed)


def roll_code(roll: Column) -> Column:
    """``R`` followed by the roll number."""
    return F.upper(F.when(F.lower(roll).startswith("r"), roll).otherwise(F.concat(F.lit("R"), roll)))


def season_code(season: Column) -> Column:
    """``S`` followed by the season number."""
    return F.upper(F.when(F.lower(season).startswith("s"), season).otherwise(F.concat(F.lit("S"), season)))


def season_identifier(season: Column, prefix: str) -> Column:
    """Season with its site prefix, e.g. ``SER_S10``; the prefix ends in ``S``."""
    return (
        F.when(season.startswith(prefix), season)
        .when(season.startswith("S"), F.concat(F.lit(prefix[:-1]), season))
        .otherwise(F.concat(F.lit(prefix), season))
    )


def legacy_image_path(season: Column, site: Column, roll: Column, image: Column) -> Column:
    folder = F.concat_ws("_", site, roll_code(roll))
    return correct_image_name(F.concat_ws("/", season_code(season), site, folder, image))


def legacy_capture_id(season: Column, site: Column, roll: Column, capture: Column, prefix: str) -> Column:
    return F.concat_ws("#", season_identifier(season, prefix), site, F.substring(roll_code(roll), 2, 1000), capture)


def legacy_image_id(season: Column, site: Column, roll: Column, path: Column, prefix: str) -> Column:
    return F.concat_ws("#", season_identifier(season, prefix), site, roll_code(roll), base_name(path))


def image_number(name: Column) -> Column:
    """The four digits before ``.JPG``."""
    return F.regexp_extract(name, r"(\d{4})\.JPG", 1).try_cast("int")


def clean_file_name(path: Column) -> Column:
    """Drop the `` (2)`` a copied file carries."""
    return F.replace(path, F.lit(" (2)"), F.lit(""))


def manifest_file_part(name: Column, part: str, delimiter: str = "__", ext: str = "json") -> Column:
    """``id``, ``batch`` or ``name`` of a manifest file called ``id__batch__name.json``."""
    stem = F.regexp_replace(base_name(name), rf"\.{ext}.*$", "")
    return F.try_element_at(F.split(stem, delimiter), F.lit(("id", "batch", "name").index(part) + 1))


def valid_site_code(site: Column) -> Column:
    return site.rlike(r"^[\p{L}\p{N}]+$")


def valid_roll_code(roll: Column) -> Column:
    return roll.rlike(r"^R\p{N}+$")


def valid_roll_folder(folder: Column) -> Column:
    return folder.rlike(r"^[\p{L}\p{N}]+_R\p{N}+$")
