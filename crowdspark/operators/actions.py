"""Curation actions: validate an action list, expand it to images and apply it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdspark.defaults import ACTION_FLAGS, ALLOWED_ACTIONS, DATETIME_FORMAT, GROUP_KEYS, IMAGE_FLAGS
from crowdspark.functions.text import filled
from crowdspark.functions.times import parse_datetime, seconds_between, shift_seconds
from crowdspark.operators.ordering import group_positions
from crowdspark.session import stable

TARGETS = ("action_site", "action_roll", "action_from_image", "action_to_image")


def action_problems(allowed: Sequence[str] = ALLOWED_ACTIONS, datetime_format: str = DATETIME_FORMAT) -> Column:
    """The rules an action list row breaks, as an array of messages."""
    site, roll, first, last = (filled(F.col(c)) for c in TARGETS)
    action, reason = F.col("action_to_take"), filled(F.col("action_to_take_reason"))
    current, new = filled(F.col("datetime_current")), filled(F.col("datetime_new"))
    is_shift = action == "timechange"

    def unreadable(text: Column) -> Column:
        return (text != "") & F.try_to_timestamp(text, F.lit(datetime_format)).isNull()

    rules = {
        "action is not allowed": ~F.coalesce(action.isin(list(allowed)), F.lit(False)),
        "timechange needs datetime_current and datetime_new": is_shift & ((current == "") | (new == "")),
        "datetimes are only for timechange": ~is_shift & ((current != "") | (new != "")),
        "reason is missing": reason == "",
        "reason must not contain #": reason.contains("#"),
        "datetime format is wrong": unreadable(current) | unreadable(new),
        "roll needs a site": (roll != "") & (site == ""),
        "no site, roll or image given": (site == "") & (roll == "") & (first == ""),
        "image excludes site and roll": (first != "") & ((site != "") | (roll != "")),
        "from and to image must both be given": (first == "") != (last == ""),
    }
    return F.array_compact(F.array(*[F.when(broken, message) for message, broken in rules.items()]))


def validate_actions(action_list: DataFrame, **options) -> DataFrame:
    """One row per broken rule; an empty result means the list is valid."""
    return action_list.select("action_no", F.explode(action_problems(**options)).alias("problem"))


def action_scope() -> Column:
    """``site_roll``, ``site``, ``image_range`` or ``single_image``."""
    return (
        F.when((F.col("action_site") != "") & (F.col("action_roll") != ""), "site_roll")
        .when(F.col("action_site") != "", "site")
        .when((F.col("action_from_image") != "") & (F.col("action_to_image") != F.col("action_from_image")), "image_range")
        .otherwise("single_image")
    )


def _range_ends(ranges: DataFrame, captures: DataFrame, rolls: DataFrame, keys: Sequence[str], rank: str,
                image: str) -> DataFrame:
    """Ranges with the roll number and the rank of their first and last image."""
    for side in ("from", "to"):
        place = captures.select(F.col(image).alias(f"action_{side}_image"), F.col(rank).alias(f"_{side}_rank"), *keys)
        place = place.join(rolls.select(*keys, F.col("_roll_no").alias(f"_{side}_no")), list(keys)).drop(*keys)
        ranges = ranges.join(place, f"action_{side}_image", "left")
    return ranges


def _in_order() -> Column:
    start, end = F.struct("_from_no", "_from_rank"), F.struct("_to_no", "_to_rank")
    return F.coalesce(F.col("_from_no").isNotNull() & F.col("_to_no").isNotNull() & (start <= end), F.lit(False))


def number_rolls(captures: DataFrame, keys: Sequence[str] = GROUP_KEYS, rank: str = "image_rank_in_roll") -> DataFrame:
    """The rolls with their position in text order and their last rank."""
    rolls = captures.groupBy(*keys).agg(F.max(rank).cast("bigint").alias("_size"))
    return group_positions(rolls, [], list(keys), out="_roll_no")


#: Ranks of a roll are below 2 to this power.
RANK_BITS = 31


def covering_blocks(first: str, end: str) -> Column:
    """SQL for the blocks ``level, block`` that make up the ranks from ``first`` to below ``end``.

    A block of level k holds the 2^k ranks whose number shifted by k is ``block``. At most two blocks of each level are
    needed: the odd one on the left, and the one before an odd end on the right, while the left is below the right.
    """
    left, right = f"((({first}) + shiftleft(1L, k) - 1) div shiftleft(1L, k))", f"(({end}) div shiftleft(1L, k))"
    return F.expr(f"""filter(flatten(transform(sequence(0, {RANK_BITS}), k -> array(
        if({left} < {right} and {left} % 2 = 1, struct(k as level, {left} as block), null),
        if({left} < {right} and {right} % 2 = 1, struct(k as level, {right} - 1 as block), null)))), b -> b is not null)""")


def range_ends(ranges: DataFrame, captures: DataFrame, keys: Sequence[str] = GROUP_KEYS,
               rank: str = "image_rank_in_roll", image: str = "image_name") -> DataFrame:
    """Ranges with the roll numbers and ranks of both ends, null where an image is unknown."""
    return _range_ends(ranges, captures, number_rolls(captures, keys, rank), keys, rank, image)


def _range_images(columns: Sequence[str], ends: DataFrame, captures: DataFrame, keys: Sequence[str], rank: str,
                  image: str) -> DataFrame:
    rolls = number_rolls(captures, keys, rank)
    parts = ends.where(_in_order()).withColumn("_roll_no", F.explode(F.sequence("_from_no", "_to_no"))).join(rolls, "_roll_no")
    parts = parts.withColumns({
        "_first": F.when(F.col("_roll_no") == F.col("_from_no"), F.col("_from_rank")).otherwise(F.lit(0)).cast("bigint"),
        "_end": (F.when(F.col("_roll_no") == F.col("_to_no"), F.col("_to_rank")).otherwise(F.col("_size")) + 1).cast("bigint")})
    blocks = parts.select(*columns, *keys, F.explode(covering_blocks("_first", "_end")).alias("_b")).select(
        *columns, *keys, "_b.level", "_b.block")
    # an image is in one block of each level; only the levels that its roll's ranges use
    levels = blocks.groupBy(*keys).agg(F.collect_set("level").alias("_levels"))
    images = captures.select(F.col(image).alias("image"), F.col(rank).cast("bigint").alias("_rank"), *keys).join(levels, list(keys))
    images = images.withColumn("level", F.explode("_levels")).withColumn("block", F.expr("shiftright(_rank, level)"))
    return blocks.join(images.drop("_levels", "_rank"), [*keys, "level", "block"]).select(*columns, "image")


def images_for_range(ranges: DataFrame, captures: DataFrame, keys: Sequence[str] = GROUP_KEYS,
                     rank: str = "image_rank_in_roll", image: str = "image_name") -> DataFrame:
    """All images between two names in inventory order; a range may cross rolls.

    A range is cut at the rolls it touches and each part into blocks of ranks whose lengths are powers of two, so images
    meet ranges by an equi join on roll and block: it makes the rows of the result and no others, however many short
    ranges share a roll. No side has to be small.
    """
    return _range_images(ranges.columns, range_ends(ranges, captures, keys, rank, image), captures, keys, rank, image)


def _end_problems(ends: DataFrame) -> DataFrame:
    return ends.where(~_in_order()).select(
        "action_no", F.when(F.col("_from_no").isNull() | F.col("_to_no").isNull(), "image of range is unknown")
        .otherwise("last image of range precedes the first").alias("problem"))


def range_problems(ranges: DataFrame, captures: DataFrame, **options) -> DataFrame:
    """Ranges whose images are unknown or whose last image precedes the first."""
    return _end_problems(range_ends(ranges, captures, **options))


def images_for_site(actions: DataFrame, captures: DataFrame, image: str = "image_name") -> DataFrame:
    """Images of the site, or of the site and roll where a roll is given; each kind meets its own images only."""
    of_site = captures.select(F.col("site").alias("action_site"), F.col(image).alias("image"))
    of_roll = captures.select(F.col("site").alias("action_site"), F.col("roll").alias("action_roll"), F.col(image).alias("image"))
    return actions.where("action_roll = ''").join(of_site, "action_site").select(*actions.columns, "image").unionByName(
        actions.where("action_roll <> ''").join(of_roll, ["action_site", "action_roll"]).select(*actions.columns, "image"))


def check_actions(action_list: DataFrame, captures: DataFrame, **options) -> DataFrame:
    """The broken rules of an action list and its ranges without images: ``action_no, problem``."""
    ranges = action_list.where(action_scope() == "image_range")
    return validate_actions(action_list).unionByName(range_problems(ranges, captures, **options))


def generate_actions(action_list: DataFrame, captures: DataFrame, check: bool = True, keys: Sequence[str] = GROUP_KEYS,
                     rank: str = "image_rank_in_roll", image: str = "image_name") -> DataFrame:
    """One row per image and action: ``image, action, reason, shift_time_by_seconds, action_no``.

    A list with broken rules, a range that has no images, or two time changes of one image raise ValueError; the range
    ends and the rows are worked out once, written, and then checked. With ``check=False`` nothing is checked or
    written: see ``check_actions`` and ``repeated_actions`` for the problems as tables.
    """
    scoped = action_list.withColumn("_scope", action_scope())
    ranges = scoped.where(F.col("_scope") == "image_range")
    ends = range_ends(ranges, captures, keys, rank, image)
    if check:
        ends = stable(ends)
        problems = validate_actions(action_list).unionByName(_end_problems(ends)).orderBy("action_no", "problem").limit(20).collect()
        if problems:
            raise ValueError("; ".join(f"action {p.action_no}: {p.problem}" for p in problems))
    single = scoped.where(F.col("_scope") == "single_image").withColumn("image", F.col("action_from_image"))
    expanded = (
        images_for_site(scoped.where(F.col("_scope").isin("site", "site_roll")), captures, image)
        .unionByName(_range_images(ranges.columns, ends, captures, keys, rank, image))
        .unionByName(single)
    )
    shift = seconds_between(parse_datetime(F.col("datetime_current"), [DATETIME_FORMAT]),
                            parse_datetime(F.col("datetime_new"), [DATETIME_FORMAT]))
    made = expanded.select(
        "image", F.col("action_to_take").alias("action"), F.col("action_to_take_reason").alias("reason"),
        F.when(F.col("action_to_take") == "timechange", shift).otherwise(F.lit(0.0)).alias("shift_time_by_seconds"),
        "action_no")
    if check:
        made = stable(made)
        changes = made.where(F.col("action") == "timechange")
        twice = repeated_actions(changes).where("is_error").orderBy("image").limit(20).collect()
        if twice:
            raise ValueError("several time changes of " + ", ".join(r.image for r in twice))
    return made


def repeated_actions(actions: DataFrame) -> DataFrame:
    """Images with the same action twice; for a time change that is an error."""
    counts = actions.groupBy("image", "action").agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)
    return counts.withColumn("is_error", F.col("action") == "timechange")


def unknown_images(actions: DataFrame, captures: DataFrame, image: str = "image_name") -> DataFrame:
    """Actions for images the captures lack."""
    return actions.join(captures.select(F.col(image).alias("image")), "image", "left_anti")


def apply_actions(captures: DataFrame, actions: DataFrame, image: str = "image_name",
                  flags: Sequence[str] = IMAGE_FLAGS, action_flags: Mapping[str, Sequence[str]] = ACTION_FLAGS) -> DataFrame:
    """Shift times, set flags to ``1`` and append the actions and reasons taken, in action order.

    Actions are first brought to one row per image, so captures are joined once.
    """
    setters = {f: [a for a, set_flags in action_flags.items() if f in set_flags] for f in flags}
    steps = F.array_sort(F.collect_list(F.struct("action_no", "action", "reason")))
    per_image = actions.groupBy(F.col("image").alias(image)).agg(
        F.sum(F.when(F.col("action") == "timechange", F.col("shift_time_by_seconds")).otherwise(0.0)).alias("_shift"),
        steps.alias("_steps"),
        *[F.max(F.col("action").isin(setters[f])).alias(f"_{f}") for f in flags],
    )
    joined = captures.join(per_image, image, "left")

    def appended(column: str, field: str) -> Column:
        old = F.nullif(F.col(column), F.lit("")) if column in captures.columns else F.lit(None).cast("string")
        return F.concat_ws("#", old, F.col(f"_steps.{field}"))

    def flag(column: str) -> Column:
        old = filled(F.col(column)) if column in captures.columns else F.lit("")
        return F.when(F.coalesce(F.col(f"_{column}"), F.lit(False)), "1").otherwise(old)

    shifted = F.coalesce(shift_seconds(F.col("datetime"), F.col("_shift")), F.col("datetime"))
    result = joined.withColumns({
        "datetime": shifted, "action_taken": appended("action_taken", "action"),
        "action_taken_reason": appended("action_taken_reason", "reason"), **{f: flag(f) for f in flags}})
    return result.drop("_shift", "_steps", *[f"_{f}" for f in flags])
