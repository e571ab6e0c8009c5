"""Flat legacy classification exports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crowdspark.defaults import EMPTY_ANSWER, LEGACY_FLAG_QUESTIONS, LEGACY_QUESTIONS, LEGACY_SEASON_PREFIX
from crowdspark.functions import text
from crowdspark.functions.text import filled
from crowdspark.operators.consensus import answer_shares

MAX_IMAGES = 3


def map_legacy_answers(df: DataFrame, flags: Sequence[str] = LEGACY_FLAG_QUESTIONS) -> DataFrame:
    """Blank names of ``species`` become ``blank``; true and false become 1 and 0."""
    species = F.when(F.col("species").isin("no animals present", "nothing", ""), EMPTY_ANSWER).otherwise(F.col("species"))
    values = {f: F.when(F.col(f) == "true", "1").when(F.col(f) == "false", "0").otherwise(F.col(f)) for f in flags}
    return df.withColumns({"species": species, **values})


def image_captures(images: DataFrame, prefix: str = LEGACY_SEASON_PREFIX) -> DataFrame:
    """Image id and capture id of an image table (``season, site, roll, capture, path``)."""
    season, site, roll = F.col("season"), F.col("site"), F.col("roll")
    return images.select(
        text.legacy_image_id(season, site, roll, F.col("path"), prefix).alias("image_id"),
        text.legacy_capture_id(season, site, roll, F.col("capture"), prefix).alias("capture_id"))


#: What an image list is looked up by.
LIST_KEY = ("season", "site", "roll", "filenames")


def explode_file_names(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per file name of the ``;`` list, with its position."""
    return df.select(*keep, F.posexplode(F.split("filenames", ";")).alias("position", "image"))


def captures_of_images(classified: DataFrame, images: DataFrame, prefix: str = LEGACY_SEASON_PREFIX) -> DataFrame:
    """Captures of the images of each subject's lists, with their place: the lowest image number comes first.

    ``classified(subject_id, season, site, roll, filenames)`` lies by subject, so equal lists of a subject are looked up
    once, however many annotations name them.
    """
    key = ["subject_id", *LIST_KEY]
    listed = explode_file_names(classified.select(*key).distinct(), key)
    image_id = F.concat_ws("#", text.season_identifier(F.col("season"), prefix), "site", text.roll_code(F.col("roll")), "image")
    number = text.image_number(F.col("image"))
    found = listed.select(*key, image_id.alias("image_id"), number.alias("number"), "position").join(images, "image_id")
    return found.select(*key, F.col("capture_id").alias("_capture"), F.struct("number", "position").alias("_place"))


def resolve_captures(classifications: DataFrame, subject_captures: DataFrame, images: DataFrame,
                     prefix: str = LEGACY_SEASON_PREFIX, order_by: Sequence[str] = ("capture_id",)) -> DataFrame:
    """Add ``capture_id`` and ``reject_reason``: by subject first, by image names where the subject is unknown.

    Of several rows of a subject in ``subject_captures(subject_id, capture_id)`` or of an image in
    ``images(image_id, capture_id)`` the last by ``order_by`` counts. If the images of a list belong to several captures, the
    one of the lowest image number is taken. The rows are exchanged once, by subject, together with the captures of
    subjects and of their lists that were found; the result lies by subject. Only lists that can be looked up, neither
    empty nor too long, and whose subject is unknown, are exchanged by their images.
    """
    kind = classifications.schema["subject_id"].dataType
    by_subject = subject_captures.groupBy(F.col("subject_id").cast(kind).alias("subject_id")).agg(
        F.max_by("capture_id", F.struct(*order_by)).alias("_by_subject")).where(
        F.col("subject_id").isNotNull() & F.col("_by_subject").isNotNull())
    images = images.groupBy("image_id").agg(F.max_by("capture_id", F.struct(*order_by)).alias("capture_id"))
    n_names = F.size(F.split("filenames", ";"))
    # a list with a missing part has no capture
    has_list = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in LIST_KEY]) & (F.col("filenames") != "") & (n_names <= MAX_IMAGES)
    listed = classifications.where(has_list).select("subject_id", *LIST_KEY).join(by_subject, "subject_id", "left_anti")
    found = captures_of_images(listed, images, prefix)
    gathered = classifications.withColumn("_row", F.lit(True))
    for captures in (found, by_subject):
        gathered = gathered.unionByName(captures, allowMissingColumns=True)
    joined = gathered.repartition("subject_id").withColumn(
        "_by_images", F.min_by("_capture", "_place").over(Window.partitionBy("subject_id", *LIST_KEY))).withColumn(
        "_by_subject", F.max("_by_subject").over(Window.partitionBy("subject_id"))).where("_row")
    known = F.coalesce("_by_subject", "_by_images")
    return joined.withColumns({
        "capture_id": F.coalesce(known, F.lit("")),
        "reject_reason": F.when(F.col("season") == "tutorial", "not_eligible")
        .when(F.col("_by_subject").isNotNull(), None)
        .when(F.col("filenames") == "", "without_images")
        .when(n_names > MAX_IMAGES, "too_many_images")
        .when(F.col("_by_images").isNull(), "capture_not_found"),
    }).drop("_row", "_capture", "_place", "_by_subject", "_by_images")


def first_classification_rows(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """All rows of the first classification of each user and subject; rows without one of them are left out.

    ``df`` is read once, and its rows are exchanged once.
    """
    first = F.min_by("classification_id", F.struct(*order_by)).over(Window.partitionBy("user_name", "subject_id"))
    known = df.where(F.col("user_name").isNotNull() & F.col("subject_id").isNotNull())
    return known.withColumn("_first", first).where(F.col("classification_id") == F.col("_first")).drop("_first")


def consolidate_annotations(df: DataFrame, order_by: Sequence[str], keys: Sequence[str] = ("classification_id", "species"),
                            questions: Sequence[str] = LEGACY_QUESTIONS) -> DataFrame:
    """One row per classification and species that was named several times.

    Counts are added up in order: 11-50 wins always, else 51+, else an empty count, and a sum above 10
    becomes 11-50 if it is reached before any empty or 51+ count. Other answers take their maximum, all
    further columns their last value. The rule is written as sums and minima over a window, so no list of the rows
    is folded; ``df`` is read once and exchanged once, by ``keys``.
    """
    keys, number = list(keys), F.col("count").try_cast("int")
    answers = [q for q in questions if q in df.columns and q not in keys and q != "count"]
    others = [c for c in df.columns if c not in [*keys, *answers, "count"]]
    ordered = Window.partitionBy(*keys).orderBy(F.col("_order").desc())
    group = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = df.withColumn("_order", F.struct(*order_by)).withColumns({
        "_back": F.row_number().over(ordered), "_n": F.count(F.lit(1)).over(group),
        "_mid": F.count_if(F.col("count") == "11-50").over(group), "_high": F.count_if(F.col("count") == "51+").over(group),
        "_sum": F.sum(number).over(group), "_stop": F.min(F.when(F.col("count").isin("", "51+"), F.col("_order"))).over(group),
        **{f"_max_{a}": F.max(a).over(group) for a in answers}})
    # groups that mix numbers with an empty or 51+ count need to know which came first; those with a missing key do not
    early = F.when(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]) & (F.col("_order") < F.col("_stop")), number)
    rows = rows.withColumns({"_early": F.sum(early).over(group), "_n_early": F.count(early).over(group)}).where(F.col("_back") == 1)
    count = (
        F.when(F.col("_n") == 1, F.col("count"))
        .when(F.col("_mid") > 0, "11-50")
        .when(F.col("_stop").isNull(), F.when(F.col("_sum") > 10, "11-50").otherwise(F.col("_sum").cast("string")))
        .when((F.col("_early") > 10) & (F.col("_n_early") > 1), "11-50")
        .when(F.col("_high") > 0, "51+").otherwise("")
    )
    result = rows.select(*keys, *[F.col(f"_max_{a}").alias(a) for a in answers], count.alias("count"), *others)
    return result.select(*df.columns)


def extract_legacy_annotations(df: DataFrame, subject_captures: DataFrame, images: DataFrame, order_by: Sequence[str],
                               prefix: str = LEGACY_SEASON_PREFIX) -> DataFrame:
    """Eligible legacy annotations with their capture, consolidated per classification and species."""
    resolved = resolve_captures(df, subject_captures, images, prefix).where(F.col("reject_reason").isNull())
    mapped = map_legacy_answers(resolved.drop("reject_reason"))
    with_capture = mapped.withColumn("capture", F.element_at(F.split("capture_id", "#"), -1))
    return consolidate_annotations(first_classification_rows(with_capture, order_by), order_by)


def reject_stats(resolved: DataFrame) -> DataFrame:
    """Rows per reject reason, ``kept`` for the others."""
    return resolved.groupBy(F.coalesce("reject_reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("count"))


def legacy_answer_stats(df: DataFrame, columns: Sequence[str] = (*LEGACY_QUESTIONS, "season", "retirement_reason")) -> DataFrame:
    """Count, total and percentage of each answer, season and retirement reason."""
    return answer_shares(df, list(columns), places=2, answer=filled)
