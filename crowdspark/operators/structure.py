"""Names and layout of image folders, and the plan to rename images."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdspark.functions import text


def structure_report(files: DataFrame, path: str = "path") -> DataFrame:
    """Problems of paths ``.../<site>/<site>_R<roll>/<file>.jpg``, one row per path and problem.

    Files of a badly named roll folder are not checked further.
    """
    parts = F.split(F.col(path), "/")
    site, folder, name = (F.element_at(parts, i) for i in (-3, -2, -1))
    good_folder = text.valid_roll_folder(folder)
    problems = F.array_compact(F.array(
        F.when(~text.valid_site_code(site), "site folder must be alphanumeric"),
        F.when(~good_folder, "roll folder must be <site>_R<number>"),
        F.when(good_folder & (F.substring_index(folder, "_", 1) != site), "roll folder does not start with its site"),
        F.when(good_folder & ~F.lower(name).endswith(".jpg"), "file must end in .jpg"),
    ))
    return files.select(path, F.explode(problems).alias("problem"))


def rename_plan(inventory: DataFrame, files: DataFrame | None = None, source: str = "image_path_original",
                target: str = "image_path") -> DataFrame:
    """Source and destination of every image, with the conflicts that would stop the renaming.

    The files themselves are not moved.
    """
    repeated = inventory.groupBy(F.col(target).alias("_target")).agg((F.count(F.lit(1)) > 1).alias("target_is_repeated"))
    plan = inventory.select(F.col(source).alias("source"), F.col(target).alias("target"))
    plan = plan.join(repeated, F.col("target") == F.col("_target")).drop("_target")
    if files is None:
        return plan.withColumn("target_exists", F.lit(False))
    existing = files.select(F.col("path").alias("_existing")).distinct()
    return plan.join(existing, F.col("target") == F.col("_existing"), "left").withColumn(
        "target_exists", F.col("_existing").isNotNull()).drop("_existing")
