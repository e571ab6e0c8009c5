"""Training data: splits, samples and the records of the training file."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdspark.functions import text
from crowdspark.functions.answers import binary_answer
from crowdspark.functions.hashing import assign_split, hash_to_unit, shuffle_key
from crowdspark.operators.ordering import first_n_per_group, group_positions, lowest_hashes
from crowdspark.operators.predictions import first_images

SPLIT_NAMES, SPLIT_SHARES = ("train", "val", "test"), (0.9, 0.05, 0.05)


def split_name(capture_id: Column, season: Column, shares: Sequence[float] = SPLIT_SHARES,
               names: Sequence[str] = SPLIT_NAMES) -> Column:
    """Split of a capture with its season, ``train_<season>``; equal captures always get the same one."""
    return F.concat_ws("_", assign_split(hash_to_unit(capture_id), shares, names), F.lower(season))


def training_rows(df: DataFrame, season_prefix: str = "", counts: Mapping[str, str] | None = None,
                  behaviours: Sequence[str] = (), path_prefix: str = "SER/") -> DataFrame:
    """Database rows as training rows.

    Needs ``season, site, roll, capture, path, timestamp, n_species, species, count`` and the behaviour
    columns. Adds the capture id, the empty/species flag and the split; unreadable times become 1900.
    """
    time = F.coalesce(F.try_to_timestamp("timestamp", F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz"),
                      F.lit("1900-01-01 00:00:00").cast("timestamp_ntz"))
    is_empty = F.col("n_species") == "0"
    count = F.when(is_empty, "0").otherwise(F.col("count"))
    rows = df.withColumns({
        "timestamp": F.date_format(time, "yyyy-MM-dd-HH-mm-ss"),
        "image": F.concat(F.lit(path_prefix), text.correct_image_name(F.col("path"))),
        "empty": F.when(is_empty, "empty").otherwise("species"),
        "species": F.lower(F.when(is_empty, "empty").otherwise(F.col("species"))),
        "count": text.lookup(counts or {}, count),
        "location": F.col("site"),
        "season": F.concat(F.lit(season_prefix), "season"),
        **{b: binary_answer(F.col(b)) for b in behaviours},
    })
    rows = rows.withColumn("capture_id", text.capture_id())
    return rows.withColumn("split_name", split_name(F.col("capture_id"), F.col("season")))


def capture_records(rows: DataFrame, order_by: Sequence[str], columns: Sequence[str], n_images: int = 3) -> DataFrame:
    """One record per capture and species: its last row, and the first different images of the capture."""
    distinct = rows.groupBy("capture_id", F.col("image").alias("path")).agg(F.min(F.struct(*order_by)).alias("_first"))
    images = first_images(distinct, n_images, ["_first"])
    last = first_n_per_group(rows, ["capture_id", "species"], [F.col(c).desc() for c in order_by], 1)
    keep = [c for c in columns if c not in ("capture_id", "species")]
    return last.select("capture_id", "species", *keep).join(images, "capture_id")


def test_split_only(df: DataFrame, location: str = "location", season: str = "season") -> DataFrame:
    """Rows of ``test_<location>_<season>`` splits, image paths prefixed by the location."""
    rows = df.where(F.col("split_name") == F.concat_ws("_", F.lit("test"), location, season))
    paths = {c: F.when(F.col(c) == "", "").otherwise(F.concat_ws("/", F.col(location), F.col(c)))
             for c in df.columns if "image" in c}
    return rows.withColumns(paths)


def random_sample(df: DataFrame, n: int, unique_id: str, strata: Sequence[str] = (), seed: int = 123) -> DataFrame:
    """Exactly ``n`` rows (of each stratum), without replacement, repeatable by the seed; nothing is sorted as a whole."""
    ordered = df.withColumn("_random", shuffle_key(seed, F.col(unique_id)))
    return lowest_hashes(ordered, strata, "_random", [unique_id], n).select(*df.columns)


def shuffle(df: DataFrame, unique_id: str, seed: int = 123) -> DataFrame:
    """All rows in a repeatable random order."""
    return df.orderBy(shuffle_key(seed, F.col(unique_id)), unique_id)


def mix_sources(frames: Mapping[str, DataFrame], flag: str = "source") -> DataFrame:
    """Concatenation of tables with a column that names their origin."""
    return reduce(lambda a, b: a.unionByName(b), [df.withColumn(flag, F.lit(name)) for name, df in frames.items()])


def label_to_index(df: DataFrame, label: str) -> DataFrame:
    """The different labels with their position in alphabetical order, from 0."""
    placed = group_positions(df.select(label).distinct(), [], [label], out="label_index")
    return placed.withColumn("label_index", (F.col("label_index") - 1).cast("int"))


def standardize_species(df: DataFrame, mapping: DataFrame, level: str, column: str = "species") -> DataFrame:
    """Species replaced by their ``grouped`` or ``standardized`` name; unknown names stay.

    ``mapping(species, grouped, standardized)``.
    """
    names = mapping.select(F.col("species").alias("_species"), F.col(level).alias("_name"))
    joined = df.join(names, F.lower(F.col(column)) == F.col("_species"), "left")
    return joined.withColumn(column, F.coalesce("_name", F.col(column))).drop("_species", "_name")


def blank_images(captures: DataFrame, links: DataFrame, blanks: DataFrame) -> DataFrame:
    """Corrected image paths of the blank subjects, through the table that links captures to subjects."""
    linked = captures.join(links.select("capture_id", "subject_id").distinct(), "capture_id")
    kept = linked.join(blanks.select("subject_id"), "subject_id", "left_semi")
    return kept.withColumn("path", text.correct_image_name(F.col("path")))


def common_ids(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Different ids that occur in both tables."""
    return left.select(key).intersect(right.select(key))
