"""Upload manifests: records, batches and the state of the upload."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdspark.defaults import FLAGS_REMOVED_FROM_UPLOAD
from crowdspark.functions.hashing import anonymous_id, shuffle_key
from crowdspark.functions.text import capture_id as build_capture_id
from crowdspark.operators.captures import remove_flagged
from crowdspark.operators.ordering import group_positions
from crowdspark.operators.predictions import update_map
from crowdspark.session import stable

EMPTY_MAP = "map<string,string>"


def images_on_disk(images: DataFrame, files: DataFrame, path: str = "path") -> DataFrame:
    """Images whose file exists."""
    return images.join(files.select(F.col("path").alias(path)), path, "left_semi")


def images_missing(images: DataFrame, files: DataFrame, path: str = "path") -> DataFrame:
    """Images whose file does not exist."""
    return images.join(files.select(F.col("path").alias(path)), path, "left_anti")


def manifest_records(images: DataFrame, attribution: str, licence: str, order_by: Sequence[str],
                     path: str = "path") -> DataFrame:
    """One record per capture: metadata, state and its image paths in order.

    Images that must not be uploaded are left out. A record holds all images of its capture, as the
    manifest does; the captures themselves stay spread over the cluster.
    """
    kept = remove_flagged(images, FLAGS_REMOVED_FROM_UPLOAD)
    fields = ["site", "roll", "season", "capture"]
    grouped = kept.groupBy("capture_id").agg(
        *[F.min(F.col(f).cast("string")).alias(f) for f in fields],
        F.array_sort(F.collect_list(F.struct(*order_by, F.col(path).alias("_path")))).alias("_images"))
    metadata = F.create_map(
        F.lit("#capture_id"), F.col("capture_id"),
        *[x for f in fields for x in (F.lit(f"#{f}"), F.col(f))],
        F.lit("attribution"), F.lit(attribution), F.lit("license"), F.lit(licence))
    return grouped.select("capture_id", metadata.alias("upload_metadata"), F.struct(F.lit(False).alias("uploaded")).alias("info"),
                          F.col("_images._path").alias("images"))


def batch_assign(df: DataFrame, order_by: Sequence[str], n_batches: int | None = None, max_size: int | None = None,
                 seed: int | None = None, unique_id: str = "capture_id", **options) -> DataFrame:
    """Add ``batch``, 1 to n: near-equal runs of the rows in order, or in a repeatable random order.

    Batch b ends at row ``round(b * N / n)``, halves rounded to even. The input is counted and numbered,
    so it is checkpointed first.
    """
    df = stable(df)
    total = df.agg(F.count(F.lit(1))).scalar()
    rows = df
    if seed is not None:
        rows, order_by = df.withColumn("_random", shuffle_key(seed, F.col(unique_id))), ["_random", unique_id]
    placed = group_positions(rows, [], list(order_by), out="_position", **options).withColumn("_total", total)
    n = F.lit(n_batches) if n_batches is not None else F.ceil(F.col("_total") / max_size)
    placed = placed.withColumn("_n", n.cast("bigint"))
    # the smallest b with b * N / n >= position - 1/2, or the next one where a half is rounded down
    near = F.greatest(F.lit(1), F.expr("((2 * _position - 1) * _n + 2 * _total - 1) div (2 * _total)"))
    ends = F.filter(F.sequence(near, near + 1), lambda b: F.rint(b * F.col("_total") / F.col("_n")) >= F.col("_position"))
    return placed.withColumn("batch", F.array_min(ends).cast("int")).select(*df.columns, "batch")


def pending(items: DataFrame, tracker: DataFrame, key: str) -> DataFrame:
    """Items the tracker does not list yet."""
    return items.join(tracker.select(key), key, "left_anti")


def keys_with_prefix(metadata: Column, prefix: str) -> Column:
    return F.map_filter(metadata, lambda k, _: k.startswith(prefix))


def needs_update(new: Column, existing: Column) -> Column:
    """Whether any entry of ``new`` is missing from ``existing`` or differs."""
    return ~F.forall(F.map_entries(new), lambda e: F.map_contains_key(existing, e["key"])
                     & F.try_element_at(existing, e["key"]).eqNullSafe(e["value"]))


def upload_metadata(manifest: DataFrame) -> DataFrame:
    """Metadata as uploaded: with the original images and the anonymous capture id."""
    new = F.create_map(F.lit("#original_images"), F.to_json("images"),
                       F.lit("capture_id_anonymized"), anonymous_id(F.col("capture_id")))
    return manifest.withColumn("upload_metadata", update_map(F.col("upload_metadata"), new))


def record_upload(manifest: DataFrame, tracker: DataFrame, set_id: str, set_name: str, upload_time: str,
                  order_by: Sequence[str] = ("subject_id",)) -> DataFrame:
    """Manifest with the upload state of all captures the tracker lists.

    A capture that the append-only tracker lists several times has its last row by ``order_by``.
    """
    done = tracker.groupBy("capture_id").agg(F.max_by("subject_id", F.struct(*order_by)).alias("_subject"))
    joined = manifest.join(done, "capture_id", "left")
    uploaded = F.col("_subject").isNotNull()
    state = {
        "subject_set_id": F.lit(set_id), "subject_set_name": F.lit(set_name), "upload_time": F.lit(upload_time),
        "subject_id": F.col("_subject"), "anonymized_capture_id": anonymous_id(F.col("capture_id")),
    }
    info = F.col("info").withField("uploaded", F.coalesce(F.col("info.uploaded"), F.lit(False)) | uploaded)
    for field, value in state.items():
        info = info.withField(field, F.when(uploaded, value.cast("string")))
    return joined.withColumn("info", info).drop("_subject")


def patch_metadata(metadata: Column, season: str = "") -> Column:
    """Add missing season, capture id and anonymous capture id, and drop ``capture_id``."""
    none = F.create_map().cast(EMPTY_MAP)

    def missing(key: str, value: Column, of: Column) -> Column:
        return F.when(F.map_contains_key(of, key) | value.isNull(), none).otherwise(F.create_map(F.lit(key), value))

    kept = F.map_filter(metadata, lambda k, _: k != "capture_id")
    with_season = F.map_concat(kept, missing("#season", F.lit(season or None).cast("string"), kept))
    parts = [F.try_element_at(with_season, F.lit(k)) for k in ("#season", "#site", "#roll", "#capture")]
    identifier = F.concat(*[x for p in parts for x in (F.lit("#"), p)][1:])
    with_id = F.map_concat(with_season, missing("#capture_id", identifier, with_season))
    anonymous = anonymous_id(F.try_element_at(with_id, F.lit("#capture_id")))
    return F.map_concat(with_id, missing("capture_id_anonymized", anonymous, with_id))


def with_capture_id(df: DataFrame) -> DataFrame:
    return df if "capture_id" in df.columns else df.withColumn("capture_id", build_capture_id())
