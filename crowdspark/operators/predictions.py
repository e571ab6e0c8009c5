"""Model input and model predictions of captures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdspark.operators.classifications import bounded_rows
from crowdspark.operators.ordering import first_n_per_group

PREDICTION_STRUCT = (
    "struct<predictions_top: map<string,string>, confidences_top: map<string,string>, "
    "aggregated_pred: map<string,map<string,string>>>"
)


def first_images(images: DataFrame, n: int, order_by: Sequence[str], path: str = "path") -> DataFrame:
    """One row per capture with the paths of its first ``n`` images, ``image1`` .. ``image<n>``."""
    first = first_n_per_group(images.select("capture_id", path, *order_by), ["capture_id"], list(order_by), n, rank="_rank")
    return first.groupBy("capture_id").agg(*[
        F.coalesce(F.max(F.when(F.col("_rank") == i, F.col(path))), F.lit("")).alias(f"image{i}")
        for i in range(1, n + 1)])


def _prefixed(values: Column, prefix: str) -> Column:
    return F.transform_keys(values, lambda key, _: F.concat(F.lit(prefix), key))


def _label_confidences(label: Column, scores: Column) -> Column:
    """Scores of one label as entries; a 0/1 label gives the score of 1 only."""
    name = F.concat(F.lit("machine_confidence_"), label)
    is_binary = (F.size(scores) == 2) & F.map_contains_key(scores, "0") & F.map_contains_key(scores, "1")
    one = F.array(F.struct(name.alias("key"), F.try_element_at(scores, F.lit("1")).alias("value")))
    every = F.transform(F.map_entries(scores), lambda e: F.struct(
        F.concat(name, F.lit("_"), e["key"]).alias("key"), e["value"].alias("value")))
    return F.when(is_binary, one).otherwise(every)


def species_prediction_map(prediction: str = "prediction", only_top: bool = False) -> Column:
    """Flat names and values of a species prediction: top labels, their scores and all scores."""
    top = F.map_concat(_prefixed(F.col(f"{prediction}.predictions_top"), "machine_topprediction_"),
                       _prefixed(F.col(f"{prediction}.confidences_top"), "machine_topconfidence_"))
    if only_top:
        return top
    labels = F.map_entries(F.col(f"{prediction}.aggregated_pred"))
    scores = F.flatten(F.transform(labels, lambda e: _label_confidences(e["key"], e["value"])))
    return F.map_concat(top, F.map_from_entries(scores))


def empty_prediction_map(prediction: str = "prediction") -> Column:
    """Flat names and values of an empty/not empty prediction, from either label name."""
    scores = F.col(f"{prediction}.aggregated_pred")
    empty, blank = F.try_element_at(scores, F.lit("empty")), F.try_element_at(scores, F.lit("is_blank"))
    top = F.try_element_at(F.col(f"{prediction}.predictions_top"), F.lit("is_blank"))
    top = F.when(top == "0", "not_empty").when(top == "1", "empty").otherwise(top)
    from_blank = F.create_map(
        F.lit("machine_topprediction_is_empty"), top,
        F.lit("machine_confidence_is_empty"), F.try_element_at(blank, F.lit("1")))
    neither = F.raise_error(F.concat(F.lit("'is_blank' or 'empty' expected, found: "),
                                     F.array_join(F.map_keys(scores), ", "))).cast("map<string,string>")
    return F.when(empty.isNotNull(), _prefixed(empty, "machine_confidence_")).when(
        blank.isNotNull(), from_blank).otherwise(neither)


def without_keys_of(values: Column, other: Column) -> Column:
    return F.map_filter(values, lambda key, _: ~F.map_contains_key(other, key))


def update_map(values: Column, new: Column) -> Column:
    """``values`` with the entries of ``new`` added or replaced; a null ``new`` changes nothing."""
    none = F.create_map().cast("map<string,string>")
    new = F.coalesce(new, none)
    return F.map_concat(without_keys_of(F.coalesce(values, none), new), new)


def combine_predictions(empty: DataFrame, species: DataFrame) -> DataFrame:
    """Flat predictions of all captures that have an empty or a species prediction."""
    left = empty.select("capture_id", empty_prediction_map().alias("_empty"))
    right = species.select("capture_id", species_prediction_map().alias("_species"))
    return left.join(right, "capture_id", "full_outer").select(
        "capture_id", update_map(F.col("_empty"), F.col("_species")).alias("predictions"))


def prediction_names(flat: DataFrame) -> list[str]:
    """The sorted names that occur in the flat predictions: one distinct job over map keys."""
    names = flat.select(F.explode(F.map_keys("predictions")).alias("name")).distinct()
    return sorted(row["name"] for row in bounded_rows(names))


def spread_predictions(flat: DataFrame, names: Sequence[str]) -> DataFrame:
    """One column per prediction name, empty text where a capture lacks it. Meant for exports."""
    return flat.select("capture_id", *[
        F.coalesce(F.try_element_at(F.col("predictions"), F.lit(n)), F.lit("")).alias(n) for n in names])


def add_predictions(manifest: DataFrame, empty: DataFrame, species: DataFrame, all_scores: bool = False) -> DataFrame:
    """Manifest whose metadata has the flat predictions with a ``#`` in front, and a ``machine_learning`` flag."""
    left = empty.select("capture_id", _prefixed(empty_prediction_map(), "#").alias("_empty"))
    right = species.select("capture_id", _prefixed(species_prediction_map(only_top=not all_scores), "#").alias("_species"))
    joined = manifest.join(left, "capture_id", "left").join(right, "capture_id", "left")
    metadata = update_map(update_map(F.col("upload_metadata"), F.col("_empty")), F.col("_species"))
    predicted = F.col("_empty").isNotNull() | F.col("_species").isNotNull()
    return joined.withColumns({
        "upload_metadata": metadata, "info": F.col("info").withField("machine_learning", predicted),
    }).drop("_empty", "_species")


def prediction_coverage(manifest: DataFrame) -> DataFrame:
    """Captures with predictions and all captures."""
    return manifest.agg(F.count_if("info.machine_learning").alias("with_predictions"), F.count(F.lit(1)).alias("total"))
