"""Reports: labels and predictions joined to captures, answer statistics and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crowdspark.defaults import (
    COUNT_QUESTIONS, EMPTY_ANSWER, HUMAN_LABELS, MAIN_COLUMN, MAIN_QUESTION,
)
from crowdspark.functions.answers import half_up_answer
from crowdspark.functions.hashing import shuffle_key
from crowdspark.operators import ordering
from crowdspark.operators.consensus import answer_shares, question_columns
from crowdspark.operators.ordering import exchange_by, lowest_hashes
from crowdspark.session import stable


def merge_tables(base: DataFrame, add: DataFrame, key: str, new_columns: str = "right") -> DataFrame:
    """Left join; columns the base already has are not added. New columns go right or left."""
    new = [c for c in add.columns if c not in base.columns]
    merged = base.join(add.select(key, *new), key, "left")
    if new_columns == "left":
        return merged.select(*new, *base.columns)
    return merged.select(*base.columns, *new)


def deduplicate_captures(aggregated: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """The first subject of a capture wins; every row of a losing subject is dropped, in all captures.

    The aggregations are needed several times, so they are checkpointed first. They are counted, so that a task's rows
    do not grow with them, and meet their capture in one exchange of few columns.
    """
    aggregated = stable(aggregated)
    n_rows = aggregated.count()
    known = aggregated.where(F.col("capture_id").isNotNull()).select(
        "capture_id", "subject_id", F.struct(*order_by).alias("_order"))
    first = F.min_by("subject_id", "_order").over(Window.partitionBy("capture_id"))
    placed = exchange_by(known, ["capture_id"], n_rows).withColumn("_first", first)
    losers = placed.where(F.col("subject_id") != F.col("_first")).select("subject_id")
    # both sides in the same number of tasks, or Spark falls back to that of the session
    return exchange_by(aggregated, ["subject_id"], n_rows).join(exchange_by(losers, ["subject_id"], n_rows), "subject_id", "left_anti")


def species_report(captures: DataFrame, aggregated: DataFrame, exclude_non_consensus: bool = False,
                   exclude_humans: bool = False, exclude_blanks: bool = False,
                   exclude_captures_without_data: bool = False, humans: Sequence[str] = HUMAN_LABELS,
                   main: str = MAIN_COLUMN) -> DataFrame:
    """Captures with each of their aggregations that pass the filters.

    Captures that were never aggregated stay with empty columns, unless ``exclude_captures_without_data``.
    Captures whose aggregations were all filtered out are dropped. Capture columns win name clashes. The captures are
    counted, so that many of them are joined in as many tasks as they need.
    """
    n_rows = captures.count()
    if n_rows > ordering.ROWS_PER_TASK:
        captures = exchange_by(captures, ["capture_id"], n_rows)
    new = [c for c in aggregated.columns if c not in captures.columns]
    keep = F.lit(True)
    if exclude_non_consensus and "species_is_plurality_consensus" in aggregated.columns:
        keep = keep & (F.col("species_is_plurality_consensus").cast("string") != "0")
    if exclude_humans:
        keep = keep & ~F.col(main).isin(list(humans))
    if exclude_blanks:
        keep = keep & (F.col(main) != EMPTY_ANSWER)
    marked = aggregated.select("capture_id", *new, keep.alias("_keep"))
    # one join serves both cases: rows without a partner were never aggregated
    joined = captures.join(marked, "capture_id", "inner" if exclude_captures_without_data else "left")
    report = joined.where(F.coalesce(F.col("_keep"), F.lit(True)))
    return report.select(*captures.columns, *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in new])


def exclude_columns(columns: Sequence[str], prefixes: Sequence[str]) -> list[str]:
    """Columns that start with none of the prefixes."""
    return [c for c in columns if not any(c.startswith(p) for p in prefixes)]


def prediction_report(captures: DataFrame, predictions: DataFrame, only_with_predictions: bool = False) -> DataFrame:
    """Captures with their flat predictions, empty text where there is none."""
    how = "inner" if only_with_predictions else "left"
    return captures.join(predictions, "capture_id", how).na.fill("")


def report_images(images: DataFrame, report: DataFrame, url_prefix: str | None = None) -> DataFrame:
    """Rank and path of the images of all captures of a report, optionally with their address."""
    path = "path" if "path" in images.columns else "image_path_rel"
    rank = "image_rank_in_capture" if "image_rank_in_capture" in images.columns else "image"
    rows = images.join(report.select("capture_id").distinct(), "capture_id", "left_semi").select(
        "capture_id", F.col(rank).alias("image_rank_in_capture"), F.col(path).alias("image_path_rel"))
    return rows if url_prefix is None else add_url(rows, url_prefix)


def add_url(images: DataFrame, prefix: str) -> DataFrame:
    return images.withColumn("url", F.concat_ws("/", F.lit(prefix), "image_path_rel"))


def report_stats(report: DataFrame) -> DataFrame:
    """Count, total and percentage of each answer of each question column."""
    return answer_shares(report, question_columns(report.columns))


def prediction_stats(report: DataFrame, empty_column: str = "machine_topprediction_is_empty",
                     empty_labels: Sequence[str] = ("empty", "blank")) -> DataFrame:
    """Answers of each top-prediction column; rows predicted empty count in the empty column only."""
    columns = [c for c in report.columns if "topprediction" in c]
    is_empty = F.col(empty_column).isin(list(empty_labels)) if empty_column in report.columns else F.lit(False)
    values = [F.when(~is_empty | F.lit(c == empty_column), F.col(c)).alias(c) for c in columns]
    long = report.select(*values).unpivot([], columns, "question", "answer").where(F.col("answer").isNotNull())
    counts = long.groupBy("question", "answer").agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy("question"))
    return counts.withColumn("total", total).withColumn("percent", F.round(100 * F.col("count") / F.col("total"), 1))


def question_answer_overview(reports: DataFrame, keys: Sequence[str] = ("location", "season"),
                             not_binary: Sequence[str] = (*COUNT_QUESTIONS, MAIN_QUESTION)) -> DataFrame:
    """Different answers of each question over many reports; binary answers are rounded half up."""
    questions = question_columns(reports.columns)
    values = [(F.col(q) if any(n in q for n in not_binary) else half_up_answer(F.col(q))).alias(q) for q in questions]
    long = reports.select(*keys, *values).unpivot(list(keys), questions, "question", "answer")
    return long.distinct()


def balanced_sample(df: DataFrame, label: str, n: int, unique_id: str, seed: int = 123) -> DataFrame:
    """``n`` rows with labels as balanced as possible; only the commonest labels are cut short.

    Every label gives up to R rows, with the smallest R that reaches ``n``; the labels are filled from
    the rarest to the commonest. Rows of a label are chosen by a repeatable random order of their id.
    The quota of each label comes from the label counts. No label is sorted as a whole (``lowest_hashes``). The input
    is read several times, so it is checkpointed first.
    """
    df = stable(df)
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_count"))
    by_size = Window.orderBy("_count", F.col(label).desc())
    counts = counts.withColumns({
        "_wanted": F.least(F.lit(n), F.sum("_count").over(Window.partitionBy())),
        "_smaller": F.coalesce(F.sum("_count").over(by_size.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_others": F.count(F.lit(1)).over(Window.partitionBy()) - F.row_number().over(by_size) + 1,
    })
    # rows per label if all smaller labels are taken whole; the first label that has as many sets R,
    # and later labels only give lower levels
    level = F.ceil((F.col("_wanted") - F.col("_smaller")) / F.col("_others"))
    counts = counts.withColumn("_level", F.max(F.when(level <= F.col("_count"), level)).over(Window.partitionBy()))
    counts = counts.withColumn("_share", F.least("_count", F.coalesce("_level", "_count")))
    taken = F.coalesce(F.sum("_share").over(by_size.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumn("_quota", F.greatest(F.lit(0), F.least("_share", F.col("_wanted") - taken)))
    ordered = df.withColumn("_random", shuffle_key(seed, F.col(unique_id)))
    quotas = counts.select(F.col(label).alias("_label"), F.col("_quota").alias("_taken"))
    joined = ordered.join(quotas, ordered[label].eqNullSafe(quotas["_label"]))
    return lowest_hashes(joined, [label], "_random", [unique_id], F.col("_taken")).select(*df.columns)
