"""Queries of the streams: the given tables arrive in files, and the results equal those of the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdspark.plans.capture_queries import CAPTURES_SQL, GAP, IMAGE_COLUMNS
from crowdspark.plans.classification_queries import FILTERS, ORDER
from crowdspark.plans.registry import query
from crowdspark.plans.tables import Tables
from crowdspark.session import shared_folder
from crowdspark.streaming import arrivals, incremental

#: Files in which a table arrives; days by which rows are late at most, and that the watermark waits.
FILES, LATE_DAYS, DELAY = 3, 2, "3 days"
#: Longer than the table, so that no roll is closed before its last image; the mark comes after that.
CLOSE_AFTER, END = 20 * 366 * 86400, "2100-01-01 00:00:00"


def arriving(rows: DataFrame, at: str, key: str, end: DataFrame) -> list[DataFrame]:
    """``rows`` in the parts in which they arrive: by time, but each row up to LATE_DAYS too late; the end mark comes last.

    A row's part comes from ``at`` and ``key`` alone, named once, so that a part is filtered before its other columns are made.
    """
    day = F.unix_date(F.to_date(F.substring(F.col(at).cast("string"), 1, 10)))
    first, last = rows.select(day.alias("d")).agg(F.min("d"), F.max("d")).first()
    if first is None:
        parts = [rows]
    else:
        passed = day + F.pmod(F.xxhash64(key), F.lit(LATE_DAYS + 1)) - first
        number = F.least(F.coalesce(F.floor(passed * FILES / max(last - first, 1)), F.lit(0)), F.lit(FILES - 1))
        parts = [rows.where(number == i) for i in range(FILES)]
    parts[-1] = parts[-1].unionByName(end.select(*[F.col(c.name).cast(c.dataType) for c in rows.schema]))
    return parts


def written(parts: list[DataFrame], stream: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """All rows of a stream, from the files that it writes: a run from one checkpoint for each part.

    A part's rows lie in its files in any order, so all its files belong to one micro-batch: the watermark must not move
    between them, however many there are.
    """
    spark = parts[0].sparkSession
    folder, out, state = (shared_folder(spark, f"{name}-{n}") for n in ("in", "out", "state"))
    for part in parts:
        part.write.mode("append").parquet(folder)
        rows = stream(spark.readStream.schema(parts[0].schema).parquet(folder))
        rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(
            availableNow=True).start().awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


@query("v_captures", CAPTURES_SQL.replace("image_rank_in_roll\n", """image_rank_in_roll,
  seconds_to_last_image_taken, seconds_to_next_image_taken, days_to_last_image_taken, days_to_next_image_taken
"""))
def captures_of_a_stream(t: Tables) -> DataFrame:
    """W1-W4 of images as they arrive, out of order within the delay."""
    images = t.inventory.select("season", "site", "roll", "datetime", "image_path_original")
    end = arrivals.end_mark(t.spark, "season string, site string, roll string, datetime timestamp_ntz, image_path_original string",
                            "datetime", END)
    rows = written(arriving(images, "datetime", "image_path_original", end), lambda arrived: arrivals.capture_stream(
        arrived, delay=DELAY, max_gap=GAP, close_after=CLOSE_AFTER), "captures")
    return rows.select(*IMAGE_COLUMNS, "capture_id", "capture", "image_rank_in_capture", "image_rank_in_roll",
                       "seconds_to_last_image_taken", "seconds_to_next_image_taken", "days_to_last_image_taken",
                       "days_to_next_image_taken")


@query("v_eligible", "SELECT classification_id, user_name, subject_ids, workflow_id, workflow_version, created_at, price FROM v_eligible")
def first_classifications_of_a_stream(t: Tables) -> DataFrame:
    """F7, W7 of classifications as they arrive: the first of each user, subject and workflow."""
    rows = t.classifications
    texts = ("metadata", "annotations", "subject_data")
    end = arrivals.end_mark(t.spark, ", ".join(f"{n} {k}" for n, k in rows.dtypes), "created_at", "2100-01-01 00:00:00 UTC")
    return written(arriving(rows, "created_at", "price", end), lambda arrived: incremental.first_classification_stream(
        arrived, ORDER, delay=DELAY, keep=[c for c in rows.columns if c not in texts], **FILTERS), "firsts").select(
        "classification_id", "user_name", "subject_ids", "workflow_id", "workflow_version", "created_at", "price")


@query("v_inventory", "SELECT DISTINCT site FROM v_inventory")
def items_once(t: Tables) -> DataFrame:
    """Items of a stream, each key written once over two runs from one checkpoint."""
    folder, out, state = (shared_folder(t.spark, f"once-{n}") for n in ("in", "out", "state"))
    sites = t.inventory.select("site", "event_id")
    for part in (0, 1):
        sites.where(F.col("event_id") % 2 == part).write.mode("append").parquet(folder)
        stream = t.spark.readStream.schema("site string, event_id bigint").parquet(folder)
        incremental.process_once(stream, "site", out, state).awaitTermination()
    return t.spark.read.schema("site string, event_id bigint").parquet(out).select("site")
