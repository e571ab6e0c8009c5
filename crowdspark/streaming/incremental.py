"""Growing exports: annotations of new classification files, and ids that are processed once.

The batch operators that work row by row apply to a stream unchanged. What a batch run keeps in a
tracker file, a stream keeps in its state, by key: a micro-batch looks up its own keys and reads nothing else.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crowdspark.operators.classifications import (
    CLASSIFICATION_KEY, explode_classifications, flatten_annotations, with_reject_reason, without_rejected,
)
from crowdspark.streaming.arrivals import first_rows_stream


def classification_stream(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Classification exports as they arrive in a folder."""
    return spark.readStream.schema(schema).options(header=True, escape='"', multiLine=True).csv(folder).na.fill("")


def annotation_stream(classifications: DataFrame, single: Sequence[str], multi: Mapping[str, Sequence[str]], **filters) -> DataFrame:
    """Flat annotations of the eligible classifications; the questions must be given.

    Repeated classifications of a user stay; ``first_annotation_stream`` removes them.
    """
    passed = with_reject_reason(classifications, **filters).where(F.col("reject_reason").isNull())
    return flatten_annotations(explode_classifications(passed), single, multi)


def first_classification_stream(classifications: DataFrame, order_by: Sequence[str], *, delay: str,
                                created_at: str = "created_at", keep: Sequence[str] | None = None, **filters) -> DataFrame:
    """Eligible classifications, the first of each user, subject and workflow, as they arrive.

    ``order_by`` decides within a day, the date of ``created_at`` between days; see ``first_rows_stream``. A row waits in the
    state with the columns to ``keep`` (all, if not given; its key, time and order in any case).
    """
    # a row without any key is no classification: it moves the watermark
    mark = F.coalesce(*[F.col(c) for c in CLASSIFICATION_KEY]).isNull()
    passed = without_rejected(classifications, mark, **filters)
    if keep is not None:
        needed = {*keep, *CLASSIFICATION_KEY, *order_by, created_at}
        passed = passed.select(*[c for c in passed.columns if c in needed])
    day = F.try_to_timestamp(F.substring(created_at, 1, 10), F.lit("yyyy-MM-dd"))
    return first_rows_stream(passed, CLASSIFICATION_KEY, day, order_by, delay=delay)


def first_annotation_stream(classifications: DataFrame, single: Sequence[str], multi: Mapping[str, Sequence[str]],
                            order_by: Sequence[str], *, delay: str, **filters) -> DataFrame:
    """Flat annotations of the first eligible classification of each user, subject and workflow."""
    firsts = first_classification_stream(classifications, order_by, delay=delay, **filters)
    return flatten_annotations(explode_classifications(firsts), single, multi)


def process_once(items: DataFrame, key: str, folder: str, checkpoint: str, event_time: str | None = None,
                 within: str | None = None, **trigger) -> StreamingQuery:
    """Write the items of a stream whose key was not written before.

    Keys are kept in the state store, so a batch costs what its own items cost, however many came before it; keep
    the store on disk (``spark.sql.streaming.stateStore.providerClass``) if there are many keys. With ``event_time`` and
    ``within``, keys are only kept until the watermark has passed them. The folder's log names the files of finished
    batches, so a batch that is run again is not read twice.
    """
    if within is None:
        fresh = items.dropDuplicates([key])
    else:
        fresh = items.withWatermark(event_time, within).dropDuplicatesWithinWatermark([key])
    return fresh.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).trigger(
        **(trigger or {"availableNow": True})).start()
