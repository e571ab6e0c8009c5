"""Captures of images as they arrive, and first rows of a key: keyed state that ends with the watermark.

Both wait until the watermark has passed a row before they decide about it, so rows may arrive in any order within the
delay. A micro-batch reads its own rows and the state of their keys, and nothing that was written before.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from crowdspark.defaults import CAPTURE_GAP_SECONDS, GROUP_KEYS, MAX_DAYS_WITHOUT_IMAGE
from crowdspark.functions.times import epoch_seconds
from crowdspark.operators.captures import CAPTURE_COLUMNS, SECONDS_PER_DAY

#: Buckets of rolls that a capture stream keeps state for.
CAPTURE_BUCKETS = 256
CAPTURE_STATE = "rolls binary, pending binary"
CAPTURE_ROWS = "row string, rank long, last double, following double, capture long, in_capture long"


def event_time(seconds: Column) -> Column:
    """The time of the watermark: the wall-clock time as if it were UTC."""
    return F.timestamp_micros((seconds * 1000000).cast("bigint"))


def end_mark(spark: SparkSession, schema: str, datetime: str, at: str) -> DataFrame:
    """A row that holds nothing but a time; it moves the watermark of its stream and makes no row of output."""
    return spark.range(1).select(F.lit(at).alias(datetime)).withColumn("_no", F.lit(None)).selectExpr(*[
        f"cast({datetime if c.name == datetime else '_no'} as {c.dataType.simpleString()}) as {c.name}"
        for c in spark.createDataFrame([], schema).schema])


ROLLS = pa.schema([("_roll", pa.string()), ("_s", pa.float64()), ("_row", pa.string()), ("rank", pa.int64()),
                   ("capture", pa.int64()), ("in_capture", pa.int64()), ("last", pa.float64())])
PENDING = pa.schema([("_roll", pa.string()), ("_s", pa.float64()), ("_id", pa.string()), ("_row", pa.string())])


def _packed(frame: pd.DataFrame, schema: pa.Schema) -> bytes:
    with pa.BufferOutputStream() as sink:
        with pa.ipc.new_stream(sink, schema) as writer:
            writer.write_table(pa.Table.from_pandas(frame[schema.names], schema, preserve_index=False))
        return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(data)).read_all().to_pandas()


class CaptureStep:
    """What one micro-batch does to a bucket of rolls: final images are numbered, a roll's last one waits for its successor.

    State: one row for each roll, its last numbered image (without the row once it was given out), and the images
    above the watermark. All rolls of the bucket are worked out together.
    """

    def __init__(self, max_gap: float, close_after: float):
        self.max_gap, self.close_after = max_gap, close_after

    def __call__(self, key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs()
        held = [_unpacked(part) for part in state.get] if state.exists else [s.empty_table().to_pandas() for s in (ROLLS, PENDING)]
        rolls, pending = held[0], [held[1]]
        for frame in frames:
            pending.append(frame.loc[frame["_id"].notna() & frame["_s"].notna(), PENDING.names])
        pending = pd.concat([p for p in pending if len(p)] or pending[:1], ignore_index=True)
        ready = np.rint(pending["_s"].to_numpy() * 1000000) <= now * 1000
        rolls, done = self.number(rolls, pending[ready].sort_values(["_roll", "_s", "_id", "_row"]))
        pending = pending[~ready]
        waits = rolls["_row"].notna() & ~rolls["_roll"].isin(pending["_roll"])
        closes = (rolls["_s"] + self.close_after) * 1000
        closed = waits & (closes <= now)
        done = pd.concat([f for f in (done, rolls[closed].assign(following=0.0)) if len(f)] or [done])
        rolls.loc[closed, "_row"] = None
        if len(rolls) or len(pending):
            state.update((_packed(rolls, ROLLS), _packed(pending, PENDING)))
            due = [*(pending["_s"] * 1000), *closes[waits & ~closed]]
            if due:
                state.setTimeoutTimestamp(max(int(min(due)), now + 1))
        if len(done):
            yield done.rename(columns={"_row": "row"})[["row", "rank", "last", "following", "capture", "in_capture"]]

    def number(self, rolls: pd.DataFrame, ready: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
        """The rolls after the sorted images ``ready``, and the images whose successor is known now."""
        if not len(ready):
            return rolls, rolls[:0].assign(following=0.0)
        # a roll's last image of before, then its new ones: the sort is stable
        rows = pd.concat([f for f in (rolls, ready[["_roll", "_s", "_row"]]) if len(f)], ignore_index=True)
        if not len(rolls):
            rows = rows.reindex(columns=ROLLS.names)
        known = np.arange(len(rows)) < len(rolls)
        order = np.argsort(pd.factorize(rows["_roll"])[0], kind="stable")
        rows, known = rows.iloc[order].reset_index(drop=True), known[order]
        places, seconds = np.arange(len(rows)), rows["_s"].to_numpy()
        first = np.append(True, rows["_roll"].to_numpy()[1:] != rows["_roll"].to_numpy()[:-1])
        gap = np.append(0.0, seconds[1:] - seconds[:-1])
        head = np.maximum.accumulate(np.where(first, places, 0))
        starts = ~known & (first | (gap > self.max_gap))
        before = {c: np.where(known, rows[c], 0).astype("int64")[head] for c in ("rank", "capture", "in_capture")}
        anchor = np.maximum.accumulate(np.where(first | starts, places, 0))
        counted, one = np.cumsum(starts), np.where(known, 0, 1)[head]
        rows = rows.assign(
            rank=before["rank"] + places - head + one, capture=before["capture"] + counted - counted[head] + one,
            in_capture=places - anchor + np.where(known[anchor], before["in_capture"], 1),
            last=np.where(known, rows["last"], np.where(first, 0.0, gap)))
        last = np.append(first[1:], True)
        done = rows.assign(following=np.append(gap[1:], 0.0))
        return rows[last].reset_index(drop=True), done[~last & rows["_row"].notna()]


def capture_stream(images: DataFrame, *, delay: str, keys: Sequence[str] = GROUP_KEYS, datetime: str = "datetime",
                   unique_id: str = "image_path_original", max_gap: float = CAPTURE_GAP_SECONDS,
                   close_after: float = MAX_DAYS_WITHOUT_IMAGE * SECONDS_PER_DAY, buckets: int = CAPTURE_BUCKETS) -> DataFrame:
    """``group_into_captures`` of a stream of images; same columns and, within the delay, the same rows.

    An image is numbered when the watermark (the latest time less ``delay``) has passed it, and given out when
    its successor in the roll is known too, or ``close_after`` seconds without any later image; a successor that comes
    after that still counts on, but the image before it has said that nothing follows. A gap of exactly ``max_gap`` stays
    in the capture. Images that arrive after the watermark are dropped, and so are those without a time. Rows
    without an id only move the watermark (``end_mark``).

    State: a roll's counters, and its images above the watermark. Rolls are kept in ``buckets`` by a hash of their keys, and
    a micro-batch reads the buckets of its rows, so that its calls of Python do not grow with the number of rolls.
    """
    keys = list(keys)
    base = [c for c in images.columns if c not in CAPTURE_COLUMNS]
    row = F.struct(*base)
    seconds = epoch_seconds(F.col(datetime))
    roll = F.to_json(F.array(*[F.col(k).cast("string") for k in keys]))
    events = images.select(F.pmod(F.xxhash64(roll), F.lit(buckets)).alias("_bucket"), roll.alias("_roll"), seconds.alias("_s"),
                           event_time(seconds).alias("_event"), F.col(unique_id).cast("string").alias("_id"),
                           F.to_json(row, {"ignoreNullFields": "false"}).alias("_row"))
    done = events.withWatermark("_event", delay).groupBy("_bucket").applyInPandasWithState(
        CaptureStep(float(max_gap), float(close_after)), CAPTURE_ROWS, CAPTURE_STATE, "append", GroupStateTimeout.EventTimeTimeout)
    schema = images.select(*base).schema
    capture = F.col("capture").cast("int")
    return done.withColumn("row", F.from_json("row", schema)).select(
        *[F.col(f"row.`{c}`").alias(c) for c in base], F.col("rank").cast("int").alias("image_rank_in_roll"),
        F.col("last").alias("seconds_to_last_image_taken"), F.col("following").alias("seconds_to_next_image_taken"),
        F.round(F.col("last") / SECONDS_PER_DAY, 2).alias("days_to_last_image_taken"),
        F.round(F.col("following") / SECONDS_PER_DAY, 2).alias("days_to_next_image_taken"),
        capture.alias("capture"), F.col("in_capture").cast("int").alias("image_rank_in_capture"),
        F.concat_ws("#", *[F.col(f"row.`{k}`") for k in keys], capture.cast("string")).alias("capture_id"))


def _first_of_batch(keys: Sequence[str]):
    """The earliest row of each key of a partition; rows whose key is all null are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            rows = pa.Table.from_batches(held).sort_by([("_us", "ascending")]).group_by(list(keys), use_threads=False).aggregate(
                [("_row", "first")]).rename_columns({"_row_first": "_row"})
            named = [pc.is_valid(rows.column(k)) for k in keys]
            yield from rows.filter(reduce(pc.or_, named)).select([*keys, "_row"]).to_batches()
    return run


def first_rows_stream(rows: DataFrame, key: Sequence[str], at: Column, order_by: Sequence[str], *, delay: str) -> DataFrame:
    """The first row of each key of a stream: by the time ``at``, then by ``order_by`` (texts or numbers).

    Rows may arrive in any order within ``delay``; a key's row is given out when the watermark has passed it, and all
    later rows of the key are dropped, in this and in every later run from the same checkpoint. Rows that arrive after the
    watermark are dropped, and so are those without a time; a row whose key is all null only moves the watermark.

    The least row of each key and time is an aggregate that ends with the watermark; of those that end in one micro-batch
    the earliest is taken where they meet, and keys given out before are dropped. State: one row for each key and time that
    waits, a mark of each key given out.
    """
    micros = F.unix_micros(at.cast("timestamp"))
    kinds, keys = dict(rows.dtypes), [f"_k{i}" for i in range(len(key))]
    # nulls come first, as they do in a sort, and what is no number counts as null
    order = [F.nanvl(c, F.lit(None)) if kinds[c] in {"float", "double"} else F.col(c) for c in order_by]
    place = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], F.to_json(
        F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("_row"))
    events = rows.select(*[F.col(c).cast("string").alias(k) for c, k in zip(key, keys)],
                         F.timestamp_micros(micros).alias("_event"), place.alias("_place"))
    least = events.where("_event is not null").withWatermark("_event", delay).groupBy(*keys, "_event").agg(
        F.min("_place").alias("_place"))
    # a key that is all null is dropped after the exchange: before it, it would not reach the watermark
    firsts = least.select(*keys, F.unix_micros("_event").alias("_us"), "_place._row").repartition(*keys).mapInArrow(
        _first_of_batch(keys), ", ".join(f"{c} string" for c in [*keys, "_row"])).dropDuplicates(keys)
    return firsts.select(F.from_json("_row", rows.schema).alias("row")).select("row.*")
