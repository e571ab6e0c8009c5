"""Ordered operators that stay exact when one group holds most of the rows.

A plain window puts each group into one task. That is right for groups of ordinary size and wrong for
a roll or label with billions of rows. ``split_hot_groups`` finds the large groups with one
pre-aggregated count; their rows are range-partitioned by the full order, so every slice has about the
same size however skewed the keys are, and a small per-slice summary carries the running values over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdspark.defaults import HOT_GROUP_ROWS
from crowdspark.session import stable

SLICE = "_slice"
#: Hash buckets of keys that are counted first; a task sends at most so many counts.
HOT_BUCKETS = 1 << 16
#: Rows that a task gets of an exchange after which it sorts them several times.
ROWS_PER_TASK = 250_000


def split_hot_groups(df: DataFrame, keys: Sequence[str], hot_group_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary groups, and rows of groups above ``hot_group_rows`` (None if there are none).

    Hash buckets of the keys are counted first: those counts collapse in the map tasks, whatever the number of
    groups. Groups themselves are counted only in buckets that are large enough to hold a hot one.
    """
    return count_and_split(df, keys, hot_group_rows)[1:]


def count_and_split(df: DataFrame, keys: Sequence[str], hot_group_rows: int) -> tuple[int, DataFrame, DataFrame | None]:
    """The number of rows, and the two tables of ``split_hot_groups``; one count serves both."""
    if not keys:
        n_rows = df.agg(F.count(F.lit(1))).scalar()
        return (n_rows, df, None) if n_rows <= hot_group_rows else (n_rows, df.limit(0), df)
    bucket = F.pmod(F.xxhash64(*[df[k] for k in keys]), F.lit(HOT_BUCKETS))
    counts = df.groupBy(bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    n_rows, full = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)),
                              F.collect_list(F.when(F.col("_n") > hot_group_rows, F.col("_b")))).first()
    if not full:
        return n_rows, df, None
    some = df.select(*keys).where(bucket.isin(full)) if len(full) < HOT_BUCKETS // 64 else df.select(*keys)
    large = some.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_group_rows)
    large = large.select(*[F.col(k).alias(f"_hot_{k}") for k in keys])
    if large.isEmpty():
        return n_rows, df, None
    large = stable(large)
    same = [df[k].eqNullSafe(large[f"_hot_{k}"]) for k in keys]
    return n_rows, df.join(large, same, "left_anti"), df.join(large, same, "left_semi")


def exchange_by(df: DataFrame, keys: Sequence[str], n_rows: int | None) -> DataFrame:
    """Rows partitioned by ``keys`` into as many tasks as ``n_rows`` need, so that a task's memory does not grow with them.

    Left to Spark, partitions are joined up to a size in bytes on the wire, of which the sorts of a task hold many times as
    much. Few rows, or an unknown number, are left to Spark.
    """
    n = -(-(n_rows or 0) // ROWS_PER_TASK)
    if n <= 1:
        return df.repartition(*keys)
    return df.repartition(max(n, df.sparkSession.sparkContext.defaultParallelism), *keys)


def ordered_slices(df: DataFrame, order: Sequence[str], n_slices: int | None = None) -> DataFrame:
    """Range-partition by ``order`` and add the slice number; slice numbers follow the order.

    The result is checkpointed: range bounds come from a sample, so every consumer must read the same cut.
    """
    n = n_slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stable(df.repartitionByRange(n, *order).withColumn(SLICE, F.spark_partition_id()))


def before_slice(summary: DataFrame, keys: Sequence[str], value: str) -> Column:
    """Sum of ``value`` over the earlier slices of the same group, 0 for the first."""
    w = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(w), F.lit(0))


def join_summary(df: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join the per-slice values back to the rows; keys may be null."""
    right = summary.select(
        *[F.col(k).alias(f"_s_{k}") for k in [*keys, SLICE]],
        *[c for c in summary.columns if c not in [*keys, SLICE]],
    )
    same = [df[k].eqNullSafe(right[f"_s_{k}"]) for k in [*keys, SLICE]]
    return df.join(right, same, "left").drop(*[f"_s_{k}" for k in [*keys, SLICE]], SLICE)


def group_positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "position",
    hot_group_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """1-based position of each row in its group, ordered by ``order``.

    Without ``keys`` all rows are one group, of whatever size, and are always numbered in slices.
    """
    keys = list(keys)
    cold, hot = split_hot_groups(df, keys, hot_group_rows) if keys else (None, df)
    plain = cold and cold.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))
    if hot is None:
        return plain
    sliced = ordered_slices(hot, [*keys, *order])
    local = sliced.withColumn("_rn", F.row_number().over(Window.partitionBy(SLICE, *keys).orderBy(*order)))
    summary = sliced.groupBy(*keys, SLICE).agg(F.count(F.lit(1)).alias("_n"))
    summary = summary.withColumn("_before", before_slice(summary, keys, "_n")).drop("_n")
    ranked = join_summary(local, summary, keys).withColumn(out, F.col("_before") + F.col("_rn"))
    ranked = ranked.select(*df.columns, out)
    return plain.unionByName(ranked) if plain else ranked


def first_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int = 1,
                      rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of each group.

    A ``row_number() <= n`` filter is planned as a group limit before and after the shuffle, so a map
    task sends at most ``n`` rows per group, whatever the group's size.
    """
    name = rank or "_rn"
    kept = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = kept.where(F.col(name) <= n)
    return kept if rank else kept.drop(name)


#: Leading hexadecimal digits of a hash that its histogram counts.
HASH_DIGITS = 4


def lowest_hashes(df: DataFrame, keys: Sequence[str], hashed: str, tie: Sequence[str], quota: Column | int) -> DataFrame:
    """The rows of each group with the lowest values of a hexadecimal hash: as many as ``quota`` says.

    No group is sorted. The leading digits are counted, with partial sums; from these counts comes the bucket in which
    a group reaches its quota. Rows of lower buckets are taken whole, and only those of that one bucket are ranked, by hash
    and ``tie``. ``quota`` is a number, or a column of ``df`` that is the same in a group. Reads ``df`` three times.
    """
    keys, quota = list(keys), F.lit(quota) if isinstance(quota, int) else quota
    rows = df.withColumns({"_bucket": F.conv(F.substring(hashed, 1, HASH_DIGITS), 16, 10).cast("int"), "_quota": quota.cast("bigint")})
    counts = rows.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"), F.max("_quota").alias("_wanted"))
    counts = counts.withColumn("_upto", F.sum("_n").over(Window.partitionBy(*keys).orderBy("_bucket")))
    counts = counts.withColumn("_before", F.col("_upto") - F.col("_n"))
    cuts = counts.where("_before < _wanted and _upto >= _wanted or _wanted <= 0 and _before = 0")
    cuts = cuts.select(*[F.col(k).alias(f"_c_{k}") for k in keys], F.col("_bucket").alias("_cut"), "_before")
    same = [rows[k].eqNullSafe(cuts[f"_c_{k}"]) for k in keys]
    placed = rows.join(cuts, same, "left") if keys else rows.join(cuts.withColumn("_one", F.lit(1)), F.lit(1) == F.col("_one"), "left")
    whole = placed.where(F.col("_cut").isNull() | (F.col("_bucket") < F.col("_cut")))
    edge = placed.where(F.col("_bucket") == F.col("_cut")).withColumn(
        "_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(hashed, *tie))).where(
        F.col("_rn") <= F.col("_quota") - F.col("_before"))
    return whole.select(*df.columns).unionByName(edge.select(*df.columns))
