"""Size checks and skew handling shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rdfweave.operators.stage import stage

# A side is only broadcast when the planner's size estimate is below this.  The
# estimate rests on compressed files, so the bound leaves room for a tenfold growth.
BROADCAST_BYTES = 16 * 1024 * 1024
# Up to this many node values are pushed into the scan as an IN filter.
PUSHED_VALUES = 1000
# Below this a whole join side fits one task, so a hot key cannot hurt.
SKEW_BYTES = 256 * 1024 * 1024
# A hot key is cut into slices of about this many rows.
SLICE_ROWS = 2_000_000
# Hashes by which rows are counted before keys are.
HASHES = 1 << 16

# What one task sorts, and what it merges by the estimate of files, which are compressed.
TASK_ROWS = 500_000
TASK_BYTES = 4 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate (file sizes for scans); runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _scanned_bytes(df: DataFrame) -> int:
    """The size of all scans below ``df``; joins, whose estimates are products, do not count."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(n).stats().sizeInBytes())) for n in range(leaves.size())]
    # What Spark knows no size of has one beyond all files.
    return sum(x for x in sizes if x < 1 << 60)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only for a side that is known to be small.

    Above the limit the frame is returned as it is and Spark shuffles it, or
    broadcasts it at run time if it turns out small after all.
    """
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def short_list(values: DataFrame) -> list[str] | None:
    """The distinct values of a one-column frame of small estimated size, if they are few."""
    if estimated_bytes(values) > BROADCAST_BYTES:
        return None
    first = values.distinct().limit(PUSHED_VALUES + 1).collect()
    return [row[0] for row in first] if len(first) <= PUSHED_VALUES else None


def keep_nodes(data: DataFrame, nodes: DataFrame, value: str = "node") -> DataFrame | None:
    """Rows of ``data`` whose subject is among the staged ``nodes``, if they are few.

    Up to ``PUSHED_VALUES`` nodes become an IN filter that reaches the Parquet scan; for
    a longer list the answer is ``None`` and the caller joins.  Rows of other kinds of
    node with an equal label may be kept too; an exact join follows.
    """
    values = short_list(nodes.select(value))
    return None if values is None else data.filter(F.col("s").isin(values))


def is_large(df: DataFrame, limit: int | None = None) -> bool:
    return estimated_bytes(df) > (SKEW_BYTES if limit is None else limit)


def dealt(rows: DataFrame, *key: str) -> DataFrame:
    """``rows`` dealt by ``key`` to tasks that stay as small however many rows there are.

    Merging copies then takes no memory of the tasks that scan, whose size follows the files.
    """
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(least, -(-_scanned_bytes(rows) // TASK_BYTES)), *key)


def in_order(rows: DataFrame, *key: str, then: Sequence[str] = (), task_bytes: int | None = None) -> DataFrame:
    """Staged ``rows`` in ranges of ``key`` sorted by it (and ``then``), in tasks of about ``TASK_ROWS``.

    With ``task_bytes`` long rows make as many tasks as their files have of it.
    """
    least = rows.sparkSession.sparkContext.defaultParallelism
    parts = max(least, -(-rows.count() // TASK_ROWS))
    if task_bytes:
        parts = max(parts, -(-_scanned_bytes(rows) // task_bytes))
    return rows.repartitionByRange(parts, *key).sortWithinPartitions(*key, *then)


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    large: bool | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Join on ``on`` where a few keys of ``left`` may hold a large part of its rows.

    Needed where ``right`` was just aggregated on the join key: Spark then reuses
    that partitioning and cannot split a skewed partition of ``left`` by itself.
    Hot keys of ``left`` are cut into slices and the matching rows of ``right``
    are repeated once per slice; all other keys keep one slice.  The list of hot
    keys is counted exactly and staged, so both sides always agree on the slices;
    it is broadcast if its size allows it, else joined as Spark sees fit.  Keys are
    counted where many rows share a hash; without such rows this is a plain join.

    ``how`` may be inner, left, left_semi or left_anti.
    """
    if not (is_large(left) if large is None else large):
        return left.join(right, on, how)
    bucket = F.pmod(F.xxhash64(*on), F.lit(HASHES))
    full = left.groupBy(bucket.alias("_hash")).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > slice_rows).collect()
    if not full:
        return left.join(right, on, how)
    hot = (
        left.filter(bucket.isin([row["_hash"] for row in full]))
        .groupBy(*on)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > slice_rows)
        .select(*on, F.ceil(F.col("_rows") / F.lit(slice_rows)).cast("int").alias("_slices"))
    )
    hot = broadcast_if_small(stage(hot, "hot_keys"))
    slices = F.coalesce(F.col("_slices"), F.lit(1))
    left_cut = (
        left.join(hot, on, "left")
        .withColumn("_slice", F.pmod(F.xxhash64(*left.columns), slices).cast("int"))
        .drop("_slices")
    )
    right_cut = (
        right.join(hot, on, "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), slices - 1)))
        .drop("_slices")
    )
    return left_cut.join(right_cut, [*on, "_slice"], how).drop("_slice")


def join_lookup(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join many rows to a lookup table of one row (or few) per key.

    A lookup that is known to be small is broadcast.  Otherwise both sides are
    shuffled, and hot keys of a large ``left`` are sliced.
    """
    if estimated_bytes(right) <= BROADCAST_BYTES:
        return left.join(F.broadcast(right), on, how)
    return skew_join(left, right, on, how)


def join_catalog(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join many rows to a short table on a key that few values may fill.

    The short table is staged, so its size is known: normally it is broadcast and
    ``left`` is not shuffled.  Should it be long after all, hot keys are sliced.
    """
    right = stage(right, "catalog")
    if estimated_bytes(right) <= BROADCAST_BYTES:
        return left.join(F.broadcast(right), on, how)
    return skew_join(left, right, on, how, large=True)
