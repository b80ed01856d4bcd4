"""Places of rows in one order, for whole tables and for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rdfweave.llm import common
from rdfweave.operators.scale import broadcast_if_small

# The low bits of monotonically_increasing_id count the rows of a partition.
ROW_BITS = 33


def numbered(df: DataFrame, group: list[str], order: list[Column | str]) -> DataFrame:
    """``df`` with ``i``, the place of a row in its group from 0, and ``n``, the rows of the group.

    The whole table is sorted by range, so a group of any size lies in many partitions and
    no task holds it.  Only (partition, group) pairs are counted further: at most one per
    group and one per partition.  Values in ``group`` must not be null.  Ties are broken
    by the place of a row in the input.
    """
    key = [*group, *order, "_salt"]
    placed = (
        df.withColumn("_salt", F.monotonically_increasing_id())
        .repartitionByRange(*key)
        .sortWithinPartitions(*key)
        .drop("_salt")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1)))
    )
    rows = common.stage(placed, "ordered")
    counted = rows.groupBy(*group, "_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_count"))
    # A group has as many rows here as partitions that hold it.
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select(
        *group,
        "_part",
        (F.coalesce(F.sum("_count").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_count").over(whole).alias("n"),
    )
    starts = broadcast_if_small(common.stage(starts, "starts"))
    return rows.join(starts, [*group, "_part"]).withColumn("i", F.col("_row") + F.col("_shift")).drop("_part", "_row", "_shift")


def placed(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(doc_id, text, place) of every row; ``place`` tells documents apart and orders them.

    It is the doc_id, unless one stands on several texts: then documents are numbered by
    doc_id and the hash of their text, and (place, doc_id) is returned beside the rows.
    Rows without a doc_id have no place.
    """
    rows = common.only(docs, "doc_id", "text")
    known = rows.filter("doc_id IS NOT NULL").select("doc_id", F.xxhash64("text").alias("_hash"))
    several = known.groupBy("doc_id").agg(F.min("_hash").alias("a"), F.max("_hash").alias("b")).filter("a <> b")
    if common.stage(several, "several").isEmpty():
        return rows.withColumn("place", F.col("doc_id")), None
    places = common.stage(
        numbered(known.distinct(), [], ["doc_id", "_hash"]).select("doc_id", "_hash", F.col("i").alias("place")), "places"
    )
    rows = rows.withColumn("_hash", F.xxhash64("text")).join(places, ["doc_id", "_hash"], "left").drop("_hash")
    return rows, places.select("place", "doc_id")
