"""Where the n-th statement of a predicate lies, so that a deep page is looked up and not counted.

Published statements are sorted by predicate and then in the order of pages, over files that
do not overlap.  For every file and predicate the index holds how many statements there are and
the first of them: one row per file, and one more for each predicate that a file holds.
"""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rdfweave import model as M
from rdfweave.model import Pattern
from rdfweave.operators.match import match
from rdfweave.operators.scale import broadcast_if_small
from rdfweave.operators.stage import scope, stage

#: The order of pages below a predicate.
WITHIN = [c for c in M.TERMS if c != "p"]


def folder(table: str) -> str:
    return f"{table.rstrip('/')}.ranks"


def write(spark: SparkSession, table: str, statements: DataFrame) -> None:
    """Index the published ``statements`` of ``table``; other source keys keep their entries."""
    # Files are sorted, so the first statement of a predicate is that of the least place.  A least
    # place needs no sort, which a least statement does; few rows are then looked up.
    place, file = F.col("_metadata.row_index"), F.col("_metadata.file_path")
    key = ["source_rank", "source_key", "p"]
    first = F.struct(*[x for c in WITHIN for x in (F.col(c).isNotNull(), F.col(c))])
    with scope(spark):
        least = stage(
            statements.select(*key, file.alias("file"), place.alias("place"))
            .groupBy(*key, "file")
            .agg(F.count(F.lit(1)).alias("rows"), F.min("place").alias("place")),
            "places",
        )
        found = statements.select(file.alias("file"), place.alias("place"), first.alias("first"))
        (
            found.join(broadcast_if_small(least), ["file", "place"])
            .select("source_rank", "p", "file", "rows", "first", "source_key")
            # Only the entries meet in one task; ``coalesce`` would take the scan there, too.
            .repartition(1)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("source_key")
            .parquet(folder(table))
        )


def serves(pattern: Pattern) -> bool:
    """Whether the index knows the place of what matches: the predicate alone is bound."""
    return pattern.p is not None and pattern.s is None and pattern.o is None


@dataclass(frozen=True)
class Place:
    """The files that hold a page, the rows in them before it, and all rows of the pattern."""

    files: list[str]
    skip: int
    total: int


def find(spark: SparkSession, table: str, pattern: Pattern, limit: int, offset: int) -> Place:
    """Where rows ``offset .. offset + limit`` of a predicate's statements lie.

    Runs over the entries of one predicate, at most one for each file; of these, only the
    entries of the page come to the driver.
    """
    if not serves(pattern):
        raise ValueError("only a bound predicate has ranks")
    entries = spark.read.parquet(folder(table)).filter(F.col("p") == pattern.p.value)
    order = "source_rank, source_key, first"
    before = F.expr(f"coalesce(sum(rows) OVER (ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    placed = entries.withColumn("before", before).withColumn("total", F.expr("sum(rows) OVER ()"))
    reached = placed.filter((F.col("before") < offset + limit) & (F.col("before") + F.col("rows") > offset))
    rows = reached.orderBy("before").select("file", "before", "total").collect()
    if not rows:
        total = entries.agg(F.sum("rows")).first()[0] or 0
        return Place([], 0, total)
    return Place([r["file"] for r in rows], offset - rows[0]["before"], rows[0]["total"])


def page(spark: SparkSession, table: str, schema, pattern: Pattern, limit: int, offset: int) -> tuple[DataFrame, int]:
    """The page, and how many statements match in all; reads no other files than the page's."""
    place = find(spark, table, pattern, limit, offset)
    if not place.files:
        return match(spark.createDataFrame([], schema), pattern), place.total
    # Paths are listed as they are encoded; the reader wants them as they are.
    paths = list(dict.fromkeys(unquote(f) for f in place.files))
    rows = match(spark.read.schema(schema).option("basePath", table).parquet(*paths), pattern)
    order = [F.col(c).asc_nulls_first() for c in (*M.SOURCE, *M.TERMS)]
    return rows.orderBy(*order).offset(place.skip).limit(limit), place.total
