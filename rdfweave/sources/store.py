"""The statements table on shared storage: load, replace, clear, read.

One Parquet folder per named graph, sorted by predicate and subject so that row-group
statistics prune pattern scans, with the fragment-free lower-case subject stored for hash
variants.  Graphs are replaced by commits, see ``versions``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rdfweave import model as M
from rdfweave.model import Pattern
from rdfweave.operators.match import default_graphs, subject_base
from rdfweave.operators.scale import TASK_BYTES, dealt, in_order
from rdfweave.operators.stage import scope, stage
from rdfweave.sources import ranks
from rdfweave.sources.ntriples import QUARANTINE_SCHEMA
from rdfweave.sources.versions import Versions

STORE_SCHEMA = T.StructType(
    [f for f in M.STATEMENTS_SCHEMA.fields if f.name != "graph"]
    + [T.StructField("s_base", T.StringType()), T.StructField("graph", T.StringType())]
)


def table(store: str) -> Versions:
    return Versions(store, "graph", STORE_SCHEMA)


def read(spark: SparkSession, store: str) -> DataFrame:
    """The statements of the last commit; later writes do not change what is read."""
    return table(store).read(spark)


#: Characters of an object that range partitioning goes by: it sends samples to the driver.
NEAR_CHARS = 256


def _laid_out(statements: DataFrame, ordered: bool, staged: bool = False) -> DataFrame:
    """Distinct statements of each graph in store layout.

    The range partitioning runs over the sort key, so a predicate that fills a third of a
    graph is spread over many files, and copies are in one task: they are merged in the
    order in which they are written, and rows are shuffled and sorted once.
    """
    copies = ["graph", "source_id", *M.TERMS]
    if not ordered:
        rows = dealt(statements, *copies).dropDuplicates(copies)
    else:
        # Finding the ranges reads the rows, and dealing them out reads them again.
        rows = statements if staged else stage(statements, "statements")
        # Beginnings of objects are in the order of the objects.
        near = ["graph", "p", "s", "_near"]
        rows = in_order(rows.withColumn("_near", F.substring("o", 1, NEAR_CHARS)), *near, then=["o"], task_bytes=TASK_BYTES)
        # Grouped by the sort key first, so that the order stays.
        rows = rows.dropDuplicates([*near, "o", *[c for c in copies if c not in (*near, "o")]])
        rows = rows.sortWithinPartitions(*near, "o")
    return rows.withColumn("s_base", subject_base(F.col("s"))).select(*STORE_SCHEMA.names)


def append(statements: DataFrame, store: str, ordered: bool = True) -> None:
    """Add statements to their graphs."""
    with scope(statements.sparkSession):
        table(store).append(_laid_out(statements, ordered))


def replace(
    statements: DataFrame, store: str, graphs: list[str], ordered: bool = True, staged: bool = False
) -> None:
    """Put ``statements`` in the place of the named graphs; other graphs stay.

    A graph for which ``statements`` holds nothing ends up empty.  All graphs change at once,
    and only when the new rows are written.  ``staged`` says that ``statements`` only read
    staged rows, which may well be read twice.
    """
    with scope(statements.sparkSession):
        table(store).replace(_laid_out(statements.filter(F.col("graph").isin(graphs)), ordered, staged), graphs)


def clear(spark: SparkSession, store: str, *graphs: str) -> None:
    """Empty graphs: the next commit does not name them."""
    table(store).clear(spark, list(graphs))


def vacuum(spark: SparkSession, store: str, keep: int = 1) -> list[str]:
    """Remove what the last ``keep`` commits do not name."""
    return table(store).vacuum(spark, keep)


def quarantine(rejects: DataFrame, path: str, source_ids: list[int]) -> None:
    """Keep what could not be read, with the reason, in the place of what the named
    sources had there; a source without bad rows has none left."""
    rows = rejects.select("value", "reason", F.col("source_id").cast("int").alias("source_id"))
    Versions(path, "source_id", QUARANTINE_SCHEMA).replace(rows, source_ids)


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    """``(value, reason, source_id)`` of all sources."""
    return Versions(path, "source_id", QUARANTINE_SCHEMA).read(spark)


PUBLISHED_SCHEMA = T.StructType(
    [T.StructField("source_rank", T.IntegerType())]
    + [f for f in M.STATEMENTS_SCHEMA.fields if f.name in M.TERMS]
    + [T.StructField("s_base", T.StringType()), T.StructField("source_key", T.StringType())]
)


def publish(
    spark: SparkSession, store: str, table: str, source_keys: list[str] | None = None, by_object: bool = False
) -> None:
    """Write the default graphs of a store once, so that queries need not merge copies, and
    the ranks of their statements, so that deep pages need not count.

    All loaded files become the one graph ``local``.  After graphs were replaced, name
    their ``source_keys``; only those folders are rewritten.  ``by_object`` writes a second
    copy, sorted by object, for patterns that bind it (``for_pattern``).
    """
    data = default_graphs(read(spark, store), distinct=False)
    if source_keys is not None:
        data = data.filter(F.col("source_key").isin(source_keys))
    with scope(spark):
        rows = stage(dealt(data, "source_key", *M.TERMS).distinct().select(*PUBLISHED_SCHEMA.names), "published")
        # Below a predicate, the order of pages.
        _publish(rows, table, ["source_key", "p", *ranks.WITHIN], "s")
        if by_object:
            _publish(rows, _objects(table), ["source_key", "o", "p", "s"], "p")
    written = published(spark, table)
    ranks.write(spark, table, written if source_keys is None else written.filter(F.col("source_key").isin(source_keys)))


def _objects(table: str) -> str:
    return f"{table.rstrip('/')}.objects"


def _publish(rows: DataFrame, table: str, key: list[str], bloom: str) -> None:
    """Files in the order of ``key``; ``bloom`` is a column that this order scatters."""
    (
        in_order(rows, *key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option(f"parquet.bloom.filter.enabled#{bloom}", "true")
        .partitionBy("source_key")
        .parquet(table)
    )


def for_pattern(spark: SparkSession, table: str, pattern: Pattern) -> DataFrame:
    """The default graphs in the layout in which a pattern reads least.

    A bound object is looked up in the copy sorted by object, which ``publish`` must have
    written; all else in the one sorted by predicate, where a subject alone is found by its
    Bloom filters.
    """
    return published(spark, table if pattern.o is None or pattern.s is not None else _objects(table))


def published(spark: SparkSession, table: str) -> DataFrame:
    """The default graphs as queries take them."""
    return spark.read.schema(PUBLISHED_SCHEMA).parquet(table)


def ranked_page(spark: SparkSession, table: str, pattern: Pattern, limit: int, offset: int) -> tuple[DataFrame, int]:
    """A page of a predicate's statements and their total, from the files that hold the page."""
    return ranks.page(spark, table, PUBLISHED_SCHEMA, pattern, limit, offset)
