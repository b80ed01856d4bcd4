"""Pages of a fragment server: totals, page plan, and data without metadata.

Input is a statements frame with ``url`` (the page) and ``startfragment`` columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rdfweave import model as M
from rdfweave.operators.scale import skew_join

PAGE = ["url", "startfragment"]


def totals(rows: DataFrame) -> DataFrame:
    """Total and page size each page states about itself.

    The total is ``hydra:totalItems``, else ``void:triples``.  Pages that state
    none are kept with a null total, so that they can be reported.
    """

    def stated(predicate: str):
        about = (F.col("s") == F.col("url")) & (F.col("p") == predicate)
        return F.max(F.when(about & (F.col("o_kind") == M.LITERAL), F.col("o").try_cast("long")))

    return rows.groupBy(*PAGE).agg(
        F.coalesce(stated(M.HYDRA + "totalItems"), stated(M.VOID + "triples")).alias("total"),
        stated(M.HYDRA + "itemsPerPage").alias("page_size"),
    )


def page_plan(stated: DataFrame, limit: int, offset: int, covering: bool = False) -> DataFrame:
    """Page addresses to ask for, for servers with a fixed page size.

    Input is ``totals`` of the first pages; servers without total or page size, or
    with no row beyond the offset, are left out.  Pages are numbered from 0; the
    first is ``ceil(offset / size)`` and ``ceil(limit / size)`` pages are taken.
    ``covering`` instead takes exactly the pages that hold the wanted rows.
    """
    size = F.col("page_size")
    first = F.ceil(F.lit(offset) / size).cast("long")
    last = first + F.ceil(F.lit(limit) / size).cast("long") - 1
    if covering:
        end = F.least(F.lit(offset + limit), F.col("total")) - 1
        first = F.floor(F.lit(offset) / size).cast("long")
        last = F.floor(end / size).cast("long")
    usable = stated.filter((F.col("total") > offset) & (size > 0))
    numbered = usable.withColumn("_first", first).withColumn("_last", last)
    glue = F.when(F.contains(F.col("url"), F.lit("?")), F.lit("&")).otherwise(F.lit("?"))
    return (
        numbered.filter(F.col("_last") >= F.col("_first"))
        .withColumn("page", F.explode(F.sequence("_first", "_last")))
        .withColumn("page_url", F.concat("url", glue, F.lit("page="), F.col("page").cast("string")))
        .drop("_first", "_last")
    )


def unusable(stated: DataFrame) -> DataFrame:
    """First pages that cannot be paged through: no total or no page size stated."""
    return stated.filter(F.col("total").isNull() | F.col("page_size").isNull())


def _listed() -> Column:
    """Whether a statement says that its subject is a page."""
    return (F.col("p") == M.RDF_TYPE) & F.col("o").isin(M.HYDRA + "Collection", M.HYDRA + "PagedCollection")


def _dataset() -> Column:
    return F.concat(F.col("startfragment"), F.lit("#dataset"))


def _hashed(rows: DataFrame) -> DataFrame:
    """``rows`` with a hash of ``(url, s)`` as ``_key``: leading a join key, it is what is compared in sorts."""
    return rows.withColumn("_key", F.xxhash64("url", "s"))


def metadata_subjects(rows: DataFrame) -> DataFrame:
    """Subjects that describe the page rather than belong to its data: ``(url, s)``.

    One scan: a mapping counts if a search of the same page names its subject.
    """
    search = (F.col("s") == _dataset()) & (F.col("p") == M.HYDRA + "search")
    mapping = (F.col("p") == M.HYDRA + "mapping") & (F.col("o_kind") == M.BNODE)
    listed, searches = F.col("p") == M.RDF_TYPE, F.col("p") == M.HYDRA + "search"
    found = rows.filter(_listed() | search | mapping).select(
        "url",
        F.when(searches, F.col("o")).otherwise(F.col("s")).alias("s"),
        F.when(listed, F.col("s")).otherwise(F.col("o")).alias("node"),
        searches.alias("searched"),
        (F.col("p") == M.HYDRA + "mapping").alias("maps"),
    )
    around = Window.partitionBy("_key", "url", "s")
    searched = F.max("searched").over(around) & F.col("url").isNotNull() & F.col("s").isNotNull()
    found = _hashed(found).withColumn("searched", searched)
    return found.filter(~F.col("maps") | F.col("searched")).select("url", F.col("node").alias("s")).distinct()


def strip_metadata(rows: DataFrame) -> DataFrame:
    """The data statements of every page, all term columns kept."""
    # What lists its subject is metadata without a look at other statements.
    plain = F.coalesce(_listed() & F.col("url").isNotNull() & F.col("s").isNotNull(), F.lit(False))
    left = _hashed(rows.filter((F.col("s") != _dataset()) & ~plain))
    return skew_join(left, _hashed(metadata_subjects(rows)), ["_key", "url", "s"], "left_anti").drop("_key")


__all__ = [
    "metadata_subjects",
    "page_plan",
    "strip_metadata",
    "totals",
    "unusable",
]
