"""Counting, merging and paging over many sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rdfweave import model as M
from rdfweave.model import Pattern
from rdfweave.operators.expand import by_depth, expand_by_source, expanded_counts, levels_of
from rdfweave.operators.match import match, match_subjects
from rdfweave.operators.paging import PAGE_SIZE, order_columns, page, page_per_group
from rdfweave.operators.scale import broadcast_if_small
from rdfweave.operators.stage import stage


def with_total(counts: DataFrame) -> DataFrame:
    """Adds the total over all sources to per-source counts, as the row without a key."""
    return counts.rollup("source_key").agg(
        F.when(F.grouping("source_key") == 0, F.max("source_rank")).alias("source_rank"),
        F.sum("solutions").alias("solutions"),
    )


def counts_by_source(base: DataFrame, data: DataFrame, depths: DataFrame) -> DataFrame:
    """Solutions per source, each expanded to its own depth, without expanding them."""
    at_depth = by_depth(depths)
    parts = [
        expanded_counts(at_depth(base, d), at_depth(data, d), d, M.SOURCE)
        for d in levels_of(depths)
    ]
    return reduce(DataFrame.unionByName, parts)


def merge(*graphs: DataFrame) -> DataFrame:
    """Set union of graphs: a statement found in several of them stays once."""
    return reduce(DataFrame.unionByName, [g.select(*M.TERMS) for g in graphs]).distinct()


def distinct_statements(statements: DataFrame) -> DataFrame:
    """Size of the merged graph: one row, ``distinct_statements``."""
    return statements.select(*M.TERMS).distinct().agg(F.count(F.lit(1)).alias("distinct_statements"))


def page_sources(counts: DataFrame, limit: int, offset: int) -> DataFrame:
    """The sources a page reaches and how much of each it takes.

    ``counts`` has one row per source, so the running total is over the catalog,
    never over statements.
    """
    before = Window.orderBy("source_rank", "source_key").rowsBetween(
        Window.unboundedPreceding, -1
    )
    first = F.coalesce(F.sum("solutions").over(before), F.lit(0))
    skip = F.greatest(F.lit(offset) - F.col("first"), F.lit(0))
    return (
        counts.withColumn("first", first)
        .withColumn("skip", skip.cast("long"))
        .withColumn(
            "take",
            (F.least(F.col("solutions"), F.lit(offset + limit) - F.col("first")) - F.col("skip")).cast(
                "long"
            ),
        )
        .filter((F.col("skip") < F.col("solutions")) & (F.col("take") > 0))
    )


def reaching(
    base: DataFrame, counts: DataFrame, limit: int, offset: int
) -> tuple[DataFrame, int]:
    """Leaves out the sources a page does not reach; returns what remains of the offset.

    The counts are the ones already made for the total.  What is kept is an IN list
    of source keys, which prunes the scan.
    """
    reached = page_sources(counts, limit, offset).orderBy("first").collect()
    if not reached:
        return base.limit(0), 0
    keys = [row["source_key"] for row in reached]
    return base.filter(F.col("source_key").isin(keys)), offset - reached[0]["first"]


def dereference(
    data: DataFrame,
    requests: DataFrame,
    depths: DataFrame,
    limit: int = PAGE_SIZE,
    offset: int = 0,
    hash_variants: bool = False,
    root: str | None = None,
) -> DataFrame:
    """The page of solutions of every request ``(request_id, uri)``.

    With a ``root``, a request for no address or for the root's asks for all statements; what
    it gets is found once, however many such requests there are.

    Every matched statement has at least one solution and sorts first by its own
    terms, so each request is cut to its first ``offset + limit`` matched statements
    before anything is expanded, and to the exact page afterwards.  The cut is
    staged, since every depth level and every hop starts from it.
    """
    wanted = stage(requests.select("request_id", "uri"), "requests")
    if root is not None:
        subject = M.request_subject(F.col("uri"), F.lit(root))
        for_all, wanted = wanted.filter(subject.isNull()).select("request_id"), wanted.filter(subject.isNotNull())
        if not for_all.isEmpty():
            page_of_all = stage(expanded_page_by_source(match(data, Pattern()), data, depths, limit, offset), "all")
            named = dereference(data, wanted, depths, limit, offset, hash_variants)
            every = F.lit(0).alias("_every")
            rows = page_of_all.select("*", every).join(for_all.select("*", every), "_every").select(*named.columns)
            return named.unionByName(rows)
    wanted = broadcast_if_small(wanted)
    found = match_subjects(data, wanted, hash_variants).select("request_id", *M.SOURCE, *M.TERMS)
    first = page_per_group(found, ["request_id"], order_columns(), offset + limit)
    solutions = expand_by_source(stage(first, "pages"), data, depths)
    return page_per_group(
        solutions, ["request_id"], order_columns(max(levels_of(depths))), limit, offset
    )


def expanded_page_by_source(
    base: DataFrame, data: DataFrame, depths: DataFrame, limit: int = PAGE_SIZE, offset: int = 0
) -> DataFrame:
    """A page of ``expand_by_source(base, data, depths)``, whatever ``base`` matches.

    Every matched statement has at least one solution and sorts first by its own terms, so the
    page lies within the first ``offset + limit`` of them.
    """
    first = stage(page(base, offset + limit), "page")
    deepest = max(levels_of(depths))
    return page(expand_by_source(first, data, depths), limit, offset, deepest)
