"""The two read queries from end to end: pattern query and dereference."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rdfweave import model as M
from rdfweave.model import Pattern, Term
from rdfweave.operators import describe, expand, federate, paging
from rdfweave.operators.match import match
from rdfweave.operators.stage import stage


@dataclass
class Answer:
    """A page of an answer with its totals and its description."""

    solutions: DataFrame
    statements: DataFrame
    counts: DataFrame
    total: int
    found: bool
    description: DataFrame


def _result(df: DataFrame, root: str, path: str, query: str, limit: int, offset: int, total: int) -> DataFrame:
    values = [(0, root, path, query, limit, offset, total)]
    columns = "result_id int, root string, path string, query_string string, limit long, offset long, total long"
    return describe.describe(df.sparkSession.createDataFrame(values, columns)).drop("result_id")


def result(df: DataFrame, root: str, query: str, limit: int, offset: int, total: int) -> DataFrame:
    """The description of a page of a pattern's matches."""
    return _result(df, root, describe.PATTERN_PATH, query, limit, offset, total)


def pattern_query(
    data: DataFrame,
    pattern: Pattern,
    limit: int = paging.PAGE_SIZE,
    offset: int = 0,
    depth: int = 1,
    root: str = "http://localhost",
    query_string: str = "",
) -> Answer:
    """Matching statements of all sources as one page, with totals.

    ``data`` comes from ``match.default_graphs``.  Sources are counted once; the
    counts give the total and leave out the sources the page does not reach.
    """
    counts = stage(expand.solution_counts(data, pattern, depth), "counts")
    total = counts.agg(F.sum("solutions")).first()[0] or 0
    base, rest = match(data, pattern), offset
    if depth == 1 or expand.counts_expansion(pattern, depth):
        # Only where the counts are those of the solutions that are paged.
        base, rest = federate.reaching(base, counts, limit, offset)
    page = stage(paging.expanded_page(base, data, depth, limit, rest), "answer")
    return Answer(
        solutions=page,
        statements=expand.construct(page, depth),
        counts=counts,
        total=total,
        found=not page.isEmpty(),
        description=result(data, root, query_string, limit, offset, total),
    )


def dereference_query(
    data: DataFrame,
    uri: str,
    depths: DataFrame,
    offset: int = 0,
    hash_variants: bool = False,
    root: str = "http://localhost",
    path: str = "",
    query_string: str = "",
) -> Answer:
    """Everything known about one URI, each source expanded to its own depth.

    An empty address, or that of the root, names no subject: all statements are asked for.
    """
    named = uri not in ("", root)
    pattern = Pattern(s=Term.iri(uri), hash_variants=hash_variants) if named else Pattern()
    base = match(data, pattern)
    # The count rule of pattern queries: hash variants are counted as matched statements.
    if expand.counts_expansion(pattern, expand.MAX_DEPTH):
        counts = federate.counts_by_source(base, data, depths)
    else:
        counts = expand.expanded_counts(base, data, expand.MIN_DEPTH, M.SOURCE)
    counts = stage(counts, "counts")
    total = counts.agg(F.sum("solutions")).first()[0] or 0
    request = data.sparkSession.createDataFrame([(0, uri)], "request_id long, uri string")
    found = federate.dereference(data, request, depths, offset=offset, hash_variants=hash_variants, root=root)
    pages = stage(found, "answer")
    return Answer(
        solutions=pages,
        statements=expand.construct(pages, max(expand.levels_of(depths))),
        counts=counts,
        total=total,
        found=not pages.isEmpty(),
        description=_result(data, root, path, query_string, paging.PAGE_SIZE, offset, total),
    )
