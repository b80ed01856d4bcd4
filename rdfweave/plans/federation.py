"""One answer from all kinds of sources: loaded graphs, endpoints' answers, fragment pages.

Every kind of source says how many solutions it has for the pattern, and gives those of
them that a page takes.  The counts alone decide which sources a page reaches and how much
of each; what lies outside is neither parsed nor scanned.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rdfweave import model as M
from rdfweave.model import Pattern
from rdfweave.operators import expand, federate, fragments, paging
from rdfweave.operators.match import match, matches
from rdfweave.operators.scale import broadcast_if_small
from rdfweave.operators.stage import stage
from rdfweave.plans.query import Answer, result
from rdfweave.sources import answers, turtle

SPARQL, LDF = "sparql", "ldf"


@dataclass(frozen=True)
class Share:
    """What a page takes of a source: ``take`` solutions behind the first ``skip``."""

    source_key: str
    skip: int
    take: int


class StatementSource(Protocol):
    """One kind of source."""

    def counts(self, pattern: Pattern) -> DataFrame:
        """``(source_rank, source_key, solutions)`` of its sources; no row means none."""

    def scan(self, pattern: Pattern, shares: list[Share]) -> DataFrame:
        """The rows ``M.SOURCE + M.TERMS`` of the shares; keys of other kinds are ignored."""


def _key(kind: str, source_id: Column) -> Column:
    return M.source_key(F.lit(kind), source_id)


def _ids(kind: str, shares: list[Share]) -> list[int]:
    return [int(s.source_key.split(":", 1)[1]) for s in shares if s.source_key.startswith(kind + ":")]


def _listed(like: DataFrame, shares: list[Share]) -> DataFrame:
    """The shares as a table; a page has no more of them than rows."""
    rows = [(s.source_key, s.skip, s.take) for s in shares]
    return F.broadcast(like.sparkSession.createDataFrame(rows, "source_key string, skip long, take long"))


def _taken(rows: DataFrame, shares: list[Share], before: Column) -> DataFrame:
    """Rows whose ``before``, the number of rows of their source before them, is in the share."""
    placed = rows.withColumn("_before", before).join(_listed(rows, shares), "source_key")
    inside = (F.col("_before") >= F.col("skip")) & (F.col("_before") < F.col("skip") + F.col("take"))
    return placed.filter(inside).select(*M.SOURCE, *M.TERMS)


class StoreSource:
    """The loaded graphs, as ``store.published`` or ``match.default_graphs`` gives them."""

    def __init__(self, data: DataFrame) -> None:
        self.data = data.filter(F.col("source_key") == "local")

    def counts(self, pattern: Pattern) -> DataFrame:
        return expand.solution_counts(self.data, pattern)

    def scan(self, pattern: Pattern, shares: list[Share]) -> DataFrame:
        share = next((s for s in shares if s.source_key == "local"), Share("local", 0, 0))
        return paging.page(match(self.data, pattern), share.take, share.skip).select(*M.SOURCE, *M.TERMS)


class EndpointSource:
    """Saved answers of endpoints: ``counted`` and ``graphs`` are (source_id, named_graph, body).

    An endpoint with a named graph is answered by what was asked of that graph alone, any
    other by what was asked of its default graph.
    """

    def __init__(self, catalog: DataFrame, counted: DataFrame, graphs: DataFrame) -> None:
        self.catalog = catalog.filter(F.col("type") == SPARQL).select("id", F.col("named_graph").alias("_graph"))
        self.counted, self.graphs = counted, graphs

    def _own(self, saved: DataFrame) -> DataFrame:
        listed = broadcast_if_small(self.catalog)
        same = (F.col("source_id") == F.col("id")) & F.col("named_graph").eqNullSafe(F.col("_graph"))
        return saved.join(listed, same).select("source_id", "body")

    def counts(self, pattern: Pattern) -> DataFrame:
        stated = answers.counts(self._own(self.counted))
        return stated.select(F.lit(1).alias("source_rank"), _key(SPARQL, F.col("source_id")).alias("source_key"), "solutions")

    def scan(self, pattern: Pattern, shares: list[Share]) -> DataFrame:
        # Other sources' answers are not even read.
        wanted = self._own(self.graphs.filter(F.col("source_id").isin(_ids(SPARQL, shares))))
        found = answers.graphs(wanted).select(
            F.lit(1).alias("source_rank"), _key(SPARQL, F.col("source_id")).alias("source_key"), *M.TERMS
        )
        order = Window.partitionBy("source_key").orderBy(*[F.col(c).asc_nulls_first() for c in M.TERMS])
        found = found.filter(matches(found, pattern)).distinct()
        return _taken(found, shares, F.row_number().over(order) - 1)


class FragmentSource:
    """Saved pages of fragment servers: ``pages`` is (source_id, url, body).

    A source's first page is at its start fragment; the pages that hold a share follow
    from the total and the page size which it states.
    """

    def __init__(self, catalog: DataFrame, pages: DataFrame) -> None:
        self.catalog = catalog.filter(F.col("type") == LDF).select("id", "startfragment")
        self.pages = pages
        self.first: DataFrame | None = None

    def _parsed(self, pages: DataFrame) -> DataFrame:
        docs = pages.withColumn("doc", F.sha1(F.concat_ws(" ", F.col("source_id").cast("string"), "url")))
        return turtle.parse(docs, "body", "doc", scope=F.col("source_id"), base=F.col("startfragment"))

    def _own(self, pages: DataFrame) -> DataFrame:
        return pages.join(broadcast_if_small(self.catalog), F.col("source_id") == F.col("id")).drop("id")

    def stated(self) -> DataFrame:
        """(source_id, url, startfragment, total, page_size) of every usable source."""
        if self.first is None:
            first = self._own(self.pages).filter(F.col("url") == F.col("startfragment"))
            stated = fragments.totals(self._parsed(first)).join(self.catalog, "startfragment")
            self.first = stage(
                stated.filter(F.col("total").isNotNull() & (F.col("page_size") > 0))
                .select(F.col("id").alias("source_id"), "url", "startfragment", "total", "page_size"),
                "stated",
            )
        return self.first

    def counts(self, pattern: Pattern) -> DataFrame:
        return self.stated().select(
            F.lit(2).alias("source_rank"), _key(LDF, F.col("source_id")).alias("source_key"), F.col("total").alias("solutions")
        )

    def scan(self, pattern: Pattern, shares: list[Share]) -> DataFrame:
        stated = self.stated().withColumn("source_key", _key(LDF, F.col("source_id")))
        planned = stated.join(_listed(stated, shares), "source_key")
        first = F.floor(F.col("skip") / F.col("page_size")).cast("long")
        last = F.floor((F.col("skip") + F.col("take") - 1) / F.col("page_size")).cast("long")
        glue = F.when(F.contains(F.col("url"), F.lit("?")), "&").otherwise("?")
        # Asked for as the address of a page; the first page may be saved under the start alone.
        numbered = planned.select("source_id", "source_key", "startfragment", "page_size", F.explode(F.sequence(first, last)).alias("page"), glue.alias("glue"))
        address = F.concat("startfragment", "glue", F.lit("page="), F.col("page").cast("string"))
        wanted = stage(numbered.withColumn("url", address), "plan")
        known = broadcast_if_small(wanted.select("source_id", "url"))
        pages = self._own(self.pages.filter(F.col("source_id").isin(_ids(LDF, shares))).join(known, ["source_id", "url"], "left_semi"))
        rows = fragments.strip_metadata(stage(self._parsed(pages), "pages"))
        rows = rows.join(broadcast_if_small(wanted.select("source_id", "source_key", "url", "page", "page_size")), ["source_id", "url"])
        rows = rows.filter(matches(rows, pattern)).withColumn("source_rank", F.lit(2))
        inside = Window.partitionBy("source_key", "page").orderBy(*[F.col(c).asc_nulls_first() for c in M.TERMS])
        return _taken(rows, shares, F.col("page") * F.col("page_size") + F.row_number().over(inside) - 1)


def totals(sources: list[StatementSource], pattern: Pattern) -> DataFrame:
    """``(source_rank, source_key, solutions)`` over all kinds; sources without any are left out."""
    counts = reduce(DataFrame.unionByName, [s.counts(pattern).select(*M.SOURCE, F.col("solutions").cast("long").alias("solutions")) for s in sources])
    return counts.filter(F.col("solutions") > 0)


def federated_query(
    sources: list[StatementSource],
    pattern: Pattern,
    limit: int = paging.PAGE_SIZE,
    offset: int = 0,
    root: str = "http://localhost",
    query_string: str = "",
) -> Answer:
    """Matching statements of all kinds of sources as one page, with totals.

    Sources come in the order of their rank and key, so a page may begin in the loaded
    graphs and end in a fragment server.
    """
    counts = stage(totals(sources, pattern), "counts")
    total = counts.agg(F.sum("solutions")).first()[0] or 0
    # At most as many sources as the page has rows.
    reached = federate.page_sources(counts, limit, offset).collect()
    shares = [Share(r["source_key"], r["skip"], r["take"]) for r in reached]
    parts = [s.scan(pattern, shares) for s in sources] if shares else [counts.sparkSession.createDataFrame([], _page_schema())]
    page = stage(reduce(DataFrame.unionByName, parts), "answer")
    return Answer(
        solutions=page,
        statements=page.select(*M.TERMS).distinct(),
        counts=counts,
        total=total,
        found=not page.isEmpty(),
        description=result(counts, root, query_string, limit, offset, total),
    )


def _page_schema() -> str:
    return ", ".join(["source_rank int", *[f"{c} string" for c in ("source_key", *M.TERMS)]])
