"""Statement-pattern matching over one default graph per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rdfweave import model as M
from rdfweave.model import Pattern, Term
from rdfweave.operators.scale import short_list


def subject_base(subject: Column) -> Column:
    """Lower-cased subject without its fragment: the stored key for hash variants."""
    return F.lower(F.substring_index(subject, "#", 1))


def hash_variant(subject: Column, uri: Column, unescaped: bool = False) -> Column:
    """``subject`` is ``uri`` or ``uri#...``, ignoring case.

    ``unescaped`` reads the URI as a regular expression, so that its dots match
    any character; only of use to reproduce answers made that way.
    """
    if unescaped:
        return F.regexp_like(subject, F.concat(F.lit("(?i)^"), uri, F.lit("(#.*)?$")))
    wanted = F.lower(uri)
    found = F.lower(subject)
    return (found == wanted) | F.startswith(found, F.concat(wanted, F.lit("#")))


def matches(df: DataFrame, pattern: Pattern, unescaped: bool = False) -> Column:
    """The filter of a pattern; plain equalities wherever the pattern allows it."""
    test = F.lit(True)
    if pattern.by_hash:
        uri = F.lit(pattern.s.value)
        if "s_base" in df.columns and not unescaped:
            # Equality on the stored key is pushed to the scan; the exact test follows.
            test &= F.col("s_base") == subject_base(uri)
        test &= (F.col("s_kind") == M.IRI) & hash_variant(F.col("s"), uri, unescaped)
    elif pattern.s is not None:
        test &= pattern.s.matches("s")
    for position, term in (("p", pattern.p), ("o", pattern.o)):
        if term is not None:
            test &= term.matches(position)
    return test


def in_graph(statements: DataFrame, graph: str | None) -> DataFrame:
    """Restrict to one named graph; prunes partitions of the store."""
    return statements if graph is None else statements.filter(F.col("graph") == graph)


def default_graphs(
    statements: DataFrame, graph: str | None = None, distinct: bool = True
) -> DataFrame:
    """The statements as queries see them: one set per ``source_key``.

    All loaded files make up the single graph ``local``; each endpoint and each
    fragment server is a graph of its own.  The same statement loaded from two files
    counts once.  ``distinct=False`` skips that step where the caller knows there
    are no copies, such as within one loaded graph.
    """
    key = M.source_key(F.col("source_type"), F.col("source_id"))
    rank = M.source_rank(F.col("source_type"))
    extra = ["s_base"] if "s_base" in statements.columns else []
    rows = in_graph(statements, graph).select(
        rank.alias("source_rank"), key.alias("source_key"), *M.TERMS, *extra
    )
    return rows.distinct() if distinct else rows


def match(data: DataFrame, pattern: Pattern, unescaped: bool = False) -> DataFrame:
    """Rows of ``data`` that match; depth-one solutions."""
    return data.filter(matches(data, pattern, unescaped)).select(*M.SOURCE, *M.TERMS)


def match_subjects(
    data: DataFrame, requests: DataFrame, hash_variants: bool = False
) -> DataFrame:
    """Match many subjects at once: ``requests(request_id, uri, ...)`` against subjects.

    With ``hash_variants`` the equi-join is on the fragment-free lower-case key
    and the exact test runs on the joined rows.  A few requests also become an IN
    filter that reaches the scan.
    """
    column, wanted = ("s_base", subject_base(F.col("uri"))) if hash_variants else ("s", F.col("uri"))
    values = short_list(requests.select(wanted.alias("value")))
    if values is not None and column in data.columns:
        data = data.filter(F.col(column).isin(values))
    if not hash_variants:
        return data.filter(F.col("s_kind") == M.IRI).join(
            requests, F.col("s") == F.col("uri"), "inner"
        )
    base = data if "s_base" in data.columns else data.withColumn("s_base", subject_base(F.col("s")))
    wanted = requests.withColumn("_base", subject_base(F.col("uri")))
    return (
        base.filter(F.col("s_kind") == M.IRI)
        .join(wanted, F.col("s_base") == F.col("_base"), "inner")
        .filter(hash_variant(F.col("s"), F.col("uri")))
        .drop("_base", "s_base")
    )


__all__ = [
    "Pattern",
    "Term",
    "default_graphs",
    "hash_variant",
    "in_graph",
    "match",
    "match_subjects",
    "matches",
    "subject_base",
]
