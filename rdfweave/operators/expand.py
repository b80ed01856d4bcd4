"""Bounded-depth expansion along object -> subject, its counts and its statements.

A solution of depth ``d`` is a matched statement followed by one path of ``d - 1``
further statements, each starting at the object of the one before.  The path is all
or nothing: a statement without any full path keeps one solution with an empty path.
Paths never leave their ``source_key`` and never start at a literal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rdfweave import model as M
from rdfweave.model import Pattern
from rdfweave.operators.match import match
from rdfweave.operators.scale import (
    PUSHED_VALUES,
    broadcast_if_small,
    is_large,
    join_catalog,
    keep_nodes,
    skew_join,
)
from rdfweave.operators.stage import stage

# Allowed depths of a source, and the depth of the loaded graphs
# when a URI is dereferenced.
MIN_DEPTH, MAX_DEPTH = 1, 5
LOCAL_DEPTH = 3

NODE = ["source_key", "node_kind", "node"]


def hop_columns(hop: int) -> list[str]:
    return [f"p{hop}", f"o{hop}", f"o{hop}_kind", f"o{hop}_datatype", f"o{hop}_lang"]


def path_columns(depth: int) -> list[str]:
    return [c for hop in range(2, depth + 1) for c in hop_columns(hop)]


def _check(depth: int) -> None:
    if not MIN_DEPTH <= depth <= MAX_DEPTH:
        raise ValueError(f"depth must be {MIN_DEPTH} to {MAX_DEPTH}, got {depth}")


def _not_literal(column: str) -> Column:
    return F.col(column) != M.LITERAL


def _hop(data: DataFrame, hop: int) -> DataFrame:
    """All statements as hop ``hop``, keyed by the node they start from."""
    p, o, kind, datatype, lang = hop_columns(hop)
    return data.select(
        "source_key",
        F.col("s_kind").alias("node_kind"),
        F.col("s").alias("node"),
        F.col("p").alias(p),
        F.col("o").alias(o),
        F.col("o_kind").alias(kind),
        F.col("o_datatype").alias(datatype),
        F.col("o_lang").alias(lang),
    )


def hops(
    data: DataFrame, start: DataFrame, n: int, columns: list[str] | None = None, once: bool = False
) -> list[DataFrame]:
    """The statements that a path of up to ``n`` statements from the nodes ``start`` can pass, by
    their place on it.

    Every hop is staged, so ``data`` is read once for each, whatever follows; while the list
    of nodes is short, it filters the scan.  The last hop is not, if it is used ``once``.
    """
    out: list[DataFrame] = []
    for i in range(n):
        rows = _starting_at(data, start)
        rows = rows if columns is None else rows.select(*columns)
        out.append(rows if once and i == n - 1 else stage(rows, "hop"))
        start = _object_node(out[-1].filter(_not_literal("o_kind")))
    return out


def paths(data: DataFrame, depth: int, start: DataFrame) -> DataFrame:
    """Every path of ``depth - 1`` statements from the nodes ``start``, with its first node.

    Each hop joins the statements to the nodes reached so far, never to each other as a whole.
    """
    steps = hops(data, start, depth - 1)
    chain = _hop(steps[0], 2)
    for hop in range(3, depth + 1):
        chain = _next_hop(chain, steps[hop - 2], hop)
    return chain


def _starting_at(data: DataFrame, nodes: DataFrame) -> DataFrame:
    """The statements that start at ``nodes`` (``NODE`` keys).

    The distinct nodes are staged, so their number is known when the join is planned:
    a short list becomes a filter or a broadcast, a long one an ordinary semi-join.
    """
    keys = stage(nodes.select(*NODE).distinct(), "nodes")
    kept = keep_nodes(data, keys)
    rows = data if kept is None else kept
    joined = keys.select(*[F.col(c).alias(f"_{c}") for c in NODE])
    return rows.join(
        broadcast_if_small(joined),
        (F.col("source_key") == F.col("_source_key"))
        & (F.col("s_kind") == F.col("_node_kind"))
        & (F.col("s") == F.col("_node")),
        "left_semi",
    )


def _next_hop(chain: DataFrame, data: DataFrame, hop: int) -> DataFrame:
    _, o, kind, _, _ = hop_columns(hop - 1)
    step = _hop(data, hop).select(
        F.col("source_key").alias("_key"),
        F.col("node_kind").alias("_kind"),
        F.col("node").alias("_node"),
        *hop_columns(hop),
    )
    return (
        chain.filter(_not_literal(kind))
        .join(
            step,
            (F.col("source_key") == F.col("_key"))
            & (F.col(kind) == F.col("_kind"))
            & (F.col(o) == F.col("_node")),
            "inner",
        )
        .drop("_key", "_kind", "_node")
    )


def _object_node(base: DataFrame) -> DataFrame:
    return base.withColumn("node_kind", F.col("o_kind")).withColumn("node", F.col("o"))


def _without_path(base: DataFrame, depth: int) -> DataFrame:
    return base.select("*", *[F.lit(None).cast("string").alias(c) for c in path_columns(depth)])


def expand(
    base: DataFrame,
    data: DataFrame,
    depth: int,
    large: bool | None = None,
) -> DataFrame:
    """Solutions of the matched statements ``base`` down to ``depth``.

    Paths are grown from the objects of ``base``, whatever their number: what the
    pattern does not reach is never joined.

    Literal objects cannot have a path and skip the join.  On large data the left
    join becomes an inner join (skew on either side is split) plus an anti join.
    """
    _check(depth)
    if depth == 1:
        return base
    columns = [*base.columns, *path_columns(depth)]
    literals = _without_path(base.filter(~_not_literal("o_kind")), depth)
    nodes = _object_node(base.filter(_not_literal("o_kind")))
    chain = paths(data, depth, nodes)
    if not (is_large(data) if large is None else large):
        expanded = nodes.join(chain, NODE, "left").select(*columns)
    else:
        full = nodes.join(chain, NODE, "inner").select(*columns)
        ends = chain.select(*NODE).distinct()
        none = skew_join(nodes, ends, NODE, "left_anti", large=True)
        expanded = full.unionByName(_without_path(none, depth).select(*columns))
    return literals.select(*columns).unionByName(expanded)


def levels_of(depths: DataFrame) -> list[int]:
    """The depths that occur, with the one of sources that ``depths`` does not name."""
    found = {MIN_DEPTH, *[row[0] for row in depths.select("depth").distinct().limit(100).collect()]}
    for depth in found:
        _check(depth)
    return sorted(found)


def by_depth(depths: DataFrame) -> Callable[[DataFrame, int], DataFrame]:
    """A function that keeps the rows of the sources with a given depth.

    Sources that ``depths(source_key, depth)`` does not name have depth one.  The keys
    of an ordinary catalog become a plain filter, so that the folders of other sources
    are not even listed; a very long catalog is joined.
    """
    catalog = depths.select("source_key", "depth")
    rows = catalog.limit(PUSHED_VALUES + 1).collect()

    def listed(df: DataFrame, depth: int) -> DataFrame:
        if depth == MIN_DEPTH:
            return df.filter(~F.col("source_key").isin([r[0] for r in rows if r[1] > depth]))
        return df.filter(F.col("source_key").isin([r[0] for r in rows if r[1] == depth]))

    def joined(df: DataFrame, depth: int) -> DataFrame:
        if depth == MIN_DEPTH:
            deeper = catalog.filter(F.col("depth") > depth).select("source_key")
            return join_catalog(df, deeper, ["source_key"], "left_anti")
        keys = catalog.filter(F.col("depth") == depth).select("source_key")
        return join_catalog(df, keys, ["source_key"], "left_semi")

    return listed if len(rows) <= PUSHED_VALUES else joined


def expand_by_source(
    base: DataFrame,
    data: DataFrame,
    depths: DataFrame,
) -> DataFrame:
    """Expansion where each source has its own depth: ``depths(source_key, depth)``.

    One branch per depth level, over the sources of that level only.  Sources that
    ``depths`` does not name get depth one.
    """
    levels, at_depth = levels_of(depths), by_depth(depths)
    deepest = max(levels)
    out = None
    for depth in levels:
        part = expand(at_depth(base, depth), at_depth(data, depth), depth)
        missing = [c for c in path_columns(deepest) if c not in part.columns]
        part = part.select("*", *[F.lit(None).cast("string").alias(c) for c in missing])
        out = part if out is None else out.unionByName(part)
    return out


def construct(solutions: DataFrame, depth: int, by: list[str] | None = None) -> DataFrame:
    """The distinct statements that solutions are made of, merged over all sources.

    With ``by`` columns (such as a request id) the statements are kept apart by them.
    """
    hops = [M.TERMS]
    subject = ["o", "o_kind"]
    for hop in range(2, depth + 1):
        hops.append([*subject, *hop_columns(hop)])
        subject = [f"o{hop}", f"o{hop}_kind"]
    statements = [F.struct(*[F.col(c).alias(n) for c, n in zip(hop, M.TERMS)]) for hop in hops]
    return (
        solutions.select(*(by or []), F.inline(F.array(*statements)))
        .filter(F.col("p").isNotNull())
        .distinct()
    )


def reduced(base: DataFrame, data: DataFrame, depth: int, large: bool | None = None) -> list[DataFrame]:
    """The statements of each hop that lie on a full path from ``base``, without any path.

    Forwards, a hop has the statements that start at the nodes reached; backwards from the
    last, those stay whose object a statement of the next hop starts at.  What passes both
    lies on a path through all hops.
    """
    nodes = _object_node(base.filter(_not_literal("o_kind"))).select(*NODE)
    steps = hops(data, nodes, depth - 1)
    for n in range(len(steps) - 2, -1, -1):
        ahead = steps[n + 1].select("source_key", F.col("s_kind").alias("node_kind"), F.col("s").alias("node")).distinct()
        edges = _object_node(steps[n].filter(_not_literal("o_kind")))
        kept = skew_join(edges, broadcast_if_small(stage(ahead, "ahead")), NODE, "left_semi", large=large)
        steps[n] = stage(kept.select(*steps[n + 1].columns), "kept")
    return steps


def construct_all(base: DataFrame, data: DataFrame, depth: int, large: bool | None = None) -> DataFrame:
    """The distinct statements of all solutions of ``base``: ``construct(expand(...))`` of a
    whole answer.

    Solutions are not built, so their number does not matter.  A page cuts solutions, so it
    is constructed from them.
    """
    _check(depth)
    rows = base.select(*M.TERMS)
    for step in reduced(base, data, depth, large) if depth > 1 else []:
        rows = rows.unionByName(step.select(*M.TERMS))
    return rows.distinct()


# What a count needs of a statement.
_EDGE = ["source_key", "s_kind", "s", "o_kind", "o"]


def path_counts(
    data: DataFrame, n: int, start: DataFrame, large: bool | None = None
) -> DataFrame:
    """How many paths of ``n`` statements start at each of the nodes ``start``, without
    building one.

    The nodes of each hop are found forwards, then paths are counted backwards from
    out-degrees; every step is a join to one row per node followed by a sum, so nothing
    grows with the number of paths, or with what the nodes do not reach.
    """
    node = [F.col("source_key"), F.col("s_kind").alias("node_kind"), F.col("s").alias("node")]
    steps = hops(data, start, n, _EDGE, once=True)
    counts = steps[-1].groupBy(*node).agg(F.count(F.lit(1)).alias("paths"))
    for step in steps[-2::-1]:
        edges = step.filter(_not_literal("o_kind")).select(
            "source_key",
            "s_kind",
            "s",
            F.col("o_kind").alias("node_kind"),
            F.col("o").alias("node"),
        )
        counts = (
            skew_join(edges, counts, NODE, "inner", large=large)
            .groupBy(*node)
            .agg(F.sum("paths").alias("paths"))
        )
    return counts


def counts_expansion(pattern: Pattern, depth: int) -> bool:
    """A count leaves the expansion out when the whole pattern is open."""
    return depth > 1 and not pattern.is_open


def solution_counts(
    data: DataFrame, pattern: Pattern, depth: int = 1, large: bool | None = None
) -> DataFrame:
    """Number of solutions per source: ``(source_rank, source_key, solutions)``.

    Counts solutions, not distinct statements, and follows the count rule above.
    """
    _check(depth)
    base = match(data, pattern)
    if not counts_expansion(pattern, depth):
        return base.groupBy(*M.SOURCE).agg(F.count(F.lit(1)).alias("solutions"))
    return expanded_counts(base, data, depth, M.SOURCE, large=large)


def expanded_counts(
    base: DataFrame,
    data: DataFrame,
    depth: int,
    by: list[str],
    large: bool | None = None,
) -> DataFrame:
    """Count the solutions of ``expand(base, data, depth)`` per ``by`` without expanding."""
    if depth == 1:
        return base.groupBy(*by).agg(F.count(F.lit(1)).alias("solutions"))
    # One row per object node; all literals of a source collapse into one row.
    node = F.when(_not_literal("o_kind"), F.col("o"))
    ends = base.groupBy(
        *dict.fromkeys([*by, "source_key"]),
        F.when(_not_literal("o_kind"), F.col("o_kind")).alias("node_kind"),
        node.alias("node"),
    ).agg(F.count(F.lit(1)).alias("_rows"))
    # Read twice: for the nodes, and for the sum.
    ends = stage(ends, "ends")
    counts = path_counts(data, depth - 1, ends.filter(F.col("node").isNotNull()), large)
    solutions = F.col("_rows") * F.coalesce(F.col("paths"), F.lit(1))
    return ends.join(counts, NODE, "left").groupBy(*by).agg(F.sum(solutions).alias("solutions"))


def with_solution_number(
    base: DataFrame, data: DataFrame, depth: int, large: bool | None = None
) -> DataFrame:
    """Adds to every matched statement how many solutions it has, without expanding it."""
    literals = base.filter(~_not_literal("o_kind")).withColumn("solutions", F.lit(1).cast("long"))
    nodes = _object_node(base.filter(_not_literal("o_kind")))
    counts = path_counts(data, depth - 1, nodes, large)
    numbered = skew_join(nodes, counts, NODE, "left", large=large).select(
        *base.columns, F.coalesce(F.col("paths"), F.lit(1)).alias("solutions")
    )
    return literals.unionByName(numbered)

