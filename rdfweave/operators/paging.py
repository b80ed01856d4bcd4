"""One deterministic order over all solutions, and pages cut from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rdfweave import model as M
from rdfweave.operators.expand import expand, path_columns, with_solution_number
from rdfweave.operators.scale import estimated_bytes
from rdfweave.operators.stage import stage

# Fixed value: page size when a request names none.
PAGE_SIZE = 100
# In a plain top-k every task sends a whole page to the last one; this many rows are
# no burden to it.
LAST_TASK_ROWS = 2_000_000
TASK_BYTES = 128 * 1024 * 1024
# Up to here the matched statements of an expanded page are found by their own order.
FIRST_ROWS = 10_000
# Split keys per narrowing pass over a deep page, and rows drawn to find them.
SPLITS = 16
DRAWN_ROWS = 4096


def order_columns(depth: int = 1) -> list[str]:
    return [*M.SOURCE, *M.TERMS, *path_columns(depth)]


def _order(columns: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns]


def page(
    solutions: DataFrame,
    limit: int = PAGE_SIZE,
    offset: int = 0,
    depth: int = 1,
    last_rows: int = LAST_TASK_ROWS,
    tasks: int | None = None,
) -> DataFrame:
    """Rows ``offset .. offset + limit`` of all solutions, sources in their order.

    The order is total: source, then every term and path column, nulls first.
    A page is a top-k where that is cheap: not too many rows times ``tasks`` (by
    default estimated from the input size).  Otherwise the solutions are first
    narrowed, by counting, to a short key range that holds the page.
    """
    columns = order_columns(depth)
    tasks = 1 + estimated_bytes(solutions) // TASK_BYTES if tasks is None else tasks
    if (offset + limit) * tasks > last_rows:
        solutions, offset = _narrow(solutions, columns, offset, limit, last_rows)
    return solutions.orderBy(*_order(columns)).offset(offset).limit(limit)


def _key(columns: list[str], row=None, schema=None) -> Column:
    """The order key of a row, or of the fixed ``row``, as one comparable struct.

    A null sorts before every value, as it does in the page order.
    """

    def part(c: str) -> Column:
        return F.col(c) if row is None else F.lit(row[c]).cast(schema[c].dataType)

    return F.struct(
        *[x for c in columns for x in (part(c).isNotNull().alias(f"{c}_set"), part(c).alias(c))]
    )


def _between(df: DataFrame, columns: list[str], low, high) -> DataFrame:
    """Rows from key ``low`` up to, not including, key ``high``."""
    if low is not None and high is not None and low["source_key"] == high["source_key"]:
        # Plain comparisons on leading columns reach the scan; the exact test follows.
        df = df.filter(
            (F.col("source_key") == low["source_key"]) & F.col("s").between(low["s"], high["s"])
        )
    if low is not None:
        df = df.filter(_key(columns) >= _key(columns, low, df.schema))
    if high is not None:
        df = df.filter(_key(columns) < _key(columns, high, df.schema))
    return df


def _narrow(
    solutions: DataFrame,
    columns: list[str],
    offset: int,
    limit: int,
    last_rows: int,
    weight: Column | None = None,
) -> tuple[DataFrame, int]:
    """Cut ``solutions`` to a key range that still holds the whole page.

    With ``weight`` every row stands for that many rows of the page.

    Every pass draws a few split keys, counts the rows below each of them in one
    aggregation and keeps the ranges that overlap the page.  The draw only decides
    how even the ranges are, never what is in the page.  Keys are compared on the
    leading columns first and on more of them when one subject fills the range.
    """
    weight = F.lit(1) if weight is None else weight
    rows = solutions.agg(F.sum(weight)).first()[0] or 0
    if offset >= rows:
        return solutions.limit(0), 0
    used = len(M.SOURCE) + 1
    while rows > max(last_rows, 2 * limit):
        prefix = columns[:used]
        keys = _split_keys(solutions, prefix, rows)
        below = _rows_below(solutions, prefix, keys, weight)
        low = max((i for i, n in enumerate(below) if 0 < n <= offset), default=None)
        high = min((i for i, n in enumerate(below) if offset + limit <= n < rows), default=None)
        if low is None and high is None:
            if used == len(columns):
                break
            used = min(len(columns), used + len(M.TERMS))
            continue
        start = 0 if low is None else below[low]
        end = rows if high is None else below[high]
        solutions = _between(
            solutions,
            prefix,
            None if low is None else keys[low],
            None if high is None else keys[high],
        )
        offset, rows = offset - start, end - start
    return solutions, offset


def _rows_below(
    solutions: DataFrame, columns: list[str], keys: list, weight: Column
) -> list[int]:
    if not keys:
        return []
    here = _key(columns)
    counters = [
        F.sum(F.when(here < _key(columns, key, solutions.schema), weight)).alias(f"c{i}")
        for i, key in enumerate(keys)
    ]
    return [n or 0 for n in solutions.agg(*counters).first()]


def _split_keys(solutions: DataFrame, columns: list[str], rows: int) -> list:
    share = min(1.0, DRAWN_ROWS / max(rows, 1))
    drawn = solutions.select(*columns).sample(share, seed=1).limit(2 * DRAWN_ROWS)
    ranked = drawn.orderBy(*_order(columns)).collect()
    picked = ranked[:: max(1, len(ranked) // SPLITS)]
    return [key for i, key in enumerate(picked) if i == 0 or key != picked[i - 1]]


def expanded_page(
    base: DataFrame,
    data: DataFrame,
    depth: int,
    limit: int = PAGE_SIZE,
    offset: int = 0,
    first_rows: int = FIRST_ROWS,
    last_rows: int = LAST_TASK_ROWS,
) -> DataFrame:
    """A page of ``expand(base, data, depth)`` without expanding what lies outside it.

    Solutions sort by their matched statement first, and every matched statement has at
    least one.  So a page near the start lies within the first ``offset + limit``
    matched statements.  For a deep page the matched statements are numbered with their
    solutions and narrowed to those the page falls on.  Only these are expanded.
    """
    if depth == 1:
        return page(base, limit, offset, last_rows=last_rows)
    if offset + limit <= first_rows:
        first = page(base, offset + limit, 0, last_rows=last_rows)
    else:
        numbered = stage(with_solution_number(base, data, depth), "numbered")
        first, offset = _narrow(
            numbered, order_columns(), offset, limit, last_rows, F.col("solutions")
        )
        first = first.drop("solutions")
    first = stage(first, "page")
    tasks = int(data.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return page(expand(first, data, depth), limit, offset, depth, last_rows, tasks)


def page_per_group(
    rows: DataFrame,
    group: list[str],
    order: list[str],
    limit: int = PAGE_SIZE,
    offset: int = 0,
    slices: int = 64,
) -> DataFrame:
    """Rows ``offset .. offset + limit`` of every group.

    Short pages rely on Spark cutting each group to its first rows before the
    shuffle.  For longer ones each group is first ranked in slices, so that one
    huge group is never sorted by a single task, and only the first
    ``offset + limit`` rows of each slice go on to the final ranking.
    """
    last = offset + limit
    window = Window.partitionBy(*group).orderBy(*_order(order))
    if last > 1000:
        sliced = rows.withColumn("_slice", F.pmod(F.xxhash64(*order), F.lit(slices)))
        per_slice = Window.partitionBy(*group, "_slice").orderBy(*_order(order))
        rows = (
            sliced.withColumn("_rank", F.row_number().over(per_slice))
            .filter(F.col("_rank") <= last)
            .drop("_slice", "_rank")
        )
    return (
        rows.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") <= last)
        .filter(F.col("_rank") > offset)
        .drop("_rank")
    )
