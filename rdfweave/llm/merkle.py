"""A Merkle manifest: leaves per document, a tree per source, one root over all sources.

Children of a parent are spread into one column for each of its slots by conditional
aggregates.  The columns together are what the parent hashes; without the own slot's
column they are the siblings that a proof needs.  Trees are built by blocks of a few
levels: a block is a bounded group of rows, so every level of it is computed where its
rows already lie, and a source of any size is many blocks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rdfweave.llm import common
from rdfweave.llm.order import numbered
from rdfweave.llm.twins import crc32_sql

FANOUT = 3
#: Levels of a block: it holds FANOUT ** LEVELS nodes of its lowest level.
LEVELS = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the count of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: str = "text") -> Column:
    return digest(F.concat(*[encoded(F.col(text if c == "text" else c)) for c in FIELDS]))


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(g, doc_id, source, leaf, seen): ``seen`` is the leaf of the tampered text.

    ``g`` is the encoded source, so that null is a group of its own.
    """
    rows = common.only(docs, *FIELDS)
    rows = rows.withColumn("_text", F.col("text") if tampered is None else tampered)
    own = leaf()
    seen = F.when(F.col("_text").eqNullSafe(F.col("text")), F.col("leaf")).otherwise(leaf("_text"))
    return rows.withColumn("leaf", own).select(encoded(F.col("source")).alias("g"), "doc_id", F.col("source").cast("string").alias("source"), "leaf", seen.alias("seen"))


def slots(h: str, place: Column, fanout: int) -> list[Column]:
    """One conditional aggregate for each slot below a parent."""
    return [F.max(F.when(place % fanout == j, F.col(h))) for j in range(fanout)]


def joined(columns: list[Column]) -> Column:
    return F.concat(F.lit(""), *[F.coalesce(c, F.lit("")) for c in columns])


def dealt(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Nodes with their ``block``, those of one block in one partition."""
    size = fanout**levels
    return nodes.withColumn("block", F.expr(f"i div {size}")).repartition("g", "block")


def climbed(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(g, i, n, h): the nodes that are left of (g, i, n, h) some levels up.

    ``n`` is the number of nodes of a tree on the level; a tree of one node is done.
    """
    rows = dealt(nodes.select("g", "i", "n", "h"), fanout, levels)
    for _ in range(levels):
        pivot = rows.groupBy("g", "block", F.expr(f"i div {fanout}").alias("parent"), "n").agg(
            *[c.alias(f"s{j}") for j, c in enumerate(slots("h", F.col("i"), fanout))]
        )
        made = F.when(F.col("n") > 1, digest(joined([F.col(f"s{j}") for j in range(fanout)]))).otherwise(F.col("s0"))
        rows = pivot.select(
            "g", "block", F.col("parent").alias("i"), F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"), made.alias("h")
        )
    return rows.select("g", "i", "n", "h")


def steps(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Nodes with ``block`` and ``path``: the siblings on each level up to the block's top.

    A step holds the siblings to the left and to the right, each joined.
    """
    rows = dealt(nodes, fanout, levels).withColumns({"_h": F.col("h"), "_k": F.col("i"), "_n": F.col("n")})
    found = []
    for level in range(levels):
        parent = F.expr(f"_k div {fanout}")
        rows = rows.withColumn("_parent", parent)
        siblings = Window.partitionBy("g", "block", "_parent")
        columns = [F.col(f"_s{j}") for j in range(fanout)]
        rows = rows.withColumns({f"_s{j}": c.over(siblings) for j, c in enumerate(slots("_h", F.col("_k"), fanout))})
        own = F.col("_k") % fanout
        step = reduce(
            lambda c, j: c.when(own == j, F.struct(joined(columns[:j]).alias("left"), joined(columns[j + 1 :]).alias("right"))),
            range(1, fanout),
            F.when(own == 0, F.struct(F.lit("").alias("left"), joined(columns[1:]).alias("right"))),
        )
        more = F.col("_n") > 1
        found.append(f"_step{level}")
        rows = rows.withColumns(
            {
                found[-1]: F.when(more, step),
                "_h": F.when(more, digest(joined(columns))).otherwise(F.col("_h")),
                "_n": F.expr(f"(_n + {fanout - 1}) div {fanout}"),
                "_k": F.col("_parent"),
            }
        ).drop(*[f"_s{j}" for j in range(fanout)], "_parent")
    path = F.filter(F.array(*found), lambda s: s.isNotNull())
    return rows.withColumn("path", path).drop(*found, "_h", "_k", "_n")


def tiers(nodes: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> list[DataFrame]:
    """The staged nodes (g, i, n, h), and what is left of them every few levels up.

    The last tier has one node for each tree.
    """
    most, out = nodes.agg(F.max("n")).first()[0] or 1, [nodes]
    while most > 1:
        out.append(common.stage(climbed(out[-1], fanout, levels), "nodes"))
        most = -(-most // fanout**levels)
    return out


def proved(below: list[DataFrame], top: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """The nodes of the lowest tier with the ``path`` to the end of ``top``'s path.

    ``top`` has one row per tree: (g, path) and columns that every node of the tree gets.
    """
    carried = [c for c in top.columns if c not in ("g", "i", "path")]
    upper = top.withColumn("i", F.lit(0).cast("long"))
    if len(below) == 1:
        return below[0].join(upper.drop("i"), "g")
    for n, tier in reversed(list(enumerate(below[:-1]))):
        own = steps(tier, fanout, levels)
        above = upper.select("g", F.col("i").alias("block"), F.col("path").alias("_above"), *carried)
        upper = own.join(above, ["g", "block"]).withColumn("path", F.concat("path", "_above")).drop("_above", "block")
        if n:
            upper = common.stage(upper.select("g", "i", "path", *carried), "paths")
    return upper


def siblings(path: str = "path") -> Column:
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def folded(start: Column, path: str = "path") -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(F.col(path), start, lambda h, s: digest(F.concat(s["left"], h, s["right"])))


def manifest(docs: DataFrame, tampered: Column | None = None, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """(doc_id, source, leaf, subroot, root, path, seen) of every row of ``docs``.

    ``seen`` is the leaf of the text that ``tampered`` gives, by default the text itself;
    ``path`` holds the siblings from the leaf to the root.  A null value in any field is
    written as ``-``; rows without a source form a tree of their own, the first; rows
    without a doc_id come first in theirs; rows with one doc_id are ordered by their
    leaves; repeated rows are leaves each.  An empty table gives an empty result.  Columns
    other than the five fields are not read.
    """
    found = common.stage(leaves(docs, tampered), "leaves")
    # Columns are short here, so the texts are read and hashed once.
    places = numbered(found, ["g"], ["doc_id", "leaf"])
    trees = tiers(common.stage(places.withColumnRenamed("leaf", "h"), "tree"), fanout, levels)
    roots = trees[-1].select(F.col("g").alias("key"), F.col("h").alias("subroot"))
    sources = found.select(F.col("g").alias("key"), "source").distinct()
    ordered = numbered(roots.join(sources, "key"), [], ["source"])
    forest = tiers(common.stage(ordered.withColumnRenamed("subroot", "h").withColumn("g", F.lit("")), "roots"), fanout, levels)
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    root = forest[-1].select("g", nothing.alias("path"), F.col("h").alias("root"))
    tops = proved(forest, root, fanout, levels).select(F.col("key").alias("g"), F.col("h").alias("subroot"), "path", "root")
    return proved(trees, common.stage(tops, "tops"), fanout, levels).select(
        "doc_id", "source", F.col("h").alias("leaf"), "subroot", "root", "path", "seen"
    )


def proofs(rows: DataFrame) -> DataFrame:
    """The manifest's rows with the digest of each path, the root that the seen leaf gives,
    and whether it is the manifest's."""
    return rows.withColumn("proof_sha256", digest(siblings())).withColumn("folded_root", folded(F.col("seen"))).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )


def op13_slot_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = manifest(common.table(spark, sf_dir, "documents"), tampered)
    return proofs(rows).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


OP13_SQL = f"""
WITH RECURSIVE crc_of AS (
  SELECT DISTINCT doc_id::VARCHAR AS v FROM documents WHERE doc_id IS NOT NULL
), {crc32_sql("crc").strip()}, field AS (
  SELECT doc_id, source, text,
    CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS seen_text,
    coalesce(length(doc_id::VARCHAR) || ':' || doc_id, '-')
      || coalesce(octet_length(encode(source)) || ':' || source, '-')
      || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
      || coalesce(length(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
  FROM documents LEFT JOIN crc ON v = doc_id::VARCHAR
), leaf AS (
  SELECT doc_id, source,
    sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(octet_length(encode(seen_text)) || ':' || seen_text, '-')) AS seen
  FROM field
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM leaf
), node AS (
  SELECT source, 0 AS level, i, n, leaf AS h FROM placed
  UNION ALL
  SELECT source, level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM node WHERE n > 1 GROUP BY source, level, i // 3, n
), subroot AS (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM node WHERE n = 1
), top AS (
  SELECT 0 AS level, i, n, subroot AS h FROM subroot
  UNION ALL
  SELECT level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, i // 3, n
), walk AS (
  SELECT doc_id, source, leaf, seen, 0 AS level, i, n, '' AS proof, seen AS fold FROM placed
  UNION ALL
  SELECT w.doc_id, w.source, w.leaf, w.seen, w.level + 1, w.i // 3, (w.n + 2) // 3,
    w.proof || coalesce(string_agg(x.h, '' ORDER BY x.i) FILTER (x.i <> w.i), ''),
    sha256(string_agg(CASE WHEN x.i = w.i THEN w.fold ELSE x.h END, '' ORDER BY x.i))
  FROM walk w JOIN node x ON x.source IS NOT DISTINCT FROM w.source AND x.level = w.level AND x.i // 3 = w.i // 3
  WHERE w.n > 1 GROUP BY w.doc_id, w.source, w.leaf, w.seen, w.level, w.i, w.n, w.proof, w.fold
), climb AS (
  SELECT doc_id, leaf, subroot, 0 AS level, s.i, s.n, proof, fold FROM walk w JOIN subroot s ON s.source IS NOT DISTINCT FROM w.source WHERE w.n = 1
  UNION ALL
  SELECT c.doc_id, c.leaf, c.subroot, c.level + 1, c.i // 3, (c.n + 2) // 3,
    c.proof || coalesce(string_agg(x.h, '' ORDER BY x.i) FILTER (x.i <> c.i), ''),
    sha256(string_agg(CASE WHEN x.i = c.i THEN c.fold ELSE x.h END, '' ORDER BY x.i))
  FROM climb c JOIN top x ON x.level = c.level AND x.i // 3 = c.i // 3
  WHERE c.n > 1 GROUP BY c.doc_id, c.leaf, c.subroot, c.level, c.i, c.n, c.proof, c.fold
)
SELECT c.doc_id, leaf, subroot, t.h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = t.h AS verified
FROM climb c, (SELECT h FROM top WHERE n = 1) t WHERE c.n = 1
"""
