"""Turtle documents as Spark jobs: tokens by one regular expression, structure by columns.

Documents are shuffled once, as texts, and split into tokens where they are read.  What a
token means follows from its neighbours and from what was declared or opened before it; that
is found over the tokens of many documents at once, as are the values of terms
(``turtle_structure``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rdfweave.functions.text import unescape, written_iri
from rdfweave.operators.scale import broadcast_if_small
from rdfweave.operators.stage import stage
from rdfweave.sources import pieces, turtle_structure, turtle_syntax

def _without_dots(iri: Column) -> Column:
    """An address with the ``.`` and ``..`` segments of its path carried out."""
    parts = r"^([A-Za-z][A-Za-z0-9+.\-]*:(?://[^/?#]*)?)(/[^?#]*)([?#].*)?$"
    segments = F.split(F.regexp_extract(iri, parts, 2), "/")
    # The first segment is empty and stands for the root; a last dot leaves a slash.
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, x: F.when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1))))
        .when(x == ".", done)
        .otherwise(F.concat(done, F.array(x))),
    )
    tail = F.when(F.element_at(segments, -1).isin(".", ".."), "/").otherwise("")
    clean = F.concat(
        F.regexp_extract(iri, parts, 1), F.array_join(kept, "/"), tail, F.regexp_extract(iri, parts, 3)
    )
    return F.when(F.regexp_like(iri, F.lit(r"^[A-Za-z][A-Za-z0-9+.\-]*:(?://[^/?#]*)?/(?:[^?#]*/)?\.\.?(?:[/?#]|$)")), clean).otherwise(iri)


def resolve_iri(iri: Column, base: Column) -> Column:
    """``iri`` against ``base``: absolute, ``//host``, ``/path``, ``#part``, ``?query``, relative."""
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*:(?://[^/?#]*)?)", 1)
    path = F.substring(F.regexp_replace(base, "[?#].*$", ""), F.length(origin) + 1, F.length(base))
    # A host without a path has the root for its folder.
    root = F.when((path == "") & F.contains(origin, F.lit("//")), "/").otherwise("")
    folder = F.concat(origin, root, F.regexp_replace(path, "[^/]*$", ""))
    return (
        F.when(base.isNull() | F.regexp_like(iri, F.lit(r"^[A-Za-z][A-Za-z0-9+.\-]*:")), iri)
        .when(iri == "", F.substring_index(base, "#", 1))
        .when(iri.startswith("//"), F.concat(F.substring_index(base, ":", 1), F.lit(":"), iri))
        .when(iri.startswith("/"), _without_dots(F.concat(origin, iri)))
        .when(iri.startswith("#"), F.concat(F.substring_index(base, "#", 1), iri))
        .when(iri.startswith("?"), F.concat(F.regexp_replace(base, "[?#].*$", ""), iri))
        .otherwise(_without_dots(F.concat(folder, iri)))
    )


def _read(docs: DataFrame, body: str, doc: str, scope: Column | None, base: Column | None, only_wrong: bool) -> DataFrame:
    """``turtle_structure.reader`` over documents, which are shuffled once as texts."""
    given = {"_scope": F.col(doc) if scope is None else scope, "_doc": F.col(doc), "_start": F.lit(None) if base is None else base}
    keep = [c for c in docs.columns if c != body or only_wrong]
    # A number of partitions is given so that they are not merged by text size: the
    # rows made from a text are many times larger.
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.repartition(partitions, F.col(doc)).select(
        *keep, F.col(body).alias("_body"), *[value.cast("string").alias(name) for name, value in given.items()]
    )
    written = [] if only_wrong else turtle_structure.TERMS
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(c, T.StringType()) for c in ("reason", *written)])
    return texts.mapInArrow(turtle_structure.reader(keep, only_wrong), schema)


def read(
    docs: DataFrame,
    body: str,
    doc: str,
    scope: Column | None = None,
    base: Column | None = None,
) -> DataFrame:
    """Statements of all readable documents, and one row with a ``reason`` for each other one.

    Other columns of ``docs`` are kept.  ``doc`` names a unique key column fit for
    blank-node labels.  Labels written in a document are scoped by ``scope`` (default:
    the document itself).  A document has statements or a reason, never both.
    """
    return _read(docs, body, doc, scope, base, only_wrong=False)


def parse(
    docs: DataFrame,
    body: str,
    doc: str,
    scope: Column | None = None,
    base: Column | None = None,
) -> DataFrame:
    """The statements that ``read`` finds."""
    return read(docs, body, doc, scope, base).filter(F.col("reason").isNull()).drop("reason")


def rejects(docs: DataFrame, body: str, doc: str, base: Column | None = None) -> DataFrame:
    """Documents that cannot be read, as quarantine rows with the whole text."""
    wrong = _read(docs.filter(F.col(doc).isNotNull()), body, doc, None, base, only_wrong=True)
    return wrong.select(F.col(body).alias("value"), "reason", *[c for c in docs.columns if c != body])


_DECLARED = pa.schema(
    [
        ("path", pa.string()), ("pos", pa.int64()), ("part", pa.int32()), ("names", pa.list_(pa.string())),
        ("directives", pa.list_(pa.struct([("place", pa.int64()), ("name", pa.string()), ("iri", pa.string())]))),
    ]
)
_DECLARED_SQL = "path string, pos long, part int, names array<string>, directives array<struct<place:long,name:string,iri:string>>"


def _declared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        found = [[dict(zip(("place", "name", "iri"), d, strict=True)) for d in turtle_syntax.directives(x)] for x in texts]
        names = pa.array([turtle_syntax.names(x) for x in texts], pa.list_(pa.string()))
        columns = [*[batch.column(c) for c in ("path", "pos", "part")], names, pa.array(found, _DECLARED.field("directives").type)]
        yield pa.RecordBatch.from_arrays(columns, schema=_DECLARED)


def _absolute(directives: DataFrame) -> DataFrame:
    """Directives ``(path, at, name, iri)`` with absolute addresses; the base has no name."""
    order = Window.partitionBy("path").orderBy("at")
    iri, is_base = unescape(F.col("iri")), F.col("name") == ""
    absolute = F.regexp_like(iri, F.lit(r"^[A-Za-z][A-Za-z0-9+.\-]*:"))
    # A relative base rests on those before it, back to the last absolute one.
    rows = directives.withColumn("iri", iri).withColumn("run", F.count(F.when(is_base & absolute, 1)).over(order))
    chain = F.collect_list(F.when(is_base, F.col("iri"))).over(Window.partitionBy("path", "run").orderBy("at"))
    base = F.aggregate(chain, F.col("path"), lambda base, x: resolve_iri(x, base))
    return rows.withColumn("base", base).select(
        "path", "at", "name", F.when(is_base, F.col("base")).otherwise(resolve_iri(F.col("iri"), F.col("base"))).alias("iri")
    )


def _heads(found: DataFrame) -> DataFrame:
    """(path, pos, part, head): the directives in force where each text begins.

    Only the names that a text may use are looked up, each by the last declaration before it.
    """
    at = ["pos", "part", "place"]
    declared = found.select("path", "pos", "part", F.explode("directives").alias("d")).select(
        "path", F.struct("pos", "part", F.col("d.place").alias("place")).alias("at"), F.col("d.name").alias("name"), F.col("d.iri").alias("iri")
    )
    declared = stage(_absolute(declared), "directives")
    known = declared.select("path", "name").distinct()
    used = found.select("path", "pos", "part", F.explode(F.array_append("names", F.lit(""))).alias("name")).join(
        broadcast_if_small(known), ["path", "name"], "left_semi"
    )
    used = used.select("path", F.struct("pos", "part", F.lit(-1).cast("long").alias("place")).alias("at"), "name", F.lit(None).cast("string").alias("iri"))
    before = Window.partitionBy("path", "name").orderBy("at")
    rows = declared.unionByName(used).withColumn("iri", F.last("iri", ignorenulls=True).over(before))
    line = F.when(F.col("name") == "", F.concat(F.lit("@base "), written_iri(F.col("iri")))).otherwise(
        F.concat(F.lit("@prefix "), "name", F.lit(" "), written_iri(F.col("iri")))
    )
    lines = rows.filter((F.col("at.place") < 0) & F.col("iri").isNotNull()).groupBy("path", *[F.col(f"at.{c}").alias(c) for c in at[:2]]).agg(
        F.sort_array(F.collect_list(F.concat(line, F.lit(" .\n")))).alias("lines")
    )
    return lines.select("path", "pos", "part", F.array_join("lines", "").alias("head"))


def read_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Whole files as documents: ``(doc, file, path, body)``."""
    return pieces.read_documents(spark, paths)


def read_statements(spark: SparkSession, paths: str | list[str], size: int = pieces.PIECE_BYTES) -> DataFrame:
    """Files of any size and style as documents of about ``size``: ``(doc, file, path, body)``.

    Every document holds whole statements behind the directives in force there, wherever
    the file declares them.  Scope blank nodes by ``file``.
    """
    rows = pieces.split(spark, paths, turtle_syntax, size)
    found = stage(rows.select("path", "pos", "part", "text").mapInArrow(_declared, _DECLARED_SQL), "declared")
    heads = broadcast_if_small(stage(_heads(found), "heads"))
    docs = pieces.named(rows.join(heads, ["path", "pos", "part"], "left"))
    return docs.select("doc", "file", "path", F.concat(F.coalesce("head", F.lit("")), "text").alias("body"))


def one_by_one(docs: DataFrame, body: str = "body", doc: str = "doc") -> DataFrame:
    """Every statement of ``docs`` as a document with the directives that it stands behind."""
    return pieces.apart(docs, turtle_syntax.one_by_one, body, doc)
