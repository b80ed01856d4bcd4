"""RDF/XML documents: many documents in parallel, or big files cut by element."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rdfweave import model as M
from rdfweave.operators.scale import broadcast_if_small
from rdfweave.operators.stage import stage
from rdfweave.sources import pieces, rdfxml_events, rdfxml_syntax

#: Statements of a document that are held until it is known to be readable.  A longer one
#: is read through to its end first, and then once more.
HELD_ROWS = 50_000


def _checked(text: str, base: str | None) -> Iterator[list[tuple]]:
    """The statements of a document, none of them before the whole of it is known to be right."""
    found, held, n = rdfxml_events.statements(text, base), [], 0
    for rows in found:
        held.append(rows)
        n += len(rows)
        if n > HELD_ROWS:
            break
    else:
        yield from held
        return
    for _ in found:
        pass
    yield from rdfxml_events.statements(text, base)


def _reader(columns: list[str], body: str, start: str):
    """Rows of the other columns with ``reason`` and the terms of each statement as read."""
    keep = [c for c in columns if c != body]

    def rows_of(batch: pa.RecordBatch, found: list[tuple]) -> pa.RecordBatch:
        place, *read = zip(*found, strict=True)
        own = [batch.column(columns.index(c)).take(pa.array(place, pa.int64())) for c in keep]
        return pa.RecordBatch.from_arrays([*own, *[pa.array(c, pa.string()) for c in read]], names=[*keep, "reason", *M.TERMS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            for i in range(batch.num_rows):
                text, base = (batch.column(columns.index(c))[i].as_py() for c in (body, start))
                try:
                    for rows in _checked(text or "", base):
                        found += [(i, None, *row) for row in rows]
                        if len(found) >= HELD_ROWS:
                            yield rows_of(batch, found)
                            found = []
                except ValueError as error:
                    found.append((i, str(error), *[None] * len(M.TERMS)))
            if found:
                yield rows_of(batch, found)

    return run


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
    the document itself).
    """
    scope = F.col(doc) if scope is None else scope
    start = F.lit(None).cast("string") if base is None else base
    keep = [c for c in docs.columns if c != body]
    placed = pieces.dealt(docs, doc, body).withColumn("_scope", scope.cast("string")).withColumn("_start", start)
    terms = [T.StructField(c, T.StringType()) for c in ("reason", *M.TERMS)]
    schema = T.StructType([f for f in placed.schema.fields if f.name != body] + terms)
    rows = placed.mapInArrow(_reader(placed.columns, body, "_start"), schema)

    def term(value: Column, kind: Column) -> Column:
        own = F.concat(F.lit("."), F.col(doc).cast("string"))
        label = F.concat(
            F.lit("_:s"), "_scope", F.when(value.startswith("-"), own).otherwise(""), F.lit("."), value
        )
        return F.when(kind == M.BNODE, label).otherwise(value)

    return rows.select(
        *keep,
        "reason",
        term(F.col("s"), F.col("s_kind")).alias("s"),
        "s_kind",
        "p",
        term(F.col("o"), F.col("o_kind")).alias("o"),
        "o_kind",
        F.when(F.col("o_datatype") != M.XSD + "string", F.col("o_datatype")).alias("o_datatype"),
        "o_lang",
    )


def parse(
    docs: DataFrame,
    body: str,
    doc: str,
    scope: Column | None = None,
    base: Column | None = None,
) -> DataFrame:
    """The statements that ``read`` finds."""
    return read(docs, body, doc, scope, base).filter(F.col("reason").isNull()).drop("reason")


def rejects(docs: DataFrame, body: str) -> DataFrame:
    """Documents that cannot be read, as quarantine rows with the whole text."""
    keep, at = [c for c in docs.columns if c != body], docs.columns.index(body)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reasons = [rdfxml_events.reason(x or "") for x in batch.column(at).to_pylist()]
            yield batch.append_column("_reason", pa.array(reasons, pa.string()))

    checked = pieces.dealt(docs, *docs.columns).mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_reason", T.StringType())]))
    return checked.filter(F.col("_reason").isNotNull()).select(F.col(body).alias("value"), F.col("_reason").alias("reason"), *keep)


# The start tag of a root that only holds descriptions, in what stands before the first of them.
_ROOT = r"<((?:[A-Za-z_][\w.\-]*:)?RDF)(?:\s[^<]*)?>$"
_TAIL = r"</(?:[A-Za-z_][\w.\-]*:)?RDF\s*>(?:\s|<!--(?:[^-]|-(?!->))*+-->)*$"


def read_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Whole files as documents: ``(doc, file, path, body)``."""
    return pieces.read_documents(spark, paths)


def read_descriptions(spark: SparkSession, paths: str | list[str], size: int = pieces.PIECE_BYTES) -> DataFrame:
    """Files of any size as documents of about ``size``: ``(doc, file, path, body)``.

    Every document holds whole elements between the start and the end of the file's root,
    so that namespaces, entities, base and language hold.  A file whose root is itself a
    description is one document.  Scope blank nodes by ``file``.
    """
    rows = pieces.split(spark, paths, rdfxml_syntax, size)
    head = F.when(F.col("ended"), F.col("text"))
    root = F.regexp_extract(head, _ROOT, 1)
    heads = rows.filter(F.col("pos") < 0).select("path", head.alias("head"), F.when(root != "", root).alias("root"))
    known = pieces.named(rows.join(broadcast_if_small(stage(heads, "heads")), "path", "left"))
    is_head = F.col("pos") < 0
    # What stands behind the last element is the end of the root, and what is wrong with it.
    content = F.when(F.col("ended"), F.col("text")).otherwise(F.regexp_replace("text", _TAIL, ""))
    parts = known.filter(F.col("root").isNotNull() & ~is_head & F.regexp_like(content, F.lit(r"\S"))).select(
        "doc", "file", "path", F.concat("head", content, F.lit("</"), "root", F.lit(">")).alias("body")
    )
    texts = F.sort_array(F.collect_list(F.struct("pos", "part", "text")))
    whole = known.filter(F.col("root").isNull()).groupBy("file", "path").agg(
        F.array_join(F.transform(texts, lambda t: t["text"]), "").alias("body")
    )
    return parts.unionByName(whole.select(F.col("file").alias("doc"), "file", "path", "body"))


def one_by_one(docs: DataFrame, body: str = "body", doc: str = "doc") -> DataFrame:
    """Every element below the root of ``docs`` as a document of its own."""
    return pieces.apart(docs, rdfxml_syntax.one_by_one, body, doc)
