"""Load configured file sources into the store."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rdfweave import model as M
from rdfweave.operators.scale import broadcast_if_small
from rdfweave.operators.stage import scope, stage
from rdfweave.sources import catalog, ntriples, pieces, rdfxml, store, turtle

GRAPH_BASE = "urn:rdfweave:graph:"
#: How a file is written, where the catalog's ``format`` column says nothing.
FORMATS = {"turtle": "turtle", "rdf": "rdfxml"}
LINES = "ntriples"
_LINE_NAMES = r"(?i)\.nt(?:\.(?:gz|bz2|zst|zstd|lz4|snappy))?$"


def graph_name(source_id: int, base: str = GRAPH_BASE) -> str:
    return f"{base}{source_id}"


def formats(sources: DataFrame) -> Column:
    """Format of each source: its ``format``, or one that its name or its type tells."""
    own = F.col("format") if "format" in sources.columns else F.lit(None).cast("string")
    by_type = F.element_at(F.create_map(*[F.lit(x) for pair in FORMATS.items() for x in pair]), F.col("type"))
    by_name = F.when((F.col("type") == "turtle") & F.regexp_like("uri", F.lit(_LINE_NAMES)), LINES)
    return F.coalesce(own, by_name, by_type)


def _files(spark: SparkSession, paths: dict[int, str]) -> list[tuple[list[str], list[tuple[str, int]]]]:
    """Scans of (paths, [(file, source_id)]): each file lies in one path of a scan.

    One scan holds all sources but those that name a file which another one names, too.
    """
    scans: list[tuple[list[str], dict[str, list[int]]]] = []
    same: dict[str, list[int]] = {}
    for source_id, path in sorted(paths.items()):
        same.setdefault(path, []).append(source_id)
    for path, ids in same.items():
        # Scans name a file of the default file system with one slash.
        files = [re.sub(r"^(\w+):///", r"\1:/", f) for f in spark.read.text(path).inputFiles()]
        scan = next((s for s in scans if not any(f in s[1] for f in files)), None)
        if scan is None:
            scans.append(scan := ([], {}))
        scan[0].append(path)
        scan[1].update({f: ids for f in files})
    return [(listed, [(f, i) for f, ids in files.items() for i in ids]) for listed, files in scans]


def _read_format(
    spark: SparkSession, kind: str, paths: dict[int, str], whole: bool, size: int = pieces.PIECE_BYTES
) -> tuple[DataFrame, DataFrame]:
    """Statements and quarantine rows of all sources of one format, each with ``source_id``.

    The files are read once and parsed once for both, and what was found is staged; which
    source a row belongs to follows from its file.
    """

    def scan(listed: list[str], files: list[tuple[str, int]]) -> DataFrame:
        if kind == LINES:
            rows = ntriples.read_lines(spark, listed, with_path=True)
        elif whole:
            rows = pieces.read_documents(spark, listed)
        elif kind == "turtle":
            rows = turtle.read_statements(spark, listed, size)
        else:
            rows = rdfxml.read_descriptions(spark, listed, size)
        sources = stage(spark.createDataFrame(files, "path string, source_id int"), "files")
        return rows.join(broadcast_if_small(sources), "path")

    docs = reduce(DataFrame.unionByName, [scan(*s) for s in _files(spark, paths)])
    scope = F.concat_ws(".", F.col("source_id").cast("string"), "file")
    if kind == LINES:
        lines = stage(ntriples.read(docs, scope).select(*M.TERMS, "value", "reason", "source_id"), "read")
        return lines.filter(F.col("reason").isNull()), lines.filter(F.col("reason").isNotNull())
    docs = stage(docs, "documents")
    # Two sources may name the same file.
    docs = docs.withColumn("doc", F.concat_ws(".", F.col("source_id").cast("string"), "doc"))
    reader = turtle if kind == "turtle" else rdfxml

    def parsed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
        read = stage(reader.read(docs, "body", "doc", scope=scope, base=F.col("path")), "read")
        return read.filter(F.col("reason").isNull()), pieces.reasons(read, docs, "body", "doc")

    good, bad = parsed(docs)
    if whole or bad.isEmpty():
        return good, bad
    # One bad statement does not take those beside it along.
    again = bad.withColumnRenamed("value", "body").drop("reason")
    more, bad = parsed(stage(reader.one_by_one(again), "statements"))
    return good.unionByName(more), bad


def read_sources(
    spark: SparkSession, sources: DataFrame, base: str = GRAPH_BASE, whole: bool = False, size: int = pieces.PIECE_BYTES
) -> tuple[DataFrame, DataFrame, list[int]]:
    """Statements, quarantine rows and ids of all file sources of a resolved catalog.

    A ``uri`` may be a file, a folder or a pattern; relative addresses in a file are
    resolved against the file's own path.  The ``format`` of a source is ``turtle``,
    ``rdfxml`` or ``ntriples``.  Files are cut into documents of about ``size`` that many
    tasks read; ``whole`` makes every file one document.
    """
    listed = sources.filter(catalog.is_loaded(F.col("type")))
    # The catalog is edited by hand: one row per source comes to the driver.
    rows = listed.select("id", "type", "uri", formats(listed).alias("format")).orderBy("id").collect()
    unknown = sorted({r["format"] for r in rows} - {*FORMATS.values(), LINES})
    if unknown:
        raise ValueError(f"formats that cannot be read: {unknown}")
    good, bad = [], []
    for kind in sorted({r["format"] for r in rows}):
        found, wrong = _read_format(spark, kind, {r["id"]: r["uri"] for r in rows if r["format"] == kind}, whole, size)
        good.append(found.select(*M.TERMS, "source_id"))
        bad.append(wrong.select("value", "reason", "source_id"))
    if not rows:
        empty = spark.createDataFrame([], M.STATEMENTS_SCHEMA)
        return empty, spark.createDataFrame([], ntriples.QUARANTINE_SCHEMA), []
    ids = [r["id"] for r in rows]
    types = spark.createDataFrame([(r["id"], r["type"]) for r in rows], "source_id int, source_type string")
    statements = reduce(DataFrame.unionByName, good).join(broadcast_if_small(stage(types, "types")), "source_id").select(
        *M.TERMS,
        F.concat(F.lit(base), F.col("source_id").cast("string")).alias("graph"),
        "source_id",
        "source_type",
    )
    return statements, reduce(DataFrame.unionByName, bad), ids


def read_source(
    spark: SparkSession,
    source_id: int,
    source_type: str,
    uri: str,
    base: str = GRAPH_BASE,
    whole: bool = False,
    size: int = pieces.PIECE_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Statements and quarantine rows of one source."""
    if source_type not in FORMATS:
        raise ValueError(f"{source_type} sources are not loaded")
    source = spark.createDataFrame([(source_id, source_type, uri)], "id int, type string, uri string")
    return read_sources(spark, source, base, whole, size)[:2]


def load(
    spark: SparkSession,
    sources: DataFrame,
    store_path: str,
    quarantine_path: str,
    base: str = GRAPH_BASE,
    whole: bool = False,
) -> list[str]:
    """Replace the graphs of all file sources of a resolved catalog; returns their names.

    The catalog has one row per source; endpoints and fragment servers are skipped.
    Bad statements and documents take the place of the sources' rows in the quarantine table.
    """
    with scope(spark):
        statements, rejects, ids = read_sources(spark, sources, base, whole)
        graphs = [graph_name(i, base) for i in ids]
        if ids:
            store.replace(statements, store_path, graphs, staged=True)
            store.quarantine(rejects, quarantine_path, ids)
    return graphs
