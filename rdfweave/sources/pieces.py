"""Files cut into pieces that many tasks can read, whatever stands on a line.

A file is read by line and its lines are taken together to pieces of about 1 MB.  What a
piece means depends on what was open before it: a literal, a comment, brackets, elements.
A syntax says for every such state what a piece turns it into, and by how much it changes
the nesting.  These tables are composed along a file, first inside each block of the scan,
then over the blocks, so that every piece is known to begin in one state without any task
reading the file from its start.  Then each piece is cut at the ends of its statements, and
only statements that run over the edge of a piece are put together from their parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rdfweave.operators.scale import broadcast_if_small
from rdfweave.operators.stage import stage

PIECE_BYTES = 1 << 20
#: A statement longer than this does not fit one cell; its parts are set aside.
STATEMENT_BYTES = 1 << 30
#: Parts of a piece: what ends in it but began before, what lies in it, what begins in it.
HEAD, BODY, TAIL = 0, 1, 2


class Syntax(Protocol):
    """What a format says of pieces; states are numbered from 0, the one that a file begins in."""

    states: int

    def passes(self, text: str) -> list[tuple[int, int]]:
        """For each state before a piece: the state behind it, and the change of depth."""

    def ends(self, text: str, state: int, depth: int) -> list[int]:
        """Where statements end; 0 is among them if one ended right before the piece."""


def read_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Whole files as documents: ``(doc, file, path, body)``; ``doc`` and ``file`` are equal."""
    path = F.col("_metadata.file_path")
    return spark.read.text(paths, wholetext=True).select(
        F.sha1(path).alias("doc"), F.sha1(path).alias("file"), path.alias("path"), F.col("value").alias("body")
    )


def dealt(docs: DataFrame, *by: str) -> DataFrame:
    """Documents dealt to as many tasks as a shuffle has.

    Texts may be made from small rows, thousands of which are one task of a scan.
    """
    return docs.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


_BLOCKS = pa.schema(
    [
        ("path", pa.string()), ("block", pa.int64()), ("pos", pa.int64()), ("text", pa.string()),
        ("states", pa.list_(pa.int32())), ("depths", pa.list_(pa.int64())),
    ]
)
_BLOCKS_SQL = "path string, block long, pos long, text string, states array<int>, depths array<long>"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[str]]]:
    """Lines in their order, those of one block of one file together."""
    for batch in batches:
        if not batch.num_rows:
            continue
        path, block = batch.column("path"), batch.column("block").to_numpy()
        codes = path.dictionary_encode().indices.to_numpy()
        edges = np.flatnonzero((np.diff(codes) != 0) | (np.diff(block) != 0)) + 1
        for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            yield (path[int(a)].as_py(), int(block[a])), batch.column("value").slice(a, b - a).to_pylist()


def _blocks(syntax: Syntax, size: int):
    """Pieces with the composed table of all that stands before them in their block.

    The last row of a block has no text: its table is that of the whole block.
    """

    def row(key, pos, text, table) -> pa.RecordBatch:
        values = (key[0], key[1], pos, text, [s for s, _ in table], [d for _, d in table])
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _BLOCKS, strict=True)], schema=_BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, length, pos, table = None, [], 0, 0, []

        def piece() -> pa.RecordBatch:
            nonlocal held, length, pos, table
            text = "\n".join(held) + "\n"
            out = row(key, pos, text, table)
            steps = syntax.passes(text)
            table = [(steps[s][0], d + steps[s][1]) for s, d in table]
            held, length, pos = [], 0, pos + length
            return out

        for at, lines in _runs(batches):
            if at != key:
                if key:
                    if held:
                        yield piece()
                    yield row(key, pos, None, table)
                key, pos, table = at, at[1], [(s, 0) for s in range(syntax.states)]
            for line in lines:
                held.append(line)
                length += len(line) + 1
                if length >= size:
                    yield piece()
        if key:
            if held:
                yield piece()
            yield row(key, pos, None, table)

    return run


def _entered(blocks: DataFrame) -> DataFrame:
    """(path, block, state, depth): how each block of a file is entered; one row per block."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block")
        state, depth, out = 0, 0, []
        for states, depths in zip(rows["states"], rows["depths"], strict=True):
            out.append((state, depth))
            state, depth = int(states[state]), depth + int(depths[state])
        return pd.DataFrame({"path": rows["path"], "block": rows["block"], "state": [s for s, _ in out], "depth": [d for _, d in out]})

    whole = blocks.filter(F.col("text").isNull()).select("path", "block", "states", "depths")
    return whole.groupBy("path").applyInPandas(run, "path string, block long, state int, depth long")


_PARTS = pa.schema([("path", pa.string()), ("pos", pa.int64()), ("part", pa.int32()), ("text", pa.string()), ("ended", pa.bool_())])


def _cut(syntax: Syntax):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                text, ends = r["text"], syntax.ends(r["text"], r["state"], r["depth"])
                if ends:
                    first, last = ends[0], ends[-1]
                    parts = [(HEAD, text[:first], True), (BODY, text[first:last], True), (TAIL, text[last:], False)]
                    rows += [(r["path"], r["pos"], *p) for p in parts if p[1] or p[0] == TAIL]
                else:
                    rows.append((r["path"], r["pos"], HEAD, text, False))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), _PARTS, strict=True)], schema=_PARTS)

    return run


def split(spark: SparkSession, paths: str | list[str], syntax: Syntax, size: int = PIECE_BYTES) -> DataFrame:
    """``(path, pos, part, text, ended)``: whole statements, many to a row, staged.

    Rows of one file are in the order of ``pos`` and ``part``.  The first row of a file
    that does not begin with a statement has ``pos`` -1.  ``ended`` is false for what
    stands behind the last end of a file, and for the parts of a statement that is longer
    than ``STATEMENT_BYTES``; nothing is lost.
    """
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    blocks = stage(lines.mapInArrow(_blocks(syntax, size), _BLOCKS_SQL), "blocks")
    entered = broadcast_if_small(stage(_entered(blocks), "entered"))
    known = blocks.filter(F.col("text").isNotNull()).join(entered, ["path", "block"]).select(
        "path",
        "pos",
        "text",
        F.get("states", F.col("state")).alias("state"),
        (F.col("depth") + F.get("depths", F.col("state"))).alias("depth"),
    )
    parts = stage(known.mapInArrow(_cut(syntax), "path string, pos long, part int, text string, ended boolean"), "parts")
    return stage(parts.filter(F.col("part") == BODY).unionByName(_crossing(parts)), "statements")


def _crossing(parts: DataFrame) -> DataFrame:
    """Statements that run over an edge, put together from their parts."""
    # Only what stands at the edges of pieces is dealt by file here.
    order = Window.partitionBy("path").orderBy("pos", "part")
    begun = F.last(F.when(F.col("part") == TAIL, F.col("pos")), ignorenulls=True).over(order)
    edges = parts.filter(F.col("part") != BODY).withColumn("begun", F.coalesce(begun, F.lit(-1)))
    size = F.sum(F.octet_length("text")).over(Window.partitionBy("path", "begun"))
    edges = edges.withColumn("long", size > STATEMENT_BYTES)
    texts = F.sort_array(F.collect_list(F.struct("pos", "part", "text")))
    joined = edges.filter(~F.col("long")).groupBy("path", "begun").agg(
        F.array_join(F.transform(texts, lambda t: t["text"]), "").alias("text"), F.max("ended").alias("ended")
    )
    apart = edges.filter("long").select("path", "pos", F.lit(TAIL).alias("part"), "text", F.lit(False).alias("ended"))
    whole = joined.select("path", F.col("begun").alias("pos"), F.lit(TAIL).alias("part"), "text", "ended")
    return whole.unionByName(apart).filter(F.regexp_like("text", F.lit(r"\S")))


def named(rows: DataFrame) -> DataFrame:
    """Adds ``file`` and ``doc``, the keys of a file and of a row of ``split``."""
    file = F.sha1("path")
    return rows.withColumn("file", file).withColumn("doc", F.concat_ws(".", "file", F.col("pos").cast("string"), F.col("part").cast("string")))


def apart(docs: DataFrame, one_by_one, body: str = "body", doc: str = "doc") -> DataFrame:
    """Every statement of each document as a document, as ``one_by_one(text)`` gives them.

    A document with one statement stays as it is.  Other columns are kept.
    """
    names, at, key = docs.columns, docs.columns.index(body), docs.columns.index(doc)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                texts = one_by_one(row.column(at)[0].as_py())
                if len(texts) < 2:
                    yield row
                    continue
                columns = [pa.array(row.column(c).to_pylist() * len(texts), row.column(c).type) for c in range(len(names))]
                columns[at] = pa.array(texts, columns[at].type)
                columns[key] = pa.array([f"{columns[key][0].as_py()}.{n}" for n in range(len(texts))], columns[key].type)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, docs.schema)


def reasons(read: DataFrame, docs: DataFrame, body: str, doc: str) -> DataFrame:
    """Quarantine rows: the documents that ``read`` gives a reason for, with their whole text."""
    keep = [c for c in docs.columns if c != body]
    wrong = (
        read.filter(F.col("reason").isNotNull())
        .groupBy(F.col(doc).alias("_doc"))
        .agg(F.max("reason").alias("reason"))
    )
    return docs.join(wrong, F.col(doc) == F.col("_doc"), "inner").select(F.col(body).alias("value"), "reason", *keep)
