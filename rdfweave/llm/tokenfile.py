"""Token ids of documents in files of range-coded blocks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rdfweave.llm import coder, common
from rdfweave.llm.tokens import Encoder, crc32

#: Ids of a segment: the documents that are coded and decoded together.
SEGMENT_IDS = 4 << 20
#: One row of a file.  ``start`` counts the ids before the segment in its part; blocks
#: have ``block_ids`` ids (the last one fewer) in ``width`` symbols each, ``block_bytes``
#: bytes of ``payload`` and a crc32 of their ids as little-endian 32-bit integers.
FILE = """part int, start long, doc_ids array<long>, lengths array<long>, n_ids long, width int,
block_ids int, block_bytes array<int>, block_crc32 array<long>, payload binary"""


def segment(part: int, start: int, doc_ids: list, docs: list[np.ndarray]) -> dict:
    """A row of the file format."""
    ids = np.concatenate(docs)
    symbols, width = ids, 1
    if len(ids) and ids.max() >= 1 << 16:
        width = 2
        symbols = np.stack([ids >> 16, ids & 0xFFFF], 1).ravel()
    step = coder.BLOCK // width
    blocks = [symbols[i : i + coder.BLOCK] for i in range(0, len(symbols), coder.BLOCK)]
    payloads = coder.encode(blocks)
    return {
        "part": part, "start": start, "doc_ids": doc_ids, "lengths": [len(d) for d in docs], "n_ids": len(ids),
        "width": width, "block_ids": step, "block_bytes": [len(p) for p in payloads],
        "block_crc32": [crc32(ids[i : i + step]) for i in range(0, len(ids), step)], "payload": b"".join(payloads),
    }


def documents(row: dict) -> list[np.ndarray]:
    """The ids of each document of a row; a block with another checksum is an error."""
    ends = np.cumsum(row["block_bytes"]).tolist()
    payloads = [row["payload"][a:b] for a, b in zip([0, *ends], ends, strict=False)]
    left = row["n_ids"] * row["width"] - np.arange(len(payloads)) * coder.BLOCK
    blocks = coder.decode(payloads, np.minimum(left, coder.BLOCK).tolist())
    if row["width"] == 2:
        blocks = [b[0::2] << 16 | b[1::2] for b in blocks]
    for i, (b, crc) in enumerate(zip(blocks, row["block_crc32"], strict=True)):
        if crc32(b) != crc:
            raise ValueError(f"block {i} of the segment at {row['start']} of part {row['part']} is damaged")
    ids = np.concatenate([np.zeros(0, np.uint32), *blocks])
    return np.split(ids, np.cumsum(row["lengths"])[:-1])


SEGMENT = pa.schema(
    [("part", pa.int32()), ("start", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("n_ids", pa.int64()),
     ("width", pa.int32()), ("block_ids", pa.int32()), ("block_bytes", pa.list_(pa.int32())), ("block_crc32", pa.list_(pa.int64())), ("payload", pa.binary())]
)


def write(docs: DataFrame, path: str, tokenizer: str | None = None, segment_ids: int = SEGMENT_IDS) -> None:
    """Write the ids of every row in ascending order of doc_id, rows without one first.

    The rows are dealt by ranges of doc_id (and of a hash of the text, so that one id
    with very many rows is no single task); equal ids are in the order of that hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part = Encoder.shared(tokenizer), TaskContext.get().partitionId()
        ids: list[np.ndarray] = []
        doc_ids: list = []
        held = start = 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([segment(part, start, doc_ids, ids)], SEGMENT)

        for batch, raw in common.chunks(batches):
            for doc_id, x in zip(batch.column("doc_id").to_pylist(), encoder.encode(raw), strict=True):
                tokens = encoder.ids(x)
                if held and held + len(tokens) > segment_ids:
                    yield flush()
                    start, held = start + held, 0
                    ids, doc_ids = [], []
                ids.append(tokens)
                doc_ids.append(doc_id)
                held += len(tokens)
        if ids:
            yield flush()

    ordered = (
        common.only(docs, "doc_id", "text").withColumn("_tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
    )
    ordered.select("doc_id", "text").mapInArrow(run, FILE).write.parquet(path)


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document in the files."""
    files = spark.read.schema(FILE).parquet(path)
    # One number per part, and there are as many parts as the writer had tasks.
    sizes = files.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    before = dict(zip([r["part"] for r in sizes], np.cumsum([0, *[r["n"] for r in sizes]]).tolist(), strict=False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                docs = documents(row)
                lengths = np.array(row["lengths"], np.int64)
                starts = before[row["part"]] + row["start"] + np.cumsum(lengths) - lengths
                columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(starts), pa.array(lengths), pa.array([crc32(d) for d in docs], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array([d.tolist() for d in docs], pa.list_(pa.int64()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)


def encode_documents(spark: SparkSession, docs: DataFrame, path: str | None = None, tokenizer: str | None = None) -> DataFrame:
    """Write all rows of ``docs`` to ``path`` and read them back.

    Null and empty texts are the end id alone; repeated rows are documents of their own;
    an empty table gives an empty result.
    """
    path = path or f"{common.shared_folder(spark)}/ids-{uuid.uuid4().hex}"
    write(docs, path, tokenizer)
    return read(spark, path)


def op3_range_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(spark, common.table(spark, sf_dir, "documents"))
