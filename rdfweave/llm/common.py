"""Tables, chunks of text and staged results shared by the operators of this folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDER_SETTING = "spark.checkpoint.dir"
# Bytes of text that a task looks at together; a longer document is a chunk of its own.
CHUNK_BYTES = 1 << 20
#: Labels are learned only where this is not 0.
FOLDS = 5


_own: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a local session without it gets its own."""
    folder = spark.conf.get(FOLDER_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {FOLDER_SETTING} to a folder that all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="llm-shared-"))
    return _own[0]


def stage(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read back: no lineage, no recomputation."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns alone, so that no other column can clash; a missing one is null."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") if c in have else F.lit(None).cast("string").alias(c) for c in columns])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def training_labels(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, label): one row per document of the training folds whose labels agree."""
    return (
        only(labels, "doc_id", column)
        .filter(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min(column).alias("label"), F.max(column).alias("_most"))
        .filter("label = _most")
        .select("doc_id", F.col("label").cast("int").alias("label"))
    )


def sample(df: DataFrame, limit: int, *key: str) -> DataFrame:
    """About ``limit`` rows at most, those with the least hashes of ``key``.

    The bound on the hash follows from the count, so tasks send no more than the sample.
    """
    count = df.count()
    if count <= limit:
        return df
    bound = int((1 << 30) * (limit / count))
    return df.filter(F.pmod(F.xxhash64(*key), F.lit(1 << 30)) < bound)


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each value, null as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def chunks(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with about ``limit`` bytes of text, and those texts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        raw = raw_texts(batch.column(text))
        first, size = 0, 0
        for i, x in enumerate(raw):
            if size and size + len(x) > limit:
                yield batch.slice(first, i - first), raw[first:i]
                first, size = i, 0
            size += len(x) + 1
        yield batch.slice(first), raw[first:]
