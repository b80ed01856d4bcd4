"""Bounded-space online best-fit packing of token sequences."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rdfweave.llm import common
from rdfweave.llm.tokens import Encoder, crc32

SIZE = 1024
#: Bins that a packer keeps open.
OPEN_BINS = 4096
#: Pieces that a packer looks at together, longest first.
LOOK = 16384


class Packer:
    """Open bins by free space: bit f of ``mask`` is set while a bin has f tokens free.

    A piece goes to the fullest bin that has room.  Beyond ``open_bins`` the fullest bin
    closes.  Bins of one free space are used last in, first out.
    """

    def __init__(self, size: int = SIZE, open_bins: int = OPEN_BINS) -> None:
        self.size, self.open_bins = size, open_bins
        self.mask, self.bins, self.count, self.made = 0, [[] for _ in range(size + 1)], 0, 0

    def _take(self, free: int) -> int:
        sequence = self.bins[free].pop()
        if not self.bins[free]:
            self.mask &= ~(1 << free)
        self.count -= 1
        return sequence

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) of a piece of 1 to ``size`` tokens."""
        if not 0 < length <= self.size:
            raise ValueError(f"a piece has 1 to {self.size} tokens, not {length}")
        room = self.mask >> length
        if room:
            free = length + (room & -room).bit_length() - 1
            sequence = self._take(free)
        else:
            free, sequence = self.size, self.made
            self.made += 1
        left = free - length
        if left:
            self.bins[left].append(sequence)
            self.mask |= 1 << left
            self.count += 1
            if self.count > self.open_bins:
                self._take((self.mask & -self.mask).bit_length() - 1)
        return sequence, self.size - free


def pieces(n: int, size: int = SIZE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens; the first may be shorter."""
    first = n % size
    starts = ([0] if first else []) + list(range(first, n, size))
    return [(s, (first if s < first else size)) for s in starts]


def tokenized(docs: DataFrame, size: int = SIZE, path: str | None = None, ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every piece of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.shared(path)
        for batch, raw in common.chunks(batches):
            rows: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            for doc_id, x in zip(batch.column("doc_id").to_pylist(), encoder.encode(raw), strict=True):
                tokens = encoder.ids(x)
                for p, (s, n) in enumerate(pieces(len(tokens), size)):
                    part = tokens[s : s + n]
                    for k, v in zip(rows, (doc_id, p, s, n, crc32(part), part.astype("<u4").tobytes() if ids else None), strict=True):
                        rows[k].append(v)
            arrays = [pa.array(rows[k], t) for k, t in (("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()))]
            names = list(rows)[:5]
            if ids:
                arrays, names = [*arrays, pa.array(rows["ids"], pa.binary())], list(rows)
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * ids
    return common.only(docs, "doc_id", "text").mapInArrow(run, schema)


def looked_at(batches: Iterable[pa.RecordBatch], look: int) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        while batch.num_rows:
            room = look - sum(b.num_rows for b in held)
            held.append(batch.slice(0, room))
            batch = batch.slice(min(room, batch.num_rows))
            if sum(b.num_rows for b in held) == look:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def pack(parts: DataFrame, size: int = SIZE, open_bins: int = OPEN_BINS, look: int = LOOK) -> DataFrame:
    """``parts`` with ``sequence_id`` and ``offset``.

    Pieces are dealt by a hash, so no key is hot, and ordered by it, so that a task that
    runs again packs alike.  Each task packs its share; what two tasks leave open is not
    joined.  A bin never holds more than ``size`` tokens and offsets have no gaps.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = (TaskContext.get().partitionId() + 1) << 40
        packer = Packer(size, open_bins)
        for table in looked_at(batches, look):
            lengths = table.column("length").to_numpy()
            order = np.argsort(-lengths, kind="stable")
            got = np.array([packer.place(n) for n in lengths[order].tolist()], np.int64).reshape(-1, 2)
            out = np.empty_like(got)
            out[order] = got
            table = table.drop_columns("_deal").append_column("sequence_id", pa.array(out[:, 0] + first)).append_column("offset", pa.array(out[:, 1]))
            yield from table.combine_chunks().to_batches()

    dealt = parts.withColumn("_deal", F.xxhash64("doc_id", "piece", "ids_crc32"))
    # One task packs about this many bytes of piece rows; adaptive execution joins small shares.
    ordered = dealt.repartition("_deal").sortWithinPartitions("_deal", "doc_id", "piece", "start")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    return ordered.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, size: int = SIZE, path: str | None = None, ids: bool = False, open_bins: int = OPEN_BINS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids].

    Null and empty texts are one piece that holds the end id alone; repeated rows are
    packed each by itself; an empty table gives an empty result.
    """
    return pack(tokenized(docs, size, path, ids), size, open_bins)


def op8_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(common.table(spark, sf_dir, "documents"))
