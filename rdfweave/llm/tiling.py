"""Benchmark decontamination by greedy string tiling of shared token stretches."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rdfweave.llm import common, words

#: Shortest tile, and so the length of a seed, in words.
TILE = 5
#: A document is contaminated by an item of which tiles cover this share.
COVERAGE = 0.5
#: The benchmark is a query set; it goes over all documents in blocks of this many bytes.
BLOCK_BYTES = 8 << 20
#: Tile search starts at this length and is halved down to TILE.
START = 32
MODULUS, RADIX = (1 << 61) - 1, 1_000_003


def tokens(raw: list[bytes]) -> tuple[words.Text, np.ndarray, np.ndarray]:
    """(text, hashes, owners): lower-case runs of letters and digits."""
    t = words.Text([x.decode("utf-8", "replace").lower().encode() for x in raw])
    start, end = t.stretches(words.NOT_WORD)
    return t, t.hashes(start, end), t.owner(start)


def runs_of(marked: list[bool], length: int) -> Iterator[tuple[int, int]]:
    """Unmarked stretches of at least ``length``."""
    first = 0
    for i, m in enumerate([*marked, True]):
        if m:
            if i - first >= length:
                yield first, i
            first = i + 1


def rolling(values: list[int], first: int, last: int, length: int) -> Iterator[tuple[int, int]]:
    """(position, Karp-Rabin hash) of every window of ``length`` inside [first, last)."""
    top, h = pow(RADIX, length - 1, MODULUS), 0
    for i in range(first, last):
        if i - first >= length:
            h = (h - values[i - length] * top) % MODULUS
        h = (h * RADIX + values[i]) % MODULUS
        if i - first >= length - 1:
            yield i - length + 1, h


def tile(item: list[int], text: list[int], least: int = TILE, breaks: frozenset[int] = frozenset()) -> list[tuple[int, int, int]]:
    """Greedy tiles (position in item, position in text, length), longest first.

    ``breaks`` are positions of the text that no tile may contain.  A token of either
    side belongs to one tile at most, so a passage that is repeated counts once and a
    passage whose parts change places is still covered.
    """
    marked_i, marked_t = [False] * len(item), [i in breaks for i in range(len(text))]
    tiles: list[tuple[int, int, int]] = []
    length = max(least, START)
    while True:
        places: dict[int, list[int]] = defaultdict(list)
        for a, b in runs_of(marked_i, length):
            for i, h in rolling(item, a, b, length):
                places[h].append(i)
        matches: list[tuple[int, int, int]] = []
        longest = 0
        for a, b in runs_of(marked_t, length):
            for j, h in rolling(text, a, b, length):
                for i in places.get(h, ()):
                    # A match that goes on to the left was found one step before.
                    if i and j and not marked_i[i - 1] and not marked_t[j - 1] and item[i - 1] == text[j - 1]:
                        continue
                    k = 0
                    while i + k < len(item) and j + k < len(text) and item[i + k] == text[j + k] and not marked_i[i + k] and not marked_t[j + k]:
                        k += 1
                    if k >= length:
                        matches.append((k, i, j))
                        longest = max(longest, k)
        again = False
        for k, i, j in sorted(matches, key=lambda m: (-m[0], m[1], m[2])):
            free = next((n for n in range(k) if marked_i[i + n] or marked_t[j + n]), k)
            if free < k:
                again = True  # what is left of it may still be a tile: search this length once more
                continue
            tiles.append((i, j, k))
            marked_i[i : i + k] = [True] * k
            marked_t[j : j + k] = [True] * k
        if again:
            continue
        if length == least:
            return tiles
        length = max(least, length // 2)


class Block:
    """Seeds of a bounded number of benchmark items, ready to be sent to every task."""

    def __init__(self, ids: list, texts: list[bytes]) -> None:
        _, h, owner = tokens(texts)
        at = np.searchsorted(owner, np.arange(len(ids) + 1))
        self.ids = ids
        self.items = [h[at[i] : at[i + 1]] for i in range(len(ids))]
        place, seed = words.windows(h, owner, TILE)
        order = np.argsort(seed, kind="stable")
        self.seed, self.item = seed[order], owner[place][order].astype(np.int32)
        self.present = np.zeros(1 << 22, bool)
        self.present[(self.seed >> np.uint64(42)).astype(np.int64)] = True

    def pairs(self, raw: list[bytes], coverage: float) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, tiles, covered words) of the pairs whose coverage is enough."""
        _, h, owner = tokens(raw)
        at, seed = words.windows(h, owner, TILE)
        likely = self.present[(seed >> np.uint64(42)).astype(np.int64)]
        at, seed = at[likely], seed[likely]
        left, right = np.searchsorted(self.seed, seed, "left"), np.searchsorted(self.seed, seed, "right")
        places: dict[tuple[int, int], list[int]] = defaultdict(list)
        for a, lo, hi in zip(at[right > left].tolist(), left[right > left].tolist(), right[right > left].tolist(), strict=True):
            for i in set(self.item[lo:hi].tolist()):
                places[int(owner[a]), i].append(a)
        for (text, i), found in places.items():
            item = self.items[i]
            # Each seed covers TILE words of the text at most; too few cannot be enough.
            if TILE * len(found) < coverage * len(item):
                continue
            inside = np.unique(np.add.outer(found, np.arange(TILE)).ravel())
            jump = np.flatnonzero(np.diff(inside) > 1)
            stretch, breaks, last = [], [], 0
            for end in [*(jump + 1).tolist(), len(inside)]:
                stretch += [*h[inside[last:end]].tolist(), 0]
                breaks.append(len(stretch) - 1)
                last = end
            tiles = tile(item.tolist(), stretch, TILE, frozenset(breaks))
            covered = sum(k for _, _, k in tiles)
            if tiles and covered >= coverage * len(item):
                yield text, i, len(tiles), covered


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The items in blocks of about ``block_bytes``; each block is read by itself."""
    items = common.only(benchmark, "item_id", "text").filter("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // block_bytes)
    for b in range(count):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == b)
        rows = sorted(part.distinct().collect(), key=lambda r: (r["item_id"] is None, r["item_id"], r["text"]))
        if rows:
            yield Block([r["item_id"] for r in rows], [r["text"].encode() for r in rows])


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, item_id, n_tiles, covered, n_words, coverage): pairs of a row and an item.

    Null and empty texts, and items of fewer than five words, meet nothing.  Repeated
    rows of documents give repeated pairs, repeated rows of the benchmark do not.
    """
    kind = benchmark.schema["item_id"].dataType.simpleString() if "item_id" in benchmark.columns else "string"
    schema = f"doc_id long, item_id {kind}, n_tiles int, covered int, n_words int, coverage double"
    source = common.only(docs, "doc_id", "text")
    out = None
    for block in blocks(benchmark):
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = sent.value
            for batch, raw in common.chunks(batches):
                ids = batch.column("doc_id").to_pylist()
                rows = [(ids[t], block.ids[i], n, c, len(block.items[i]), c / len(block.items[i])) for t, i, n, c in block.pairs(raw, coverage)]
                if rows:
                    yield pa.RecordBatch.from_pylist(
                        [dict(zip(("doc_id", "item_id", "n_tiles", "covered", "n_words", "coverage"), r, strict=True)) for r in rows],
                        schema=pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()), ("n_tiles", pa.int32()), ("covered", pa.int32()), ("n_words", pa.int32()), ("coverage", pa.float64())]),
                    )

        part = source.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def without_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with all their columns."""
    for block in blocks(benchmark):
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch, raw in common.chunks(batches):
                keep = np.ones(len(raw), bool)
                for t, *_ in sent.value.pairs(raw, coverage):
                    keep[t] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op6_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark, common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
