"""Removal of repeated byte strings by suffix sorting of shards.

Every string of LENGTH bytes is dealt by its key, the least hash of the GRAM-byte strings
in it, so equal strings meet in one shard.  Neighbouring strings with one key travel as
one piece of text.  A key that occurs once has nothing to compare; equal pieces of a key
are merged to the first of them, as otherwise a group of copies would be a shard without
bound.  Strings of a key that still has more than a shard are dealt again by longer grams,
at last by all their bytes, so that no shard depends on how common a line is.  What is left
of a key goes to its shard, whose suffixes are sorted by external induction with their
common prefixes: strings with a common prefix of LENGTH are equal, and all but the first
are repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rdfweave.llm import common, words
from rdfweave.llm.induced import Sorter
from rdfweave.llm.order import placed

LENGTH = 100
GRAM = 24
#: Grams by which strings of keys with more than a shard are dealt again, the last a whole string.
LONGER = (62, 81, LENGTH)
#: Text of a shard that is sorted at once; a key with more is dealt again.
SHARD_BYTES = 2 << 20
#: Tuples that the queues of a shard hold in memory, and suffixes of a level of names that
#: are sorted there; what is beyond lies on disk, and is sorted by induction of its own.
QUEUE_BYTES = 4 << 20
INNER_SUFFIXES = 1 << 20


def pieces(t: words.Text, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(owner, start, strings, key, digest, inner): runs of neighbouring strings with one key.

    ``start`` is a byte of the owner, ``strings`` how many strings begin from there on.
    ``inner`` tells that a string may lie twice in the run: only if its least gram does,
    which then is in one string twice or as many grams apart as a string has.
    """
    n = len(t.bytes)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none.view(np.uint64), none.view(np.uint64), none.astype(bool)
    _, inverse = words.powers(n + 1)
    # The low bits of a hash give way to the place, counted up and down: if the least hash
    # stands twice in a string, the two minima lie at two places.
    place = np.arange(n - gram + 1, dtype=np.uint64) & np.uint64(127)
    hashed = words.mix((t.sums[gram:] - t.sums[:-gram]) * inverse[: n - gram + 1]) & ~np.uint64(127)
    width = length - gram + 1
    least, most = _sliding_least(hashed | place, width), _sliding_least(hashed | (np.uint64(127) - place), width)
    twice = (least & np.uint64(127)) + (most & np.uint64(127)) != 127
    least &= ~np.uint64(127)
    owner = np.repeat(np.arange(t.n), np.diff(t.at))[: len(least)]
    inside = np.arange(len(least)) + length <= t.at[1:][owner] - 1
    first = inside.copy()
    if gram < length:  # else every string is by itself
        first[1:] &= (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
    start = np.flatnonzero(first)
    counted = np.concatenate([[0], np.cumsum(inside)])
    strings = counted[np.append(start[1:], len(least))] - counted[start] if len(start) else none
    digest = t.hashes(start, start + strings + length - 1)
    doubles = np.concatenate([[0], np.cumsum(twice & inside)])
    inner = (doubles[np.append(start[1:], len(least))] > doubles[start] if len(start) else none.astype(bool)) | (strings > width)
    return owner[start], start - t.at[owner[start]], strings, least[start], digest, inner


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    step = 1
    while step * 2 <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return values if step == width else np.minimum(values[: len(values) - width + step], values[width - step :])


def keyed(gram: int = GRAM) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The pieces of each text by grams of a length.

    A text that itself is a piece of a document has a column ``at``, where it begins there:
    ``start`` counts from the beginning of the document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in common.chunks(batches):
            owner, start, strings, key, digest, inner = pieces(words.Text(raw), gram=gram)
            names, more = ["key", "digest", "doc_id", "start", "strings", "inner"], []
            if "at" in batch.schema.names:
                at = batch.column("at").to_numpy()[owner]
                names, more, start = [*names, "at"], [pa.array(at)], start + at
            ids = batch.column("doc_id").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(digest.view(np.int64)), pa.array(ids[owner]), pa.array(start.astype(np.int32)), pa.array(strings.astype(np.int32)), pa.array(inner), *more],
                names=names,
            )

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, digest and place: those that repeat an earlier piece, and
    the first of each piece if its key has others (``sort``).

    A piece that may repeat a string itself (``inner``) is sorted in any case.  Only the
    last row of a batch is carried on.
    """
    fields: list[pa.Field] = []  # of key, digest, doc_id, start, strings and what else there is
    last = None  # (key, digest, doc_id, start) of the row before
    first_of_key = None  # the only piece of the last key so far, not yet given out

    def rows(columns: list[np.ndarray], chosen: np.ndarray, sort: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c[chosen]) for c in columns] + [pa.array(sort[chosen])], names=[*[f.name for f in fields], "sort"]
        )

    def held(row: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip(row, fields, strict=True)] + [pa.array([True])],
            names=[*[f.name for f in fields], "sort"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        fields = [f for f in batch.schema if f.name != "inner"]
        columns = [batch.column(f.name).to_numpy() for f in fields]
        key, digest, doc, start = columns[:4]
        before = [np.concatenate([[c[0] if last is None else last[i]], c[:-1]]) for i, c in enumerate(columns[:4])]
        new_key = key != before[0]
        new_piece = new_key | (digest != before[1])
        again = ~new_piece & (doc == before[2]) & (start == before[3])  # a repeated row
        if last is None:
            new_key[0] = new_piece[0] = True
            again[0] = False
        at = np.flatnonzero(new_piece)
        group = np.cumsum(new_key)[at]
        # Pieces of one key: all of them are sorted if there are two or more.
        size = np.bincount(group, minlength=group[-1] + 1 if len(group) else 1)
        sort = np.zeros(len(key), bool)
        carried = size[0] if len(size) else 0
        sort[at] = (size[group] > 1) | (group == 0) | batch.column("inner").to_numpy(zero_copy_only=False)[at]
        if first_of_key is not None and carried:
            yield held(first_of_key)
            first_of_key = None
        keep = (~new_piece & ~again) | sort
        if new_key.any():
            first_of_key = None
            open_ = at[group == group[-1]]
            if len(open_) == 1 and not sort[open_[0]]:
                i = open_[0]
                first_of_key = tuple(c[i].item() for c in columns)
        if keep.any():
            yield rows(columns, np.flatnonzero(keep), sort)
        last = tuple(c[-1].item() for c in columns[:4])


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of each wanted piece."""
    for batch, raw in common.chunks(batches):
        out: dict[str, list] = {n: [] for n in ("key", "doc_id", "start", "strings", "piece")}
        begin = batch.column("at").to_pylist() if "at" in batch.schema.names else [0] * len(raw)
        for doc_id, at, text, wanted in zip(batch.column("doc_id").to_pylist(), begin, raw, batch.column("wanted").to_pylist(), strict=True):
            for w in wanted:
                out["key"].append(w["key"])
                out["doc_id"].append(doc_id)
                out["start"].append(w["start"])
                out["strings"].append(w["strings"])
                out["piece"].append(text[w["start"] - at : w["start"] - at + w["strings"] + LENGTH - 1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["key"], pa.int64()), pa.array(out["doc_id"], pa.int64()), pa.array(out["start"], pa.int32()), pa.array(out["strings"], pa.int32()), pa.array(out["piece"], pa.binary())],
            names=list(out),
        )


def repeated_in(doc_id: np.ndarray, start: np.ndarray, texts: list[bytes], length: int = LENGTH, memory: int = QUEUE_BYTES, inner: int = INNER_SUFFIXES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc_id, start, end) of runs of bytes that repeated strings of a shard cover."""
    order = np.lexsort((start, doc_id))
    doc_id, start, texts = doc_id[order], start[order], [texts[i] for i in order]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    # Pieces lie in the order of their places, so the least position is the first one.
    joined = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.uint16) + np.uint16(1)
    at = np.concatenate([[0], np.cumsum(sizes + 1)])
    joined[at[1:] - 1] = 0
    change = np.zeros(len(joined) + 1, np.int32)
    np.add.at(change, at[:-1], 1)
    np.add.at(change, at[1:] - length, -1)
    begins = np.cumsum(change[:-1]) > 0  # where a whole string begins
    later = np.zeros(len(joined), bool)
    for position, prefix in Sorter(joined, length, memory, inner).by_symbol():
        equal = prefix >= length
        member = equal | np.append(equal[1:], False)
        if not member.any():
            continue
        some, joins = position[member], equal[member]
        head = np.flatnonzero(~joins)
        first = np.repeat(np.minimum.reduceat(some, head), np.diff(np.append(head, len(some))))
        later[some[some != first]] = True
    found = np.flatnonzero(later & begins)
    if not len(found):
        return doc_id[:0], start[:0], start[:0]
    owner = np.searchsorted(at, found, "right") - 1
    new = np.concatenate([[True], (found[1:] != found[:-1] + 1) | (owner[1:] != owner[:-1])])
    begin, end = found[new], found[np.append(new[1:], True)]
    owner = owner[new]
    return doc_id[owner], start[owner] + begin - at[owner], start[owner] + end - at[owner] + length


def _sorted_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, cut into shards of whole keys."""
    held: list[tuple[int, int, int, bytes]] = []
    size, last = 0, None

    def shard(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        doc_id, start, end = repeated_in(
            np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64), [r[3] for r in rows]
        )
        return pa.RecordBatch.from_arrays(
            [pa.array(doc_id), pa.array(start.astype(np.int64)), pa.array(end.astype(np.int64))], names=["doc_id", "start", "end"]
        )

    for batch in batches:
        for row in zip(*[batch.column(n).to_pylist() for n in ("key", "doc_id", "start", "piece")], strict=True):
            if row[:3] == last:  # a repeated row of the table
                continue
            last = row[:3]
            if held and row[0] != held[-1][0]:
                if size >= SHARD_BYTES:
                    yield shard(held)
                    held, size = [], 0
            held.append(row)
            size += len(row[3]) + 1
    if held:
        yield shard(held)


SPAN = "array<struct<start:long,end:long>>"


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, raw in common.chunks(batches):
        spans, kept = [], []
        for text, found in zip(raw, batch.column("spans").to_pylist(), strict=True):
            runs: list[list[int]] = []
            for a, b in sorted((s["start"], s["end"]) for s in found or ()):
                if runs and a <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], b)
                else:
                    runs.append([a, b])
            spans.append(runs)
            ends = [0, *[b for _, b in runs]]
            kept.append(b"".join(text[a:b] for a, b in zip(ends, [*[a for a, _ in runs], len(text)], strict=True)))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(x) for x in raw], pa.int64()),
                pa.array([sum(b - a for a, b in s) for s in spans], pa.int64()),
                pa.array([len(s) for s in spans], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in kept]),
                pa.array(kept, pa.binary()),
            ],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


KEYED = "key long, digest long, doc_id long, start int, strings int, inner boolean"
MERGED = "key long, digest long, doc_id long, start int, strings int{}, sort boolean"
TEXTS = "key long, doc_id long, start int, strings int, piece binary"


def _wanted(source: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id[, at], text, wanted): the texts of the pieces in ``found``."""
    row = [c for c in ("doc_id", "at") if c in source.columns]
    wanted = found.groupBy(*row).agg(F.collect_list(F.struct("key", "start", "strings")).alias("wanted"))
    return source.join(wanted, row).select(*row, "text", "wanted")


def dealt(source: DataFrame) -> Iterator[tuple[DataFrame, DataFrame]]:
    """For each length of grams: pieces that repeat an earlier one, and the texts of those to sort.

    No key has more than SHARD_BYTES to sort: strings of such a key are dealt again, and
    strings with all bytes in common are merged in the end.  Documents are shuffled for
    the first texts only; what is dealt again is cut from these.
    """
    rows, at = source.mapInArrow(keyed(), KEYED), ""
    for longer in (*LONGER, None):
        found = common.stage(
            rows.repartition("key").sortWithinPartitions("key", "digest", "doc_id", "start").mapInArrow(_merged, MERGED.format(at)), "pieces"
        )
        copies, sort = found.filter("NOT sort"), found.filter("sort")
        texts = _wanted(source, sort).mapInArrow(cut, TEXTS)
        if longer is None:
            yield copies, texts
            return
        # At most one key for each SHARD_BYTES of the pieces, staged to be small enough to broadcast.
        heavy = common.stage(
            sort.groupBy("key").agg(F.sum(F.col("strings").cast("long") + LENGTH).alias("bytes"))
            .filter(F.col("bytes") > SHARD_BYTES).select("key"),
            "heavy",
        )
        if heavy.isEmpty():
            yield copies, texts
            return
        texts = common.stage(texts, "texts", "zstd")
        yield copies, texts.join(heavy, "key", "left_anti")
        source = texts.join(heavy, "key", "left_semi").select("doc_id", F.col("start").alias("at"), F.col("piece").alias("text"))
        rows, at = source.mapInArrow(keyed(longer), f"{KEYED}, at int"), ", at int"


def repeated_runs(rows: DataFrame) -> DataFrame:
    """(doc_id, start, end): runs of bytes that repeated strings cover; they may overlap.

    ``rows`` are those of ``placed``; ``doc_id`` stands for the place here and below.
    """
    source = rows.select(F.col("place").alias("doc_id"), "text").filter("doc_id IS NOT NULL AND octet_length(text) >= 100")
    runs = None
    for copies, texts in dealt(source):
        shards = (
            texts.select("key", "doc_id", "start", "piece").repartition("key").sortWithinPartitions("key", "doc_id", "start")
            .mapInArrow(_sorted_shards, "doc_id long, start long, end long")
        )
        both = copies.select(
            "doc_id", F.col("start").cast("long").alias("start"), F.expr(f"cast(start + strings + {LENGTH - 1} AS long)").alias("end")
        ).unionByName(shards)
        runs = both if runs is None else runs.unionByName(both)
    return runs


def without_repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row.

    Null texts are empty; texts under 100 bytes and rows without a doc_id keep all their
    bytes and repeat nothing; rows that are repeated as a whole are one document and have
    equal results; several texts under one doc_id are documents each, in the order of a
    hash of the text; an empty table gives an empty result.
    """
    rows, _ = placed(docs)
    spans = (
        common.stage(repeated_runs(rows), "spans")
        .groupBy(F.col("doc_id").alias("place")).agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    )
    return (
        rows.join(spans, "place", "left").select("doc_id", "text", "spans")
        .mapInArrow(_removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    )


def op1_induced_sorting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(spark, common.table(spark, sf_dir, "documents")).drop("kept")
