"""Near duplicates by b-bit MinHash: banded candidates, packed estimates, exact links.

Documents of equal shingle sets are one class, represented by the least doc_id.  Links
between classes are found in buckets of equal bands.  A small bucket compares all its
classes.  A large one first compares all with one of them; only classes that this leaves
in another component are then compared with the rest of the bucket, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rdfweave.llm import common, words
from rdfweave.llm.components import components
from rdfweave.llm.order import placed
from rdfweave.operators.scale import skew_join

SHINGLE = 4
#: A pair is linked if PERCENT of the union of both sets is common.
PERCENT = 80
#: A pair at the threshold shares no band once in twenty million times.
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: Low bits kept of each minimum.
BITS = 4
#: Standard deviations below the threshold that an estimate may lie.
MARGIN = 5.0
#: Buckets up to this size compare all their classes.
SMALL = 12
#: Rows and shingles of a block of a large bucket.
BLOCK_ROWS, BLOCK_SHINGLES = 512, 1_000_000

_random = np.random.default_rng(20240229)
FLIPS = _random.integers(0, 1 << 32, HASHES, dtype=np.uint32)
FACTORS = _random.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)


def shingles(raw: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(owner, hash): the distinct shingles of each text, ordered by owner and hash."""
    t = words.Text([x.lower() for x in raw])
    start, end = t.stretches(words.SPACE)
    owner = t.owner(start)
    h = t.hashes(start, end)
    at, found = words.windows(h, owner, k)
    owners = owner[at]
    n = np.bincount(owner, minlength=t.n)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        first = np.searchsorted(owner, short)
        power, _ = words.powers(k + 1)
        whole = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            more = n[short] > j
            whole[more] += h[first[more] + j] * power[k - j]
        whole = words.mix(whole + n[short].astype(np.uint64))
        owners, found = np.concatenate([owners, short]), np.concatenate([found, whole])
    order = np.lexsort((found, owners))
    owners, found = owners[order], found[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owners[1:] != owners[:-1])
    return owners[new], found[new]


def digests(owner: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """128 bits of each set, whatever its order."""
    out = np.zeros((n, 2), np.uint64)
    np.add.at(out[:, 0], owner, words.mix(h))
    np.add.at(out[:, 1], owner, words.mix(h ^ np.uint64(0xA5A5A5A55A5A5A5A)))
    return out.view(np.int64)


def sketch(owner: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(bands, signature) of each text: 64-bit keys, and packed low bits of the minima."""
    minima = np.zeros((HASHES, n), np.uint32)
    if len(h):
        x = (h >> np.uint64(32)).astype(np.uint32)
        has, first = np.unique(owner, return_index=True)
        for j in range(HASHES):
            v = (x ^ FLIPS[j]) * FACTORS[j]
            minima[j, has] = np.minimum.reduceat(v, first)
    keys = np.zeros((BANDS, n), np.uint64)
    for b in range(BANDS):
        key = np.full(n, b + 1, np.uint64)
        for r in range(ROWS):
            key = words.mix(key * np.uint64(0x9E3779B97F4A7C15) + minima[b * ROWS + r])
        keys[b] = key
    low = (minima & ((1 << BITS) - 1)).astype(np.uint8)
    packed = low[0::2] | low[1::2] << BITS
    return keys.T.view(np.int64), np.ascontiguousarray(packed.T)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of packed signatures, row by row, corrected for chance agreement."""
    other = np.ascontiguousarray(a ^ b).view(np.uint64)
    # A position differs if any of its BITS bits does.
    some = other | other >> np.uint64(1)
    some = (some | some >> np.uint64(2)) & np.uint64(0x1111111111111111)
    equal = 1 - np.bitwise_count(some).sum(1) / HASHES
    chance = 2.0**-BITS
    return (equal - chance) / (1 - chance)


def least_estimate(similarity: float) -> float:
    """An estimate below this is too far from the similarity to be one of it."""
    chance = 2.0**-BITS
    p = similarity + (1 - similarity) * chance
    return similarity - MARGIN * float(np.sqrt(p * (1 - p) / HASHES)) / (1 - chance)


def linked(common_count: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 100 * common_count >= PERCENT * (a + b - common_count)


def _sketched(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in common.chunks(batches):
            owner, h = shingles(raw, k)
            bands, packed = sketch(owner, h, len(raw))
            digest = digests(owner, h, len(raw))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.bincount(owner, minlength=len(raw)), pa.int64()),
                    pa.array(digest[:, 0]),
                    pa.array(digest[:, 1]),
                    pa.FixedSizeListArray.from_arrays(pa.array(bands.ravel()), BANDS).cast(pa.list_(pa.int64())),
                    pa.array([x.tobytes() for x in packed], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "d1", "d2", "bands", "signature"],
            )

    return run


def _sets(k: int):
    """Shingle sets of texts whose digest is the wanted one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in common.chunks(batches):
            owner, h = shingles(raw, k)
            digest = digests(owner, h, len(raw))
            fits = (digest[:, 0] == batch.column("d1").to_numpy()) & (digest[:, 1] == batch.column("d2").to_numpy())
            at = np.searchsorted(owner, np.arange(len(raw) + 1))
            keep = np.flatnonzero(fits)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(keep)), pa.array([h[at[i] : at[i + 1]].tobytes() for i in keep], pa.binary())],
                names=["id", "shingles"],
            )

    return run


def sets_of(ids: DataFrame, classes: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """(id, shingles): the whole set of each wanted class, from its representative's text."""
    wanted = ids.select("id").distinct().join(classes.select("id", "d1", "d2"), "id").withColumnRenamed("id", "doc_id")
    found = common.only(docs, "doc_id", "text").join(wanted, "doc_id").select("doc_id", "text", "d1", "d2")
    return common.stage(found.mapInArrow(_sets(k), "id long, shingles binary").dropDuplicates(["id"]), "sets")


def likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose packed signatures do not rule a link out."""
    bound = least_estimate(PERCENT / 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("sa", "sb"))
                yield batch.select(["a", "b"]).filter(pa.array(estimate(one, two) >= bound))

    sign = classes.select("id", "signature")
    return (
        pairs.join(sign.toDF("a", "sa"), "a").join(sign.toDF("b", "sb"), "b")
        .select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")
    )


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("xa").to_pylist(), batch.column("xb").to_pylist(), strict=True):
            a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            least = PERCENT * max(len(a), len(b)) <= 100 * min(len(a), len(b))
            keep.append(least and bool(linked(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b))))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that whole sets confirm; one set moves with each pair."""
    return (
        pairs.join(sets.toDF("b", "xb"), "b").join(sets.toDF("a", "xa"), "a")
        .select("a", "b", "xa", "xb").mapInArrow(_exact, "a long, b long")
    )


def _across(rows: pd.DataFrame) -> pd.DataFrame:
    """Links between the probes and the members of a block that lie in two components:
    for each probe, one link to each component that it meets."""
    member, probe = rows[~rows["probe"]], rows[rows["probe"]]
    out: list[tuple[int, int]] = []
    if len(member) and len(probe):
        values = [np.frombuffer(x, np.uint64) for x in member["shingles"]]
        sizes = np.array([len(v) for v in values])
        flat, at = np.concatenate(values), np.repeat(np.arange(len(values)), sizes)
        order = np.argsort(flat, kind="stable")
        flat, at = flat[order], at[order]
        ids, labels = member["id"].to_numpy(), member["component"].to_numpy()
        for i, label, x in zip(probe["id"], probe["component"], probe["shingles"], strict=True):
            h = np.frombuffer(x, np.uint64)
            left, right = np.searchsorted(flat, h, "left"), np.searchsorted(flat, h, "right")
            n = right - left
            hit = np.repeat(left - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            shared = np.bincount(at[hit], minlength=len(values))
            good = np.flatnonzero(linked(shared, sizes, len(h)) & (labels != label))
            _, first = np.unique(labels[good], return_index=True)
            out += [(i, j) for j in ids[good[first]]]
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def across(groups: DataFrame, labels: DataFrame, classes: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """Links (a, b) that large buckets still hide.

    ``groups`` has (pivot, id).  Classes in the pivot's component need no look; every
    other one is compared with all classes of the group.  Members and probes are cut
    into blocks, so a task holds one block of each, however large the group is.
    """
    label = F.coalesce(F.col("component"), F.col("id"))
    pivots = labels.select(F.col("node").alias("pivot"), F.col("component").alias("at"))
    found = (
        groups.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("component", label)
        .join(pivots, "pivot", "left").withColumn("probe", F.col("component") != F.coalesce("at", "pivot"))
        .join(classes.select("id", "n_shingles"), "id")
        .select("pivot", "id", "component", "probe", "n_shingles")
    )
    found = common.stage(found, "members")
    share = lambda flag: F.ceil(F.greatest(F.sum(flag) / BLOCK_ROWS, F.sum(flag * F.col("n_shingles")) / BLOCK_SHINGLES))
    sizes = (
        found.groupBy("pivot")
        .agg(share(F.lit(1)).cast("int").alias("member_blocks"), share(F.col("probe").cast("int")).cast("int").alias("probe_blocks"))
        .filter("probe_blocks > 0")
    )
    open_ = common.stage(found.join(sizes, "pivot"), "open")
    sets = sets_of(open_, classes, docs, k)
    block = lambda n: F.pmod(F.xxhash64("id"), n)
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    columns = ["pivot", "id", "component", "probe", "mb", "pb"]
    member = open_.withColumn("probe", F.lit(False)).withColumn("mb", block(F.col("member_blocks")).cast("int")).withColumn("pb", every(F.col("probe_blocks"))).select(columns)
    probes = open_.filter("probe").withColumn("pb", block(F.col("probe_blocks")).cast("int")).withColumn("mb", every(F.col("member_blocks"))).select(columns)
    return (
        member.unionByName(probes).join(sets, "id")
        .groupBy("pivot", "mb", "pb").applyInPandas(_across, "a long, b long")
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    ``component_id`` is the least doc_id that links reach; ``kept`` holds for that one.
    Null and empty texts and texts without a word have no shingle, are linked with
    nothing and kept; so are rows without a doc_id (component null).  Repeated rows are
    one class; several texts under one doc_id are classes each.  An empty table gives an
    empty result.
    """
    rows, places = placed(docs)
    found = _near(rows.select(F.col("place").alias("doc_id"), "text"), k)
    if places is not None:
        # The least place of a component has its least doc_id.
        named = [places.toDF("doc_id", "own"), places.toDF("component_id", "least")]
        found = skew_join(skew_join(found, named[0], ["doc_id"], "left", large=True), named[1], ["component_id"], "left", large=True)
        found = found.select(F.col("own").alias("doc_id"), "n_shingles", F.col("least").alias("component_id"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return found.withColumn("kept", kept)


def _near(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row, where a doc_id stands on one text."""
    sketches = common.stage(
        common.only(docs, "doc_id", "text").mapInArrow(
            _sketched(k), "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, signature binary"
        ),
        "sketches",
    )
    classes = common.stage(
        sketches.filter("doc_id IS NOT NULL AND n_shingles > 0").groupBy("d1", "d2", "n_shingles")
        .agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands"), F.first("signature").alias("signature")),
        "classes",
    )
    rows = classes.select("id", F.explode("bands").alias("key"))
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = common.stage(rows.join(sizes, "key"), "buckets")

    small = shared.filter(F.col("size") <= SMALL).groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    pairs = (
        small.select(F.posexplode("ids").alias("i", "a"), "ids")
        .select("a", F.explode(F.expr("slice(ids, i + 2, size(ids))")).alias("b"))
    )
    # The class in the largest buckets is likely the one that the others derive from.
    large = shared.filter(F.col("size") > SMALL)
    weight = shared.groupBy("id").agg(F.sum("size").alias("weight"))
    pivots = (
        large.join(weight, "id").groupBy("key")
        .agg(F.max(F.struct("weight", (-F.col("id")).alias("minus"))).alias("best"))
        .select("key", (-F.col("best.minus")).alias("pivot"))
    )
    groups = common.stage(large.join(pivots, "key").select("pivot", "id").distinct(), "groups")
    stars = groups.filter("pivot <> id").select(F.least("pivot", "id").alias("a"), F.greatest("pivot", "id").alias("b"))
    candidates = common.stage(likely(pairs.unionByName(stars).distinct(), classes), "candidates")
    sets = sets_of(
        candidates.select(F.col("a").alias("id")).unionByName(candidates.select(F.col("b").alias("id"))), classes, docs, k
    )
    links = common.stage(confirmed(candidates, sets), "links")
    more = common.stage(across(groups, components(links), classes, docs, k), "more")
    found = components(links.unionByName(more))

    named = classes.join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "d1", "d2", "n_shingles", F.coalesce("component", "id").alias("component")
    )
    return (
        sketches.select("doc_id", "n_shingles", "d1", "d2").join(named, ["d1", "d2", "n_shingles"], "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")))
        .select("doc_id", "n_shingles", "component_id")
    )


def one_of_each(spark: SparkSession, docs: DataFrame, k: int = 5) -> DataFrame:
    """The rows of ``docs`` that represent their group, with all their columns.

    Rows are told apart by a number of their own, so copies go whether they have the same
    doc_id, another one or none; the one with the least doc_id stays, any of several such.
    Rows without a word, null or empty ones too, are linked with nothing and all stay.  An
    empty table stays empty.
    """
    number = next(c for n in range(len(docs.columns) + 1) if (c := f"_row{n}") not in docs.columns)
    rows = common.stage(docs.withColumn(number, F.monotonically_increasing_id()), "rows")
    found = _near(rows.select(F.col(number).alias("doc_id"), "text"), k).select(F.col("doc_id").alias(number), "component_id")
    doc_id = common.only(rows, number, "doc_id")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", number))
    kept = found.join(doc_id, number).groupBy("component_id").agg(best.alias("best")).select(F.col(f"best.{number}").alias(number))
    return rows.join(kept, number, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, common.table(spark, sf_dir, "documents"))
