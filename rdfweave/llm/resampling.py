"""Documents drawn by how much more their n-grams belong to a target than to the corpus.

Newlines cut texts into lines.  A line that occurs many times is one segment: its
features are computed once, and their counts are multiplied by its occurrences.
Features whose words lie on more than one line are added for each text.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rdfweave.llm import common
from rdfweave.llm.order import numbered
from rdfweave.llm.twins import crc32_sql

BUCKETS = 10_000
#: Share of the eligible documents that is drawn, in hundredths, and how many words make one eligible.
DRAWN, LEAST_WORDS = 5, 20
SEED = 42
#: A segment with more than this share of all link rows is looked up apart: fewer than 1/share of them exist.
HOT_SHARE = 1 / 4096

# A-Z are lowered, every other ASCII byte that is no letter or digit but the newline parts words.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() or c == 10 else 32 for c in range(256))


def segments(raw: bytes) -> list[list[bytes]]:
    """The words of each line that has any."""
    return [words for line in raw.translate(_PLAIN).split(b"\n") if (words := line.split())]


def _prefixed(words: list[bytes]) -> list[bytes]:
    return [b" " + w for w in words]


def features(words: list[bytes], buckets: int = BUCKETS) -> list[int]:
    """Buckets of all runs of one to three words; a longer run goes on from the shorter one's checksum."""
    one, rest = list(map(zlib.crc32, words)), _prefixed(words[1:])
    two = list(map(zlib.crc32, rest, one))
    three = list(map(zlib.crc32, rest[1:], two))
    return [c % buckets for c in (*one, *two, *three)]


def crossing(lines: list[list[bytes]], buckets: int = BUCKETS) -> list[int]:
    """Buckets of the runs of two and three words that do not lie on one line."""
    out = []
    for n in range(len(lines) - 1):
        # Runs are taken where they leave line n: its last words and the next two words.
        last, after = lines[n][-2:], lines[n + 1][:2]
        if len(after) < 2 and n + 2 < len(lines):
            after = after + lines[n + 2][:1]
        if len(last) == 2:
            out.append(zlib.crc32(b" ".join([*last, after[0]])))
        out.append(two := zlib.crc32(b" ".join([last[-1], after[0]])))
        if len(after) == 2:
            out.append(zlib.crc32(b" " + after[1], two))
    return [c % buckets for c in out]


def _key(words: list[bytes]) -> tuple[bytes, bytes]:
    text = b" ".join(words)
    return blake2b(text, digest_size=16).digest(), text


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(segment, words, occurrences): the distinct lines of each chunk of texts."""
    for _, raw in common.chunks(batches):
        found = Counter(_key(words) for x in raw for words in segments(x))
        keys = list(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in keys], pa.binary()), pa.array([w for _, w in keys], pa.binary()), pa.array(list(found.values()), pa.int64())],
            names=["segment", "words", "occurrences"],
        )


def distinct(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(segment, chunks, occurrences, features): every distinct line of all texts, computed once.

    ``features`` holds the buckets in order, two or four bytes each.
    """
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in common.chunks(batches, "words"):
            found = pa.array([np.sort(np.array(features(x.split(b" "), buckets), kind)).tobytes() for x in raw], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("segment"), batch.column("chunks"), batch.column("occurrences"), found],
                names=["segment", "chunks", "occurrences", "features"],
            )

    once = (
        common.only(docs, "doc_id", "text").mapInArrow(_segments, "segment binary, words binary, occurrences long")
        .groupBy("segment")
        .agg(F.first("words").alias("words"), F.count(F.lit(1)).alias("chunks"), F.sum("occurrences").alias("occurrences"))
    )
    return common.stage(once.mapInArrow(run, "segment binary, chunks long, occurrences long, features binary"), "distinct", "zstd")


_CUT = pa.schema(
    [
        ("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("crossing", pa.binary()),
        ("segment", pa.binary()), ("rows", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())),
    ]
)
_CUT_SQL = "row long, doc_id long, n_words long, crossing binary, segment binary, rows array<long>, times array<long>"


def _cut(buckets: int):
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        for batch, raw in common.chunks(batches):
            docs: list[tuple] = []
            found: dict[bytes, dict[int, int]] = {}
            for doc_id, x in zip(batch.column("doc_id").to_pylist(), raw, strict=True):
                lines = segments(x)
                docs.append((row, doc_id, sum(map(len, lines)), np.array(crossing(lines, buckets), kind).tobytes()))
                for words in lines:
                    links = found.setdefault(_key(words)[0], {})
                    links[row] = links.get(row, 0) + 1
                row += 1
            values = [*map(list, zip(*docs, strict=True)), list(found), [list(x) for x in found.values()], [list(x.values()) for x in found.values()]]
            n, m = len(docs), len(found)
            columns = [v + [None] * m if i < 4 else [None] * n + v for i, v in enumerate(values)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _CUT, strict=True)], schema=_CUT)

    return run


def cut(docs: DataFrame, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """Rows (row, doc_id, n_words, crossing) of texts, and links (segment, rows, times).

    A segment has one link row for each chunk of texts that holds it, however often it
    stands there.  ``row`` names the row of a text; both come from one staged pass.
    """
    both = common.stage(common.only(docs, "doc_id", "text").mapInArrow(_cut(buckets), _CUT_SQL), "links", "zstd")
    texts = both.filter("row IS NOT NULL").select("row", "doc_id", "n_words", "crossing")
    return texts, both.filter("segment IS NOT NULL").select("segment", "rows", "times")


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def _flat(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets in an array of bytes, and the row of each."""
    raw = column.to_pylist()
    values = np.frombuffer(b"".join(raw), _kind(buckets))
    return values, np.repeat(np.arange(len(raw)), [len(x) // values.itemsize for x in raw])


def _summed(rows: DataFrame, column: str, times: str | None, buckets: int) -> DataFrame:
    """(bucket, n): how often the features occur; a task sends one row per bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            values, owner = _flat(batch.column(0), buckets)
            weights = None if times is None else batch.column(1).to_numpy()[owner]
            np.add.at(total, values, 1 if weights is None else weights)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return rows.select(column, *([times] if times else [])).mapInArrow(run, "bucket long, n long")


def counts(texts: DataFrame, segments: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket; one number per bucket leaves Spark."""
    parts = _summed(segments, "features", "occurrences", buckets).unionByName(_summed(texts, "crossing", None, buckets))
    out = np.zeros(buckets, np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of how much more likely a bucket is in the target; one is added to every count."""
    n, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)],
        np.int64,
    )


def _gained(rows: DataFrame, column: str, gain: np.ndarray) -> DataFrame:
    """``rows`` with the sum of the gains of their features in the place of these."""
    keep = [c for c in rows.columns if c != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, owner = _flat(batch.column(column), len(gain))
            out = np.zeros(batch.num_rows, np.int64)
            np.add.at(out, owner, gain[values])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(out)], names=[*keep, "gain"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != column)
    return rows.mapInArrow(run, f"{schema}, gain long")


def weights(texts: DataFrame, links: DataFrame, segments: DataFrame, gain: np.ndarray) -> DataFrame:
    """(row, doc_id, n_words, weight): every text with the sum of its features' gains.

    Segments in very many chunks are few (at most 1 / ``HOT_SHARE``), so they are broadcast;
    no other segment has a notable share of the links.
    """
    gained = common.stage(_gained(segments.select("segment", "chunks", "features"), "features", gain), "gains")
    bound = max(1.0, (gained.agg(F.sum("chunks")).first()[0] or 0) * HOT_SHARE)
    frequent = F.col("chunks") > bound
    known = links.select("segment", "rows", "times")
    few = F.broadcast(gained.filter(frequent).select("segment", F.col("gain").alias("_gain")))
    marked = known.join(few, "segment", "left")
    rest = marked.filter("_gain IS NULL").drop("_gain").join(gained.filter(~frequent).select("segment", F.col("gain").alias("_gain")), "segment")
    linked = marked.filter("_gain IS NOT NULL").unionByName(rest)
    parts = linked.select("_gain", F.explode(F.arrays_zip("rows", "times")).alias("x")).select(
        F.col("x.rows").alias("row"), (F.col("x.times") * F.col("_gain")).alias("gain")
    )
    own = _gained(texts, "crossing", gain)
    nothing = [F.lit(None).cast("long").alias(c) for c in ("doc_id", "n_words")]
    return (
        own.unionByName(parts.select("row", *nothing, "gain"))
        .groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.sum("gain").alias("weight"))
    )


def gumbel(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variable that follows from the seed and the doc_id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    return F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame, target: DataFrame, share: int = DRAWN, least_words: int = LEAST_WORDS, seed: int = SEED, buckets: int = BUCKETS
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``.

    ``share`` hundredths of the rows with ``least_words`` words are drawn: those with the
    highest scores, ranked from 1; ``rank`` is null elsewhere.  Null and empty texts have
    no features, weight 0 and no rank.  A null doc_id is scored as an empty one and comes
    last among equals; repeated rows are scored and ranked each.  Empty tables give an
    empty result, an empty target counts as one of equal buckets.  Other columns than
    ``doc_id`` and ``text`` are not read.
    """
    found = distinct(docs, buckets)
    texts, links = cut(docs, buckets)
    wanted = target.select(F.lit(None).cast("long").alias("doc_id"), "text")
    gain = gains(counts(texts, found, buckets), counts(cut(wanted, buckets)[0], distinct(wanted, buckets), buckets))
    n = F.col("n_words")
    scored = common.stage(
        weights(texts, links, found, gain)
        .withColumn("n_features", n + F.greatest(n - 1, F.lit(0)) + F.greatest(n - 2, F.lit(0)))
        .withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
        .select("doc_id", "n_features", "weight", "score", (n >= least_words).alias("_eligible")),
        "scored",
    )
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "n_features"]
    placed = numbered(scored.filter("_eligible"), [], order)
    rank = F.when(F.col("i") < F.expr(f"{share} * n div 100"), F.col("i") + 1).cast("long")
    names = ["doc_id", "n_features", "weight", "score"]
    others = scored.filter("NOT _eligible").select(*names, F.lit(None).cast("long").alias("rank"))
    return placed.select(*names, rank.alias("rank")).unionByName(others)


def op12_segment_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


OP12_SQL = rf"""
WITH texts AS (
  SELECT true AS own, row_number() OVER () AS r, doc_id, text FROM documents
  UNION ALL SELECT false, row_number() OVER (), NULL, text FROM benchmark
), word AS (
  SELECT own, r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (
    SELECT own, r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM texts)
), run AS (
  SELECT own, r, w, w || ' ' || lead(w) OVER o AS w2, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS w3
  FROM word WINDOW o AS (PARTITION BY own, r ORDER BY i)
), feature AS (
  SELECT own, r, f, count(*) AS n FROM (
    SELECT own, r, w AS f FROM run UNION ALL SELECT own, r, w2 FROM run UNION ALL SELECT own, r, w3 FROM run)
  WHERE f IS NOT NULL GROUP BY own, r, f
), crc_of AS (
  SELECT DISTINCT f AS v FROM feature
), {crc32_sql("crc").strip()}, dealt AS (
  SELECT own, r, crc % {BUCKETS} AS b, sum(n) AS n FROM feature JOIN crc ON f = v GROUP BY own, r, b
), bucket AS (
  SELECT b, coalesce(sum(n) FILTER (own), 0) AS s, coalesce(sum(n) FILTER (NOT own), 0) AS t FROM dealt GROUP BY b
), total AS (
  SELECT coalesce(sum(s), 0)::DOUBLE AS s_all, coalesce(sum(t), 0)::DOUBLE AS t_all FROM bucket
), gain AS (
  SELECT b, floor(1000 * ln((t + 1)::DOUBLE * (s_all + {BUCKETS}) / ((s + 1)::DOUBLE * (t_all + {BUCKETS}))))::BIGINT AS g FROM bucket, total
), weight AS (
  SELECT r, sum(n)::BIGINT AS n_features, sum(n * g)::BIGINT AS weight FROM dealt JOIN gain USING (b) WHERE own GROUP BY r
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score,
    coalesce(n_features, 0) >= 3 * {LEAST_WORDS} - 3 AS eligible
  FROM texts LEFT JOIN weight USING (r) WHERE own
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY eligible ORDER BY score DESC, doc_id, n_features) AS i, count(*) OVER (PARTITION BY eligible) AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN eligible AND i <= {DRAWN} * n // 100 THEN i END AS rank FROM placed
"""
