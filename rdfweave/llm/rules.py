"""Quality rules of documents, judged again by host with shrunken failure rates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rdfweave.llm import common, words
from rdfweave.operators.scale import skew_join

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: A host is refused if its shrunken rate of failures is above this.
HOST_RATE = 0.5
#: Host tables up to this many rows are broadcast (some tens of bytes each).
BROADCAST_HOSTS = 50_000


def measure(raw: list[bytes]) -> dict[str, np.ndarray]:
    """The five measures of each text; a line or window is equal by its 64-bit hash."""
    t = words.Text(raw, b"\n")
    start, end = t.stretches(words.SPACE)
    owner = t.owner(start)
    out = {"n_words": np.bincount(owner, minlength=t.n)}
    out["word_chars"] = t.per_text(~words.SPACE[t.bytes] & ((t.bytes & 0xC0) != 0x80))
    out["n_symbols"] = t.per_text(SYMBOLS[t.bytes])

    line_end = np.flatnonzero(t.bytes == 10)
    line_start = np.concatenate([[0], line_end[:-1] + 1])
    has_word = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
    line_start, line_end = line_start[has_word], line_end[has_word]
    line_owner = t.owner(line_start)
    _, later = words.repeated(words.owned(t.hashes(line_start, line_end), line_owner))
    out["n_dup_lines"] = np.bincount(line_owner[later], minlength=t.n)

    at, h = words.windows(t.hashes(start, end), owner, WINDOW)
    twice, _ = words.repeated(words.owned(h, owner[at]))
    cover = np.zeros(len(start) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + WINDOW, -1)
    out["n_repeat_words"] = np.bincount(owner[np.cumsum(cover[:-1]) > 0], minlength=t.n)
    return out


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, raw in common.chunks(batches):
        got = measure(raw)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("source").cast(pa.string()), *[pa.array(got[m], pa.int64()) for m in MEASURES]],
            names=["doc_id", "source", *MEASURES],
        )


def base_rules(docs: DataFrame) -> DataFrame:
    """(doc_id, source, measures, base_failed) of every row."""
    measured = common.only(docs, "doc_id", "source", "text").mapInArrow(
        _measured, "doc_id long, source string, " + ", ".join(f"{m} long" for m in MEASURES)
    )
    return measured.withColumn(
        "base_failed", F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words")
    )


def host_rates(judged: DataFrame) -> DataFrame:
    """Failure rate of each host, shrunk towards the rates of all hosts.

    A beta prior is fitted by moments to the hosts' rates: the mean is weighted by rows,
    the spread is what exceeds the noise of rates over so few rows.  Only sums over all
    hosts leave the aggregation.  Rows without a host belong to none.
    """
    hosts = (
        judged.filter(F.col("source").isNotNull())
        .groupBy("source")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("k"))
    )
    total = hosts.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum("n").alias("n"),
        F.sum("k").alias("k"),
        F.sum(F.expr("cast(k AS double) * k / n")).alias("kkn"),
        F.sum(F.expr("cast(n AS double) * n")).alias("nn"),
    ).first()
    mean, weight = beta_prior(*[x or 0 for x in total])
    return hosts.select(
        "source", "n", "k", ((F.col("k") + mean * weight) / (F.col("n") + weight)).alias("rate")
    )


def beta_prior(hosts: float, n: float, k: float, kkn: float, nn: float) -> tuple[float, float]:
    """Mean and weight (in rows) of the prior, from sums over the hosts.

    The variance between hosts is what the weighted squares have beyond p (1 - p) / n.
    Without any, all hosts are alike and the prior weighs as much as all rows.
    """
    if not n:
        return 0.0, 1.0
    p, spare = k / n, n - nn / n
    between = max((kkn - n * p * p - (hosts - 1) * p * (1 - p)) / spare, 0) if spare > 0 else 0
    return p, max(p * (1 - p) / between - 1, 1) if between > 0 and 0 < p < 1 else n


def judge(spark: SparkSession, docs: DataFrame, host_rate: float = HOST_RATE) -> DataFrame:
    """Every row with its measures, ``base_failed``, ``host_rate`` and ``kept``.

    Null texts are empty and fail; null sources have no host and only the base rules;
    repeated rows count as rows; an empty table gives an empty result.
    """
    judged = common.stage(base_rules(docs), "rules")
    hosts = common.stage(host_rates(judged).select("source", F.col("rate").alias("host_rate")), "hosts")
    if hosts.count() <= BROADCAST_HOSTS:
        joined = judged.join(F.broadcast(hosts), "source", "left")
    else:
        joined = skew_join(judged, hosts, ["source"], "left", large=True)
    return joined.withColumn("kept", F.expr(f"NOT base_failed AND coalesce(host_rate <= {host_rate}, true)"))


def op9_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark, common.table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


OP9_SQL = r"""
WITH word AS (
  SELECT doc_id, i, w FROM (
    SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
    FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents))
), counted AS (
  SELECT doc_id, count(*) AS n_words, sum(length(w)) AS word_chars FROM word GROUP BY doc_id
), line AS (
  SELECT doc_id, sum(c - 1) AS n_dup_lines FROM (
    SELECT doc_id, l, count(*) AS c FROM (
      SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l FROM documents)
    WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id, l) GROUP BY doc_id
), win AS (
  SELECT doc_id, i, string_agg(w, ' ') OVER win8 AS s, count(*) OVER win8 AS c FROM word
  WINDOW win8 AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM win WHERE c = 8) WHERE c > 1
), rep AS (
  SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words FROM twice, range(8) AS r(o) GROUP BY doc_id
), base AS (
  SELECT d.doc_id, d.source, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
    length(regexp_replace(coalesce(d.text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM documents d LEFT JOIN counted USING (doc_id) LEFT JOIN line USING (doc_id) LEFT JOIN rep USING (doc_id)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base
), host AS (
  SELECT source, count(*) AS n, sum(base_failed::BIGINT) AS k FROM judged WHERE source IS NOT NULL GROUP BY source
), total AS (
  SELECT count(*) AS h, sum(n)::DOUBLE AS n, sum(k)::DOUBLE / sum(n) AS p, sum(k::DOUBLE * k / n) AS kkn, sum(n::DOUBLE * n) AS nn FROM host
), spread AS (
  SELECT n, p, greatest((kkn - n * p * p - (h - 1) * p * (1 - p)) / nullif(n - nn / n, 0), 0) AS b FROM total
), prior AS (
  SELECT p AS mean, CASE WHEN p > 0 AND p < 1 AND b > 0 THEN greatest(p * (1 - p) / b - 1, 1) ELSE n END AS weight FROM spread
), rate AS (
  SELECT source, (k + mean * weight) / (n + weight) AS rate FROM host, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(rate <= 0.5, true) AS kept
FROM judged LEFT JOIN rate USING (source)
"""
