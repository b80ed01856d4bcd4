"""Document quality: boosted trees over statistics of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rdfweave.llm import boosting, common, words

#: Labelled rows that the model is fitted on: those with the least hash of doc_id.
TRAINING_ROWS = 20_000
THRESHOLD = 0.3
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "space": b" \t\x0b\x0c\r",
    "stop": b".",
    "comma": b",;:",
    "loud": b"!?",
    "pipe": b"|",
    "symbol": b"#*$%&<>",
    "bracket": b"()[]{}=\"'/\\_+-@^~`",
}
STATISTICS = [
    "log_words", "word_length", "long_word", "distinct_words", "lines", "line_words", "dup_lines",
    "repeat_2", "repeat_4", "repeat_8", "same_as_previous", "high_bytes", *CLASSES,
]


def _table(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


TABLES = {k: _table(v) for k, v in CLASSES.items()}


def statistics(raw: list[bytes]) -> np.ndarray:
    """One row of STATISTICS for each text; an empty text has zeros."""
    t = words.Text([x.strip() for x in raw], b"\n")
    start, end = t.stretches(words.SPACE)
    owner = t.owner(start)
    n = np.bincount(owner, minlength=t.n)
    per_word = np.maximum(n, 1)
    size = np.maximum(t.sizes, 1)
    count = lambda flags, of=owner: np.bincount(of[flags], minlength=t.n)
    h = t.hashes(start, end)
    _, seen = words.repeated(words.owned(h, owner))
    length = end - start
    line_end = np.flatnonzero(t.bytes == 10)
    line_start = np.concatenate([[0], line_end[:-1] + 1])
    line_owner = t.owner(line_start)
    lines = np.bincount(line_owner, minlength=t.n)
    _, dup = words.repeated(words.owned(t.hashes(line_start, line_end), line_owner))
    out = {
        "log_words": np.log1p(n),
        "word_length": np.bincount(owner, length, t.n) / per_word,
        "long_word": count(length > 20) / per_word,
        "distinct_words": 1 - count(seen) / per_word,
        "lines": np.log1p(lines),
        "line_words": n / np.maximum(lines, 1),
        "dup_lines": count(dup, line_owner) / np.maximum(lines, 1),
        "same_as_previous": count(np.concatenate([[False], (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])])[: len(h)]) / per_word,
        "high_bytes": t.per_text(t.bytes > 127) / size,
    }
    for k in (2, 4, 8):
        at, w = words.windows(h, owner, k)
        _, later = words.repeated(words.owned(w, owner[at]))
        out[f"repeat_{k}"] = np.bincount(owner[at][later], minlength=t.n) / per_word
    for name, member in TABLES.items():
        out[name] = t.per_text(member[t.bytes]) / (per_word if name in ("symbol", "pipe", "loud") else size)
    return np.stack([out[s] for s in STATISTICS], 1).astype(np.float32)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, raw in common.chunks(batches):
        got = statistics(raw)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(got[:, i]) for i in range(got.shape[1])]], names=["doc_id", *STATISTICS]
        )


def measured(docs: DataFrame) -> DataFrame:
    return common.only(docs, "doc_id", "text").mapInArrow(
        _measured, "doc_id long, " + ", ".join(f"{s} float" for s in STATISTICS)
    )


def fit(rows: DataFrame, labels: DataFrame, limit: int = TRAINING_ROWS) -> boosting.Forest:
    """Trees fitted on the statistics of about ``limit`` labelled rows of the training folds."""
    labelled = rows.join(common.training_labels(labels, "quality"), "doc_id")
    sample = common.sample(labelled, limit, "doc_id").toPandas().sort_values(["doc_id", *STATISTICS])
    return boosting.train(sample[STATISTICS].to_numpy(np.float32), sample["label"].to_numpy(float))


def score(rows: DataFrame, model: boosting.Forest) -> DataFrame:
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(s).to_numpy() for s in STATISTICS], 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"])

    return rows.mapInArrow(scored, "doc_id long, score double")


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, limit: int = TRAINING_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    Null texts are empty texts and are scored like them; rows without a doc_id are scored
    and not held out; repeated rows get equal scores; without usable labels every score
    is 0.5; an empty table gives an empty result.
    """
    rows = common.stage(measured(docs), "statistics")
    return score(rows, fit(rows, labels, limit)).select(
        "doc_id",
        common.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op5_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(spark, common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
