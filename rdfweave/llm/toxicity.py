"""Toxicity from confirmed examples and unlabelled text: non-negative risk estimation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rdfweave.llm import common, words
from rdfweave.llm.boosting import sigmoid

#: Rows that the model is fitted on: those with the least hash of doc_id.
CONFIRMED_ROWS = 4_000
UNLABELLED_ROWS = 12_000
#: A word counts as a whole and by its first bytes, so that inflected forms meet.
PREFIXES = (4, 5, 6, 8)
#: A feature is used if it is LIFT times as frequent in toxic as in all text (at most half
#: of what the prior allows), and in LEAST toxic texts.
LIFT, LEAST = 4.0, 3
THRESHOLD = 0.5


def features(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(owner, hash): the distinct words and word beginnings of each text, by owner."""
    t = words.Text([x.lower() for x in raw])
    start, end = t.stretches(words.NOT_WORD)
    owner = t.owner(start)
    found, owners = [t.hashes(start, end)], [owner]
    for k in PREFIXES:
        long = end - start > k
        found.append(t.hashes(start[long], start[long] + k) + np.uint64(k))
        owners.append(owner[long])
    h, o = np.concatenate(found), np.concatenate(owners)
    _, later = words.repeated(words.owned(h, o))
    h, o = h[~later], o[~later]
    order = np.argsort(o, kind="stable")
    return o[order], h[order]


@dataclass
class Linear:
    known: np.ndarray  # sorted hashes of the features in use
    weight: np.ndarray
    bias: float

    def columns(self, owner: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(owner, column) of the features in use."""
        if not len(self.known):
            return owner[:0], np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        hit = self.known[at] == h
        return owner[hit], at[hit]

    def score(self, raw: list[bytes]) -> np.ndarray:
        owner, column = self.columns(*features(raw))
        return sigmoid(np.bincount(owner, self.weight[column], len(raw)) + self.bias)


def train(
    known: np.ndarray, confirmed: list[np.ndarray], unlabelled: list[np.ndarray], prior: float,
    steps: int = 600, rate: float = 0.1, ridge: float = 1e-3,
) -> Linear:
    """Minimise prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)) by Adam on all rows.

    A row holds the indexes of its features among ``known``.  The losses are sigmoid
    losses.  Where the corrected negative risk falls below zero, the step goes the other
    way, as the non-negative estimator prescribes.
    """
    m = len(known)
    if not m or not confirmed or not unlabelled:
        return Linear(known[:0], np.zeros(0), -1.0)
    flat = lambda rows: (np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate(rows).astype(np.int64))
    (po, pc), (uo, uc) = flat(confirmed), flat(unlabelled)
    w, b = np.full(m, 0.5), -1.0
    moment, square = np.zeros(m + 1), np.zeros(m + 1)
    for step in range(1, steps + 1):
        sp = sigmoid(np.bincount(po, w[pc], len(confirmed)) + b)
        su = sigmoid(np.bincount(uo, w[uc], len(unlabelled)) + b)
        dp, du = sp * (1 - sp) / len(confirmed), su * (1 - su) / len(unlabelled)
        negative = su.mean() - prior * sp.mean()
        # Gradients of R_p(+) = mean(1 - sp), R_u(-) = mean(su) and R_p(-) = mean(sp).
        sign, plus = (1.0, 1.0) if negative >= 0 else (-1.0, 0.0)
        gp, gu = -plus * prior * dp - sign * prior * dp, sign * du
        g = np.bincount(pc, gp[po], m) + np.bincount(uc, gu[uo], m) + ridge * w / m
        g = np.append(g, gp.sum() + gu.sum())
        moment, square = 0.9 * moment + 0.1 * g, 0.999 * square + 0.001 * g * g
        move = rate * moment / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return Linear(known, w, float(b))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, confirmed, unlabelled): in how many rows of a chunk each feature is."""
    for batch, raw in common.chunks(batches):
        flag = batch.column("confirmed").to_numpy()
        owner, h = features(raw)
        name, at = np.unique(h, return_inverse=True)
        toxic = np.bincount(at[flag[owner] == 1], minlength=len(name))
        rest = np.bincount(at[flag[owner] == 0], minlength=len(name))
        yield pa.RecordBatch.from_arrays(
            [pa.array(name.view(np.int64)), pa.array(toxic, pa.int64()), pa.array(rest, pa.int64())],
            names=["feature", "confirmed", "unlabelled"],
        )


def fit(
    docs: DataFrame, labels: DataFrame, confirmed_rows: int = CONFIRMED_ROWS, unlabelled_rows: int = UNLABELLED_ROWS
) -> Linear:
    """A model from bounded samples of confirmed toxic and of unlabelled rows.

    The class prior is the share of toxic among all labelled rows of the training folds.
    The unlabelled rows are drawn from the training folds, whatever their label is.
    Features are chosen by counts over the samples, and only those reach the driver.
    """
    nothing = Linear(np.zeros(0, np.uint64), np.zeros(0), -1.0)
    labels = common.training_labels(labels, "toxic")
    total, toxic = labels.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not toxic:
        return nothing
    prior = toxic / total
    rows = common.only(docs, "doc_id", "text").filter(F.col("doc_id").isNotNull() & ~common.held_out(F.col("doc_id")))
    drawn = lambda ids, n, flag: common.sample(ids.select("doc_id").distinct(), n, "doc_id").withColumn("confirmed", F.lit(flag))
    # Ids first: texts are read only for the rows of the samples, whose number is bounded.
    chosen = common.stage(
        drawn(rows.select("doc_id").join(labels.filter("label = 1"), "doc_id", "left_semi"), confirmed_rows, 1)
        .unionByName(drawn(rows, unlabelled_rows, 0)),
        "chosen",
    )
    texts = common.stage(rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "confirmed", "text"), "texts")
    sizes = {r["confirmed"]: r["count"] for r in texts.groupBy("confirmed").count().collect()}
    if len(sizes) < 2:
        return nothing
    lift = F.expr(f"(confirmed / {sizes[1]}) / ((unlabelled + 1) / {sizes[0] + 1})")
    known = np.sort(np.array([
        r["feature"]
        for r in texts.mapInArrow(_counted, "feature long, confirmed long, unlabelled long")
        .groupBy("feature").agg(F.sum("confirmed").alias("confirmed"), F.sum("unlabelled").alias("unlabelled"))
        .filter((F.col("confirmed") >= LEAST) & (lift >= min(LIFT, 0.5 / prior)))
        .select("feature").collect()
    ], np.int64).view(np.uint64))

    def used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Linear(known, np.zeros(len(known)), 0.0)
        for batch, raw in common.chunks(batches):
            owner, column = model.columns(*features(raw))
            at = np.searchsorted(owner, np.arange(len(raw) + 1))
            found = [column[at[i] : at[i + 1]].astype(np.int32).tobytes() for i in range(len(raw))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("confirmed"), pa.array(found, pa.binary())], names=["doc_id", "confirmed", "used"]
            )

    split: tuple[list, list] = ([], [])
    for row in sorted(texts.mapInArrow(used, "doc_id long, confirmed int, used binary").collect()):
        split[row["confirmed"]].append(np.frombuffer(bytes(row["used"]), np.int32))
    return train(known, split[1], split[0], prior)


def scored(docs: DataFrame, model: Linear) -> DataFrame:
    """(doc_id, score) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in common.chunks(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(raw))], names=["doc_id", "score"])

    return common.only(docs, "doc_id", "text").mapInArrow(run, "doc_id long, score double")


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    Null texts are empty texts; rows without a doc_id are scored and not held out;
    repeated rows get equal scores; without confirmed examples nothing is predicted
    toxic; an empty table gives an empty result.
    """
    return scored(docs, fit(docs, labels)).select(
        "doc_id",
        common.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def without_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    model = fit(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in common.chunks(batches):
            yield batch.filter(pa.array(model.score(raw) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(spark, common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
