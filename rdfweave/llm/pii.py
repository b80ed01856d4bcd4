"""Personal data, and terms that give it away by how often they stand beside it."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rdfweave.llm import common, words

KINDS = ("email", "ip", "card", "phone")
#: Kinds that the method adds: a term that is removed, a term that is generalised.
TERMS = ("term", "general")
#: Words on either side of personal data that count as beside it.
CONTEXT = 8
#: Distinct contexts in which a term must stand beside the same value.
SUPPORT = 3
#: Share of a value's information that a term may disclose before it is generalised, removed.
GENERALISE, REMOVE = 0.8, 0.95

LOCAL, DOMAIN = "A-Za-z0-9._%+-", "[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)+"
# A match begins where its run begins, or where the match before it ended: starts inside
# a run would meet the same end, so long runs are read once.
EMAIL = re.compile(f"[{LOCAL}]++@{DOMAIN}")
EMAIL_RUN = re.compile(f"(?<![{LOCAL}])[{LOCAL}]++@{DOMAIN}")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while True:
        m = (at and EMAIL.match(text, at)) or EMAIL_RUN.search(text, at)
        if not m:
            return
        yield m.span()
        at = m.end()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, ordered."""
    out: list[tuple[int, int, int]] = []
    if "@" in text:
        out += [(a, 0, b) for a, b in emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(int(p) <= 255 if len(p) < 20 else not p.strip("0") or int(p[-20:]) <= 255 and not p[:-3].strip("0") for p in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(DIGIT.findall(m.group())) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def named(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{(*KINDS, *TERMS)[k]}:{a}:{b}" for a, k, b in spans)


def value_hash(kind: int, value: str) -> int:
    """Values of one kind that differ only in punctuation or case are one."""
    plain = value.lower() if kind < 2 else "".join(DIGIT.findall(value))
    return int.from_bytes(hashlib.blake2b(f"{kind}:{plain}".encode(), digest_size=8).digest(), "little", signed=True)


def group_of(kind: int, value: str) -> str:
    """What a value has in common with others of its kind: mail domain, network, issuer,
    country and area."""
    if kind == 0:
        return value.rsplit("@", 1)[1].lower()
    if kind == 1:
        return ".".join(value.split(".")[:2])
    digits = "".join(DIGIT.findall(value))
    return digits[:6] if kind == 2 else digits[:4]


def entities(kind: int, value: str) -> list[int]:
    """The protected entities that a value stands for: itself, and the group it is one of."""
    group = int.from_bytes(hashlib.blake2b(f"group {kind}:{group_of(kind, value)}".encode(), digest_size=8).digest(), "little", signed=True)
    return [value_hash(kind, value), group]


class Terms:
    """Words of one text as runs of letters and digits, placed by code points."""

    def __init__(self, text: str) -> None:
        raw = text.encode("utf-8", "replace")
        # Only A to Z is lowered, so positions stay.
        self.text = words.Text([raw.lower()])
        start, end = self.text.stretches(words.NOT_WORD)
        self.hash = self.text.hashes(start, end).view(np.int64)
        points = np.concatenate([[0], np.cumsum((self.text.bytes & 0xC0) != 0x80)])
        self.start, self.end = points[start], points[end]


def contexts(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(value, term, context) hashes: the words beside each base span."""
    if not spans:
        return []
    t = Terms(text)
    inside = np.zeros(len(t.start), bool)
    for a, _, b in spans:
        inside |= (t.start < b) & (t.end > a)
    letters = (t.end - t.start >= 3) & ~inside
    out = set()
    for a, k, b in spans:
        left, right = np.searchsorted(t.end, a, "right"), np.searchsorted(t.start, b, "left")
        near = np.concatenate([np.arange(max(0, left - CONTEXT), left), np.arange(right, min(len(t.start), right + CONTEXT))])
        near = near[letters[near]]
        context = int(words.mix(np.bitwise_xor.reduce(words.mix(t.hash[near].view(np.uint64)), initial=np.uint64(0)).reshape(1)).view(np.int64)[0])
        out.update((value, int(h), context) for value in entities(k, text[a:b]) for h in t.hash[near])
    return sorted(out)


PAIR = pa.struct([("value", pa.int64()), ("term", pa.int64()), ("context", pa.int64())])


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, raw in common.chunks(batches):
        values, pairs = [], []
        for x in raw:
            text = x.decode("utf-8", "replace")
            spans = base_spans(text)
            values.append(sorted({e for a, k, b in spans for e in entities(k, text[a:b])}))
            pairs.append([dict(zip(("value", "term", "context"), p, strict=True)) for p in contexts(text, spans)])
        yield pa.RecordBatch.from_arrays([pa.array(values, pa.list_(pa.int64())), pa.array(pairs, pa.list_(PAIR))], names=["found", "pairs"])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, texts): in how many texts of a chunk each word stands."""
    for _, raw in common.chunks(batches):
        t = words.Text([x.lower() for x in raw])
        start, end = t.stretches(words.NOT_WORD)
        start, end = start[end - start >= 3], end[end - start >= 3]
        h = t.hashes(start, end)
        _, later = words.repeated(words.owned(h, t.owner(start)))
        term, texts = np.unique(h[~later], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(texts)], names=["term", "texts"])


FOUND = "found array<long>, pairs array<struct<value:long,term:long,context:long>>"


def disclosing(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(value, term, action): terms that reveal a value beyond the thresholds.

    The share of a value's information that a term discloses is their pointwise mutual
    information over the information of the value, from counts of texts of the whole
    corpus.  Equal contexts, as copies have them, are evidence once.
    """
    rows = found.count()
    pairs = found.select(F.explode("pairs").alias("p")).select("p.*")
    both = (
        pairs.groupBy("value", "term")
        .agg(F.countDistinct("context").alias("contexts"), F.count(F.lit(1)).alias("together"))
        .filter(F.col("contexts") >= SUPPORT)
    )
    having = found.select(F.explode("found").alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("with_value"))
    texts = (
        common.only(docs, "doc_id", "text").mapInArrow(_frequencies, "term long, texts long")
        .groupBy("term").agg(F.sum("texts").alias("with_term"))
    )
    share = "1 + ln(least(together, with_term) / with_term) / ln(greatest(total / with_value, 1.0000001D))"
    return (
        both.join(having, "value").join(texts, "term")
        .withColumn("total", F.lit(float(rows)))
        .withColumn("share", F.expr(share))
        .filter(F.col("share") >= GENERALISE)
        .select("value", "term", F.when(F.col("share") >= REMOVE, 0).otherwise(1).alias("action"))
    )


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text_hash, term): the distinct words of each text."""
    for batch, raw in common.chunks(batches):
        t = words.Text([x.lower() for x in raw])
        start, end = t.stretches(words.NOT_WORD)
        start, end = start[end - start >= 3], end[end - start >= 3]
        h, owner = t.hashes(start, end), t.owner(start)
        _, later = words.repeated(words.owned(h, owner))
        key = batch.column("text_hash").to_numpy()[owner[~later]]
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(h[~later].view(np.int64))], names=["text_hash", "term"])


def text_hash() -> Column:
    """Texts with one hash share their terms; one that has none of them loses nothing."""
    return F.xxhash64("text")


def disclosed(docs: DataFrame, risky: DataFrame) -> DataFrame:
    """(text_hash, terms): the disclosing terms of every text that holds one.

    A term is marked wherever it stands, most of all in texts without the value.  Its
    strictest action counts.
    """
    actions = common.stage(risky.groupBy("term").agg(F.min("action").alias("action")), "actions")
    # Staged, so that sizes are known: a short list is broadcast and texts stay in place.
    return common.stage(
        common.only(docs, "doc_id", "text").filter("text IS NOT NULL")
        .select("text", text_hash().alias("text_hash"))
        .mapInArrow(_words, "text_hash long, term long")
        .join(actions, "term")
        .groupBy("text_hash").agg(F.collect_set(F.struct("term", "action")).alias("terms")),
        "terms",
    )


def all_spans(text: str, terms: list[dict] | None) -> tuple[list, list]:
    """The base spans of a text, and all spans of it."""
    base = base_spans(text)
    if not terms:
        return base, base
    t, action = Terms(text), {p["term"]: p["action"] for p in terms}
    more = [
        (int(t.start[i]), len(KINDS) + action[int(t.hash[i])], int(t.end[i]))
        for i in np.flatnonzero(np.isin(t.hash, list(action)))
        if not any(a < t.end[i] and b > t.start[i] for a, _, b in base)
    ]
    return base, sorted(base + more)


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, raw in common.chunks(batches):
        counts, sha, spans = [], [], []
        for x, terms in zip(raw, batch.column("terms").to_pylist(), strict=True):
            base, found = all_spans(x.decode("utf-8", "replace"), terms)
            counts.append([sum(k == i for _, k, _ in base) for i in range(4)])
            sha.append(hashlib.sha256(named(base).encode()).hexdigest())
            spans.append(named(found))
        n = np.array(counts, np.int64).reshape(-1, 4)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(n[:, i]) for i in range(4)], pa.array(sha), pa.array(spans)],
            names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
        )


SPANS = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"


def terms_of(docs: DataFrame) -> DataFrame:
    """(text_hash, terms) of every text of ``docs`` that holds a disclosing term."""
    found = common.stage(common.only(docs, "doc_id", "text").mapInArrow(_found, FOUND), "found")
    return disclosed(docs, common.stage(disclosing(docs, found), "disclosing"))


def find(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row.

    Spans follow from a row's own text and the disclosing terms of the whole table, with
    or without a doc_id.  Null and empty texts have none; repeated rows have equal rows;
    an empty table gives an empty result.
    """
    return (
        common.only(docs, "doc_id", "text").withColumn("text_hash", text_hash())
        .join(terms_of(docs), "text_hash", "left").select("doc_id", "text", "terms")
        .mapInArrow(_spans, SPANS)
    )


def sanitised(text: str, spans: str) -> str:
    """The text with each span replaced by its kind; overlapping spans become one."""
    out, at = [], 0
    for s in spans.split(",") if spans else ():
        kind, a, b = s.split(":")
        if int(a) >= at:
            out += [text[at : int(a)], "" if kind == "term" else f"[{kind.upper()}]"]
        at = max(at, int(b))
    return "".join([*out, text[at:]])


def without_personal_data(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced in ``text`` and ``n_chars`` counted anew.

    Spans follow from a row's own text, whatever its doc_id.  Rows without personal data
    stay as they are.
    """
    terms = terms_of(docs).select(F.col("text_hash").alias("_text_hash"), F.col("terms").alias("_terms"))

    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in common.chunks(batches):
            columns = {n: batch.column(n) for n in names}
            found = [named(all_spans(x.decode("utf-8", "replace"), terms)[1]) for x, terms in zip(raw, batch.column("_terms").to_pylist(), strict=True)]
            clean = [sanitised(t, s) if s else t for t, s in zip(columns["text"].to_pylist(), found, strict=True)]
            columns["text"] = pa.array(clean, columns["text"].type)
            if "n_chars" in columns:
                counts = [len(t) if s else n for t, s, n in zip(clean, found, columns["n_chars"].to_pylist(), strict=True)]
                columns["n_chars"] = pa.array(counts, columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return docs.withColumn("_text_hash", text_hash()).join(terms, "_text_hash", "left").mapInArrow(run, docs.schema)


def op2_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(spark, common.table(spark, sf_dir, "documents"))
