"""Secrets in texts and in what is encoded inside them, layer below layer.

A worklist starts with the text.  Each layer is scanned, and whatever in it is encoded
(percent signs, character escapes, base64, compressed bytes) becomes a layer of its own,
until nothing new comes up.  Every layer knows where its characters stand in the text, so
a secret found there is a span of the text.
"""

from __future__ import annotations

import binascii
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rdfweave.llm import common

KINDS = ("assign", "access", "hex")
#: Kinds that the method adds: the same, found below the text itself.
INNER = tuple(f"inner_{k}" for k in KINDS)
LEAST_VALUE, LEAST_HEX, LEAST_TOKEN = 6, 24, 16
#: Decoded text is scanned in pieces of about this many bytes, cut at line feeds.
PIECE_BYTES = 1 << 20

ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
# A run that is too short fails as a whole, so only long ones are looked for.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}+")
HEX = re.compile(rf"[0-9a-f]{{{LEAST_HEX},}}+")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
TOKEN = re.compile(rf"[A-Za-z0-9+/_-]{{{LEAST_TOKEN},}}+={{0,2}}")
URL_SAFE = bytes.maketrans(b"-_", b"+/")
#: How compressed bytes begin, and what reads them.
READERS = {
    b"\x1f\x8b": lambda: zlib.decompressobj(31),
    b"\x78\x01": zlib.decompressobj,
    b"\x78\x5e": zlib.decompressobj,
    b"\x78\x9c": zlib.decompressobj,
    b"\x78\xda": zlib.decompressobj,
    b"BZh": bz2.BZ2Decompressor,
    b"\xfd7zXZ\x00": lzma.LZMADecompressor,
}
BROKEN = (zlib.error, lzma.LZMAError, OSError, EOFError, ValueError)

Span = tuple[int, int]


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, ordered."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


class Layer:
    """A text, and where its characters stand in the layer above.

    ``edits`` are (start, end, above_start, above_end) of characters that were decoded;
    those between them are as they were, from ``begin`` on.  A layer that was decoded as a
    whole is one edit.
    """

    def __init__(
        self, text: str, above: Layer | None = None, edits: list[tuple[int, int, int, int]] | None = None, begin: int = 0
    ) -> None:
        self.text, self.above, self.edits, self.begin = text, above, edits or [], begin
        self.starts = [e[0] for e in self.edits]

    def _place(self, at: int, end: bool) -> int:
        n = bisect_right(self.starts, at) - 1
        if n < 0:
            return self.begin + at + end
        start, stop, above_start, above_stop = self.edits[n]
        if at < stop:
            return above_stop if end else above_start
        return above_stop + at - stop + end

    def span(self, start: int, end: int) -> Span:
        """Where a stretch stands in the text itself."""
        layer: Layer = self
        while layer.above is not None:
            start, end = layer._place(start, False), layer._place(end - 1, True)
            layer = layer.above
        return start, end

    def decoded(self, start: int, end: int) -> bool:
        """Whether a stretch holds anything that this layer has decoded."""
        n = bisect_right(self.starts, end - 1) - 1
        return n >= 0 and self.edits[n][1] > start


def readable(raw: bytes) -> str | None:
    """The text that bytes are, or ``None`` for anything else."""
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return text if text and all(c.isprintable() or c in "\t\n\r" for c in text) else None


def reader_of(raw: bytes):
    return next((READERS[magic] for magic in READERS if raw.startswith(magic)), None)


def unpacked(raw: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """What compressed bytes hold, in parts; a broken end is left out."""
    while make := reader_of(raw):
        reader, data = make(), raw
        try:
            while not reader.eof:
                part = reader.decompress(data, size)
                # One kind of reader gives back what it has not read, the other keeps it.
                data = getattr(reader, "unconsumed_tail", b"")
                if part:
                    yield part
                elif not data:
                    return
        except BROKEN:
            return
        raw = reader.unused_data


def texts(parts: Iterator[bytes], size: int = PIECE_BYTES) -> Iterator[str]:
    """Parts as texts that end at line feeds, which no pattern runs over.

    A small input that unpacks to very much is so never held as a whole; only a line is.
    """
    decoder, held, length = codecs.getincrementaldecoder("utf-8")("replace"), [], 0
    for part in parts:
        text = decoder.decode(part)
        cut = text.rfind("\n") + 1
        if cut and length + cut >= size:
            yield "".join([*held, text[:cut]])
            held, length, text = [], 0, text[cut:]
        held.append(text)
        length += len(text)
    last = "".join([*held, decoder.decode(b"", True)])
    if last:
        yield last


def opened(raw: bytes, seen: set[bytes] | None = None) -> Iterator[str]:
    """The texts in bytes: these themselves, or what they unpack to, through every layer.

    Bytes that were met before on the way, as an archive of itself has them, end it.
    """
    seen = set() if seen is None else seen
    if reader_of(raw) is None:
        text = readable(raw)
        if text:
            yield text
        return
    mark = hashlib.blake2b(raw, digest_size=16).digest()
    if mark in seen:
        return
    seen.add(mark)
    parts = unpacked(raw)
    first = next(parts, b"")
    if reader_of(first):
        # What is compressed again is unpacked from memory.
        yield from opened(b"".join([first, *parts]), seen)
    elif first:
        yield from texts(chain([first], parts))


def characters(raw: bytes) -> list[tuple[str, int]]:
    """Characters of percent-coded bytes, each with its number of bytes; what is no UTF-8 is one sign a byte."""
    try:
        return [(c, len(c.encode())) for c in raw.decode()]
    except UnicodeDecodeError:
        return [(chr(b) if b < 128 else "\ufffd", 1) for b in raw]


def escaped(m: re.Match) -> str | None:
    code = int(m[6]) if m[6] else int(next(x for x in m.groups() if x), 16)
    return chr(code) if 0 < code < 0x110000 and not 0xD800 <= code < 0xE000 else None


def unescaped(layer: Layer, pattern: re.Pattern, found) -> Iterator[Layer]:
    """Lines of a layer with what ``pattern`` matches decoded: ``found`` gives (text, sources) of a match."""
    text, at = layer.text, 0
    m = pattern.search(text)
    while m:
        start = text.rfind("\n", 0, m.start()) + 1
        stop = text.find("\n", m.start())
        stop = len(text) if stop < 0 else stop
        out, edits, at, length = [], [], start, 0
        for m in pattern.finditer(text, start, stop):
            out.append(text[at : m.start()])
            length += m.start() - at
            at = m.start()
            for c, n in found(m):
                out.append(c)
                edits.append((length, length + len(c), at, at + n))
                length += len(c)
                at += n
        if edits:
            yield Layer("".join([*out, text[at:stop]]), layer, edits, start)
        m = pattern.search(text, stop)


def below(layer: Layer) -> Iterator[Layer]:
    """The layers that are encoded in a layer."""
    text = layer.text
    if "%" in text:
        for m in PERCENT.finditer(text):
            raw = bytes.fromhex(m[0].replace("%", ""))
            if reader_of(raw):
                for inner in opened(raw):
                    yield Layer(inner, layer, [(0, len(inner), m.start(), m.end())])
        yield from unescaped(layer, PERCENT, lambda m: [(c, 3 * n) for c, n in characters(bytes.fromhex(m[0].replace("%", "")))])
    if "\\" in text or "&#" in text:
        yield from unescaped(layer, ESCAPE, lambda m: [(c, len(m[0]))] if (c := escaped(m)) else [])
    for m in TOKEN.finditer(text):
        token = m[0].rstrip("=").encode().translate(URL_SAFE)
        if len(token) % 4 == 1:
            continue
        raw = binascii.a2b_base64(token + b"=" * (-len(token) % 4))
        for inner in opened(raw):
            yield Layer(inner, layer, [(0, len(inner), m.start(), m.end())])


def secrets(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(start, kind, end) of the base spans, and of all spans with those found below."""
    base = scan(text)
    inner: set[tuple[int, int, int]] = set()
    # A layer that says the same of the same place has been met: nothing new can follow.
    seen: set[tuple[bytes, Span]] = set()
    # Layers are taken up one by one as they are decoded, the deepest first.
    work = [below(Layer(text))]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        mark = (hashlib.blake2b(layer.text.encode("utf-8", "replace"), digest_size=16).digest(), layer.span(0, len(layer.text)))
        if mark in seen:
            continue
        seen.add(mark)
        for a, k, b in scan(layer.text):
            if layer.decoded(a, b):
                start, end = layer.span(a, b)
                inner.add((start, len(KINDS) + k, end))
        work.append(below(layer))
    return base, sorted([*base, *inner])


def named(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{(*KINDS, *INNER)[k]}:{a}:{b}" for a, k, b in spans)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, raw in common.chunks(batches):
        counts, sha, spans = [], [], []
        for x in raw:
            base, every = secrets(x.decode("utf-8", "replace"))
            counts.append([sum(k == i for _, k, _ in base) for i in range(len(KINDS))])
            sha.append(hashlib.sha256(named(base).encode()).hexdigest())
            spans.append(named(every))
        n = np.array(counts, np.int64).reshape(-1, len(KINDS))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(n[:, i]) for i in range(len(KINDS))], pa.array(sha), pa.array(spans)],
            names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
        )


SPANS = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row.

    Each row follows from its own text alone, in one pass without a shuffle.  Null and
    empty texts have no spans; repeated rows have equal rows; an empty table gives an empty
    result; other columns than ``doc_id`` and ``text`` are not read.  Base64 that is broken
    over several lines is read line by line.
    """
    return common.only(docs, "doc_id", "text").mapInArrow(_found, SPANS)


def redacted(text: str) -> str:
    """The text with every stretch that holds a secret replaced; overlapping ones become one."""
    out, at = [], 0
    for a, _, b in secrets(text)[1]:
        if a >= at:
            out += [text[at:a], "[SECRET]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def without_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets replaced in ``text``; all other columns stay as they are."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = pa.array([None if x is None else redacted(x) for x in batch.column(at).to_pylist()], batch.column(at).type)
            yield batch.set_column(at, batch.schema.field(at), clean)

    return docs.mapInArrow(run, docs.schema)


def op11_decoding_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(common.table(spark, sf_dir, "documents"))
