"""Token ids of whole texts from a public tokenizer file, with a cache of words."""

from __future__ import annotations

import os
import zlib
from array import array

import numpy as np
import pyarrow as pa

END = 2
#: Entries of a worker's word cache; it is emptied when it is full.
CACHE_WORDS = 1_000_000
#: Separators that stand together; a text with such is encoded whole.
DOUBLE = (b"  ", b" \n", b"\n ", b"\n\n")
#: White space besides them, or the beginning of its bytes.
OTHER_ASCII = b"\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
OTHER = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a", b"\xe2\x80", b"\xe2\x81", b"\xe3\x80")
#: Punctuation that the pre-tokenizer leaves together and parts from letters before it.
PUNCTUATION = ".,;:!?|%$&#*()-"

_encoders: dict = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def plain(raw: bytes, text: str) -> bool:
    """Whether all white space, in any reading, is single spaces and line feeds between words."""
    if not text or text[0] in " \n" or text[-1] in " \n" or any(d in raw for d in DOUBLE):
        return False
    if len(raw.translate(None, OTHER_ASCII)) == len(raw) and not any(x in raw for x in OTHER):
        return True
    return len(text.split()) == text.count(" ") + text.count("\n") + 1


def byte_spelling(tokenizer) -> dict[int, str]:
    """How the pre-tokenizer spells each byte; empty if it does more than that to words."""
    from tokenizers import models, pre_tokenizers

    if not (
        isinstance(tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel) and isinstance(tokenizer.model, models.BPE)
        and tokenizer.normalizer is None and not tokenizer.pre_tokenizer.add_prefix_space
    ):
        return {}
    out: dict[int, str] = {}
    bytewise = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    # Characters that together hold every byte of UTF-8.
    for point in [*range(0x800), *range(0x800, 0x10000, 0x40), *range(0x10000, 0x110000, 0x1000)]:
        if not 0xD800 <= point < 0xE000:
            spelled = "".join(x for x, _ in bytewise.pre_tokenize_str(chr(point)))
            out.update(zip(chr(point).encode(), spelled, strict=True))
    return out


class Encoder:
    """Ids as little-endian 16 or 32 bit integers.

    The byte-level pre-tokenizer never joins a single space or line feed to what stands
    before it, nor a line feed to the word behind it, nor a letter to punctuation.  So a text may be cut there, and
    each distinct piece is encoded once.  A text with the string of an added token is encoded whole.
    """

    def __init__(self, path: str | None = None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or default_path())
        # Strings of added tokens are ids of their own wherever they stand in a text.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.kind = np.dtype("<u2" if self.code == "H" else "<u4")
        self.end = np.array([END], self.kind).tobytes()
        self.feed = self.whole(["\n"])[0]
        self.spelling = byte_spelling(self.tokenizer)
        self.model = self.tokenizer.model
        self.tails: dict[str, bytes] = {}  # punctuation behind words
        self.words: dict[str, bytes] = {}  # a word, with its line feed or without its space

    @classmethod
    def shared(cls, path: str | None = None) -> Encoder:
        """The worker's encoder for ``path``; its cache serves later tasks too."""
        if path not in _encoders:
            _encoders[path] = cls(path)
        return _encoders[path]

    def whole(self, texts: list[str]) -> list[bytes]:
        code = self.code
        return [array(code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def letters(self, words: list[str], mark: str = "") -> list[bytes]:
        """Ids of words of letters with ``mark`` before each: to the pre-tokenizer one piece, so the model takes them as they are."""
        code, tokenize = self.code, self.model.tokenize
        # The words' bytes, each as its spelling; a space is no letter and parts them.
        spelled = " ".join(words).encode().decode("latin-1").translate(self.spelling).split(self.spelling[32])
        mark = "".join(self.spelling[b] for b in mark.encode())
        return [array(code, [t.id for t in tokenize(mark + x)]).tobytes() for x in spelled]

    def learn(self, pieces: set[str]) -> None:
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        new = pieces.difference(self.words)
        # Punctuation behind a letter or digit is encoded by itself.
        marked = []
        for p in new:
            if not p[-1:].isalnum():
                stem = p.rstrip(PUNCTUATION)
                if stem and len(stem) < len(p) and stem[-1].isalnum():
                    marked.append((p, stem, p[len(stem) :]))
        new.difference_update([p for p, _, _ in marked])
        new.update({stem for _, stem, _ in marked}.difference(self.words))
        tails = list({tail for _, _, tail in marked}.difference(self.tails))
        if len(self.tails) > CACHE_WORDS:
            self.tails.clear()
            tails = list({tail for _, _, tail in marked})
        self.tails.update(zip(tails, self.whole(tails), strict=True))
        todo = list(new)
        if self.spelling:
            spaced, fed, rest = [], [], []
            for p in todo:
                (spaced if p.isalpha() else fed if p[0] == "\n" and p[1:].isalpha() else rest).append(p)
            if spaced:
                self.words.update(zip(spaced, self.letters(spaced, " "), strict=True))
            if fed:
                found = self.letters([p[1:] for p in fed])
                self.words.update((p, self.feed + x) for p, x in zip(fed, found, strict=True))
            todo = rest
        for i in range(0, len(todo), 20_000):
            part = todo[i : i + 20_000]
            self.words.update(zip(part, self.whole([p if p[0] == "\n" else " " + p for p in part]), strict=True))
        for p, stem, tail in marked:
            self.words[p] = self.words[stem] + self.tails[tail]

    def pieces(self, raw: list[bytes]) -> list[bytes]:
        """Ids of texts that are ``plain``, without the end id; each distinct piece is looked up once."""
        buffer = b" " + b" ".join(raw)
        symbols = np.frombuffer(buffer, np.uint8)
        at = np.flatnonzero((symbols == 32) | (symbols == 10))
        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
        first = np.searchsorted(at, np.cumsum(sizes) - sizes).tolist()  # the piece that begins each text
        offsets = np.append(at, len(symbols))
        # A piece is a space or line feed and the word behind it.
        cut = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(buffer)]).dictionary_encode()
        words = cut.dictionary.buffers()[2].to_pybytes().decode().replace("\n", " \n").split(" ")[1:]
        self.learn(set(words))
        found = pa.array(list(map(self.words.__getitem__, words)), pa.large_binary()).take(cut.indices)
        ends, ids = np.frombuffer(found.buffers()[1], np.int64), memoryview(found.buffers()[2])
        # The first word of a text has no space.
        heads = self.whole([buffer[offsets[i] + 1 : offsets[i + 1]].decode() for i in first])
        return [b"".join([head, ids[ends[i + 1] : ends[j]]]) for head, i, j in zip(heads, first, [*first[1:], len(at)], strict=True)]

    def encode(self, raw: list[bytes]) -> list[bytes]:
        """Ids of each text, the end id last."""
        texts = [x.decode("utf-8", "replace") for x in raw]
        simple = [
            not any(a in x for a in self.added) and plain(r, x) and ("\ufffd" not in x or x.encode() == r)
            for r, x in zip(raw, texts, strict=True)
        ]
        whole = iter(self.whole([x for x, s in zip(texts, simple, strict=True) if not s]))
        cut = [r for r, s in zip(raw, simple, strict=True) if s]
        pieces = iter(self.pieces(cut) if cut else ())
        return [next(pieces if s else whole) + self.end for s in simple]

    def ids(self, encoded: bytes) -> np.ndarray:
        return np.frombuffer(encoded, self.kind)


def crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
