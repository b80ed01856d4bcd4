"""What the tokens of Turtle documents state, found column by column for many documents at once.

The tokens of some documents are one column.  Nesting, frames, roles and neighbours
are running sums, last values and shifts over it: what windows over a row per token would
give, but no token becomes a row, is shuffled or sorted in Spark.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from rdfweave import model as M
from rdfweave.functions import text as T
from rdfweave.sources import rdfxml_events

#: Tokens that are looked at together, unless one document has more.
TOKENS = 1 << 17
#: Bytes of text that are looked at together, unless one document has more.
TEXT_BYTES = 1 << 26
#: Terms of a statement.
TERMS = ["s", "s_kind", "p", "o", "o_kind", "o_datatype", "o_lang"]

_KINDS = [".", ";", ",", "[", "]", "(", ")", M.LITERAL, M.BNODE, M.IRI, "?"]
_DOT, _SEMICOLON, _COMMA, _OPEN, _CLOSE, _OPEN_LIST, _CLOSE_LIST, _LITERAL, _BNODE, _IRI, _UNKNOWN = range(11)
_MARK_OF = np.full(256, -1)
_MARK_OF[[ord(c) for c in _KINDS[:7]]] = range(7)
# What a token is to its neighbours.
_OTHER, _QUOTE, _CARET, _AT_PREFIX, _PREFIX, _AT_BASE, _BASE = range(7)
_WORDS = {"@prefix": _AT_PREFIX, "prefix": _PREFIX, "@base": _AT_BASE, "base": _BASE}
# Roles beside those of dot, semicolon and comma.
_TERM, _OPENER = 3, 4
#: The greatest of a document counts.
REASONS = [None, "statement has no closing dot", "unbalanced brackets", "unknown prefix", "unreadable token"]
WRONG = [None, "predicate is no IRI", "statement has no object", "subject is a literal"]
_SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*:"
_FIXED = [f"{M.RDF}{name}" for name in ("nil", "first", "rest")]
_XSD_STRING = M.XSD + "string"

_BLANK = r"[ \t\n\x0b\f\r]"
_ESCAPE = re.compile(rf"(?s){T._PAIR}|{T._SINGLE}|{T._LONG}|\\.")


def _pattern(word: str, letter: str) -> re.Pattern:
    """One token behind blanks and comments, or the end; ``word`` and ``letter`` are what a name may hold and begin with.

    Which kind of token it is follows from its first characters.  Repeats are possessive.
    """
    other = r"%[0-9a-fA-F]{2}|\\[_~.!$&'()*+,;=/?#@%\-]"
    local = rf"[{word}:\-]*+(?:(?:{other}|\.++(?=[{word}:\-]|{other}))[{word}:\-]*+)*+"
    tokens = [
        r"[;,\[\]()]",
        r'<[^<>"{}|^`\x00-\x20]*+>',
        rf"(?:{letter}[{word}\-]*+(?:\.(?=[{word}\-.]*:)[{word}\-]*+)*+)?:{local}",
        r"[a-zA-Z]++",
        r'"""[^"\\]*+(?:(?:\\.|"(?!""))[^"\\]*+)*+"""',
        r"'''[^'\\]*+(?:(?:\\.|'(?!''))[^'\\]*+)*+'''",
        r'"[^"\\\n\r]*+(?:\\.[^"\\\n\r]*+)*+"',
        r"'[^'\\\n\r]*+(?:\\.[^'\\\n\r]*+)*+'",
        rf"_:[{word}][{word}\-]*+(?:\.++(?=[{word}\-])[{word}\-]*+)*+",
        r"@[a-zA-Z]+(?:-[a-zA-Z0-9]+)*+",
        r"\^\^",
        r"[+-]?(?:[0-9]++\.[0-9]*+[eE][+-]?[0-9]++|\.?[0-9]++[eE][+-]?[0-9]++|[0-9]*+\.[0-9]++|[0-9]++)",
        _BLANK.replace("[", "[^"),
    ]
    return re.compile(rf"(?s)(?:{_BLANK}++|#[^\n\r]*+)*+({'|'.join(tokens)}|\Z)")


_PLAIN = _pattern("a-zA-Z0-9_", "[a-zA-Z]")


@lru_cache(1)
def _wide() -> re.Pattern:
    # Numbers that are no digits are no letters.
    numbers = "".join(c for c in map(chr, range(128, 0x110000)) if unicodedata.category(c) in ("Nl", "No"))
    return _pattern(r"\w", rf"[^\W\d_{numbers}]")


def _column(words: list[str]) -> pa.StringArray:
    text = "".join(words)
    if not text.isascii():
        return pa.array(words, pa.string())
    offsets = np.zeros(len(words) + 1, np.int32)
    np.cumsum(np.fromiter(map(len, words), np.int32, len(words)), out=offsets[1:])
    return pa.StringArray.from_buffers(len(words), pa.py_buffer(offsets), pa.py_buffer(text.encode()))


def _words(text: str) -> list[str] | pa.StringArray:
    """The tokens of a document; of a long one only some are Python strings at the same time."""
    pattern = _PLAIN if text.isascii() else _wide()
    if len(text) > TEXT_BYTES // 16:
        found = (m[1] for m in pattern.finditer(text) if m[1])
        return pa.concat_arrays([_column([]), *map(_column, iter(lambda: list(islice(found, TOKENS)), []))])
    found = pattern.findall(text)
    while found and not found[-1]:
        found.pop()
    return found


def _character(m: re.Match) -> str:
    token = m[0]
    if len(token) == 2:
        return T.SHORT_ESCAPES.get(token) or (token[1] if token[1] in "\"'\\" else token)
    return bytes.fromhex(token[2:6] + token[8:]).decode("utf-16-be") if len(token) == 12 else chr(int(token[2:], 16))


def unescaped(text: str) -> str:
    """The value of a quoted literal, by the same rules as ``text.unescape``."""
    return _ESCAPE.sub(_character, text)


def resolved(iri: str, base: str | None) -> str:
    """``iri`` against ``base``, by the same rules as ``turtle.resolve_iri``."""
    if base is None or re.match(_SCHEME, base):
        return rdfxml_events.resolved(iri, base)
    # A base without a scheme has no host, and dots stay.
    page = base.split("#", 1)[0]
    path = page.split("?", 1)[0]
    if re.match(rf"{_SCHEME}|/(?!/)", iri):
        return iri
    if iri.startswith("//"):
        return base.split(":", 1)[0] + ":" + iri
    return (page if not iri or iri[0] == "#" else path if iri[0] == "?" else path[: path.rfind("/") + 1]) + iri


def _bytes(text: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column, and where each value begins; one place more than values."""
    _, offsets, data = text.buffers()
    return np.frombuffer(data, np.uint8), np.frombuffer(offsets, np.int32)[text.offset : text.offset + len(text) + 1]


def _back(values: np.ndarray, n: int, pos: np.ndarray, otherwise) -> np.ndarray:
    """The value ``n`` places before in the same document."""
    out = np.concatenate([np.full(n, otherwise, values.dtype), values])[: len(values)]
    out[pos < n] = otherwise
    return out


def _last(found: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Place of the last row found, up to this one and not before ``begins``; -1 without any."""
    at = np.maximum.accumulate(np.where(found, np.arange(len(found)), -1))
    return np.where(at < begins, -1, at)


def _taken(values: pa.Array, at: np.ndarray) -> pa.Array:
    return values.take(pa.array(at, pa.int64(), mask=at < 0))


def _joined(*parts) -> pa.Array:
    """Texts set side by side; null where one is."""
    return pc.binary_join_element_wise(*parts, "")


def _cut(text: pa.StringArray, front: int = 0, back: int = 0) -> pa.StringArray:
    """Values without so many bytes at their ends; what is shorter becomes empty."""
    data, at = _bytes(text)
    size, kept = np.diff(at), np.ones(int(at[-1] - at[0]), bool)
    for k in range(front):
        kept[(at[:-1] + k - at[0])[size > k]] = False
    for k in range(1, back + 1):
        kept[(at[1:] - k - at[0])[size >= k]] = False
    offsets = np.concatenate([[0], np.cumsum(np.maximum(size - front - back, 0))]).astype(np.int32)
    valid = pc.is_valid(text).buffers()[1] if text.null_count else None
    return pa.StringArray.from_buffers(len(text), pa.py_buffer(offsets), pa.py_buffer(data[at[0] : at[-1]][kept]), valid)


def _each(change, values: pa.StringArray, *more: pa.Array, where: pa.Array) -> pa.StringArray:
    """``values`` with those chosen changed one by one."""
    chosen = pc.fill_null(where, False)
    if not pc.any(chosen).as_py():
        return values
    new = [change(*x) for x in zip(*(v.filter(chosen).to_pylist() for v in (values, *more)), strict=True)]
    return pc.replace_with_mask(values, chosen, pa.array(new, pa.string()))


def _unescaped(values: pa.StringArray) -> pa.StringArray:
    return _each(unescaped, values, where=pc.match_substring(values, "\\"))


def _relative(values: pa.StringArray) -> pa.Array:
    return pc.invert(pc.match_substring_regex(values, f"^{_SCHEME}"))


def _before(values: pa.Array, mark: str) -> pa.Array:
    return pc.list_element(pc.split_pattern(values, mark, max_splits=1), 0) if len(values) else values


def _all_resolved(iris: pa.StringArray, bases: pa.StringArray) -> pa.StringArray:
    """``resolved`` for columns; only paths are looked at one by one."""
    relative = pc.and_(_relative(iris), pc.is_valid(bases))
    query = pc.starts_with(iris, "?")
    on_page = pc.and_(relative, pc.or_(query, pc.or_(pc.equal(iris, ""), pc.starts_with(iris, "#"))))
    own, asks, pages = iris.filter(on_page), query.filter(on_page), _before(bases.filter(on_page), "#")
    pages = pc.replace_with_mask(pages, asks, _before(pages.filter(asks), "?"))
    iris = pc.replace_with_mask(iris, on_page, _joined(pages, own))
    return _each(resolved, iris, bases, where=pc.and_not(relative, on_page))


def _largest(values: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """The greatest value of each document; rows of a document follow one another."""
    out = np.zeros(docs, values.dtype)
    if len(doc):
        begins = np.flatnonzero(np.concatenate([[True], np.diff(doc) != 0]))
        out[doc[begins]] = np.maximum.reduceat(values, begins)
    return out


class _Tokens:
    """Tokens of some documents: what each is, its nesting, and what its prefix stands for."""

    def __init__(self, text: pa.StringArray, sizes: np.ndarray, start: pa.StringArray) -> None:
        self.text = text
        self.docs, n = len(sizes), len(self.text)
        self.doc = np.repeat(np.arange(self.docs), sizes)
        self.pos = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.last = self.pos == sizes[self.doc] - 1
        if not n:
            return
        data, at = _bytes(self.text)
        first, size = data[at[:-1]], np.diff(at)
        self._kinds(data, at, first, size)
        self._neighbours(first)
        self.level = np.cumsum(np.isin(self.kind, (_OPEN, _OPEN_LIST)).astype(np.int64) - np.isin(self.kind, (_CLOSE, _CLOSE_LIST)))
        before = np.concatenate([[0], self.level])[np.cumsum(sizes) - sizes]
        self.level = self.level - before[self.doc]
        self._addresses(first, start)

    def _among(self, at: np.ndarray, words: list[str], lower: bool = False) -> np.ndarray:
        """Place in ``words`` of the tokens ``at`` some places, -1 for others."""
        text = self.text.take(pa.array(at, pa.int64()))
        found = pc.index_in(pc.ascii_lower(text) if lower else text, pa.array(words))
        return pc.fill_null(found, -1).to_numpy(zero_copy_only=False)

    def _kinds(self, data: np.ndarray, at: np.ndarray, first: np.ndarray, size: np.ndarray) -> None:
        self.quoted = (first == ord('"')) | (first == ord("'"))
        number = ((first >= ord("0")) & (first <= ord("9"))) | (np.isin(first, list(b"+-.")) & (size > 1))
        flag = np.zeros(len(size), bool)
        maybe = np.flatnonzero(((first == ord("t")) & (size == 4)) | ((first == ord("f")) & (size == 5)))
        flag[maybe] = self._among(maybe, ["true", "false"]) >= 0
        colons = np.flatnonzero(data == ord(":"))
        colon = np.concatenate([colons, [len(data)]])[np.searchsorted(colons, at[:-1])]
        self.has_colon = colon < at[1:]
        bnode = (first == ord("_")) & (colon == at[:-1] + 1) & self.has_colon
        self.written = first == ord("<")
        self.is_a = (first == ord("a")) & (size == 1)
        mark = np.where(size == 1, _MARK_OF[first], -1)
        iri = self.is_a | self.written | self.has_colon
        self.kind = np.select([mark >= 0, self.quoted | number | flag, bnode, iri], [mark, _LITERAL, _BNODE, _IRI], _UNKNOWN)
        self.mark = np.where(self.quoted, _QUOTE, np.where((first == ord("^")) & (size == 2), _CARET, _OTHER))
        maybe = np.flatnonzero(np.isin(first, list(b"@pPbB")) & (size >= 4) & (size <= 7))
        word = self._among(maybe, list(_WORDS), lower=True)
        self.mark[maybe[word >= 0]] = np.array(list(_WORDS.values()))[word[word >= 0]]

    def _neighbours(self, first: np.ndarray) -> None:
        one, two, three = (_back(self.mark, k, self.pos, _OTHER) for k in (1, 2, 3))
        self.declares = (self.mark > _CARET) | (one > _CARET) | ((two > _CARET) & (two != _BASE)) | (three == _AT_PREFIX)
        at_sign = first == ord("@")
        self.attached = self.declares | (self.mark == _CARET) | (one == _CARET) | (at_sign & (one == _QUOTE))

        def after(values: np.ndarray, k: int = 1) -> np.ndarray:
            out = np.concatenate([values[k:], np.zeros(min(k, len(values)), bool)])
            return out & ~self.last

        self.typed = self.quoted & after(self.mark == _CARET)
        self.has_lang = self.quoted & after(at_sign & (self.mark != _AT_PREFIX) & (self.mark != _AT_BASE))
        self.closes = after(self.kind == _CLOSE_LIST)

    def _declared(self, first: np.ndarray, start: pa.StringArray) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """The place of each directive, the name (the base has an empty one), and the address.

        An address may rest on the base declared before it.
        """
        at = np.flatnonzero(self.mark > _CARET)
        is_base = (self.mark[at] == _AT_BASE) | (self.mark[at] == _BASE)
        texts = pa.concat_arrays([self.text, pa.array([""])])

        def behind(k: np.ndarray) -> np.ndarray:
            there = np.minimum(at + k, len(self.doc) - 1)
            return np.where((at + k < len(self.doc)) & (self.doc[there] == self.doc[at]), there, -1)

        names = _taken(texts, np.where(is_base, len(self.doc), behind(1)))
        place = behind(np.where(is_base, 1, 2))
        iris = _cut(_taken(self.text, np.where((place >= 0) & (first[place] == ord("<")), place, -1)), 1, 1)
        rests = pc.or_(_relative(iris), pc.match_substring(iris, "\\"))
        if pc.any(rests).as_py():
            known = []
            for doc, rows in groupby(zip(self.doc[at].tolist(), is_base.tolist(), iris.to_pylist(), strict=True), lambda x: x[0]):
                base = start[doc].as_py()
                for _, declares_base, iri in rows:
                    known.append(None if iri is None else resolved(unescaped(iri), base))
                    base = known[-1] if declares_base and iri is not None else base
            iris = pa.array(known, pa.string())
        return at, names, iris

    def _addresses(self, first: np.ndarray, start: pa.StringArray) -> None:
        """``addresses`` and the place there, for each IRI, of what it is written with."""
        at, names, iris = self._declared(first, start)
        self.addresses = pa.concat_arrays([iris, start])
        self.prefixed = np.flatnonzero((self.kind == _IRI) & ~self.written & ~self.is_a)
        written = np.flatnonzero(self.written)
        parts = pc.split_pattern(self.text.take(pa.array(self.prefixed, pa.int64())), ":", max_splits=1)
        none = pa.array([], pa.string())
        self.local = pc.list_element(parts, 1) if len(self.prefixed) else none
        wanted = _joined(pc.list_element(parts, 0), ":") if len(self.prefixed) else none
        codes = pa.concat_arrays([pa.array([""]), names, wanted]).dictionary_encode().indices
        codes = pc.fill_null(codes, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        kinds, places = codes.max() + 2, self.pos.max() + 2

        def key(doc: np.ndarray, code: np.ndarray, pos: np.ndarray) -> np.ndarray:
            return (doc * kinds + code + 1) * places + pos

        own = key(self.doc[at], codes[1 : 1 + len(names)], self.pos[at])
        order = np.argsort(own)
        own = own[order]

        def last(at: np.ndarray, code: np.ndarray) -> np.ndarray:
            """The last declaration of a name before a token, -1 without one or without an address."""
            asked = key(self.doc[at], code, self.pos[at])
            found = np.searchsorted(own, asked, side="right") - 1
            same = (found >= 0) & (own[found] // places == asked // places) if len(own) else np.zeros(len(at), bool)
            out = np.where(same, order[found] if len(own) else 0, -1)
            null = iris.is_null().to_numpy(zero_copy_only=False)
            return np.where((out >= 0) & null[out], -1, out) if len(null) else out

        self.address = np.full(len(self.pos), -1)
        self.address[self.prefixed] = last(self.prefixed, codes[1 + len(names) :])
        base = last(written, np.full(len(written), codes[0]))
        self.address[written] = np.where(base >= 0, base, len(iris) + self.doc[written])
        self.resolved = self.written | ((self.kind == _IRI) & ~self.is_a & (self.address >= 0))

    def values(self, scope: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
        """The values of all terms, in any order, and the place of each token's, -1 without one."""
        place = np.full(len(self.pos), -1)
        place[self.is_a] = 0
        parts, size = [pa.array([M.RDF_TYPE])], 1

        def put(at: np.ndarray, values: pa.StringArray) -> None:
            nonlocal size
            place[at] = np.arange(size, size + len(at))
            parts.append(values)
            size += len(at)

        def text(at: np.ndarray) -> pa.StringArray:
            return self.text.take(pa.array(at, pa.int64()))

        plain = _each(lambda x: re.sub(r"\\(.)", r"\1", x), self.local, where=pc.match_substring(self.local, "\\"))
        put(self.prefixed, _joined(_taken(self.addresses, self.address[self.prefixed]), plain))
        written = np.flatnonzero(self.written)
        iris, bases = _unescaped(_cut(text(written), 1, 1)), _taken(self.addresses, self.address[written])
        put(written, _all_resolved(iris, bases))
        quoted = np.flatnonzero(self.quoted)
        literals = text(quoted)
        long = pc.or_(pc.starts_with(literals, '"""'), pc.starts_with(literals, "'''"))
        values = _cut(literals, 1, 1)
        put(quoted, _unescaped(pc.if_else(long, _cut(literals, 3, 3), values) if pc.any(long).as_py() else values))
        # A mark where a subject is due stands for itself.
        other = np.flatnonzero(((self.kind == _LITERAL) & ~self.quoted) | (self.kind == _SEMICOLON) | (self.kind == _COMMA))
        put(other, text(other))
        nodes = np.flatnonzero(self.kind == _BNODE)
        put(nodes, _joined("_:s", scope.take(pa.array(self.doc[nodes], pa.int64())), ".", _cut(text(nodes), 2)))
        return pa.concat_arrays(parts), place

    def datatypes(self, at: np.ndarray) -> pa.StringArray:
        """The datatypes that the written form of tokens ``at`` has, null for those of quoted literals and other terms."""
        bare = np.flatnonzero((self.kind[at] == _LITERAL) & ~self.quoted[at])
        text = self.text.take(pa.array(at[bare], pa.int64()))
        kinds = [M.XSD + "boolean", M.XSD + "double", M.XSD + "decimal", M.XSD_INTEGER]
        checks = [pc.is_in(text, pa.array(["true", "false"])), pc.match_substring_regex(text, "[eE]"), pc.match_substring(text, ".")]
        found = np.full(len(at), -1)
        found[bare] = np.select([x.to_numpy(zero_copy_only=False) for x in checks], [0, 1, 2], 3)
        return _taken(pa.array(kinds), found)

    def reasons(self) -> np.ndarray:
        """For each document the greatest reason why its tokens cannot stand, 0 for none."""
        if not len(self.doc):
            return np.zeros(self.docs, np.int64)
        resolved = self.resolved
        typed = np.concatenate([resolved[2:], np.zeros(min(2, len(resolved)), bool)])
        # The datatype stands in the same document.
        typed &= np.concatenate([self.doc[2:], np.full(min(2, len(self.doc)), -1)]) == self.doc
        unknown = ((self.kind == _IRI) & ~self.is_a & ~resolved) | (self.typed & ~typed)
        checks = [
            ~self.attached & (self.kind == _UNKNOWN),
            ~self.attached & unknown,
            (self.level < 0) | (self.last & (self.level != 0)),
            self.last & (self.kind != _DOT) & ~self.declares,
        ]
        return _largest(np.select(checks, [4, 3, 2, 1], 0), self.doc, self.docs)


class _Rows:
    """Terms and marks of readable documents, each beside those of its level.

    A bracket opens a level of its own and is a term of the level around it.  Rows of one
    statement, or of one bracket, share a frame.
    """

    def __init__(self, tokens: _Tokens, good: np.ndarray) -> None:
        t = tokens
        at = np.flatnonzero(~t.attached & good[t.doc] & (t.kind != _CLOSE) & (t.kind != _CLOSE_LIST))
        opens = np.isin(t.kind[at], (_OPEN, _OPEN_LIST))
        role = np.where(t.kind[at] <= _COMMA, t.kind[at], _TERM)
        depth = np.concatenate([t.level[at] - opens, t.level[at[opens]]])
        at, role = np.concatenate([at, at[opens]]), np.concatenate([role, np.full(opens.sum(), _OPENER)])
        part = t.doc[at] * (depth.max(initial=0) + 1) + depth
        order = np.argsort(part * (t.pos.max(initial=0) + 1) + t.pos[at], kind="stable")
        self.at, self.role, self.depth, part = at[order], role[order], depth[order], part[order]
        self.doc, self.pos, self.kind = t.doc[self.at], t.pos[self.at], t.kind[self.at]
        rows, n = np.arange(len(part)), len(part)
        if not n:
            return
        new = np.concatenate([[True], np.diff(part) != 0])
        begins = np.maximum.accumulate(np.where(new, rows, 0))
        dots = np.cumsum(self.role == _DOT) - (self.role == _DOT)
        self.opener = _last(self.role == _OPENER, begins)
        frame = np.where(self.depth == 0, dots - dots[begins], self.pos[self.opener])
        self.in_list = (self.depth > 0) & (self.kind[self.opener] == _OPEN_LIST)
        starts = new | np.concatenate([[True], np.diff(frame) != 0])
        self.starts, self.first = starts, np.maximum.accumulate(np.where(starts, rows, 0))
        self.term = self.role == _TERM
        behind_start = np.concatenate([[False], starts[:-1]])
        behind_semicolon = np.concatenate([[False], self.role[:-1] == _SEMICOLON])
        self.is_predicate = self.term & ~starts & (behind_start | behind_semicolon)
        self.predicate = _last(self.is_predicate & ~self.in_list, begins)
        # Whether the next row is in the same frame.
        self.followed = np.concatenate([~starts[1:], [False]])
        self.next_role = np.where(self.followed, np.concatenate([self.role[1:], [_DOT]]), -1)

    def wrong(self, docs: int) -> np.ndarray:
        """For each document the greatest reason why its terms cannot stand, 0 for none."""
        if not len(self.at):
            return np.zeros(docs, np.int64)
        no_object = self.is_predicate & (self.next_role != _TERM)
        alone = self.starts & self.term & (self.kind != _OPEN) & (self.next_role == _DOT)
        checks = [
            ~self.in_list & self.is_predicate & (self.kind != _IRI),
            (self.depth == 0) & self.starts & (self.kind == _LITERAL),
            ~self.in_list & (no_object | alone),
        ]
        return _largest(np.select(checks, [1, 3, 2], 0), self.doc, docs)

    def statements(self, tokens: _Tokens, good: np.ndarray, scope: pa.StringArray, named: pa.StringArray) -> tuple[np.ndarray, list[pa.Array]]:
        """The document of each statement, and its terms; ``named`` names the documents in made labels."""
        none = np.full(0, -1)
        if not len(self.at):
            return none, [pa.array([], pa.string()) for _ in TERMS]
        values, value = tokens.values(scope)
        n = len(values)
        made = _joined("_:s", scope, ".", named, ".")
        texts, size = [values, pa.array(_FIXED)], n + len(_FIXED)

        def labels(kind: str, rows: np.ndarray, more: int = 0) -> np.ndarray:
            """Places of made labels; no written label starts with a dash."""
            nonlocal size
            if len(rows):
                texts.append(_joined(made.take(pa.array(self.doc[rows], pa.int64())), f"-{kind}", pa.array(self.pos[rows] + more).cast(pa.string())))
            size += len(rows)
            return np.arange(size - len(rows), size)

        node, kind = value[self.at], self.kind.copy()
        brackets, lists = self.kind == _OPEN, self.kind == _OPEN_LIST
        empty = lists & tokens.closes[self.at]
        node[brackets] = labels("node", np.flatnonzero(brackets))
        node[lists] = labels("list", np.flatnonzero(lists), 1)
        node[empty] = n
        kind[brackets | lists] = _BNODE
        kind[empty] = _IRI
        right = good[self.doc] & self.term
        listed, stated = np.flatnonzero(right & self.in_list), np.flatnonzero(right & ~self.in_list & ~self.starts & ~self.is_predicate)
        cells, followed = labels("list", listed), self.followed[listed]
        rest, rest_kind = np.full(len(listed), n), np.where(followed, _BNODE, _IRI)
        rest[followed] = labels("list", listed[followed] + 1)

        top, first, opener = self.depth[stated] == 0, self.first[stated], self.opener[stated]
        verb = self.predicate[stated]
        bnodes = np.full(len(listed), _BNODE)
        s_kind = np.concatenate([np.where(top, kind[first], _BNODE), bnodes, bnodes])
        s = np.concatenate([np.where(top, node[first], node[opener]), cells, cells])
        p = np.concatenate([np.where(verb < 0, -1, value[self.at[verb]]), np.full(len(listed), n + 1), np.full(len(listed), n + 2)])
        o_kind = np.concatenate([kind[stated], kind[listed], rest_kind])
        o = np.concatenate([node[stated], node[listed], rest])
        # Datatype and language stand behind the literal.
        place = np.concatenate([self.at[stated], self.at[listed]])
        text, kinds = pa.concat_arrays(texts), pa.array(_KINDS)
        typed, tagged = tokens.typed[place], tokens.has_lang[place]
        types = _taken(values, np.where(typed, value[np.minimum(place + 2, len(value) - 1)], -1))
        types = pc.if_else(pc.equal(types, _XSD_STRING), None, types)
        types = pc.coalesce(types, tokens.datatypes(place))
        tags = _cut(_taken(tokens.text, np.where(tagged, place + 1, -1)), 1)
        types, tags = (pa.concat_arrays([x, pa.nulls(len(listed), pa.string())]) for x in (types, tags))

        columns = [_taken(text, s), _taken(kinds, s_kind), _taken(text, p), _taken(text, o), _taken(kinds, o_kind), types, tags]
        return np.concatenate([self.doc[stated], self.doc[listed], self.doc[listed]]), columns


def _slices(texts: pa.Array) -> Iterator[tuple[int, int, pa.StringArray, np.ndarray]]:
    """Documents that are looked at together: begin, end, their tokens, and how many each has."""
    begin, size, found, sizes, parts = 0, 0, [], [], []
    for i, text in enumerate(texts):
        text = text.as_py()
        words = [] if text is None else _words(text.decode("utf-8", "replace"))
        sizes.append(len(words))
        if isinstance(words, list):
            found += words
        else:
            parts += [_column(found), words]
            found = []
        size += len(words) + (0 if text is None else len(text) * TOKENS // TEXT_BYTES)
        if size >= TOKENS or i == len(texts) - 1:
            yield begin, i + 1, pa.concat_arrays([*parts, _column(found)]), np.array(sizes, np.int64)
            begin, size, found, sizes, parts = i + 1, 0, [], [], []


def reader(keep: list[str], only_wrong: bool):
    """Batches with ``_body``, ``_scope``, ``_doc`` and ``_start`` as rows ``(*keep, reason, *TERMS)``.

    A document has statements or one reason, never both.  ``only_wrong`` leaves out
    statements and the columns of their terms.
    """
    reasons = pa.array([*REASONS, *WRONG[1:]], pa.string())

    def rows_of(batch: pa.RecordBatch, text: pa.StringArray, sizes: np.ndarray) -> pa.RecordBatch:
        scope, named, start = (batch.column(c).cast(pa.string()) for c in ("_scope", "_doc", "_start"))
        tokens = _Tokens(text, sizes, start)
        reason = tokens.reasons()
        if len(tokens.doc):
            rows = _Rows(tokens, reason == 0)
            wrong = rows.wrong(tokens.docs)
            reason = np.where(wrong > 0, wrong + len(REASONS) - 1, reason)
        doc, at = np.flatnonzero(reason), reason[reason > 0]
        columns = []
        if not only_wrong:
            stated, columns = rows.statements(tokens, reason == 0, scope, named) if len(tokens.doc) else (doc[:0], [pa.array([], pa.string()) for _ in TERMS])
            columns = [pa.concat_arrays([c, pa.nulls(len(doc), c.type)]) for c in columns]
            doc, at = np.concatenate([stated, doc]), np.concatenate([np.zeros(len(stated), np.int64), at])
        own = [batch.column(c).take(pa.array(doc, pa.int64())) for c in keep]
        names = [*keep, "reason", *([] if only_wrong else TERMS)]
        return pa.RecordBatch.from_arrays([*own, reasons.take(pa.array(at, pa.int64())), *columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, text, sizes in _slices(batch.column("_body").cast(pa.binary())):
                yield rows_of(batch.slice(begin, end - begin), text, sizes)

    return run
