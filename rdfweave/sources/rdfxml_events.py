"""Statements of one RDF/XML document, read as a stream of events.

A stack holds one frame per open element with what it passes on: base, language, and the
subject or the statement that it is a part of.  Nothing else of the document is kept, so
memory follows its depth and not its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.parsers import expat

from rdfweave import model as M

_XML = "http://www.w3.org/XML/1998/namespace "
_RDF = M.RDF + " "
# Attributes that are syntax, not properties.
_SYNTAX = {_RDF + n for n in ("about", "ID", "nodeID", "resource", "datatype", "parseType")} | {
    _XML + "lang",
    _XML + "base",
}
#: Signs of a document that are parsed at a time.
CHUNK = 1 << 16

_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.\-]*:")
_PARTS = re.compile(r"([A-Za-z][A-Za-z0-9+.\-]*:(?://[^/?#]*)?)([^?#]*)(.*)", re.DOTALL)


def _without_dots(path: str) -> str:
    """A path with its ``.`` and ``..`` segments carried out."""
    out: list[str] = []
    parts = path.split("/")
    for x in parts:
        if x == "..":
            del out[max(1, len(out) - 1) :]
        elif x != ".":
            out.append(x)
    return "/".join(out) + ("/" if parts[-1] in (".", "..") else "")


def resolved(iri: str, base: str | None) -> str:
    """``iri`` against ``base``, by the same rules as ``turtle.resolve_iri``."""
    if not base or _SCHEME.match(iri):
        return iri
    page = base.split("#", 1)[0]
    if iri == "":
        return page
    m = _PARTS.match(base)
    origin, path = (m[1], m[2]) if m else ("", page.split("?", 1)[0])
    if iri.startswith("//"):
        return base.split(":", 1)[0] + ":" + iri
    if iri.startswith("#"):
        return page + iri
    if iri.startswith("?"):
        return page.split("?", 1)[0] + iri
    name, mark, rest = re.match(r"([^?#]*)([?#]?)(.*)", iri, re.DOTALL).groups()
    if not iri.startswith("/"):
        folder = path[: path.rfind("/") + 1] or ("/" if "//" in origin else "")
        name = folder + name
    return origin + (_without_dots(name) if name.startswith("/") else name) + mark + rest


def _iri(name: str) -> str:
    """The address of an element or attribute name; plain markup has none."""
    if " " not in name:
        raise ValueError(f"name without a namespace: {name}")
    return name.replace(" ", "", 1)


ROOT, NODE, PROPERTY, COLLECTION, LITERAL = "root", "node", "property", "collection", "literal"


class _Frame:
    """An open element: what it is, what it passes on, and what it has met so far."""

    __slots__ = ("kind", "base", "lang", "subject", "predicate", "datatype", "id", "text", "object", "members", "last", "builder", "depth")

    def __init__(self, kind: str, base: str | None, lang: str | None, subject=None, predicate: str = "") -> None:
        self.kind, self.base, self.lang, self.subject, self.predicate = kind, base, lang, subject, predicate
        self.datatype = self.id = self.object = self.last = self.builder = None
        self.text: list[str] = []
        self.members = self.depth = 0


class Reader:
    """Collects (s, s_kind, p, o, o_kind, datatype, lang) in ``rows``.

    Labels of blank nodes are returned as written, those of nodes without one begin with
    a dash; they are scoped in Spark afterwards.
    """

    def __init__(self, base: str | None) -> None:
        self.rows: list[tuple] = []
        self.made, self.base, self.stack = 0, base, []
        self.parser = expat.ParserCreate(namespace_separator=" ")
        self.parser.buffer_text = True
        self.parser.StartElementHandler = self.start
        self.parser.EndElementHandler = self.end
        self.parser.CharacterDataHandler = self.characters

    def new_node(self) -> tuple[str, str]:
        self.made += 1
        return f"-node{self.made}", M.BNODE

    def add(self, s, p, o, datatype=None, lang=None) -> None:
        self.rows.append((s[0], s[1], p, o[0], o[1], datatype, lang))

    def state(self, frame: _Frame, o, datatype=None, lang=None) -> None:
        """The statement of a property, and what its ``rdf:ID`` says of it."""
        self.add(frame.subject, frame.predicate, o, datatype, lang)
        if frame.id is not None:
            about = (resolved("#" + frame.id, frame.base), M.IRI)
            self.add(about, M.RDF_TYPE, (M.RDF + "Statement", M.IRI))
            self.add(about, M.RDF + "subject", frame.subject)
            self.add(about, M.RDF + "predicate", (frame.predicate, M.IRI))
            self.add(about, M.RDF + "object", o, datatype, lang)

    def reference(self, attributes: dict, name: str, base: str | None):
        if _RDF + name in attributes:
            return resolved(attributes[_RDF + name], base), M.IRI
        if name == "about" and _RDF + "ID" in attributes:
            return resolved("#" + attributes[_RDF + "ID"], base), M.IRI
        if _RDF + "nodeID" in attributes:
            return attributes[_RDF + "nodeID"], M.BNODE
        return None

    def properties_of(self, s, attributes: dict, base: str | None, lang: str | None) -> None:
        for name, text in attributes.items():
            if name == _RDF + "type":
                self.add(s, M.RDF_TYPE, (resolved(text, base), M.IRI))
            elif name not in _SYNTAX and " " in name and not name.startswith(_XML):
                self.add(s, _iri(name), (text, M.LITERAL), None, lang)

    def start(self, name: str, attributes: dict) -> None:
        above = self.stack[-1] if self.stack else None
        if above is not None and above.kind == LITERAL:
            above.depth += 1
            above.builder.start(_qualified(name), {_qualified(k): v for k, v in attributes.items()})
            return
        base = above.base if above else self.base
        lang = above.lang if above else None
        if _XML + "base" in attributes:
            base = resolved(attributes[_XML + "base"], base).split("#", 1)[0]
        if _XML + "lang" in attributes:
            lang = attributes[_XML + "lang"] or None
        if above is None and name == _RDF + "RDF":
            self.stack.append(_Frame(ROOT, base, lang))
        elif above is None or above.kind in (ROOT, PROPERTY, COLLECTION):
            self.stack.append(self.node(above, name, attributes, base, lang))
        else:
            self.stack.append(self.property(above, name, attributes, base, lang))

    def node(self, above: _Frame | None, name: str, attributes: dict, base, lang) -> _Frame:
        s = self.reference(attributes, "about", base) or self.new_node()
        if above is not None and above.kind == PROPERTY:
            if above.object is not None:
                raise ValueError(f"a second value in one property: {_iri(name)}")
            above.object = s
            self.state(above, s)
        elif above is not None and above.kind == COLLECTION:
            cell = self.new_node()
            if above.last is None:
                self.state(above, cell)
            else:
                self.add(above.last, M.RDF + "rest", cell)
            self.add(cell, M.RDF + "first", s)
            above.last = cell
        if name != _RDF + "Description":
            self.add(s, M.RDF_TYPE, (_iri(name), M.IRI))
        self.properties_of(s, attributes, base, lang)
        return _Frame(NODE, base, lang, s)

    def property(self, above: _Frame, name: str, attributes: dict, base, lang) -> _Frame:
        predicate = _iri(name)
        if name == _RDF + "li":
            above.members += 1
            predicate = f"{M.RDF}_{above.members}"
        frame = _Frame(PROPERTY, base, lang, above.subject, predicate)
        frame.id = attributes.get(_RDF + "ID")
        parse = attributes.get(_RDF + "parseType")
        target = self.reference(attributes, "resource", base)
        if parse == "Resource":
            node = self.new_node()
            self.state(frame, node)
            return _Frame(NODE, base, lang, node)
        if parse == "Collection":
            frame.kind = COLLECTION
        elif parse is not None:
            frame.kind, frame.builder = LITERAL, ElementTree.TreeBuilder()
            frame.builder.start("literal", {})
        elif target is not None or any(a not in _SYNTAX and " " in a for a in attributes):
            frame.object = target or self.new_node()
            self.state(frame, frame.object)
            self.properties_of(frame.object, attributes, base, lang)
        elif _RDF + "datatype" in attributes:
            frame.datatype = resolved(attributes[_RDF + "datatype"], base)
        return frame

    def characters(self, text: str) -> None:
        if not self.stack:
            return
        frame = self.stack[-1]
        if frame.kind == LITERAL:
            frame.builder.data(text)
        elif frame.kind == PROPERTY and frame.object is None:
            frame.text.append(text)

    def end(self, name: str) -> None:
        frame = self.stack[-1]
        if frame.kind == LITERAL and frame.depth:
            frame.depth -= 1
            frame.builder.end(_qualified(name))
            return
        self.stack.pop()
        if frame.kind == LITERAL:
            frame.builder.end("literal")
            root = frame.builder.close()
            inner = (root.text or "") + "".join(ElementTree.tostring(x, encoding="unicode") for x in root)
            self.state(frame, (inner, M.LITERAL), M.RDF + "XMLLiteral")
        elif frame.kind == COLLECTION:
            nothing = (M.RDF + "nil", M.IRI)
            if frame.last is None:
                self.state(frame, nothing)
            else:
                self.add(frame.last, M.RDF + "rest", nothing)
        elif frame.kind == PROPERTY and frame.object is None:
            text = ("".join(frame.text), M.LITERAL)
            self.state(frame, text, frame.datatype, None if frame.datatype else frame.lang)


def _qualified(name: str) -> str:
    space, _, local = name.rpartition(" ")
    return f"{{{space}}}{local}" if space else local


def statements(text: str, base: str | None = None) -> Iterator[list[tuple]]:
    """Statements, as many at a time as a stretch of the document holds.

    Raises ``ValueError`` where the document turns out to be no RDF/XML.
    """
    reader = Reader(base)
    try:
        for at in range(0, len(text), CHUNK):
            reader.parser.Parse(text[at : at + CHUNK], False)
            if reader.rows:
                yield reader.rows
                reader.rows = []
        reader.parser.Parse("", True)
    except (expat.ExpatError, ValueError) as error:
        raise ValueError(f"not RDF/XML: {error}") from None
    if reader.rows:
        yield reader.rows


def reason(text: str) -> str | None:
    """Why a document cannot be read; ``None`` if it can."""
    try:
        for _ in statements(text):
            pass
    except ValueError as error:
        return str(error)
    return None
