"""Small statements frames for tests."""

from __future__ import annotations

from rdfweave import model as M

N = "http://ex.org/"


def term(text: str) -> tuple[str, str, str | None, str | None]:
    """``<iri>`` shortened to a name, ``_:label``, ``"text"``, ``"text"@en``, ``"4"^^int``."""
    if text.startswith('"'):
        value, _, rest = text[1:].rpartition('"')
        if rest.startswith("@"):
            return value, M.LITERAL, None, rest[1:]
        return value, M.LITERAL, M.XSD_INTEGER if rest == "^^int" else None, None
    if text.startswith("_:"):
        return text, M.BNODE, None, None
    return N + text, M.IRI, None, None


def statements(spark, rows):
    """Rows of (s, p, o[, source_id, source_type])."""
    out = []
    for s, p, o, *source in rows:
        source_id, source_type = source or (1, "turtle")
        sv, sk, _, _ = term(s)
        ov, ok, dt, lang = term(o)
        out.append((sv, sk, N + p, ov, ok, dt, lang, f"{N}graph/{source_id}", source_id, source_type))
    return spark.createDataFrame(out, M.STATEMENTS_SCHEMA)


def solutions(rows, p, depth):
    """All solutions of a predicate by brute force: lists of statements, per source key."""

    def key(row):
        source_id, source_type = row[3:] or (1, "turtle")
        return "local" if source_type in M.LOCAL_TYPES else f"{source_type}:{source_id}"

    facts = {(key(r), *r[:3]) for r in rows}

    def paths(k, node, hops):
        if hops == 0:
            return [[]]
        if node.startswith('"'):
            return []
        return [
            [(s, q, o), *rest]
            for (k2, s, q, o) in facts
            if k2 == k and s == node
            for rest in paths(k, o, hops - 1)
        ]

    found = []
    for k, s, q, o in facts:
        if p is None or q == p:
            found += [(k, [(s, q, o), *path]) for path in paths(k, o, depth - 1) or [[]]]
    return found
