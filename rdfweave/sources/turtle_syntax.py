"""Where Turtle statements end and what they declare, read from any stretch of a file.

Lines end outside all tokens but long literals, so before a line there are four states:
between statements, inside one, and inside a long literal of either quote.
"""

from __future__ import annotations

import re

BETWEEN, INSIDE, DOUBLE, SINGLE = range(4)

# The same tokens as in ``turtle``, in the spelling of this matcher.
_COMMENT = r"#[^\n\r]*+"
_IRI = r'<[^<>"{}|^`\x00-\x20]*+>'
_LOCAL = r"[\w:\-]|%[0-9a-fA-F]{2}|\\[_~.!$&'()*+,;=/?#@%\-]"
_LETTER = r"[^\W\d_]"
_PREFIX = rf"(?:{_LETTER}(?:[\w\-]|\.(?=[\w\-.]*:))*+)?:"
_REST_OF = {DOUBLE: r'[^"\\]*+(?:(?:\\.|"(?!""))[^"\\]*+)*+"""', SINGLE: r"[^'\\]*+(?:(?:\\.|'(?!''))[^'\\]*+)*+'''"}
_TOKENS = [
    _COMMENT,
    _IRI,
    '"""' + _REST_OF[DOUBLE],
    "'''" + _REST_OF[SINGLE],
    r'(?!""")"[^"\\\n\r]*+(?:\\.[^"\\\n\r]*+)*+"',
    r"(?!''')'[^'\\\n\r]*+(?:\\.[^'\\\n\r]*+)*+'",
    r"_:\w(?:[\w\-]|\.++(?=[\w\-]))*+",
    rf"{_PREFIX}(?:{_LOCAL}|\.++(?={_LOCAL}))*+",
    r"@[a-zA-Z]+(?:-[a-zA-Z0-9]+)*+",
    r"[+-]?(?:[0-9]++\.[0-9]*+[eE][+-]?[0-9]++|\.?[0-9]++[eE][+-]?[0-9]++|[0-9]*+\.[0-9]++|[0-9]++)",
    r"[a-zA-Z]++",
    r"[;,^]",
]
# All tokens up to one that counts: a bracket, a dot, or the start of a literal without an end.
STEP = re.compile(rf"(?s)(?:\s++|{'|'.join(_TOKENS)})*+(?:([\[\](.)])|(\"\"\"|''')|\S|\Z)")
REST_OF = {state: re.compile(f"(?s){rest}") for state, rest in _REST_OF.items()}
_GAP = rf"(?:\s++|{_COMMENT})*+"
BLANK = re.compile(_GAP)
LINE_END = re.compile(r"(?:[ \t\r]*+\n)?")
_NAMED = rf"({_PREFIX}){_GAP}<([^<>\"{{}}|^`\x00-\x20]*+)>"
_HERE = r"<([^<>\"{}|^`\x00-\x20]*+)>"
DIRECTIVE = re.compile(
    rf"{_GAP}(?:(?i:@prefix)(?![a-zA-Z0-9\-]){_GAP}{_NAMED}{_GAP}\.|(?i:prefix)(?=[\s#]){_GAP}{_NAMED}"
    rf"|(?i:@base)(?![a-zA-Z0-9\-]){_GAP}{_HERE}{_GAP}\.|(?i:base)(?=[\s<#]){_GAP}{_HERE})"
)
DECLARES = re.compile("(?i)prefix|base")
NO_NAME = re.compile(r"[^\w.\-:]+")

states = 4


def _run(text: str, at: int) -> tuple[int, int]:
    """State behind a stretch that begins outside literals, and the change of depth.

    The state is ``INSIDE`` if nothing but blanks stands there; that may mean either.
    """
    depth, closed = 0, -1
    for m in STEP.finditer(text, at):
        if m[1] in ("[", "("):
            depth += 1
        elif m[1] in ("]", ")"):
            depth -= 1
        elif m[1]:
            closed = m.end()
        elif m[2]:
            return (DOUBLE if m[2][0] == '"' else SINGLE), depth
    between = closed >= 0 and BLANK.match(text, closed).end() == len(text)
    return (BETWEEN if between else INSIDE), depth


def passes(text: str) -> list[tuple[int, int]]:
    blank = BLANK.match(text).end() == len(text)
    inside = _run(text, 0)
    out = [(BETWEEN, 0) if blank else inside, inside]
    for state in (DOUBLE, SINGLE):
        m = REST_OF[state].match(text)
        out.append(_run(text, m.end()) if m else (state, 0))
    return out


def _statements(text: str, state: int, depth: int):
    """(end, directive) of each statement; the directive is a match or ``None``."""
    at = 0
    if state in REST_OF:
        m = REST_OF[state].match(text)
        if not m:
            return
        at = m.end()
    between = state == BETWEEN and depth <= 0
    if between:
        yield 0, None
    while True:
        if between and (m := DIRECTIVE.match(text, at)):
            at = LINE_END.match(text, m.end()).end()
            yield at, m
            continue
        m = STEP.match(text, at)
        at, between = m.end(), False
        if m[1] in ("[", "("):
            depth += 1
        elif m[1] in ("]", ")"):
            depth -= 1
        elif m[1] and depth <= 0:
            between = True
            at = LINE_END.match(text, at).end()
            yield at, None
        elif m[2] or at >= len(text):
            return


def ends(text: str, state: int, depth: int) -> list[int]:
    return [end for end, _ in _statements(text, state, depth)]


def _declared(m: re.Match) -> tuple[str, str]:
    """(name with its colon or empty for the base, written address) of a directive."""
    for name, iri in ((1, 2), (3, 4)):
        if m[name] is not None:
            return m[name], m[iri]
    return "", m[5] if m[5] is not None else m[6]


def directives(text: str) -> list[tuple[int, str, str]]:
    """(place, name, written address) of the directives of a text that begins with a statement."""
    if not DECLARES.search(text):
        return []
    return [(end, *_declared(m)) for end, m in _statements(text, BETWEEN, 0) if m]


def names(text: str) -> list[str]:
    """What may be a prefix in a text; some of it is not."""
    return sorted({x[: x.index(":") + 1].lstrip("-.0123456789") for x in set(NO_NAME.split(text)) if ":" in x})


def one_by_one(text: str) -> list[str]:
    """Every statement of a text behind the directives that stand before it."""
    known, out, at = {}, [], 0
    for end, m in _statements(text, BETWEEN, 0):
        part, at = text[at:end], end
        if m:
            name, _ = _declared(m)
            # Addresses may rest on the base that was declared before them.
            known = {**known, (name, len(known) if not name else 0): part.strip()}
        elif part.strip():
            out.append("\n".join([*known.values(), part.strip()]) + "\n")
    if text[at:][BLANK.match(text, at).end() - at :]:
        out.append("\n".join([*known.values(), text[at:]]))
    return out
