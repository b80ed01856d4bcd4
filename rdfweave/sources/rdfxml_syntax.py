"""Where the elements below the root of an XML document end, read from any stretch of it.

The state before a line says what markup is open there; the depth counts open elements.
"""

from __future__ import annotations

import re

CONTENT, TAG, TAG_DOUBLE, TAG_SINGLE, COMMENT, CDATA, INSTRUCTION, DOCTYPE, SUBSET, CLOSING = range(10)
states = 10

_VALUES = r"""(?:"[^"]*+"|'[^']*+')"""
# How each kind of open markup goes on to its end.
_REST = {
    TAG: rf"""[^<>"']*+(?:{_VALUES}[^<>"']*+)*+>""",
    TAG_DOUBLE: rf"""[^"]*+"[^<>"']*+(?:{_VALUES}[^<>"']*+)*+>""",
    TAG_SINGLE: rf"""[^']*+'[^<>"']*+(?:{_VALUES}[^<>"']*+)*+>""",
    COMMENT: r"[\s\S]*?-->",
    CDATA: r"[\s\S]*?\]\]>",
    INSTRUCTION: r"[\s\S]*?\?>",
    DOCTYPE: r"""[^\[>]*+(?:\[[\s\S]*?\]\s*+)?>""",
    SUBSET: r"[\s\S]*?\]\s*+>",
    CLOSING: r"[^<>]*+>",
}
REST = {state: re.compile(rest) for state, rest in _REST.items()}
# What an end of markup must hold; without it nothing need be searched.
SIGN = {COMMENT: "-->", CDATA: "]]>", INSTRUCTION: "?>", SUBSET: "]"}
# Markup that is whole, or else the rest of the stretch behind a sign that opens some.
MARKUP = re.compile(
    rf"<!--{_REST[COMMENT]}|<!\[CDATA\[{_REST[CDATA]}|<\?{_REST[INSTRUCTION]}|<!(?!--|\[){_REST[DOCTYPE]}"
    rf"|(</{_REST[CLOSING]})|(<(?![!?/]){_REST[TAG]})|(<[\s\S]*+)"
)
_OPEN = (("<!--", COMMENT), ("<![CDATA[", CDATA), ("<?", INSTRUCTION), ("</", CLOSING))
_VALUE = re.compile(_VALUES)


def _opened(rest: str) -> int:
    """The state that unfinished markup leaves."""
    for sign, state in _OPEN:
        if rest.startswith(sign):
            return state
    if rest.startswith("<!"):
        return SUBSET if "[" in rest else DOCTYPE
    return _in_tag(rest)


def _in_tag(rest: str) -> int:
    left = _VALUE.sub("", rest)
    at = min((left.find(q) for q in "\"'" if q in left), default=-1)
    return TAG if at < 0 else TAG_DOUBLE if left[at] == '"' else TAG_SINGLE


def _markup(text: str, state: int):
    """(end, change of depth, state behind it) of each markup in a stretch."""
    at = 0
    if state != CONTENT:
        m = REST[state].match(text) if SIGN.get(state, ">") in text else None
        if not m:
            yield len(text), 0, _still(text, state)
            return
        at = m.end()
        yield at, 0 if state > TAG_SINGLE and state != CLOSING else _change(m[0], state == CLOSING), CONTENT
    for m in MARKUP.finditer(text, at):
        if m[3]:
            yield len(text), 0, _opened(m[3])
        else:
            yield m.end(), _change(m[0], bool(m[1])) if m[1] or m[2] else 0, CONTENT


def _still(text: str, state: int) -> int:
    """The state behind a stretch in which open markup does not end."""
    if state in (TAG, TAG_DOUBLE, TAG_SINGLE):
        return _in_tag({TAG: "", TAG_DOUBLE: '"', TAG_SINGLE: "'"}[state] + text)
    return SUBSET if state == DOCTYPE and "[" in text else state


def _change(tag: str, closing: bool) -> int:
    return -1 if closing else 0 if tag.endswith("/>") else 1


def passes(text: str) -> list[tuple[int, int]]:
    """Markup that is read from another state soon meets markup that is read from content;
    from there on both agree, so a stretch is read about once."""
    behind, depth, state = {}, 0, CONTENT
    for end, change, state in _markup(text, CONTENT):
        depth += change
        if state == CONTENT:
            behind[end] = depth
    out = [(state, depth)]
    for start in range(1, states):
        here, now = 0, start
        for end, change, now in _markup(text, start):
            here += change
            if now == CONTENT and end in behind:
                here, now = here + depth - behind[end], state
                break
        out.append((now, here))
    return out


def ends(text: str, state: int, depth: int) -> list[int]:
    """Behind the root's start tag, and behind every element right below the root."""
    out = [0] if state == CONTENT and depth == 1 else []
    for end, change, _ in _markup(text, state):
        depth += change
        # Comments and the like change nothing and end nothing.
        if depth == 1 and text[end - 1 : end] == ">" and (change or text[end - 2 : end - 1] == "/"):
            out.append(end)
    return out


HEAD = re.compile(r"<(?![!?])((?:[^\W\d][\w.\-]*:)?RDF)(?=[\s>])")


def one_by_one(text: str) -> list[str]:
    """Every element below the root as a document with the start and the end of the whole."""
    found = ends(text, CONTENT, 0)
    root = HEAD.search(text[: found[0]]) if found else None
    if not root:
        return [text]
    head, foot = text[: found[0]], f"</{root[1]}>"
    parts = [p for a, b in zip(found, found[1:]) if (p := text[a:b].strip())]
    rest = re.sub(rf"\s*{re.escape(foot[:-1])}\s*>\s*\Z", "", text[found[-1] :])
    return [head + p + foot for p in (*parts, *([rest] if rest.strip() else []))]
