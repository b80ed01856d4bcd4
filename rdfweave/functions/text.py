"""Column functions between terms and their written form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rdfweave import model as M

# Characters with a short escape inside a quoted literal.
SHORT_ESCAPES = {"\\t": "\t", "\\b": "\b", "\\n": "\n", "\\r": "\r", "\\f": "\f"}
# Characters that may not stand in a written IRI.
IRI_ESCAPED = ["\\", "<", ">", '"', " ", "{", "}", "|", "^", "`"]

# Tokens of a text with escapes.  A surrogate pair is one token; a lone surrogate
# is no character and falls apart into plain tokens.  No alternative repeats a
# group, so that long texts cannot overflow the matcher's stack.
_SINGLE = r"\\u(?![dD][89a-fA-F])[0-9a-fA-F]{4}"
_PAIR = r"\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}"
_LONG = r"\\U(?!0000[dD][89a-fA-F])00(?:0[0-9a-fA-F]|10)[0-9a-fA-F]{4}"
_TOKENS = rf"(?s){_PAIR}|{_SINGLE}|{_LONG}|[^\\]++|\\.|\\"


def _decode(token: Column, otherwise: Column) -> Column:
    # Of the tokens above, only character codes have these beginnings and lengths.
    low, high, long = F.substring(token, 3, 4), F.substring(token, 9, 4), F.substring(token, 3, 8)
    size = F.length(token)
    return (
        F.when(~token.startswith("\\"), token)
        .when(token.startswith("\\u") & (size == 6), F.decode(F.unhex(low), "UTF-16BE"))
        .when(token.startswith("\\u") & (size == 12), F.decode(F.unhex(F.concat(low, high)), "UTF-16BE"))
        .when(token.startswith("\\U") & (size == 10), F.decode(F.unhex(long), "UTF-32"))
        .otherwise(otherwise)
    )


def _by_token(text: Column, change) -> Column:
    tokens = F.regexp_extract_all(text, F.lit(_TOKENS), F.lit(0))
    changed = F.array_join(F.transform(tokens, change), "")
    return F.when(F.contains(text, F.lit("\\")), changed).otherwise(text)


def decode_unicode(text: Column) -> Column:
    """Replace ``\\uXXXX`` and ``\\UXXXXXXXX`` by their characters.

    Surrogate pairs become one character; an escaped backslash stays as it is, and
    so does what follows it.
    """
    return _by_token(text, lambda token: _decode(token, token))


def unescape(text: Column) -> Column:
    """The value of a quoted literal: short escapes and character codes decoded."""

    def change(token: Column) -> Column:
        value = F.when(F.length(token) < 2, token)
        for written, character in SHORT_ESCAPES.items():
            value = value.when(token == written, F.lit(character))
        value = value.when(token.isin('\\"', "\\'", "\\\\"), F.substring(token, 2, 1))
        return _decode(token, value.otherwise(token))

    return _by_token(text, change)


def escape_literal(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit('"'), F.lit('\\"'))
    for written, character in SHORT_ESCAPES.items():
        out = F.replace(out, F.lit(character), F.lit(written))
    return out


def escape_iri(iri: Column) -> Column:
    out = iri
    for character in IRI_ESCAPED:
        out = F.replace(out, F.lit(character), F.lit(f"\\u{ord(character):04X}"))
    return F.when(F.regexp_like(iri, F.lit(r'[\\<>" {}|^`]')), out).otherwise(iri)


def written_iri(iri: Column) -> Column:
    return F.concat(F.lit("<"), escape_iri(iri), F.lit(">"))


def written_resource(kind: Column, value: Column) -> Column:
    return F.when(kind == M.IRI, written_iri(value)).otherwise(value)


def written_object(kind: Column, value: Column, datatype: Column, lang: Column) -> Column:
    quoted = F.concat(F.lit('"'), escape_literal(value), F.lit('"'))
    literal = (
        F.when(lang.isNotNull(), F.concat(quoted, F.lit("@"), lang))
        .when(datatype.isNotNull(), F.concat(quoted, F.lit("^^"), written_iri(datatype)))
        .otherwise(quoted)
    )
    return F.when(kind == M.LITERAL, literal).otherwise(written_resource(kind, value))


def written_subject() -> Column:
    return written_resource(F.col("s_kind"), F.col("s"))


def written_predicate() -> Column:
    return written_iri(F.col("p"))


def written_value() -> Column:
    return written_object(F.col("o_kind"), F.col("o"), F.col("o_datatype"), F.col("o_lang"))


def statement() -> Column:
    """One N-Triples statement per row of a statements frame."""
    return F.concat_ws(" ", written_subject(), written_predicate(), written_value(), F.lit("."))
