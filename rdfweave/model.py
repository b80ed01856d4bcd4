"""The statements table: column layout, terms and statement patterns.

One row is one statement.  Terms are stored without angle brackets or quotes; what
they are is told by ``s_kind`` / ``o_kind`` and, for literals, by ``o_datatype``
and ``o_lang``.  Two terms are the same when all of these agree.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

IRI, BNODE, LITERAL = "uri", "bnode", "literal"

# Public RDF vocabulary IRIs.
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XSD = "http://www.w3.org/2001/XMLSchema#"
HYDRA = "http://www.w3.org/ns/hydra/core#"
VOID = "http://rdfs.org/ns/void#"
RDF_TYPE = RDF + "type"
XSD_INTEGER = XSD + "integer"

# The four kinds of source, in the order their answers are paged.
# Turtle and RDF/XML files are loaded and together form one local default graph.
LOCAL_TYPES = ("turtle", "rdf")
REMOTE_TYPES = ("sparql", "ldf")
SOURCE_TYPES = LOCAL_TYPES + REMOTE_TYPES

TERMS = ["s", "s_kind", "p", "o", "o_kind", "o_datatype", "o_lang"]
SOURCE = ["source_rank", "source_key"]

STATEMENTS_SCHEMA = T.StructType(
    [
        T.StructField("s", T.StringType()),
        T.StructField("s_kind", T.StringType()),
        T.StructField("p", T.StringType()),
        T.StructField("o", T.StringType()),
        T.StructField("o_kind", T.StringType()),
        T.StructField("o_datatype", T.StringType()),
        T.StructField("o_lang", T.StringType()),
        T.StructField("graph", T.StringType()),
        T.StructField("source_id", T.IntegerType()),
        T.StructField("source_type", T.StringType()),
    ]
)


def source_key(source_type: Column, source_id: Column) -> Column:
    """The default graph a statement belongs to: all loaded files share ``local``."""
    return F.when(source_type.isin(*LOCAL_TYPES), F.lit("local")).otherwise(
        F.concat(source_type, F.lit(":"), source_id.cast("string"))
    )


def source_rank(source_type: Column) -> Column:
    """Paging order of the sources: local, then sparql, then ldf."""
    return (
        F.when(source_type.isin(*LOCAL_TYPES), F.lit(0))
        .when(source_type == "sparql", F.lit(1))
        .otherwise(F.lit(2))
    )


def scoped_bnode(label: Column, source_id: Column) -> Column:
    """Blank-node labels are only unique inside a source, so carry its id."""
    return F.concat(F.lit("_:s"), source_id.cast("string"), F.lit("."), label)


@dataclass(frozen=True)
class Term:
    """A bound position of a statement pattern."""

    kind: str
    value: str
    datatype: str | None = None
    lang: str | None = None

    @staticmethod
    def iri(value: str) -> "Term":
        return Term(IRI, value)

    @staticmethod
    def bnode(label: str) -> "Term":
        return Term(BNODE, label)

    @staticmethod
    def text(value: str, lang: str | None = None) -> "Term":
        return Term(LITERAL, value, lang=lang)

    @staticmethod
    def typed(value: object, datatype: str) -> "Term":
        return Term(LITERAL, str(value), datatype=datatype)

    @staticmethod
    def number(value: int) -> "Term":
        """A bare integer: another term than the text ``"42"``."""
        return Term.typed(value, XSD_INTEGER)

    def matches(self, position: str) -> Column:
        """Equality conjuncts on one position; all reach the Parquet scan."""
        value = F.col(position) == self.value
        if position == "p":
            return value
        test = value & (F.col(f"{position}_kind") == self.kind)
        if position == "o" and self.kind == LITERAL:
            for column, wanted in (("o_datatype", self.datatype), ("o_lang", self.lang)):
                test &= F.col(column).isNull() if wanted is None else F.col(column) == wanted
        return test


@dataclass(frozen=True)
class Pattern:
    """A statement pattern; an unset position is open.

    ``hash_variants`` lets the subject also match ``subject#anything``, ignoring
    case.  It has no effect on an open subject.
    """

    s: Term | None = None
    p: Term | None = None
    o: Term | None = None
    hash_variants: bool = False

    @property
    def by_hash(self) -> bool:
        return self.hash_variants and self.s is not None

    @property
    def is_open(self) -> bool:
        """Nothing bound, or nothing but a subject that is matched by its hash variants."""
        return (self.s is None or self.by_hash) and self.p is None and self.o is None


def _resource(text: str | None, variable: str) -> Term | None:
    if text is None or text == variable:
        return None
    if text.startswith("<") and text.endswith(">"):
        return Term.iri(text[1:-1])
    if text.startswith("_:"):
        return Term.bnode(text)
    return Term.iri(text)


def pattern_from_parameters(
    subject: str | None = None,
    predicate: str | None = None,
    object: str | None = None,
    hash_variants: bool = False,
) -> Pattern:
    """Read request parameters: an address is an IRI, any other object is plain text.

    Unset parameters and ``?s`` / ``?p`` / ``?o`` stay open.
    """
    if object is None or object == "?o":
        o = None
    elif object.startswith("http"):
        o = Term.iri(object)
    elif object.startswith("<http"):
        o = Term.iri(object[1:].removesuffix(">"))
    else:
        o = Term.text(object.strip('"'))
    return Pattern(_resource(subject, "?s"), _resource(predicate, "?p"), o, hash_variants)


def object_term(parameter: Column) -> Column:
    """The same reading of an ``object`` parameter as a column: ``struct(kind, value)``."""
    enclosed = parameter.startswith("<http")
    return F.when(
        parameter.isNotNull() & (parameter != "?o"),
        F.struct(
            F.when(parameter.startswith("http") | enclosed, F.lit(IRI))
            .otherwise(F.lit(LITERAL))
            .alias("kind"),
            F.when(parameter.startswith("http"), parameter)
            .when(enclosed, F.regexp_replace(parameter, "^<|>$", ""))
            .otherwise(F.regexp_replace(parameter, '^"+|"+$', ""))
            .alias("value"),
        ),
    )


def request_subject(uri: Column, root: Column) -> Column:
    """The subject a request names; an empty or root address names none (null)."""
    return F.when((F.length(uri) > 0) & (uri != root), uri)
