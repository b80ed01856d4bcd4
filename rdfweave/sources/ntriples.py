"""N-Triples: line scan, line sink, and the split into good and bad statements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rdfweave import model as M
from rdfweave.functions.text import statement, unescape

# One statement per line.  Possessive repeats keep very long literals off the
# matcher's stack.
_IRI = r'<([^<>"{}|^`\x00-\x20]*)>'
_BNODE = r"(_:[^\s<>\"]+)"
_QUOTED = r'"([^"\\]*+(?:\\.[^"\\]*+)*+)"'
_TAG = r"(?:\^\^" + _IRI + r"|@([a-zA-Z]+(?:-[a-zA-Z0-9]+)*+))?"
STATEMENT = (
    rf"^[ \t]*(?:{_IRI}|{_BNODE})[ \t]*{_IRI}[ \t]*"
    rf"(?:{_IRI}|{_BNODE}|({_QUOTED}){_TAG})[ \t]*\.[ \t]*(?:#.*)?$"
)
# Groups: subject IRI and blank node, predicate, object IRI and blank node, quoted
# literal with quotes and without, datatype, language.  A line break cannot occur
# inside a line, so it separates the groups safely.
_GROUPS = "\n".join(f"${n}" for n in range(1, 10))


def read_lines(spark: SparkSession, paths: str | list[str], with_path: bool = False) -> DataFrame:
    """The lines of files, with the ``path`` of each and its key ``file`` if asked for:
    blank nodes of two files of one source are two nodes."""
    lines, path = spark.read.text(paths), F.col("_metadata.file_path")
    return lines.select("value", path.alias("path"), F.sha1(path).alias("file")) if with_path else lines


def with_statement(lines: DataFrame, line: str = "value") -> DataFrame:
    """Adds ``_parts``: the nine groups of a statement, or one element for a bad line."""
    return lines.withColumn(
        "_parts", F.split(F.regexp_replace(F.col(line), STATEMENT, _GROUPS), "\n", -1)
    )


def is_statement() -> Column:
    return F.size("_parts") == 9


def is_blank(line: Column) -> Column:
    return F.regexp_like(line, F.lit(r"^\s*(#.*)?$"))


def _given(part: Column) -> Column:
    return F.when(part != "", part)


def _terms(source_id: Column) -> list[Column]:
    """The terms of a statement, whose groups are ``_parts``."""
    part = [F.col("_parts")[n] for n in range(9)]
    datatype = _given(unescape(part[7]))
    return [
        F.when(part[1] != "", M.scoped_bnode(F.substring(part[1], 3, 1 << 30), source_id))
        .otherwise(unescape(part[0]))
        .alias("s"),
        F.when(part[1] != "", M.BNODE).otherwise(M.IRI).alias("s_kind"),
        unescape(part[2]).alias("p"),
        F.when(part[5] != "", unescape(part[6]))
        .when(part[4] != "", M.scoped_bnode(F.substring(part[4], 3, 1 << 30), source_id))
        .otherwise(unescape(part[3]))
        .alias("o"),
        F.when(part[5] != "", M.LITERAL).when(part[4] != "", M.BNODE).otherwise(M.IRI).alias("o_kind"),
        # xsd:string says no more than a plain literal does
        F.when(datatype != M.XSD + "string", datatype).alias("o_datatype"),
        _given(part[8]).alias("o_lang"),
    ]


def parse(lines: DataFrame, source_id: Column, line: str = "value") -> DataFrame:
    """Statements of the good lines.  Blank nodes are scoped by ``source_id``.

    Other columns of ``lines`` are kept.
    """
    kept = [c for c in lines.columns if c != line]
    return with_statement(lines, line).filter(is_statement()).select(*_terms(source_id), *kept)


def _reason(line: str) -> Column:
    return (
        F.when(~F.regexp_like(F.col(line), F.lit(r"\.\s*$")), "statement has no closing dot")
        .when(F.regexp_like(F.col(line), F.lit(r'^\s*"')), "subject is a literal")
        .otherwise("not a statement")
    )


def rejects(lines: DataFrame, line: str = "value") -> DataFrame:
    """Lines that are neither statements nor blank, with the reason."""
    kept = [c for c in lines.columns if c != line]
    bad = with_statement(lines, line).filter(~is_statement() & ~is_blank(F.col(line)))
    return bad.select(F.col(line).alias("value"), _reason(line).alias("reason"), *kept)


def read(lines: DataFrame, source_id: Column, line: str = "value") -> DataFrame:
    """What ``parse`` and ``rejects`` give, in one pass: statements without ``value`` and
    ``reason``, and bad lines with both.

    No filter rests on the groups of a line, as Spark would find them once for it and once more.
    """
    kept = [c for c in lines.columns if c != line]
    rows = with_statement(lines.filter(F.col(line).isNotNull() & ~is_blank(F.col(line))), line)
    good = is_statement()
    rows = rows.select(
        F.when(good, F.col("_parts")).alias("_parts"),
        F.when(~good, F.col(line)).alias("value"),
        F.when(~good, _reason(line)).alias("reason"),
        *kept,
    )
    return rows.select(*_terms(source_id), "value", "reason", *kept)


def lines(statements: DataFrame) -> DataFrame:
    return statements.select(statement().alias("value"))


def write(statements: DataFrame, path: str, mode: str = "errorifexists") -> None:
    lines(statements).write.mode(mode).text(path)


QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("source_id", T.IntegerType()),
    ]
)
