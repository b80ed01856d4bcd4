"""Statements grouped by their subject: nested maps and Turtle blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rdfweave import model as M
from rdfweave.functions.text import written_predicate, written_subject, written_value
from rdfweave.operators.scale import dealt

SUBJECT = ["s_kind", "s"]


def with_part(statements: DataFrame, parts: int = 1) -> DataFrame:
    """Adds ``part``: every subject is spread over up to ``parts`` rows by a hash of its statements.

    The caller names the number, so the shape of the result never depends on the data.
    """
    if parts == 1:
        return statements.withColumn("part", F.lit(0))
    part = F.pmod(F.xxhash64("p", "o", "o_kind", "o_datatype", "o_lang"), F.lit(parts))
    return statements.withColumn("part", part.cast("int"))


def _graph(statements: DataFrame, parts: int) -> DataFrame:
    """Distinct statements with ``part``, those of a row of the result in one task: the only shuffle."""
    rows = with_part(statements.select(*M.TERMS), parts)
    return dealt(rows, *SUBJECT, *(["part"] if parts > 1 else [])).distinct()


def resource_map(statements: DataFrame, parts: int = 1) -> DataFrame:
    """``(s_kind, s, part, properties)`` with predicate -> sorted list of objects."""
    value = F.struct(
        F.col("o").alias("value"),
        F.col("o_kind").alias("type"),
        F.col("o_datatype").alias("datatype"),
        F.col("o_lang").alias("lang"),
    )
    lists = (
        _graph(statements, parts)
        .groupBy(*SUBJECT, "part", "p")
        .agg(F.sort_array(F.collect_list(value)).alias("objects"))
    )
    return lists.groupBy(*SUBJECT, "part").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("p", "objects")))).alias("properties")
    )


def write_json(statements: DataFrame, path: str, mode: str = "errorifexists", parts: int = 1) -> None:
    """One JSON object per subject (and part)."""
    resource_map(statements, parts).write.mode(mode).option("ignoreNullFields", "true").json(path)


def turtle_blocks(statements: DataFrame, parts: int = 1) -> DataFrame:
    """One Turtle block per subject (and part): ``(s_kind, s, part, value)``."""
    written = _graph(statements, parts).select(
        *SUBJECT,
        "part",
        written_subject().alias("subject"),
        written_predicate().alias("predicate"),
        written_value().alias("object"),
    )
    properties = written.groupBy(*SUBJECT, "part", "subject", "predicate").agg(
        F.array_join(F.sort_array(F.collect_list("object")), " ,\n    ").alias("objects")
    )
    lines = F.concat_ws(" ", "predicate", "objects")
    block = F.array_join(F.sort_array(F.collect_list(lines)), " ;\n  ")
    return (
        properties.groupBy(*SUBJECT, "part", "subject")
        .agg(block.alias("block"))
        .select(*SUBJECT, "part", F.concat("subject", F.lit("\n  "), "block", F.lit(" .")).alias("value"))
    )


def write_turtle(statements: DataFrame, path: str, mode: str = "errorifexists", parts: int = 1) -> None:
    turtle_blocks(statements, parts).select("value").write.mode(mode).text(path)
