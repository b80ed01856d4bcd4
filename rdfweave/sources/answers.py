"""Saved answers of endpoints: JSON counts and RDF/XML graphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rdfweave.operators.stage import stage
from rdfweave.sources import pieces, rdfxml

# Fixed value: where a count answer holds its number.
COUNT_PATH = "$.results.bindings[0].count.value"


def number(body: Column, path: str) -> Column:
    """The whole number at a path of a JSON text; null where there is none."""
    return F.get_json_object(body, path).try_cast("long")


def counts(answers: DataFrame) -> DataFrame:
    """``(source_id, body)`` -> ``(source_id, solutions)``.

    An empty or unreadable answer contributes nothing.
    """
    return answers.select("source_id", number(F.col("body"), COUNT_PATH).alias("solutions")).filter(
        F.col("solutions").isNotNull()
    )


def is_graph() -> Column:
    """A graph answer is markup; anything else is an error message."""
    return F.col("body").startswith("<")


def graphs(answers: DataFrame, doc: str = "source_id") -> DataFrame:
    """Statements of the graph answers, with the other columns of ``answers``."""
    return rdfxml.parse(answers.filter(is_graph()), "body", doc)


def rejected(answers: DataFrame) -> DataFrame:
    """Answers that are no graph, as quarantine rows; empty ones are left out.

    Markup that is no RDF/XML, such as an error page, is none either.
    """
    text = answers.filter(~is_graph() & (F.length("body") > 0)).select(
        F.col("body").alias("value"), F.lit("answer is not RDF/XML").alias("reason"), "source_id"
    )
    markup = rdfxml.rejects(answers.filter(is_graph()), "body").select("value", "reason", "source_id")
    return text.unionByName(markup)


def parsed(answers: DataFrame, doc: str = "source_id") -> tuple[DataFrame, DataFrame]:
    """``graphs`` and ``rejected`` of the same answers, every one of which is read once."""
    markup = answers.filter(is_graph())
    read = stage(rdfxml.read(markup, "body", doc), "answers")
    wrong = pieces.reasons(read, markup, "body", doc).select("value", "reason", "source_id")
    text = answers.filter(~is_graph() & (F.length("body") > 0)).select(
        F.col("body").alias("value"), F.lit("answer is not RDF/XML").alias("reason"), "source_id"
    )
    return read.filter(F.col("reason").isNull()).drop("reason"), text.unionByName(wrong)
