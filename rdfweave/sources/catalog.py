"""The source catalog: parents, one child table per type, defaults, validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rdfweave import model as M
from rdfweave.operators.expand import LOCAL_DEPTH, MAX_DEPTH, MIN_DEPTH
from rdfweave.operators.scale import join_lookup


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_INT, _TEXT = T.IntegerType(), T.StringType()

# Columns of the catalog tables and the parameters of each type.
PARENT_SCHEMA = _schema(id=_INT, source_id=_INT, source_type=_TEXT)
CHILD_SCHEMAS = {
    "turtle": _schema(id=_INT, uri=_TEXT),
    "rdf": _schema(id=_INT, uri=_TEXT),
    "sparql": _schema(
        id=_INT,
        endpoint=_TEXT,
        endpoint_user=_TEXT,
        endpoint_password=_TEXT,
        depth=_INT,
        named_graph=_TEXT,
    ),
    "ldf": _schema(id=_INT, startfragment=_TEXT),
}
PARAMETERS = [
    "uri",
    "endpoint",
    "endpoint_user",
    "endpoint_password",
    "depth",
    "named_graph",
    "startfragment",
]
DEFAULTS = {"depth": 1}
REQUIRED = {"turtle": "uri", "rdf": "uri", "sparql": "endpoint", "ldf": "startfragment"}


def type_name(source_type: Column) -> Column:
    """``SparqlSource`` -> ``sparql``."""
    return F.lower(F.regexp_replace(source_type, "Source$", ""))


def children(tables: dict[str, DataFrame]) -> DataFrame:
    """All child tables as one, with their type; columns a type lacks are null."""
    typed = [df.withColumn("type", F.lit(kind)) for kind, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), typed)


def resolve(parents: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Configuration of every source: parent joined to the child table of its type."""
    child = children(tables).withColumnRenamed("id", "source_id")
    columns = [c for c in child.columns if c not in ("source_id", "type")]
    typed = parents.withColumn("type", type_name(F.col("source_type")))
    return join_lookup(typed, child, ["type", "source_id"], "inner").select("id", "type", *columns)


def orphans(parents: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Parents whose child row is missing."""
    child = children(tables).select("type", F.col("id").alias("source_id"))
    typed = parents.withColumn("type", type_name(F.col("source_type")))
    return join_lookup(typed, child, ["type", "source_id"], "left_anti")


def is_empty(column: Column, kind: T.DataType) -> Column:
    """Null, false, zero, ``''`` or ``'0'``."""
    if isinstance(kind, T.StringType):
        return column.isNull() | column.isin("", "0")
    if isinstance(kind, T.BooleanType):
        return column.isNull() | ~column
    return column.isNull() | (column == 0)


def with_defaults(df: DataFrame, defaults: dict[str, object] | None = None) -> DataFrame:
    """Empty parameters get their default, or null when they have none."""
    defaults = DEFAULTS if defaults is None else defaults
    changed = {}
    for name in PARAMETERS:
        if name in df.columns:
            kind = df.schema[name].dataType
            empty = is_empty(F.col(name), kind)
            value = F.lit(defaults.get(name)).cast(kind)
            changed[name] = F.when(empty, value).otherwise(F.col(name))
    return df.withColumns(changed)


def errors(df: DataFrame) -> Column:
    """Messages for everything that is wrong with a configuration row.

    Rows are as entered: every parameter is text.
    """
    kind = F.lower(F.col("type"))

    def text(name: str) -> Column:
        return F.trim(F.col(name)) if name in df.columns else F.lit(None).cast("string")

    def missing(name: str) -> Column:
        return F.coalesce(text(name), F.lit("")) == ""

    depth = text("depth")
    number = depth.try_cast("int")
    given = (kind == "sparql") & ~missing("depth")
    whole = F.regexp_like(depth, F.lit(r"^[+-]?[0-9]+$"))
    address = F.regexp_like(text("uri"), F.lit(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:|/)\S+$"))
    rules = [
        (missing("type") | (text("type") == "0"),
         f"type is required, one of: {', '.join(sorted(M.SOURCE_TYPES))}"),
        (~missing("type") & (text("type") != "0") & ~kind.isin(*M.SOURCE_TYPES),
         "type is not supported"),
        *[
            ((kind == name) & missing(parameter), f"{parameter} is required")
            for name, parameter in REQUIRED.items()
        ],
        (kind.isin(*M.LOCAL_TYPES) & ~missing("uri") & ~address, "uri cannot be resolved"),
        (given & ~whole, "depth must be an integer"),
        (given & whole & F.coalesce(number < MIN_DEPTH, depth.startswith("-")),
         f"depth must be at least {MIN_DEPTH}"),
        (given & whole & F.coalesce(number > MAX_DEPTH, ~depth.startswith("-")),
         f"depth may not be greater than {MAX_DEPTH}"),
    ]
    return F.array_compact(F.array(*[F.when(rule, F.lit(message)) for rule, message in rules]))


def validate(df: DataFrame) -> DataFrame:
    """Adds ``errors``; a row is valid when it is empty."""
    return df.withColumn("errors", errors(df))


def is_loaded(kind: Column) -> Column:
    """Files are loaded into the store; endpoints and fragment servers are not."""
    return F.lower(kind).isin(*M.LOCAL_TYPES)


def depths(sources: DataFrame) -> DataFrame:
    """Depth a URI is dereferenced to, per ``source_key``."""
    kind, identifier = F.col("type"), F.col("id")
    depth = (
        F.when(kind.isin(*M.LOCAL_TYPES), F.lit(LOCAL_DEPTH))
        .when(kind == "sparql", F.coalesce(F.col("depth"), F.lit(DEFAULTS["depth"])))
        .otherwise(F.lit(1))
    )
    return sources.select(
        M.source_key(kind, identifier).alias("source_key"), depth.cast("int").alias("depth")
    ).distinct()
