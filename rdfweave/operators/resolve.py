"""Which kind of thing a request names, and listings of collections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rdfweave import model as M
from rdfweave.functions import uri as U
from rdfweave.operators.scale import BROADCAST_BYTES, estimated_bytes, join_lookup
from rdfweave.operators.stage import stage


def identified(requests: DataFrame, formats: Sequence[str] = U.FORMATS) -> DataFrame:
    """Adds route, format, identifier and subject address to ``requests``.

    ``requests(request_id, root, path, query_string)``.
    """
    path = F.ltrim(F.col("path"), F.lit("/"))
    return (
        requests.withColumn("route", U.route(path))
        .withColumn("format", F.coalesce(U.route_format(path), U.extension(path, formats)))
        .withColumn("identifier", U.without_extension(path, formats))
        .withColumn(
            "uri",
            F.when(F.col("identifier") == "", F.col("root")).otherwise(
                F.concat(F.col("root"), F.lit("/"), F.col("identifier"))
            ),
        )
    )


def _collection_uri() -> Column:
    return F.rtrim(F.col("collection_uri"), F.lit("/"))


def _ancestors(path: Column) -> Column:
    """``a/b/c`` -> ``[a, a/b, a/b/c]``."""
    segments = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(1), F.size(segments)),
        lambda n: F.array_join(F.slice(segments, 1, n), "/"),
    )


def collection_members(definitions: DataFrame) -> DataFrame:
    """What lies in or below every collection: ``(identifier, kind, uri)``, distinct.

    A definition is a ``dataset`` of its own collection; seen from a collection
    further up, its collection is listed once as a ``collection``.
    """
    own = _collection_uri()
    below = definitions.select(
        "resource_name", own.alias("own"), F.explode(_ancestors(own)).alias("identifier")
    )
    direct = F.col("own") == F.col("identifier")
    return below.select(
        "identifier",
        F.when(direct, F.lit("dataset")).otherwise(F.lit("collection")).alias("kind"),
        F.when(direct, F.concat_ws("/", "own", "resource_name")).otherwise(F.col("own")).alias("uri"),
    ).distinct()


def resolve(
    requests: DataFrame,
    definitions: DataFrame,
    core_resources: DataFrame,
    data: DataFrame,
    formats: Sequence[str] = U.FORMATS,
) -> DataFrame:
    """Adds ``resolution`` to every request: the first kind of thing that it names.

    In order: a published ``dataset``, a ``core`` resource (by its first segment), a
    ``collection``, the ``statements`` of a subject; null when there is nothing.
    Requests are staged, catalog tables are broadcast when small, and subjects are
    first cut down to those that are requested at all.
    """
    named = stage(identified(requests, formats), "requests")
    datasets = definitions.select(
        F.concat_ws("/", _collection_uri(), "resource_name").alias("identifier")
    ).distinct()
    collections = definitions.select(
        F.explode(_ancestors(_collection_uri())).alias("identifier")
    ).distinct()
    core = core_resources.select(F.col("name").alias("_first")).distinct()
    asked = named.select("uri").distinct()
    subjects = data.filter(F.col("s_kind") == M.IRI).select(F.col("s").alias("uri"))
    if estimated_bytes(asked) <= BROADCAST_BYTES:
        subjects = subjects.join(F.broadcast(asked), "uri", "left_semi").distinct()
    else:
        # Made distinct before the shuffle, a subject with many statements is one row.
        subjects = subjects.distinct().join(asked, "uri", "left_semi")

    joined = named.withColumn("_first", U.first_segment(F.col("identifier")))
    for lookup, key, name in (
        (datasets, "identifier", "_dataset"),
        (core, "_first", "_core"),
        (collections, "identifier", "_collection"),
        (subjects, "uri", "_statements"),
    ):
        joined = join_lookup(joined, lookup.withColumn(name, F.lit(True)), [key])
    resolution = (
        F.when(F.col("_dataset"), "dataset")
        .when(F.col("_core"), "core")
        .when(F.col("_collection"), "collection")
        .when(F.col("_statements"), "statements")
    )
    return joined.withColumn("resolution", resolution).select(
        "request_id", *[c for c in named.columns if c != "request_id"], "resolution"
    )


def list_collections(resolved: DataFrame, definitions: DataFrame) -> DataFrame:
    """Members of every request that names a collection."""
    asked = resolved.filter(F.col("resolution") == "collection").select(
        "request_id", "root", "identifier"
    )
    return join_lookup(asked, collection_members(definitions), ["identifier"], "inner").select(
        "request_id",
        "identifier",
        "kind",
        F.concat_ws("/", F.col("root"), F.col("uri")).alias("uri"),
    )


def unresolved(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """Requests without any answer row."""
    return join_lookup(
        requests, answers.select("request_id").distinct(), ["request_id"], "left_anti"
    )


def with_found(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """Adds ``found`` to every request."""
    hits = answers.select("request_id").distinct().withColumn("_hit", F.lit(True))
    return (
        join_lookup(requests, hits, ["request_id"])
        .withColumn("found", F.coalesce(F.col("_hit"), F.lit(False)))
        .drop("_hit")
    )


def description(resolved: DataFrame) -> DataFrame:
    """The collection path and resource name a request is described by."""
    return resolved.withColumn("collection_uri", U.parent_path(F.col("identifier"))).withColumn(
        "resource_name", U.last_segment(F.col("identifier"))
    )
