"""Column functions on request addresses, identifiers and query strings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default of a parameter: extensions that name an answer format.
FORMATS = ("csv", "geojson", "html", "json", "jsonld", "kml", "map", "nt", "php", "rdf", "ttl", "xml")

# Paging keys that are not passed on to a fragment server, when its
# total is asked for and when its pages are fetched.
COUNT_DROPPED = ("page",)
FETCH_DROPPED = ("page", "page_size", "limit", "offset")


def query_parts(query_string: Column) -> Column:
    """The non-empty parts of a raw query string, in their order and encoding.

    A part that is just ``0`` counts as empty.
    """
    parts = F.split(F.coalesce(query_string, F.lit("")), "&")
    return F.filter(parts, lambda part: ~part.isin("", "0"))


def part_key(part: Column) -> Column:
    return F.substring_index(part, "=", 1)


def encode_hash(uri: Column) -> Column:
    return F.replace(uri, F.lit("#"), F.lit("%23"))


def with_query(uri: Column, parts: Column) -> Column:
    """``uri?a&b``, or just ``uri`` when there are no parts."""
    return F.when(F.size(parts) > 0, F.concat(uri, F.lit("?"), F.array_join(parts, "&"))).otherwise(
        uri
    )


def raw_request_uri(url: Column, query_string: Column) -> Column:
    """The address as it was requested: raw query string kept, ``#`` encoded."""
    return encode_hash(with_query(url, query_parts(query_string)))


def extension(uri: Column, formats: Sequence[str] = FORMATS) -> Column:
    """A known format after the last dot, as written; null when there is none."""
    last = F.regexp_extract(uri, r"^.+\.([^.]+)$", 1)
    return F.when(F.lower(last).isin(*[f.lower() for f in formats]), last)


def without_extension(uri: Column, formats: Sequence[str] = FORMATS) -> Column:
    """The identifier without a known format; an unknown extension stays."""
    found = extension(uri, formats)
    return F.when(found.isNotNull(), F.regexp_replace(uri, r"\.[^.]+$", "")).otherwise(uri)


def parent_path(identifier: Column) -> Column:
    """Everything before the last slash; empty for a single segment."""
    return F.regexp_extract(identifier, r"^(.*)/[^/]*$", 1)


def last_segment(identifier: Column) -> Column:
    return F.substring_index(identifier, "/", -1)


def first_segment(identifier: Column) -> Column:
    return F.substring_index(identifier, "/", 1)


def trim_end(text: Column, characters: str) -> Column:
    """Drop any run of ``characters`` at the end."""
    return F.rtrim(text, F.lit(characters))


def trim_quotes(text: Column) -> Column:
    return F.ltrim(F.rtrim(text, F.lit('"')), F.lit('"'))


def percent_encode(text: Column) -> Column:
    """Form encoding with a space as ``%20``; only letters, digits and ``-_.`` stay."""
    return F.replace(
        F.replace(F.url_encode(text), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")
    )


def query_uri(endpoint: Column, query: Column, accept: str) -> Column:
    """The address an endpoint is asked under."""
    return F.concat(
        trim_end(endpoint, "/"),
        F.lit("?query="),
        percent_encode(query),
        F.lit("&format="),
        F.url_encode(F.lit(accept)),
    )


def fingerprint(text: Column) -> Column:
    return F.sha1(text)


def query_fingerprint(source_id: Column, query: Column) -> Column:
    """Key of an endpoint's answer to a query."""
    return F.sha1(F.concat(F.lit("sparql_"), source_id.cast("string"), F.lit("_"), query))


def rewrite_query(
    query_string: Column, dropped: Sequence[str], subject: Column | None = None
) -> Column:
    """Query parts for a fragment server: paging keys dropped, subject set.

    A non-null ``subject`` replaces the value of a ``subject`` part and is appended
    when there is no such part.
    """
    kept = F.filter(query_parts(query_string), lambda part: ~part_key(part).isin(*dropped))
    if subject is None:
        return kept

    def is_subject(part: Column) -> Column:
        return F.lower(part_key(part)) == "subject"

    replaced = F.transform(
        kept,
        lambda part: F.when(is_subject(part), F.concat(part_key(part), F.lit("="), subject)).otherwise(
            part
        ),
    )
    added = F.array(F.concat(F.lit("subject="), subject))
    return (
        F.when(subject.isNull(), kept)
        .when(F.exists(kept, is_subject), replaced)
        .otherwise(F.concat(kept, added))
    )


def fragment_subject(root: Column, path: Column) -> Column:
    """The subject a path stands for; the root and ``all...`` stand for none."""
    return F.when(
        (F.length(path) > 0) & ~F.lower(path).startswith("all"), F.concat(root, F.lit("/"), path)
    )


def count_fragment(startfragment: Column, query_string: Column, subject: Column) -> Column:
    return with_query(startfragment, rewrite_query(query_string, COUNT_DROPPED, subject))


def fetch_fragment(startfragment: Column, query_string: Column) -> Column:
    return with_query(startfragment, rewrite_query(query_string, FETCH_DROPPED))


def route(path: Column) -> Column:
    """What a path asks for: ``pattern``, ``source``, ``dereference`` or null."""
    path = F.ltrim(path, F.lit("/"))
    return (
        F.when(F.regexp_like(path, F.lit(r"^all(\.[a-zA-Z]*)?$")), F.lit("pattern"))
        .when(F.regexp_like(path, F.lit(r"^api/triples(/[0-9]+)?$")), F.lit("source"))
        .when(F.regexp_like(path, F.lit(r"^(?!api|discovery).+")), F.lit("dereference"))
    )


def route_format(path: Column) -> Column:
    """The format asked for by ``all.<format>``."""
    found = F.regexp_extract(F.ltrim(path, F.lit("/")), r"^all\.([a-zA-Z]+)$", 1)
    return F.when(found != "", found)


def route_source(path: Column) -> Column:
    """The source id in ``api/triples/<id>``."""
    return F.regexp_extract(F.ltrim(path, F.lit("/")), r"^api/triples/([0-9]+)$", 1).try_cast("int")
