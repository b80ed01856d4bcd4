"""Statistics and paging statements that accompany an answer (VoID and Hydra)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rdfweave import model as M
from rdfweave.functions import uri as U

# The pattern route and the three template variables.
PATTERN_PATH = "all"
VARIABLES = ("subject", "predicate", "object")


def pages(total: Column, limit: Column) -> Column:
    """Number of pages; null when the page size is 0."""
    return F.when(limit > 0, F.ceil(total / limit).cast("long"))


def page_offsets(limit: Column, offset: Column, total: Column) -> dict[str, Column]:
    """Offsets of the first, next, last and previous page; null where there is none."""
    more = (limit > 0) & (offset + limit < total)
    return {
        "first": F.lit(0).cast("long"),
        "next": F.when(more, (offset + limit).cast("long")),
        "last": F.when(more, ((pages(total, limit) - 1) * limit).cast("long")),
        "previous": F.when(
            (offset > 0) & (total > 0), F.greatest(offset - limit, F.lit(0)).cast("long")
        ),
    }


def is_pattern_path(path: Column) -> Column:
    return F.lower(U.first_segment(F.ltrim(path, F.lit("/")))) == PATTERN_PATH


def result_uri(root: Column, path: Column, query_string: Column) -> Column:
    """The address of the answer itself; a dereferenced one gets ``#dataset``."""
    pattern = is_pattern_path(path)
    base = F.concat(root, F.lit("/"), F.when(pattern, F.lit(PATTERN_PATH)).otherwise(path))
    full = U.raw_request_uri(base, query_string)
    return F.when(pattern, full).otherwise(F.concat(full, F.lit("#dataset")))


def link_base(root: Column, path: Column, query_string: Column) -> tuple[Column, Column]:
    """The address page links start with, and the character that comes next.

    Only the pattern's own parameters stay in the query string.
    """
    kept = F.filter(
        U.query_parts(query_string), lambda part: F.lower(U.part_key(part)).isin(*VARIABLES)
    )
    base = F.concat(
        root, F.lit("/"), F.when(is_pattern_path(path), F.lit(PATTERN_PATH)).otherwise(path)
    )
    glue = F.when(F.size(kept) > 0, F.lit("&")).otherwise(F.lit("?"))
    return U.encode_hash(U.with_query(base, kept)), glue


def page_link(base: Column, glue: Column, limit: Column, offset: Column) -> Column:
    """Null when there is no such page."""
    return F.concat(
        base, glue, F.lit("limit="), limit.cast("string"), F.lit("&offset="), offset.cast("string")
    )


def paging_links(results: DataFrame) -> DataFrame:
    """Adds ``first``, ``next``, ``last``, ``previous`` links and the number of pages.

    ``results(root, path, query_string, limit, offset, total)``, one row per answer.
    """
    base, glue = link_base(F.col("root"), F.col("path"), F.col("query_string"))
    offsets = page_offsets(F.col("limit"), F.col("offset"), F.col("total"))
    return results.select(
        "*",
        pages(F.col("total"), F.col("limit")).alias("pages"),
        *[page_link(base, glue, F.col("limit"), o).alias(name) for name, o in offsets.items()],
    )


def _statement(s: Column, s_kind: str, p: str, o: Column, o_kind: str, datatype: str | None = None) -> Column:
    return F.struct(
        s.alias("s"),
        F.lit(s_kind).alias("s_kind"),
        F.lit(p).alias("p"),
        o.cast("string").alias("o"),
        F.lit(o_kind).alias("o_kind"),
        F.lit(datatype).cast("string").alias("o_datatype"),
        F.lit(None).cast("string").alias("o_lang"),
    )


def describe(results: DataFrame, key: str = "result_id") -> DataFrame:
    """Description statements of every answer: 22 fixed ones and one per page link.

    ``results(<key>, root, path, query_string, limit, offset, total)``.
    """
    dataset = F.concat(F.col("root"), F.lit(f"/{PATTERN_PATH}#dataset"))

    def node(name: str) -> Column:
        return F.concat(F.lit("_:r"), F.col(key).cast("string"), F.lit(f".{name}"))

    def iri(s: Column, p: str, o: Column, s_kind: str = M.IRI) -> Column:
        return _statement(s, s_kind, p, o, M.IRI)

    template = node("template")
    out = [
        iri(dataset, M.RDF_TYPE, F.lit(M.VOID + "Dataset")),
        iri(dataset, M.RDF_TYPE, F.lit(M.HYDRA + "Collection")),
        _statement(dataset, M.IRI, M.HYDRA + "search", template, M.BNODE),
        iri(template, M.RDF_TYPE, F.lit(M.HYDRA + "IriTemplate"), M.BNODE),
        _statement(
            template,
            M.BNODE,
            M.HYDRA + "template",
            F.concat(F.col("root"), F.lit(f"/{PATTERN_PATH}{{?{','.join(VARIABLES)}}}")),
            M.LITERAL,
        ),
    ]
    for name in VARIABLES:
        out += [
            iri(node(name), M.RDF_TYPE, F.lit(M.HYDRA + "IriTemplateMapping"), M.BNODE),
            _statement(node(name), M.BNODE, M.HYDRA + "variable", F.lit(name), M.LITERAL),
            iri(node(name), M.HYDRA + "property", F.lit(M.RDF + name), M.BNODE),
            _statement(template, M.BNODE, M.HYDRA + "mapping", node(name), M.BNODE),
        ]
    full = result_uri(F.col("root"), F.col("path"), F.col("query_string"))
    for predicate, value in (
        (M.HYDRA + "totalItems", "total"),
        (M.VOID + "triples", "total"),
        (M.HYDRA + "itemsPerPage", "limit"),
    ):
        out.append(_statement(full, M.IRI, predicate, F.col(value), M.LITERAL, M.XSD_INTEGER))
    out += [iri(full, M.VOID + "subset", dataset), iri(dataset, M.VOID + "subset", full)]
    for name in ("first", "next", "last", "previous"):
        out.append(iri(full, f"{M.HYDRA}{name}Page", F.col(name)))
    return (
        paging_links(results)
        .select(key, F.inline(F.array(*out)))
        .filter(F.col("o").isNotNull())
    )
