"""Every operator as a query over whole test tables, each with its SQL twin.

``QUERIES`` maps a name to a function of (spark, sf_dir), ``ORACLES`` to the SQL
that DuckDB runs on the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures import lift as L
from fixtures import tables as X
from rdfweave import model as M
from rdfweave.functions import text, uri
from rdfweave.model import Pattern, Term
from rdfweave.operators import describe, expand, federate, fragments, match, paging, resolve, resources
from rdfweave.operators.stage import new_folder, stage
from rdfweave.plans import federation, load
from rdfweave.plans import query as plans
from rdfweave.sources import answers, catalog, ntriples, rdfxml, store, turtle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

NS, V = L.NS, L.V
TERMS = ", ".join(M.TERMS)
STATEMENTS = f"statements AS ({L.lift_sql()})"
SOURCE_KEY = (
    "CASE WHEN source_type IN ('turtle', 'rdf') THEN 'local' "
    "ELSE concat(source_type, ':', source_id) END"
)
SOURCE_RANK = (
    "CASE WHEN source_type IN ('turtle', 'rdf') THEN 0 WHEN source_type = 'sparql' THEN 1 ELSE 2 END"
)


def data_sql(statements: str = "statements", name: str = "data", where: str = "true") -> str:
    return (
        f"{name} AS (SELECT DISTINCT {SOURCE_RANK} AS source_rank, {SOURCE_KEY} AS source_key, "
        f"{TERMS} FROM {statements} WHERE {where})"
    )


DATA = data_sql()
DEPTHS = "depths AS (SELECT * FROM (VALUES {}) t(source_key, depth))".format(
    ", ".join(f"('{key}', {depth})" for key, depth in L.DEPTHS)
)


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def with_sql(*parts: str) -> str:
    """All but the last part are common table expressions."""
    return "WITH " + ",\n".join(parts[:-1]) + "\n" + parts[-1]


def data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match.default_graphs(L.lift(spark, sf_dir))


def depths(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(L.DEPTHS, "source_key string, depth int")


LEVELS = (1, 2, 3)


def paths_sql(depth: int, source: str = "data") -> str:
    """All paths of ``depth - 1`` statements."""
    columns, joins = ["t2.source_key AS k", "t2.s AS n", "t2.s_kind AS nk"], f"{source} t2"
    for hop in range(2, depth + 1):
        t = f"t{hop}"
        columns += [
            f"{t}.p AS p{hop}", f"{t}.o AS o{hop}", f"{t}.o_kind AS o{hop}_kind",
            f"{t}.o_datatype AS o{hop}_datatype", f"{t}.o_lang AS o{hop}_lang",
        ]
        if hop > 2:
            b = f"t{hop - 1}"
            joins += (
                f" JOIN {source} {t} ON {b}.source_key = {t}.source_key AND {b}.o = {t}.s "
                f"AND {b}.o_kind = {t}.s_kind"
            )
    return f"SELECT {', '.join(columns)} FROM {joins}"


def expand_sql(base: str, depth: int, source: str = "data", extra: str = "") -> str:
    path = "".join(f", {c}" for c in expand.path_columns(depth))
    return (
        f"SELECT {extra}source_rank, source_key, {TERMS}{path} FROM {base} "
        f"LEFT JOIN ({paths_sql(depth, source)}) c ON source_key = k AND o = n AND o_kind = nk"
    )


def construct_sql(solutions: str, depth: int, by: str = "") -> str:
    parts = [f"SELECT {by}{TERMS} FROM {solutions}"]
    s, kind = "o", "o_kind"
    for hop in range(2, depth + 1):
        parts.append(
            f"SELECT {by}{s}, {kind}, p{hop}, o{hop}, o{hop}_kind, o{hop}_datatype, o{hop}_lang "
            f"FROM {solutions} WHERE p{hop} IS NOT NULL"
        )
        s, kind = f"o{hop}", f"o{hop}_kind"
    return "\nUNION ".join(parts) if len(parts) > 1 else parts[0].replace("SELECT", "SELECT DISTINCT", 1)


def order_sql(depth: int = 1) -> str:
    return ", ".join(f"{c} NULLS FIRST" for c in paging.order_columns(depth))


# --- counts of a pattern -------------------------------------------------------

COUNTS: dict[str, tuple[Pattern, str, int]] = {
    "count_open": (Pattern(), "true", 1),
    "count_subject": (Pattern(s=Term.iri(NS + "nation/3")), f"s = '{NS}nation/3' AND s_kind = 'uri'", 1),
    "count_predicate": (Pattern(p=Term.iri(V + "name")), f"p = '{V}name'", 1),
    "count_object_literal": (
        Pattern(o=Term.text("MACHINERY")),
        "o = 'MACHINERY' AND o_kind = 'literal' AND o_datatype IS NULL AND o_lang IS NULL",
        1,
    ),
    "count_object_uri": (Pattern(o=Term.iri(NS + "nation/3")), f"o = '{NS}nation/3' AND o_kind = 'uri'", 1),
    "count_object_number": (
        Pattern(o=Term.number(42)),
        f"o = '42' AND o_kind = 'literal' AND o_datatype = '{M.XSD_INTEGER}' AND o_lang IS NULL",
        1,
    ),
    "expand_open_count_rule": (Pattern(), "true", 3),
}


def _count(pattern: Pattern, depth: int) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        counts = expand.solution_counts(data(spark, sf_dir), pattern, depth)
        return counts.agg(F.coalesce(F.sum("solutions"), F.lit(0)).alias("solutions"))

    return query


for _name, (_pattern, _where, _depth) in COUNTS.items():
    register(
        _name,
        with_sql(STATEMENTS, DATA, f"SELECT count(*) AS solutions FROM data WHERE {_where}"),
    )(_count(_pattern, _depth))

for _depth in (2, 3, 5):
    register(
        f"expand_depth{_depth}_count",
        with_sql(
            STATEMENTS,
            DATA,
            f"base AS (SELECT * FROM data WHERE p = '{V}nation')",
            f"SELECT count(*) AS solutions FROM ({expand_sql('base', _depth)})",
        ),
    )(_count(Pattern(p=Term.iri(V + "nation")), _depth))

register(
    "expand_subject_count",
    with_sql(
        STATEMENTS,
        DATA,
        f"base AS (SELECT * FROM data WHERE s = '{NS}nation/3' AND s_kind = 'uri')",
        f"SELECT count(*) AS solutions FROM ({expand_sql('base', 3)})",
    ),
)(_count(Pattern(s=Term.iri(NS + "nation/3")), 3))


GRAPH2 = L.graph(2)


@register(
    "count_named_graph",
    with_sql(
        STATEMENTS,
        data_sql(where=f"graph = '{GRAPH2}'"),
        f"base AS (SELECT * FROM data WHERE p = '{V}nation')",
        f"SELECT count(*) AS solutions FROM ({expand_sql('base', 3)})",
    ),
)
def count_named_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = match.default_graphs(L.lift(spark, sf_dir), graph=GRAPH2)
    return expand.solution_counts(one, Pattern(p=Term.iri(V + "nation")), 3).agg(
        F.sum("solutions").alias("solutions")
    )


@register(
    "match_named_graph",
    with_sql(STATEMENTS, data_sql(where=f"graph = '{GRAPH2}'"), f"SELECT DISTINCT {TERMS} FROM data"),
)
def match_named_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = match.default_graphs(L.lift(spark, sf_dir), graph=GRAPH2)
    return expand.construct(match.match(one, Pattern()), 1)


@register(
    "match_predicate_page",
    with_sql(
        STATEMENTS,
        DATA,
        f"page AS (SELECT * FROM data WHERE p = '{V}name' ORDER BY {order_sql()} LIMIT 150)",
        f"SELECT DISTINCT {TERMS} FROM page",
    ),
)
def match_predicate_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = match.match(data(spark, sf_dir), Pattern(p=Term.iri(V + "name")))
    return expand.construct(paging.page(found, limit=150), 1)


@register(
    "match_parameters",
    with_sql(
        STATEMENTS,
        DATA,
        f"SELECT source_key, {TERMS} FROM data WHERE p = '{V}segment' AND o = 'BUILDING' "
        "AND o_kind = 'literal' AND o_datatype IS NULL AND o_lang IS NULL",
    ),
)
def match_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pattern = M.pattern_from_parameters(predicate=V + "segment", object='"BUILDING"')
    return match.match(data(spark, sf_dir), pattern).drop("source_rank")


@register(
    "coerce_objects",
    "SELECT kind, value, count(*) AS n FROM ("
    "SELECT CASE WHEN starts_with(x, 'http') OR starts_with(x, '<http') THEN 'uri' ELSE 'literal' END AS kind, "
    "CASE WHEN starts_with(x, 'http') THEN x WHEN starts_with(x, '<http') "
    "THEN rtrim(ltrim(x, '<'), '>') ELSE rtrim(ltrim(x, '\"'), '\"') END AS value FROM ("
    "SELECT url AS x FROM pages UNION ALL SELECT concat('<', url, '>') FROM pages "
    "UNION ALL SELECT concat('\"', p_name, '\"') FROM part "
    "UNION ALL SELECT concat(p_brand, '@en') FROM part)) GROUP BY kind, value",
)
def coerce_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, part = L.table(spark, sf_dir, "pages"), L.table(spark, sf_dir, "part")
    values = (
        pages.select(F.col("url").alias("x"))
        .union(pages.select(F.concat(F.lit("<"), "url", F.lit(">"))))
        .union(part.select(F.concat(F.lit('"'), "p_name", F.lit('"'))))
        .union(part.select(F.concat("p_brand", F.lit("@en"))))
    )
    return values.select(M.object_term(F.col("x")).alias("t")).groupBy(
        F.col("t.kind").alias("kind"), F.col("t.value").alias("value")
    ).agg(F.count(F.lit(1)).alias("n"))


# --- hash variants --------------------------------------------------------------

PAGES = f"statements AS ({L.lift_sql(L.PAGES)})"
BASE = "regexp_replace({}, '#.*$', '')"
VARIANT = "(lower(s) = lower(uri) OR starts_with(lower(s), concat(lower(uri), '#')))"


def page_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match.default_graphs(L.lift(spark, sf_dir, L.PAGES))


@register(
    "hash_variants_batch",
    with_sql(
        PAGES,
        data_sql(),
        f"requests AS (SELECT page_id AS request_id, upper({BASE.format('url')}) AS uri FROM pages)",
        f"SELECT request_id, uri, s, o FROM requests JOIN data ON {VARIANT}",
    ),
)
def hash_variants_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = L.table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("request_id"),
        F.upper(F.substring_index("url", "#", 1)).alias("uri"),
    )
    found = match.match_subjects(page_data(spark, sf_dir), requests, hash_variants=True)
    return found.select("request_id", "uri", "s", "o")


HASH_SUBJECT = "HTTPS://m.ththth.example.net/en/25"
HASH = Pattern(s=Term.iri(HASH_SUBJECT), hash_variants=True)


@register(
    "hash_variants_count",
    with_sql(
        PAGES,
        data_sql(),
        f"SELECT count(*) AS solutions FROM data, (SELECT '{HASH_SUBJECT}' AS uri) WHERE {VARIANT}",
    ),
)
def hash_variants_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = expand.solution_counts(page_data(spark, sf_dir), HASH, 3)
    return counts.agg(F.coalesce(F.sum("solutions"), F.lit(0)).alias("solutions"))


@register(
    "hash_variants_match",
    with_sql(
        PAGES,
        data_sql(),
        f"SELECT {TERMS} FROM data, (SELECT '{HASH_SUBJECT}' AS uri) WHERE {VARIANT}",
    ),
)
def hash_variants_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    statements = L.lift(spark, sf_dir, L.PAGES).withColumn("s_base", match.subject_base(F.col("s")))
    return match.match(match.default_graphs(statements), HASH).select(*M.TERMS)


@register(
    "hash_variants_expand",
    with_sql(
        STATEMENTS,
        DATA,
        f"base AS (SELECT data.* FROM data, (SELECT '{NS.upper()}nation/3' AS uri) "
        f"WHERE p = '{V}region' AND {VARIANT})",
        f"solutions AS ({expand_sql('base', 3)})",
        construct_sql("solutions", 3),
    ),
)
def hash_variants_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    pattern = Pattern(
        s=Term.iri(NS.upper() + "nation/3"), p=Term.iri(V + "region"), hash_variants=True
    )
    all_statements = data(spark, sf_dir)
    return expand.construct(expand.expand(match.match(all_statements, pattern), all_statements, 3), 3)


# --- expansion ------------------------------------------------------------------


# A link to a nation is followed by what its source says of the nation: name and region.
_LINKS = (
    f"SELECT 0 AS source_rank, 'local' AS source_key, {L.CUSTOMER} AS s, c_nationkey AS k FROM customer "
    f"UNION ALL SELECT DISTINCT 0, 'local', {L.iri('region', 'n_regionkey')}, n_nationkey FROM nation "
    f"UNION ALL SELECT 1, 'sparql:3', {L.SUPPLIER}, s_nationkey FROM supplier"
)
_NATIONS = (
    f"SELECT n_nationkey AS k, '{V}name' AS p2, n_name AS o2, 'literal' AS o2_kind FROM nation "
    f"UNION ALL SELECT n_nationkey, '{V}region', {L.iri('region', 'n_regionkey')}, 'uri' FROM nation"
)
_NONE = "cast(null as string)"


@register(
    "expand_depth2",
    f"SELECT source_rank, source_key, s, 'uri' AS s_kind, '{V}nation' AS p, {L.iri('nation', 'k')} AS o, 'uri' AS o_kind, "
    f"{_NONE} AS o_datatype, {_NONE} AS o_lang, p2, o2, o2_kind, {_NONE} AS o2_datatype, {_NONE} AS o2_lang "
    f"FROM ({_LINKS}) JOIN ({_NATIONS}) USING (k)",
)
def expand_depth2(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_statements = data(spark, sf_dir)
    return expand.expand(match.match(all_statements, Pattern(p=Term.iri(V + "nation"))), all_statements, 2)


@register(
    "expand_depth3_construct",
    with_sql(
        STATEMENTS,
        DATA,
        f"base AS (SELECT * FROM data WHERE p = '{V}nation')",
        f"solutions AS ({expand_sql('base', 3)})",
        construct_sql("solutions", 3),
    ),
)
def expand_depth3_construct(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_statements = data(spark, sf_dir)
    base = match.match(all_statements, Pattern(p=Term.iri(V + "nation")))
    return expand.construct_all(base, all_statements, 3)


@register(
    "expand_depth5_construct",
    with_sql(
        STATEMENTS,
        DATA,
        # Each hop of a full path once: forwards by the nodes reached, backwards by what follows.
        f"base AS (SELECT * FROM data WHERE p = '{V}nation')",
        *[
            f"f{n} AS (SELECT * FROM data d WHERE EXISTS (SELECT 1 FROM {'base' if n == 2 else f'f{n - 1}'} b "
            "WHERE b.source_key = d.source_key AND b.o = d.s AND b.o_kind = d.s_kind AND b.o_kind <> 'literal'))"
            for n in (2, 3, 4, 5)
        ],
        "g5 AS (SELECT * FROM f5)",
        *[
            f"g{n} AS (SELECT * FROM f{n} d WHERE d.o_kind <> 'literal' AND EXISTS (SELECT 1 FROM g{n + 1} b "
            "WHERE b.source_key = d.source_key AND d.o = b.s AND d.o_kind = b.s_kind))"
            for n in (4, 3, 2)
        ],
        "\nUNION ".join(f"SELECT {TERMS} FROM {t}" for t in ("base", "g2", "g3", "g4", "g5")),
    ),
)
def expand_depth5_construct(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_statements = data(spark, sf_dir)
    base = match.match(all_statements, Pattern(p=Term.iri(V + "nation")))
    return expand.construct_all(base, all_statements, 5)


@register(
    "expand_subject_construct",
    with_sql(
        STATEMENTS,
        DATA,
        f"base AS (SELECT * FROM data WHERE s = '{NS}region/1' AND s_kind = 'uri')",
        f"solutions AS ({expand_sql('base', 3)})",
        construct_sql("solutions", 3),
    ),
)
def expand_subject_construct(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_statements = data(spark, sf_dir)
    base = match.match(all_statements, Pattern(s=Term.iri(NS + "region/1")))
    return expand.construct(expand.expand(base, all_statements, 3), 3)


def _by_depth_sql(base: str, extra: str = "") -> str:
    path = expand.path_columns(3)
    parts = []
    for depth in LEVELS:
        missing = path[len(expand.path_columns(depth)):]
        level = f"(SELECT * FROM {base} JOIN depths USING (source_key) WHERE depth = {depth})"
        inner = expand_sql(level, depth, extra=extra) if depth > 1 else (
            f"SELECT {extra}source_rank, source_key, {TERMS} FROM {level}"
        )
        nulls = "".join(f", cast(null as string) AS {c}" for c in missing)
        parts.append(f"SELECT *{nulls} FROM ({inner})")
    return "\nUNION ALL ".join(parts)


@register(
    "expand_depth_per_source",
    with_sql(STATEMENTS, DATA, DEPTHS, f"SELECT source_key, count(*) AS solutions, count(p2) AS depth2, count(p3) AS depth3 FROM ({_by_depth_sql('data')}) GROUP BY source_key"),
)
def expand_depth_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_statements = data(spark, sf_dir)
    solutions = expand.expand_by_source(
        match.match(all_statements, Pattern()), all_statements, depths(spark)
    )
    return solutions.groupBy("source_key").agg(
        F.count(F.lit(1)).alias("solutions"), F.count("p2").alias("depth2"), F.count("p3").alias("depth3")
    )


@register(
    "count_depth_per_source",
    with_sql(STATEMENTS, DATA, DEPTHS, f"SELECT source_rank, source_key, count(*) AS solutions FROM ({_by_depth_sql('data')}) GROUP BY source_rank, source_key"),
)
def count_depth_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_statements = data(spark, sf_dir)
    return federate.counts_by_source(
        match.match(all_statements, Pattern()), all_statements, depths(spark)
    )


# --- several sources ------------------------------------------------------------


@register(
    "totals_by_source",
    with_sql(
        STATEMENTS,
        DATA,
        "counts AS (SELECT source_rank, source_key, count(*) AS solutions FROM data "
        f"WHERE p = '{V}name' GROUP BY source_rank, source_key)",
        "SELECT * FROM counts UNION ALL SELECT null, null, cast(sum(solutions) AS bigint) FROM counts",
    ),
)
def totals_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = expand.solution_counts(data(spark, sf_dir), Pattern(p=Term.iri(V + "name")))
    return federate.with_total(counts)


@register(
    "page_within_source",
    with_sql(
        STATEMENTS,
        DATA,
        f"base AS (SELECT * FROM data WHERE p = '{V}nation')",
        f"SELECT * FROM ({expand_sql('base', 3)}) ORDER BY {order_sql(3)} LIMIT 100 OFFSET 250",
    ),
)
def page_within_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_statements = data(spark, sf_dir)
    base = match.match(all_statements, Pattern(p=Term.iri(V + "nation")))
    return paging.expanded_page(base, all_statements, 3, limit=100, offset=250)


@register(
    "page_across_sources",
    with_sql(
        STATEMENTS,
        DATA,
        f"SELECT * FROM data WHERE p = '{V}name' ORDER BY {order_sql()} LIMIT 200 OFFSET 1480",
    ),
)
def page_across_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_statements = data(spark, sf_dir)
    pattern = Pattern(p=Term.iri(V + "name"))
    counts = expand.solution_counts(all_statements, pattern)
    base, offset = federate.reaching(match.match(all_statements, pattern), counts, 200, 1480)
    return paging.page(base, 200, offset)


@register(
    "page_sources",
    with_sql(
        STATEMENTS,
        DATA,
        "counts AS (SELECT source_rank, source_key, count(*) AS solutions FROM data "
        f"WHERE p = '{V}name' GROUP BY source_rank, source_key)",
        "starts AS (SELECT *, coalesce(cast(sum(solutions) OVER (ORDER BY source_rank, source_key "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bigint), 0) AS first FROM counts)",
        "SELECT source_rank, source_key, solutions, first, greatest(1480 - first, 0) AS skip, "
        "least(solutions, 1680 - first) - greatest(1480 - first, 0) AS take FROM starts "
        "WHERE first < 1680 AND first + solutions > 1480",
    ),
)
def page_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = expand.solution_counts(data(spark, sf_dir), Pattern(p=Term.iri(V + "name")))
    return federate.page_sources(counts, 200, 1480)


@register(
    "merge_graphs_distinct",
    with_sql(
        STATEMENTS, f"SELECT count(*) AS distinct_statements FROM (SELECT DISTINCT {TERMS} FROM statements)"
    ),
)
def merge_graphs_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return federate.distinct_statements(L.lift(spark, sf_dir))


@register(
    "merge_graphs",
    with_sql(
        STATEMENTS,
        f"SELECT {TERMS} FROM statements WHERE source_id = 1 UNION SELECT {TERMS} FROM statements "
        f"WHERE source_id = 2 UNION SELECT {TERMS} FROM statements WHERE source_id = 3",
    ),
)
def merge_graphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    statements = L.lift(spark, sf_dir)
    return federate.merge(*[statements.filter(F.col("source_id") == n) for n in (1, 2, 3)])


# --- requests -------------------------------------------------------------------

REQUESTS = f"requests AS ({X.REQUESTS})"
DEFINITIONS = f"definitions AS ({X.DEFINITIONS})"
FORMATS = ", ".join(f"'{f}'" for f in uri.FORMATS)
IDENTIFIED = (
    "parts AS (SELECT *, regexp_extract(path, '^.+\\.([^.]+)$', 1) AS ext, "
    "regexp_extract(path, '^all\\.([a-zA-Z]+)$', 1) AS pf FROM requests),\n"
    "identified AS (SELECT request_id, root, path, query_string, "
    "CASE WHEN regexp_matches(path, '^all(\\.[a-zA-Z]*)?$') THEN 'pattern' "
    "WHEN regexp_matches(path, '^api/triples(/[0-9]+)?$') THEN 'source' "
    "WHEN path <> '' AND NOT starts_with(path, 'api') AND NOT starts_with(path, 'discovery') "
    "THEN 'dereference' END AS route, "
    f"CASE WHEN pf <> '' THEN pf WHEN lower(ext) IN ({FORMATS}) THEN ext END AS format, "
    f"CASE WHEN lower(ext) IN ({FORMATS}) THEN regexp_replace(path, '\\.[^.]+$', '') ELSE path END AS identifier "
    "FROM parts)"
)
ANCESTORS = (
    "members AS (SELECT DISTINCT identifier, "
    "CASE WHEN own = identifier THEN 'dataset' ELSE 'collection' END AS kind, "
    "CASE WHEN own = identifier THEN concat(own, '/', resource_name) ELSE own END AS uri FROM ("
    "SELECT own, resource_name, array_to_string(list_slice(segments, 1, i), '/') AS identifier FROM ("
    "SELECT own, resource_name, segments, unnest(generate_series(1, len(segments))) AS i FROM ("
    "SELECT rtrim(collection_uri, '/') AS own, resource_name, "
    "string_split(rtrim(collection_uri, '/'), '/') AS segments FROM definitions))))"
)
RESOLVED = (
    "resolved AS (SELECT i.*, concat(root, '/', identifier) AS uri, "
    "CASE WHEN identifier IN (SELECT concat(rtrim(collection_uri, '/'), '/', resource_name) FROM definitions) "
    "THEN 'dataset' "
    "WHEN split_part(identifier, '/', 1) IN ('info', 'discovery') THEN 'core' "
    "WHEN identifier IN (SELECT identifier FROM members) THEN 'collection' "
    "WHEN concat(root, '/', identifier) IN (SELECT s FROM data WHERE s_kind = 'uri') THEN 'statements' "
    "END AS resolution FROM identified i)"
)


def resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.resolve(
        X.frame(spark, sf_dir, X.REQUESTS),
        X.frame(spark, sf_dir, X.DEFINITIONS),
        X.frame(spark, sf_dir, X.CORE_RESOURCES),
        data(spark, sf_dir),
    )


RESOLVE_PARTS = (STATEMENTS, DATA, REQUESTS, DEFINITIONS, IDENTIFIED, ANCESTORS, RESOLVED)


@register(
    "resolve_routes",
    with_sql(
        *RESOLVE_PARTS,
        "SELECT request_id, root, path, query_string, route, format, identifier, uri, resolution FROM resolved",
    ),
)
def resolve_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolved(spark, sf_dir)


@register(
    "list_collection",
    with_sql(
        *RESOLVE_PARTS,
        "SELECT request_id, identifier, kind, concat(root, '/', m.uri) AS uri FROM resolved "
        "JOIN members m USING (identifier) WHERE resolution = 'collection'",
    ),
)
def list_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.list_collections(
        resolved(spark, sf_dir), X.frame(spark, sf_dir, X.DEFINITIONS)
    )


@register(
    "unresolved_requests",
    with_sql(*RESOLVE_PARTS, "SELECT request_id, path, route FROM resolved WHERE resolution IS NULL"),
)
def unresolved_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = stage(resolved(spark, sf_dir))
    answered = named.filter(F.col("resolution").isNotNull())
    return resolve.unresolved(named, answered).select("request_id", "path", "route")


@register(
    "dereference_batch",
    with_sql(
        *RESOLVE_PARTS[:-1],
        RESOLVED,
        DEPTHS,
        "base AS (SELECT request_id, data.* FROM resolved JOIN data ON s = uri AND s_kind = 'uri' "
        "WHERE resolution = 'statements')",
        f"solutions AS ({_by_depth_sql('base', 'request_id, ')})",
        f"ranked AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY {order_sql(3)}) AS r FROM solutions)",
        "SELECT * EXCLUDE (r) FROM ranked WHERE r > 2 AND r <= 102",
    ),
)
def dereference_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = resolved(spark, sf_dir).filter(F.col("resolution") == "statements")
    return federate.dereference(data(spark, sf_dir), asked, depths(spark), offset=2)


@register(
    "dereference_statements",
    with_sql(
        *RESOLVE_PARTS[:-1],
        RESOLVED,
        DEPTHS,
        "base AS (SELECT request_id, data.* FROM resolved JOIN data ON s = uri AND s_kind = 'uri' "
        "WHERE resolution = 'statements')",
        f"solutions AS ({_by_depth_sql('base', 'request_id, ')})",
        f"ranked AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY {order_sql(3)}) AS r FROM solutions)",
        "page AS (SELECT * FROM ranked WHERE r <= 100)",
        construct_sql("page", 3, "request_id, "),
    ),
)
def dereference_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = resolved(spark, sf_dir).filter(F.col("resolution") == "statements")
    pages = federate.dereference(data(spark, sf_dir), asked, depths(spark))
    return expand.construct(pages, 3, by=["request_id"])


# --- description of an answer ---------------------------------------------------

RESULTS = f"results AS ({X.RESULTS})"
_FULL_PARTS = "list_filter(string_split(query_string, '&'), lambda x: x <> '' AND x <> '0')"
_KEPT_PARTS = (
    "list_filter(string_split(query_string, '&'), lambda x: x <> '' AND x <> '0' AND "
    "lower(split_part(x, '=', 1)) IN ('subject', 'predicate', 'object'))"
)
LINKS = (
    "based AS (SELECT *, concat(root, '/', path) AS base, "
    f"array_to_string({_FULL_PARTS}, '&') AS q, array_to_string({_KEPT_PARTS}, '&') AS k FROM results),\n"
    "links AS (SELECT *, concat(replace(concat(base, CASE WHEN q <> '' THEN concat('?', q) ELSE '' END), '#', '%23'), "
    "CASE WHEN path <> 'all' THEN '#dataset' ELSE '' END) AS full_uri, "
    "concat(replace(concat(base, CASE WHEN k <> '' THEN concat('?', k) ELSE '' END), '#', '%23'), "
    "CASE WHEN k <> '' THEN '&' ELSE '?' END, 'limit=', \"limit\", '&offset=') AS link, "
    "cast(ceil(total / cast(\"limit\" as double)) as bigint) AS pages FROM based),\n"
    "paged AS (SELECT result_id, root, path, query_string, \"limit\", \"offset\", total, pages, full_uri, "
    "concat(link, 0) AS first, "
    "CASE WHEN \"offset\" + \"limit\" < total THEN concat(link, \"offset\" + \"limit\") END AS next, "
    "CASE WHEN \"offset\" + \"limit\" < total THEN concat(link, (pages - 1) * \"limit\") END AS last, "
    "CASE WHEN \"offset\" > 0 AND total > 0 THEN concat(link, greatest(\"offset\" - \"limit\", 0)) END AS previous "
    "FROM links)"
)


@register(
    "paging_links",
    with_sql(RESULTS, LINKS, "SELECT * EXCLUDE (full_uri) FROM paged"),
)
def paging_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.paging_links(X.frame(spark, sf_dir, X.RESULTS))


def _described_sql() -> str:
    dataset, template = "concat(root, '/all#dataset')", "concat('_:r', result_id, '.template')"
    a, hydra, void = M.RDF_TYPE, M.HYDRA, M.VOID
    rows = [
        (dataset, "uri", a, f"'{void}Dataset'", "uri", ""),
        (dataset, "uri", a, f"'{hydra}Collection'", "uri", ""),
        (dataset, "uri", hydra + "search", template, "bnode", ""),
        (template, "bnode", a, f"'{hydra}IriTemplate'", "uri", ""),
        (template, "bnode", hydra + "template", "concat(root, '/all{?subject,predicate,object}')", "literal", ""),
        ("full_uri", "uri", hydra + "totalItems", "cast(total as string)", "literal", M.XSD_INTEGER),
        ("full_uri", "uri", void + "triples", "cast(total as string)", "literal", M.XSD_INTEGER),
        ("full_uri", "uri", hydra + "itemsPerPage", "cast(\"limit\" as string)", "literal", M.XSD_INTEGER),
        ("full_uri", "uri", void + "subset", dataset, "uri", ""),
        (dataset, "uri", void + "subset", "full_uri", "uri", ""),
    ]
    for name in ("subject", "predicate", "object"):
        node = f"concat('_:r', result_id, '.{name}')"
        rows += [
            (node, "bnode", a, f"'{hydra}IriTemplateMapping'", "uri", ""),
            (node, "bnode", hydra + "variable", f"'{name}'", "literal", ""),
            (node, "bnode", hydra + "property", f"'{M.RDF}{name}'", "uri", ""),
            (template, "bnode", hydra + "mapping", node, "bnode", ""),
        ]
    for name in ("first", "next", "last", "previous"):
        rows.append(("full_uri", "uri", f"{hydra}{name}Page", name, "uri", ""))
    selects = [
        f"SELECT result_id, {s} AS s, '{sk}' AS s_kind, '{p}' AS p, {o} AS o, '{ok}' AS o_kind, "
        f"nullif('{dt}', '') AS o_datatype, cast(null as string) AS o_lang FROM paged"
        for s, sk, p, o, ok, dt in rows
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(selects)}) WHERE o IS NOT NULL"


@register("describe_result", with_sql(RESULTS, LINKS, _described_sql()))
def describe_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.describe(X.frame(spark, sf_dir, X.RESULTS))


# --- addresses ------------------------------------------------------------------

PAGE_QUERY = (
    "q AS (SELECT page_id, url, split_part(url, '?', 1) AS base, "
    "CASE WHEN contains(url, '?') THEN concat(regexp_replace(url, '^[^?]*\\?', ''), '&&limit=20&Subject=a=b&0') "
    "ELSE '' END AS qs FROM pages)"
)


def page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.table(spark, sf_dir, "pages").select(
        "page_id",
        "url",
        F.substring_index("url", "?", 1).alias("base"),
        F.when(
            F.contains(F.col("url"), F.lit("?")),
            F.concat(F.regexp_replace("url", r"^[^?]*\?", ""), F.lit("&&limit=20&Subject=a=b&0")),
        )
        .otherwise("")
        .alias("qs"),
    )


@register(
    "raw_uri",
    with_sql(
        PAGE_QUERY,
        "SELECT page_id, replace(concat(base, CASE WHEN qs = '' THEN '' ELSE concat('?', "
        "array_to_string(list_filter(string_split(qs, '&'), lambda x: x <> '' AND x <> '0'), '&')) END), "
        "'#', '%23') AS raw_uri FROM q",
    ),
)
def raw_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_urls(spark, sf_dir).select(
        "page_id", uri.raw_request_uri(F.col("base"), F.col("qs")).alias("raw_uri")
    )


@register(
    "uri_extension",
    "SELECT page_id, CASE WHEN lower(e) IN (" + FORMATS + ") THEN e END AS format, "
    "CASE WHEN lower(e) IN (" + FORMATS + ") THEN regexp_replace(b, '\\.[^.]+$', '') ELSE b END AS identifier "
    "FROM (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS b, "
    "regexp_extract(regexp_replace(url, '[?#].*$', ''), '^.+\\.([^.]+)$', 1) AS e FROM pages)",
)
def uri_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.regexp_replace("url", "[?#].*$", "")
    return L.table(spark, sf_dir, "pages").select(
        "page_id",
        uri.extension(base).alias("format"),
        uri.without_extension(base).alias("identifier"),
    )


@register(
    "uri_parts",
    "SELECT page_id, regexp_extract(url, '^(.*)/[^/]*$', 1) AS collection_uri, "
    "regexp_extract(url, '([^/]*)$', 1) AS resource_name, rtrim(url, '/') AS trimmed, "
    "rtrim(ltrim(concat('\"\"', url, '\"'), '\"'), '\"') AS unquoted FROM pages",
)
def uri_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.table(spark, sf_dir, "pages").select(
        "page_id",
        uri.parent_path(F.col("url")).alias("collection_uri"),
        uri.last_segment(F.col("url")).alias("resource_name"),
        uri.trim_end(F.col("url"), "/").alias("trimmed"),
        uri.trim_quotes(F.concat(F.lit('""'), "url", F.lit('"'))).alias("unquoted"),
    )


@register(
    "uri_encode",
    "SELECT doc_id, replace(url_encode(text), '~', '%7E') AS encoded FROM documents",
)
def uri_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.table(spark, sf_dir, "documents").select(
        "doc_id", uri.percent_encode(F.col("text")).alias("encoded")
    )


@register(
    "endpoint_query_uri",
    "SELECT page_id, concat('http://ex.org/sparql?query=', url_encode(url), "
    "'&format=application%2Frdf%2Bxml') AS query_uri FROM pages",
)
def endpoint_query_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.table(spark, sf_dir, "pages").select(
        "page_id",
        uri.query_uri(F.lit("http://ex.org/sparql//"), F.col("url"), "application/rdf+xml").alias(
            "query_uri"
        ),
    )


@register(
    "uri_fingerprint",
    "SELECT page_id, sha1(url) AS uri_key, sha1(concat('sparql_', page_id, '_', url)) AS query_key FROM pages",
)
def uri_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.table(spark, sf_dir, "pages").select(
        "page_id",
        uri.fingerprint(F.col("url")).alias("uri_key"),
        uri.query_fingerprint(F.col("page_id"), F.col("url")).alias("query_key"),
    )


@register(
    "rewrite_query",
    with_sql(
        PAGE_QUERY,
        "parts AS (SELECT page_id, url, list_filter(string_split(qs, '&'), lambda x: x <> '' AND x <> '0' "
        "AND split_part(x, '=', 1) <> 'page') AS c, "
        "list_filter(string_split(qs, '&'), lambda x: x <> '' AND x <> '0' "
        "AND split_part(x, '=', 1) NOT IN ('page', 'page_size', 'limit', 'offset')) AS f FROM q)",
        "SELECT page_id, concat('http://s', '?', array_to_string(CASE WHEN "
        "len(list_filter(c, lambda x: lower(split_part(x, '=', 1)) = 'subject')) > 0 THEN "
        "list_transform(c, lambda x: CASE WHEN lower(split_part(x, '=', 1)) = 'subject' "
        "THEN concat(split_part(x, '=', 1), '=', url) ELSE x END) "
        "ELSE list_concat(c, [concat('subject=', url)]) END, '&')) AS count_uri, "
        "CASE WHEN len(f) = 0 THEN 'http://s' ELSE concat('http://s?', array_to_string(f, '&')) END "
        "AS fetch_uri FROM parts",
    ),
)
def rewrite_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.lit("http://s")
    return page_urls(spark, sf_dir).select(
        "page_id",
        uri.count_fragment(start, F.col("qs"), F.col("url")).alias("count_uri"),
        uri.fetch_fragment(start, F.col("qs")).alias("fetch_uri"),
    )


# --- text -----------------------------------------------------------------------


@register("unescape_unicode", "SELECT doc_id, text AS decoded FROM documents")
def unescape_unicode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accented letters are written as codes, with a surrogate pair at the end, and read back."""
    letters = "àâäçéèêëîïíñôöóßùûüúáÀÂÄÇÉÈÊËÎÏÍÑÔÖÓÙÛÜÚÁ"
    parts = F.regexp_extract_all("text", F.lit(f"[{letters}]|[^{letters}]++"), F.lit(0))

    def write(part: Column) -> Column:
        return F.when(part.isin(*letters), F.concat(F.lit("\\u"), F.lpad(F.hex(F.ascii(part)), 4, "0"))).otherwise(part)

    written = F.concat(F.array_join(F.transform(parts, write), ""), F.lit("\\uD83D\\uDE00"))
    # A column of its own, so that it is written once and not wherever the decoder looks at it.
    docs = L.table(spark, sf_dir, "documents").select("doc_id", written.alias("written"))
    return docs.select("doc_id", F.regexp_replace(text.decode_unicode(F.col("written")), "\U0001f600$", "").alias("decoded"))


@register(
    "ntriples_round_trip",
    f"WITH t AS ({L.lift_sql(L.DOCUMENTS)}) SELECT {TERMS} FROM t",
)
def ntriples_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = ntriples.lines(L.lift(spark, sf_dir, L.DOCUMENTS))
    return ntriples.parse(written, F.lit(7))


@register(
    "ntriples_lines",
    with_sql(
        STATEMENTS,
        "SELECT concat(CASE WHEN s_kind = 'uri' THEN concat('<', s, '>') ELSE s END, ' <', p, '> ', "
        "CASE WHEN o_kind = 'uri' THEN concat('<', o, '>') WHEN o_kind = 'bnode' THEN o "
        "WHEN o_datatype IS NULL THEN concat('\"', o, '\"') "
        "ELSE concat('\"', o, '\"^^<', o_datatype, '>') END, ' .') AS value FROM statements",
    ),
)
def ntriples_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ntriples.lines(L.lift(spark, sf_dir))


@register(
    "quarantine_rows",
    "SELECT line AS value, CASE WHEN NOT regexp_matches(line, '\\.\\s*$') THEN 'statement has no closing dot' "
    "WHEN regexp_matches(line, '^\\s*\"') THEN 'subject is a literal' ELSE 'not a statement' END AS reason, "
    "doc_id FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) "
    "WHERE NOT regexp_matches(line, '^\\s*(#.*)?$')",
)
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of prose between good statements: all of the prose is set aside, with reasons."""
    docs = L.table(spark, sf_dir, "documents")
    prose = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("value"))
    good = docs.select(
        "doc_id",
        F.concat_ws(" ", F.concat(F.lit("<http://ex.org/doc/"), "doc_id", F.lit(">")),
                    F.lit("<http://ex.org/v#lang>"),
                    F.concat(F.lit('"'), "lang", F.lit('"')), F.lit(".")).alias("value"),
    )
    return ntriples.rejects(prose.unionByName(good))


# --- saved answers and fragments ------------------------------------------------


@register(
    "json_answer_count",
    "SELECT o_custkey AS source_id, count(*) AS solutions FROM orders "
    "WHERE o_custkey IN (SELECT c_custkey FROM customer) GROUP BY o_custkey",
)
def json_answer_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answers.counts(X.frame(spark, sf_dir, X.COUNT_ANSWERS))


@register(
    "json_path",
    "SELECT event_id, cast(json_extract_string(props, '$.k') AS bigint) AS k FROM events",
)
def json_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.table(spark, sf_dir, "events").select(
        "event_id", answers.number(F.col("props"), "$.k").alias("k")
    )


FRAGMENTS = f"fragments AS ({X.FRAGMENTS})"
_STATED = "max(CASE WHEN s = url AND p = '{}' AND o_kind = 'literal' THEN try_cast(o AS bigint) END)"
STATED = (
    "stated AS (SELECT url, startfragment, coalesce("
    f"{_STATED.format(M.HYDRA + 'totalItems')}, {_STATED.format(M.VOID + 'triples')}) AS total, "
    f"{_STATED.format(M.HYDRA + 'itemsPerPage')} AS page_size FROM fragments GROUP BY url, startfragment)"
)


@register("fragment_totals", with_sql(FRAGMENTS, STATED, "SELECT * FROM stated"))
def fragment_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragments.totals(X.frame(spark, sf_dir, X.FRAGMENTS))


@register(
    "fragment_page_plan",
    with_sql(
        FRAGMENTS,
        STATED,
        "plans AS (SELECT *, cast(ceil(3 / cast(page_size as double)) as bigint) AS f, "
        "cast(ceil(20 / cast(page_size as double)) as bigint) AS m FROM stated WHERE total > 3 AND page_size > 0)",
        "numbered AS (SELECT url, startfragment, total, page_size, unnest(generate_series(f, f + m - 1)) AS page FROM plans)",
        "SELECT *, concat(url, '&page=', page) AS page_url FROM numbered",
    ),
)
def fragment_page_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragments.page_plan(fragments.totals(X.frame(spark, sf_dir, X.FRAGMENTS)), 20, 3)


@register(
    "fragment_unusable",
    with_sql(FRAGMENTS, STATED, "SELECT * FROM stated WHERE total IS NULL OR page_size IS NULL"),
)
def fragment_unusable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragments.unusable(fragments.totals(X.frame(spark, sf_dir, X.FRAGMENTS)))


@register(
    "fragment_strip_metadata",
    with_sql(FRAGMENTS, f"SELECT url, startfragment, {TERMS} FROM fragments WHERE starts_with(s, '{NS}orders/')"),
)
def fragment_strip_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragments.strip_metadata(X.frame(spark, sf_dir, X.FRAGMENTS))


# --- catalog --------------------------------------------------------------------


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {kind: X.frame(spark, sf_dir, sql) for kind, sql in X.CHILDREN.items()}


PARENTS = f"parents AS ({X.PARENTS})"
CHILDREN = ",\n".join(f"{kind} AS ({sql})" for kind, sql in X.CHILDREN.items())
_KIND = "lower(regexp_replace(source_type, 'Source$', ''))"


@register(
    "catalog_resolve",
    with_sql(
        PARENTS,
        CHILDREN,
        "SELECT p.id, 'turtle' AS type, uri, null AS endpoint, null AS endpoint_user, null AS endpoint_password, "
        "null AS depth, null AS named_graph, null AS startfragment FROM parents p JOIN turtle c "
        "ON p.source_id = c.id AND source_type = 'TurtleSource' "
        "UNION ALL SELECT p.id, 'rdf', uri, null, null, null, null, null, null FROM parents p JOIN rdf c "
        "ON p.source_id = c.id AND source_type = 'RdfSource' "
        "UNION ALL SELECT p.id, 'sparql', null, endpoint, endpoint_user, endpoint_password, depth, named_graph, null "
        "FROM parents p JOIN sparql c ON p.source_id = c.id AND source_type = 'SparqlSource' "
        "UNION ALL SELECT p.id, 'ldf', null, null, null, null, null, null, startfragment FROM parents p JOIN ldf c "
        "ON p.source_id = c.id AND source_type = 'LdfSource'",
    ),
)
def catalog_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.resolve(X.frame(spark, sf_dir, X.PARENTS), _tables(spark, sf_dir))


@register(
    "catalog_orphans",
    "SELECT cast(s_suppkey as int) AS id, cast(s_suppkey as int) + 7 AS source_id, "
    "CASE WHEN s_nationkey < 6 THEN 'turtle' WHEN s_nationkey < 12 THEN 'rdf' "
    "WHEN s_nationkey < 18 THEN 'sparql' ELSE 'ldf' END AS type FROM supplier WHERE s_acctbal < 0",
)
def catalog_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = X.frame(spark, sf_dir, X.PARENTS)
    return catalog.orphans(parents, _tables(spark, sf_dir)).select("id", "source_id", "type")


CONFIG = f"config AS ({X.CONFIG})"


@register(
    "catalog_validate",
    with_sql(
        CONFIG,
        "SELECT id, array_to_string(list_filter(["
        "CASE WHEN type = '' THEN 'type is required, one of: ldf, rdf, sparql, turtle' END, "
        "CASE WHEN type = 'json' THEN 'type is not supported' END, "
        "CASE WHEN type IN ('turtle', 'rdf') AND uri = '' THEN 'uri is required' END, "
        "CASE WHEN type = 'sparql' AND endpoint IS NULL THEN 'endpoint is required' END, "
        "CASE WHEN type = 'ldf' AND startfragment = '' THEN 'startfragment is required' END, "
        "CASE WHEN type IN ('turtle', 'rdf') AND uri = 'no address' THEN 'uri cannot be resolved' END, "
        "CASE WHEN type = 'sparql' AND depth = 'deep' THEN 'depth must be an integer' END, "
        "CASE WHEN type = 'sparql' AND depth = '0' THEN 'depth must be at least 1' END, "
        "CASE WHEN type = 'sparql' AND depth = '6' THEN 'depth may not be greater than 5' END"
        "], lambda x: x IS NOT NULL), '; ') AS errors FROM config",
    ),
)
def catalog_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = catalog.validate(X.frame(spark, sf_dir, X.CONFIG))
    return checked.select("id", F.array_join("errors", "; ").alias("errors"))


@register(
    "catalog_defaults",
    with_sql(
        CONFIG,
        "SELECT id, type, nullif(uri, '') AS uri, nullif(nullif(endpoint, ''), '0') AS endpoint, "
        "nullif(startfragment, '') AS startfragment, "
        "coalesce(nullif(nullif(depth, ''), '0'), '1') AS depth FROM config",
    ),
)
def catalog_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.with_defaults(X.frame(spark, sf_dir, X.CONFIG))


@register(
    "catalog_depths",
    with_sql(
        CHILDREN,
        PARENTS,
        "SELECT concat('sparql:', p.id) AS source_key, coalesce(depth, 1) AS depth FROM parents p "
        "JOIN sparql c ON p.source_id = c.id AND source_type = 'SparqlSource' "
        "UNION SELECT 'local', 3 FROM parents p JOIN turtle c ON p.source_id = c.id AND source_type = 'TurtleSource' "
        "UNION SELECT 'local', 3 FROM parents p JOIN rdf c ON p.source_id = c.id AND source_type = 'RdfSource' "
        "UNION SELECT concat('ldf:', p.id), 1 FROM parents p JOIN ldf c ON p.source_id = c.id AND source_type = 'LdfSource'",
    ),
)
def catalog_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.depths(catalog_resolve(spark, sf_dir))


# --- nested form ----------------------------------------------------------------


@register(
    "resource_map",
    with_sql(
        STATEMENTS,
        f"g AS (SELECT DISTINCT {TERMS} FROM statements)",
        "SELECT s_kind, s, p, string_agg(o, '|' ORDER BY o) AS objects, count(*) AS n FROM g GROUP BY s_kind, s, p",
    ),
)
def resource_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = resources.resource_map(L.lift(spark, sf_dir))
    return nested.select("s_kind", "s", F.explode("properties").alias("p", "list")).select(
        "s_kind",
        "s",
        "p",
        F.array_join(F.transform("list", lambda o: o["value"]), "|").alias("objects"),
        F.size("list").cast("long").alias("n"),
    )


@register(
    "turtle_blocks",
    with_sql(
        STATEMENTS,
        "g AS (SELECT DISTINCT s_kind, s, p, CASE WHEN s_kind = 'uri' THEN concat('<', s, '>') ELSE s END AS subject, "
        "concat('<', p, '>') AS predicate, CASE WHEN o_kind = 'uri' THEN concat('<', o, '>') WHEN o_kind = 'bnode' THEN o "
        "WHEN o_datatype IS NULL THEN concat('\"', o, '\"') ELSE concat('\"', o, '\"^^<', o_datatype, '>') END AS object "
        "FROM statements)",
        "l AS (SELECT s_kind, s, subject, predicate, string_agg(object, concat(' ,', chr(10), '    ') ORDER BY object) AS objects "
        "FROM g GROUP BY ALL)",
        "SELECT s_kind, s, 0 AS part, concat(subject, chr(10), '  ', string_agg(concat(predicate, ' ', objects), "
        "concat(' ;', chr(10), '  ') ORDER BY concat(predicate, ' ', objects)), ' .') AS value FROM l GROUP BY s_kind, s, subject",
    ),
)
def turtle_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resources.turtle_blocks(L.lift(spark, sf_dir))


# --- documents ------------------------------------------------------------------

TURTLE = f"docs AS ({X.TURTLE})"
_ORDER = "concat('http://ex.org/orders/', o_orderkey)"
_ACCOUNT = "concat('_:s', o_orderkey, '.', o_orderkey, '.-node')"


def _rows(table: str, *rows: tuple[str, str, str, str, str, str, str]) -> str:
    """UNION of (s, s_kind, p, o, o_kind, datatype, lang) expressions."""
    return "\nUNION ALL ".join(
        f"SELECT {s} AS s, '{sk}' AS s_kind, '{p}' AS p, {o} AS o, '{ok}' AS o_kind, "
        f"nullif('{dt}', '') AS o_datatype, nullif('{lang}', '') AS o_lang FROM {table}"
        for s, sk, p, o, ok, dt, lang in rows
    )


_TURTLE_ROWS = _rows(
    "orders",
    (_ORDER, "uri", V + "status", "o_orderstatus", "literal", "", ""),
    (_ORDER, "uri", V + "priority", "o_orderpriority", "literal", "", ""),
    (_ORDER, "uri", V + "customer", "concat('http://ex.org/customer/', o_custkey)", "uri", "", ""),
    (_ORDER, "uri", V + "customer", _ACCOUNT, "bnode", "", ""),
    (_ACCOUNT, "bnode", V + "key", "cast(o_custkey as string)", "literal", M.XSD_INTEGER, ""),
    (_ORDER, "uri", M.RDF_TYPE, f"'{V}Order'", "uri", "", ""),
    (_ORDER, "uri", V + "date", "cast(cast(o_orderdate as date) as string)", "literal", M.XSD + "date", ""),
)


@register(
    "turtle_corpus",
    with_sql(
        f"t AS ({_TURTLE_ROWS})",
        # the number in a made label is a token position
        "SELECT regexp_replace(s, 'node$', '') AS s, s_kind, p, regexp_replace(o, 'node$', '') AS o, o_kind, o_datatype, o_lang FROM t",
    ),
)
def turtle_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = X.frame(spark, sf_dir, X.TURTLE)
    found = turtle.parse(docs, "body", "doc")
    return found.select(
        F.regexp_replace("s", r"node\d+$", "").alias("s"), "s_kind", "p",
        F.regexp_replace("o", r"node\d+$", "").alias("o"), "o_kind", "o_datatype", "o_lang",
    )


@register(
    "turtle_rejects",
    "SELECT doc_id, text AS value FROM documents",
)
def turtle_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prose is no Turtle: every document is set aside, with its whole text and a reason."""
    docs = L.table(spark, sf_dir, "documents").select("doc_id", "text")
    bad = turtle.rejects(docs, "text", "doc_id")
    return bad.filter(F.col("reason") != "").drop("reason")


_CUSTOMER = "concat('http://ex.org/customer/', c_custkey)"
_NODE = "concat('_:s', c_custkey, '.', c_custkey, '.-node1')"
_GRAPH = "(SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING')"
_RDFXML_ROWS = _rows(
    _GRAPH,
    (_CUSTOMER, "uri", M.RDF_TYPE, f"'{V}Customer'", "uri", "", ""),
    (_CUSTOMER, "uri", V + "segment", "c_mktsegment", "literal", "", ""),
    (_CUSTOMER, "uri", V + "name", "c_name", "literal", "", "en"),
    (_CUSTOMER, "uri", V + "nation", "concat('http://ex.org/nation/', c_nationkey)", "uri", "", ""),
    (_CUSTOMER, "uri", V + "account", _NODE, "bnode", "", ""),
    (_NODE, "bnode", V + "balance", "cast(cast(round(c_acctbal * 100) as bigint) as string)", "literal", M.XSD_INTEGER, ""),
)


@register("rdfxml_corpus", f"SELECT {TERMS} FROM ({_RDFXML_ROWS})")
def rdfxml_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answers.graphs(X.frame(spark, sf_dir, X.RDFXML)).select(*M.TERMS)


@register(
    "rdfxml_rejects",
    "SELECT cast(c_custkey as string) AS source_id, concat('no graph for ', c_name) AS value, "
    "'answer is not RDF/XML' AS reason FROM customer WHERE c_mktsegment = 'BUILDING'",
)
def rdfxml_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answers.rejected(X.frame(spark, sf_dir, X.RDFXML))


# Fragment pages as Turtle: one page per order with its metadata in front.
FRAGMENT_BODIES = (
    "SELECT cast(o_orderkey as string) AS doc, concat('{start}?page=', o_orderkey) AS url, '{start}' AS startfragment, "
    "concat('@prefix hydra: <{hydra}> .\n@prefix void: <{void}> .\n@prefix v: <{v}> .\n"
    "<?page=', o_orderkey, '> a hydra:PagedCollection ; hydra:totalItems ', o_custkey, ' ; hydra:itemsPerPage 2 .\n"
    "<#dataset> hydra:search [ hydra:template \"t\" ; hydra:mapping [ hydra:variable \"s\" ] ] .\n"
    "<{ns}orders/', o_orderkey, '> v:status \"', o_orderstatus, '\"@en ; v:customer <{ns}customer/', o_custkey, '> .') "
    "AS body FROM orders"
).format(start=X.START, hydra=M.HYDRA, void=M.VOID, v=V, ns=NS)


@register(
    "fragment_scan",
    with_sql(
        "t AS ("
        + _rows(
            "orders",
            (_ORDER, "uri", V + "status", "o_orderstatus", "literal", "", "en"),
            (_ORDER, "uri", V + "customer", "concat('http://ex.org/customer/', o_custkey)", "uri", "", ""),
        ).replace("SELECT", f"SELECT concat('{X.START}?page=', o_orderkey) AS url, cast(o_custkey as bigint) AS total, cast(2 as bigint) AS page_size,")
        + ")",
        "SELECT * FROM t",
    ),
)
def fragment_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = X.frame(spark, sf_dir, FRAGMENT_BODIES)
    rows = stage(turtle.parse(pages, "body", "doc", base=F.col("startfragment")).drop("doc"))
    stated = fragments.totals(rows).drop("startfragment")
    return fragments.strip_metadata(rows).join(stated, "url").drop("startfragment")


# --- store ----------------------------------------------------------------------


@register(
    "replace_graph",
    with_sql(
        STATEMENTS,
        f"kept AS (SELECT DISTINCT {TERMS}, graph, source_id FROM statements WHERE (source_id = 2 AND p <> '{V}segment') "
        "OR source_id = 3 OR source_id = 5)",
        "SELECT graph, count(*) AS n, count(DISTINCT s) AS subjects FROM kept GROUP BY graph",
    ),
)
def replace_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all graphs, replace one by a smaller one, empty two, and read what is left."""
    folder = new_folder(spark, "store")
    statements = L.lift(spark, sf_dir)
    store.append(statements, folder)
    smaller = statements.filter((F.col("source_id") == 2) & (F.col("p") != V + "segment"))
    store.replace(smaller, folder, [L.graph(2), L.graph(4)])
    store.clear(spark, folder, L.graph(1))
    return store.read(spark, folder).groupBy("graph").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("s").alias("subjects")
    )


@register(
    "store_pattern_query",
    with_sql(
        STATEMENTS,
        DATA,
        f"base AS (SELECT * FROM data WHERE p = '{V}nation')",
        f"page AS (SELECT * FROM ({expand_sql('base', 3)}) ORDER BY {order_sql(3)} LIMIT 100 OFFSET 40)",
        construct_sql("page", 3),
    ),
)
def store_pattern_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "store")
    store.append(L.lift(spark, sf_dir), folder)
    stored = match.default_graphs(store.read(spark, folder))
    answer = plans.pattern_query(stored, Pattern(p=Term.iri(V + "nation")), 100, 40, depth=3)
    return answer.statements


@register(
    "store_dereference_query",
    with_sql(
        STATEMENTS,
        DATA,
        DEPTHS,
        f"base AS (SELECT * FROM data WHERE s = '{NS}nation/3' AND s_kind = 'uri')",
        f"solutions AS ({_by_depth_sql('base')})",
        f"page AS (SELECT * FROM solutions ORDER BY {order_sql(3)} LIMIT 100)",
        construct_sql("page", 3),
    ),
)
def store_dereference_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, table = new_folder(spark, "store"), new_folder(spark, "published")
    store.append(L.lift(spark, sf_dir), folder)
    store.publish(spark, folder, table)
    stored = store.published(spark, table)
    return plans.dereference_query(stored, NS + "nation/3", depths(spark)).statements


@register(
    "page_by_rank",
    with_sql(
        STATEMENTS,
        DATA,
        f"SELECT * FROM data WHERE p = '{V}name' ORDER BY {order_sql()} LIMIT 200 OFFSET 3300",
    ),
)
def page_by_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deep page, looked up in the ranks of the published table."""
    folder, table = new_folder(spark, "store"), new_folder(spark, "published")
    store.append(L.lift(spark, sf_dir), folder)
    store.publish(spark, folder, table)
    return store.ranked_page(spark, table, Pattern(p=Term.iri(V + "name")), 200, 3300)[0]


@register(
    "match_bound_object",
    with_sql(STATEMENTS, DATA, f"SELECT * FROM data WHERE o = '{NS}nation/7' AND o_kind = 'uri'"),
)
def match_bound_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that points at a node, from the copy of the published table that is sorted by object."""
    folder, table = new_folder(spark, "store"), new_folder(spark, "published")
    store.append(L.lift(spark, sf_dir), folder)
    store.publish(spark, folder, table, by_object=True)
    pattern = Pattern(o=Term.iri(NS + "nation/7"))
    return match.match(store.for_pattern(spark, table, pattern), pattern)


# --- all kinds of sources ---------------------------------------------------------

# What each kind says of names, in the order that pages follow.
_NAMED = (
    f"named AS (SELECT source_rank, source_key, {TERMS} FROM data WHERE source_key = 'local' AND p = '{V}name' "
    f"UNION ALL SELECT 1, concat('sparql:', 100 + s_nationkey), {L.SUPPLIER}, 'uri', '{V}name', s_name, 'literal', {_NONE}, {_NONE} FROM supplier "
    f"UNION ALL SELECT 2, concat('ldf:', 200 + p_size % 3), {L.PART}, 'uri', '{V}name', p_name, 'literal', {_NONE}, {_NONE} FROM part)"
)


def _federated(spark: SparkSession, sf_dir: str) -> list[federation.StatementSource]:
    """The store, endpoints by nation, fragment servers of parts."""
    listed = X.frame(spark, sf_dir, X.FEDERATED)
    counted, graphs, pages = (X.frame(spark, sf_dir, sql) for sql in (X.FEDERATED_COUNTS, X.FEDERATED_GRAPHS, X.FEDERATED_PAGES))
    return [
        federation.StoreSource(data(spark, sf_dir)),
        federation.EndpointSource(listed, counted, graphs),
        federation.FragmentSource(listed, pages),
    ]


_ALL_NAMES = Pattern(p=Term.iri(V + "name"))


@register(
    "federated_totals",
    with_sql(
        STATEMENTS,
        DATA,
        _NAMED,
        "counts AS (SELECT source_rank, source_key, count(*) AS solutions FROM named GROUP BY source_rank, source_key)",
        "SELECT * FROM counts UNION ALL SELECT null, null, cast(sum(solutions) AS bigint) FROM counts",
    ),
)
def federated_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted in the store, stated by endpoints for their own graph, stated by first pages."""
    return federate.with_total(federation.totals(_federated(spark, sf_dir), _ALL_NAMES))


@register(
    "federated_page",
    with_sql(
        STATEMENTS,
        DATA,
        _NAMED,
        f"SELECT * FROM named ORDER BY {order_sql()} LIMIT 230 OFFSET 1500",
    ),
)
def federated_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page that begins in the store, holds all endpoints and ends in a fragment server."""
    return federation.federated_query(_federated(spark, sf_dir), _ALL_NAMES, 230, 1500).solutions


@register(
    "root_request",
    with_sql(
        STATEMENTS,
        DATA,
        DEPTHS,
        # The page lies within its first matched statements, as each has a solution at least.
        f"base AS (SELECT * FROM data ORDER BY {order_sql()} LIMIT 140)",
        f"page AS (SELECT * FROM ({_by_depth_sql('base')}) ORDER BY {order_sql(3)} LIMIT 100 OFFSET 40)",
        construct_sql("page", 3),
    ),
)
def root_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The address of the root names no subject: all statements are asked for."""
    answer = plans.dereference_query(data(spark, sf_dir), X.ROOT, depths(spark), offset=40, root=X.ROOT)
    return answer.statements


# --- files ----------------------------------------------------------------------

_SUPPLIERS = (
    f"SELECT s_nationkey AS part, concat('<rdf:RDF xmlns:rdf=\"{M.RDF}\" xmlns:v=\"{V}\" xml:base=\"{NS}supplier/all\">\n', "
    "concat_ws('\n', collect_list(concat('<rdf:Description rdf:about=\"', s_suppkey, '\"><v:name>', s_name, "
    "'</v:name><v:nation rdf:resource=\"../nation/', s_nationkey, '\"/></rdf:Description>'))), '\n</rdf:RDF>') AS value "
    "FROM supplier GROUP BY s_nationkey"
)


def _written_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as Turtle, suppliers as one RDF/XML file per nation, documents as lines of
    N-Triples with bad lines between them; returns the catalog of these sources."""
    folder = new_folder(spark, "files")
    customers = L.lift(spark, sf_dir).filter(F.col("source_id") == 2)
    resources.write_turtle(customers, f"{folder}/turtle")
    X.frame(spark, sf_dir, _SUPPLIERS).write.partitionBy("part").text(f"{folder}/rdf")
    docs = L.table(spark, sf_dir, "documents")
    bad = docs.select(F.concat(F.lit("no statement "), "doc_id").alias("value"))
    lines = ntriples.lines(L.lift(spark, sf_dir, L.DOCUMENTS)).unionByName(bad)
    lines.write.text(f"{folder}/lines")
    rows = [(1, "turtle", "turtle", None), (2, "rdf", "rdf", None), (3, "turtle", "lines", "ntriples")]
    rows += [(4, "sparql", None, None)]
    return spark.createDataFrame(
        [(i, kind, name and f"{folder}/{name}", form) for i, kind, name, form in rows],
        "id int, type string, uri string, format string",
    )


@register(
    "load_files",
    with_sql(
        f"statements AS ({L.lift_sql()})",
        f"texts AS ({L.lift_sql(L.DOCUMENTS)})",
        f"suppliers AS ({_rows('supplier', (L.SUPPLIER, 'uri', V + 'name', 's_name', 'literal', '', ''), (L.SUPPLIER, 'uri', V + 'nation', L.iri('nation', 's_nationkey'), 'uri', '', ''))})",
        f"SELECT DISTINCT '{load.GRAPH_BASE}1' AS graph, {TERMS} FROM statements WHERE source_id = 2 "
        f"UNION ALL SELECT DISTINCT '{load.GRAPH_BASE}2', {TERMS} FROM suppliers "
        f"UNION ALL SELECT DISTINCT '{load.GRAPH_BASE}3', {TERMS} FROM texts",
    ),
)
def load_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the tables as files in three formats, load them, and read the store."""
    folder = new_folder(spark, "loaded")
    load.load(spark, _written_sources(spark, sf_dir), f"{folder}/store", f"{folder}/bad")

    def label(value: str) -> Column:
        # labels are scoped by source and file
        return F.regexp_replace(value, r"^_:s\d+\.[0-9a-f]{40}\.", "_:").alias(value)

    return store.read(spark, f"{folder}/store").select(
        "graph", *[label(c) if c in ("s", "o") else F.col(c) for c in M.TERMS]
    )


@register(
    "load_twice",
    "SELECT 3 AS source_id, concat('no statement ', doc_id) AS value, 'statement has no closing dot' AS reason FROM documents",
)
def load_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad lines stand in the quarantine table once, however often their file is loaded."""
    folder = new_folder(spark, "loaded")
    sources = _written_sources(spark, sf_dir)
    for _ in range(2):
        load.load(spark, sources, f"{folder}/store", f"{folder}/bad")
    return store.quarantined(spark, f"{folder}/bad").select("source_id", "value", "reason")
