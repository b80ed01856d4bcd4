"""Requests, definitions, catalog rows, saved answers and fragment pages.

All are derived from whole test tables by SELECTs that read the same in Spark and
DuckDB; see ``lift`` for the statements themselves.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from fixtures.lift import NS, V

ROOT = "http://ex.org"
START = "http://ldf.example.org/orders"
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
HYDRA = "http://www.w3.org/ns/hydra/core#"
VOID = "http://rdfs.org/ns/void#"
XSD_INTEGER = "http://www.w3.org/2001/XMLSchema#integer"


def _request(base: int, table: str, key: str, path: str, query: str = "''") -> str:
    return (
        f"SELECT cast({base} as bigint) + {key} AS request_id, '{ROOT}' AS root, "
        f"{path} AS path, {query} AS query_string FROM {table}"
    )


# Paths of subjects (some with a format), published datasets, collections, core
# resources, the pattern route, and paths that name nothing.
REQUESTS = "\nUNION ALL ".join(
    [
        _request(10_000_000, "region", "r_regionkey", "concat('region/', r_regionkey)"),
        _request(20_000_000, "nation", "n_nationkey", "concat('nation/', n_nationkey)"),
        _request(
            21_000_000, "nation", "n_nationkey", "concat('region/', n_regionkey, '/', n_name, '.json')"
        ),
        _request(
            22_000_000, "nation", "n_nationkey",
            "concat('region/', n_regionkey, '/', n_name, '/stats')",
        ),
        _request(
            30_000_000, "customer", "c_custkey", "concat('customer/', c_custkey)",
            "concat('limit=2&predicate=', c_mktsegment, '&offset=1')",
        ),
        _request(40_000_000, "supplier", "s_suppkey", "concat('supplier/', s_suppkey, '.ttl')"),
        _request(50_000_000, "part", "p_partkey", "concat('info/', p_partkey)"),
        _request(
            60_000_000, "part", "p_partkey", "concat('all.', lower(substring(p_type, 1, 3)))",
            "concat('object=', p_name, '&&predicate=a=b&page=3')",
        ),
        _request(70_000_000, "part", "p_partkey", "concat('part/', p_partkey, '.v', p_size)"),
        _request(80_000_000, "part", "p_partkey", "concat('api/triples/', p_partkey)"),
    ]
)

DEFINITIONS = (
    "SELECT concat('region/', n_regionkey) AS collection_uri, n_name AS resource_name FROM nation\n"
    "UNION ALL SELECT concat('region/', n_regionkey, '/', n_name, '/'), 'stats' FROM nation\n"
    "UNION ALL SELECT concat('region/', n_regionkey, '/', n_name, '/'), 'names' FROM nation"
)

CORE_RESOURCES = "SELECT DISTINCT 'info' AS name FROM region UNION SELECT 'discovery' AS name FROM region"

PARENTS = (
    "SELECT cast(s_suppkey as int) AS id, cast(s_suppkey as int) + 7 AS source_id, "
    "CASE WHEN s_nationkey < 6 THEN 'TurtleSource' WHEN s_nationkey < 12 THEN 'RdfSource' "
    "WHEN s_nationkey < 18 THEN 'SparqlSource' ELSE 'LdfSource' END AS source_type FROM supplier"
)

# Suppliers in debt have no child row: their parents are orphans.
_CHILD = "cast(s_suppkey as int) + 7 AS id"
CHILDREN = {
    "turtle": f"SELECT {_CHILD}, concat('file:///data/', s_suppkey, '.ttl') AS uri "
    "FROM supplier WHERE s_nationkey < 6 AND s_acctbal >= 0",
    "rdf": f"SELECT {_CHILD}, concat('http://ex.org/data/', s_suppkey, '.rdf') AS uri "
    "FROM supplier WHERE s_nationkey >= 6 AND s_nationkey < 12 AND s_acctbal >= 0",
    "sparql": f"SELECT {_CHILD}, concat('http://ex.org/sparql/', s_suppkey, '/') AS endpoint, "
    "s_name AS endpoint_user, cast(null as string) AS endpoint_password, "
    "s_nationkey - 12 AS depth, concat('http://ex.org/graph/', s_suppkey) AS named_graph "
    "FROM supplier WHERE s_nationkey >= 12 AND s_nationkey < 18 AND s_acctbal >= 0",
    "ldf": f"SELECT {_CHILD}, concat('http://ex.org/ldf/', s_suppkey) AS startfragment "
    "FROM supplier WHERE s_nationkey >= 18 AND s_acctbal >= 0",
}

# Configuration rows as somebody would enter them, many of them wrong.
CONFIG = (
    "SELECT c_custkey AS id, "
    "CASE c_mktsegment WHEN 'BUILDING' THEN 'turtle' WHEN 'MACHINERY' THEN 'sparql' "
    "WHEN 'HOUSEHOLD' THEN 'ldf' WHEN 'AUTOMOBILE' THEN 'rdf' "
    "ELSE CASE WHEN c_nationkey < 12 THEN '' ELSE 'json' END END AS type, "
    "CASE WHEN c_nationkey < 5 THEN '' WHEN c_nationkey < 10 THEN 'no address' "
    "ELSE concat('http://ex.org/data/', c_custkey) END AS uri, "
    "CASE WHEN c_nationkey < 3 THEN cast(null as string) WHEN c_nationkey < 5 THEN '0' "
    "ELSE concat('http://ex.org/sparql/', c_custkey) END AS endpoint, "
    "CASE WHEN c_nationkey < 4 THEN '' ELSE concat('http://ex.org/ldf/', c_custkey) END AS startfragment, "
    "CASE WHEN c_nationkey < 4 THEN '0' WHEN c_nationkey < 8 THEN '6' WHEN c_nationkey < 12 THEN 'deep' "
    "WHEN c_nationkey < 16 THEN '' WHEN c_nationkey < 20 THEN cast(null as string) "
    "ELSE '3' END AS depth FROM customer"
)

# One saved count answer per customer: order counts as endpoint JSON, an empty body
# for customers without orders.
COUNT_ANSWERS = (
    "SELECT c_custkey AS source_id, CASE WHEN n IS NULL THEN '' ELSE "
    "concat('{\"head\": {\"vars\": [\"count\"]}, \"results\": {\"bindings\": [{\"count\": "
    "{\"type\": \"literal\", \"value\": \"', n, '\"}}]}}') END AS body FROM customer "
    "LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) q "
    "ON o_custkey = c_custkey"
)

# Fragment pages: one per customer, holding the customer's order statements between
# the page's own metadata.
_PAGE = f"concat('{START}?customer=', c_custkey)"
_ORDER_PAGE = f"concat('{START}?customer=', o_custkey)"
_COUNTS = (
    "customer JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) q "
    "ON o_custkey = c_custkey"
)


def _fragment(
    s: str, p: str, o: str, table: str, kind: str = "uri", s_kind: str = "uri", datatype: str = "", page: str = _PAGE
) -> str:
    typed = f"'{datatype}'" if datatype else "cast(null as string)"
    return (
        f"SELECT {page} AS url, '{START}' AS startfragment, {s} AS s, '{s_kind}' AS s_kind, "
        f"'{p}' AS p, {o} AS o, '{kind}' AS o_kind, {typed} AS o_datatype, "
        f"cast(null as string) AS o_lang FROM {table}"
    )


_SEARCH = "concat('_:search', c_custkey)"
_MAPPING = "concat('_:map', c_custkey)"
FRAGMENTS = "\nUNION ALL ".join(
    [
        _fragment(f"concat('{NS}orders/', o_orderkey)", f"{V}status", "o_orderstatus", "orders", "literal", page=_ORDER_PAGE),
        _fragment(f"concat('{NS}orders/', o_orderkey)", f"{V}customer", f"concat('{NS}customer/', o_custkey)", "orders", page=_ORDER_PAGE),
        _fragment(_PAGE, RDF_TYPE, f"'{HYDRA}PagedCollection'", "customer"),
        _fragment(f"'{START}#dataset'", RDF_TYPE, f"'{HYDRA}Collection'", "customer"),
        _fragment(f"'{START}#dataset'", f"{HYDRA}search", _SEARCH, "customer", "bnode"),
        _fragment(_SEARCH, f"{HYDRA}template", f"'{START}{{?s,p,o}}'", "customer", "literal", "bnode"),
        _fragment(_SEARCH, f"{HYDRA}mapping", _MAPPING, "customer", "bnode", "bnode"),
        _fragment(_MAPPING, f"{HYDRA}variable", "'subject'", "customer", "literal", "bnode"),
        _fragment(_PAGE, f"{HYDRA}totalItems", "cast(n as string)", f"{_COUNTS} WHERE c_mktsegment <> 'BUILDING' AND c_mktsegment <> 'MACHINERY'", "literal", datatype=XSD_INTEGER),
        _fragment(_PAGE, f"{VOID}triples", "cast(n * 2 as string)", f"{_COUNTS} WHERE c_mktsegment <> 'MACHINERY'", "literal", datatype=XSD_INTEGER),
        _fragment(_PAGE, f"{HYDRA}itemsPerPage", "cast(c_nationkey + 1 as string)", f"{_COUNTS} WHERE c_mktsegment <> 'FURNITURE'", "literal", datatype=XSD_INTEGER),
    ]
)

# Endpoints by nation, half of them with a named graph, and fragment servers for the parts.
FEDERATED = (
    "SELECT 100 + n_nationkey AS id, 'sparql' AS type, concat('http://sparql.example.org/', n_nationkey) AS endpoint, "
    "CASE WHEN n_nationkey % 2 = 0 THEN 'http://ex.org/graph/even' END AS named_graph, cast(null as string) AS startfragment FROM nation\n"
    "UNION ALL SELECT DISTINCT 200 + p_size % 3, 'ldf', cast(null as string), cast(null as string), "
    "concat('http://ldf.example.org/parts/', p_size % 3) FROM part"
)
# Every endpoint was asked for its default graph and for a named one; one of them is not its own.
_GRAPHS = (
    "(SELECT n_nationkey AS nation, CASE WHEN n_nationkey % 2 = 0 THEN 'http://ex.org/graph/even' END AS own FROM nation) g "
    "CROSS JOIN (VALUES (cast(null as string)), ('http://ex.org/graph/even')) a(asked)"
)
_IS_OWN = "coalesce(own, '') = coalesce(asked, '')"
FEDERATED_COUNTS = (
    "SELECT 100 + nation AS source_id, asked AS named_graph, concat('{\"results\": {\"bindings\": [{\"count\": {\"value\": \"', "
    f"CASE WHEN {_IS_OWN} THEN coalesce(n, 0) ELSE 999999 END, '\"}}}}]}}}}') AS body FROM {_GRAPHS} "
    "LEFT JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY s_nationkey) q ON s_nationkey = nation"
)
FEDERATED_GRAPHS = (
    "SELECT 100 + nation AS source_id, asked AS named_graph, concat('<rdf:RDF xmlns:rdf=\"http://www.w3.org/1999/02/22-rdf-syntax-ns#\" "
    f"xmlns:v=\"{V}\" xml:base=\"{NS}supplier/\">', CASE WHEN {_IS_OWN} THEN concat_ws('\n', collect_list(concat('<rdf:Description rdf:about=\"', "
    "s_suppkey, '\"><v:name>', s_name, '</v:name></rdf:Description>'))) ELSE '<v:Other rdf:about=\"other\" v:name=\"of another graph\"/>' END, '</rdf:RDF>') AS body "
    f"FROM {_GRAPHS} JOIN supplier ON s_nationkey = nation GROUP BY nation, own, asked"
)
# Parts in the order of their addresses, twenty on a page, between what a page says of itself.
FEDERATED_PAGES = (
    "SELECT 200 + kind AS source_id, url, concat('@prefix hydra: <" + HYDRA + "> .\n@prefix v: <" + V + "> .\n<', url, '> a hydra:PagedCollection ; "
    "hydra:totalItems ', max(total), ' ; hydra:itemsPerPage 20 .\n', concat_ws('\n', collect_list(concat('<', s, '> v:name \"', p_name, '\" .')))) AS body FROM ("
    "SELECT *, floor((n - 1) / 20) AS page, CASE WHEN first THEN concat('http://ldf.example.org/parts/', kind) ELSE "
    "concat('http://ldf.example.org/parts/', kind, '?page=', cast(floor((n - 1) / 20) as int)) END AS url FROM ("
    "SELECT *, row_number() OVER (PARTITION BY kind ORDER BY s) AS n, count(*) OVER (PARTITION BY kind) AS total FROM ("
    f"SELECT p_size % 3 AS kind, concat('{NS}part/', p_partkey) AS s, p_name FROM part)) JOIN (VALUES (true), (false)) f(first) ON NOT first OR n <= 20"
    ") GROUP BY kind, url"
)

# One Turtle document per order, with both directive forms and all list marks.
TURTLE = (
    "SELECT cast(o_orderkey as string) AS doc, concat('@prefix v: <http://ex.org/v#> .\n"
    "PREFIX xsd: <http://www.w3.org/2001/XMLSchema#> # types\n@base <http://ex.org/orders/> .\n<', o_orderkey, "
    "'> v:status \"', o_orderstatus, '\" ; v:priority \"\"\"', o_orderpriority, '\"\"\" ;\n  v:customer "
    "<http://ex.org/customer/', o_custkey, '> , [ v:key ', o_custkey, ' ] .\n<', o_orderkey, '> a v:Order ; v:date \"', "
    "cast(cast(o_orderdate as date) as string), '\"^^xsd:date .\n') AS body FROM orders"
)

# One RDF/XML document per customer; BUILDING customers are answered by an error text.
RDFXML = (
    "SELECT cast(c_custkey as string) AS source_id, CASE WHEN c_mktsegment = 'BUILDING' "
    "THEN concat('no graph for ', c_name) ELSE concat("
    "'<?xml version=\"1.0\"?>\n<rdf:RDF xmlns:rdf=\"http://www.w3.org/1999/02/22-rdf-syntax-ns#\" "
    "xmlns:v=\"http://ex.org/v#\">\n<v:Customer rdf:about=\"http://ex.org/customer/', c_custkey, "
    "'\" v:segment=\"', c_mktsegment, '\">\n<v:name xml:lang=\"en\">', c_name, '</v:name>\n"
    "<v:nation rdf:resource=\"http://ex.org/nation/', c_nationkey, '\"/>\n<v:account><rdf:Description>"
    "<v:balance rdf:datatype=\"http://www.w3.org/2001/XMLSchema#integer\">', "
    "cast(round(c_acctbal * 100) as bigint), '</v:balance></rdf:Description></v:account>\n"
    "</v:Customer>\n</rdf:RDF>') END AS body FROM customer"
)

# Answers whose statistics are described: one per customer, page size and offset
# vary so that first, middle, last and only pages all occur.
RESULTS = (
    f"SELECT c_custkey AS result_id, '{ROOT}' AS root, "
    "CASE WHEN c_nationkey < 12 THEN 'all' ELSE concat('customer/', c_custkey) END AS path, "
    "CASE WHEN c_nationkey < 6 THEN concat('object=a#', c_custkey, '&limit=4&&Subject=x=y') "
    "WHEN c_nationkey < 18 THEN 'limit=4' ELSE '' END AS query_string, "
    "cast(4 as bigint) AS \"limit\", cast(4 * floor(n / 8) as bigint) AS \"offset\", "
    f"cast(n as bigint) AS total FROM {_COUNTS}"
)


def frame(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run one of the SELECTs above over the Parquet tables."""
    for name in ("region", "nation", "customer", "supplier", "part", "orders"):
        if re.search(rf"(FROM|JOIN) {name}\b", sql):
            spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)
    return spark.sql(sql.replace('"', "`") if "AS \"" in sql else sql)
