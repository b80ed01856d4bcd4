"""Test tables as statements.

The test tables hold no RDF, so queries, tests and the benchmark lift whole
tables into the statements layout.  Each lift is one SELECT whose expressions read
the same in Spark and DuckDB, so both engines start from equal statements.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

NS = "http://ex.org/"
V = NS + "v#"
XSD = "http://www.w3.org/2001/XMLSchema#"


@dataclass(frozen=True)
class Lift:
    source_id: int
    source_type: str
    table: str
    s: str
    p: str
    o: str
    o_kind: str = "literal"
    o_datatype: str | None = None
    o_lang: str | None = None
    s_kind: str = "uri"

    def columns(self) -> list[str]:
        def text(value: str | None) -> str:
            return "cast(null as string)" if value is None else f"'{value}'"

        return [
            f"{self.s} AS s",
            f"'{self.s_kind}' AS s_kind",
            f"'{V}{self.p}' AS p",
            f"{self.o} AS o",
            f"'{self.o_kind}' AS o_kind",
            f"{text(self.o_datatype)} AS o_datatype",
            f"{self.o_lang or 'cast(null as string)'} AS o_lang",
            f"'{graph(self.source_id)}' AS graph",
            f"{self.source_id} AS source_id",
            f"'{self.source_type}' AS source_type",
        ]


def graph(source_id: int) -> str:
    return f"{NS}graph/{source_id}"


def iri(name: str, key: str) -> str:
    return f"concat('{NS}{name}/', cast({key} as string))"


def bnode(source_id: int, name: str, key: str) -> str:
    return f"concat('_:s{source_id}.{name}', cast({key} as string))"


def cents(column: str) -> str:
    return f"cast(cast(round({column} * 100) as bigint) as string)"


def nations(source_id: int, source_type: str) -> list[Lift]:
    nation = iri("nation", "n_nationkey")
    return [
        Lift(source_id, source_type, "nation", nation, "name", "n_name"),
        Lift(source_id, source_type, "nation", nation, "region", iri("region", "n_regionkey"), "uri"),
    ]


def account(source_id: int, source_type: str, table: str, key: str, balance: str) -> list[Lift]:
    """A blank node per row, with equal labels in different sources before scoping."""
    node = bnode(source_id, "b", key)
    return [
        Lift(source_id, source_type, table, iri(table, key), "account", node, "bnode"),
        Lift(
            source_id, source_type, table, node, "balance", cents(balance),
            o_datatype=XSD + "integer", s_kind="bnode",
        ),
    ]


REGION = iri("region", "r_regionkey")
CUSTOMER = iri("customer", "c_custkey")
SUPPLIER = iri("supplier", "s_suppkey")
PART = iri("part", "p_partkey")
ORDER = iri("orders", "o_orderkey")

# Sources 1 and 2 are loaded files (one default graph), 3 and 4 endpoints, 5 a
# fragment server.  Nations stand in sources 1, 2 and 3: copies inside the local
# graph and across sources.  Regions link back to nations: cycles.
SOURCES: list[Lift] = [
    *nations(1, "turtle"),
    Lift(1, "turtle", "region", REGION, "name", "r_name"),
    Lift(1, "turtle", "nation", iri("region", "n_regionkey"), "nation", iri("nation", "n_nationkey"), "uri"),
    Lift(2, "rdf", "customer", CUSTOMER, "name", "c_name"),
    Lift(2, "rdf", "customer", CUSTOMER, "segment", "c_mktsegment"),
    Lift(2, "rdf", "customer", CUSTOMER, "nation", iri("nation", "c_nationkey"), "uri"),
    *account(2, "rdf", "customer", "c_custkey", "c_acctbal"),
    *nations(2, "rdf"),
    Lift(3, "sparql", "supplier", SUPPLIER, "name", "s_name"),
    Lift(3, "sparql", "supplier", SUPPLIER, "nation", iri("nation", "s_nationkey"), "uri"),
    *account(3, "sparql", "supplier", "s_suppkey", "s_acctbal"),
    *nations(3, "sparql"),
    Lift(4, "sparql", "part", PART, "name", "p_name"),
    Lift(4, "sparql", "part", PART, "brand", "p_brand"),
    Lift(4, "sparql", "part", PART, "type", "p_type"),
    Lift(4, "sparql", "part", PART, "size", "cast(p_size as string)", o_datatype=XSD + "integer"),
    Lift(5, "ldf", "orders", ORDER, "status", "o_orderstatus"),
    Lift(5, "ldf", "orders", ORDER, "priority", "o_orderpriority"),
    Lift(
        5, "ldf", "orders", ORDER, "date", "cast(cast(o_orderdate as date) as string)",
        o_datatype=XSD + "date",
    ),
    Lift(5, "ldf", "orders", ORDER, "customer", iri("customer", "o_custkey"), "uri"),
]

# Depth of each source when a URI is dereferenced.
DEPTHS = [("local", 3), ("sparql:3", 2), ("sparql:4", 3), ("ldf:5", 1)]

# Web addresses as subjects, and long multilingual texts as language literals.
PAGES = [Lift(6, "turtle", "pages", "url", "page", "cast(page_id as string)", o_datatype=XSD + "integer")]
DOCUMENTS = [Lift(7, "turtle", "documents", iri("doc", "doc_id"), "text", "text", o_lang="lang")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lift(spark: SparkSession, sf_dir: str, lifts: list[Lift] = SOURCES) -> DataFrame:
    tables = {name: table(spark, sf_dir, name) for name in {one.table for one in lifts}}
    return spark.sql(lift_sql(lifts, "{{{}}}"), **tables)


def lift_sql(lifts: list[Lift] = SOURCES, name: str = "{}") -> str:
    return "\nUNION ALL ".join(
        f"SELECT {', '.join(one.columns())} FROM {name.format(one.table)}" for one in lifts
    )
