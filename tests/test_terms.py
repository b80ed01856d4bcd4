import pytest
from pyspark.sql import functions as F

from rdfweave import model as M
from rdfweave.functions import uri as U
from rdfweave.model import Pattern, Term, pattern_from_parameters
from rdfweave.operators import describe, match, resolve
from tests.frames import N, statements


def test_parameters():
    assert pattern_from_parameters() == Pattern()
    assert pattern_from_parameters("?s", "?p", "?o") == Pattern()
    assert pattern_from_parameters(object="http://a").o == Term.iri("http://a")
    assert pattern_from_parameters(object="<http://a>").o == Term.iri("http://a")
    assert pattern_from_parameters(object='"x"').o == Term.text("x")
    assert pattern_from_parameters(object="x@en").o == Term.text("x@en")
    assert pattern_from_parameters(object="42").o != Term.number(42)
    assert pattern_from_parameters("<http://a>", "http://b") == Pattern(Term.iri("http://a"), Term.iri("http://b"))


def count(data, pattern, **kw):
    return match.match(data, pattern, **kw).count()


def test_terms_differ_by_kind_datatype_and_language(spark):
    rows = [("a", "p", '"42"'), ("a", "p", '"42"^^int'), ("a", "p", '"42"@en'), ("a", "p", "42")]
    data = match.default_graphs(statements(spark, rows))
    for term in (Term.text("42"), Term.number(42), Term.text("42", "en"), Term.iri(N + "42")):
        assert count(data, Pattern(o=term)) == 1


def test_hash_variants(spark):
    rows = [(s, "p", '"x"') for s in ("bar", "bar#a", "BAR#B", "barn", "bar/x", "bxr")] + [("_:bar", "p", '"x"')]
    data = match.default_graphs(statements(spark, rows))
    exact = Pattern(s=Term.iri(N + "bar"))
    hashed = Pattern(s=Term.iri(N + "Bar"), hash_variants=True)
    assert count(data, exact) == 1
    assert count(data, hashed) == 3
    assert count(data.withColumn("s_base", match.subject_base(F.col("s"))), hashed) == 3
    assert count(data, Pattern(s=Term.iri(N + "b.r"), hash_variants=True)) == 0
    assert count(data, Pattern(s=Term.iri(N + "b.r"), hash_variants=True), unescaped=True) == 4
    assert count(data, Pattern(s=Term.iri(N + "bar#a"), hash_variants=True)) == 1
    assert Pattern(hash_variants=True).by_hash is False


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    statements(spark, [("a", "p", "b")]).write.partitionBy("graph").parquet(path)
    stored = spark.read.schema(M.STATEMENTS_SCHEMA).parquet(path)
    one = match.default_graphs(stored, graph=N + "graph/1")
    plan = match.match(one, Pattern(s=Term.iri(N + "a"), p=Term.iri(N + "p")))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(s,http://ex.org/a)" in plan and "EqualTo(p,http://ex.org/p)" in plan
    assert "PartitionFilters: [isnotnull(graph" in plan


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def lit(text):
    return F.lit(text)


def test_raw_request_uri(spark):
    query = "offset=7&object=oak%20tree&predicate=https%3A%2F%2Fex.org%2Fvocab%23height&limit=3"
    got = value(spark, U.raw_request_uri(lit("https://ex.org/parks/north"), lit(query)))
    assert got == "https://ex.org/parks/north?" + query
    assert value(spark, U.raw_request_uri(lit("http://h/a#b"), lit(""))) == "http://h/a%23b"
    assert value(spark, U.raw_request_uri(lit("http://h"), lit("&&x&0&a=b=c&"))) == "http://h?x&a=b=c"
    assert value(spark, U.raw_request_uri(lit("http://h"), lit(None).cast("string"))) == "http://h"


@pytest.mark.parametrize(
    "uri, ext, rest",
    [
        ("a/b.json", "json", "a/b"),
        ("a/b.JSON", "JSON", "a/b"),
        ("parks/north.gate", None, "parks/north.gate"),
        (".json", None, ".json"),
        ("plain", None, "plain"),
        ("a.json/b", None, "a.json/b"),
    ],
)
def test_extension(spark, uri, ext, rest):
    assert value(spark, U.extension(lit(uri))) == ext
    assert value(spark, U.without_extension(lit(uri))) == rest


@pytest.mark.parametrize(
    "path, route",
    [
        ("all", "pattern"), ("all.ttl", "pattern"), ("allfoo", "dereference"), ("api/triples", "source"),
        ("api/triples/12", "source"), ("api/info", None), ("discovery", None), ("x/y", "dereference"), ("", None),
    ],
)
def test_route(spark, path, route):
    assert value(spark, U.route(lit(path))) == route


def test_rewrite(spark):
    query, subject = lit("page=1&Subject=x&limit=2"), lit("http://s")
    assert value(spark, U.count_fragment(lit("http://f"), query, subject)) == "http://f?Subject=http://s&limit=2"
    assert value(spark, U.count_fragment(lit("http://f"), lit(""), subject)) == "http://f?subject=http://s"
    none = lit(None).cast("string")
    assert value(spark, U.count_fragment(lit("http://f"), lit("page=1"), none)) == "http://f"
    assert value(spark, U.fetch_fragment(lit("http://f"), query)) == "http://f?Subject=x"
    assert value(spark, U.fragment_subject(lit("http://h"), lit("All.json"))) is None
    assert value(spark, U.fragment_subject(lit("http://h"), lit("a/b"))) == "http://h/a/b"


def test_encode_and_fingerprint(spark):
    assert value(spark, U.percent_encode(lit("a b+*~é"))) == "a%20b%2B%2A%7E%C3%A9"
    assert value(spark, U.query_fingerprint(lit(3), lit("q"))) == value(spark, F.sha1(lit("sparql_3_q")))
    assert value(spark, U.trim_end(lit("http://h//"), "/")) == "http://h"


@pytest.mark.parametrize(
    "limit, offset, total, links, n",
    [
        (10, 0, 25, {"first": 0, "next": 10, "last": 20}, 25),
        (10, 10, 25, {"first": 0, "next": 20, "last": 20, "previous": 0}, 26),
        (10, 20, 25, {"first": 0, "previous": 10}, 24),
        (100, 0, 25, {"first": 0}, 23),
        (10, 5, 25, {"first": 0, "next": 15, "last": 20, "previous": 0}, 26),
        (0, 0, 25, {"first": 0}, 23),
    ],
)
def test_description(spark, limit, offset, total, links, n):
    row = [(1, "http://h", "all", "subject=http://a#b&limit=3", limit, offset, total)]
    results = spark.createDataFrame(row, "result_id int, root string, path string, query_string string, limit long, offset long, total long")
    got = describe.describe(results).collect()
    assert len(got) == n
    base = f"http://h/all?subject=http://a%23b&limit={limit}&offset="
    pages = {r["p"].split("#")[1][:-4]: r["o"] for r in got if r["p"].endswith("Page") and r["o_kind"] == "uri"}
    assert pages == {name: f"{base}{o}" for name, o in links.items()}


def test_dereferenced_description_address(spark):
    uri = describe.result_uri(lit("http://h"), lit("a/b"), lit("x=1"))
    assert value(spark, uri) == "http://h/a/b?x=1#dataset"


def test_resolution_order(spark):
    requests = spark.createDataFrame(
        [(i, "http://ex.org", p, "") for i, p in enumerate(["c/d", "c", "info/x", "s.json", "t.v1", "none", "cc"])],
        "request_id long, root string, path string, query_string string",
    )
    definitions = spark.createDataFrame([("c/", "d"), ("c/e/f", "g")], "collection_uri string, resource_name string")
    core = spark.createDataFrame([("info",)], "name string")
    data = match.default_graphs(statements(spark, [("s", "p", "o"), ("t.v1", "p", "o"), ("c", "p", "o"), ("info/x", "p", "o")]))
    resolved = resolve.resolve(requests, definitions, core, data).cache()
    got = {r["path"]: r["resolution"] for r in resolved.collect()}
    assert got == {
        "c/d": "dataset", "c": "collection", "info/x": "core", "s.json": "statements", "t.v1": "statements", "none": None, "cc": None,
    }
    listing = {(r["kind"], r["uri"]) for r in resolve.list_collections(resolved, definitions).collect()}
    assert listing == {("dataset", "http://ex.org/c/d"), ("collection", "http://ex.org/c/e/f")}
    hits = resolved.filter(F.col("resolution").isNotNull())
    assert {r["path"] for r in resolve.unresolved(requests, hits).collect()} == {"none", "cc"}
    assert {r["path"]: r["found"] for r in resolve.with_found(requests, hits).collect()}["none"] is False
