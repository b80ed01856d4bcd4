"""Fragment pages at scale: texts reach their reader as they are, and few passes follow over the statements."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rdfweave import model as M
from rdfweave.functions import text
from rdfweave.operators import fragments, scale
from rdfweave.operators.scale import skew_join
from rdfweave.operators.stage import stage
from rdfweave.sources import turtle, turtle_structure

START = "http://ldf.example.org/orders"
ODD = [
    "plain", "", "\\t\\n\\\"\\'\\\\", "\\u00e9\\U0001F600\\uD83D\\uDE00", "\\uD800 \\uDC00x", "a\\q\\😀", "\\\\u0041", "\\U00110000\\U0000D800",
    "\\uFEFF\\uFFFE\\u0000", "\\", "\\u12", "\\U000000e9",
]
IRIS = ["http://a/b", "x", "../y/./z", "#f", "?q=1", "", "//h/p", "/r/../s", "urn:x:y", "..", ".", "x?y#z/../w", "?", "./?a/..", "é"]
BASES = [None, "http://s.org/d/e.ttl?x=1#y", "http://s.org", "foo/bar", "", "urn:a:b", "/p/q", "a#b", "http://s.org/a/../b/"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_turtle_texts_reach_the_reader_as_they_are(spark):
    docs = spark.createDataFrame([("1", "<a> <b> <c> .")], "doc string, body string")
    made = plan(turtle.read(docs, "body", "doc"))
    assert "regexp" not in made and "lambda" not in made


def test_values_in_the_reader_are_those_of_columns(spark):
    rows = spark.createDataFrame([(x,) for x in ODD], "x string").select("x", text.unescape(F.col("x")).alias("y")).collect()
    assert {r["x"]: r["y"] for r in rows} == {x: turtle_structure.unescaped(x) for x in ODD}
    pairs = [(iri, base) for iri in IRIS for base in BASES]
    rows = spark.createDataFrame(pairs, "iri string, base string").select("iri", "base", turtle.resolve_iri(F.col("iri"), F.col("base")).alias("y")).collect()
    want = {(r["iri"], r["base"]): r["y"] for r in rows}
    assert want == {pair: turtle_structure.resolved(*pair) for pair in pairs}
    columns = (pa.array(x, pa.string()) for x in zip(*pairs, strict=True))
    assert want == dict(zip(pairs, turtle_structure._all_resolved(*columns).to_pylist(), strict=True))


@pytest.mark.parametrize("tokens", [3, 1 << 17])
def test_long_documents_and_small_slices_give_the_same_rows(monkeypatch, tokens):
    bodies = ['@prefix v: <http://ex.org/v#> . <a> v:p "é"@en , [ v:q ( 1 <b> ) ] , """l\nm""" .', None, "", "<a> <b> !", "<a> v:p 1 .", "²x:a <b> <c> ."]
    names = [str(i) for i in range(len(bodies))]
    batch = pa.RecordBatch.from_pydict({c: pa.array(x, pa.string()) for c, x in {"_body": bodies, "_scope": names, "_doc": names, "_start": [START] * len(names)}.items()})

    def rows(size: int) -> list:
        monkeypatch.setattr(turtle_structure, "TEXT_BYTES", size)
        return sorted((str(r) for b in turtle_structure.reader(["_doc"], False)(iter([batch])) for r in b.to_pylist()))

    want = rows(1 << 26)
    assert len(want) == 11 and sum("unreadable" in r for r in want) == 2
    monkeypatch.setattr(turtle_structure, "TOKENS", tokens)
    assert rows(1 << 26) == want and rows(16) == want


@pytest.mark.parametrize("large", [False, True])
def test_metadata_is_found_in_one_scan(spark, monkeypatch, large):
    monkeypatch.setattr(scale, "is_large", lambda df, limit=None: large)
    page, other, dataset = f"{START}?page=1", f"{START}?page=2", f"{START}#dataset"
    search, mapping, paged = M.HYDRA + "search", M.HYDRA + "mapping", M.HYDRA + "PagedCollection"
    keep = [
        (page, START, "http://a", M.RDF_TYPE, "http://T", M.IRI), (page, START, "_:n", mapping, "_:free", M.BNODE), (page, START, "_:free", "v:p", "x", M.LITERAL),
        (other, START, "_:s", "v:p", "x", M.LITERAL), (other, START, "_:s", mapping, "_:m", M.BNODE), (page, START, "_:l", "v:p", "x", M.LITERAL),
        (None, START, "http://n", M.RDF_TYPE, paged, M.IRI), (None, START, "_:q", mapping, "_:r", M.BNODE),
    ]
    gone = [
        (page, START, page, M.RDF_TYPE, paged, M.IRI), (page, START, page, "v:p", "x", M.LITERAL), (page, START, dataset, search, "_:s", M.BNODE),
        (page, START, dataset, search, "_:t", M.BNODE), (page, START, "_:s", mapping, "_:m", M.BNODE), (page, START, "_:s", mapping, "_:l", M.LITERAL),
        (page, START, "_:m", "v:p", "x", M.LITERAL), (page, None, "http://x", "v:p", "x", M.LITERAL), (None, START, dataset, search, "_:q", M.BNODE),
    ]
    rows = stage(spark.createDataFrame((keep + gone) * 2, "url string, startfragment string, s string, p string, o string, o_kind string"))
    found = fragments.metadata_subjects(rows)
    assert plan(found).count("FileScan") == 1
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, [(page, page), (page, "_:s"), (page, "_:t"), (page, "_:m"), (None, "http://n"), (None, "_:q")]))
    assert sorted(map(str, map(tuple, fragments.strip_metadata(rows).select(*rows.columns).collect()))) == sorted(map(str, keep * 2))


def test_a_join_without_hot_keys_is_a_plain_one(spark):
    left = spark.createDataFrame([(f"k{i % 50}", i) for i in range(500)], "k string, v int")
    right = spark.createDataFrame([(f"k{i}", i) for i in range(40)], "k string, w int")
    plain = skew_join(left, right, ["k"], "left_anti", large=True, slice_rows=10**6)
    assert "_slice" not in plan(plain) and plain.count() == 100
    assert "_slice" in plan(skew_join(left, right, ["k"], "left_anti", large=True, slice_rows=5))
