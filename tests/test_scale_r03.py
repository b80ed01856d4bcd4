"""What a step costs must follow its input: plans and batches of the larger queries."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rdfweave import model as M
from rdfweave.model import Pattern, Term
from rdfweave.operators import resources
from rdfweave.operators.stage import stage
from rdfweave.plans import load
from rdfweave.sources import ntriples, ranks, rdfxml, store, turtle

DOCUMENT = '@prefix v: <http://ex.org/v#> . @base <http://ex.org/> .\n<a> v:p "x"@en , [ v:q (1 <b>) ] .'


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("read", [turtle.read, turtle.rejects])
def test_turtle_tokens_are_no_rows(spark, read):
    docs = spark.createDataFrame([("1", DOCUMENT)], "doc string, body string")
    text = plan(read(docs, "body", "doc"))
    assert "Window" not in text and "Generate" not in text and "Join" not in text
    assert text.count("Exchange hashpartitioning") == 1


def test_turtle_documents_that_come_twice(spark):
    docs = spark.createDataFrame([("1", DOCUMENT)] * 2 + [("2", DOCUMENT), ("3", None), ("4", "")], "doc string, body string")
    rows = turtle.read(docs, "body", "doc").collect()
    assert {r["reason"] for r in rows} == {None}
    assert {d: sum(r["doc"] == d for r in rows) for d in "1234"} == {"1": 14, "2": 7, "3": 0, "4": 0}
    objects = {r["o"] for r in rows if r["doc"] == "2"}
    assert {"x", "1", "http://ex.org/b"} <= objects


def test_rdfxml_documents_are_dealt_and_written_together(spark):
    body = '<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:v="http://ex.org/v#"><rdf:Description rdf:about="http://ex.org/{}"><v:p>x</v:p></rdf:Description></rdf:RDF>'
    docs = spark.createDataFrame([(str(n), body.format(n) if n % 3 else "<no") for n in range(30)], "doc string, body string").coalesce(1)
    rows = rdfxml.read(docs, "body", "doc")
    assert rows.rdd.getNumPartitions() > 1 and rdfxml.rejects(docs, "body").rdd.getNumPartitions() > 1
    found = rows.collect()
    assert {r["doc"] for r in found if r["reason"] is None} == {str(n) for n in range(30) if n % 3}
    assert {r["doc"] for r in found if r["reason"]} == {str(n) for n in range(0, 30, 3)}
    batch = pa.RecordBatch.from_pylist([{"doc": str(n), "body": body.format(n), "_start": None} for n in range(20)], pa.schema([(c, pa.string()) for c in ("doc", "body", "_start")]))
    assert [b.num_rows for b in rdfxml._reader(["doc", "body", "_start"], "body", "_start")(iter([batch]))] == [20]


@pytest.mark.parametrize("parts", [1, 3])
def test_subjects_are_shuffled_once(spark, parts):
    data = spark.createDataFrame([("http://ex.org/a", "uri", "http://ex.org/p", "x", "literal", None, None)] * 3, ", ".join(f"{c} string" for c in M.TERMS))
    for made in (resources.turtle_blocks(data, parts), resources.resource_map(data, parts)):
        assert plan(made).count("Exchange hashpartitioning") == 1
        assert made.count() == 1


def test_ranks_are_found_without_a_sort(spark, tmp_path, monkeypatch):
    rows = [(0, f"http://ex.org/{n:03}", "uri", "http://ex.org/p", str(n), "literal", None, None, "", "local") for n in range(60)]
    data = spark.createDataFrame(rows, store.PUBLISHED_SCHEMA)
    store._publish(data, f"{tmp_path}/t", ["source_key", "p", *ranks.WITHIN], "s")
    merged = []
    monkeypatch.setattr(ranks, "stage", lambda df, name: merged.append(plan(df)) or stage(df, name))
    ranks.write(spark, f"{tmp_path}/t", store.published(spark, f"{tmp_path}/t"))
    assert merged and "Sort" not in merged[0]
    page, total = store.ranked_page(spark, f"{tmp_path}/t", Pattern(p=Term.iri("http://ex.org/p")), 7, 41)
    assert total == 60 and [r["s"] for r in page.collect()] == [f"http://ex.org/{n:03}" for n in range(41, 48)]


def test_copies_are_merged_in_tasks_of_their_own(spark):
    text = plan(store._laid_out(spark.createDataFrame([], M.STATEMENTS_SCHEMA), ordered=False))
    assert text.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in text


def test_statements_are_dealt_once_and_long_ones_spread(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "TASK_BYTES", 1 << 10, raising=False)
    text = "".join(chr(97 + n * n % 26) for n in range(2000))
    rows = [(f"http://ex.org/{n:02}", "uri", "http://ex.org/p", f"{n}{text}{end}", "literal", None, "en", "g", 1, "turtle") for n in range(40) for end in "ab"]
    data = spark.createDataFrame(rows * 2 + [(*rows[0][:5], "http://ex.org/d", None, *rows[0][7:])], M.STATEMENTS_SCHEMA)
    text = plan(store._laid_out(data, ordered=True))
    assert text.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in text
    store.replace(data, f"{tmp_path}/s", ["g"])
    found = store.read(spark, f"{tmp_path}/s")
    assert len(found.inputFiles()) > spark.sparkContext.defaultParallelism
    assert sorted((r["s"], r["o"]) for r in found.collect()) == sorted([(r[0], r[3]) for r in [*rows, rows[0]]])
    for file in found.inputFiles():
        part = pq.ParquetFile(file.removeprefix("file://")).read(["s", "o"]).to_pylist()
        assert [(r["s"], r["o"]) for r in part] == sorted((r["s"], r["o"]) for r in part)


def test_lines_are_parsed_once_for_statements_and_rejects(spark, tmp_path, monkeypatch):
    lines = [
        '<http://ex.org/a> <http://ex.org/p> "x\\n"@en . # end', "_:n <http://ex.org/p> _:m .", "", "  # note", "no statement",
        '"x" <http://ex.org/p> <http://ex.org/a> .', "<a b> <c> <d> .", '<http://ex.org/a> <http://ex.org/p> "x\\n"@en .',
        '<http://ex.org/a> <http://ex.org/q> "4"^^<http://www.w3.org/2001/XMLSchema#integer> .', "no statement",
    ]
    data = spark.createDataFrame([(x, 1) for x in lines] + [(None, 1)], "value string, source_id int")
    rows = ntriples.read(data, F.lit("7"))
    good, bad = rows.filter("reason IS NULL"), rows.filter("reason IS NOT NULL")
    terms = [*M.TERMS, "source_id"]
    assert sorted(map(str, good.select(terms).collect())) == sorted(map(str, ntriples.parse(data, F.lit("7")).select(terms).collect()))
    assert good.filter("value IS NOT NULL").isEmpty()
    wrong = ["value", "reason", "source_id"]
    assert sorted(map(str, bad.select(wrong).collect())) == sorted(map(str, ntriples.rejects(data).select(wrong).collect()))
    (tmp_path / "a.nt").write_text("\n".join(lines[:-1]))
    staged = []
    monkeypatch.setattr(load, "stage", lambda df, name: staged.append(name) or stage(df, name))
    sources = spark.createDataFrame([(1, "turtle", f"{tmp_path}/a.nt")], "id int, type string, uri string")
    statements, rejects, _ = load.read_sources(spark, sources)
    assert "documents" not in staged and staged.count("read") == 1
    assert statements.count() == 4 and rejects.count() == 3
    assert "RegExpReplace" not in plan(statements) and "regexp_replace" not in plan(rejects)
