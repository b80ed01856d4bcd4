import json
import os

import pytest
from pyspark.sql import functions as F

from rdfweave import model as M
from rdfweave.functions import text
from rdfweave.operators import fragments, resources, stage
from rdfweave.plans import load
from rdfweave.sources import answers, catalog, ntriples, rdfxml, rdfxml_events, rdfxml_syntax, store, turtle, turtle_syntax
from tests.frames import N, statements


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "written, decoded",
    [
        (r"caf\u00e9", "café"),
        (r"\uD83D\uDE00", "😀"),
        (r"\U0001F600", "😀"),
        (r"\\u00e9", r"\\u00e9"),
        (r"lone \ud800 x", r"lone \ud800 x"),
        (r"\u00g9", r"\u00g9"),
        ("tail\\", "tail\\"),
        ("none", "none"),
    ],
)
def test_decode_unicode(spark, written, decoded):
    assert value(spark, text.decode_unicode(F.lit(written))) == decoded


def test_unescape_is_the_inverse_of_escape(spark):
    odd = "a\"b\\c\nd\re\tf\bg\fh'é😀\\u0041 \\n"
    assert value(spark, text.unescape(text.escape_literal(F.lit(odd)))) == odd


def test_very_long_texts(spark):
    long = 'x\\n"' * 100_000
    written = text.escape_literal(F.lit(long))
    assert value(spark, F.length(text.unescape(written))) == len(long)
    line = '<a:b> <a:c> "' + "\\u00e9\\n" * 100_000 + '" .'
    (row,) = ntriples.parse(spark.createDataFrame([(line,)], "value string"), F.lit(1)).collect()
    assert row["o"] == "é\n" * 100_000


LINES = [
    ('<http://a> <http://b> "x"@en-GB .', None),
    ('<http://a> <http://b> "4"^^<http://t> . # note', None),
    ("_:b0 <http://b> _:b1 .", None),
    ('<http://a><http://b>"".', None),
    ("", None),
    ("# only a comment", None),
    ('<http://a> <http://b> "x"', "statement has no closing dot"),
    ('"s" <http://b> <http://c> .', "subject is a literal"),
    ("<http://a> <http://b c> <http://c> .", "not a statement"),
]


def test_ntriples_good_and_bad(spark):
    lines = spark.createDataFrame([(l,) for l, _ in LINES], "value string")
    assert {r["value"]: r["reason"] for r in ntriples.rejects(lines).collect()} == {
        l: reason for l, reason in LINES if reason
    }
    good = {(r["s"], r["o"], r["o_datatype"], r["o_lang"]) for r in ntriples.parse(lines, F.lit(9)).collect()}
    assert good == {
        ("http://a", "x", None, "en-GB"), ("http://a", "4", "http://t", None), ("_:s9.b0", "_:s9.b1", None, None),
        ("http://a", "", None, None),
    }


def test_turtle_document(spark):
    body = """@prefix ex: <http://ex.org/> . # c <x>
PREFIX v: <http://ex.org/v#>
ex:a a ex:T ; v:n "x ; . \\"q\\""@en , 42, -1.5, 1e3, true ;; .
_:b ex:p [ ex:q "in" ] , ( 1 [ ex:k 2 ] ( ) ) .
[ ex:only 'y' ] .
ex:l ex:t \"\"\"two
lines "quoted" \\u00e9\"\"\" .
@prefix ex: <http://other.org/> .
ex:a ex:p () .
"""
    rows = turtle.parse(spark.createDataFrame([("d", body)], "doc string, body string"), "body", "doc").collect()
    got = {(r["s"], r["p"], r["o"], r["o_datatype"] or r["o_lang"]) for r in rows}
    first, rest, nil = M.RDF + "first", M.RDF + "rest", M.RDF + "nil"
    x, v = M.XSD, "http://ex.org/v#n"
    made = sorted({r["s"] for r in rows if r["s_kind"] == "bnode"} | {r["o"] for r in rows if r["o_kind"] == "bnode"})
    nodes = [m for m in made if "node" in m]
    lists = [m for m in made if "list" in m]
    assert len(nodes) == 3 and len(lists) == 3
    inner, in_list, only = sorted(nodes, key=lambda m: int(m.rsplit("node")[-1]))
    l1, l2, l3 = sorted(lists, key=lambda m: int(m.rsplit("list")[-1]))
    assert got == {
        (N + "a", M.RDF_TYPE, N + "T", None), (N + "a", v, 'x ; . "q"', "en"), (N + "a", v, "42", x + "integer"),
        (N + "a", v, "-1.5", x + "decimal"), (N + "a", v, "1e3", x + "double"), (N + "a", v, "true", x + "boolean"),
        ("_:sd.b", N + "p", inner, None), (inner, N + "q", "in", None), ("_:sd.b", N + "p", l1, None),
        (l1, first, "1", x + "integer"), (l1, rest, l2, None), (l2, first, in_list, None), (in_list, N + "k", "2", x + "integer"),
        (l2, rest, l3, None), (l3, first, nil, None), (l3, rest, nil, None), (only, N + "only", "y", None),
        (N + "l", N + "t", 'two\nlines "quoted" é', None), ("http://other.org/a", "http://other.org/p", nil, None),
    }


def test_turtle_bad_documents(spark):
    bad = {
        "ex:a ex:b ex:c .": "unknown prefix",
        "<a> <b> <c>": "statement has no closing dot",
        "<a> <b> [ <c> <d> .": "unbalanced brackets",
        "<a> <b> !": "unreadable token",
        '<a> <b> "x"@en': "statement has no closing dot",
        "<a> <b> .": "statement has no object",
        "<a> <b> <c> ; <d> .": "statement has no object",
        "<a> .": "statement has no object",
        '"s" <b> <c> .': "subject is a literal",
        "<a> _:b <c> .": "predicate is no IRI",
    }
    docs = spark.createDataFrame([(str(i), b) for i, b in enumerate(bad)], "doc string, body string")
    assert {r["value"]: r["reason"] for r in turtle.rejects(docs, "body", "doc").collect()} == bad
    assert turtle.parse(docs, "body", "doc").count() == 0


def test_blank_nodes_are_scoped_by_document(spark):
    docs = spark.createDataFrame([("1", "_:b0 <x:p> 1 ."), ("2", "_:b0 <x:p> 1 .")], "doc string, body string")
    assert {r["s"] for r in turtle.parse(docs, "body", "doc").collect()} == {"_:s1.b0", "_:s2.b0"}


XML = """<?xml version="1.0"?>
<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:v="http://ex.org/" xml:base="http://ex.org/doc">
<rdf:Description rdf:about="http://ex.org/a"><v:name xml:lang="fr">é &amp; b</v:name><v:to rdf:resource="#frag"/>
<v:n rdf:datatype="http://www.w3.org/2001/XMLSchema#integer">4</v:n></rdf:Description>
<v:T rdf:nodeID="n1" v:attr="x"><v:in rdf:parseType="Resource"><v:k>1</v:k></v:in>
<v:list rdf:parseType="Collection"><rdf:Description rdf:about="http://ex.org/i"/></v:list></v:T>
<rdf:Bag rdf:about="http://ex.org/bag"><rdf:li>one</rdf:li><rdf:li>two</rdf:li></rdf:Bag>
</rdf:RDF>"""


def test_rdfxml(spark):
    docs = spark.createDataFrame([("d", XML), ("e", "<broken"), ("f", "no markup")], "doc string, body string")
    got = {(r["s"], r["p"], r["o"], r["o_datatype"] or r["o_lang"]) for r in rdfxml.parse(docs, "body", "doc").collect()}
    node, res, cell = "_:sd.n1", "_:sd.d.-node1", "_:sd.d.-node2"
    assert got == {
        (N + "a", N + "name", "é & b", "fr"), (N + "a", N + "to", N + "doc#frag", None), (N + "a", N + "n", "4", M.XSD_INTEGER),
        (node, M.RDF_TYPE, N + "T", None), (node, N + "attr", "x", None), (node, N + "in", res, None), (res, N + "k", "1", None),
        (node, N + "list", cell, None), (cell, M.RDF + "first", N + "i", None), (cell, M.RDF + "rest", M.RDF + "nil", None),
        (N + "bag", M.RDF_TYPE, M.RDF + "Bag", None), (N + "bag", M.RDF + "_1", "one", None), (N + "bag", M.RDF + "_2", "two", None),
    }
    assert {r["doc"] for r in rdfxml.rejects(docs, "body").collect()} == {"e", "f"}


def test_count_answers(spark):
    good = json.dumps({"results": {"bindings": [{"count": {"value": "12"}}]}})
    rows = [(1, good), (2, ""), (3, "no json"), (4, good.replace("12", "many"))]
    got = answers.counts(spark.createDataFrame(rows, "source_id int, body string")).collect()
    assert [tuple(r) for r in got] == [(1, 12)]


def rows_of(df):
    return sorted(map(tuple, df.select(*M.TERMS).collect()), key=str)


SAMPLE = [("a", "p", '"x . y"'), ("a", "p", '"2"^^int'), ("a", "q", "_:n"), ("_:n", "p", '"é"@fr'), ("b", "p", "a")]


def test_turtle_blocks_read_back(spark, tmp_path):
    data = statements(spark, [*SAMPLE, *[("hot", "p", f'"{i}"') for i in range(200)]])
    blocks = resources.turtle_blocks(data, parts=4)
    assert blocks.filter(F.col("s") == N + "hot").count() > 1
    docs = blocks.select(F.concat_ws("-", F.sha1("s"), "part").alias("doc"), "value")
    back = turtle.parse(docs, "value", "doc", scope=F.lit(0)).withColumn("s", F.regexp_replace("s", "^_:s0.", "_:")).withColumn("o", F.regexp_replace("o", "^_:s0.", "_:"))
    assert rows_of(back) == rows_of(data)


@pytest.mark.parametrize("size", [2, 3000])
def test_resource_map_has_one_shape_at_any_size(spark, size):
    data = statements(spark, [("hot", "p", f'"{i}"') for i in range(size)] + SAMPLE)
    whole = {r["s"]: r["properties"] for r in resources.resource_map(data).collect()}
    assert len(whole) == 4 and len(whole[N + "hot"][N + "p"]) == size
    assert [o["value"] for o in whole[N + "a"][N + "p"]] == ["2", "x . y"]
    hot = resources.resource_map(data, parts=5).filter(F.col("s") == N + "hot").collect()
    assert sorted(o["value"] for r in hot for o in r["properties"][N + "p"]) == sorted(str(i) for i in range(size))


def test_json_sink(spark, tmp_path):
    path = str(tmp_path / "json")
    resources.write_json(statements(spark, SAMPLE), path)
    back = spark.read.json(path)
    assert back.count() == 3


def graph_counts(spark, path):
    return {r["graph"][-1]: r["count"] for r in store.read(spark, path).groupBy("graph").count().collect()}


def test_store_replace_and_clear(spark, tmp_path):
    path = str(tmp_path / "store")
    both = statements(spark, [("a", "p", f'"{i}"', n, "turtle") for n in (1, 2) for i in range(5)] + [("a", "p", '"0"', 1, "turtle")])
    store.append(both, path)
    assert graph_counts(spark, path) == {"1": 5, "2": 5}
    store.replace(statements(spark, [("b", "p", '"x"', 2, "turtle")]), path, [N + "graph/2"])
    assert graph_counts(spark, path) == {"1": 5, "2": 1}
    store.replace(statements(spark, []), path, [N + "graph/2"])
    assert graph_counts(spark, path) == {"1": 5}
    store.clear(spark, path, N + "graph/1")
    assert graph_counts(spark, path) == {}


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "store")
    store.append(statements(spark, [("a", "p", f'"{i}"', n, "turtle") for n in (1, 2, 3) for i in range(5)]), path)
    before = store.read(spark, path)
    fails = F.udf(lambda s: 1 / 0, "string")
    broken = statements(spark, [("b", "p", '"x"', 1, "turtle")]).withColumn("o", fails("s"))
    with pytest.raises(Exception, match="ZeroDivisionError"):
        store.replace(broken, path, [f"{N}graph/{n}" for n in (1, 2, 3)])
    assert graph_counts(spark, path) == {"1": 5, "2": 5, "3": 5}
    # All graphs change together: one filled, two emptied, in one commit.
    store.replace(statements(spark, [("b", "p", '"x"', 1, "turtle")]), path, [f"{N}graph/{n}" for n in (1, 2, 3)])
    assert graph_counts(spark, path) == {"1": 1}
    assert store.table(path).committed(spark)[0] == 2
    # Who has read the old commit keeps it, until it is removed.
    assert before.count() == 15
    assert len(store.vacuum(spark, path)) >= 1 and graph_counts(spark, path) == {"1": 1}
    assert store.vacuum(spark, str(tmp_path / "none")) == []


def test_two_writers_do_not_overwrite_each_other(spark, tmp_path):
    path = str(tmp_path / "store")
    store.append(statements(spark, [("a", "p", '"1"')]), path)
    table = store.table(path)
    n, pairs = table.committed(spark)
    store.append(statements(spark, [("a", "p", '"2"')]), path)
    with pytest.raises(Exception, match="(?i)exists"):
        table.commit(spark, n, pairs)
    assert store.read(spark, path).count() == 2


def test_publish_merges_copies(spark, tmp_path):
    path, table = str(tmp_path / "store"), str(tmp_path / "table")
    store.append(statements(spark, [("a", "p", "b", n, t) for n, t in ((1, "turtle"), (2, "rdf"), (3, "sparql"))]), path)
    store.publish(spark, path, table)
    assert {r["source_key"] for r in store.published(spark, table).collect()} == {"local", "sparql:3"}
    store.replace(statements(spark, [("x", "p", "y", 3, "sparql"), ("x", "p", "z", 3, "sparql")]), path, [N + "graph/3"])
    store.publish(spark, path, table, ["sparql:3"])
    assert store.published(spark, table).count() == 3


def test_load_sources(spark, tmp_path):
    (tmp_path / "a.ttl").write_text('@prefix ex: <http://ex.org/> .\nex:a ex:p _:b0 , "x" .\n', encoding="utf-8")
    (tmp_path / "b.rdf").write_text(XML, encoding="utf-8")
    (tmp_path / "c.nt").write_text('_:b0 <http://ex.org/p> "\\u00e9" .\nnonsense\n', encoding="utf-8")
    (tmp_path / "d.ttl").write_text("ex:a ex:b ex:c .", encoding="utf-8")
    rows = [
        (1, "turtle", f"{tmp_path}/a.ttl"), (2, "rdf", f"{tmp_path}/b.rdf"), (3, "turtle", f"{tmp_path}/c.nt"),
        (4, "turtle", f"{tmp_path}/d.ttl"), (5, "sparql", None), (6, "ldf", None),
    ]
    sources = spark.createDataFrame(rows, "id int, type string, uri string")
    target, bad = str(tmp_path / "store"), str(tmp_path / "bad")
    graphs = load.load(spark, sources, target, bad)
    assert len(graphs) == 4
    assert graph_counts(spark, target) == {"1": 2, "2": 13, "3": 1}
    reasons = {(r["source_id"], r["reason"]) for r in store.quarantined(spark, bad).collect()}
    assert reasons == {(3, "statement has no closing dot"), (4, "unknown prefix")}
    # What was staged on the way is gone.
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    load.load(spark, sources.filter("id = 1"), target, bad)
    assert set(os.listdir(folder)) <= before
    assert graph_counts(spark, target) == {"1": 2, "2": 13, "3": 1}
    with pytest.raises(ValueError):
        load.read_source(spark, 9, "sparql", "x")


EX = "@prefix ex: <http://ex.org/> .\n"
MANY = "".join(f"ex:s{i} ex:p _:n , {i} .\n" for i in range(6))
TURTLE_FILES = {
    "plain": EX + MANY,
    "no line end": EX + MANY + "ex:last ex:p 1 .",
    "dot without a space": EX + MANY.replace(" .", ".") + "ex:last ex:p ex:x.",
    "comment first": "# A file .\n# @prefix old: <http://old.org/> .\n" + EX + MANY,
    "other directives": "PREFIX ex: <http://ex.org/>\nBASE <http://ex.org/b/>\n" + MANY + "<c> ex:p <../d> .\n",
    "relative directives": "@base <http://ex.org/b/c> .\n@prefix ex: <../> .\n<x> ex:p <y> .\n@base <z/> .\n@prefix w: <#> .\n" + MANY + "<x> ex:p w:v .\nBASE <k/>\n<l> ex:p <m> .\n",
    "directives over lines": "@prefix\nex:\n<http://ex.org/>\n.\nPREFIX # note\n v:\n# other <x>\n <http://v.org/>\n" + MANY + "v:a v:b v:c .\n",
    "nodes after a directive": "PREFIX ex: <http://ex.org/>\nex:a ex:p [ ex:q [ ] ] .\n" + MANY,
    "prefixes named like directives": "@prefix base: <http://b.org/> .\n@prefix prefix: <http://p.org/> .\nbase:a prefix:b base:c .\nprefix:a base:b 1 .\n",
    "one statement": "<http://a.org/> <http://b.org/> 1 .\n",
    "literals like ends": EX + 'ex:a ex:p """one .\ntwo .\n""" .\n' + MANY,
    "single quotes": EX + "ex:a ex:p '''one .\n\"\"\" two .\n\\''' [ .\n''' .\n" + MANY,
    "quotes that balance": EX + 'ex:a ex:p """ say " .\n "x" .\n""" .\n' + MANY,
    "comment over a cut": EX + "ex:a ex:p # note .\n ex:o .\n" + MANY,
    "statement begun before a comment": EX + "ex:a ex:p ex:o . ex:b # note .\n ex:p 2 .\n" + MANY,
    "bracket over a cut": EX + "ex:a ex:p ( 1 # two .\n3 ) .\nex:b ex:p [\nex:q [ ex:r (\n1\n2\n) ] ;\n] .\n" + MANY,
    "late directive": EX + MANY + "@prefix ex: <http://new.org/> .\n" + MANY + "@prefix ex: <http://newer.org/> . ex:x ex:p 1 .\n" + MANY,
    "declared twice": EX + "@prefix ex: <http://new.org/> .\n" + MANY,
    "windows line ends": ((EX + MANY).replace("\n", "\r\n")),
    "marks in literals": EX + "ex:a ex:p '# [ prefix', \"( .\" , <http://x/#a> .\n" + MANY,
    "many on a line": EX + MANY.replace("\n", " ") * 3 + "ex:a ex:p 1.5 , 2.0e3, 1 .ex:b ex:p ex:c.d .\n",
    "long literal": EX + MANY + 'ex:a ex:p """' + "line .\n" * 200 + '""" .\n' + MANY,
    "empty": "",
    "blank": "\n \n# nothing\n",
}
RDF_ROOT = '<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:v="http://ex.org/v#">\n'
FLAT = "".join(
    f'<rdf:Description rdf:about="http://ex.org/{i}"><v:p rdf:nodeID="n"/><v:q>{i}</v:q></rdf:Description>\n' for i in range(6)
)
CITY = '<v:City rdf:about="http://ex.org/c"><v:name>x</v:name></v:City>\n'
RDF_FILES = {
    "plain": "<?xml version='1.0'?>\n<!-- a - note -->\n" + RDF_ROOT + FLAT + "</rdf:RDF>\n",
    "typed elements": RDF_ROOT + CITY + FLAT + CITY + "</rdf:RDF>",
    "no description": RDF_ROOT + CITY + "</rdf:RDF>",
    "other root": (RDF_ROOT + CITY + "</rdf:RDF>").replace("rdf:", "r:").replace("xmlns:rdf", "xmlns:r"),
    "nested": RDF_ROOT + f"<v:T><v:p>\n{FLAT.splitlines()[0]}\n</v:p></v:T>" + FLAT + "</rdf:RDF>",
    "comment": RDF_ROOT + FLAT + "<!-- </rdf:Description>\n</rdf:RDF> -->" + FLAT + "</rdf:RDF>\n<!-- end -->\n",
    "relative": RDF_ROOT.replace(">", ' xml:base="http://ex.org/b/c">') + FLAT.replace("http://ex.org/", "../") + "</rdf:RDF>",
    "base below": RDF_ROOT + '<rdf:Description xml:base="http://base/x/"\n rdf:about="a"><v:p\n xml:base="y/" rdf:resource="b"/>\n</rdf:Description>\n' + FLAT + "</rdf:RDF>",
    "quotes and entities": '<?xml version="1.0"?>\n<!DOCTYPE rdf:RDF [\n<!ENTITY v "http://ex.org/v#">\n]>\n' + RDF_ROOT.replace("\n", "") + "<v:A\n rdf:about='>'\n v:b=\"/v:A>\n'>\">\n<v:c><![CDATA[</v:A>\n]]></v:c>\n<v:d rdf:resource='&v;x'/></v:A\n>\n" + FLAT + "</rdf:RDF>",
    "empty elements": RDF_ROOT + '<rdf:Description rdf:about="http://a/"\nv:p="1"\n/>\n<v:T/><v:T rdf:about="http://b/"/>' + FLAT + "</rdf:RDF\n>",
    "empty root": RDF_ROOT.strip()[:-1] + "/>\n",
    "root is a description": CITY.replace("<v:City", '<v:City xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:v="http://ex.org/v#"').replace("><", ">\n<"),
}


def linked(rows):
    """Statements in which blank nodes are told apart by what is said of them."""
    names = sorted({x for r in rows for x, k in ((r["s"], r["s_kind"]), (r["o"], r["o_kind"])) if k == "bnode"})
    facts = {n: sorted((r["p"], r["o"] if r["o_kind"] != "bnode" else "_", r["s"] == n) for r in rows if n in (r["s"], r["o"])) for n in names}
    found = {}
    for r in rows:
        s, o = (str(facts[x]) if k == "bnode" else x for x, k in ((r["s"], r["s_kind"]), (r["o"], r["o_kind"])))
        found[(s, r["p"], o, r["o_datatype"], r["o_lang"])] = found.get((s, r["p"], o, r["o_datatype"], r["o_lang"]), 0) + 1
    return found


@pytest.mark.parametrize("kind, files", [("turtle", TURTLE_FILES), ("rdf", RDF_FILES)])
def test_pieces_lose_nothing(spark, tmp_path, kind, files):
    """Every file gives the same statements whole and in pieces of any size, in many blocks too."""
    for i, body in enumerate(files.values()):
        if body.strip() or kind == "turtle":
            (tmp_path / f"{i:02}.x").write_bytes(body.encode())
    whole, bad = load.read_source(spark, 1, kind, str(tmp_path), whole=True)
    assert [tuple(r) for r in bad.collect()] == []
    one = linked(whole.collect())
    assert len(one) > 25
    reader = turtle.read_statements if kind == "turtle" else rdfxml.read_descriptions
    try:
        for size, block in ((1, 128 << 20), (50, 300)):
            spark.conf.set("spark.sql.files.maxPartitionBytes", block)
            good, bad = load.read_source(spark, 1, kind, str(tmp_path), size=size)
            assert [tuple(r) for r in bad.collect()] == [], (size, block)
            assert linked(good.collect()) == one, (size, block)
        docs = {r["path"].rsplit("/", 1)[1]: r["count"] for r in reader(spark, str(tmp_path), size=1).groupBy("path").count().collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    # Whatever the style, a file with many lines is many documents.
    single = {"one statement", "empty", "blank", "empty root", "root is a description", "no description", "other root"}
    assert {n for i, n in enumerate(files) if docs.get(f"{i:02}.x", 0) < 2} == single & set(files)


@pytest.mark.parametrize("kind", ["turtle", "rdf"])
def test_documents_are_not_too_many(spark, tmp_path, kind):
    body = EX + MANY * 2000 if kind == "turtle" else RDF_ROOT + FLAT * 300 + "</rdf:RDF>"
    (tmp_path / "a.x").write_text(body)
    reader = turtle.read_statements if kind == "turtle" else rdfxml.read_descriptions
    assert reader(spark, str(tmp_path)).count() == 1
    sizes = [r[0] for r in reader(spark, str(tmp_path), size=20_000).select(F.length("body")).collect()]
    assert len(sizes) >= len(body) // 20_000 and sum(sizes) < 1.2 * len(body)


def test_sources_share_a_scan(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"a {i}%20é.ttl").write_text(f"<http://a.org/{i}> <http://b.org/> {i} .\n")
    rows = [(i, "turtle", f"{tmp_path}/a {i}%20é.ttl") for i in range(5)] + [(9, "turtle", str(tmp_path)), (10, "turtle", str(tmp_path))]
    assert [len(files) for _, files in load._files(spark, {r[0]: r[2] for r in rows})] == [5, 10]
    good, bad, ids = load.read_sources(spark, spark.createDataFrame(rows, "id int, type string, uri string"))
    got = {(r["source_id"], r["o"]) for r in good.collect()}
    assert got == {(i, str(i)) for i in range(5)} | {(k, str(i)) for k in (9, 10) for i in range(5)}
    assert good.count() == 15 and bad.count() == 0


@pytest.mark.parametrize("syntax, files", [(turtle_syntax, TURTLE_FILES), (rdfxml_syntax, RDF_FILES)])
def test_states_compose(syntax, files):
    """What two stretches do one after the other is what the whole does, wherever it is cut."""
    for body in files.values():
        lines = body.splitlines(keepends=True)
        for n in range(len(lines) + 1):
            first, second = "".join(lines[:n]), "".join(lines[n:])
            # An open tag holds no other, so only what a file can begin with is tried there.
            for state in range(syntax.states) if syntax is turtle_syntax else (0,):
                middle, depth = syntax.passes(first)[state]
                last, more = syntax.passes(second)[middle]
                whole = syntax.passes(body)[state]
                # Blank stretches may not know that they are between statements.
                assert (last, depth + more) == whole or {last, whole[0]} <= {0, 1} and depth + more == whole[1], (body, n, state)


def test_bad_pieces_are_kept_with_their_reason(spark, tmp_path):
    (tmp_path / "a.ttl").write_text(EX + MANY + "ex:a nowhere:p 1 .\n")
    (tmp_path / "b.ttl").write_text(EX + "ex:a ex:p [ ex:q 1 .\n" + MANY)
    good, bad = load.read_source(spark, 1, "turtle", str(tmp_path))
    assert good.count() == 12  # the other statements of a.ttl
    got = {r["reason"]: r["value"] for r in bad.collect()}
    assert set(got) == {"unknown prefix", "unbalanced brackets"}
    assert got["unbalanced brackets"] == EX + "ex:a ex:p [ ex:q 1 .\n" + MANY
    (tmp_path / "c.rdf").write_text(RDF_ROOT + CITY + "<v:A v:b='1' v:b='2'/>" + FLAT + "<v:open>")
    good, bad = load.read_source(spark, 1, "rdf", f"{tmp_path}/c.rdf")
    assert good.count() == 14
    assert sorted(r["value"].split(RDF_ROOT.strip())[1].strip()[:6] for r in bad.collect()) == ["<v:A v", "<v:ope"]


@pytest.mark.parametrize(
    "iri, base, full",
    [
        ("../x", "http://ex.org/a/b/c", "http://ex.org/a/x"), ("./x", "http://ex.org/a/b", "http://ex.org/a/x"),
        ("../../../x", "http://ex.org/a/b", "http://ex.org/x"), ("..", "http://ex.org/a/b/c", "http://ex.org/a/"),
        (".", "http://ex.org/a/b", "http://ex.org/a/"), ("/a/./b/../c?q=/../d", "http://ex.org/z", "http://ex.org/a/c?q=/../d"),
        ("x", "http://ex.org", "http://ex.org/x"), ("x/..y", "http://ex.org/", "http://ex.org/x/..y"), ("x", "urn:a", "urn:x"),
    ],
)
def test_relative_addresses(spark, iri, base, full):
    assert value(spark, turtle.resolve_iri(F.lit(iri), F.lit(base))) == full
    assert rdfxml_events.resolved(iri, base) == full


def rdf(body, root=RDF_ROOT):
    return [r for rows in rdfxml_events.statements(root + body + "</rdf:RDF>", "http://doc/d") for r in rows]


def test_context_is_inherited():
    inner = '<v:p><v:T rdf:about="b"><v:q xml:lang="">plain</v:q><v:q rdf:resource="c"/></v:T></v:p>'
    rows = rdf(f'<rdf:Description xml:base="http://base/x/" xml:lang="fr" rdf:about="a"><v:n>un</v:n>{inner}<v:r xml:base="y/z" rdf:resource="d"/></rdf:Description><v:T rdf:about="e"/>')
    v = "http://ex.org/v#"
    assert {(r[0], r[2], r[3], r[6]) for r in rows} == {
        ("http://base/x/a", v + "n", "un", "fr"), ("http://base/x/a", v + "p", "http://base/x/b", None),
        ("http://base/x/b", M.RDF_TYPE, v + "T", None), ("http://base/x/b", v + "q", "plain", None), ("http://base/x/b", v + "q", "http://base/x/c", None),
        ("http://base/x/a", v + "r", "http://base/x/y/d", None), ("http://doc/e", M.RDF_TYPE, v + "T", None),
    }


def test_statements_with_an_id_are_described():
    rows = rdf('<rdf:Description rdf:ID="a"><v:p rdf:ID="s" xml:lang="en">x</v:p><v:q rdf:ID="t"><v:T/></v:q></rdf:Description>')
    about = {(r[2], r[3], r[6]) for r in rows if r[0] == "http://doc/d#s"}
    assert about == {
        (M.RDF_TYPE, M.RDF + "Statement", None), (M.RDF + "subject", "http://doc/d#a", None),
        (M.RDF + "predicate", "http://ex.org/v#p", None), (M.RDF + "object", "x", "en"),
    }
    assert (("http://doc/d#t", "uri", M.RDF + "object", "-node1", "bnode", None, None)) in rows


def test_collections_members_and_markup():
    rows = rdf(
        '<rdf:Seq><rdf:li>1</rdf:li><rdf:li rdf:resource="http://x/"/></rdf:Seq><v:T v:a="1"><v:l rdf:parseType="Collection"><v:I rdf:nodeID="i"/><v:I/></v:l>'
        '<v:e rdf:parseType="Collection"/><v:m rdf:parseType="Literal">a<b xmlns="http://h/">c</b></v:m><v:r rdf:parseType="Resource"><v:k>2</v:k></v:r><v:u v:w="3"/></v:T>'
    )
    assert [r[3] for r in rows if r[2] in (M.RDF + "_1", M.RDF + "_2")] == ["1", "http://x/"]
    cells = [r for r in rows if r[2] in (M.RDF + "first", M.RDF + "rest")]
    assert len(cells) == 4 and cells[-1][3] == M.RDF + "nil" and cells[0][3] == "i"
    by = {r[2].split("#")[1]: r for r in rows if "v#" in r[2]}
    assert by["e"][3] == M.RDF + "nil" and by["m"][3].startswith("a<") and by["m"][5] == M.RDF + "XMLLiteral"
    assert by["k"][0] == by["r"][3] and by["w"][0] == by["u"][3] and by["a"][3] == "1"


@pytest.mark.parametrize("body", ["<v:a><v:b><v:c/><v:d/></v:b></v:a>", "<plain/>", "<v:a><plain/></v:a>", "<v:a>"])
def test_what_is_no_rdfxml(body):
    with pytest.raises(ValueError, match="not RDF/XML"):
        rdf(body)


def test_a_long_document_is_read_as_a_stream(spark, monkeypatch):
    import tracemalloc

    many = 40_000
    text = RDF_ROOT + "".join(f"<v:T rdf:about='http://x/{i}'><v:n>{i}</v:n></v:T>\n" for i in range(many))
    tracemalloc.start()
    assert sum(map(len, rdfxml_events.statements(text + "</rdf:RDF>"))) == 2 * many
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4_000_000
    # None of its statements is returned if its end is wrong, however long it is.
    docs = spark.createDataFrame([("good", text + "</rdf:RDF>"), ("bad", text)], "doc string, body string")
    got = rdfxml.read(docs, "body", "doc")
    assert {(r["doc"], r["reason"] is None): r["count"] for r in got.groupBy("doc", "reason").count().collect()} == {("good", True): 2 * many, ("bad", False): 1}


def test_the_format_is_a_column(spark, tmp_path):
    (tmp_path / "a.txt").write_text(f'_:x <{N}p> "a" .\nbad\n')
    rows = [(1, "turtle", f"{tmp_path}/a.txt", "ntriples"), (2, "turtle", f"{tmp_path}/a.txt", None)]
    sources = spark.createDataFrame(rows, "id int, type string, uri string, format string")
    good, bad, ids = load.read_sources(spark, sources)
    assert ids == [1, 2]
    # Read as Turtle, too, only the line that is none is set aside.
    assert sorted(r["source_id"] for r in good.collect()) == [1, 2]
    assert sorted(r["source_id"] for r in bad.collect()) == [1, 2]
    with pytest.raises(ValueError, match="csv"):
        load.read_sources(spark, sources.withColumn("format", F.lit("csv")))


def test_catalog(spark):
    parents = spark.createDataFrame([(1, 10, "TurtleSource"), (2, 10, "SparqlSource"), (3, 99, "LdfSource")], catalog.PARENT_SCHEMA)
    tables = {
        "turtle": spark.createDataFrame([(10, "file:///x.ttl")], catalog.CHILD_SCHEMAS["turtle"]),
        "sparql": spark.createDataFrame([(10, "http://e", None, None, None, None)], catalog.CHILD_SCHEMAS["sparql"]),
        "ldf": spark.createDataFrame([], catalog.CHILD_SCHEMAS["ldf"]),
    }
    resolved = catalog.resolve(parents, tables)
    assert {(r["id"], r["type"], r["uri"], r["endpoint"]) for r in resolved.collect()} == {
        (1, "turtle", "file:///x.ttl", None), (2, "sparql", None, "http://e"),
    }
    assert [r["id"] for r in catalog.orphans(parents, tables).collect()] == [3]
    assert {tuple(r) for r in catalog.depths(resolved).collect()} == {("local", 3), ("sparql:2", 1)}


@pytest.mark.parametrize(
    "row, errors",
    [
        (("sparql", None, "http://e", "3", None), []),
        (("sparql", None, "http://e", "", None), []),
        (("sparql", None, "", "0", None), ["endpoint is required", "depth must be at least 1"]),
        (("sparql", None, "e", "-2", None), ["depth must be at least 1"]),
        (("sparql", None, "e", "99999999999", None), ["depth may not be greater than 5"]),
        (("sparql", None, "e", "2.5", None), ["depth must be an integer"]),
        (("turtle", "no address", None, None, None), ["uri cannot be resolved"]),
        (("rdf", " ", None, None, None), ["uri is required"]),
        (("ldf", None, None, "9", None), ["startfragment is required"]),
        (("csv", None, None, None, None), ["type is not supported"]),
        ((None, None, None, None, None), ["type is required, one of: ldf, rdf, sparql, turtle"]),
    ],
)
def test_validation(spark, row, errors):
    df = spark.createDataFrame([row], "type string, uri string, endpoint string, depth string, startfragment string")
    assert catalog.validate(df).first()["errors"] == errors


def test_fragment_page_plan(spark):
    stated = spark.createDataFrame(
        [("http://f", "http://f", 100, 10), ("http://g?x=1", "http://g", 5, 10), ("http://h", "http://h", None, 10)],
        "url string, startfragment string, total long, page_size long",
    )
    plan = fragments.page_plan(stated, 20, 15).collect()
    assert [r["page_url"] for r in plan] == ["http://f?page=2", "http://f?page=3"]
    covering = fragments.page_plan(stated, 20, 15, covering=True).collect()
    assert [r["page"] for r in covering] == [1, 2, 3]
    assert [r["page_url"] for r in fragments.page_plan(stated, 20, 0).collect()] == [
        "http://f?page=0", "http://f?page=1", "http://g?x=1&page=0", "http://g?x=1&page=1",
    ]
    assert fragments.unusable(stated).count() == 1


def test_error_pages_are_rejected(spark):
    rows = [(1, "<html><body>502 Bad Gateway</body></html>"), (2, "<html><br></html>"), (3, "no markup"), (4, "")]
    bad = answers.rejected(spark.createDataFrame(rows, "source_id int, body string")).collect()
    assert sorted(r["source_id"] for r in bad) == [1, 2, 3]


def test_quarantine_is_replaced_and_blank_nodes_are_scoped(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.nt").write_text(f'_:x <{N}p> "{name}" .\nbad line of {name}\n')
    good, bad = load.read_source(spark, 1, "turtle", f"{tmp_path}/*.nt")
    assert good.select("s").distinct().count() == 2
    path = str(tmp_path / "quarantine")
    for _ in range(2):
        store.quarantine(bad, path, [1, 2])
    assert store.quarantined(spark, path).count() == 2
    store.quarantine(bad.limit(0), path, [1])
    assert store.quarantined(spark, path).count() == 0


def test_a_shared_folder_is_required(monkeypatch):
    class Session:
        conf = {}

    monkeypatch.setattr(stage, "_own", [])
    with pytest.raises(ValueError, match="share"):
        stage.shared_folder(Session)
    Session.conf = {"spark.checkpoint.dir": "hdfs://shared/"}
    assert stage.shared_folder(Session) == "hdfs://shared"
