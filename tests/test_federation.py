"""One answer from the store, saved answers of endpoints and saved fragment pages."""

import pytest

from rdfweave import model as M
from rdfweave.model import Pattern, Term
from rdfweave.operators import federate, match
from rdfweave.plans import federation
from rdfweave.plans import query as plans
from tests.frames import N, statements

P = N + "p"
OWN = "http://graph/own"
START = "http://f/x?y=1"


def count(n):
    return f'{{"results": {{"bindings": [{{"count": {{"value": "{n}"}}}}]}}}}'


def graph(*pairs):
    inner = "".join(f'<rdf:Description rdf:about="{N}{s}"><v:p>{o}</v:p><v:q>other</v:q></rdf:Description>' for s, o in pairs)
    return f'<rdf:RDF xmlns:rdf="{M.RDF}" xmlns:v="{N}">{inner}</rdf:RDF>'


def page(url, *pairs, total=5):
    head = f"@prefix h: <{M.HYDRA}> .\n<{url}> a h:PagedCollection ; h:totalItems {total} ; h:itemsPerPage 2 .\n"
    return (9, url, head + "".join(f'<{N}{s}> <{P}> "{o}" .\n' for s, o in pairs))


@pytest.fixture(scope="module")
def sources(spark):
    data = match.default_graphs(statements(spark, [("l1", "p", '"1"'), ("l1", "p", '"2"'), ("l2", "p", '"3"'), ("l2", "q", '"x"'), ("r", "p", '"no"', 3, "sparql")]))
    catalog = spark.createDataFrame(
        [(4, "sparql", OWN, None), (5, "sparql", None, None), (6, "sparql", None, None), (7, "turtle", None, None), (9, "ldf", None, START)],
        "id int, type string, named_graph string, startfragment string",
    )
    counted = [(4, OWN, count(2)), (4, None, count(50)), (5, None, count(1)), (5, OWN, count(70)), (6, None, "no answer"), (8, None, count(9))]
    graphs = [(4, OWN, graph(("e1", "4"), ("e2", "5"))), (4, None, graph(("z", "not asked"))), (5, None, graph(("d", "6"))), (6, None, "error")]
    pages = [
        page(START, ("f1", "7"), ("f2", "8")), page(START + "&page=0", ("f1", "7"), ("f2", "8")),
        page(START + "&page=1", ("f3", "9"), ("f4", "10")), page(START + "&page=2", ("f5", "11")), (9, START + "&page=3", "not <turtle"),
    ]
    columns = "source_id int, named_graph string, body string"
    return [
        federation.StoreSource(data),
        federation.EndpointSource(catalog, spark.createDataFrame(counted, columns), spark.createDataFrame(graphs, columns)),
        federation.FragmentSource(catalog, spark.createDataFrame(pages, "source_id int, url string, body string")),
    ]


def test_totals_of_all_kinds(sources):
    got = {(r["source_rank"], r["source_key"]): r["solutions"] for r in federation.totals(sources, Pattern(p=Term.iri(P))).collect()}
    assert got == {(0, "local"): 3, (1, "sparql:4"): 2, (1, "sparql:5"): 1, (2, "ldf:9"): 5}


@pytest.mark.parametrize("limit, offset", [(100, 0), (4, 2), (3, 5), (2, 7), (3, 9), (5, 11), (0, 0), (1, 10)])
def test_pages_straddle_kinds(sources, limit, offset):
    answer = federation.federated_query(sources, Pattern(p=Term.iri(P)), limit, offset)
    assert answer.total == 11
    order = [*map(str, range(1, 10)), "10", "11"]
    want = order[offset : offset + limit]
    rows = answer.solutions.orderBy("source_rank", "source_key", "s", "o").collect()
    assert [r["o"] for r in rows] == want and answer.found == bool(want)
    assert {r["p"] for r in rows} <= {P}


def test_what_a_page_does_not_reach_is_not_parsed(sources):
    share = [federation.Share("ldf:9", 2, 2)]
    rows = sources[2].scan(Pattern(), share)
    assert sorted(r["o"] for r in rows.collect()) == ["10", "9"]
    # The page that is no Turtle is the fourth; a share of it is empty and harms nothing.
    assert sources[2].scan(Pattern(), [federation.Share("ldf:9", 6, 1)]).count() == 0
    assert sources[1].scan(Pattern(), share).count() == 0
    assert sources[0].scan(Pattern(), share).count() == 0


def test_requests_for_the_root(spark, sources):
    data = match.default_graphs(statements(spark, [(f"x{i}", "p", f'"{i}"') for i in range(5)] + [("x0", "q", "x1")]))
    depths = spark.createDataFrame([("local", 2)], "source_key string, depth int")
    requests = spark.createDataFrame([(1, N + "x0"), (2, ""), (3, "http://root"), (4, N + "none")], "request_id long, uri string")
    got = federate.dereference(data, requests, depths, limit=4, offset=1, root="http://root").collect()
    by = {}
    for r in got:
        by.setdefault(r["request_id"], []).append((r["s"], r["o"], r["o2"]))
    assert set(by) == {1, 2, 3} and sorted(by[2]) == sorted(by[3]) and len(by[2]) == 4
    assert by[1] == [(N + "x0", N + "x1", "1")]
    whole = plans.dereference_query(data, "http://root", depths, root="http://root")
    assert whole.total == 6 and len(whole.statements.collect()) == 6
    # Without the root's address it is a subject like any other.
    assert not plans.dereference_query(data, "http://root", depths, root="http://other").found
