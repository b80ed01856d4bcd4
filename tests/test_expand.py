import random
from collections import Counter

import pytest

from rdfweave.model import Pattern, Term
from rdfweave.operators import expand, match
from rdfweave.operators.scale import skew_join
from tests.frames import N, solutions, statements

CHAIN = [
    ("c1", "nation", "n1"),
    ("c2", "nation", "n2"),
    ("c3", "nation", '"nowhere"'),
    ("n1", "name", '"one"'),
    ("n1", "region", "r1"),
    ("n2", "region", "r2"),
    ("r1", "name", '"R"'),
    ("r1", "of", "n1"),
]


def found(df, depth):
    rows = []
    for r in df.collect():
        path = [(r["s"], r["p"], r["o"])]
        s = r["o"]
        for hop in range(2, depth + 1):
            if r[f"p{hop}"] is not None:
                path.append((s, r[f"p{hop}"], r[f"o{hop}"]))
                s = r[f"o{hop}"]
        rows.append((r["source_key"], tuple(path)))
    return Counter(rows)


def expected(rows, p, depth):
    def long(text):
        return text if text.startswith("_:") else text[1:].rpartition('"')[0] if text[0] == '"' else N + text

    return Counter(
        (k, tuple((long(s), N + q, long(o)) for s, q, o in path)) for k, path in solutions(rows, p, depth)
    )


@pytest.mark.parametrize("large", [False, True])
@pytest.mark.parametrize("depth", [1, 2, 3, 4])
def test_all_or_nothing(spark, depth, large):
    data = match.default_graphs(statements(spark, CHAIN))
    base = match.match(data, Pattern(p=Term.iri(N + "nation")))
    got = found(expand.expand(base, data, depth, large=large), depth)
    assert got == expected(CHAIN, "nation", depth)


def test_two_hop_path_is_dropped_at_depth_three(spark):
    data = match.default_graphs(statements(spark, CHAIN))
    base = match.match(data, Pattern(s=Term.iri(N + "c2")))
    (row,) = expand.expand(base, data, 3).collect()
    assert row["p2"] is None and row["p3"] is None


@pytest.mark.parametrize("seed", range(4))
def test_random_graphs(spark, seed):
    rng = random.Random(seed)
    nodes = [f"x{i}" for i in range(6)] + ["_:b0", "_:b1"]
    sources = [(1, "turtle"), (2, "rdf"), (3, "sparql"), (4, "ldf")]
    rows = []
    for _ in range(40):
        o = rng.choice([*nodes, '"lit"', '"4"^^int'])
        rows.append((rng.choice(nodes), rng.choice(["p", "q"]), o, *rng.choice(sources)))
    data = match.default_graphs(statements(spark, rows)).cache()
    for depth in (2, 3):
        pattern = Pattern(p=Term.iri(N + "p"))
        want = expected(rows, "p", depth)
        base = match.match(data, pattern)
        assert found(expand.expand(base, data, depth), depth) == want
        assert found(expand.expand(base, data, depth, large=True), depth) == want
        per_source = Counter()
        for (key, _), n in want.items():
            per_source[key] += n
        for large in (False, True):
            counts = expand.solution_counts(data, pattern, depth, large=large).collect()
            assert {r["source_key"]: r["solutions"] for r in counts} == per_source


@pytest.mark.parametrize("seed", range(2))
def test_construct_without_paths(spark, seed):
    rng = random.Random(100 + seed)
    nodes = [f"x{i}" for i in range(8)] + ["_:b0"]
    rows = [(rng.choice(nodes), rng.choice("pqr"), rng.choice([*nodes, '"lit"']), *rng.choice([(1, "turtle"), (3, "sparql")])) for _ in range(16)]
    data = match.default_graphs(statements(spark, rows)).cache()
    base = match.match(data, Pattern(p=Term.iri(N + "p")))
    for depth, large in ((1, False), (2, True), (3, False), (5, True)):
        want = sorted(map(tuple, expand.construct(expand.expand(base, data, depth), depth).collect()), key=str)
        got = expand.construct_all(base, data, depth, large=large)
        assert sorted(map(tuple, got.collect()), key=str) == want, (depth, large)


def test_construct_builds_no_path(spark):
    # 30 x 30 x 30 paths over 120 statements.
    rows = [("a", "p", "l0n0")]
    rows += [("l0n0", "q", f"l1n{j}") for j in range(30)]
    rows += [(f"l1n{i}", "q", f"l2n{j}") for i in range(30) for j in range(30)]
    rows += [(f"l2n{i}", "q", f'"{j}"') for i in range(30) for j in range(30)]
    data = match.default_graphs(statements(spark, rows))
    base = match.match(data, Pattern(p=Term.iri(N + "p")))
    steps = expand.reduced(base, data, 4)
    assert [s.count() for s in steps] == [30, 900, 900]
    plan = expand.construct_all(base, data, 4)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" not in plan and "Join LeftOuter" not in plan


def test_hops_are_read_once(spark):
    data = match.default_graphs(statements(spark, CHAIN))
    base = match.match(data, Pattern(p=Term.iri(N + "nation")))
    for depth in (2, 4):
        counts = expand.solution_counts(data, Pattern(p=Term.iri(N + "nation")), depth)
        # What is left to do reads staged hops, and the table for the last one.
        plan = counts._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("LogicalRDD") == 1 and plan.count(" parquet") <= depth + 1, plan
        assert counts.agg({"solutions": "sum"}).first()[0] == expand.expand(base, data, depth).count()


def test_open_pattern_count_leaves_the_path_out(spark):
    data = match.default_graphs(statements(spark, CHAIN))
    (row,) = expand.solution_counts(data, Pattern(), 3).collect()
    assert row["solutions"] == len(CHAIN)
    hashed = Pattern(s=Term.iri(N + "c1"), hash_variants=True)
    (row,) = expand.solution_counts(data, hashed, 3).collect()
    assert row["solutions"] == 1
    plain = Pattern(s=Term.iri(N + "c1"))
    (row,) = expand.solution_counts(data, plain, 3).collect()
    assert row["solutions"] == 2


def test_literal_never_expands(spark):
    rows = [("a", "p", '"http://ex.org/b"'), ("b", "q", '"x"')]
    data = match.default_graphs(statements(spark, rows))
    (row,) = expand.expand(match.match(data, Pattern(p=Term.iri(N + "p"))), data, 2).collect()
    assert row["p2"] is None


def test_sources_are_evaluated_alone(spark):
    rows = [("a", "p", "b", 3, "sparql"), ("b", "q", "c", 1, "turtle"), ("b", "q", "d", 2, "rdf")]
    data = match.default_graphs(statements(spark, rows))
    (row,) = expand.expand(match.match(data, Pattern(p=Term.iri(N + "p"))), data, 2).collect()
    assert row["p2"] is None
    local = [("a", "p", "b", 2, "rdf"), *rows[1:]]
    data = match.default_graphs(statements(spark, local))
    assert expand.expand(match.match(data, Pattern(p=Term.iri(N + "p"))), data, 2).count() == 2


def test_copies_in_local_graphs_count_once(spark):
    rows = [("a", "p", "b", 1, "turtle"), ("a", "p", "b", 2, "rdf"), ("a", "p", "b", 3, "sparql")]
    data = match.default_graphs(statements(spark, rows))
    assert data.count() == 2
    assert match.default_graphs(statements(spark, rows), distinct=False).count() == 3


def test_construct_is_distinct_and_skips_empty_paths(spark):
    data = match.default_graphs(statements(spark, CHAIN))
    base = match.match(data, Pattern(p=Term.iri(N + "nation")))
    got = {(r["s"], r["p"]) for r in expand.construct(expand.expand(base, data, 3), 3).collect()}
    assert got == {
        (N + "c1", N + "nation"), (N + "c2", N + "nation"), (N + "c3", N + "nation"),
        (N + "n1", N + "region"), (N + "r1", N + "name"), (N + "r1", N + "of"),
    }


def test_depth_bounds(spark):
    data = match.default_graphs(statements(spark, CHAIN))
    for depth in (0, 6):
        with pytest.raises(ValueError):
            expand.expand(data, data, depth)


def test_depth_per_source(spark):
    rows = [
        (s, p, o, *source)
        for source in ((1, "turtle"), (3, "sparql"), (5, "ldf"), (6, "sparql"))
        for s, p, o in CHAIN
    ]
    data = match.default_graphs(statements(spark, rows))
    depths = spark.createDataFrame([("local", 3), ("sparql:3", 2), ("ldf:5", 1)], "source_key string, depth int")
    base = match.match(data, Pattern(p=Term.iri(N + "nation")))
    got = expand.expand_by_source(base, data, depths)
    by_key = Counter()
    for r in got.collect():
        by_key[r["source_key"]] += 1
    want = {"local": 3, "sparql:3": 2, "ldf:5": 1, "sparql:6": 1}
    assert by_key == {k: len(solutions(CHAIN, "nation", d)) for k, d in want.items()}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_slices_hot_keys(spark, how):
    left = spark.createDataFrame([("hot", i) for i in range(500)] + [(f"k{i}", i) for i in range(50)] + [("alone", 1)], "k string, v int")
    right = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(40)], "k string, w int")
    plain = left.join(right, ["k"], how)
    sliced = skew_join(left, right, ["k"], how, large=True, slice_rows=20)
    assert sorted(map(tuple, sliced.collect())) == sorted(map(tuple, plain.collect()))
    assert sliced.columns == plain.columns
