import pytest
from pyspark.sql import functions as F

from rdfweave.model import Pattern, Term
from rdfweave.operators import expand, federate, match, paging
from rdfweave.plans import query
from rdfweave.sources import store
from tests.frames import N, statements


def many(spark):
    rows = [(f"a{i:03}", "p", f'"{i}"', 1, "turtle") for i in range(100)]
    rows += [(f"b{i:03}", "p", f'"{i}"', 3, "sparql") for i in range(50)]
    return match.default_graphs(statements(spark, rows))


@pytest.mark.parametrize("offset, first, n", [(0, "a000", 20), (90, "a090", 20), (100, "b000", 20), (140, "b040", 10), (150, None, 0)])
def test_page_straddles_sources(spark, offset, first, n):
    data = many(spark)
    pattern = Pattern(p=Term.iri(N + "p"))
    counts = expand.solution_counts(data, pattern)
    base, rest = federate.reaching(match.match(data, pattern), counts, 20, offset)
    rows = paging.page(base, 20, rest).collect()
    assert len(rows) == n
    assert first is None or rows[0]["s"] == N + first


def test_pages_together_are_the_whole(spark):
    data = many(spark).cache()
    whole = [r["s"] for r in paging.page(data, 1000).collect()]
    parts = [r["s"] for offset in range(0, 150, 37) for r in paging.page(data, 37, offset).collect()]
    assert parts == whole and len(set(whole)) == 150


def test_empty_page(spark):
    assert paging.page(many(spark), limit=0).count() == 0


@pytest.mark.parametrize("offset", [0, 60, 399, 590, 700])
def test_deep_page_equals_plain_page(spark, offset):
    rows = [("hot", f"p{i % 7}", f'"{i}"') for i in range(400)] + [(f"s{i}", "p", '"x"') for i in range(200)]
    data = match.default_graphs(statements(spark, rows)).cache()
    plain = [tuple(r) for r in paging.page(data, 25, offset).collect()]
    deep = [tuple(r) for r in paging.page(data, 25, offset, last_rows=60).collect()]
    assert deep == plain


def test_expanded_page_equals_page_of_expansion(spark):
    rows = [(f"a{i:02}", "p", f"b{i % 5}") for i in range(40)] + [(f"b{i}", "q", f'"{j}"') for i in range(4) for j in range(3)]
    data = match.default_graphs(statements(spark, rows)).cache()
    base = match.match(data, Pattern(p=Term.iri(N + "p")))
    for offset in (0, 17, 90):
        want = paging.page(expand.expand(base, data, 2), 20, offset, 2).collect()
        assert paging.expanded_page(base, data, 2, 20, offset).collect() == want
        assert paging.expanded_page(base, data, 2, 20, offset, first_rows=10, last_rows=45).collect() == want


def test_page_per_group_with_a_hot_group(spark):
    rows = [("hot", "p", f'"{i:05}"') for i in range(3000)] + [("cold", "p", '"1"')]
    data = match.default_graphs(statements(spark, rows)).withColumn("request_id", F.col("s"))
    order = paging.order_columns()
    for limit, offset in ((100, 0), (100, 50), (500, 1500)):
        got = paging.page_per_group(data, ["request_id"], order, limit, offset).collect()
        hot = sorted(r["o"] for r in got if r["s"] == N + "hot")
        assert hot == [f"{i:05}" for i in range(offset, offset + limit)]
        assert any(r["s"] == N + "cold" for r in got) == (offset == 0)


def test_group_page_is_cut_before_the_shuffle(spark):
    data = many(spark).withColumn("request_id", F.col("source_key"))
    page = paging.page_per_group(data, ["request_id"], paging.order_columns())
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_totals_and_copies_across_sources(spark):
    rows = [("a", "p", "b", 1, "turtle"), ("a", "p", "b", 3, "sparql"), ("a", "p", "c", 3, "sparql")]
    data = match.default_graphs(statements(spark, rows))
    totals = {r["source_key"]: r["solutions"] for r in federate.with_total(expand.solution_counts(data, Pattern())).collect()}
    assert totals == {"local": 1, "sparql:3": 2, None: 3}
    assert federate.distinct_statements(data).first()[0] == 2
    assert federate.merge(data, data).count() == 2


def test_pattern_query(spark):
    answer = query.pattern_query(many(spark), Pattern(p=Term.iri(N + "p")), limit=20, offset=90)
    assert (answer.total, answer.found, answer.statements.count()) == (150, True, 20)
    assert answer.description.count() == 22 + 4
    nothing = query.pattern_query(many(spark), Pattern(p=Term.iri(N + "none")))
    assert (nothing.total, nothing.found) == (0, False)


def test_open_query_pages_what_its_count_leaves_out(spark):
    rows = [("a", "p", "b"), ("b", "q", "c"), ("b", "q", "d")]
    data = match.default_graphs(statements(spark, rows))
    answer = query.pattern_query(data, Pattern(), limit=10, offset=1, depth=2)
    assert answer.total == 3
    assert answer.solutions.count() == 3  # four solutions, the first one skipped


def test_dereference_query(spark):
    rows = [("a", "p", "b"), ("b", "q", "c"), ("a#x", "p", '"y"')]
    data = match.default_graphs(statements(spark, rows))
    depths = spark.createDataFrame([("local", 3)], "source_key string, depth int")
    answer = query.dereference_query(data, N + "a", depths)
    assert (answer.total, answer.found, answer.statements.count()) == (1, True, 1)
    hashed = query.dereference_query(data, N + "A", depths, hash_variants=True)
    assert {r["s"] for r in hashed.statements.collect()} == {N + "a", N + "a#x"}
    # The total counts matched statements, as a pattern query with hash variants does.
    variants = Pattern(s=Term.iri(N + "A"), hash_variants=True)
    assert hashed.total == query.pattern_query(data, variants, depth=3).total == 2
    assert not query.dereference_query(data, N + "none", depths).found


def test_no_source_vanishes(spark):
    rows = [(f"n{i}", "p", f"n{i + 1}", source, kind) for i in range(6) for source, kind in ((1, "turtle"), (3, "sparql"), (4, "sparql"), (5, "ldf"))]
    data = match.default_graphs(statements(spark, rows))
    keys = {r[0] for r in data.select("source_key").distinct().collect()}
    assert len(keys) == 4
    named = sorted(keys)
    depths = spark.createDataFrame([(named[0], 5), (named[1], 4), (named[2], 2)], "source_key string, depth int")
    base = match.match(data, Pattern())
    counts = federate.counts_by_source(base, data, depths)
    solutions = expand.expand_by_source(base, data, depths)
    assert {r["source_key"]: r["solutions"] for r in counts.collect()} == dict.fromkeys(keys, 6)
    longest = solutions.filter("p5 IS NOT NULL").select("source_key").distinct().collect()
    assert [r[0] for r in longest] == [named[0]]
    asked = spark.createDataFrame([(0, N + "n0")], "request_id long, uri string")
    assert {r["source_key"] for r in federate.dereference(data, asked, depths).collect()} == keys
    with pytest.raises(ValueError, match="depth"):
        expand.levels_of(spark.createDataFrame([("x", 6)], "source_key string, depth int"))


def test_pages_are_looked_up_by_rank(spark, tmp_path):
    path, table = str(tmp_path / "store"), str(tmp_path / "table one")
    rows = [(f"s{i % 37}", p, f'"{i}"', *source) for i in range(300) for p in ("p", "q") for source in ((1, "turtle"), (3, "sparql"))]
    rows += [("_:s0", "p", "s0"), ("s0", "p", '"0"@en'), ("s0", "p", '"0"^^int')]
    store.append(statements(spark, rows), path)
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        store.publish(spark, path, table)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    data, pattern = store.published(spark, table), Pattern(p=Term.iri(N + "p"))
    columns = paging.order_columns()
    every = [tuple(r) for r in paging.page(match.match(data, pattern), 10_000, 0).select(*columns).collect()]
    files = len(data.inputFiles())
    assert files > 6 and len(every) == 603
    for limit, offset in ((10, 0), (25, 280), (50, 290), (7, 540), (100, 600), (5, 603), (5, 9999), (0, 3)):
        got, total = store.ranked_page(spark, table, pattern, limit, offset)
        assert [tuple(r) for r in got.select(*columns).collect()] == every[offset : offset + limit], (limit, offset)
        assert total == 603
        # Only the files of the page are read.
        assert len(got.inputFiles()) <= 4 < files
    with pytest.raises(ValueError, match="predicate"):
        store.ranked_page(spark, table, Pattern(), 1, 0)
    # After a part was published again, ranks follow.
    store.replace(statements(spark, [("z", "p", '"z"', 3, "sparql")]), path, [N + "graph/3"])
    store.publish(spark, path, table, ["sparql:3"])
    got, total = store.ranked_page(spark, table, pattern, 5, 303)
    assert total == 304 and [r["s"] for r in got.collect()] == [N + "z"]


def test_a_bound_object_reads_few_row_groups(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    path, table = str(tmp_path / "store"), str(tmp_path / "table")
    rows = [(f"s{i}", f"p{i % 7}", f"o{i * 37 % 500}" if i % 2 else f'"{i}"') for i in range(2000)]
    store.append(statements(spark, rows), path)
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        store.publish(spark, path, table, by_object=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")

    def groups(folder, column, value):
        found = 0
        for file in glob.glob(f"{folder}/*/*.parquet"):
            meta = pq.ParquetFile(file).metadata
            for i in range(meta.num_row_groups):
                columns = {meta.row_group(i).column(k).path_in_schema: meta.row_group(i).column(k).statistics for k in range(meta.num_columns)}
                found += columns[column].min <= value <= columns[column].max
        return found

    for pattern in (Pattern(o=Term.iri(N + "o37")), Pattern(o=Term.text("44"), p=Term.iri(N + "p2"))):
        layout = store.for_pattern(spark, table, pattern)
        got = match.match(layout, pattern)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, match.match(store.published(spark, table), pattern).collect())) != []
        assert "EqualTo(o," in got._jdf.queryExecution().executedPlan().toString()
        assert groups(f"{table}.objects", "o", pattern.o.value) <= 2 < 4 <= groups(table, "o", pattern.o.value)
    both = Pattern(s=Term.iri(N + "s1"), o=Term.iri(N + "o37"))
    assert store.for_pattern(spark, table, both).inputFiles() == store.published(spark, table).inputFiles()
