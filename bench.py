"""Headline queries over a loaded store; prints one JSON line.

``BENCH_SF_DIR`` names the test tables, ``BENCH_CPUS`` the local cores and
``BENCH_RUNS`` the runs per query after one warm-up (the median is reported).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from fixtures import lift as L
from fixtures import queries as Q
from fixtures import tables as X
from rdfweave.model import Pattern, Term
from rdfweave.operators import expand, federate, match, paging
from rdfweave.operators.stage import new_folder
from rdfweave.sources import ntriples, store, turtle

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("rdfweave-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="rdfweave-bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    times: dict[str, float] = {}

    def timed(name: str, job, runs: int = RUNS, warm: bool = True) -> None:
        if warm:
            job()
        spent = []
        for _ in range(runs):
            start = time.perf_counter()
            job()
            spent.append(time.perf_counter() - start)
        times[name] = round(statistics.median(spent), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)

    def nation_link(table: str) -> Pattern:
        return Pattern(p=Term.iri(L.V + table))

    # From the tables, first run, lift included: comparable to the figures on record.
    lifted = match.default_graphs(L.lift(spark, SF_DIR))
    pattern = nation_link("nation")
    timed(
        "lift_expand3_count_first_run",
        lambda: expand.solution_counts(lifted, pattern, 3).collect(),
        runs=1,
        warm=False,
    )

    folder = new_folder(spark, "bench")
    timed("store_load", lambda: store.append(L.lift(spark, SF_DIR), folder), runs=1, warm=False)
    table = new_folder(spark, "published")
    timed("store_publish", lambda: store.publish(spark, folder, table), runs=1, warm=False)
    data = store.published(spark, table)
    names = nation_link("name")
    base = match.match(data, pattern)

    timed("count_predicate", lambda: expand.solution_counts(data, names).collect())
    timed("count_subject", lambda: expand.solution_counts(data, Pattern(s=Term.iri(L.NS + "nation/3"))).collect())
    timed("expand3_count", lambda: expand.solution_counts(data, pattern, 3).collect())
    timed("expand3_solutions", lambda: run(expand.expand(base, data, 3)))
    timed("expand3_construct", lambda: run(expand.construct(expand.expand(base, data, 3), 3)))
    timed("totals_by_source", lambda: run(federate.with_total(expand.solution_counts(data, names))))
    total = sum(row["solutions"] for row in expand.solution_counts(data, names).collect())

    def page_at(offset: int) -> None:
        counts = expand.solution_counts(data, names)
        rows, rest = federate.reaching(match.match(data, names), counts, 100, offset)
        run(paging.page(rows, 100, rest))

    timed("page_first", lambda: page_at(0))
    timed("page_at_90_percent", lambda: page_at(total * 9 // 10))
    timed("page_expanded", lambda: run(paging.expanded_page(base, data, 3, 100, 100)))

    variant = Pattern(s=Term.iri(L.NS.upper() + "customer/7"), hash_variants=True)
    timed("hash_variant_stored_key", lambda: run(match.match(data, variant)))
    timed("hash_variant_scan", lambda: run(match.match(data.drop("s_base"), variant)))

    requests = (
        L.table(spark, SF_DIR, "customer")
        .orderBy("c_custkey")
        .limit(1000)
        .select(
            F.col("c_custkey").alias("request_id"),
            F.concat(F.lit(L.NS + "customer/"), "c_custkey").alias("uri"),
        )
    )
    timed(
        "dereference_1000",
        lambda: run(federate.dereference(data, requests, Q.depths(spark))),
    )

    def round_trip() -> None:
        path = new_folder(spark, "lines")
        ntriples.write(store.read(spark, folder), path)
        run(ntriples.parse(ntriples.read_lines(spark, path), F.lit(1)))

    timed("ntriples_round_trip", round_trip, runs=1)
    timed("resource_map", lambda: run(Q.QUERIES["resource_map"](spark, SF_DIR)), runs=1)
    docs = X.frame(spark, SF_DIR, X.TURTLE)
    timed("turtle_documents", lambda: run(turtle.parse(docs, "body", "doc")), runs=1)
    graph = L.lift(spark, SF_DIR).filter(F.col("source_id") == 3)
    timed("replace_graph", lambda: store.replace(graph, folder, [L.graph(3)]))

    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
