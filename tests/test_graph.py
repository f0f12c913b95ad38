import pytest

from skyledger.operators import graph
from skyledger.operators.cleaning import clean_flights
from skyledger.sources.star import raw_flights

EDGES = [(1, 2), (1, 2), (1, 3), (2, 3), (3, 1), (3, 4), (4, 5), (2, 5), (2, 5), (2, 5), (6, 1)]
RANKS = {"1": 1.124902, "2": 1.032053, "3": 0.932499, "4": 0.790567, "5": 1.726644, "6": 0.393335}


def edge_table(spark, pairs):
    return spark.createDataFrame([(str(a), str(b)) for a, b in pairs], "src string, dst string")


def ranks(df):
    return {r.id: r.pagerank for r in df.collect()}


def plain_pagerank(pairs, reset=0.15, iters=10):
    nodes = sorted({n for pair in pairs for n in pair})
    out = {n: sum(a == n for a, _ in pairs) for n in nodes}
    rank = dict.fromkeys(nodes, 1.0)
    for _ in range(iters):
        inflow = dict.fromkeys(nodes, 0.0)
        for a, b in pairs:
            inflow[b] += rank[a] / out[a]
        rank = {n: reset + (1 - reset) * inflow[n] for n in nodes}
    scale = len(nodes) / sum(rank.values())
    return {str(n): r * scale for n, r in rank.items()}


def test_golden_ranks(spark):
    assert ranks(graph.pagerank(edge_table(spark, EDGES))) == pytest.approx(RANKS, abs=1e-6)


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_broadcast_and_shuffle_joins_agree(spark, threshold):
    """Half of all edges leave one airport; some edges are loops or have a missing end."""
    pairs = [(0, i % 40) for i in range(300)] + [(i % 37, (i * 7) % 41) for i in range(300)]
    edges = edge_table(spark, pairs).unionAll(
        spark.createDataFrame([(None, "1"), ("1", None)], "src string, dst string"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        found = ranks(graph.pagerank(edges, iters=7, cut_every=3))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == pytest.approx(plain_pagerank(pairs, iters=7), abs=1e-9)


def test_no_edges(spark):
    assert graph.pagerank(edge_table(spark, []).limit(0)).collect() == []


def test_top_ranks_break_ties_by_code(spark):
    df = spark.createDataFrame([("B", 1.0), ("A", 1.0), ("C", 2.0)], "id string, pagerank double")
    assert [r.id for r in graph.top_airports_by_rank(df, 2).collect()] == ["C", "A"]


def test_graph_tables(spark, sf_dir):
    raw = raw_flights(spark, sf_dir)
    built = graph.flight_graph(raw)
    both = raw.select("ORIGIN").distinct().unionAll(raw.select("DEST").distinct())
    vertices = both.count()
    assert sorted(map(str, built.vertices.collect())) == sorted(
        str(r).replace("ORIGIN", "id") for r in both.collect())
    assert built.edges.count() == raw.count()
    assert dict(built.edges.dtypes) == {
        "src": "string", "dst": "string", "carrier": "string", "distance": "double",
        "departure_delay": "double", "arrival_delay": "double", "cancelled": "double",
        "diverted": "double"}
    assert {r.part: r.total for r in graph.graph_counts(raw).collect()} == {
        "vertices": vertices, "edges": raw.count()}


def test_counts_of_an_empty_graph(spark):
    empty = spark.createDataFrame([], "ORIGIN string, DEST string")
    assert {r.part: r.total for r in graph.graph_counts(empty).collect()} == {
        "vertices": 0, "edges": 0}


def test_edges_are_shuffled_once(spark, sf_dir, monkeypatch):
    """One exchange of the edges and one of the first ranks, whatever the number of rounds."""
    plans, write = [], graph.materialize

    def watched(df, name, *rest):
        if name == "ranks":
            df.collect()
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name, *rest)

    edges = graph.flight_edges(clean_flights(raw_flights(spark, sf_dir)))
    expected = {r.id: r.pagerank for r in graph.pagerank(edges).collect()}
    monkeypatch.setattr(graph, "materialize", watched)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = {r.id: r.pagerank for r in graph.pagerank(edges).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == pytest.approx(expected)
    final = plans[0].split("== Initial")[0].splitlines()
    by_source = [line for line in final if "Exchange hashpartitioning(src" in line]
    assert len(plans) == 1
    assert sum("ReusedExchange" not in line for line in by_source) == 2
    assert sum("ReusedExchange" in line for line in by_source) == 8

