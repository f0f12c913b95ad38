"""Airport graph and PageRank."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.columns import to_double
from skyledger.session import materialize


@dataclass(frozen=True)
class FlightGraph:
    vertices: DataFrame
    edges: DataFrame


def _ends(df: DataFrame) -> DataFrame:
    """Origin (side 0) and destination (side 1) of every flight, in one pass."""
    ends = F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("ORIGIN").alias("id")),
        F.struct(F.lit(1).alias("side"), F.col("DEST").alias("id"))))
    return df.select(ends.alias("end")).select("end.side", "end.id")


def flight_vertices(df: DataFrame) -> DataFrame:
    """Distinct origins and distinct destinations, one list after the other.

    An airport on both sides appears twice, as in a union of two distinct lists.
    """
    return _ends(df).distinct().select("id")


def flight_edges(df: DataFrame) -> DataFrame:
    """One edge per flight; a missing number counts as 0."""
    return df.select(
        F.col("ORIGIN").alias("src"),
        F.col("DEST").alias("dst"),
        to_double("DISTANCE").alias("distance"),
        to_double("DEP_DELAY").alias("departure_delay"),
        to_double("ARR_DELAY").alias("arrival_delay"),
        F.col("OP_CARRIER").alias("carrier"),
        to_double("CANCELLED").alias("cancelled"),
        to_double("DIVERTED").alias("diverted"),
    ).na.fill(0)


def flight_graph(df: DataFrame) -> FlightGraph:
    return FlightGraph(flight_vertices(df), flight_edges(df))


def graph_counts(df: DataFrame) -> DataFrame:
    """Number of vertices (both sides counted) and of edges, from one pass."""
    airports = _ends(df).groupBy("side", "id").agg(F.count("*").alias("flights"))
    flights = F.sum(F.when(F.col("side") == 0, F.col("flights")).otherwise(0))
    totals = airports.agg(
        F.count("*").alias("vertices"), F.coalesce(flights, F.lit(0)).alias("edges"))
    return totals.unpivot([], ["vertices", "edges"], "part", "total")


def _weighted_edges(edges: DataFrame) -> DataFrame:
    """Parallel edges merged, each with the share of its source's rank that it carries.

    Every airport also gets an edge to itself with share 0, so that one join and one
    aggregate per round keep the airports nothing flies to.
    """
    merged = materialize(
        edges.filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
        .groupBy("src", "dst").agg(F.count("*").cast("double").alias("flights")), "routes")
    departures = merged.groupBy("src").agg(F.sum("flights").alias("departures"))
    shares = merged.join(departures, "src").select(
        "src", "dst", (F.col("flights") / F.col("departures")).alias("share"))
    airports = merged.select(F.explode(F.array("src", "dst")).alias("src")).distinct()
    return shares.unionByName(
        airports.select("src", F.col("src").alias("dst"), F.lit(0.0).alias("share")))


def pagerank(
    edges: DataFrame, reset: float = 0.15, iters: int = 10, cut_every: int = 10,
) -> DataFrame:
    """Rank of every airport (`id`, `pagerank`) after a fixed number of rounds.

    Ranks start at 1. Each round gives an airport `reset` plus `1 - reset` times the ranks
    flowing in over all parallel edges, and the last round is scaled so that the ranks sum
    to the number of airports.

    The merged edges are a written table, so Catalyst knows their size: a small network is
    broadcast once for all rounds, a large one is joined by shuffle, where AQE splits a
    source with very many edges. Ranks are written out every `cut_every` rounds, so the
    lineage stays short and a lost executor costs at most that many rounds. The edges are shuffled
    once for all rounds in between: ranks come out of a round partitioned by airport, as the next
    one needs them, and every round reads the same exchange of the edges.
    """
    flows = materialize(_weighted_edges(edges), "edges")
    ranks = flows.filter(F.col("share") == 0).select(
        F.col("src").alias("id"), F.lit(1.0).alias("pagerank"))
    for step in range(1, iters + 1):
        ranks = (
            flows.join(ranks, F.col("src") == F.col("id"))
            .groupBy("dst").agg(F.sum(F.col("pagerank") * F.col("share")).alias("inflow"))
            .select(F.col("dst").alias("id"),
                    (F.lit(reset) + (1 - reset) * F.col("inflow")).alias("pagerank")))
        if step % cut_every == 0 or step == iters:
            ranks = materialize(ranks, "ranks")
    total = ranks.agg(F.count("*").alias("n"), F.sum("pagerank").alias("mass")).first()
    scale = total["n"] / total["mass"] if total["n"] else 1.0
    return ranks.select("id", (F.col("pagerank") * scale).alias("pagerank"))


def top_airports_by_rank(ranks: DataFrame, k: int = 10) -> DataFrame:
    """The `k` highest ranks; equal ranks are ordered by airport code."""
    return ranks.orderBy(F.col("pagerank").desc(), "id").limit(k)
