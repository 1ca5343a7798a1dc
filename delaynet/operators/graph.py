"""Propagation network: vertices, edges, rank and components as DataFrame rounds.

`_links` numbers the vertices in name order and writes the edges once, in buckets
by their source. Every round is then one join and one grouped aggregate over
numbers, in which the edges stay where they lie and only states and messages move.
Each vertex also gets a link to itself that carries nothing, so a round keeps
vertices nobody sends to.

A vertex with very many out-edges would put all of them in one join task. Its
edges are spread over several salts and the one row of the vertex is repeated
for each. Messages to a vertex with very many in-edges are reduced inside the
sending tasks.

Edges go in as (origin, destination, weight). They are read several times, so
pass a written table when they are costly to compute.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaynet.session import bucketed, materialize

EDGES_PER_SALT = 1_000_000
VERTICES_PER_BUCKET = 1_000_000  # up to which a task holds the states of its bucket in a hash table


def graph_vertices(edges: DataFrame) -> DataFrame:
    return (
        edges.select(F.col("origin").alias("airport")).union(edges.select(F.col("destination").alias("airport"))).distinct()
    )


def graph_stats(edges: DataFrame) -> DataFrame:
    tallies = graph_vertices(edges).select(F.lit(1).alias("v"), F.lit(0).alias("e"))
    tallies = tallies.union(edges.select(F.lit(0), F.lit(1)))
    return tallies.agg(
        F.coalesce(F.sum("v"), F.lit(0)).alias("vertices"), F.coalesce(F.sum("e"), F.lit(0)).alias("edges")
    )


@dataclass
class _Links:
    vertices: DataFrame  # (airport, id, fanout)
    rows: DataFrame  # (src, salt, dst, share, fanout), fanout being that of dst
    salted: bool
    hashed: bool  # whether a bucket's states are few enough to look them up, so that links need no sort

    def with_source(self, state: DataFrame) -> DataFrame:
        """Links together with the state (id, fanout, ...) of their source."""
        state = state.withColumnRenamed("id", "src")
        if self.salted:
            state = state.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("fanout") - 1)))
        state = state.drop("fanout")
        if self.hashed:
            state = state.hint("shuffle_hash")
        return self.rows.join(state, ["src", "salt"] if self.salted else ["src"])


def _links(edges: DataFrame, weight: Column | None, per_salt: int, per_bucket: int = VERTICES_PER_BUCKET) -> _Links:
    amount = F.lit(1.0) if weight is None else weight.cast("double")
    plain = edges.select("origin", "destination", amount.alias("amount"))
    # both ends of every edge, so that one pass finds all vertices with their degrees
    ends = F.array(
        F.struct(F.col("origin").alias("airport"), F.lit(1).alias("out"), "amount"),
        F.struct(F.col("destination").alias("airport"), F.lit(0).alias("out"), F.lit(None).cast("double").alias("amount")),
    )
    degrees = plain.select(F.inline(ends)).groupBy("airport").agg(F.sum("out").alias("degree"), F.sum("amount").alias("total"))
    named = degrees.orderBy("airport")
    # written, as the numbers must be the same wherever they are used
    vertices = materialize(
        named.select(
            "airport",
            F.monotonically_increasing_id().alias("id"),
            F.greatest(F.ceil(F.col("degree") / per_salt), F.lit(1)).cast("int").alias("fanout"),
            "total",
        ),
        "vertices",
    )
    salted = not vertices.filter("fanout > 1").isEmpty()
    source = vertices.select(F.col("airport").alias("origin"), F.col("id").alias("src"), F.col("fanout").alias("spread"), "total")
    target = vertices.select(F.col("airport").alias("destination"), F.col("id").alias("dst"), "fanout")
    sending = (
        plain.join(source, "origin")
        .join(target, "destination")
        .select(
            "src",
            F.pmod(F.xxhash64("dst"), F.col("spread")).cast("int").alias("salt"),
            "dst",
            # a vertex whose edges all weigh nothing passes nothing on
            F.coalesce(F.try_divide("amount", "total"), F.lit(0.0)).alias("share"),
            "fanout",
        )
    )
    itself = vertices.select(
        F.col("id").alias("src"), F.lit(0).alias("salt"), F.col("id").alias("dst"), F.lit(0.0).alias("share"), "fanout"
    )
    keys = ("src", "salt") if salted else ("src",)
    buckets = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = vertices.count() <= buckets * per_bucket
    return _Links(vertices.drop("total"), bucketed(sending.unionByName(itself), "links", buckets, *keys), salted, hashed)


def pagerank(
    edges: DataFrame,
    iterations: int = 10,
    reset: float = 0.15,
    weight: Column | None = None,
    write_every: int = 5,
    per_salt: int = EDGES_PER_SALT,
) -> DataFrame:
    """Ranks after a fixed number of rounds, scaled to sum to the vertex count.

    Every vertex starts at 1 and passes its rank on in equal parts, or in
    proportion to `weight`. Ranks are written every few rounds, which keeps
    plans short and limits what a lost executor makes Spark repeat.
    """
    links = _links(edges, weight, per_salt)
    state = links.vertices.select("id", "fanout", F.lit(1.0).alias("rank"))
    for step in range(1, iterations + 1):
        received = F.sum(F.col("rank") * F.col("share"))
        state = (
            links.with_source(state)
            .groupBy(F.col("dst").alias("id"))
            .agg(
                F.max("fanout").alias("fanout"),
                (F.lit(reset) + F.lit(1.0 - reset) * received).alias("rank"),
            )
        )
        if step % write_every == 0 or step == iterations:
            state = materialize(state, "ranks")
    scale = state.agg(F.count(F.lit(1)) / F.sum("rank")).scalar()
    ranked = state.join(links.vertices.select("id", "airport"), "id")
    return ranked.select("airport", (F.col("rank") * scale).alias("pagerank"))


def connected_components(edges: DataFrame, per_salt: int = EDGES_PER_SALT, max_rounds: int = 100) -> DataFrame:
    """Every vertex with the smallest vertex of its undirected component.

    A round takes the smallest label among a vertex and its neighbours, then
    replaces each label by that label's own label. The second step halves the
    remaining distance, so long chains need few rounds as well.
    """
    both = edges.select("origin", "destination").union(edges.select("destination", "origin"))
    links = _links(both, None, per_salt)
    state = links.vertices.select("id", "fanout", F.col("id").alias("label"))
    for _ in range(max_rounds):
        lowest = materialize(
            links.with_source(state)
            .groupBy(F.col("dst").alias("id"))
            .agg(
                F.max("fanout").alias("fanout"),
                F.max(F.when(F.col("src") == F.col("dst"), F.col("label"))).alias("before"),
                F.min("label").alias("label"),
            ),
            "labels",
        )
        if lowest.filter("label < before").isEmpty():
            names = links.vertices.select("id", "airport")
            roots = links.vertices.select(F.col("id").alias("label"), F.col("airport").alias("component_id"))
            return lowest.join(names, "id").join(roots, "label").select("airport", "component_id")
        # only labels that are themselves relabelled need the second step
        moved = lowest.filter("id != label").select(F.col("id").alias("label"), F.col("label").alias("root"))
        state = lowest.join(moved, "label", "left").select("id", "fanout", F.coalesce("root", "label").alias("label"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def component_sizes(components: DataFrame) -> DataFrame:
    return components.groupBy("component_id").agg(F.count(F.lit(1)).alias("size"))


def top_hubs(ranks: DataFrame, k: int = 20) -> DataFrame:
    return ranks.orderBy(F.desc("pagerank"), "airport").limit(k)
