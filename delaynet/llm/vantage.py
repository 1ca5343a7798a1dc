"""Nearest neighbours by inner product from vantage-point trees, one per shard.

Vectors get one more coordinate that brings all of them to the same length, so the
largest inner product is the smallest Euclidean distance and the triangle
inequality holds. A tree node keeps one vector and the ranges of distances from it
to its nearer and its farther half; a half is visited unless

    factor * (least distance that the triangle inequality allows) > distance of the k-th neighbour so far

With factor 1 the search is exact; larger factors skip more and may miss some.

Shards are dealt out by a hash of the id, so equal or similar vectors spread over all
of them, and every vector is in a tree. Queries travel in blocks to the shards, each
with the k-th distance over a small sample as its first bound, and each shard returns
its k nearest. Scores are inner products of the original vectors in double precision.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaynet.llm.common import map_batches
from delaynet.session import materialize

K = 20
FACTOR = 1.25
SHARD_ROWS = 8192  # vectors of a shard, about
BLOCK_ROWS = 2048  # queries of a block, about
LEAF = 256
SEED_ROWS = 1024  # vectors that first bounds come from
_SLACK = 1e-9  # above rounding, so that ties are never lost


@dataclass
class Tree:
    """Vectors in tree order. Node i covers rows begin[i] to end[i], the first of which is its vantage point."""

    ids: np.ndarray
    vectors: np.ndarray
    lift: np.ndarray  # the added coordinate
    begin: np.ndarray
    end: np.ndarray
    split: np.ndarray  # first row of the farther half; 0 at leaves
    near_node: np.ndarray
    far_node: np.ndarray
    bounds: np.ndarray  # least and greatest distance of the nearer half, then of the farther


def build(ids: np.ndarray, vectors: np.ndarray, top: float) -> Tree:
    """A tree over vectors whose norms are at most `top`."""
    lift = np.sqrt(np.maximum(top * top - (vectors * vectors).sum(axis=1), 0.0))
    order = np.arange(len(ids))
    nodes: list[list] = []
    waiting = [(0, len(ids), None)]
    while waiting:
        begin, end, parent = waiting.pop()
        number = len(nodes)
        if parent is not None:
            nodes[parent[0]][parent[1]] = number
        nodes.append([begin, end, 0, 0, 0, (0.0, 0.0, 0.0, 0.0)])
        if end - begin <= LEAF:
            continue
        rows = order[begin:end]
        middle = vectors[rows].mean(axis=0)  # the vantage point lies far from the middle
        at = int(((vectors[rows] - middle) ** 2).sum(axis=1).argmax())
        rows[[0, at]] = rows[[at, 0]]
        rest = rows[1:]
        apart = ((vectors[rest] - vectors[rows[0]]) ** 2).sum(axis=1) + (lift[rest] - lift[rows[0]]) ** 2
        distance = np.sqrt(np.maximum(apart, 0.0))
        by_distance = np.argsort(distance, kind="stable")
        rest, distance = rest[by_distance], distance[by_distance]
        half = len(rest) // 2
        order[begin:end] = np.r_[rows[0], rest]
        split = begin + 1 + half
        nodes[number][2] = split
        nodes[number][5] = (distance[0], distance[half - 1], distance[half], distance[-1])
        waiting += [(split, end, (number, 4)), (begin + 1, split, (number, 3))]
    begin, end, split, near, far, bounds = map(np.array, zip(*nodes)) if nodes else (np.zeros(0, int),) * 5 + (np.zeros((0, 4)),)
    return Tree(ids[order], vectors[order], lift[order], begin, end, split, near, far, bounds)


class Search:
    """The k nearest of a tree for a block of queries."""

    def __init__(self, tree: Tree, ids: np.ndarray, vectors: np.ndarray, first: np.ndarray, k: int, factor: float, top: float):
        self.tree, self.ids, self.vectors, self.k, self.factor = tree, ids, vectors, k, factor
        self.base = (vectors * vectors).sum(axis=1) + top * top
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.blur = 1e-7 * top  # distances come from differences of squares, which cancel
        self.least = first.copy()  # a vector below this score is not among the k nearest
        self.visited = 0

    def radius(self, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.base[rows] - 2 * (self.least[rows] - _SLACK), 0.0))

    def scan(self, rows: np.ndarray, begin: int, end: int) -> np.ndarray:
        """Offer tree rows to queries; their inner products."""
        products = self.vectors[rows] @ self.tree.vectors[begin:end].T
        self.visited += products.size
        which, column = np.divmod(np.flatnonzero(products >= (self.least[rows] - _SLACK)[:, None]), end - begin)
        other = self.ids[rows[which]] != self.tree.ids[begin + column]
        if other.any():
            self.offer(rows[which[other]], begin + column[other])
        return products

    def offer(self, rows: np.ndarray, at: np.ndarray) -> None:
        exact = (self.vectors[rows] * self.tree.vectors[at]).sum(axis=1)  # the same for equal vectors wherever they are
        query, inverse = np.unique(rows, return_inverse=True)
        owner = np.r_[np.repeat(np.arange(len(query)), self.k), inverse]
        scores = np.r_[self.scores[query].ravel(), exact]
        ids = np.r_[self.found[query].ravel(), self.tree.ids[at]]
        order = np.lexsort((ids, -scores, owner))
        owner, scores, ids = owner[order], scores[order], ids[order]
        starts = np.searchsorted(owner, np.arange(len(query)))
        place = np.arange(len(owner)) - starts[owner]
        kept = place < self.k
        self.scores[query[owner[kept]], place[kept]] = scores[kept]
        self.found[query[owner[kept]], place[kept]] = ids[kept]
        self.least[query] = np.maximum(self.least[query], self.scores[query, self.k - 1])

    def run(self) -> None:
        tree = self.tree
        stack: list[tuple] = [(0, np.arange(len(self.ids)), None)] if len(tree.ids) and len(self.ids) else []
        while stack:
            node, rows, below = stack.pop()
            if below is not None:  # the bound may have come closer since
                rows = rows[self.factor * (below - self.blur) <= self.radius(rows) + self.blur]
            if not len(rows):
                continue
            begin, end = int(tree.begin[node]), int(tree.end[node])
            if not tree.split[node]:
                self.scan(rows, begin, end)
                continue
            product = self.scan(rows, begin, begin + 1)[:, 0]
            # The added coordinate of a query is 0, so it does not enter the product.
            distance = np.sqrt(np.maximum(self.base[rows] - 2 * product, 0.0))
            low_near, high_near, low_far, high_far = tree.bounds[node]
            near_below = np.maximum(np.maximum(distance - high_near, low_near - distance), 0.0)
            far_below = np.maximum(np.maximum(low_far - distance, distance - high_far), 0.0)
            near_first = distance <= (high_near + low_far) / 2
            near, far = int(tree.near_node[node]), int(tree.far_node[node])
            # Last in, first out: each query's likelier half comes before its other one.
            for child, below, chosen in (
                (far, far_below, near_first), (near, near_below, ~near_first), (near, near_below, near_first), (far, far_below, ~near_first),
            ):
                if chosen.any():
                    stack.append((child, rows[chosen], below[chosen]))


def _packed(**arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _opened(content: bytes) -> dict:
    with np.load(io.BytesIO(content)) as arrays:
        return dict(arrays)


def _matrix(table: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors, by id and vector, without repeated rows."""
    ids = table.column("vec_id").to_numpy()
    vectors = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), size)
    order = np.lexsort((*vectors.T[::-1], ids))
    ids, vectors = ids[order], vectors[order]
    new = np.r_[True, (ids[1:] != ids[:-1]) | (vectors[1:] != vectors[:-1]).any(axis=1)]
    return ids[new], vectors[new]


def usable(embeddings: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """`vec_id, vector, size` of the rows that take part: an id, and finite components that are not all zero."""
    rows = embeddings.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = rows.filter(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    return rows.withColumn("size", F.size("vector"))


def without_repeats(rows: DataFrame) -> DataFrame:
    """Rows of `usable`, each id and vector once.

    Only rows of ids that occur more than once are compared, in a partial aggregate first, so a
    row with very many copies is one row per task.
    """
    repeated = materialize(rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("vec_id"), "repeated")
    if repeated.isEmpty():
        return rows
    folded = rows.join(repeated, "vec_id", "left_semi").dropDuplicates(["vec_id", "vector"])
    return materialize(rows.join(repeated, "vec_id", "left_anti").unionByName(folded), "vectors")


def nearest(
    embeddings: DataFrame, k: int = K, factor: float = FACTOR, every: int = 20, vec_id: str = "vec_id",
    embedding: str = "embedding", shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """`query_id, rank, vec_id, score`: the k nearest found of each id divisible by `every`, nearest first, ties to smaller ids.

    Vectors only meet those of their own length. Rows that repeat an id and vector
    count once; an id with several vectors is its own candidate in none of them,
    and as a query keeps the k best of all. Rows that are null, zero or not finite
    take no part. Other columns are not read, and no vectors give no rows.

    Shards, blocks and the sample of seeds follow a hash of id and vector, so an
    id with very many vectors is spread like any others.
    """
    spark = embeddings.sparkSession
    rows = without_repeats(materialize(usable(embeddings, vec_id, embedding), "vectors"))
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    asked = F.pmod("vec_id", F.lit(every)) == 0
    sizes = {  # one row per length of vectors
        r["size"]: (r["n"], r["asked"], float(np.sqrt(r["top"])) * (1 + 1e-12))
        for r in rows.groupBy("size").agg(F.count("*").alias("n"), F.sum(asked.cast("int")).alias("asked"), F.max(square).alias("top")).collect()
    }
    per_size = spark.createDataFrame(
        [(s, -(-n // shard_rows), max(1, -(-q // block_rows)), top, min(10**9, 10**9 * SEED_ROWS // n)) for s, (n, q, top) in sizes.items()],
        "size int, shards int, blocks int, top double, rate bigint",
    )
    placed = rows.join(F.broadcast(per_size), "size")
    place = F.xxhash64("vec_id", "vector")

    def planted(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        size, shard = key[0].as_py(), key[1].as_py()
        ids, vectors = _matrix(table, size)
        tree = build(ids, vectors, table.column("top")[0].as_py())
        return pa.table({"size": pa.array([size], pa.int32()), "shard": pa.array([shard], pa.int32()), "tree": pa.array([_packed(**vars(tree))], pa.binary())})

    def gathered(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        size, block = key[0].as_py(), key[1].as_py()
        ids, vectors = _matrix(table, size)
        top = table.column("top")[0].as_py()
        seeds = samples.value.get(size)
        first = np.full(len(ids), -np.inf)
        if seeds is not None:
            seed_ids, seed_vectors = seeds
            scores = np.where(ids[:, None] == seed_ids[None, :], -np.inf, vectors @ seed_vectors.T)
            if scores.shape[1] >= k:
                first = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k] - _SLACK
        content = _packed(ids=ids, vectors=vectors, first=first, top=np.array(top))
        return pa.table({"size": pa.array([size], pa.int32()), "block": pa.array([block], pa.int32()), "queries": pa.array([content], pa.binary())})

    # A small sample per length, whose k-th best score bounds the search from the start.
    drawn = placed.filter(F.pmod(place, F.lit(1_000_000_000)) < F.col("rate"))
    seeds: dict[int, list] = {}
    for r in drawn.select("size", "vec_id", "vector").collect():  # about SEED_ROWS rows per length
        seeds.setdefault(r["size"], []).append((r.vec_id, r.vector))
    samples = spark.sparkContext.broadcast(
        {s: (np.array([i for i, _ in vs]), np.array([v for _, v in vs])) for s, vs in
         ((s, sorted({(i, tuple(v)) for i, v in vs})) for s, vs in seeds.items())}
    )
    shard = F.pmod(place, F.col("shards")).cast("int").alias("shard")
    trees = placed.select("size", shard, "vec_id", "vector", "top").groupBy("size", "shard")
    trees = materialize(trees.applyInArrow(planted, "size int, shard int, tree binary"), "trees")
    block = F.pmod(F.xxhash64("vec_id", "vector", F.lit("block")), F.col("blocks")).cast("int").alias("block")
    blocks = placed.filter(asked).select("size", block, "vec_id", "vector", "top").groupBy("size", "block")
    blocks = materialize(blocks.applyInArrow(gathered, "size int, block int, queries binary"), "queries")
    sent = blocks.join(F.broadcast(per_size), "size").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))

    def search(batches):
        for batch in batches:
            for content, asked_for in zip(batch.column("tree"), batch.column("queries")):
                tree, block = Tree(**_opened(content.as_py())), _opened(asked_for.as_py())
                found = Search(tree, block["ids"], block["vectors"], block["first"], k, factor, float(block["top"]))
                found.run()
                real = np.isfinite(found.scores)
                columns = [np.broadcast_to(block["ids"][:, None], real.shape)[real], found.found[real], found.scores[real]]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["query_id", "vec_id", "score"])

    met = sent.select("size", "shard", "block", "queries").join(trees, ["size", "shard"]).select("queries", "tree")
    local = map_batches(met, search, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = local.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
