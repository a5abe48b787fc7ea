"""Exact top-k search by integer inner product: ball trees with branch and bound.

Vectors are dealt by a hash of id and row number to shards of bounded size; each shard becomes a ball tree.
Queries are packed in blocks, and every block meets every tree. In a tree a query goes to the child with the
higher upper bound first and leaves out subtrees whose bound is below its current kth score. That score is
shared: the first tree's kth score goes with the block to all others.

Defined cases: rows without an id, without a vector, or with a null or non-finite component take no part;
vectors meet only those of their own length; rows with the query's id count as its own; other repeated
rows are candidates each; every query row has its own result, so rows that share an id have one each; ties go to
the smaller id; an empty table gives no rows; other columns are ignored. Scores must fit 64 bits.
"""

import io
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import in_small_batches, slices
from millrace.operators import fit_broadcast
from millrace.sources import stage

SCALE = 1024
SHARD_ROWS = 8_192
BLOCK_ROWS = 1_024
LEAF_ROWS = 64
EXACT = 2**53  # below this, sums of products in doubles are exact

TREE = "dim int, shard bigint, tree binary"
HITS_NAMES = ["query", "query_id", "vec_id", "score"]
HITS = ", ".join(f"{name} bigint" for name in HITS_NAMES)
HITS_STRUCT = ", ".join(f"{name}: bigint" for name in HITS_NAMES)


def integer_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, dim and the components as floor(SCALE * x), without rows that take no part."""
    whole = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = rows.where(F.col(vec_id).isNotNull() & F.coalesce(whole, F.lit(False)))
    floors = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * SCALE))
    return usable.select(F.col(vec_id).alias("vec_id"), F.size(vector).alias("dim"), floors.alias("v"))


def _pack(**arrays: np.ndarray) -> bytes:
    buffer = io.BytesIO()
    np.savez(buffer, **arrays)
    return buffer.getvalue()


def _unpack(blob: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(blob)) as arrays:
        return {name: arrays[name] for name in arrays.files}


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.int64).reshape(len(vectors), -1)


def build_tree(rows: pd.DataFrame) -> pd.DataFrame:
    """A ball tree over one shard, as arrays: rows in tree order, and per node its range, children and ball."""
    vectors, ids = _matrix(rows["v"]), rows["vec_id"].to_numpy()
    points = vectors.astype(np.float64)
    order = np.arange(len(rows))
    nodes: list[list[int]] = []  # start, end, left, right
    centers, radii = [], []
    pending = [(0, len(rows), -1, 0)]
    while pending:
        start, end, parent, side = pending.pop()
        number = len(nodes)
        nodes.append([start, end, -1, -1])
        if parent >= 0:
            nodes[parent][side] = number
        own = points[order[start:end]]
        center = own.mean(axis=0)
        away = np.sqrt(((own - center) ** 2).sum(axis=1))
        centers.append(center)
        radii.append(away.max())
        if end - start > LEAF_ROWS:
            far = own[away.argmax()]
            other = own[((own - far) ** 2).sum(axis=1).argmax()]
            middle = (end - start) // 2
            order[start:end] = order[start:end][np.argsort(own @ (other - far), kind="stable")]
            pending += [(start, start + middle, number, 2), (start + middle, end, number, 3)]
    tree = _pack(
        vectors=vectors[order], ids=ids[order], nodes=np.array(nodes), centers=np.array(centers), radii=np.array(radii)
    )
    return pd.DataFrame({"dim": [rows["dim"].iloc[0]], "shard": [rows["shard"].iloc[0]], "tree": [tree]})


class _Search:
    """The k best of a query block so far; `floor` is each query's current kth score, or less."""

    def __init__(self, queries: dict[str, np.ndarray], k: int):
        self.ids, self.vectors, self.k = queries["ids"], queries["vectors"], k
        self.points = self.vectors.astype(np.float64)
        self.lengths = np.sqrt((self.points**2).sum(axis=1))
        self.floor = queries["floors"].copy()
        self.hits: list[list[tuple[int, int]]] = [[] for _ in self.ids]  # (-score, vec_id), best first

    def run(self, tree: dict[str, np.ndarray]) -> None:
        self.tree = tree
        sizes = [int(np.abs(a).max()) if a.size else 0 for a in (self.vectors, tree["vectors"])]
        small = max(sizes) < EXACT and sizes[0] * sizes[1] * max(1, self.vectors.shape[1]) < EXACT
        self.sides = (self.points, tree["vectors"].astype(np.float64)) if small else (self.vectors, tree["vectors"])
        everyone = np.arange(len(self.ids))
        self._visit(0, everyone, self._bounds(0, everyone))

    def _bounds(self, node: int, who: np.ndarray) -> np.ndarray:
        """No score in the ball is higher; the last term covers rounding."""
        reach = self.points[who] @ self.tree["centers"][node], self.lengths[who] * self.tree["radii"][node]
        return reach[0] + reach[1] + 1 + 1e-9 * (np.abs(reach[0]) + reach[1])

    def _visit(self, node: int, who: np.ndarray, bounds: np.ndarray) -> None:
        who = who[bounds >= self.floor[who]]
        if not len(who):
            return
        start, end, left, right = self.tree["nodes"][node]
        if left < 0:
            self._scan(start, end, who)
            return
        to_left, to_right = self._bounds(left, who), self._bounds(right, who)
        first = to_left >= to_right
        self._visit(left, who[first], to_left[first])
        self._visit(right, who[~first], to_right[~first])
        self._visit(right, who[first], to_right[first])
        self._visit(left, who[~first], to_left[~first])

    def _scan(self, start: int, end: int, who: np.ndarray) -> None:
        queries, points = self.sides
        scores = queries[who] @ points[start:end].T
        ids = self.tree["ids"][start:end]
        good = (scores >= self.floor[who][:, None]) & (ids[None, :] != self.ids[who][:, None])
        for row in np.flatnonzero(good.any(axis=1)):
            query, at = who[row], np.flatnonzero(good[row])
            found = [*self.hits[query], *zip((-scores[row, at].astype(np.int64)).tolist(), ids[at].tolist())]
            self.hits[query] = sorted(found)[: self.k]
            if len(self.hits[query]) == self.k:
                self.floor[query] = max(self.floor[query], -self.hits[query][-1][0])


def _packed_queries(queries: DataFrame, blocks: int) -> DataFrame:
    """One row per block of queries: dim, block, queries. Blocks are dealt by the number of the query's row, so that
    neither repeated rows nor a frequent id make a block larger."""
    lowest = np.iinfo(np.int64).min

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        floors = np.full(len(rows), lowest, dtype=np.int64)
        numbers = rows["query"].to_numpy()
        packed = _pack(vectors=_matrix(rows["v"]), ids=rows["vec_id"].to_numpy(), numbers=numbers, floors=floors)
        return pd.DataFrame({"dim": [rows["dim"].iloc[0]], "block": [rows["block"].iloc[0]], "queries": [packed]})

    dealt = queries.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)))
    return dealt.groupBy("dim", "block").applyInPandas(pack, "dim int, block bigint, queries binary")


def _hits(search: _Search, numbers: np.ndarray) -> list[pa.Array]:
    found = [(int(n), int(q), v, -s) for n, q, best in zip(numbers, search.ids, search.hits) for s, v in best]
    return [pa.array(list(c), pa.int64()) for c in zip(*found)] or [pa.array([], pa.int64())] * 4


def _first_search(trees: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """Every block in the first tree of its length: the block with each query's kth score, and its hits. The trees, one
    a length, are broadcast if they are measured to fit."""
    first = trees.where(F.col("shard") == 0).select("dim", "tree")
    (small,) = fit_broadcast([first])
    met = blocks.join(F.broadcast(first) if small else first, "dim", "left").select("dim", "block", "queries", "tree")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 8):
            dims, numbers, packed, found = batch.column(0), batch.column(1), [], []
            for queries, tree in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                own = _unpack(queries)
                search = _Search(own, k)
                if tree is not None:
                    search.run(_unpack(tree))
                packed.append(_pack(**(own | {"floors": search.floor})))
                columns = _hits(search, own["numbers"])
                found.append([dict(zip(HITS_NAMES, row)) for row in zip(*(c.to_pylist() for c in columns))])
            hits = pa.array(found, pa.list_(pa.struct([(name, pa.int64()) for name in HITS_NAMES])))
            yield pa.RecordBatch.from_arrays([dims, numbers, pa.array(packed, pa.binary()), hits], ["dim", "block", "queries", "hits"])

    return in_small_batches(met).mapInArrow(run, f"dim int, block bigint, queries binary, hits array<struct<{HITS_STRUCT}>>")


def _search(trees: DataFrame, blocks: DataFrame, n_shards: int, k: int) -> DataFrame:
    """Every block in every tree but the first: the k best in each, for each query.

    A tree crosses the shuffle once and stays in its task, while the blocks, copied to every shard, come by behind it in
    small batches.
    """
    nothing = F.lit(None).cast("binary")
    each_shard = F.explode(F.sequence(F.lit(1), F.lit(n_shards - 1)).cast("array<bigint>"))
    own = trees.where(F.col("shard") > 0).select("dim", "shard", F.lit(-1).cast("bigint").alias("block"), "tree", nothing.alias("queries"))
    asked = blocks.select("dim", each_shard.alias("shard"), "block", nothing.alias("tree"), "queries")
    dealt = own.unionByName(asked).repartition(n_shards, "dim", "shard").sortWithinPartitions("dim", "shard", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, tree = None, None
        for batch in slices(batches, 8):
            for dim, shard, packed_tree, queries in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4))):
                if packed_tree is not None:
                    place, tree = (dim, shard), _unpack(packed_tree)
                elif (dim, shard) == place:  # else no vector of this length is in the shard
                    own = _unpack(queries)
                    search = _Search(own, k)
                    search.run(tree)
                    yield pa.RecordBatch.from_arrays(_hits(search, own["numbers"]), HITS_NAMES)

    return in_small_batches(dealt).mapInArrow(run, HITS)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank from 1, vec_id and score of each query's k best candidates; both from `integer_vectors`."""
    kept = stage(vectors.withColumn("row", F.monotonically_increasing_id()), "vectors")
    asked = stage(queries.withColumn("query", F.monotonically_increasing_id()), "queries")
    n_shards = max(1, ceil(kept.count() / SHARD_ROWS))
    n_blocks = max(1, ceil(asked.count() / BLOCK_ROWS))
    dealt = kept.withColumn("shard", F.pmod(F.xxhash64("vec_id", "row"), F.lit(n_shards)))
    trees = stage(dealt.groupBy("dim", "shard").applyInPandas(build_tree, TREE), "trees")
    known = stage(_first_search(trees, _packed_queries(asked, n_blocks), k), "hits")
    hits = known.select(F.explode("hits").alias("hit")).select("hit.*")
    if n_shards > 1:
        hits = hits.unionByName(_search(trees, known.drop("hits"), n_shards, k))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
