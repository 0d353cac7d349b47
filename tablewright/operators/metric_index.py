"""Exact nearest vectors through an index of cells and rings, stored as a table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewright.session import persist_to_shared

PIVOTS = 256  # cells at most; their centres are all that is sent to every task
SAMPLED_PER_PIVOT = 8  # vectors that the driver chooses each centre from
BLOCK_VECTORS, BLOCK_QUERIES = 2048, 256  # vectors that meet at a time
SLACK = 1e-9  # bounds give way by this share, so that rounding drops no neighbour


def _distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """A row of distances from every point to all of ``x``."""
    return np.stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in points])


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype("float64")


def _spread(points: np.ndarray, n: int) -> np.ndarray:
    """``n`` of the points, each the one that lies furthest from those before it."""
    chosen = [0]
    gap = _distances(points, points[:1])[0]
    while len(chosen) < min(n, len(points)):
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, _distances(points, points[chosen[-1:]])[0])
    return points[chosen]


class MetricIndex:
    """Vectors by cell (nearest centre) and by distance to its centre, packed into blocks of bounded size.

    A block is a ring of a cell: by the triangle inequality no vector in it is nearer to a query than the query's
    distance to the centre leaves open. A search meets one block per query first; the k-th distance found there
    decides which other blocks can still hold a nearer vector, and only these are met. Results are exact
    for any data; how much is left out depends on how well the vectors cluster.

    Vectors are dealt by ranges of (cell, distance, key), so a cell with most rows, or one vector that is repeated,
    fills many blocks in many tasks. Null vectors are left out; all others have one length. Keys and query ids are
    integers, and a query id names one query.
    """

    def __init__(self, blocks: DataFrame | None, centres: np.ndarray, key: str) -> None:
        self.blocks, self.centres, self.key = blocks, centres, key

    @classmethod
    def build(cls, vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", pivots: int = PIVOTS) -> MetricIndex:
        rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v")).where("v IS NOT NULL")
        # a cell is worth having if it fills a block; beyond ``pivots`` cells have more rings instead
        pivots = min(pivots, -(-vectors.select(key).count() // BLOCK_VECTORS))
        some = rows.orderBy(F.xxhash64("v", "id"), "id").limit(pivots * SAMPLED_PER_PIVOT).select("v").collect()
        if not some:
            return cls(None, np.empty((0, 0)), key)
        centres = _spread(np.unique(np.array([r.v for r in some], "float64"), axis=0), pivots)

        def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    far = _distances(_stack(batch["v"]), centres)
                    yield batch.assign(cell=far.argmin(axis=0), ring=far.min(axis=0))

        def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            name = TaskContext.get().partitionId() << 32
            held = pd.DataFrame()
            for batch in batches:
                held = pd.concat([held, batch], ignore_index=True)
                whole = held["cell"].iloc[-1] if len(held) else None
                for cell, part in held.groupby("cell", sort=True):
                    full = len(part) if cell != whole else len(part) // BLOCK_VECTORS * BLOCK_VECTORS
                    for lo in range(0, full, BLOCK_VECTORS):
                        yield block(name, cell, part.iloc[lo : min(lo + BLOCK_VECTORS, full)])
                        name += 1
                    held = part.iloc[full:]
            if len(held):
                yield block(name, held["cell"].iloc[0], held)

        def block(name: int, cell: int, part: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({
                "block": [name], "cell": [cell], "n": [len(part)], "inner": [part["ring"].min()], "outer": [part["ring"].max()],
                "ids": [part["id"].to_numpy("int64").tobytes()], "points": [_stack(part["v"]).tobytes()],
            })

        dealt = rows.mapInPandas(assign, "id bigint, v array<double>, cell int, ring double")
        dealt = dealt.repartitionByRange("cell", "ring", "id").sortWithinPartitions("cell", "ring", "id")
        packed = dealt.mapInPandas(pack, "block bigint, cell int, n bigint, inner double, outer double, ids binary, points binary")
        return cls(persist_to_shared(packed, "metric-index"), centres, key)

    def _reach(self, queries: DataFrame, k: int) -> DataFrame:
        """``(query_id, vector, block, nearest)``: the blocks that cells alone do not rule out, and how near their vectors may be."""
        cells = self.blocks.groupBy("cell").agg(F.sum("n").alias("n"), F.min("inner").alias("inner"), F.max("outer").alias("outer"))
        shape = cells.orderBy("cell").collect()  # a row per cell
        names, sizes = np.array([r.cell for r in shape]), np.array([r.n for r in shape])
        inner, outer = np.array([r.inner for r in shape]), np.array([r.outer for r in shape])
        centres = self.centres[names]

        def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for row in batch.itertuples(index=False):
                    far = _distances(centres, np.asarray(row.vector, "float64")[None, :])[0]
                    order = np.argsort(far + outer)  # the first cells that hold k vectors bound the k-th distance
                    enough = min(np.searchsorted(np.cumsum(sizes[order]), k), len(order) - 1)
                    limit = (far + outer)[order[enough]] if sizes.sum() >= k else np.inf
                    low = np.maximum(np.maximum(far - outer, inner - far), 0)
                    near = np.flatnonzero(low <= limit * (1 + SLACK) + SLACK * (far + outer))
                    yield pd.DataFrame({
                        "query_id": row.query_id, "vector": [row.vector] * len(near), "cell": names[near], "far": far[near], "limit": limit,
                    })

        asked = queries.select(F.col("query_id").cast("bigint").alias("query_id"), F.col("vector").cast("array<double>").alias("vector"))
        visits = asked.where("vector IS NOT NULL").mapInPandas(visit, "query_id bigint, vector array<double>, cell int, far double, limit double")
        nearest = F.greatest(F.col("far") - F.col("outer"), F.col("inner") - F.col("far"), F.lit(0.0))
        rounding = SLACK * (F.col("far") + F.col("outer"))
        met = visits.join(self.blocks.select("cell", "block", "inner", "outer"), "cell")
        return met.withColumn("nearest", nearest - rounding).where(F.col("nearest") <= F.col("limit") * (1 + SLACK)).select(
            "query_id", "vector", "block", "nearest"
        )

    def _meet(self, pairs: DataFrame, k: int) -> DataFrame:
        """The k best of each (query, block) pair. Queries of a block come to it in arrays of bounded size."""
        key = self.key

        def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for name, part in batch.groupby("block", sort=False):
                    for lo in range(0, len(part), BLOCK_QUERIES):
                        some = part.iloc[lo : lo + BLOCK_QUERIES]
                        yield pd.DataFrame({
                            "block": [name], "q_ids": [some["query_id"].to_numpy("int64").tobytes()], "q_points": [_stack(some["vector"]).tobytes()],
                        })

        def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for row in batch.itertuples(index=False):
                    ids, names = np.frombuffer(row.ids, "int64"), np.frombuffer(row.q_ids, "int64")
                    x = np.frombuffer(row.points, "float64").reshape(len(ids), -1)
                    d = _distances(x, np.frombuffer(row.q_points, "float64").reshape(len(names), -1))
                    order = np.lexsort((np.broadcast_to(ids, d.shape), d), axis=1)[:, :k]
                    yield pd.DataFrame({
                        "query_id": np.repeat(names, order.shape[1]), key: ids[order].ravel(), "distance": np.take_along_axis(d, order, 1).ravel(),
                    })

        dealt = pairs.select("block", "query_id", "vector").repartitionByRange("block", "query_id").sortWithinPartitions("block", "query_id")
        groups = dealt.mapInPandas(gather, "block bigint, q_ids binary, q_points binary")
        met = groups.join(self.blocks.select("block", "ids", "points"), "block")
        return _ranked(met.mapInPandas(best, f"query_id bigint, {key} bigint, distance double"), k, key)

    def plan(self, queries: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
        """The first block of every query with its k best, and the other blocks that each query has to meet."""
        reach = persist_to_shared(self._reach(queries, k), "reach")
        first = reach.groupBy("query_id").agg(F.min_by("block", F.struct("nearest", "block")).alias("home"))
        tagged = reach.join(first, "query_id")
        found = persist_to_shared(self._meet(tagged.where("block = home"), k), "first-block")
        kth = found.where(F.col("rank") == k).select("query_id", F.col("distance").alias("kth"))
        others = tagged.where("block <> home").join(kth, "query_id", "left")
        return found, others.where(F.col("kth").isNull() | (F.col("nearest") <= F.col("kth") * (1 + SLACK)))

    def search(self, queries: DataFrame, k: int = 4) -> DataFrame:
        """``(query_id, rank, key, distance)``: the k nearest to each row of ``queries`` (query_id, vector); ties by key."""
        if self.blocks is None:
            return queries.sparkSession.createDataFrame([], f"query_id bigint, rank int, {self.key} bigint, distance double")
        found, others = self.plan(queries, k)
        both = found.drop("rank").unionByName(self._meet(others, k).drop("rank"))
        return _ranked(both, k, self.key).select("query_id", "rank", self.key, "distance")

    def meetings(self, queries: DataFrame, k: int = 4) -> DataFrame:
        """One row: the (query, block) pairs that a search meets, and how many a nested loop would."""
        found, others = self.plan(queries, k)
        asked = found.select("query_id").distinct()
        return others.agg(F.count(F.lit(1)).alias("n")).crossJoin(asked.agg(F.count(F.lit(1)).alias("q"))).crossJoin(
            self.blocks.agg(F.count(F.lit(1)).alias("b"))
        ).select((F.col("n") + F.col("q")).alias("met"), (F.col("q") * F.col("b")).alias("all_pairs"))


def _ranked(rows: DataFrame, k: int, key: str) -> DataFrame:
    # row_number <= k is also applied before the exchange, so a task sends k rows per query
    order = Window.partitionBy("query_id").orderBy("distance", key)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
