"""Exact top-k inner products by one KD-tree per shard.

Vectors are dealt into shards by their ids. Each shard splits its points at medians of the
widest coordinate and keeps tight boxes. A query visits boxes best first, by the largest
product that any point of a box can have, and stops when that is less than its k-th best.
It first searches its own shard; the k-th score found there goes with it to all others, so
most of their boxes are never opened. Blocks of queries meet shards, one pair per task.
"""

from __future__ import annotations

import io
from heapq import heapify, heappop, heappush, heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.frames import written_table

#: Points of a shard and queries of a block, about, and points of a leaf at most.
SHARD_ROWS, BLOCK_ROWS, LEAF = 8_192, 4_096, 48
SCALE = 1024

HITS = "array<struct<vec_id bigint, score bigint, row bigint>>"
ARROW_HITS = pa.list_(pa.struct([("vec_id", pa.int64()), ("score", pa.int64()), ("row", pa.int64())]))


class Tree:
    """Points in leaf order with their ids and row numbers, and the nodes of a KD-tree with their boxes."""

    def __init__(self, ids, rows, points, low, high, start, stop, left, right):
        self.ids, self.rows, self.points, self.low, self.high = ids, rows, points, low, high
        self.start, self.stop, self.left, self.right = start, stop, left, right
        limit = float(np.abs(points).max(initial=0))
        self.limit = limit

    @classmethod
    def build(cls, ids: np.ndarray, rows: np.ndarray, points: np.ndarray) -> Tree:
        order = np.lexsort((rows, ids))
        nodes: list[list] = []  # start, stop, left, right

        def split(start: int, stop: int) -> int:
            number = len(nodes)
            nodes.append([start, stop, -1, -1])
            if stop - start > LEAF:
                mine = points[order[start:stop]]
                axis = int(np.argmax(mine.max(axis=0) - mine.min(axis=0))) if mine.shape[1] else 0
                half = (stop - start) // 2
                if mine.shape[1]:
                    order[start:stop] = order[start:stop][np.argpartition(mine[:, axis], half)]
                nodes[number][2] = split(start, start + half)
                nodes[number][3] = split(start + half, stop)
            return number

        split(0, len(ids))
        table = np.array(nodes, np.int64)
        sorted_points = points[order]
        low = np.stack([sorted_points[a:b].min(axis=0) for a, b, _, _ in nodes])
        high = np.stack([sorted_points[a:b].max(axis=0) for a, b, _, _ in nodes])
        return cls(ids[order], rows[order], sorted_points, low, high, *table.T)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, ids=self.ids, rows=self.rows, points=self.points, low=self.low, high=self.high, start=self.start, stop=self.stop, left=self.left, right=self.right)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Tree:
        with np.load(io.BytesIO(data)) as found:
            return cls(*(found[name] for name in ("ids", "rows", "points", "low", "high", "start", "stop", "left", "right")))

    def search(self, query: np.ndarray, own: int, k: int, least: int | None = None) -> list[tuple[int, int, int]]:
        """(score, id, row), best first, ties to the smaller id, then row, of points but the row ``own``.

        With ``least``, only points of at least this score: the k-th that is known elsewhere.
        """
        if len(query) != self.points.shape[1]:
            return []
        # products and sums of whole numbers are exact in doubles up to 2**53
        exact = float(np.abs(query).max(initial=0)) * self.limit * max(1, len(query)) < 2**53
        kind = np.float64 if exact else object
        ask = query.astype(kind)
        most = np.maximum(self.low.astype(kind) * ask, self.high.astype(kind) * ask).sum(axis=1).tolist()
        points = self._as(kind)
        heap: list[tuple[int, int, int]] = []  # the k best, the least first; ids and rows negative
        open_ = [(-most[0], 0)]
        heapify(open_)
        while open_:
            bound, node = heappop(open_)
            kth = heap[0][0] if len(heap) == k else least
            if kth is not None and -bound < kth:
                break
            if self.left[node] >= 0:
                for child in (int(self.left[node]), int(self.right[node])):
                    if kth is None or most[child] >= kth:
                        heappush(open_, (-most[child], child))
                continue
            a, b = self.start[node], self.stop[node]
            scores = points[a:b] @ ask
            for place in (np.flatnonzero(scores >= kth) if kth is not None else range(b - a)):
                row = int(self.rows[a + place])
                if row == own:
                    continue
                entry = (int(scores[place]), -int(self.ids[a + place]), -row)
                if len(heap) < k:
                    heappush(heap, entry)
                elif entry > heap[0]:
                    heapreplace(heap, entry)
        return [(score, -vec, -row) for score, vec, row in sorted(heap, reverse=True)]

    def _as(self, kind) -> np.ndarray:
        if not hasattr(self, "_cast") or self._cast.dtype != kind:
            self._cast = self.points.astype(kind)
        return self._cast


def _stack(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(lists), -1)


def _hits(found: list[tuple[int, int, int]]) -> list[dict]:
    return [{"vec_id": vec, "score": score, "row": row} for score, vec, row in found]


def top_inner_products(
    vectors: DataFrame, every: int, k: int, id_col: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score) of rows whose id is divisible by ``every``.

    Components x count as floor(1024 * x). Rows without id or vector, or with a null or
    non-finite component, take no part; nor do vectors of another length meet. A query meets all
    rows but itself: each of the rows that repeat an id is a candidate, and a query with ten
    hits of its own if the id is divisible. Other columns play no part; an empty table gives an
    empty table.
    """
    whole = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    fit = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector).isNotNull() & fit)
    points = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), whole.alias("v"))
    # rows are numbered once and for all in a stored table
    points = written_table(points.withColumn("row", F.monotonically_increasing_id()), "points")
    points = points.withColumn("size", F.size("v"))
    shards = 1 + points.count() // SHARD_ROWS
    points = points.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))

    def build(group: pa.Table) -> pa.Table:
        ids, numbers = group.column("vec_id").to_numpy(), group.column("row").to_numpy()
        mine = _stack(group.column("v"))
        tree = Tree.build(ids, numbers, mine)
        asked = np.flatnonzero(ids % every == 0)
        found = [tree.search(mine[at], int(numbers[at]), k) for at in asked]
        shard, size = group.column("shard")[0].as_py(), group.column("size")[0].as_py()
        n = len(asked)
        return pa.table(
            {
                "shard": pa.array([shard] * (n + 1), pa.int32()),
                "size": pa.array([size] * (n + 1), pa.int32()),
                "tree": pa.array([tree.dump(), *[None] * n], pa.binary()),
                "query_id": pa.array([None, *ids[asked].tolist()], pa.int64()),
                "query_row": pa.array([None, *numbers[asked].tolist()], pa.int64()),
                "v": pa.array([None, *mine[asked].tolist()], pa.list_(pa.int64())),
                "least": pa.array([None, *[f[-1][0] if len(f) == k else None for f in found]], pa.int64()),
                "hits": pa.array([None, *[_hits(f) for f in found]], ARROW_HITS),
            }
        )

    schema = f"shard int, size int, tree binary, query_id bigint, query_row bigint, v array<bigint>, least bigint, hits {HITS}"
    first = written_table(points.groupBy("size", "shard").applyInArrow(build, schema), "trees")
    queries = first.where("query_id is not null")
    blocks = 1 + queries.count() // BLOCK_ROWS
    queries = queries.withColumn("block", F.pmod(F.xxhash64("query_row"), F.lit(blocks)).cast("int"))
    trees = first.where("tree is not null").select(
        "size", "shard", "tree", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    )
    sent = queries.select(
        "size", F.col("shard").alias("home"), "query_id", "query_row", "v", "least", "block",
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
    ).where("shard != home")

    def search(tree_rows: pa.Table, asked: pa.Table) -> pa.Table:
        ids, numbers, hits = [], [], []
        if tree_rows.num_rows and asked.num_rows:
            tree = Tree.load(tree_rows.column("tree")[0].as_py())
            least = asked.column("least").to_pylist()
            keys = zip(asked.column("query_id").to_pylist(), asked.column("query_row").to_pylist(), strict=True)
            for (query_id, row), vec, bound in zip(keys, _stack(asked.column("v")), least, strict=True):
                ids.append(query_id)
                numbers.append(row)
                hits.append(_hits(tree.search(vec, row, k, bound)))
        return pa.table({"query_id": pa.array(ids, pa.int64()), "query_row": pa.array(numbers, pa.int64()), "hits": pa.array(hits, ARROW_HITS)})

    keys = ("size", "shard", "block")
    second = trees.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(
        search, f"query_id bigint, query_row bigint, hits {HITS}"
    )
    both = queries.select("query_id", "query_row", "hits").unionByName(second)
    found = both.select("query_id", "query_row", F.explode("hits").alias("hit")).select("query_id", "query_row", "hit.*")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def oracle(every: int, k: int) -> str:
    """The same by comparing all pairs of a query and a row."""
    return f"""
        WITH fit AS (
            SELECT row_number() OVER () AS number, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scores AS (
            SELECT q.number AS query, q.vec_id AS query_id, c.number, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM fit q JOIN fit c ON q.vec_id % {every} = 0 AND q.number <> c.number),
        ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id, number) AS INTEGER) AS rank
            FROM scores)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {k}"""
