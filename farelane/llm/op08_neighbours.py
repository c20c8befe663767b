"""Approximate nearest neighbours: a vantage-point tree for each shard, pruned by a relaxed triangle inequality."""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelane.session import save_table

#: Vectors of a shard, queries that are searched together, and vectors of a leaf.
SHARD_ROWS, QUERY_ROWS, LEAF = 8192, 16_384, 128
#: How much more is pruned than the triangle inequality allows; 1 is exact. At 3 and more, vectors that
#: lie near few dimensions lose neighbours.
FACTOR = 2.0
_SLACK = 1e-9


def usable(vector: Column) -> Column:
    """Whether a vector has an angle: no null or non-finite component, and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class VantageTree:
    """A tree over unit vectors, whose distance is that of the chord, so that near means a small angle.

    Each inner node has a vantage point and the median distance ``mu`` to it, which parts its points.
    Points lie in the order of the leaves. ``nodes`` has (vantage, mu, inner, outer, first, last) for
    each node; leaves have no inner node.
    """

    def __init__(self, vectors: np.ndarray, seed: int = 0) -> None:
        self.points = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
        self.nodes: list[tuple[int, float, int, int, int, int]] = []
        self.order = np.arange(len(vectors))
        self._rng = np.random.default_rng(seed)
        if len(vectors):
            self._split(0, len(vectors))

    def _split(self, first: int, last: int) -> int:
        number = len(self.nodes)
        self.nodes.append((-1, 0.0, -1, -1, first, last))
        if last - first <= LEAF:
            return number
        own = self.order[first:last]
        # The point that is furthest from a random one lies at the edge, which parts the rest best.
        start = self.points[own[self._rng.integers(len(own))]]
        vantage = own[np.argmin(self.points[own] @ start)]
        distance = chord(self.points[own] @ self.points[vantage])
        by_distance = np.argsort(distance, kind="stable")
        self.order[first:last] = own[by_distance]
        middle = (last - first) // 2
        mu = float(distance[by_distance[middle]])
        inner = self._split(first, first + middle)
        outer = self._split(first + middle, last)
        self.nodes[number] = (int(vantage), mu, inner, outer, first, last)
        return number

    def search(self, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, point) of which each query's ``k`` nearest points found are a part.

        ``queries`` are unit vectors. A side is left out if it is further than the ``k``-th distance
        so far divided by ``factor``; points that tie with the ``k``-th within rounding stay.
        """
        self.visited = 0
        best = np.full((len(queries), k), -np.inf)
        pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        leaf_points = self.points[self.order] if self.nodes else self.points

        def scan(active: np.ndarray, first: int, last: int) -> None:
            self.visited += len(active) * (last - first)
            cosine = queries[active] @ leaf_points[first:last].T
            both = np.concatenate([best[active], cosine], axis=1)
            best[active] = -np.sort(-np.partition(both, both.shape[1] - k, axis=1)[:, -k:], axis=1)
            q, p = np.nonzero(cosine >= best[active][:, -1:] - _SLACK)
            pairs.append((active[q], self.order[first + p], cosine[q, p]))

        def near(active: np.ndarray, gap: np.ndarray) -> np.ndarray:
            return active[gap <= chord(best[active, -1]) / factor + _SLACK]

        def visit(number: int, active: np.ndarray) -> None:
            if not len(active):
                return
            vantage, mu, inner, outer, first, last = self.nodes[number]
            if inner < 0:
                return scan(active, first, last)
            distance = chord(queries[active] @ self.points[vantage])
            within = distance <= mu
            inside, outside = active[within], active[~within]
            visit(inner, inside)
            visit(outer, outside)
            visit(outer, near(inside, mu - distance[within]))
            visit(inner, near(outside, distance[~within] - mu))

        if self.nodes:
            visit(0, np.arange(len(queries)))
        if not pairs:
            return np.zeros(0, int), np.zeros(0, int)
        q, p, cosine = (np.concatenate(x) for x in zip(*pairs))
        keep = cosine >= best[q, -1] - _SLACK
        return q[keep], p[keep]


def chord(cosine: np.ndarray) -> np.ndarray:
    """The distance of unit vectors with that cosine; infinite if there is none yet."""
    return np.sqrt(np.maximum(2.0 - 2.0 * cosine, 0.0))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks()
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(values), -1) if len(values) else np.zeros((0, 0))


def build(table: pa.Table, k: int) -> bytes:
    """One shard's tree over its different vectors, each with its ``k + 1`` smallest ids.

    Copies would tie, so more of them can never be among the nearest, a query's own row included.
    """
    table = table.sort_by([("vec_id", "ascending"), ("row", "ascending")])
    vectors = _matrix(table["embedding"])
    different, number = np.unique(vectors, axis=0, return_inverse=True)
    number = number.reshape(-1)
    order = np.argsort(number, kind="stable")
    rank = np.arange(len(order)) - np.searchsorted(number[order], number[order])
    kept = order[rank <= k]
    starts = np.searchsorted(number[kept], np.arange(len(different) + 1))
    tree = VantageTree(different)
    out = io.BytesIO()
    np.savez(
        out,
        vectors=different,
        order=tree.order,
        nodes=np.array(tree.nodes),
        starts=starts,
        vec_id=table["vec_id"].to_numpy()[kept],
        row=table["row"].to_numpy()[kept],
    )
    return out.getvalue()


def nearest(blob: bytes, queries: pa.Table, k: int, factor: float) -> pa.Table:
    """The ``k`` nearest of one shard for each query, by cosine of the given vectors, then id."""
    saved = np.load(io.BytesIO(blob))
    vectors, starts = saved["vectors"], saved["starts"]
    tree = VantageTree(np.zeros((0, vectors.shape[1])))
    tree.points = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
    tree.order = saved["order"]
    tree.nodes = [(int(v), mu, int(i), int(o), int(a), int(b)) for v, mu, i, o, a, b in saved["nodes"].tolist()]
    given = _matrix(queries["embedding"])
    unit = given / np.sqrt((given * given).sum(axis=1))[:, None]
    # One more than asked for, since the query's own vector may be in the shard.
    q, p = tree.search(unit, k + 1, factor)
    length = lambda x: np.sqrt((x * x).sum(axis=1))
    score = (given[q] * vectors[p]).sum(axis=1) / (length(given)[q] * length(vectors)[p])
    copies = starts[p + 1] - starts[p]
    at = np.repeat(starts[p] - (np.cumsum(copies) - copies), copies) + np.arange(int(copies.sum()))
    q, score = np.repeat(q, copies), np.repeat(score, copies)
    vec_id, row = saved["vec_id"][at], saved["row"][at]
    other = row != queries["row"].to_numpy()[q]
    q, score, vec_id, row = q[other], score[other], vec_id[other], row[other]
    order = np.lexsort((row, vec_id, -score, q))
    q = q[order]
    order = order[np.arange(len(q)) - np.searchsorted(q, q) < k]
    q = np.sort(q)[np.arange(len(q)) - np.searchsorted(q, q) < k]
    return pa.table(
        {
            "query_row": queries["row"].to_numpy()[q],
            "query_id": queries["vec_id"].to_numpy()[q],
            "vec_id": vec_id[order],
            "row": row[order],
            "score": score[order],
        }
    )


def find_nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    factor: float = FACTOR,
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` nearest found for each query.

    The rows of ``vectors`` for which ``is_query`` (over ``vec_id``) holds are searched against all
    rows but their own. Rows are dealt out evenly to shards of about ``shard_rows``, and each shard
    builds one tree over all of its vectors. Queries come in blocks of about ``query_rows``; a block
    meets each shard in a task of its own, and the ``k`` best of all shards are ranked. With
    ``factor`` 1 the result is exact; a larger one leaves out more.

    Vectors that are null, zero, or hold null or non-finite components take no part; vectors of
    different lengths have no angle and don't meet; rows without an id take no part either. Repeated rows are rows of their own, as queries and as candidates. Equal scores
    go by the smaller id. An empty table, or one without queries, gives no row.
    """
    named = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].alias("embedding"))
    kept = named.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        "vec_id", "embedding", F.size("embedding").cast("long").alias("dim"), F.monotonically_increasing_id().alias("row")
    )
    kept = save_table(kept, "vectors")
    queries = kept.filter(is_query)
    n_rows, n_queries = kept.count(), queries.count()
    shards, blocks = max(1, -(-n_rows // shard_rows)), max(1, -(-n_queries // query_rows))
    # Rows are numbered in runs, one for each task that wrote them; a hash deals them out evenly.
    spread = F.xxhash64("row")
    sharded = kept.withColumn("shard", F.pmod(spread, F.lit(shards)))
    trees = sharded.groupBy("dim", "shard").applyInArrow(
        lambda key, table: pa.table({"dim": [key[0].as_py()], "shard": [key[1].as_py()], "tree": [build(table, k)]}),
        "dim long, shard long, tree binary",
    )
    trees = save_table(trees, "trees")
    blocked = queries.withColumn("block", F.pmod(spread, F.lit(blocks)))
    meet = blocked.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    spread_trees = trees.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    schema = "query_row long, query_id long, vec_id long, row long, score double"

    def search(tree: pa.Table, asked: pa.Table) -> pa.Table:
        if not tree.num_rows or not asked.num_rows:
            names = ["query_row", "query_id", "vec_id", "row"]
            return pa.table({**{n: pa.array([], pa.int64()) for n in names}, "score": pa.array([], pa.float64())})
        return nearest(tree["tree"][0].as_py(), asked, k, factor)

    key = ["dim", "shard", "block"]
    found = spread_trees.groupBy(*key).cogroup(meet.groupBy(*key)).applyInArrow(search, schema)
    ranked = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return (
        found.withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
