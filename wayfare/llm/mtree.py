"""Exact top-k by inner product with M-trees and best-first search.

Inner product becomes a distance by one more coordinate: with M the greatest norm in a tree, a
vector v is put at (v, sqrt(M^2 - |v|^2)) and a query q at (q, 0); then d(q, v)^2 = |q|^2 + M^2 - 2 q.v, so
the nearest vectors are those of the highest score. A tree is made of pages. A routing entry has an
object, the radius that covers all below it and its distance to the page's own routing object; a
leaf entry has a vector and that distance. Search takes the page with the least possible distance
first, and before any distance is computed the stored ones decide by the triangle inequality
whether it could matter. Scores are integers, so results and ties are exact.

All rows are dealt into trees of bounded size by a hash of their id, and queries into blocks; each
(tree, block) is one unit of work that gives each query's k best of the tree, and the k best of
all trees are merged. The queries of a block search a tree together: a page is opened once, for those it may matter to.

Defined cases: null vectors, those of no components and those holding a null, NaN or infinity take no
part, neither as query nor as candidate; rows with a null ``vec_id`` take no part; rows repeated under
one id are one vector, the smallest; only vectors of the query's length are its candidates;
scores must fit in 64 bits; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfare.llm.common import stored

LEAF, FANOUT = 64, 16
# Vectors in a tree: a thirty-second of all, within these bounds; queries in a block.
LEAST, MOST = 256, 32_768
BLOCK = 256


class Tree:
    """Pages over integer vectors; ``ids`` ascend, so of equal scores the first position wins."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order].astype(np.int64)
        norms = (self.vectors.astype(np.float64) ** 2).sum(1)
        self.top = float(norms.max())
        self.points = np.column_stack([self.vectors.astype(np.float64), np.sqrt(self.top - norms)])
        self.slack = 1e-7 * (1 + np.sqrt(self.top))
        self.pages: list[tuple] = []
        self.root = self.page(np.arange(len(ids)), None)
        del self.points  # distances to a query need the integers alone

    def far(self, at: np.ndarray, pivot: int) -> np.ndarray:
        return np.sqrt(((self.points[at] - self.points[pivot]) ** 2).sum(1))

    def page(self, at: np.ndarray, parent: int | None) -> int:
        if len(at) <= LEAF:
            page = (True, at, np.zeros(len(at)), self.far(at, parent) if parent is not None else None, None)
        else:
            # Pivots by farthest-first order; rows go to the nearest one.
            pivots, nearest = [int(at[0])], self.far(at, int(at[0]))
            owner = np.zeros(len(at), int)
            while len(pivots) < FANOUT and nearest.max() > 0:
                pivots.append(int(at[nearest.argmax()]))
                distance = self.far(at, pivots[-1])
                owner[distance < nearest] = len(pivots) - 1
                nearest = np.minimum(nearest, distance)
            groups = [at[owner == i] for i in range(len(pivots))]
            if len(groups) == 1:  # all at one place
                groups = np.array_split(at, FANOUT)
                pivots = [int(g[0]) for g in groups]
            groups, pivots = zip(*[(g, p) for g, p in zip(groups, pivots, strict=True) if len(g)], strict=True)
            radius = np.array([self.far(g, p).max() for g, p in zip(groups, pivots, strict=True)])
            pivot = np.array(pivots)
            page = (False, pivot, radius, self.far(pivot, parent) if parent is not None else None,
                    [self.page(g, p) for g, p in zip(groups, pivots, strict=True)])
        self.pages.append(page)
        return len(self.pages) - 1

    def search(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """The k best (score, id) of other ids, best first."""
        _, ids, scores = self.search_all(query[None], np.array([own]), k)
        return list(zip(scores.tolist(), ids.tolist(), strict=True))

    def search_all(self, queries: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of queries, ids and scores of the k best of other ids for each query, best first.

        A page is opened once for all the queries that it may matter to, so its entries meet them in one product of matrices.
        """
        queries = queries.astype(np.int64)
        norms = (queries.astype(np.float64) ** 2).sum(1)
        base = norms + self.top
        slack = self.slack + 1e-7 * np.sqrt(base)
        # No sum of products exceeds that of the norms: below 2^53 floating numbers hold it exactly.
        exact = norms.max() * self.top < 2.0 ** 104
        asked = queries.astype(np.float64) if exact else queries
        best = np.full((len(queries), k), np.iinfo(np.int64).min)
        best_id = np.full((len(queries), k), np.iinfo(np.int64).max)
        held = np.zeros(len(queries), np.int64)
        limit = np.full(len(queries), np.inf)
        queue: list[tuple] = [(0.0, 0, self.root, np.arange(len(queries)), None, np.zeros(len(queries)))]
        order = 0
        while queue:
            _, _, number, who, to_parent, bound = heapq.heappop(queue)
            still = bound <= limit[who]
            who = who[still]
            if not len(who):
                continue
            leaf, at, radius, stored_far, children = self.pages[number]
            open_ = np.ones((len(who), len(at)), bool)
            if to_parent is not None:
                open_ = np.abs(to_parent[still, None] - stored_far) - radius <= limit[who, None]
            entries, rows = np.flatnonzero(open_.any(0)), np.flatnonzero(open_.any(1))
            if not len(entries):
                continue
            who, open_ = who[rows], open_[np.ix_(rows, entries)]
            vectors = self.vectors[at[entries]]
            scores = asked[who] @ (vectors.astype(np.float64) if exact else vectors).T
            if leaf:
                scores, ids = scores.astype(np.int64), self.ids[at[entries]]
                better = ((scores >= best[who, -1:]) | (held[who, None] < k)) & (ids != own[who, None])
                rows, entries = np.flatnonzero(better.any(1)), np.flatnonzero(better.any(0))
                if not len(rows):
                    continue
                who, better = who[rows], better[np.ix_(rows, entries)]
                value = np.hstack([best[who], np.where(better, scores[np.ix_(rows, entries)], np.iinfo(np.int64).min)])
                name = np.hstack([best_id[who], np.where(better, ids[entries], np.iinfo(np.int64).max)])
                first = np.lexsort((name, ~value))[:, :k]
                best[who], best_id[who] = np.take_along_axis(value, first, 1), np.take_along_axis(name, first, 1)
                held[who] = np.minimum(k, held[who] + better.sum(1))
                full = who[held[who] == k]
                limit[full] = np.sqrt(np.maximum(0.0, base[full] - 2.0 * best[full, -1])) + slack[full]
                continue
            far = np.sqrt(np.maximum(0.0, base[who, None] - 2.0 * scores))
            bound = np.maximum(0.0, far - radius[entries])
            live = open_ & (bound <= limit[who, None])
            for i in np.flatnonzero(live.any(0)).tolist():
                order += 1
                own_rows = live[:, i]
                queue_bound = bound[own_rows, i]
                heapq.heappush(queue, (float(queue_bound.min()), order, children[entries[i]], who[own_rows], far[own_rows, i], queue_bound))
        found = np.arange(k) < held[:, None]
        return np.nonzero(found)[0], best_id[found], best[found]


def whole_vectors(rows: DataFrame, vector: str, scale: int, *others: str) -> DataFrame:
    """``vec_id, v array<long>`` and ``others`` of the rows that take part: each component x as floor(scale * x)."""
    x = F.col(vector)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & (F.size(x) > 0) & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"), *others)


def _unique(ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort([*vectors.T[::-1], ids])
    first = order[np.concatenate(([True], np.diff(ids[order]) != 0))]
    return ids[first], vectors[first]


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("vec_id").to_numpy()
    flat = table.column("v").combine_chunks().flatten().to_numpy()
    return ids, flat.reshape(len(ids), -1)


def top_k(rows: DataFrame, is_query: Column, k: int = 10, vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """``query_id, rank, vec_id, score``: for the rows in ``is_query``, the k best of all other rows.

    ``is_query`` is a condition on ``vec_id``.
    """
    taking = stored(whole_vectors(rows, vector, scale), "vectors")
    total, asking = taking.count(), taking.where(is_query).count()
    size = min(MOST, max(LEAST, total // 32))
    trees, blocks = max(1, -(-total // size)), max(1, -(-asking // BLOCK))

    def grow(key: tuple, table: pa.Table) -> pa.Table:
        tree = Tree(*_unique(*_matrix(table)))
        return pa.table({"tree": pa.array([key[0].as_py()], pa.int64()), "width": pa.array([key[1].as_py()], pa.int32()),
                         "pages": pa.array([pickle.dumps(tree, 5)], pa.binary())})

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        ids, found = _unique(*_matrix(table))
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "width": pa.array([key[1].as_py()], pa.int32()),
                         "asked": pa.array([pickle.dumps((ids, found), 5)], pa.binary())})

    # The id decides the tree, so rows repeated under an id meet in one.
    spread = taking.select("vec_id", "v", F.size("v").alias("width"),
                           F.pmod(F.xxhash64("vec_id"), F.lit(trees)).alias("tree"))
    forest = stored(spread.groupBy("tree", "width").applyInArrow(
        grow, "tree long, width int, pages binary"), "m-trees")
    asked = stored(taking.where(is_query).select(
        "vec_id", "v", F.size("v").alias("width"), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block")).groupBy(
            "block", "width").applyInArrow(gather, "block long, width int, asked binary"), "asked")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pages, block in zip(batch.column(0), batch.column(1), strict=True):
                tree: Tree = pickle.loads(pages.as_py())  # noqa: S301 - written above
                ids, queries = pickle.loads(block.as_py())  # noqa: S301
                place, found, scores = tree.search_all(queries, ids, k)
                if len(place):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (ids[place], found, scores)],
                                                     ["query_id", "vec_id", "score"])

    units = forest.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(
        asked, ["block", "width"]).select("pages", "asked", F.monotonically_increasing_id().alias("unit"))
    found = units.repartition(max(1, min(trees * blocks, 100_000)), "unit").select("pages", "asked").mapInArrow(
        search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
