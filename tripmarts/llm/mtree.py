"""Exact top-k search by inner product with M-trees.

Vectors of whole numbers are lifted by one coordinate onto a sphere of the largest norm, where the
Euclidean distance to a query falls as the inner product grows. Every shard of vectors becomes an
M-tree: pages of entries with a routing vector, a covering radius and the distance to the parent's
routing vector. Best-first search visits pages by their least possible distance; an entry whose
distance to the query cannot be small enough, by the triangle inequality over the stored distances,
is passed over without computing it. Scores of what remains are exact integers.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmarts.llm.common import count_of, kept

SCALE = 1024
K = 10
# Entries of a page, vectors of a tree and queries searched together.
PAGE = 256
SHARD_VECTORS = 8192
QUERY_BLOCK = 256
# Rounding error of distances that bounds allow for, relative to the lengths: that of squares is some 1e-15.
SLACK = 1e-6


class Tree:
    """An M-tree over lifted vectors, in arrays.

    Page p holds the entries ``first[p] : first[p + 1]``; an entry is a routing vector with a child
    page, or a vector with child -1. ``parent[e]`` is the distance to the routing vector of the
    entry's page, ``radius[e]`` covers everything below the entry.
    """

    def __init__(self, first, entry, child, parent, radius):
        self.first, self.entry, self.child, self.parent, self.radius = first, entry, child, parent, radius


def distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((points - centre) ** 2).sum(axis=1), 0.0))


def build(points: np.ndarray, page: int = PAGE) -> Tree:
    """Bulk load: vectors are dealt to far-apart routing vectors, page by page, from the root down."""
    pages: list[list[tuple[int, int, float, float]]] = []

    def load(members: np.ndarray, centre: int | None) -> tuple[int, float]:
        """Page number and covering radius around ``centre``."""
        number = len(pages)
        pages.append([])
        away = distances(points[members], points[centre]) if centre is not None else np.zeros(len(members))
        if len(members) <= page:
            pages[number] = [(int(m), -1, float(d), 0.0) for m, d in zip(members, away, strict=True)]
            return number, float(away.max(initial=0.0))
        # Routing vectors: each one the farthest from those before.
        chosen = [0]
        nearest = distances(points[members], points[members[0]])
        owner = np.zeros(len(members), np.int64)
        while len(chosen) < min(page, -(-len(members) // (page // 2))):
            at = int(nearest.argmax())
            if nearest[at] == 0:
                break
            to = distances(points[members], points[members[at]])
            owner[to < nearest] = len(chosen)
            nearest = np.minimum(nearest, to)
            chosen.append(at)
        if len(chosen) == 1 or np.bincount(owner).max() == len(members):
            # Equal vectors: nothing to route by, so they are dealt out evenly.
            owner = np.arange(len(members)) * min(page, -(-len(members) // page)) // len(members)
        entries = []
        for group in np.unique(owner):
            part = members[owner == group]
            route = members[chosen[group]] if group < len(chosen) and owner[chosen[group]] == group else part[0]
            below, radius = load(part, int(route))
            far = float(distances(points[[route]], points[centre])[0]) if centre is not None else 0.0
            entries.append((int(route), below, far, radius))
        pages[number] = entries
        return number, float(away.max(initial=0.0))

    load(np.arange(len(points)), None)
    flat = [entry for one in pages for entry in one]
    entry, child, parent, radius = (np.array(column) for column in zip(*flat, strict=True))
    first = np.concatenate([[0], np.cumsum([len(one) for one in pages])])
    return Tree(first, entry.astype(np.int64), child.astype(np.int64), parent.astype(float), radius.astype(float))


def search(tree: Tree, entries: np.ndarray, norm: float, query: np.ndarray, k: int, limit: float, slack: float) -> np.ndarray:
    """Vectors among which the k nearest within ``limit`` are, ties included.

    ``entries`` are the lifted vectors of the tree's entries, page by page; all have squared length ``norm``.
    """
    own = norm + float(query @ query)
    best: list[float] = []  # negated distances of the k nearest so far
    found: list[np.ndarray] = []
    waiting = [(0.0, 0, 0.0, False)]  # least distance, page, query to the page's routing vector, known
    while waiting:
        least, page, to_route, routed = heapq.heappop(waiting)
        reach = min(limit, -best[0] if len(best) == k else np.inf) + slack
        if least > reach:
            break
        at = np.arange(tree.first[page], tree.first[page + 1])
        if routed:
            # |d(query, route) - d(entry, route)| - radius is a lower bound that needs no distance.
            at = at[np.abs(to_route - tree.parent[at]) - tree.radius[at] <= reach]
            if not len(at):
                continue
        near = entries[at[0] : at[-1] + 1] if len(at) == at[-1] + 1 - at[0] else entries[at]
        away = np.sqrt(np.maximum(own - 2.0 * (near @ query), 0.0))
        leaf = tree.child[at] < 0
        for e, d in zip(at[~leaf].tolist(), away[~leaf].tolist(), strict=True):
            bound = max(0.0, d - tree.radius[e])
            if bound <= reach:
                heapq.heappush(waiting, (bound, int(tree.child[e]), d, True))
        near = leaf & (away <= reach)
        for d in away[near].tolist():
            if len(best) < k:
                heapq.heappush(best, -d)
            elif -d > best[0]:
                heapq.heapreplace(best, -d)
        if near.any():
            found.append(tree.entry[at[near]])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component; NULL for vectors with a component that is no finite number."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    sound = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(sound, F.transform(wide, lambda x: F.floor(x * scale).cast("long")))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy()
    return values.reshape(len(column), -1).astype(np.int64)


def _trees(norm: float, page: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, ids, rows = None, [], []

        def made():
            keys, whole = np.concatenate(ids), np.concatenate(rows)
            points = lifted(whole, norm)
            blob = pickle.dumps((keys, whole, build(points, page)), protocol=5)
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([blob], pa.binary())], ["shard", "tree"])

        for batch in batches:
            shards, keys, whole = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2))
            edges = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
            for a, b in zip(edges, edges[1:], strict=False):
                if shard is not None and shards[a] != shard:
                    yield made()
                    ids, rows = [], []
                shard = int(shards[a])
                ids.append(keys[a:b])
                rows.append(whole[a:b])
        if shard is not None:
            yield made()

    return run


def lifted(whole: np.ndarray, norm: float) -> np.ndarray:
    """Vectors on the sphere of squared radius ``norm``."""
    squares = (whole.astype(float) ** 2).sum(axis=1)
    return np.concatenate([whole.astype(float), np.sqrt(np.maximum(norm - squares, 0.0))[:, None]], axis=1)


FOUND = "query_id long, vec_id long, score long"


def _search_blocks(norm: float, k: int):
    """Arrow mapper over rows (shard, asks, blob), where a shard's tree comes before the query blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, entries = None, None
        for batch in batches:
            for n in range(batch.num_rows):
                blob = pickle.loads(batch.column("blob")[n].as_py())
                if not batch.column("asks")[n].as_py():
                    tree, entries = blob, lifted(blob[1], norm)[blob[2].entry]
                    continue
                keys, whole, pages = tree
                out = [[np.zeros(0, np.int64)] * 3]
                for query_id, vector, low in zip(*blob, strict=True):
                    # A score s is the squared distance |query|^2 + norm - 2 s.
                    own = float((vector.astype(float) ** 2).sum())
                    limit = np.sqrt(max(0.0, own + norm - 2 * low)) if np.isfinite(low) else np.inf
                    slack = SLACK * np.sqrt(norm + own + 1)
                    # One more, as the query itself may be among them.
                    near = search(pages, entries, norm, np.append(vector.astype(float), 0.0), k + 1, limit, slack)
                    near = near[keys[near] != query_id]
                    scores = whole[near] @ vector
                    order = np.lexsort((keys[near], -scores))[:k]
                    out.append((np.full(len(order), query_id), keys[near][order], scores[order]))
                columns = [np.concatenate(c) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    return run


def _gather(rows: pd.DataFrame) -> pd.DataFrame:
    """A block of queries as one blob."""
    blob = (rows["vec_id"].to_numpy(), np.stack(rows["whole"].to_numpy()), rows["low"].to_numpy(float))
    return pd.DataFrame({"block": [rows["block"].iloc[0]], "blob": [pickle.dumps(blob, protocol=5)]})


def top_k(
    vectors: DataFrame, queries: Column, *, key: str = "vec_id", vector: str = "embedding", k: int = K, scale: int = SCALE,
    page: int = PAGE, shard_vectors: int = SHARD_VECTORS, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest inner products of every query row.

    ``queries`` is a condition on ``vectors``. Components count as floor(scale * x). Rows with a
    NULL key or vector, or with a component that is NULL or not finite, take no part, nor do rows
    whose length is not the commonest one (the smallest of these). Candidates are all rows with
    another key; ties go to the smaller key. Repeated rows are candidates each. Fewer than k
    candidates give fewer ranks; an empty table gives none.

    Every shard's tree meets every block of queries, so a task holds one tree and one block. A first
    pass over one shard gives every query a score that its k-th best cannot fall below; it bounds
    the search in all shards.
    """
    rows = vectors.select(
        F.col(key).cast("long").alias("vec_id"), whole_numbers(F.col(vector), scale).alias("whole"), queries.alias("asks")
    ).filter("vec_id IS NOT NULL AND whole IS NOT NULL")
    sizes = rows.groupBy(F.size("whole").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    spark = vectors.sparkSession
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = kept(rows.filter(F.size("whole") == sizes[0]["size"]), "vectors")
    square = F.aggregate("whole", F.lit(0).cast("long"), lambda held, x: held + x * x)
    total = rows.agg(F.count("*").alias("n"), F.max(square).alias("norm")).first()
    norm = float(total["norm"])
    shards = count_of(total["n"], shard_vectors)
    # The shard is drawn by key, ties by vector: repeated vectors spread over all trees.
    dealt = rows.select(F.pmod(F.xxhash64("vec_id", "whole"), F.lit(shards)).cast("int").alias("shard"), "vec_id", "whole")
    dealt = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "vec_id", "whole")
    trees = kept(dealt.mapInArrow(_trees(norm, page), "shard int, tree binary"), "trees")
    asking = rows.filter("asks").select("vec_id", "whole")
    blocks = count_of(asking.count(), query_block)
    asking = asking.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))

    def searched(asked: DataFrame, every: Column) -> DataFrame:
        """Each block with the trees ``every`` names; trees and blocks of a shard meet in order."""
        packed = asked.groupBy("block").applyInPandas(_gather, "block int, blob binary")
        sent = packed.select(F.explode(every).alias("shard"), F.lit(True).alias("asks"), "blob")
        met = trees.select("shard", F.lit(False).alias("asks"), F.col("tree").alias("blob")).union(sent)
        met = met.repartition(shards, "shard").sortWithinPartitions("shard", "asks")
        return met.mapInArrow(_search_blocks(norm, k), FOUND)

    first = searched(asking.withColumn("low", F.lit(float("-inf"))), F.array(F.pmod("block", F.lit(shards)).cast("int")))
    lows = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("low")).filter(F.col("n") >= k)
    bounded = asking.join(lows.select(F.col("query_id").alias("vec_id"), "low"), "vec_id", "left")
    bounded = bounded.withColumn("low", F.coalesce("low", F.lit(float("-inf"))))
    found = searched(bounded, F.sequence(F.lit(0), F.lit(shards - 1)))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
