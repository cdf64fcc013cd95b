"""Approximate nearest neighbours by counting collisions in query-centred windows.

A number of random projections map unit vectors to a line each; on a line, a block of rows is a sorted
array. Two vectors s apart collide in a window of half-width h around the query with probability 2 * Phi(h / s) - 1,
so that rows within a radius R collide in most windows of half-width WIDTH * R / 2, and far ones in fewer. The search
starts at a small radius and rehashes virtually: a larger radius widens the windows in the same arrays, and only the
rows that enter are counted. A row whose collisions reach the threshold is verified by its exact cosine. Once k are
found, the windows widen a last time, to the distance of the k-th; the search of a block ends there, for every row that is at least as
near has then reached the threshold with probability 1 - MISS or more. Nothing caps the rows to verify. Beyond the
largest distance of unit vectors all rows that are left are verified, so that a block is never answered in part.

Rows are dealt over blocks and queries over groups by a number of their own, whatever their ids and vectors. Each query first searches
one block; the distance of the k-th row found there is the radius at which it looks into every other block, by one widening. Each
block of rows meets each group of queries in a task of bounded size, and leaves k rows a query.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part, nor rows without an id; a
query meets every other row, rows that share its id excepted; a query id that repeats is answered once, by its largest
vector; rows that repeat are candidates each; shorter vectors are filled up with zeros; ties of equal cosines go to the smaller id;
fewer than k candidates give as many rows; an empty table gives no rows; columns other than id and vector take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import scratch_folder, written
from .knn import matrix

PROJECTIONS = 192
WIDTH = 2.719
MISS = 0.002
FIRST_RADIUS = 0.05
GROWTH = 1.3
GROUP_QUERIES = 2_048
BLOCK_ROWS = 16_384
TILE = 128
LONGEST = 2.0
NEAR = 1e-7
SINGLE = 1e-4
FOUND = "query_id long, vec_id long, score double"


def threshold(projections: int, miss: float) -> int:
    """The largest number of collisions that rows at the radius itself reach with probability 1 - miss."""
    p = erf(WIDTH / 2 / sqrt(2))
    below = 0.0
    for n in range(projections + 1):
        below += comb(projections, n) * p**n * (1 - p) ** (projections - n)
        if below > miss:
            return n
    return projections


def radii() -> np.ndarray:
    steps = [FIRST_RADIUS]
    while steps[-1] <= LONGEST:
        steps.append(steps[-1] * GROWTH)
    return np.array(steps)


def directions(width: int, projections: int, seed: int = 17) -> np.ndarray:
    return np.random.Generator(np.random.Philox(seed)).standard_normal((width, projections))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, which changes no cosine, so that squares neither overflow nor vanish."""
    _, exponent = np.frexp(np.abs(x).max(axis=1, initial=0.0))
    return np.ldexp(x, -exponent[:, None])


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosines of one vector with rows; equal rows have equal ones in whatever block they stand."""
    both = (x * q).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (q * q).sum())
    return np.clip(both, -1.0, 1.0)


class Windows:
    """The sorted arrays of a block of rows, one for each projection."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, projections: int, miss: float):
        self.x, self.ids = x, ids
        self.least = threshold(projections, miss)
        self.lines = directions(x.shape[1], projections)
        self.short = self.units(x).astype(np.float32)
        at = self.projected(x)
        self.order = np.ascontiguousarray(np.argsort(at, axis=0, kind="stable").T)
        self.line = np.ascontiguousarray(np.sort(at, axis=0).T)

    def units(self, x: np.ndarray) -> np.ndarray:
        return x / np.sqrt((x * x).sum(axis=1))[:, None]

    def projected(self, x: np.ndarray) -> np.ndarray:
        return np.einsum("ij,jk->ik", self.units(x), self.lines)  # the same sums for equal rows, unlike a blocked product

    def bounds(self, centre: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the windows begin and end: for each projection (a row of `centre`) and query, of the half-widths given."""
        begin = [np.searchsorted(line, c - half, side="left") for line, c in zip(self.line, centre)]
        end = [np.searchsorted(line, c + half, side="right") for line, c in zip(self.line, centre)]
        return np.stack(begin, axis=-1), np.stack(end, axis=-1)

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, reach: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
        """Per query its number, the positions of its k best rows, their cosines, and how many rows were verified.

        `reach` has for each query the distance within which k rows are known elsewhere, infinite if there are none.
        """
        steps = radii()
        known = np.full(len(queries), np.inf) if reach is None else reach * (1 + NEAR) + NEAR
        for low in range(0, len(queries), TILE):
            part, rows = queries[low : low + TILE], np.arange(low, min(low + TILE, len(queries)))
            centre = self.projected(part).T
            near = np.flatnonzero(np.isfinite(known[rows]))
            begin, end = self.bounds(centre[:, near], WIDTH * known[rows[near]] / 2)
            for j, i in enumerate(near.tolist()):
                at = self.within(own[rows[i]], begin[j], end[j])
                yield (int(rows[i]), *self.best(part[i], at, self.similar(part[i], at), k))
            far = np.setdiff1d(np.arange(len(part)), near)
            begin, end = self.bounds(centre[:, far, None], WIDTH * steps / 2)
            for j, i in enumerate(far.tolist()):
                yield (int(rows[i]), *self.widening(part[i], own[rows[i]], k, steps, centre[:, i], begin[j], end[j]))

    def within(self, own: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Rows whose collisions in these windows reach the threshold. Of each array the smaller side of the edges is counted."""
        n = len(self.ids)
        spans = list(zip(begin.tolist(), end.tolist()))
        inside = [self.order[i, s:e] for i, (s, e) in enumerate(spans) if 2 * (e - s) <= n]
        outside = [x for i, (s, e) in enumerate(spans) if 2 * (e - s) > n for x in (self.order[i, :s], self.order[i, e:])]
        counts = np.full(n, len(outside) // 2)
        for sign, held in ((1, inside), (-1, outside)):
            if held:
                counts += sign * np.bincount(np.concatenate(held), minlength=n)
        return np.flatnonzero((counts >= self.least) & (self.ids != own))

    def widening(self, q: np.ndarray, own: int, k: int, steps: np.ndarray, centre: np.ndarray, begin: np.ndarray,
                 end: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        counts = np.zeros(len(self.ids), dtype=np.int64)
        waiting = self.ids != own
        found, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.float32)
        a = b = np.array([np.searchsorted(line, c) for line, c in zip(self.line, centre)])

        def take(rows: np.ndarray) -> None:
            nonlocal found, scores
            waiting[rows] = False
            found, scores = np.concatenate([found, rows]), np.concatenate([scores, self.similar(q, rows)])

        def widen(low: np.ndarray, high: np.ndarray) -> None:
            nonlocal a, b
            low, high = np.minimum(low, a), np.maximum(high, b)
            fresh = [self.order[i, s:e] for i, (s, e) in enumerate(zip(low.tolist(), a.tolist())) if s < e]
            fresh += [self.order[i, s:e] for i, (s, e) in enumerate(zip(b.tolist(), high.tolist())) if s < e]
            a, b = low, high
            if fresh:
                counts[:] += np.bincount(np.concatenate(fresh), minlength=len(counts))
                take(np.flatnonzero(waiting & (counts >= self.least)))

        for step, radius in enumerate(steps):
            widen(begin[step], end[step])
            if len(scores) >= k:
                kth = self.best(q, found, scores, k)[1][-1]
                last = sqrt(max(0.0, 2 - 2 * kth)) * (1 + NEAR) + NEAR
                if last > radius:
                    low, high = self.bounds(centre[:, None], np.array([WIDTH * last / 2]))
                    widen(low[0], high[0])
                break
        else:
            take(np.flatnonzero(waiting))
        return self.best(q, found, scores, k)

    def similar(self, q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Cosines in single precision, to choose the rows whose exact cosines decide."""
        return self.short[rows] @ self.units(q[None])[0].astype(np.float32)

    def best(self, q: np.ndarray, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        verified = len(rows)
        if verified > k:
            rows = rows[scores >= np.partition(scores, verified - k)[verified - k] - SINGLE]
        exact = cosines(q, self.x[rows])
        order = np.lexsort((self.ids[rows], -exact))[:k]
        return rows[order], exact[order], verified


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, v): rows with an id and a vector that has a direction."""
    x = F.col(f"`{vector}`")
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf"))
    return (
        df.where(x.isNotNull() & F.col(f"`{key}`").isNotNull()).where(~F.exists(x, odd)).where(F.exists(x, lambda c: c != 0))
        .select(F.col(f"`{key}`").cast("long").alias("vec_id"), x.cast("array<double>").alias("v"))
    )


def nearest_neighbours(df: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding",
                       projections: int = PROJECTIONS, miss: float = MISS, group_queries: int = GROUP_QUERIES,
                       block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of `queries` the k rows of `df` with the largest cosines found."""
    spark = df.sparkSession
    folder = scratch_folder(spark, "collisions")
    own = F.xxhash64(F.spark_partition_id(), F.monotonically_increasing_id())
    data = written(usable(df, key, vector).withColumn("own", own), f"{folder}/data")
    asked = usable(queries, key, vector).groupBy("vec_id").agg(F.max("v").alias("v"))
    asked = written(asked.select(F.col("vec_id").alias("query_id"), "v"), f"{folder}/queries")
    rows, longest = data.agg(F.count("*"), F.max(F.size("v"))).first()
    asks, q_longest = asked.agg(F.count("*"), F.max(F.size("v"))).first()
    if not rows or not asks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = max(longest, q_longest)
    blocks, groups = -(-rows // block_rows), -(-asks // group_queries)
    shares = -(-asks // (blocks * group_queries))

    def numbers(n: int) -> Column:
        return F.sequence(F.lit(0), F.lit(n - 1))

    def dealt(name: str, n: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(name), "query_id"), F.lit(n)).cast("int")

    def solve(asks: pa.Table, rows: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if asks.num_rows and rows.num_rows:
            ids, names = rows["vec_id"].to_numpy(), asks["query_id"].to_numpy()
            index = Windows(scaled(matrix(rows["v"], width)), ids, projections, miss)
            reach = asks["reach"].to_numpy() if "reach" in asks.column_names else None
            for j, at, scores, _ in index.search(scaled(matrix(asks["v"], width)), names, k, reach):
                out["query_id"].append(np.full(len(at), names[j]))
                out["vec_id"].append(ids[at])
                out["score"].append(scores)
        return pa.table({c: pa.array(np.concatenate(x) if x else [], t) for (c, x), t in
                         zip(out.items(), (pa.int64(), pa.int64(), pa.float64()))})

    keys = ["part", "block"]
    held = data.select("vec_id", "v", F.pmod("own", F.lit(blocks)).cast("int").alias("block"))
    asked = asked.withColumn("home", dealt("home", blocks))
    # Each query widens its windows in one block, whose k-th distance is how far it has to look in the others.
    first = asked.select("query_id", "v", dealt("share", shares).alias("part"), F.col("home").alias("block")).groupBy(*keys).cogroup(
        held.withColumn("part", F.explode(numbers(shares))).groupBy(*keys)).applyInArrow(solve, FOUND)
    first = written(first, f"{folder}/first")
    least = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
    known = least.where(F.col("n") >= k).select("query_id", F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("kth"))).alias("reach"))
    sent = asked.join(known, "query_id", "left").select(
        "query_id", "v", F.coalesce("reach", F.lit(float("inf"))).alias("reach"), dealt("part", groups).alias("part"),
        F.explode(F.array_remove(numbers(blocks), F.col("home"))).alias("block"))
    others = sent.groupBy(*keys).cogroup(held.withColumn("part", F.explode(numbers(groups))).groupBy(*keys)).applyInArrow(solve, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        first.unionByName(others).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int"), "vec_id", "score")
    )
