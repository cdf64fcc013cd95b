"""Connected components of a graph given by its edges, by alternating star contractions.

Each round joins all larger neighbours of a node, then all its smaller ones, to the smallest
node next to it; the rounds are logarithmic in number. Minima are taken before the
shuffle, joins may split a hot node, and each round's edges are written, so that a lost
executor costs one round at most. Nothing but two totals per round reaches the driver.

Before the first round every task contracts the edges that it reads anyway. Rounds end, too, when no more than
TASK_EDGES edges are left: these are contracted by one task, which costs less than a round's shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch_folder, written


TASK_EDGES = 100_000
HELD_EDGES = 1 << 20


def smallest_reached(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """Of each of n numbered nodes the smallest number that it reaches by the edges (x, y)."""
    up = np.arange(n)
    while True:
        p, q = up[x], up[y]
        open_ = p != q
        if not open_.any():
            return up
        x, y, p, q = x[open_], y[open_], p[open_], q[open_]
        np.minimum.at(up, np.maximum(p, q), np.minimum(p, q))
        while (up != up[up]).any():
            up = up[up]


def contracted(edges: DataFrame) -> DataFrame:
    """Edges (a, b), a > b, that connect what those of each task connect: from each node to the smallest one it reaches there."""
    def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        names, flat = np.unique(np.concatenate([table[k].to_numpy() for k in (0, 1)]), return_inverse=True)
        least = smallest_reached(flat[: table.num_rows], flat[table.num_rows :], len(names))
        moved = np.flatnonzero(least != np.arange(len(names)))
        return pa.RecordBatch.from_arrays([pa.array(names[k], f.type) for k, f in zip((moved, least[moved]), table.schema)], schema=table.schema)

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= HELD_EDGES:
                yield stars(held)
                held = []
        if held:
            yield stars(held)

    return edges.mapInArrow(contract, edges.schema)


def star(edges: DataFrame, larger: bool) -> DataFrame:
    """One contraction of (a, b), a > b."""
    if larger:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        moved = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))  # the larger end moves
        moved = moved.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.where("a <> b").distinct()
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of an edge with the smallest node it reaches.

    Takes (a, b) of one type in any order and number; loops are ignored.
    """
    folder = scratch_folder(edges.sparkSession, "components")
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, before, turn = written(contracted(ordered), f"{folder}/0"), None, 0
    while True:
        total = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(total) == before or not total[0]:
            break
        before, turn = tuple(total), turn + 1
        if total[0] <= min(TASK_EDGES, HELD_EDGES):
            now = written(contracted(now.coalesce(1)), f"{folder}/{turn}")
            break
        now = written(star(star(now, larger=True), larger=False), f"{folder}/{turn}")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
