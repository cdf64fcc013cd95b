"""Exact top-k inner products of integer vectors by a Voronoi join.

Vectors become integers floor(scale * x). With one more component sqrt(M - |x|^2) on the data
side (M the largest |x|^2) and 0 on the query side, the largest inner product is the nearest
neighbour: |q' - x'|^2 = |q|^2 + M - 2<q, x>.

Pivots, a bounded sample of the data, cut the space into cells. Data rows summarise each cell:
count, largest distance to the pivot and the k + 1 smallest of different vec_ids. Queries form groups of near cells, a larger cell split
by hash to a bounded number of queries; a cell's summary is the largest distance of a query from its
pivot. From the summaries alone follows, for each of its cells, a distance within which every
query has k neighbours. A data row goes only to groups that it can serve by the triangle
inequality, and there to one of a number of salted blocks; each block is solved
locally, and the best k of a query's blocks are its result. Scores are exact integers.

Whole numbers of any size are exact: where a product of doubles is not, numbers are cut into limbs whose products are.
Distances are taken in units of the largest component, so that none overflows.

Defined results: vectors that are null or hold null or non-finite components take no part; a component beyond +-1e300 counts as that; scores
that a long does not hold become its largest or smallest value, and tie there; a query meets
every other row, rows that share its vec_id excepted; vectors of different lengths are filled up with zeros; fewer than k
candidates give as many rows; ties go to the smaller vec_id; a query id that repeats is answered once, by its largest vector; rows that repeat are candidates each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import scratch_folder, written

PIVOTS = 32
GROUP_QUERIES = 1_024
BLOCK_ROWS = 16_384
SLACK = 1e-5
LARGEST = 1e300
EXACT = 2.0**53
NEAREST = "array<struct<distance:double,vec_id:long>>"


def integer_vectors(df: DataFrame, scale: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v array<double> of whole numbers) of the valid rows."""
    x = F.col(f"`{vector}`")
    number = lambda c: c.cast("double")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(number(c)) == float("inf")))

    def whole(c):
        scaled = F.greatest(F.least(number(c) * F.lit(float(scale)), F.lit(LARGEST)), F.lit(-LARGEST))
        return F.when(F.abs(scaled) < EXACT, F.floor(scaled).cast("double")).otherwise(scaled)

    return (
        df.where(x.isNotNull() & F.col(f"`{key}`").isNotNull()).where(~bad)
        .select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.transform(x, whole).alias("v"))
    )


def largest_component(df: DataFrame) -> float:
    """The smallest power of two that no component exceeds; 1 without any."""
    top = df.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0]
    return float(2.0 ** np.ceil(np.log2(top))) if top else 1.0


def largest_norm2(df: DataFrame, unit: float) -> float:
    """The largest squared length in units of `unit`."""
    return df.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, c: s + (c / unit) * (c / unit)))).first()[0] or 0.0


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of `width`, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width))
    lengths = np.diff(offsets)
    if len(lengths) and (lengths == width).all():
        out[:] = values[offsets[0] : offsets[-1]].reshape(-1, width)
    else:
        for i, n in enumerate(lengths):
            out[i, :n] = values[offsets[i] : offsets[i] + n]
    return out


def distances(x: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of (x, extra) to all pivots."""
    full = np.concatenate([x, extra[:, None]], axis=1)
    d2 = (full * full).sum(1)[:, None] + (pivots * pivots).sum(1)[None] - 2 * full @ pivots.T
    return np.sqrt(np.maximum(d2, 0.0))


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """Whole numbers as sums of limbs times powers of 2**bits, signs in the limbs."""
    out, rest, sign = [], np.abs(x), np.sign(x)
    while rest.any():
        low = np.fmod(rest, 2.0**bits)
        out.append(sign * low)
        rest = (rest - low) / 2.0**bits
    return out


def long_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers of any size, cut off at what a long holds."""
    bits = (53 - int(np.ceil(np.log2(max(2, q.shape[1]))))) // 2
    sums: dict[int, np.ndarray] = {}
    right = limbs(x, bits)
    for i, a in enumerate(limbs(q, bits)):
        for j, b in enumerate(right):
            if a.any() and b.any():
                sums[i + j] = sums.get(i + j, 0) + (a @ b.T).astype(np.int64)
    total = np.zeros((len(q), len(x)), dtype=object)
    for power, part in sums.items():
        total += part.astype(object) * (1 << (bits * power))
    info = np.iinfo(np.int64)
    return np.clip(total, info.min, info.max).astype(np.int64)


def scores_of(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers; only rows too large for products of doubles take the longer way."""
    width = max(1, q.shape[1])
    side = np.sqrt(EXACT / width)
    large_q, large_x = np.abs(q).max(axis=1, initial=0.0) >= side, np.abs(x).max(axis=1, initial=0.0) >= side
    if not large_q.any() and not large_x.any():
        return (q @ x.T).astype(np.int64)
    out = np.empty((len(q), len(x)), dtype=np.int64)
    out[np.ix_(~large_q, ~large_x)] = (q[~large_q] @ x[~large_x].T).astype(np.int64)
    out[:, large_x] = long_scores(q, x[large_x])
    out[np.ix_(large_q, ~large_x)] = long_scores(q[large_q], x[~large_x])
    return out


def best_rows(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each query the positions of its k best rows, its own excepted."""
    for i in range(len(scores)):
        line = scores[i]
        if len(line) > 4 * k:
            edge = np.partition(line, len(line) - k - 1)[len(line) - k - 1]
            at = np.flatnonzero(line >= edge)
            if len(at) < 2 * k + 2:
                mine = at[ids[at] != own[i]]
                if len(mine) >= k:
                    at = mine
                else:
                    at = np.flatnonzero(ids != own[i])
            else:
                at = at[ids[at] != own[i]]
                if len(at) < k:
                    at = np.flatnonzero(ids != own[i])
        else:
            at = np.flatnonzero(ids != own[i])
        yield i, at[np.lexsort((ids[at], ~line[at]))[:k]]


def choose_pivots(data: DataFrame, n: int) -> list[list[float]]:
    """Vectors of the rows with the smallest hashes: a sample whose size is fixed."""
    rows = data.orderBy(F.xxhash64("vec_id", F.lit(11)), "vec_id").limit(n).select("v").collect()
    return [list(v) for v in dict.fromkeys(tuple(r.v) for r in rows)]


def grouped_cells(counts: dict[int, int], between: np.ndarray, most: int) -> list[tuple[list[int], int]]:
    """Cells put together, near ones first, while they have at most `most` queries; and in how many parts a larger cell goes."""
    left, out = dict(counts), []
    while left:
        start = max(left, key=lambda c: (left[c], -c))
        cells, total = [], 0
        for c in sorted(left, key=lambda c: (between[start, c], c)):
            if not cells or total + left[c] <= most:
                cells.append(c)
                total += left[c]
        for c in cells:
            del left[c]
        out.append((cells, max(1, -(-total // most))))
    return out


def top_k(df: DataFrame, queries: DataFrame, k: int = 20, scale: int = 64, pivots: int = PIVOTS,
          group_queries: int = GROUP_QUERIES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of `queries` the k best rows of `df`.

    Summaries that reach the driver have one row per cell or group of queries.
    """
    spark = df.sparkSession
    folder = scratch_folder(spark, "knn")
    data = written(integer_vectors(df, scale), f"{folder}/data")
    asked = integer_vectors(queries, scale).groupBy("vec_id").agg(F.max("v").alias("v"))
    asked = written(asked, f"{folder}/queries")
    result = "query_id long, rank int, vec_id long, score long"
    longest, rows = data.agg(F.max(F.size("v")), F.count("*")).first()
    q_longest, q_rows = asked.agg(F.max(F.size("v")), F.count("*")).first()
    if not rows or not q_rows:
        return spark.createDataFrame([], result)
    width, unit = max(longest, q_longest, 1), max(largest_component(data), largest_component(asked))
    ceiling = largest_norm2(data, unit)
    slack = SLACK * np.sqrt(max(ceiling, largest_norm2(asked, unit)))
    chosen = choose_pivots(data, pivots)
    centre = np.zeros((len(chosen), width + 1))
    for i, v in enumerate(chosen):
        centre[i, : len(v)] = np.array(v) / unit
        centre[i, width] = np.sqrt(max(0.0, ceiling - (centre[i] ** 2).sum()))
    between = np.sqrt(np.maximum(((centre[:, None] - centre[None]) ** 2).sum(-1), 0.0))

    def placed(side: str):
        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = matrix(batch.column(batch.schema.get_field_index("v")), width) / unit
                extra = np.sqrt(np.maximum(ceiling - (x * x).sum(1), 0.0)) if side == "data" else np.zeros(len(x))
                d = distances(x, extra, centre)
                cell = d.argmin(1)
                ids = batch.column(batch.schema.get_field_index("vec_id"))
                yield pa.RecordBatch.from_arrays(
                    [ids, batch.column(batch.schema.get_field_index("v")), pa.array(cell.astype(np.int32)),
                     pa.array(d[np.arange(len(d)), cell])], names=["vec_id", "v", "cell", "distance"])
        return place

    schema = "vec_id long, v array<double>, cell int, distance double"
    cells = written(data.mapInArrow(placed("data"), schema), f"{folder}/cells")
    asks = asked.mapInArrow(placed("queries"), schema)
    sizes = {r.cell: r for r in asks.groupBy("cell").agg(F.count("*").alias("n"), F.max("distance").alias("reach")).collect()}
    members = grouped_cells({c: r.n for c, r in sizes.items()}, between, group_queries)
    number = {cell: group for group, (cells, _) in enumerate(members) for cell in cells}
    plan = spark.createDataFrame([(c, number[c], members[number[c]][1]) for c in sizes], "cell int, first int, parts int")
    asks = written(
        asks.join(plan, "cell").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
        .select("vec_id", "v", "first", "part"), f"{folder}/asks")

    # summaries of the data cells: count, reach, and the k + 1 smallest distances of different vec_ids (one of them may be the query's own)
    parts = written(cells.mapInArrow(cell_summary(k), f"cell int, n long, reach double, nearest {NEAREST}"), f"{folder}/summary")
    nearest = (
        parts.select("cell", F.explode("nearest").alias("x")).groupBy("cell", "x.vec_id").agg(F.min("x.distance").alias("distance"))
        .groupBy("cell").agg(F.slice(F.array_sort(F.collect_list(F.struct("distance", "vec_id"))), 1, k + 1).alias("nearest"))
    )
    summary = parts.groupBy("cell").agg(F.sum("n").alias("n"), F.max("reach").alias("reach")).join(nearest, "cell").collect()
    held = {r.cell: r for r in summary}

    # every query of a cell has k other rows within its bound
    bounds = {}
    for c, r in sizes.items():
        away: dict[int, float] = {}
        for s in held.values():
            for x in s.nearest:
                away[x.vec_id] = min(away.get(x.vec_id, float("inf")), float(between[c, s.cell]) + x.distance)
        bounds[c] = r.reach + (sorted(away.values())[k] if len(away) > k else float("inf"))

    def serves(cells: list[int], apart, distance) -> np.ndarray:
        """Whether rows at a distance from their pivot, which is `apart` from the cells' pivots, can be near enough to a query."""
        can = np.zeros(np.shape(distance), dtype=bool)
        for c in cells:
            far = np.maximum(apart[c] - distance, distance - apart[c]) - sizes[c].reach
            can |= far <= bounds[c] + slack
        return can

    def reached(cells: list[int]) -> int:
        return sum(s.n for s in held.values() if any(between[c, s.cell] - sizes[c].reach - bounds[c] <= s.reach + slack for c in cells))

    blocks = [max(1, -(-reached(cells) // block_rows)) for cells, _ in members]

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("vec_id")).to_numpy()
            apart = between[:, batch.column(batch.schema.get_field_index("cell")).to_numpy()]
            distance = batch.column(batch.schema.get_field_index("distance")).to_numpy()
            salt = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            v = batch.column(batch.schema.get_field_index("v"))
            for group, (cells, parts) in enumerate(members):
                there = np.flatnonzero(serves(cells, apart, distance))
                for part in range(parts if len(there) else 0):
                    yield pa.RecordBatch.from_pydict({
                        "group": pa.array(np.full(len(there), group, dtype=np.int32)), "part": pa.array(np.full(len(there), part, dtype=np.int32)),
                        "block": pa.array((salt[there] % np.uint64(blocks[group])).astype(np.int32)),
                        "vec_id": pa.array(ids[there]), "v": v.take(pa.array(there))})

    spread = cells.mapInArrow(sent, "group int, part int, block int, vec_id long, v array<double>")
    several = spark.createDataFrame(list(enumerate(blocks)), "first int, blocks int")
    asking = asks.join(several, "first").select(
        F.col("first").alias("group"), "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "vec_id", "v")

    def solved(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            q, x = matrix(left["v"], width), matrix(right["v"], width)
            ids, own = right["vec_id"].to_numpy(), left["vec_id"].to_numpy()
            for low in range(0, len(q), 256):
                part = scores_of(q[low : low + 256], x)
                for i, at in best_rows(part, ids, own[low : low + 256], k):
                    out["query_id"] += [int(own[low + i])] * len(at)
                    out["vec_id"] += ids[at].tolist()
                    out["score"] += [int(s) for s in part[i][at]]
        return pa.table({c: pa.array(out[c], pa.int64()) for c in out})

    found = asking.groupBy("group", "part", "block").cogroup(spread.groupBy("group", "part", "block")).applyInArrow(
        solved, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int"), "vec_id", "score")
    )


def cell_summary(k: int):
    """Per task and cell: count, largest distance and the k + 1 smallest ones of different vec_ids."""
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[int, int] = {}
        reach: dict[int, float] = {}
        least: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            cell = batch.column(batch.schema.get_field_index("cell")).to_numpy()
            distance = batch.column(batch.schema.get_field_index("distance")).to_numpy()
            ids = batch.column(batch.schema.get_field_index("vec_id")).to_numpy()
            for c in np.unique(cell).tolist():
                d, v = distance[cell == c], ids[cell == c]
                n[c] = n.get(c, 0) + len(d)
                reach[c] = max(reach.get(c, 0.0), float(d.max()))
                if c in least:
                    d, v = np.concatenate([least[c][0], d]), np.concatenate([least[c][1], v])
                order = np.argsort(d, kind="stable")
                first = np.sort(np.unique(v[order], return_index=True)[1])[: k + 1]
                least[c] = d[order][first], v[order][first]
        if n:
            nearest = [[{"distance": d, "vec_id": v} for d, v in zip(least[c][0].tolist(), least[c][1].tolist())] for c in n]
            yield pa.RecordBatch.from_pydict({
                "cell": pa.array(list(n), pa.int32()), "n": pa.array(list(n.values()), pa.int64()),
                "reach": pa.array(list(reach.values()), pa.float64()),
                "nearest": pa.array(nearest, pa.list_(pa.struct([("distance", pa.float64()), ("vec_id", pa.int64())])))})
    return summarise
