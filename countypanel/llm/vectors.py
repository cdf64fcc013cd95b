"""Near-duplicate vectors: what may hang together is found on short copies in tables of signs, then compared in full.

Unit vectors are rotated by a randomised Hadamard transform, which spreads them over all dimensions, and kept in a
byte a dimension, with the length of what the rounding takes. Vectors at an angle of t lie on the same side of a random
plane with a probability of 1 - t / pi, whatever the data. A table codes each vector by its sides of some planes;
vectors with the same code meet. Two that meet are joined if their short copies are as near as rounding may bring two
linked vectors. There are so many tables that two vectors at exactly the least cosine meet in none with a
probability below MISSED, nearer ones with far less. Up to ALL_PAIRS rows all vectors meet instead.

Nothing moves for this: every task reads the whole file of short copies and holds the rows on its side of a few
planes. Only the joins, as stars around the smallest name, leave a task. The rows of what hangs together, and no
others, then move in full: all pairs in it are compared, those near the threshold in double precision on the given
vectors, and leave a count for each end and, of the links, a spanning forest. Small groups share a packet, large ones
are cut into pairs of chunks.

Equal vectors are one class; their number weighs in the counts.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing;
vectors of different lengths don't link; rows that repeat are vectors that link with each other; a null id
takes part in counts but names and joins no component, unless all ids of it are null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch_folder, written
from .components import components
from .knn import matrix

MISSED = 1e-9
ALL_PAIRS = 65_536
SLICE_BYTES = 96 << 20
BLOB_BYTES = 1024
CHUNK_ROWS = 20_000
COPIES = 8
HELD_ROWS = 200_000
PACKET_ROWS = 4096
JOB_TASKS = 96
LEAST_TASKS = 24
TASK_ROWS = 2048
TILE = 512
WIDE = 4096
RUN = 64
PAIRS = 65_536
FIRST_DIMS = 16
PRODUCT_DIMS = 512
ROUNDING = 1e-6
#: Microseconds that a row takes in a pass over the short copies and in a table, and a pair that meets.
READ_US, TABLE_US, PAIR_US = 0.35, 0.15, 0.08


def rotated(x: np.ndarray, seed: int = 5) -> np.ndarray:
    """Unit rows under an orthonormal map: random signs and a Hadamard transform, twice. Every row's
    result is the same in whatever batch it comes."""
    width = 1 << max(0, (x.shape[1] - 1).bit_length())
    out = np.zeros((len(x), width))
    out[:, : x.shape[1]] = x
    signs = np.random.Generator(np.random.Philox(seed)).choice([-1.0, 1.0], size=(2, width))
    for turn in range(2):
        out = out * signs[turn]
        step = 1
        while step < width:
            pairs = out.reshape(len(x), -1, 2, step)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), width)
            step *= 2
        out = out / np.sqrt(width)
    return out


def short_copies(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows rotated, as unit vectors in a byte a dimension, with the step of each row's bytes and the distance from the unrounded row."""
    u = x / np.sqrt((x * x).sum(1))[:, None]
    z = u @ rotated(np.eye(x.shape[1])) if x.shape[1] <= PRODUCT_DIMS else rotated(u)
    step = (np.abs(z).max(1) / 127).astype(np.float32)
    q = np.rint(z / step[:, None].astype(float)).astype(np.int8)
    off = z - q * step[:, None].astype(float)
    return q, step, np.sqrt((off * off).sum(1))


def merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the sets of i and j, in place; a label is the smallest member's index."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (up := label[label]) is not None and (up != label).any():
            label[:] = up


class Near:
    """Short copies, joined as they meet: `label` is the smallest index of those that hang together."""

    def __init__(self, q: np.ndarray, step: np.ndarray, reach: float):
        self.q, self.step, self.label = q, step, np.arange(len(q), dtype=np.int32)
        self.bound = reach * reach / 2 * (1 + ROUNDING) + ROUNDING
        self.half = np.concatenate([(v * v).sum(1) / 2 for _, v in self.slices()] or [np.zeros(0, np.float32)])
        # the first dimensions in steps of one size, cut off at its ends, which brings no two further apart
        first = min(FIRST_DIMS, q.shape[1])
        size = 4 / np.sqrt(q.shape[1]) / 127
        self.head = np.zeros((len(q), FIRST_DIMS), dtype=np.int8)
        for low, v in self.slices():
            self.head[low : low + len(v), :first] = np.clip(np.rint(v[:, :first] / size), -127, 127)
        self.head_bound = (np.sqrt(2 * self.bound) / size + np.sqrt(first)) ** 2
        self.head = self.head.view(np.complex128)[:, 0]  # 16 bytes at once

    def vectors(self, at: np.ndarray) -> np.ndarray:
        return self.q[at].astype(np.float32) * self.step[at][:, None]

    def slices(self, rows: int = 16_384) -> Iterator[tuple[int, np.ndarray]]:
        for low in range(0, len(self.q), rows):
            yield low, self.q[low : low + rows].astype(np.float32) * self.step[low : low + rows, None]

    def roots(self, at: np.ndarray) -> np.ndarray:
        root = self.label[at]
        while (up := self.label[root]) is not None and (up != root).any():
            root = up
        self.label[at] = root
        return root

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        """As `merge`, but only labels of roots change."""
        while len(i):
            a, b = self.roots(i), self.roots(j)
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))

    def pairs(self, a: np.ndarray, b: np.ndarray) -> None:
        for at in range(0, len(a), PAIRS):
            i, j = a[at : at + PAIRS], b[at : at + PAIRS]
            d = np.subtract(self.head[i].view(np.int8), self.head[j].view(np.int8), dtype=np.float32).reshape(-1, FIRST_DIMS)
            some = np.flatnonzero(np.einsum("ij,ij->i", d, d) <= self.head_bound)
            some = some[self.roots(i[some]) != self.roots(j[some])]
            if len(some):
                i, j = i[some], j[some]
                d = self.vectors(i) - self.vectors(j)
                near = np.einsum("ij,ij->i", d, d) <= 2 * self.bound
                self.join(i[near], j[near])

    def tile(self, head: np.ndarray, others: np.ndarray) -> None:
        """Every pair of a row of `head` and one of `others`."""
        x = self.vectors(head)
        for start in range(0, len(others), WIDE):
            other = others[start : start + WIDE]
            ours, theirs = self.roots(head), self.roots(other)
            if ours.min() == ours.max() == theirs.min() == theirs.max():
                continue
            s = x @ self.vectors(other).T
            s -= self.half[other]
            i, j = np.nonzero(s >= (self.half[head] - self.bound)[:, None])
            apart = ours[i] != theirs[j]
            self.join(head[i[apart]], other[j[apart]])

    def turns(self, task: int, tasks: int) -> None:
        """Every pair of all rows; of several tasks each takes its turn of them."""
        at = np.arange(len(self.q))
        for low in range(task * TILE, len(at), tasks * TILE):
            self.tile(at[low : low + TILE], at[low:])

    def block(self, at: np.ndarray) -> None:
        """Every pair of these rows that don't hang together yet: a few first, which join most of a dense group, then the rows of small groups before those of large ones."""
        size = TILE // 32
        while len(at):
            _, group, count = np.unique(self.roots(at), return_inverse=True, return_counts=True)
            if len(count) == 1:
                return
            at = at[np.lexsort((group, count[group]))]
            self.tile(at[:size], at)
            at, size = at[size:], TILE

    def same_codes(self, codes: np.ndarray) -> None:
        """Every pair of rows with the same code."""
        order = codes.astype(np.uint64)
        order <<= np.uint64(32)
        order |= np.arange(len(codes), dtype=np.uint64)
        order.sort()
        codes = (order >> np.uint64(32)).astype(np.uint32)
        order = order.astype(np.uint32)  # the rows
        at = np.flatnonzero(codes[1:] == codes[:-1])
        if not len(at):
            return
        new = np.concatenate([[True], at[1:] != at[:-1] + 1])
        run, starts = np.cumsum(new) - 1, at[new]
        ends = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)] + 2
        for k in np.flatnonzero(ends - starts > RUN):
            self.block(order[starts[k] : ends[k]])
        short = (ends - starts <= RUN)[run]
        at, end, shift = at[short], ends[run[short]], 1
        while len(at):
            self.pairs(order[at], order[at + shift])
            shift += 1
            more = at + shift < end
            at, end = at[more], end[more]


class Grown:
    """Columns with room for some rows, which takes memory as they come, and by half as many more whenever that is full."""

    def __init__(self, room: int, *like: np.ndarray):
        self.rows, self.columns = 0, [np.empty((room, *c.shape[1:]), c.dtype) for c in like]

    def add(self, *more: np.ndarray) -> None:
        rows = self.rows + len(more[0])
        for k, c in enumerate(more):
            if rows > len(self.columns[k]):
                grown = np.empty((max(rows, len(self.columns[k]) * 3 // 2, 65_536), *c.shape[1:]), c.dtype)
                grown[: self.rows] = self.columns[k][: self.rows]
                self.columns[k] = grown
            self.columns[k][self.rows : rows] = c
        self.rows = rows

    def all(self) -> list[np.ndarray]:
        return [c[: self.rows] for c in self.columns]


def planes(width: int, count: int, *name: int) -> np.ndarray:
    return np.random.Generator(np.random.Philox(np.random.SeedSequence([width, *name]))).standard_normal((width, count), dtype=np.float32)


def sides(x: np.ndarray, normals: np.ndarray, bits: int) -> np.ndarray:
    """For each row and each `bits` of the planes the row's sides of them, as a number."""
    packed = np.packbits((x @ normals > 0).reshape(len(x), -1, bits), axis=2)
    out = np.zeros(packed.shape[:2], dtype=np.uint32)
    for k in range(packed.shape[2]):
        out = out << np.uint32(8) | packed[:, :, k]
    return out


class Tables:
    """`schemes` times: rows part by `outer` planes, and in each part meet in `tables` tables of `bits` planes."""

    def __init__(self, schemes: int, outer: int, tables: int, bits: int):
        self.schemes, self.outer, self.tables, self.bits = schemes, outer, tables, bits

    def missed(self, meet: float) -> float:
        """Probability that two which lie on the same side of a plane with probability `meet` meet nowhere."""
        return float((1 - meet**self.outer * (1 - (1 - meet**self.bits) ** self.tables)) ** self.schemes)

    @classmethod
    def chosen(cls, rows: int, width: int, meet: float, others: np.ndarray, slice_bytes: int) -> Tables:
        """The cheapest that misses a pair with a probability of at most MISSED; `others`: of pairs of rows not near, the probability to lie on the same side."""
        outer = min(16, max(0, int(np.ceil(np.log2(max(1, rows * width / slice_bytes))))))
        best = None
        for bits in range(1, 33):
            met = rows * float((others ** (outer + bits)).mean()) / 2 if len(others) else 0
            for tables in (1, 2, 4, 6, 8, 12, 16, 24):
                found = meet**outer * (1 - (1 - meet**bits) ** tables)
                schemes = max(int(np.ceil(np.log(MISSED) / np.log1p(-min(found, 1 - MISSED)))), -(-LEAST_TASKS >> outer))
                cost = schemes * (2**outer * READ_US + tables * (TABLE_US + met * PAIR_US))
                if best is None or cost < best[0]:
                    best = cost, cls(schemes, outer, tables, bits)
        return best[1]


def shortened(vectors: DataFrame) -> DataFrame:
    """Lots of rows of one length: their classes, short copies and steps as bytes, and the largest distance from an unrounded row."""
    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(1).to_numpy()
            for length in np.unique(lengths).tolist():
                some = batch.filter(pa.array(lengths == length))
                nulls = some.column(2).flatten().is_null()
                if nulls.true_count:
                    some = some.filter(pa.array(~np.isin(np.arange(some.num_rows), pc.list_parent_indices(some.column(2)).filter(nulls).to_numpy())))
                x, names = matrix(some.column(2), length), some.column(0).to_numpy()
                with np.errstate(over="ignore", invalid="ignore"):
                    norm = np.sqrt((x * x).sum(1))
                fit = np.isfinite(norm) & (norm > 0)  # of others no cosine can be told
                if not fit.any():
                    continue
                q, step, off = short_copies(x[fit])
                names, lot = names[fit], max(1, BLOB_BYTES // q.shape[1])
                cuts = [(k, min(k + lot, len(q))) for k in range(0, len(q), lot)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([length] * len(cuts), pa.int32()), pa.array([j - i for i, j in cuts], pa.int32()),
                    *(pa.array([v[i:j].tobytes() for i, j in cuts], pa.binary()) for v in (names, q, step)),
                    pa.array([float(off[i:j].max()) for i, j in cuts], pa.float64())], names=["len", "n", "names", "q", "step", "off"])

    return vectors.select("class", "len", "x").mapInArrow(
        shorten, "len int, n int, names binary, q binary, step binary, off double")


def flat(column: pa.Array, kind: type) -> np.ndarray:
    """The bytes of all rows as numbers."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]].copy().view(kind)


def of_lots(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Length, classes, short copies and steps of the lots of each length."""
    lengths = batch.column("len").to_numpy()
    for length in np.unique(lengths).tolist():
        some = batch.filter(pa.array(lengths == length))
        names = flat(some.column("names"), np.int64)
        yield length, names, flat(some.column("q"), np.int8).reshape(len(names), -1), flat(some.column("step"), np.float32)


def joined(lots: DataFrame, rows: int, reach: float, tables: Tables | None, scheme: int, part: int, tasks: int) -> DataFrame:
    """(class, other): what hangs together by the tables of one scheme in one part, or, without tables, by a task's turn of all pairs; stars around the smallest class."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Grown] = {}
        room = rows * 9 // 8 >> tables.outer if tables else rows
        for batch in batches:
            for length, names, q, step in of_lots(batch):
                if length not in held:
                    held[length] = Grown(room if not held else 0, names, q, step)
                if tables and tables.outer:
                    normals = planes(q.shape[1], tables.outer, scheme)
                    code = np.concatenate([sides(q[k : k + 16_384].astype(np.float32), normals, tables.outer)[:, 0] for k in range(0, len(q), 16_384)])
                    mine = np.flatnonzero(code == sides_of(part, tables.outer))
                    names, q, step = names[mine], q[mine], step[mine]
                held[length].add(names, q, step)
        while held:
            names, q, step = held.popitem()[1].all()
            near = Near(q, step, reach)
            if not tables:
                near.turns(part, tasks)
            for first in range(0, tables.tables if tables else 0, 2):
                count = min(2, tables.tables - first)
                normals = planes(q.shape[1], count * tables.bits, scheme, first + 1)
                codes = np.concatenate([sides(x, normals, tables.bits) for _, x in near.slices()] or [np.zeros((0, count), np.uint32)])
                for k in range(count):
                    near.same_codes(codes[:, k])
            label = near.roots(np.arange(len(names)))
            least = names.copy()
            np.minimum.at(least, label, names)
            apart = np.flatnonzero(least[label] != names)
            some, at = np.unique(names[apart], return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(least[label[apart[at]]])], names=["class", "other"])

    return lots.coalesce(1).mapInArrow(join, "class long, other long")


def sides_of(part: int, bits: int) -> int:
    """The number that `sides` has for the part of this number: its bits fill bytes from the left."""
    return part << -bits % 8


def exact_links(x: np.ndarray, weight: np.ndarray, joins: np.ndarray, chunk: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Weight of the rows linked to each, and labels of what is linked among those that join.

    Every pair is compared, of two chunks those of different chunks: in single precision, and, where that
    doesn't tell, in double precision on the rows as given.
    """
    norm = np.sqrt((x * x).sum(1))
    u = (x / norm[:, None]).astype(np.float32)
    sure = 1.2e-7 * (x.shape[1] + 8)
    linked, label = np.zeros(len(x)), np.arange(len(x))
    two, all_join = chunk.min() != chunk.max(), bool(joins.all())
    ours, theirs = (np.flatnonzero(chunk == c) for c in (chunk.min(), chunk.max()))
    kind = np.float32 if weight.sum() < 1 << 24 else np.float64  # whole numbers that it holds
    heavy = weight.astype(kind)
    for low in range(0, len(ours), TILE):
        a = ours[low : low + TILE]
        for start in range(0 if two else low, len(theirs), WIDE):
            b = theirs[start : start + WIDE]
            s = u[a] @ u[b].T
            s -= np.float32(cosine)
            link = s >= 0
            close = np.abs(s, out=s) <= sure
            if close.any():
                i, j = np.nonzero(close)
                for at in range(0, len(i), PAIRS):
                    p, q = i[at : at + PAIRS], j[at : at + PAIRS]
                    link[p, q] = (x[a[p]] * x[b[q]]).sum(1) / (norm[a[p]] * norm[b[q]]) >= cosine
            if not two and start < low + TILE:
                link &= b[None] > a[:, None]
            ones = link.astype(kind)
            linked[a] += ones @ heavy[b]
            linked[b] += heavy[a] @ ones
            p, q = label[a], label[b]
            if p.min() == p.max() == q.min() == q.max():
                continue
            if not all_join:
                link &= joins[a][:, None] & joins[b][None]
            i, j = np.nonzero(link)
            apart = p[i] != q[j]
            if apart.any():
                merge(label, a[i[apart]], b[j[apart]])
    return linked.astype(np.int64), label


def hashed_vectors(df: DataFrame, key: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """Every row's vec_id, two hashes, a length and a class named by them, all but vec_id and len null where the vector is not valid;
    and class, len and x of all rows with components: those that are not valid have classes of their own."""
    x = F.col(f"`{vector}`")
    all_x = df.select(F.col(f"`{key}`").alias("vec_id"), x.alias("x")).withColumns(
        {"h1": F.xxhash64("x"), "h2": F.xxhash64(F.reverse("x"), F.lit(1)), "len": F.size("x")}).withColumn("class", F.xxhash64("h1", "h2", "len"))
    high, low = F.array_max("x").cast("double"), F.array_min("x").cast("double")
    bad = F.exists("x", lambda c: c.isNull()) | F.isnan(high) | (high == float("inf")) | (low == float("-inf"))
    valid = F.col("x").isNotNull() & ~bad & F.exists("x", lambda c: c != 0)
    hashed = all_x.select("vec_id", F.when(F.col("x").isNotNull(), F.col("len")).otherwise(F.lit(-1)).alias("len"),
                          *(F.when(valid, F.col(c)).alias(c) for c in ("h1", "h2", "class")))
    return hashed, all_x.where(F.size("x") > 0).select("vec_id", "class", "len", "x")


def hanging_together(lots: DataFrame, cosine: float, folder: str, all_pairs: int, slice_bytes: int) -> DataFrame:
    """(class, other) whose components hold the ends of every link."""
    total = lots.agg(F.sum("n"), F.max("off"), F.max(F.length("q") / F.col("n")), F.count("*")).first()
    rows, off, width, count = int(total[0] or 0), float(total[1] or 0), int(total[2] or 1), total[3]
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 2 * off
    tables = None
    if rows > all_pairs:
        # short copies may be at a little more than the angle of the unrounded vectors
        meet = max(0.0, 1 - (float(np.arccos(np.clip(cosine, -1, 1))) + 2 * float(np.arcsin(min(1.0, off)))) / np.pi)
        tables = Tables.chosen(rows, width, meet, others_of(lots, count, cosine), slice_bytes)
    turns = min(LEAST_TASKS, 1 + rows // TASK_ROWS)
    runs = [(t, p) for t in range(tables.schemes) for p in range(1 << tables.outer)] if tables else [(0, p) for p in range(turns)]
    files = []
    for first in range(0, len(runs), JOB_TASKS):
        # one task each; a part that is no single partition keeps Spark from running them all as one
        tasks = [lots.where("n < 0").select(F.lit(0).cast("long").alias("class"), F.lit(0).cast("long").alias("other"))]
        tasks += [joined(lots, rows, reach, tables, t, p, turns) for t, p in runs[first : first + JOB_TASKS]]
        files.append(f"{folder}/joined/{first}")
        reduce(DataFrame.unionAll, tasks).write.parquet(files[-1])
    return lots.sparkSession.read.schema("class long, other long").parquet(*files)


def others_of(lots: DataFrame, count: int, cosine: float) -> np.ndarray:
    """Of some pairs that are not near, the probability to lie on the same side of a plane; only the number of tables depends on it."""
    some = lots.where(F.pmod(F.xxhash64("names"), F.lit(max(1, count // 64))) == 0).limit(64).toArrow().combine_chunks()
    out = []
    for batch in some.to_batches():
        for _, _, q, _ in of_lots(batch):
            x = q[: 4096].astype(np.float32)
            x /= np.sqrt((x * x).sum(1))[:, None]
            c = (x @ x.T)[np.triu_indices(len(x), 1)]
            out.append(1 - np.arccos(np.clip(c[c < cosine - (1 - cosine)], -1, 1)) / np.pi)
    return np.concatenate(out or [np.zeros(0)])


def linked_vectors(df: DataFrame, cosine: float = 0.95, key: str = "vec_id", vector: str = "embedding",
                   chunk_rows: int = CHUNK_ROWS, all_pairs: int = ALL_PAIRS, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Every row's vec_id with n_links, component_id and kept."""
    folder = scratch_folder(df.sparkSession, "vectors")
    hashed, vectors = hashed_vectors(df, key, vector)
    hashed = written(hashed, f"{folder}/hashed")
    lots = written(shortened(vectors), f"{folder}/short")
    may = hanging_together(lots, cosine, folder, all_pairs, slice_bytes)
    together = written(components(may.distinct().toDF("a", "b")), f"{folder}/together").toDF("class", "group")
    sizes = together.groupBy("group").agg(F.count("*").alias("n"))
    chunk = F.least(F.greatest(F.lit(chunk_rows), F.ceil(F.col("n") / COPIES)), F.lit(max(chunk_rows, HELD_ROWS)))
    crowded = written(
        sizes.where(F.col("n") > chunk_rows).select("group", F.ceil(F.col("n") / chunk).cast("int").alias("chunks")), f"{folder}/crowded")
    packets = max(1, together.count() // PACKET_ROWS)
    dealt = (
        vectors.groupBy("class")
        .agg(F.first("x").alias("x"), F.first("len").alias("len"), F.count("*").alias("weight"), F.min("vec_id").isNotNull().alias("joins"))
        .join(together, "class").join(crowded, "group", "left")
        .withColumn("packet", F.when(F.col("chunks").isNull(), F.pmod(F.xxhash64("group"), F.lit(packets))).otherwise(-1))
        .withColumn("whole", F.when(F.col("chunks").isNotNull(), F.col("group")).otherwise(0))
        .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        .withColumn("chunk", F.pmod(F.xxhash64("class", F.lit(3)), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumns({"one": F.least("chunk", "other"), "two": F.greatest("chunk", "other")})
    )

    def solve(table: pa.Table) -> pa.Table:
        table = table.sort_by("group")
        chunk, names, group = (table[c].to_numpy() for c in ("chunk", "class", "group"))
        weight, joins = table["weight"].to_numpy(), table["joins"].to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])).tolist() + [len(group)]
        apart = table["one"][0].as_py() != table["two"][0].as_py()
        x = matrix(table["x"], max(table["len"].to_pylist()))
        linked, other = np.zeros(len(group), dtype=np.int64), names.copy()
        for low, high in zip(cuts, cuts[1:]):
            at = slice(low, high)
            if not apart or chunk[at].min() != chunk[at].max():
                linked[at], label = exact_links(x[at], weight[at], joins[at], chunk[at], cosine)
                other[at] = names[at][label]
        some = np.flatnonzero(linked)
        return pa.table({"class": names[some], "other": other[some], "links": linked[some]})

    links = written(
        dealt.select("group", "class", "weight", "joins", "len", "x", "chunk", "packet", "whole", "one", "two")
        .groupBy("packet", "whole", "one", "two").applyInArrow(solve, "class long, other long, links long"), f"{folder}/links")
    counts = links.groupBy("class").agg(F.sum("links").alias("links"))
    classes = written(
        hashed.where("class is not null").groupBy("h1", "h2", "len", "class").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")),
        f"{folder}/classes")
    named = classes.select("class", "rep")
    edges = (
        links.where("class <> other").select("class", "other").distinct()
        .join(named.withColumnRenamed("rep", "a"), "class")
        .join(named.select(F.col("class").alias("other"), F.col("rep").alias("b")), "other")
        .where("a is not null and b is not null").select("a", "b")
    )
    found = (
        classes.select("class", "rep", "weight", "h1", "h2", "len")
        .join(counts, "class", "left").join(components(edges), F.col("rep") == F.col("node"), "left")
        .select(F.col("h1").alias("__h1"), F.col("h2").alias("__h2"), F.col("len").alias("__len"),
                (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id"))
    )
    same = (F.col("h1") == F.col("__h1")) & (F.col("h2") == F.col("__h2")) & (F.col("len") == F.col("__len"))
    return (
        hashed.select("vec_id", "h1", "h2", "len").join(found, same, "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                F.coalesce("component_id", "vec_id").alias("component_id"))
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
