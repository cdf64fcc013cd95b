"""Vector codes: subvectors assigned to codebook entries, found in a geometric near-neighbour access tree over the entries.

Components become whole numbers floor(SCALE * x); vectors are cut into PARTS parts. A part position's codebook starts
as that part of the rows with the smallest ids; in each round every subvector goes to its nearest entry and entries
move to the componentwise floor of their mean.

The tree of a codebook: a node's split points divide its entries, each entry to the nearest split, and store for each pair of a
split and a child the range of distances from the split to the child's entries. A search computes
the distances to the split points and leaves out every child whose range from some split lies strictly outside the query's distance plus
or minus the best distance found. Roots are rounded to the safe side, so nothing that could tie is left out;
what remains is compared by exact squared distances of integers, ties to the lower entry. Numbers beyond 25 bits are
searched in the same tree with integers of any size.

Codebooks, at most ENTRIES vectors, go to all tasks; a task returns one sum for each entry. Sums, whatever their size, are exact.

Defined results: rows whose vector is null or holds null or non-finite components are dropped; equal distances take the lower
entry; where ids repeat, an id enters the first codebook once, by its smallest vector, and null ids don't; fewer ids make smaller
codebooks; the length is that of the first such vector, and if PARTS does not divide it, the first parts are one longer; vectors of another
length stay without code and error; if no row has an id, no row has a code. Without codebooks their digest is that of nothing. An error beyond a
long is null, and so is the sum of its label. An empty table gives no rows. Columns other than id, vector and label take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch_folder, written
from .knn import matrix

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
DEGREE = 8
SMALL = 1 << 24
MARGIN = 4e-15
LONG = 1 << 63


def whole(x: float) -> int:
    """floor(SCALE * x), exact for every finite number."""
    return int(np.floor(x * SCALE)) if abs(x) < 2.0**53 else int(x) * SCALE


def wholes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of whole numbers of at most 25 bits, and apart the positions and numbers of the other rows."""
    with np.errstate(over="ignore"):
        number = np.floor(x * float(SCALE))
    large = np.flatnonzero((np.abs(number) > SMALL).any(axis=1))
    apart = np.empty((len(large), x.shape[1]), dtype=object)
    for i, row in enumerate(large):
        apart[i] = [whole(float(c)) for c in x[row]]
    number[large] = 0
    return number.astype(np.int64), large, apart


def squares(x: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to one entry."""
    gap = x - entry
    return (gap * gap).sum(axis=1)


def below_root(d2: np.ndarray) -> np.ndarray:
    if d2.dtype == object:
        return np.array([isqrt(int(d)) for d in d2.ravel()], dtype=object).reshape(d2.shape)
    return np.sqrt(d2.astype(np.float64)) * (1 - MARGIN)


def above_root(d2: np.ndarray) -> np.ndarray:
    if d2.dtype == object:
        return below_root(d2) + 1
    return np.sqrt(d2.astype(np.float64)) * (1 + MARGIN)


class Tree:
    """Entries below one node; `entries` is the whole codebook, `members` the numbers of those that stand here."""

    def __init__(self, entries: np.ndarray, members: np.ndarray | None = None):
        self.entries = entries
        self.members = np.arange(len(entries)) if members is None else members
        self.splits, self.children = [], []
        if len(self.members) > DEGREE:
            self.divide()

    def divide(self) -> None:
        held = self.entries[self.members]
        # Far from each other: each split is the entry that is farthest from those before it.
        first = 0
        away = [squares(held, held[first])]
        chosen = [first]
        while len(chosen) < DEGREE:
            nearest = np.minimum.reduce(away)
            nearest[chosen] = -1
            chosen.append(int(nearest.argmax()))
            away.append(squares(held, held[chosen[-1]]))
        distance = np.stack(away)  # a row for each split
        self.splits = self.members[chosen].tolist()
        rest = np.setdiff1d(np.arange(len(held)), chosen)
        owner = distance[:, rest].argmin(axis=0)
        for j in range(len(chosen)):
            mine = rest[owner == j]
            if len(mine):
                near, far = below_root(distance[:, mine].min(axis=1)), above_root(distance[:, mine].max(axis=1))
                self.children.append((Tree(self.entries, self.members[mine]), near, far))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Each row's nearest entry, the squared distance, and the number of distances computed."""
        best = np.full(len(x), -1, dtype=x.dtype)
        entry = np.full(len(x), -1)
        computed = self.search(x, np.arange(len(x)), best, entry)
        return entry, best, computed

    def take(self, rows: np.ndarray, d2: np.ndarray, number: int, best: np.ndarray, entry: np.ndarray) -> None:
        now, holder = best[rows], entry[rows]
        better = (holder < 0) | (d2 < now) | ((d2 == now) & (number < holder))
        best[rows[better]] = d2[better]
        entry[rows[better]] = number

    def search(self, x: np.ndarray, rows: np.ndarray, best: np.ndarray, entry: np.ndarray) -> int:
        if not self.splits:
            for number in self.members.tolist():
                self.take(rows, squares(x[rows], self.entries[number]), number, best, entry)
            return len(rows) * len(self.members)
        here = x[rows]
        distance = np.stack([squares(here, self.entries[s]) for s in self.splits])
        for d2, number in zip(distance, self.splits):
            self.take(rows, d2, number, best, entry)
        low, high = below_root(distance), above_root(distance)
        computed = distance.size
        for child, near, far in self.children:
            reach = above_root(best[rows])
            out = ((low - reach > far[:, None]) | (high + reach < near[:, None])).any(axis=0)
            kept = rows[~out]
            if len(kept):
                computed += child.search(x, kept, best, entry)
        return computed


class Codebooks:
    """The entries of all part positions, with their trees."""

    def __init__(self, parts: list[list[list[int]]], width: int):
        self.parts, self.width = parts, width
        cuts = np.array_split(np.arange(width), PARTS)
        self.cuts = [(int(c[0]), int(c[-1]) + 1) if len(c) else (0, 0) for c in cuts]
        self.trees: dict[tuple[int, bool], Tree] = {}

    def tree(self, part: int, large: bool) -> Tree:
        if (part, large) not in self.trees:
            low, high = self.cuts[part]
            entries = np.empty((len(self.parts[part]), high - low), dtype=object if large else np.int64)
            for i, e in enumerate(self.parts[part]):
                entries[i] = e
            self.trees[part, large] = Tree(entries)
        return self.trees[part, large]

    def assigned(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Per part: entries and squared distances of all rows, the subvectors, and positions and subvectors of the large rows."""
        number, large, apart = wholes(x)
        for part, (low, high) in enumerate(self.cuts):
            sub, beyond = number[:, low:high], apart[:, low:high]
            if max((abs(c) for e in self.parts[part] for c in e), default=0) > SMALL:
                entry, d2, _ = self.tree(part, True).nearest(sub.astype(object))
            else:
                entry, d2, _ = self.tree(part, False).nearest(sub)
            if len(large):
                d2 = d2.astype(object)
                entry[large], d2[large], _ = self.tree(part, True).nearest(beyond)
            yield part, entry, d2, sub, large, beyond

    def digest(self) -> str:
        return sha256(",".join(str(c) for p in self.parts for e in p for c in e).encode("ascii")).hexdigest()


def entry_sums(books: Codebooks):
    """Per task: number and sum of the subvectors of each entry."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            for part, entry, _, sub, large, beyond in books.assigned(matrix(batch.column(0), books.width)):
                n = len(books.parts[part])
                if part not in sums:
                    counts[part], sums[part] = np.zeros(n, dtype=np.int64), np.zeros((n, sub.shape[1]), dtype=object)
                counts[part] += np.bincount(entry, minlength=n)
                held = np.zeros(sums[part].shape, dtype=np.int64)
                np.add.at(held, entry, sub)
                sums[part] += held
                for row, values in zip(large.tolist(), beyond):
                    sums[part][entry[row]] += values
        keys = [(p, e) for p in sums for e in np.flatnonzero(counts[p]).tolist()]
        if keys:
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([p for p, _ in keys], pa.int32()), "entry": pa.array([e for _, e in keys], pa.int32()),
                "n": pa.array([int(counts[p][e]) for p, e in keys], pa.int64()),
                "sums": pa.array([[str(s) for s in sums[p][e]] for p, e in keys], pa.list_(pa.string()))})
    return add


def total_sums(table: pa.Table) -> pa.Table:
    """The sum of an entry's sums, one for each task."""
    lines = [[int(s) for s in line] for line in table["sums"].to_pylist()]
    total = [str(sum(column)) for column in zip(*lines)]
    return pa.table({"part": table["part"][:1], "entry": table["entry"][:1], "n": pa.array([sum(table["n"].to_pylist())], pa.int64()),
                     "sums": pa.array([total], pa.list_(pa.string()))})


def first_codebooks(kept: DataFrame, entries: int) -> Codebooks | None:
    """Codebooks of the rows with the smallest ids."""
    ids = [r[0] for r in kept.select("id").where("id is not null").distinct().orderBy("id").limit(entries).collect()]
    if not ids:
        return None
    rows = kept.where(F.col("id").isin(ids)).groupBy("id").agg(F.min("v").alias("v")).orderBy("id").collect()
    width = len(rows[0].v)
    books = Codebooks([], width)
    numbers = [[whole(float(c)) for c in r.v] for r in rows if len(r.v) == width]
    books.parts = [[row[low:high] for row in numbers] for low, high in books.cuts]
    return books


def moved(books: Codebooks, kept: DataFrame) -> Codebooks:
    """Each entry at the floor of the mean of its subvectors; entries without any stay."""
    sums = kept.select("v").mapInArrow(entry_sums(books), "part int, entry int, n long, sums array<string>")
    found = sums.groupBy("part", "entry").applyInArrow(total_sums, "part int, entry int, n long, sums array<string>").collect()
    parts = [[list(e) for e in p] for p in books.parts]
    for r in found:  # at most PARTS * ENTRIES rows
        parts[r.part][r.entry] = [int(s) // r.n for s in r.sums]
    return Codebooks(parts, books.width)


def coded_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", entries: int = ENTRIES,
                  rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks | None]:
    """(id, label, code, error, label_error) of every row with a whole vector, and the codebooks that the codes refer to."""
    spark = df.sparkSession
    folder = scratch_folder(spark, "codes")
    x = F.col(f"`{vector}`")
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf"))
    kept = df.where(x.isNotNull()).where(~F.exists(x, odd))
    kept = written(kept.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").alias("label"), x.alias("v")), f"{folder}/kept")
    books = first_codebooks(kept, entries)
    none = [F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")]
    if books is None:
        return kept.select("id", "label", *none, F.lit(None).cast("long").alias("label_error")), None
    fitting = kept.where(F.size("v") == books.width)
    for _ in range(rounds):
        books = moved(books, fitting)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hexes = np.array([f"{i:02x}" for i in range(entries)])
        for batch in batches:
            if not batch.num_rows:
                continue
            error, text = 0, None
            for _, entry, d2, *_ in books.assigned(matrix(batch.column(2), books.width)):
                text = hexes[entry] if text is None else np.char.add(text, hexes[entry])
                error = error + d2.astype(object)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text.tolist(), pa.string()),
                 pa.array([int(e) if e < LONG else None for e in error], pa.int64())], names=["id", "label", "code", "error"])

    kinds = kept.select("id", "label").schema.add("code", "string").add("error", "long")
    coded = fitting.mapInArrow(code, kinds).unionByName(kept.where(F.size("v") != books.width).select("id", "label", *none))
    coded = written(coded, f"{folder}/coded")
    beyond = F.max(F.col("code").isNotNull() & F.col("error").isNull())
    by_label = coded.groupBy(F.col("label").alias("__label")).agg(
        F.sum(F.col("error").cast("decimal(38,0)")).alias("__sum"), beyond.alias("__beyond"))
    by_label = written(by_label.select("__label", F.when(~F.col("__beyond"), F.expr("try_cast(__sum AS bigint)")).alias("label_error")), f"{folder}/labels")
    result = coded.join(by_label, F.col("label").eqNullSafe(F.col("__label"))).drop("__label")
    return result.select("id", "label", "code", "error", "label_error"), books
