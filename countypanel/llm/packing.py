"""Best-fit packing of documents into bins of a fixed number of words, under conflicts.

A document longer than a bin fills whole bins and leaves a rest. Rests are dealt to
groups of bounded size by hash, equal ones counted first and dealt in lots of at most 64, and packed there from the largest down: a bin may hold no
two pieces of one source and no two of one cluster of copies. Bins are kept in the order
of what they have left, each with a bitmap of its sources and one of its clusters; the
search goes on from the smallest room that suffices through its successors until the
first compatible bin, which is the tightest one. Without one a new bin opens.

Defined results: a null or empty text (size null, 0 or less) gets no piece; a null
source is a source of its own; a null cluster conflicts with nothing; repeated rows are
packed as often as they occur; an empty table gives no bins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP_ROWS = 2_000
COPIES = 64
LOOK = 128
PIECES = "doc_id long, source string, cluster long, size long, piece long, first long, words long, bin string, place long, room long"


def pieces_of(items: DataFrame, capacity: int) -> DataFrame:
    """One row per piece of each document: whole bins first, then the rest."""
    size = F.col("size")
    last = F.floor((size - 1) / F.lit(capacity))
    return (
        items.where(size > 0).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        .withColumn("first", F.col("piece") * capacity)
        .withColumn("words", F.least(F.lit(capacity).cast("long"), size - F.col("first")))
    )


def bitmaps(keys: list) -> np.ndarray:
    """One row of 64-bit words per entry, with the bit of its key set; keys that occur once need none."""
    seen: dict = {}
    for key in keys:
        if key is not None:
            seen[key] = seen.get(key, 0) + 1
    bit = {key: i for i, key in enumerate(k for k, n in seen.items() if n > 1)}
    out = np.zeros((len(keys), max(1, -(-len(bit) // 64))), dtype=np.uint64)
    for i, key in enumerate(keys):
        if key in bit:
            out[i, bit[key] // 64] |= np.uint64(1 << (bit[key] % 64))
    return out


def best_fit(words: np.ndarray, sources: list, clusters: list, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin of each piece, and what each bin has left. Pieces are taken in the given order."""
    marks = np.concatenate([bitmaps(sources), bitmaps(clusters)], axis=1)
    room = np.empty(len(words), dtype=np.int64)  # of open bins, ascending
    held = np.zeros((len(words), marks.shape[1]), dtype=np.uint64)
    number = np.empty(len(words), dtype=np.int64)
    bins = np.empty(len(words), dtype=np.int64)
    left: list[int] = []
    n = 0
    for i, need in enumerate(words):
        at = int(np.searchsorted(room[:n], need))
        found = -1
        while at < n:
            clash = (held[at : min(at + LOOK, n)] & marks[i]).any(axis=1)
            free = int(clash.argmin())
            if not clash[free]:
                found = at + free
                break
            at += LOOK
        if found < 0:
            mine, rest, mark = len(left), capacity - int(need), marks[i]
            left.append(rest)
            found = n
            n += 1
        else:
            mine, rest, mark = int(number[found]), int(room[found] - need), held[found] | marks[i]
            left[mine] = rest
        bins[i] = mine
        to = int(np.searchsorted(room[:found], rest))
        for line, value in ((room, rest), (number, mine), (held, mark)):
            line[to + 1 : found + 1] = line[to:found].copy()
            line[to] = value
    return bins, np.array(left, dtype=np.int64)


def pack(items: DataFrame, capacity: int = 2048, group_rows: int = GROUP_ROWS) -> DataFrame:
    """`items` (doc_id, source, cluster, size) as pieces in bins.

    Returns doc_id, source, cluster, size, piece, first (word of the document), words, bin, place (first
    word in the bin) and room (words that the bin has left). The number of groups follows
    the number of pieces, which one aggregate gives.
    """
    chosen = items.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("cluster").cast("long"),
                          F.col("size").cast("long"))
    pieces = pieces_of(chosen, capacity)
    names = [part.split()[0] for part in PIECES.split(", ")]
    full = pieces.where(F.col("words") == capacity).select(
        *names[:7],
        F.concat_ws("-", F.lit("full"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                    F.col("piece").cast("string"), F.hex(F.monotonically_increasing_id())).alias("bin"),
        F.lit(0).cast("long").alias("place"), F.lit(0).cast("long").alias("room"))
    rests = pieces.where(F.col("words") < capacity)
    groups = max(1, -(-chosen.where("size > 0").count() // group_rows))
    lots = (
        rests.groupBy(*names[:7]).agg(F.count("*").alias("rows"))
        .withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / F.lit(COPIES)))))
        .withColumn("copies", F.least(F.lit(COPIES).cast("long"), F.col("rows") - F.col("lot") * COPIES))
    )
    dealt = lots.withColumn("group", F.pmod(F.xxhash64("doc_id", "source", "cluster", "size", "lot"), F.lit(groups)))

    def packed(table: pa.Table) -> pa.Table:
        table = table.take(pa.array(np.repeat(np.arange(table.num_rows), table["copies"].to_numpy())))
        table = table.sort_by([("words", "descending"), ("doc_id", "ascending"), ("source", "ascending"), ("cluster", "ascending")])
        source, cluster = table["source"].to_pylist(), table["cluster"].to_pylist()
        words = table["words"].to_numpy()
        bins, left = best_fit(words, ["" if s is None else "=" + s for s in source], cluster, capacity)
        order = np.argsort(bins, kind="stable")
        ahead = np.cumsum(words[order]) - words[order]
        begins = np.flatnonzero(np.r_[True, bins[order][1:] != bins[order][:-1]])
        place = np.empty(len(words), dtype=np.int64)
        place[order] = ahead - np.repeat(ahead[begins], np.diff(np.r_[begins, len(words)]))
        group = table["group"][0].as_py()
        return pa.table({**{c: table[c] for c in names[:7]}, "bin": pa.array([f"{group}-{b}" for b in bins], pa.string()),
                         "place": pa.array(place), "room": pa.array(left[bins])})

    return full.unionByName(dealt.select(*names[:7], "copies", "group").groupBy("group").applyInArrow(packed, PIECES))
