"""Mix sources to target weights by fixed-length blocks of words.

Each source's documents, in a pseudorandom order, form one stream of words that is cut
into blocks. Every output shard draws how many slots each source gets from a multinomial
over what the sources still owe; a source's slots, numbered through all shards, go
through a pseudorandom permutation of its blocks, a new one for each pass. Slots and
documents meet by block index.

The last slot of a source is cut so that the source gives its target to the word. Since
a target never exceeds twice the source's size and each pass uses a block once, no
document gives more than twice its words.

Defined results: null or empty texts have size 0 and give nothing; a null source is a
source of its own and comes last; a source of size 0 has target 0; documents that repeat
are separate rows; an empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import scratch_folder, written
from .text import text_slices, word_bounds, word_counts

WEIGHTS = (5, 2, 1)
BUCKET_ROWS = 1_000
COPIES = 64
FEISTEL_ROUNDS = 6


def with_word_counts(docs: DataFrame, name: str = "size") -> DataFrame:
    """`docs` without its texts, with the number of words of each (long)."""
    rest = [c for c in docs.columns if c not in ("text", name)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            sizes = np.concatenate([np.zeros(0, np.int64), *(word_counts(d, o) for _, _, d, o in text_slices(text))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in rest] + [pa.array(sizes.astype(np.int64))],
                names=[*rest, name])

    chosen = docs.select(*[f"`{c}`" for c in rest], "text")
    schema = chosen.drop("text").schema.add(name, "long")
    return chosen.mapInArrow(count, schema)


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple = WEIGHTS) -> DataFrame:
    """Target words of each source: (source, documents, source_size, weight, target).

    The windows run over one row per source. Capping and resharing until nothing is above
    its cap has one fixed point, min(weight * level, cap); the level is found by walking
    through the sources in the order of cap over weight.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    rows = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(most))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = (
        rows.withColumn("total", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", (F.col("total") - F.col("capped")) / F.col("left"))
        .withColumn("free", F.col("level") * F.col("weight") <= F.col("cap"))
        .withColumn("first", F.max(F.when(F.col("free"), F.col("level"))).over(everything))
    )
    target = F.least(F.col("cap"), F.coalesce(F.col("first") * F.col("weight"), F.col("cap")))
    return rows.select("source", "documents", "source_size", "weight", target.alias("target"))


def permuted(index: np.ndarray, n: int, key: int, backward: bool = False) -> np.ndarray:
    """A pseudorandom permutation of range(n), or its inverse, applied to `index`: a Feistel
    network over the next even power of two, walked until the value lies in the range."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)

    def scrambled(x: np.ndarray, turn: int) -> np.ndarray:
        x = (x + np.uint64((key * 1_000_003 + turn * 7_919) % (1 << 62))) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return (x >> np.uint64(32)) & mask

    out = np.array(index, dtype=np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for turn in range(FEISTEL_ROUNDS):
            if backward:
                left, right = right ^ scrambled(left, FEISTEL_ROUNDS - 1 - turn), left
            else:
                left, right = right, left ^ scrambled(right, turn)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def shard_counts(owed: np.ndarray, shards: int, seed: int) -> Iterator[np.ndarray]:
    """Slots of each source in each shard: multinomial over what is owed, never more than that."""
    owed = owed.astype(np.int64).copy()
    random = np.random.Generator(np.random.Philox(seed))
    for shard in range(shards):
        slots = -(-int(owed.sum()) // (shards - shard))
        given = np.zeros_like(owed)
        while (missing := slots - int(given.sum())) > 0:
            rest = owed - given
            given += np.minimum(random.multinomial(missing, rest / rest.sum()), rest)
        owed -= given
        yield given


def draw_slots(targets: DataFrame, block: int, shard_slots: int, seed: int) -> DataFrame:
    """The slots of all shards: (source, shard, slot, part, words).

    `part` is the block's index in its source, `words` how many of its words the slot takes.
    The table of counts per shard and source is drawn in one task, as each draw depends on the last;
    it has one row per source and shard, and the slots are made from it in parallel.
    """
    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        table = pa.Table.from_batches(rows).sort_by("ordinal")
        size = table["source_size"].to_numpy()
        want = np.floor(table["target"].to_numpy()).astype(np.int64)
        blocks = -(-size // block)
        tail = size - (blocks - 1) * block
        # slots needed: whole passes, then as many blocks as cover the rest even if the short one is among them
        owed = np.array([0 if w <= 0 else (w // s) * n + min(n, -(-(w % s + block - t) // block) if w % s else 0)
                         for w, s, n, t in zip(want, size, blocks, tail)], dtype=np.int64)
        shards = max(1, -(-int(owed.sum()) // shard_slots))
        start = np.zeros_like(owed)
        for shard, given in enumerate(shard_counts(owed, shards, seed)):
            there = np.flatnonzero(given)
            yield pa.RecordBatch.from_pydict({
                "ordinal": pa.array(table["ordinal"].to_numpy()[there], pa.int64()),
                "shard": pa.array(np.full(len(there), shard), pa.int64()),
                "start": pa.array(start[there]), "given": pa.array(given[there])})
            start = start + given

    listed = targets.withColumn("ordinal", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).cast("long"))
    counts = (
        listed.select("ordinal", "source_size", "target").where("source_size > 0").coalesce(1)
        .mapInArrow(draw, "ordinal long, shard long, start long, given long")
    )

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            for ordinal, size, target, shard, start, given in zip(*(rows[c] for c in (
                    "ordinal", "source_size", "target", "shard", "start", "given"))):
                blocks, want = -(-size // block), int(target // 1)
                slot = np.arange(start, start + given)
                part = np.empty(given, dtype=np.int64)
                words = np.empty(given, dtype=np.int64)
                for turn in np.unique(slot // blocks):
                    here = slot // blocks == turn
                    inside = slot[here] % blocks
                    key = (seed * 8_191 + int(ordinal) * 131 + int(turn)) & 0x7FFFFFFF
                    part[here] = permuted(inside, blocks, key)
                    lengths = np.where(part[here] == blocks - 1, size - (blocks - 1) * block, block)
                    # words of the pass before each slot: full blocks, less the short block if it came earlier
                    short = int(permuted(np.array([blocks - 1]), blocks, key, backward=True)[0])
                    taken = turn * size + inside * block - np.where(inside > short, blocks * block - size, 0)
                    words[here] = np.clip(want - taken, 0, lengths)
                keep = words > 0
                yield pa.RecordBatch.from_pydict({
                    "ordinal": pa.array(np.full(int(keep.sum()), ordinal), pa.int64()),
                    "shard": pa.array(np.full(int(keep.sum()), shard), pa.int64()),
                    "slot": pa.array(slot[keep]), "part": pa.array(part[keep]), "words": pa.array(words[keep])})

    drawn = (
        counts.join(listed.select("ordinal", "source_size", "target"), "ordinal")
        .select("ordinal", "source_size", "target", "shard", "start", "given")
        .mapInArrow(spread, "ordinal long, shard long, slot long, part long, words long")
    )
    return drawn.join(listed.select("ordinal", "source"), "ordinal").select("source", "ordinal", "shard", "slot", "part", "words")


def in_lots(rows: DataFrame, most: int = COPIES) -> DataFrame:
    """`rows` with a number `lot` that at most `most` equal rows share: they are counted, and made again from the counts."""
    counted = rows.groupBy(*[F.col(f"`{c}`") for c in rows.columns]).agg(F.count("*").alias("__n"))
    lots = counted.withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / F.lit(most)))))
    copies = F.least(F.lit(most).cast("long"), F.col("__n") - F.col("lot") * most)
    lots = lots.repartition(*[F.col(f"`{c}`") for c in rows.columns], "lot")  # a row that repeats is not made again by one task
    return lots.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), copies))).drop("__n", "__copy")


def with_positions(sizes: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    """`sizes` with each document's first word in its source's stream (`begin`).

    Documents are ordered by hash within buckets of a source, so that no task holds a whole
    source; the buckets' totals are summed up first. Rows alike in all columns go to buckets in lots.
    """
    others = [F.col(f"`{c}`") for c in sizes.columns if c not in ("source", "doc_id", "size")]
    sizes = in_lots(sizes)
    hashed = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size"), F.col("lot"))
    buckets = F.greatest(F.lit(1), F.ceil(F.col("documents") / F.lit(BUCKET_ROWS))).cast("long")
    rows = (
        sizes.join(targets.select(F.col("source").alias("__s"), "documents", "source_size", "target"),
                   F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
        .withColumn("order_hash", hashed)
        .withColumn("bucket", F.pmod(F.col("order_hash"), buckets))
    )
    totals = (
        rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
        .withColumn("base", F.sum("bucket_size").over(
            Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)))
        .select(F.col("source").alias("__s"), F.col("bucket").alias("__b"), F.coalesce("base", F.lit(0)).alias("base"))
    )
    inside = Window.partitionBy("source", "bucket").orderBy("order_hash", F.col("doc_id").asc_nulls_last(), "size", *others)
    before = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        rows.withColumn("ahead", before).withColumn("turn", F.row_number().over(inside))
        .join(totals, F.col("source").eqNullSafe(F.col("__s")) & (F.col("bucket") == F.col("__b")))
        .withColumn("begin", F.col("base") + F.col("ahead"))
        .drop("__s", "__b", "base", "ahead", "documents", "order_hash", "lot")
    )


class Mix:
    """Documents with positions and targets, and the slots that take from them, as written tables."""

    def __init__(self, docs: DataFrame, block: int = 1024, shard_slots: int = 4096, seed: int = 17,
                 share: float = 1.5, most: float = 2.0, weights: tuple = WEIGHTS, extra: tuple = ()):
        spark = docs.sparkSession
        folder = scratch_folder(spark, "mix")
        self.block = block
        sizes = written(with_word_counts(docs.select("doc_id", "source", "text", *extra)), f"{folder}/sizes")
        targets = written(source_targets(sizes, share, most, weights), f"{folder}/targets")
        self.documents = written(with_positions(sizes, targets, seed), f"{folder}/documents")
        self.slots = written(draw_slots(targets, block, shard_slots, seed), f"{folder}/slots")

    def pieces(self) -> DataFrame:
        """What each slot takes from each document: (doc_id, source, begin, turn, bucket, shard, slot, first, last).

        `first` and `last` are words of the document, `last` exclusive.
        """
        b = F.lit(self.block)
        parts = self.documents.where("size > 0").withColumn("part", F.explode(F.sequence(
            F.floor(F.col("begin") / b), F.floor((F.col("begin") + F.col("size") - 1) / b))))
        slots = self.slots.select(F.col("source").alias("__s"), F.col("part").alias("__p"), "shard", "slot", "words")
        joined = parts.join(slots, F.col("source").eqNullSafe(F.col("__s")) & (F.col("part") == F.col("__p")))
        start = F.col("part") * b
        first = F.greatest(start - F.col("begin"), F.lit(0))
        last = F.least(start + F.col("words") - F.col("begin"), F.col("size"))
        return (
            joined.withColumn("first", first).withColumn("last", last).where("last > first")
            .drop("__s", "__p", "words", "part")
        )

    def taken(self) -> DataFrame:
        """Every document with the words that the mix takes from it, repeats counted."""
        key = ["source", "bucket", "turn"]
        sums = self.pieces().groupBy(*key).agg(F.sum(F.col("last") - F.col("first")).alias("taken"))
        renamed = sums.select(*[F.col(c).alias("__" + c) for c in key], "taken")
        same = F.col("source").eqNullSafe(F.col("__source")) & (F.col("bucket") == F.col("__bucket")) & (F.col("turn") == F.col("__turn"))
        return (
            self.documents.join(renamed, same, "left")
            .withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
            .drop("__source", "__bucket", "__turn")
        )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: one row per piece that a slot takes, with the piece's text.

    A document that a slot takes whole comes as written; of a part, the text from its first
    to its last word. The other columns repeat; `n_chars`, where there is one, is that of
    the piece. Rows that agree in doc_id, text and source share their pieces.
    """
    columns = docs.columns
    key = ["doc_id", "__mark", "source"]
    marked = docs.withColumn("__mark", F.xxhash64("text"))
    mix = Mix(marked, extra=("__mark",), **options)
    place = Window.partitionBy(*key)
    numbers = mix.documents.select(*key, "bucket", "turn").withColumn(
        "__copy", F.row_number().over(place.orderBy("bucket", "turn")))
    runs = (
        mix.pieces().groupBy("source", "bucket", "turn", "doc_id", "__mark", "size")
        .agg(F.array_sort(F.collect_list(F.struct("shard", "slot", "first", "last"))).alias("__runs"))
        .join(numbers.select(F.col("source").alias("__ns"), F.col("bucket").alias("__nb"), F.col("turn").alias("__nt"), "__copy"),
              F.col("source").eqNullSafe(F.col("__ns")) & (F.col("bucket") == F.col("__nb")) & (F.col("turn") == F.col("__nt")))
        .select(F.col("doc_id").alias("__id"), F.col("__mark").alias("__m"), F.col("source").alias("__s"),
                F.col("__copy").alias("__c"), F.col("size").alias("__size"), "__runs")
    )
    joined = marked.withColumn("__copy", F.row_number().over(place.orderBy(F.lit(0)))).join(
        runs, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__mark") == F.col("__m"))
        & F.col("source").eqNullSafe(F.col("__s")) & (F.col("__copy") == F.col("__c")))
    chosen = joined.select(*[f"`{c}`" for c in columns], "__size", "__runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            runs_of = batch.column(batch.schema.get_field_index("__runs")).to_pylist()
            sizes = batch.column(batch.schema.get_field_index("__size")).to_pylist()
            for low, high, data, offsets in text_slices(text):
                starts, ends, owner = word_bounds(data, offsets)
                first_word = np.searchsorted(owner, np.arange(high - low))
                rows, texts = [], []
                raw = data.tobytes()
                for k in range(high - low):
                    for run in runs_of[low + k]:
                        if run["first"] == 0 and run["last"] == sizes[low + k]:
                            piece = raw[offsets[k] : offsets[k + 1]]
                        else:
                            w = first_word[k]
                            piece = raw[starts[w + run["first"]] : ends[w + run["last"] - 1]]
                        rows.append(low + k)
                        texts.append(piece.decode("utf-8"))
                at = pa.array(rows, pa.int64())
                arrays = []
                for name in columns:
                    if name == "text":
                        arrays.append(pa.array(texts, pa.string()))
                    elif name == "n_chars":
                        kind = batch.schema.field(name).type
                        arrays.append(pa.array([len(t) for t in texts], pa.int64()).cast(kind))
                    else:
                        arrays.append(batch.column(batch.schema.get_field_index(name)).take(at))
                yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return chosen.mapInArrow(cut, docs.schema)
