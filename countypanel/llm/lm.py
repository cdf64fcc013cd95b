"""A backed-off n-gram language model, scored by a weighted automaton.

Words and one end token per text are tokens. Counts of the training texts smooth each order into the
next lower one, p(w | h) = (c(h w) + mu * p(w | h')) / (c(h) + mu), where h' drops the first word of h; the lowest is
(c(w) + add) / (N + add * (V + 1)). As an automaton: states are contexts; a seen n-gram is an arc
that carries its log-probability; from a state without the arc a failure arc of weight log(mu / (c(h) + mu)) leads to the state of h'.
A text is read once from left to right, from the empty state; each token takes failure arcs until an arc
fits, and the log-probabilities add up.

The model covers all training texts and grows with them, so no task holds it. Texts are cut into blocks, written once.
Each block lists its distinct n-grams with its training counts; lists meet by hash range, are summed up there, and go back to the
blocks, each of which then has the part of the automaton that its own texts can reach.

Defined results: null texts are empty; an empty text is scored by its end token; a null doc_id is in training
(its text form is null, which has no remainder); rows that repeat are scored and counted each; without any training text every token is unknown; an empty table
gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch_folder, written
from .text import mixed, text_slices, word_bounds, word_hashes

ORDER = 2
ADD = 0.1
MU = 16.0
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 8 << 20
END = np.uint64(0x656E64206F662074)
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
BLOCK = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("text", pa.large_string())])


def text_blocks(docs: DataFrame, held_out) -> DataFrame:
    """Runs of texts of about BLOCK_BYTES as compressed Arrow streams: (block, bytes, content)."""
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                         F.coalesce("text", F.lit("")).alias("text"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, task = 0, TaskContext.get().partitionId()
        waiting, size = [], 0

        def block():
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, BLOCK, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                for part in waiting:
                    stream.write_batch(part)
            return pa.RecordBatch.from_pydict({"block": pa.array([(task << 24) + number], pa.int64()), "bytes": pa.array([size], pa.int64()),
                                               "content": pa.array([out.getvalue().to_pybytes()], pa.binary())})

        for batch in batches:
            texts = batch.column(2).cast(pa.large_string())
            for low, high, data, _ in text_slices(texts):
                waiting.append(pa.RecordBatch.from_arrays(
                    [c.slice(low, high - low) for c in (batch.column(0), batch.column(1), texts)], schema=BLOCK))
                size += len(data)
                if size >= BLOCK_BYTES:
                    yield block()
                    number, waiting, size = number + 1, [], 0
        if waiting:
            yield block()

    return chosen.mapInArrow(gather, "block long, bytes long, content binary")


def block_tokens(content: bytes) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """A block's rows, the hashes of all its tokens, ends of text included, and the first token of each text."""
    table = pa.ipc.open_stream(content).read_all()
    parts, counts = [], []
    for batch in table.to_batches():
        for low, high, data, offsets in text_slices(batch.column(2)):
            starts, ends, owner = word_bounds(data, offsets)
            each = np.bincount(owner, minlength=high - low)
            tokens = np.full(len(starts) + high - low, END, dtype=np.uint64)
            tokens[np.arange(len(starts)) + owner] = word_hashes(data, starts, ends)
            parts.append(tokens)
            counts.append(each + 1)
    tokens = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return table, tokens, np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1, np.int64)


def gram_keys(tokens: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n tokens that end at each position; 0 where the text has fewer before it."""
    if n == 1:
        return tokens
    key = np.zeros(len(tokens), dtype=np.uint64)
    if len(tokens) >= n:
        part = np.zeros(len(tokens) - n + 1, dtype=np.uint64)
        for k in range(n):
            part = mixed(part ^ tokens[k : len(tokens) - n + 1 + k]) + np.uint64(n)
        key[n - 1 :] = part
    place = np.arange(len(tokens)) - np.repeat(first[:-1], np.diff(first))
    key[place < n - 1] = 0
    return key


def block_grams(tokens: np.ndarray, first: np.ndarray, training: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a block's n-grams, ascending, and their counts in training texts."""
    key = gram_keys(tokens, first, n)
    real = np.ones(len(key), dtype=bool) if n == 1 else key != 0
    keys, at = np.unique(key[real], return_inverse=True)
    return keys, np.bincount(at, weights=np.repeat(training, np.diff(first))[real], minlength=len(keys)).astype(np.int64)


def shard_bounds(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's keys begin: shards are equal ranges of hashes."""
    edges = [np.uint64(((1 << 64) * s) // shards) for s in range(1, shards)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(edges, dtype=np.uint64)), [len(keys)]])


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as differences, each in as many bytes as it needs; their lengths come first."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    size = np.ones(len(gaps), dtype=np.int64)
    for k in range(1, 8):
        size += gaps >> np.uint64(8 * k) > 0
    start = np.concatenate([[0], np.cumsum(size)])
    body = np.zeros(start[-1], dtype=np.uint8)
    for k in range(8):
        here = size > k
        body[start[:-1][here] + k] = (gaps[here] >> np.uint64(8 * k)).astype(np.uint8)
    lengths = size.astype(np.uint8)
    lengths = np.concatenate([lengths, np.zeros(len(lengths) % 2, np.uint8)])
    return (lengths[::2] | (lengths[1::2] << 4)).tobytes() + body.tobytes()


def unpacked_keys(data: bytes, n: int) -> np.ndarray:
    halves = np.frombuffer(data, dtype=np.uint8, count=-(-n // 2))
    size = np.empty(2 * len(halves), dtype=np.int64)
    size[::2], size[1::2] = halves & 15, halves >> 4
    size = size[:n]
    body = np.frombuffer(data, dtype=np.uint8, offset=len(halves))
    start = np.concatenate([[0], np.cumsum(size)])[:-1]
    gaps = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        here = size > k
        gaps[here] |= body[start[here] + k].astype(np.uint64) << np.uint64(8 * k)
    return np.cumsum(gaps, dtype=np.uint64)


def packed_counts(counts: np.ndarray) -> bytes:
    """Counts, most of them small: bytes, with 255 for those that follow in full."""
    large = counts >= 255
    return zlib.compress(np.where(large, 255, counts).astype(np.uint8).tobytes() + counts[large].astype(np.int64).tobytes(), 1)


def unpacked_counts(data: bytes, n: int) -> np.ndarray:
    raw = zlib.decompress(data)
    out = np.frombuffer(raw, dtype=np.uint8, count=n).astype(np.int64)
    out[out == 255] = np.frombuffer(raw, dtype=np.int64, offset=n)
    return out


LIST = "gram int, shard int, block long, n long, keys binary, counts binary"


def block_lists(blocks: DataFrame, order: int, shards: int) -> DataFrame:
    """Each block's distinct n-grams of each order, by shard."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                table, tokens, first = block_tokens(content.as_py())
                training = ~table["held_out"].to_numpy()
                for n in range(1, order + 1):
                    keys, counts = block_grams(tokens, first, training, n)
                    bounds = shard_bounds(keys, shards)
                    rows = [(n, s, number, int(b - a), packed_keys(keys[a:b]), packed_counts(counts[a:b]))
                            for s, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])) if b > a]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                        names=["gram", "shard", "block", "n", "keys", "counts"]) if rows else None

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (b for b in make(batches) if b is not None)

    return blocks.select("block", "content").mapInArrow(some, LIST)


def summed_lists(lists: DataFrame) -> DataFrame:
    """For each list the counts of all blocks: (gram, shard, block, n, counts, known, total).

    One list per shard and order also says how many keys the shard knows and how many tokens these are.
    """
    def add(table: pa.Table) -> pa.Table:
        sizes = table["n"].to_pylist()
        keys = [unpacked_keys(k.as_py(), n) for k, n in zip(table["keys"], sizes)]
        everything, at = np.unique(np.concatenate(keys), return_inverse=True)
        mine = np.concatenate([unpacked_counts(c.as_py(), n) for c, n in zip(table["counts"], sizes)])
        total = np.zeros(len(everything), dtype=np.int64)
        np.add.at(total, at, mine)
        ends = np.cumsum(sizes)
        found = [packed_counts(total[at[e - n : e]]) for e, n in zip(ends, sizes)]
        first = np.arange(len(sizes)) == 0
        return pa.table({"gram": table["gram"], "shard": table["shard"], "block": table["block"], "n": table["n"],
                         "counts": pa.array(found, pa.binary()), "known": np.where(first, int((total > 0).sum()), 0),
                         "total": np.where(first, int(total.sum()), 0)})

    return lists.groupBy("gram", "shard").applyInArrow(
        add, "gram int, shard int, block long, n long, counts binary, known long, total long")


class Automaton:
    """The part of the automaton that a block's texts reach: arcs of each order as ascending keys with counts."""

    def __init__(self, grams: list[tuple[np.ndarray, np.ndarray]], tokens: int, known: int, add: float, mu: float):
        self.grams, self.tokens, self.known, self.add, self.mu = grams, tokens, known, add, mu

    def counts(self, keys: np.ndarray, n: int) -> np.ndarray:
        held, counts = self.grams[n - 1]
        return counts[np.searchsorted(held, keys)]

    def read(self, tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per token: its count, the lowest order's log10 probability, and that of the step which the automaton takes.

        All texts are read at once, position by position of the same kind: `step` starts as the arc of the empty
        state; for each longer context, a token whose arc is there takes it, and one whose arc is missing keeps the lower state's
        step and pays the failure arc. A context that was never seen is no state and costs nothing.
        """
        count = self.counts(tokens, 1)
        base = (count + self.add) / (self.tokens + self.add * (self.known + 1))
        step = base
        context = None
        for n in range(2, len(self.grams) + 1):
            key = gram_keys(tokens, first, n)
            there = key != 0
            seen = np.zeros(len(tokens), dtype=np.int64)
            seen[there] = self.counts(key[there], n)
            before = count if context is None else context
            state = np.zeros(len(tokens), dtype=np.int64)  # how often the n - 1 tokens before were seen
            state[1:] = before[:-1]
            state[~there] = 0
            failure = self.mu / (state + self.mu)
            step = np.where(state > 0, seen / (state + self.mu) + failure * step, step)
            context = seen
        return count, np.log10(base), np.log10(step)


def scored_documents(docs: DataFrame, held_out, order: int = ORDER, add: float = ADD, mu: float = MU) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text.

    `held_out` is a column; texts where it is not true train the model.
    """
    folder = scratch_folder(docs.sparkSession, "lm")
    blocks = written(text_blocks(docs, held_out), f"{folder}/blocks")
    size = blocks.agg(F.sum("bytes")).first()[0] or 0
    shards = max(1, size // SHARD_BYTES)
    sums = written(summed_lists(block_lists(blocks.repartition(max(1, size // BLOCK_BYTES), "block"), order, shards)), f"{folder}/sums")
    known, tokens = (n or 0 for n in sums.where("gram = 1").agg(F.sum("known"), F.sum("total")).first())

    def score(held: pa.Table, answers: pa.Table) -> pa.Table:
        out = {name: [] for name in ("doc_id", "held_out", "n_tokens", "n_known", "base_score", "score")}
        for content in held["content"]:
            table, words, first = block_tokens(content.as_py())
            training = ~table["held_out"].to_numpy()
            order_of = answers.sort_by([("gram", "ascending"), ("shard", "ascending")])
            grams = []
            for n in range(1, order + 1):
                keys, _ = block_grams(words, first, training, n)
                mine = order_of.filter(pc.equal(order_of["gram"], n))
                counts = [unpacked_counts(c.as_py(), k) for c, k in zip(mine["counts"], mine["n"].to_pylist())]
                grams.append((keys, np.concatenate([np.zeros(0, np.int64), *counts])))
            count, base, step = Automaton(grams, tokens, known, add, mu).read(words, first)
            out["doc_id"].append(table["doc_id"].combine_chunks())
            out["held_out"].append(table["held_out"].combine_chunks())
            out["n_tokens"].append(pa.array(np.diff(first)))
            out["n_known"].append(pa.array(np.add.reduceat((count > 0).astype(np.int64), first[:-1])))
            out["base_score"].append(pa.array(np.add.reduceat(base, first[:-1])))
            out["score"].append(pa.array(np.add.reduceat(step, first[:-1])))
        done = pa.table({name: pa.chunked_array(parts) for name, parts in out.items()})
        return done.add_column(4, "train_tokens", pa.array(np.full(done.num_rows, tokens), pa.int64()))

    return (
        blocks.select(F.col("block").alias("number"), "content").groupBy("number")
        .cogroup(sums.select("block", "gram", "shard", "n", "counts").groupBy("block"))
        .applyInArrow(score, SCORED)
    )
