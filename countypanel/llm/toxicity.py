"""Toxicity scores by a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

Features are the distinct n-grams of a text's code points (A-Z lower-cased, hashed to 2**BITS numbers). On labelled texts, each
feature's ratio is log(share of toxic texts that hold it / share of clean ones), smoothed; a logistic regression is
fitted on the features times their ratios, each text scaled to length one. A text's score is that
regression's probability.

The classifier is fitted on a bounded sample of labelled texts, `fit_rows` at most, half of each class,
those with the smallest hashes of doc_id. In the regression the texts of a class weigh together what the class
has among all labels, so that 0.5 means the same however the sample is made up. Every text is scored in whole.
The sample's feature numbers reach the task that fits in rows of bounded size and lie in a file of that task, which each
step reads in blocks: its memory depends on the number of features there are, not on the length of the texts.

Where toxic labels are rare, scores of texts with few toxic features are low, though they stand apart from those of clean ones. So `cut` finds the
score that tells the classes apart with the fewest errors, on labelled texts that the classifier has not seen.

Defined results: null and empty texts, and those shorter than an n-gram, score by the intercept alone; several labels of one
doc_id count as the largest; null or other labels are ignored; without labels of both classes every
score is the smoothed share of toxic labels; rows that repeat are scored each; an empty table gives no rows.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import text_slices

ORDERS = (3, 4, 5)
BITS = 20
FIT_ROWS = 5_000
SMOOTHING = 1.0
PENALTY = 4e-4  # for each text, so that a score means the same whatever the size of the sample
STEPS = 60
MIN_TEXTS = 3
SLICE_BYTES = 1 << 19  # of texts whose features are found at once
PIECE = 1 << 9  # feature numbers in a row on the way to the fit
BATCH_PIECES = 1 << 12
BLOCK = 1 << 19  # feature numbers that the fit reads at once, or those of one text
MIN_JUDGED = 20  # unseen texts of each class
CUT_STEPS = 100  # for each unit of log odds


@dataclass
class Model:
    weights: np.ndarray
    intercept: float


def text_features(text: pa.Array) -> Iterator[np.ndarray]:
    """The distinct feature numbers of each text, in no order."""
    stamp = np.zeros(1 << BITS, dtype=np.int32)
    for low, high, data, offsets in text_slices(text, SLICE_BYTES):
        chars = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
        begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        chars = np.where((chars >= 65) & (chars <= 90), chars + np.uint32(32), chars).astype(np.uint32)
        hashed = []
        for n in ORDERS:
            h = np.full(max(len(chars) - n + 1, 0), (n * 0x9E3779B1) & 0xFFFFFFFF, dtype=np.uint32)
            for k in range(n):
                h ^= chars[k : k + len(h)]
                h *= np.uint32(0x85EBCA6B)
                h ^= h >> np.uint32(15)
            hashed.append(((h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS)).astype(np.int32))
        for k in range(high - low):
            a, b = begins[k], begins[k + 1]
            found = np.concatenate([h[a : max(b - n + 1, a)] for n, h in zip(ORDERS, hashed)])
            place = np.arange(len(found), dtype=np.int32)
            stamp[found] = place
            yield found[stamp[found] == place]


def text_scores(text: pa.Array, model: Model) -> np.ndarray:
    line = [model.weights[f].sum(dtype=np.float64) / np.sqrt(len(f)) if len(f) else 0.0 for f in text_features(text)]
    return 1 / (1 + np.exp(-np.clip(np.array(line) + model.intercept, -500, 500)))


class Rows:
    """Feature numbers of texts, in a file that only this task sees and that goes with it."""

    def __init__(self) -> None:
        self.file = tempfile.TemporaryFile()
        self.sizes: list[int] = []

    def __enter__(self) -> Rows:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()

    def add(self, numbers: np.ndarray, begins: bool = True) -> None:
        """A text's next numbers, its first ones if it begins."""
        if begins:
            self.sizes.append(0)
        self.sizes[-1] += len(numbers)
        self.file.write(numbers.tobytes())

    def blocks(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Runs of whole texts of BLOCK numbers at most, a longer text alone: first and last text, their sizes, their numbers."""
        sizes = np.array(self.sizes, dtype=np.int64)
        ends = np.cumsum(sizes)
        self.file.seek(0)
        low = 0
        while low < len(sizes):
            before = ends[low] - sizes[low]
            high = max(int(np.searchsorted(ends, before + BLOCK, side="right")), low + 1)
            held = self.file.read(4 * int(ends[high - 1] - before))
            yield low, high, sizes[low:high], np.frombuffer(held, dtype=np.int32)
            low = high


def fitted(features: Iterable[np.ndarray], toxic: np.ndarray, odds: float) -> Model:
    """The model of texts with these features."""
    with Rows() as rows:
        for f in features:
            rows.add(f)
        return regression(rows, toxic, odds)


def regression(rows: Rows, toxic: np.ndarray, odds: float) -> Model:
    """Ratios, then the regression by gradient steps of adapted length. `odds` are those of the toxic class at large,
    and so the weights of the two classes in it, whatever their numbers here. Sums are added up in the order of texts, so the blocks make no difference."""
    size = 1 << BITS
    counts = np.zeros((2, size), dtype=np.int32)
    for low, high, sizes, numbers in rows.blocks():
        bad = np.repeat(toxic[low:high] > 0, sizes)
        for c, of in zip(counts, (bad, ~bad)):
            c += np.bincount(numbers[of], minlength=size)
    share = [(c + SMOOTHING) / ((toxic == k).sum() + 2 * SMOOTHING) for c, k in zip(counts, (1, 0))]
    ratio = np.log(share[0] / share[1])
    kept = np.flatnonzero(counts.sum(axis=0) >= MIN_TEXTS)
    place = np.full(size, -1, dtype=np.int32)
    place[kept] = np.arange(len(kept), dtype=np.int32)
    del counts, share
    with Rows() as held:
        # Rows of one column more, which weighs nothing, so that no row is empty.
        for _, _, sizes, numbers in rows.blocks():
            for f in np.split(numbers, np.cumsum(sizes)[:-1]):
                c = place[f]
                held.add(np.append(c[c >= 0], np.int32(len(kept))))
        scale = (1 / np.sqrt(np.maximum(1, rows.sizes))).astype(np.float32)
        factor = np.append(ratio[kept], 0).astype(np.float32)
        large = odds / (1 + odds)
        weight = np.where(toxic > 0, large / toxic.mean(), (1 - large) / (1 - toxic.mean()))
        w, b = np.zeros(len(factor)), 0.0
        g2, b2 = np.full(len(factor), 1e-8), 1e-8
        error = np.empty(len(toxic))
        for _ in range(STEPS):
            v = (w * factor).astype(np.float32)
            g = np.zeros(len(factor))
            for low, high, sizes, column in held.blocks():
                z = np.add.reduceat(v[column], np.cumsum(sizes) - sizes) * scale[low:high] + b
                error[low:high] = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - toxic[low:high]) * weight[low:high]
                pull = np.repeat((error[low:high] * scale[low:high]).astype(np.float32), sizes)
                np.add.at(g, column.astype(np.intp), pull.astype(np.float64))
            g = (g * factor) / len(toxic) + PENALTY * w
            g2 += g * g
            w -= 0.1 * g / np.sqrt(g2)
            gb = float(error.mean())
            b2 += gb * gb
            b -= 0.3 * gb / np.sqrt(b2)
    weights = np.zeros(size, dtype=np.float32)
    weights[kept] = (w * factor)[:-1]
    return Model(weights, b)


def known_labels(labels: DataFrame, chosen: Column) -> DataFrame:
    """(doc_id, toxic) of the doc_ids that meet `chosen`."""
    return (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).where(chosen)
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )


def feature_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, toxic, piece from 0, features) of (doc_id, toxic, text): PIECE feature numbers a row, the last or only one of a text may hold less."""
    for batch in batches:
        row, piece, found = [], [], []

        def out() -> pa.RecordBatch:
            at = pa.array(row, pa.int64())
            columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array(piece, pa.int32()), pa.array(found, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "toxic", "piece", "features"])

        for k, f in enumerate(text_features(batch.column(2))):
            for number, a in enumerate(range(0, max(len(f), 1), PIECE)):
                row.append(k)
                piece.append(number)
                found.append(f[a : a + PIECE].tobytes())
                if len(row) == BATCH_PIECES:
                    yield out()
                    row, piece, found = [], [], []
        yield out()


def fit(docs: DataFrame, labels: DataFrame, train: Column, fit_rows: int = FIT_ROWS) -> Model:
    """A model of the labelled texts whose doc_id meets `train`; at most `fit_rows` of them reach the one task that fits it."""
    known = known_labels(labels, train)
    shares = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    toxic, clean = shares.get(1, 0), shares.get(0, 0)
    prior = (toxic + 1) / (toxic + clean + 2)
    nothing = Model(np.zeros(1 << BITS, dtype=np.float32), float(np.log(prior / (1 - prior))))
    if not toxic or not clean:
        return nothing
    by = [F.xxhash64("doc_id", F.lit(7)), F.col("doc_id")]
    some = [known.where(F.col("toxic") == c).orderBy(*by).limit(fit_rows // 2) for c in (0, 1)]
    sample = some[0].unionByName(some[1]).select(F.col("doc_id").alias("__id"), "toxic")
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("__id")).select("doc_id", "toxic", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, toxic int, piece int, features binary"
    sampled = texts.dropDuplicates(["doc_id"]).mapInArrow(feature_pieces, schema)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with Rows() as rows:
            toxic = []
            for batch in batches:
                for t, piece, f in zip(*(batch.column(k) for k in (1, 2, 3))):
                    if piece.as_py() == 0:
                        toxic.append(t.as_py())
                    rows.add(np.frombuffer(f.as_py(), dtype=np.int32), piece.as_py() == 0)
            if not toxic:
                return
            model = regression(rows, np.array(toxic, dtype=float), prior / (1 - prior)) if 0 < sum(toxic) < len(toxic) else nothing
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.intercept], pa.float64())], names=["weights", "intercept"])

    found = sampled.repartition(1).sortWithinPartitions("doc_id", "piece").mapInArrow(learn, "weights binary, intercept double").collect()
    return Model(np.frombuffer(found[0].weights, dtype=np.float32), found[0].intercept) if found else nothing


def scored(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """`docs` with the score of each text."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.intercept))
    columns = [c for c in docs.columns if c != name]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Model(*shared.value)
        for batch in batches:
            found = text_scores(batch.column(batch.schema.get_field_index("text")), held)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*columns, name])

    chosen = docs.select(*[f"`{c}`" for c in columns])
    return chosen.mapInArrow(score, chosen.select("*").schema.add(name, "double"))


def parting(steps: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> float | None:
    """The step from which on to call texts toxic so that the fewest are called wrongly, as the middle of the widest gap
    of steps that do the same; none if calling no text toxic is as good. Of each of the ascending `steps` the numbers of clean and toxic texts are given."""
    gain = np.cumsum((toxic - clean)[::-1])[::-1]
    if gain.max() <= 0:
        return None
    gap = np.diff(steps, prepend=steps[0])  # a cut at a step does the same down to the step before
    best = np.flatnonzero(gain == gain.max())
    at = best[np.argmax(gap[best])]
    return float(steps[at] - max(0.0, gap[at] - 1) / 2)


def cut(docs: DataFrame, labels: DataFrame, judged: Column, model: Model) -> float:
    """The score from which on to call texts toxic so that the fewest of the labelled texts whose doc_id meets `judged`, which `model`
    has not seen, are called wrongly. 0.5 if these hold less than MIN_JUDGED texts of a class or are not parted by their scores."""
    known = known_labels(labels, judged).select(F.col("doc_id").alias("__id"), F.col("toxic").alias("__toxic"))
    texts = docs.select("doc_id", "text").join(known, F.col("doc_id") == F.col("__id")).select("__toxic", "text")
    score = F.greatest(F.lit(1e-12), F.least(F.lit(1 - 1e-12), F.col("score")))
    step = F.floor(F.log(score / (1 - score)) * CUT_STEPS).alias("step")
    counts = (
        scored(texts, model).groupBy(step)
        .agg(F.count_if(F.col("__toxic") == 0).alias("clean"), F.count_if(F.col("__toxic") == 1).alias("toxic")).orderBy("step").collect()
    )
    steps, clean, toxic = (np.array([r[k] for r in counts], dtype=float) for k in range(3))
    if min(clean.sum(), toxic.sum()) < MIN_JUDGED:
        return 0.5
    found = parting(steps, clean, toxic)
    return 0.5 if found is None else 1 / (1 + float(np.exp(-found / CUT_STEPS)))


def held_out(share: int = 5) -> Column:
    """Whether a document is kept from training: crc32 of its doc_id as text, modulo `share`, is 0."""
    return F.crc32(F.col("doc_id").cast("string")) % share == 0
