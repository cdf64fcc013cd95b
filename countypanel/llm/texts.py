"""Near-duplicate texts by an LSH forest over MinHash signatures.

A document's set are its distinct word shingles. Each of a number of trees orders all documents by eight values of their
signatures, begun at another place. Documents with a common prefix are neighbours; how long it has to be is decided for each region
on its own: three values, and where more than REGION_ROWS documents share them, five, and then all eight; documents of such regions
enter as many trees again, which make up for the longer prefix. Of the pairs of a region, those
whose whole signatures agree enough are candidates. A region that is crowded even at eight values is cut, and all of it hangs together.

Documents with equal sets are one class from the start. Within a task, sure candidates are reduced to a spanning forest, whose edges are
confirmed on full sets, and so are doubtful ones of few documents. What hangs together by the other candidates is a cluster: where its
documents are not one component yet, every pair of it from different components is confirmed. For that a cluster is cut into parts; a task
gets two parts with their texts, counts the shingles that its documents share, and returns a spanning forest of the links. So no row stands
for a pair that is not confirmed to be a link, and documents already joined do not meet again.

Defined results: null, empty and blank texts have an empty set, n_shingles 0, and link with nothing; a text
of fewer words than a shingle is one shingle; very long texts are handled whole, one at a time while they are signed; rows that share a doc_id
are one document in links; a null doc_id is kept and names no component; an empty table gives no rows; other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch_folder, written
from .components import components
from .text import mixed, shingles, text_slices, word_bounds, word_hashes

TREES = 12
HASHES = 96
DEPTHS = (3, 5, 8)
REGION_ROWS = 1_024
BATCH_ROWS = 4_096
FOREST_PAIRS = 4_096
RANGE_ROWS = 150_000
BUCKET_EDGES = 1_500
FEW = 4
PART_ROWS = 512
PART_SHINGLES = 500_000
GATHERED = 1 << 20
SIGNED = "doc_id long, n_shingles long, h1 long, h2 long, signature binary"


def factors() -> np.ndarray:
    return np.random.Generator(np.random.Philox(29)).integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def text_sets(text: pa.Array, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per run of rows: first and last row, distinct shingle hashes ascending per text, offsets."""
    for low, high, data, offsets in text_slices(text):
        starts, ends, owner = word_bounds(data, offsets)
        yield (low, high, *shingles(word_hashes(data, starts, ends), owner, high - low, length))


def signed_documents(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, set size, a 128-bit hash of the set, and one byte of each MinHash."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multiply = factors()
        for batch in batches:
            ids, text = batch.column(0), batch.column(1)
            for low, high, hashes, offsets in text_sets(text, length):
                sizes = np.diff(offsets)
                full = np.flatnonzero(sizes)
                at = offsets[:-1][full]
                h = np.zeros((2, high - low), dtype=np.uint64)
                least = np.zeros((len(full), HASHES), dtype=np.uint8)
                if len(full):
                    for k in range(2):
                        h[k, full] = np.add.reduceat(mixed(hashes + np.uint64(k + 1)), at)
                    for k in range(HASHES):
                        lowest = np.minimum.reduceat((hashes * multiply[k]) >> np.uint64(32), at)
                        least[:, k] = (lowest * np.uint64(0x9E3779B1)) >> np.uint64(24)
                signature = np.full(high - low, None, dtype=object)
                signature[full] = [row.tobytes() for row in least]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(low, high - low), pa.array(sizes.astype(np.int64)), pa.array(h[0].astype(np.int64)),
                     pa.array(h[1].astype(np.int64)), pa.array(signature, pa.binary())],
                    names=["doc_id", "n_shingles", "h1", "h2", "signature"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(sign, SIGNED)


def forest(x: np.ndarray, y: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the pairs (x, y) of numbers below n join two sets, taken in the given order, and the smallest number of each number's set."""
    up, joins = np.arange(n), np.zeros(len(x), dtype=bool)
    for low in range(0, len(x), FOREST_PAIRS):
        a, b = up[x[low : low + FOREST_PAIRS]], up[y[low : low + FOREST_PAIRS]]
        for i in np.flatnonzero(a != b).tolist():
            r, s = int(a[i]), int(b[i])
            while up[r] != r:
                r = int(up[r])
            while up[s] != s:
                s = int(up[s])
            if r != s:
                up[max(r, s)] = min(r, s)
                joins[low + i] = True
        while (up != up[up]).any():
            up = up[up]
    return joins, up


def run_pairs(run: np.ndarray, label: np.ndarray, order: np.ndarray, least: float) -> Iterator[tuple]:
    """All pairs of rows of one run and different labels whose share of equal values is `least` or more, with that share."""
    alive, step = np.arange(len(run)), 0
    while True:
        step += 1
        alive = alive[alive + step < len(run)]
        alive = alive[run[alive] == run[alive + step]]
        if not len(alive):
            return
        new = alive[label[alive] != label[alive + step]]
        share = np.count_nonzero(order[new] == order[new + step], axis=1) / HASHES
        ok = share >= least
        if ok.any():
            yield new[ok], new[ok] + step, share[ok]


def reduced(a: np.ndarray, b: np.ndarray, agreement: np.ndarray, sure: float, few: float) -> tuple[np.ndarray, np.ndarray]:
    """Which candidates (a, b) to confirm now, the others being left for later, and the smallest label of all that each hangs together with.

    Sure ones only as far as they join sets. Doubtful ones between such sets all, where they hang at most `few` sets together; else as a
    spanning forest. The best come first, equal ones in an order that is the same in every task.
    """
    names, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    tie = mixed(np.minimum(a, b).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.maximum(a, b).astype(np.uint64))
    at = np.lexsort((tie, -agreement))
    first, rest = at[agreement[at] >= sure], at[agreement[at] < sure]
    joins, strong = forest(x[first], y[first], len(names))
    rest = rest[strong[x[rest]] != strong[y[rest]]]
    joining, whole = forest(strong[x[rest]], strong[y[rest]], len(names))
    sets = np.bincount(whole[np.unique(strong)], minlength=len(names))
    kept = np.zeros(len(a), dtype=bool)
    kept[first[joins]] = True
    kept[rest[joining | (sets[whole[strong[x[rest]]]] <= few)]] = True
    return kept, names[whole[strong[x]]]


def in_trees(members: DataFrame, first: int, last: int) -> DataFrame:
    """`members` with the value order of each tree from `first` to `last`: the first TREES take values that stand together,
    the others values that stand TREES apart."""
    together = F.expr(f"substring(signature, tree * {HASHES // TREES} + 1, {HASHES // TREES})")
    apart = F.concat(*[F.expr(f"substring(signature, tree - {TREES} + {k * TREES + 1}, 1)") for k in range(HASHES // TREES)])
    return members.select("rep", "label", "signature", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("tree")).select(
        "rep", "label", F.hash("signature").alias("mark"), "tree", F.when(F.col("tree") < TREES, together).otherwise(apart).alias("order"))


def regions(members: DataFrame, folder: str) -> DataFrame:
    """(rep, label, signature, cell, crowd): every row with a neighbour, in the cells where it has any.

    A prefix that too many rows share makes no cell; its rows enter as many trees again, and all of these are looked at with the next
    depth. At the last depth a crowded region is cut into cells by hash, and `crowd` names it by its smallest label.
    Signatures join only the rows that are in cells, by rep and `mark`, for rows that share a doc_id may have the same rep. Tables are
    merged at any size, so that it costs alike at any size.
    """
    found, rows = [], in_trees(members, 0, TREES - 1)
    for depth in DEPTHS:
        rows = rows.withColumn("prefix", F.substring("order", 1, depth))
        runs = written(
            rows.groupBy("tree", "prefix").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
            .where("low <> high").select("tree", "prefix", "n", "low"), f"{folder}/runs-{depth}")
        last = depth == DEPTHS[-1]
        kept = runs if last else runs.where(F.col("n") <= REGION_ROWS)
        parts = F.ceil(F.col("n") / REGION_ROWS)
        found.append(rows.join(kept.hint("merge"), ["tree", "prefix"]).select(
            "rep", "label", "mark", F.xxhash64("tree", "prefix", F.pmod(F.xxhash64("rep"), parts)).alias("cell"),
            F.when(F.col("n") > REGION_ROWS, F.col("low")).alias("crowd")))
        crowded = runs.where(F.col("n") > REGION_ROWS).select("tree", "prefix")
        if last or crowded.isEmpty():
            break
        rows = rows.join(crowded, ["tree", "prefix"], "left_semi")
        if depth == DEPTHS[0]:
            again = members.join(rows.select("rep").distinct(), "rep", "left_semi")
            rows = rows.drop("prefix").unionByName(in_trees(again, TREES, 2 * TREES - 1))
        rows = written(rows.drop("prefix"), f"{folder}/crowded-{depth}")
    cells = found[0]
    for more in found[1:]:
        cells = cells.unionByName(more)
    signatures = members.select("rep", F.hash("signature").alias("mark"), "signature").repartition("rep", "mark").distinct()
    return cells.join(signatures.hint("merge"), ["rep", "mark"]).drop("mark")


def candidate_links(members: DataFrame, similarity: float, partitions: int, folder: str) -> DataFrame:
    """(a, b, root): pairs of documents whose signatures agree, to be confirmed, with the smallest label that they hang together with.

    `members` are (rep, label, signature). A row without b says that a hangs together with root by candidates that are not
    among the pairs.
    """
    agree = similarity + (1 - similarity) / 256
    spread = float(np.sqrt(agree * (1 - agree) / HASHES))
    doubtful, sure = agree - 4 * spread, min(agree + 2.2 * spread, 1.0)
    ordered = regions(members, folder).repartition(partitions, "cell").sortWithinPartitions("cell")

    def pairs_of(table: pa.Table, run: np.ndarray) -> Iterator[pa.RecordBatch]:
        rep, label = (table[c].to_numpy() for c in ("rep", "label"))
        cut, crowd = table["crowd"].is_valid().to_numpy(), table["crowd"].fill_null(0).to_numpy()
        order = np.frombuffer(b"".join(table["signature"].to_pylist()), dtype=np.uint8).reshape(-1, HASHES)
        # what is left for later, as rows (document, root)
        late = [(rep[cut], crowd[cut])]
        pairs = [(np.zeros(0, np.int64),) * 3]
        found = list(run_pairs(run, label, order, doubtful))
        if found:
            i, j, e = (np.concatenate(c) for c in zip(*found))
            kept, root = reduced(label[i], label[j], e, sure, FEW)
            late += [(rep[ends[~kept]], root[~kept]) for ends in (i, j)]
            pairs.append((np.minimum(rep[i], rep[j])[kept], np.maximum(rep[i], rep[j])[kept], root[kept]))
        a, b, root = (np.concatenate(c) for c in zip(*pairs))
        waiting = np.unique(np.column_stack([np.concatenate(c) for c in zip(*late)]), axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([a, waiting[:, 0]])), pa.concat_arrays([pa.array(b), pa.nulls(len(waiting), pa.int64())]),
             pa.array(np.concatenate([root, waiting[:, 1]]))], names=["a", "b", "root"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = pa.Table.from_batches([batch])
            held = fresh if held is None else pa.concat_tables([held, fresh])
            if held.num_rows >= BATCH_ROWS:
                run = held["cell"].to_numpy()
                done = int(np.flatnonzero(run == run[-1])[0])  # the last run may go on
                if done:
                    yield from pairs_of(held.slice(0, done), run[:done])
                    held = held.slice(done)
        if held is not None:
            yield from pairs_of(held, held["cell"].to_numpy())

    links = ordered.select("rep", "label", "signature", "cell", "crowd").mapInArrow(search, "a long, b long, root long")
    return links.groupBy("a", "b", F.when(F.col("b").isNull(), F.col("root")).alias("late")).agg(F.min("root").alias("root")).drop("late")


def confirmed_links(texts: DataFrame, links: DataFrame, length: int, percent: int, folder: str) -> DataFrame:
    """The pairs (a, b) of `links` with 100 * intersection >= percent * union on full sets; `texts` are (id, text)."""
    buckets = max(1, -(-links.count() // BUCKET_EDGES))
    crowded = written(
        links.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET_EDGES // 4)
        .select("root", F.ceil(F.col("n") / (BUCKET_EDGES // 4)).alias("parts")), f"{folder}/crowded")
    dealt = written(
        links.join(crowded, "root", "left")
        .withColumn("bucket", F.pmod(F.xxhash64("root", F.pmod(F.xxhash64("a"), F.coalesce("parts", F.lit(1)))), F.lit(buckets)).cast("int"))
        .select("a", "b", "bucket"), f"{folder}/dealt")
    ends = F.explode(F.array("a", "b")).alias("id")
    needed = dealt.select(ends, F.col("bucket").alias("place")).distinct()
    sent = texts.join(needed.hint("merge"), "id").select("place", "id", "text")

    def confirm(pairs: pa.Table, held: pa.Table) -> pa.Table:
        sets: dict[int, list[np.ndarray]] = {}
        ids = held["id"].to_pylist()
        for low, high, hashes, offsets in text_sets(held["text"].combine_chunks() if held.num_rows else pa.array([], pa.string()), length):
            for k in range(high - low):
                sets.setdefault(ids[low + k], []).append(hashes[offsets[k] : offsets[k + 1]])

        def linked(x: np.ndarray, y: np.ndarray) -> bool:
            both = len(np.intersect1d(x, y, assume_unique=True))
            return 100 * both >= percent * (len(x) + len(y) - both) > 0

        kept = [(a, b) for a, b in zip(pairs["a"].to_pylist(), pairs["b"].to_pylist()) if any(linked(x, y) for x in sets[a] for y in sets[b])]
        return pa.table({"a": pa.array([x for x, _ in kept], pa.int64()), "b": pa.array([y for _, y in kept], pa.int64())})

    return dealt.groupBy("bucket").cogroup(sent.groupBy("place")).applyInArrow(confirm, "a long, b long")


def shared_links(sets: list[np.ndarray], label: np.ndarray, part: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """Links (i, j) with 100 * intersection >= percent * union that join different labels, as a spanning forest of the labels.

    Where there are two parts, pairs of one part are left to other tasks. Of every document the shingles shared with all others are
    counted at once, through the documents that hold each shingle.
    """
    size = np.array([len(x) for x in sets])
    offsets = np.concatenate([[0], np.cumsum(size)])
    _, number, holders = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    holder = np.repeat(np.arange(len(sets)), size)[np.argsort(number, kind="stable")]
    first = np.cumsum(holders) - holders
    label, across = label.copy(), len(np.unique(part)) > 1
    for i in range(len(sets)):
        other = label != label[i]
        if not other.any():
            return
        other[: i + 1] = False
        if across:
            other &= part != part[i]
        mine = number[offsets[i] : offsets[i + 1]]
        mine = mine[holders[mine] > 1]
        if not len(mine) or not other.any():
            continue
        ends = np.cumsum(holders[mine])
        shared = np.zeros(len(sets), dtype=np.int64)
        for low, high in slices(ends):
            n = holders[mine[low:high]]
            at = np.repeat(first[mine[low:high]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            shared += np.bincount(holder[at], minlength=len(sets))
        for j in np.flatnonzero(other & (100 * shared >= percent * (size[i] + size - shared))).tolist():
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                yield i, j


def slices(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of entries whose sums, `ends` being the running one, are about GATHERED."""
    low = 0
    while low < len(ends):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + GATHERED, side="right")))
        yield low, high
        low = high


def cluster_links(waiting: DataFrame, known: DataFrame, classes: DataFrame, texts: DataFrame, length: int, percent: int, folder: str) -> DataFrame:
    """Links (a, b) that join different components of `known` inside a cluster; clusters are what hangs together by `waiting` (a, root).

    A component with many documents in a cluster has parts of its own, which do not meet each other; the others
    share parts by hash. Each pair of parts is a task of bounded size.
    """
    nodes = written(components(waiting.select("a", F.col("root").alias("b"))), f"{folder}/clusters")
    members = (
        nodes.select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
        .join(classes.groupBy("rep").agg(F.max("n_shingles").alias("n_shingles")), "rep").join(known.withColumnRenamed("node", "rep"), "rep", "left")
        .select("cluster", "rep", "n_shingles", F.coalesce("component", "rep").alias("label")))
    members = written(members, f"{folder}/members")
    per_label = members.groupBy("cluster", "label").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    parts = F.greatest(F.ceil(F.col("n") / PART_ROWS), F.ceil(F.col("s") / PART_SHINGLES)).cast("int")
    large = F.greatest(2 * F.col("n") / PART_ROWS, 2 * F.col("s") / PART_SHINGLES) > 1
    per_label = per_label.withColumn("own", F.when(large, F.col("label"))).withColumn("alone", F.when(large, parts))
    mixed = per_label.groupBy("cluster").agg(
        F.min("label").alias("low"), F.max("label").alias("high"),
        F.sum(F.when(~large, F.col("n"))).alias("n"), F.sum(F.when(~large, F.col("s"))).alias("s"))
    mixed = written(mixed.where("low <> high").select("cluster", F.coalesce(parts, F.lit(0)).alias("shared")), f"{folder}/mixed")
    own = written(per_label.where(large).select("cluster", "label", "alone"), f"{folder}/own")
    # the parts of each cluster: of components with many documents, and shared ones
    numbers = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    listed = own.join(mixed, "cluster").select("cluster", F.col("label").alias("of"), F.col("alone").alias("parts")).unionByName(
        mixed.where("shared > 0").select("cluster", F.lit(None).cast("long").alias("of"), F.col("shared").alias("parts")))
    listed = written(listed.select("cluster", "of", numbers), f"{folder}/parts")
    placed = members.join(mixed, "cluster").join(own, ["cluster", "label"], "left").select(
        "cluster", "rep", "label", F.when(F.col("alone").isNotNull(), F.col("label")).alias("of"),
        F.when(F.col("alone").isNotNull(), F.pmod(F.xxhash64("rep"), F.col("alone"))).otherwise(
            F.pmod(F.xxhash64("label"), F.col("shared"))).cast("int").alias("part"))
    others = listed.select("cluster", F.col("of").alias("other_of"), F.col("part").alias("other_part"))
    meets = F.col("of").isNull() | ~F.col("of").eqNullSafe(F.col("other_of"))
    mine, theirs = F.struct("of", "part"), F.struct(F.col("other_of").alias("of"), F.col("other_part").alias("part"))
    cells = placed.join(others, "cluster").where(meets).select(
        "cluster", F.least(mine, theirs).alias("x"), F.greatest(mine, theirs).alias("y"), F.xxhash64(mine).alias("part"), "rep", "label")
    sent = texts.join(cells, F.col("id") == F.col("rep")).select("cluster", "x", "y", "part", "rep", "label", "text")

    def confirm(table: pa.Table) -> pa.Table:
        rep, label, part = (table[c].to_numpy() for c in ("rep", "label", "part"))
        sets: list[np.ndarray] = []
        for low, high, hashes, offsets in text_sets(table["text"].combine_chunks(), length):
            sets += [hashes[offsets[k] : offsets[k + 1]] for k in range(high - low)]
        links = list(shared_links(sets, label, part, percent))
        return pa.table({"a": pa.array([rep[i] for i, _ in links], pa.int64()), "b": pa.array([rep[j] for _, j in links], pa.int64())})

    return sent.groupBy("cluster", "x", "y").applyInArrow(confirm, "a long, b long")


def near_duplicates(docs: DataFrame, length: int = 5, percent: int = 80) -> DataFrame:
    """Every document's doc_id with n_shingles, component_id and kept.

    Documents link with 100 * intersection >= percent * union of their sets of `length` words.
    """
    spark = docs.sparkSession
    folder = scratch_folder(spark, "texts")
    signed = written(signed_documents(docs, length), f"{folder}/signed")
    same = ["n_shingles", "h1", "h2"]
    classes = written(
        signed.where("n_shingles > 0").groupBy(*same).agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature")),
        f"{folder}/classes")
    rows = classes.count()
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows * TREES // RANGE_ROWS))
    groups_of = classes.where("rep is not null").select("rep", F.col("rep").alias("label"), "signature")
    found = written(candidate_links(groups_of, percent / 100, partitions, f"{folder}/first"), f"{folder}/links")
    pairs, waiting = found.where("b is not null"), found.where("b is null")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("id")).unionByName(waiting.select(F.col("a").alias("id"))).distinct()
    # The texts of all that may have to be compared, read and moved once. Merged at any size, so that it costs alike at any size.
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").where("id is not null").join(needed.hint("merge"), "id")
    texts = texts.withColumn("mark", F.md5(F.col("text").cast("binary"))).dropDuplicates(["id", "mark"]).drop("mark")
    texts = written(texts, f"{folder}/candidates")
    confirmed = written(confirmed_links(texts, pairs, length, percent, f"{folder}/first"), f"{folder}/confirmed")
    if not waiting.isEmpty():
        known = written(components(confirmed), f"{folder}/known")
        more = cluster_links(waiting, known, classes, texts, length, percent, f"{folder}/clusters")
        confirmed = written(confirmed.unionByName(more), f"{folder}/all")
    groups = classes.select(*same, "rep").join(components(confirmed), F.col("rep") == F.col("node"), "left").select(
        *[F.col(c).alias("__" + c) for c in same], F.coalesce("component", "rep").alias("component_id"))
    match = [F.col(c) == F.col("__" + c) for c in same]
    return (
        signed.select("doc_id", *same).join(groups, match, "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def without_near_duplicates(docs: DataFrame, length: int = 5, percent: int = 80) -> DataFrame:
    """`docs` with one document of each group: that with the smallest doc_id, once.

    Rows without a doc_id stay; rows that share one stay if their texts differ.
    """
    judged = near_duplicates(docs, length, percent).where("kept").select(F.col("doc_id").alias("__id"))
    named = docs.join(judged.where("__id is not null").distinct(), F.col("doc_id") == F.col("__id")).drop("__id")
    once = named.withColumn("__mark", F.xxhash64("text")).dropDuplicates(["doc_id", "__mark"]).drop("__mark")
    return once.unionByName(docs.where("doc_id is null"))
