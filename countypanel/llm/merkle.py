"""Merkle manifest of a table: a digest of every row, a root for each tree of rows, a root of all, and each row's proof.

A row's leaf is the SHA-256 of its columns, each written with its length. The leaves of a tree stand in the order of their
key; while several nodes remain, every eight consecutive ones become the digest of their hex texts put
together. The trees' roots, in the order of their names, are leaves of one more tree, whose root is that of the table.

A superblock is 8**LEVELS consecutive nodes of one tree. Going up, each superblock is reduced to its node in
one group, and the nodes of superblocks are the next tier, until each tree has one. Going down, a superblock's nodes are
cogrouped with the outer nodes that it requires, the siblings on the way from its node to the root of the table: the group
finishes the local reduction, joins local and outer siblings to proofs and folds the presented leaves with them.
So no group has more than 8**LEVELS nodes, whatever a tree's share of the rows; a proof grows with the logarithm of the rows.

Positions come from one sort by ranges, in which rows that are alike are spread by a number of their own, and
from the counts of each range; texts are read once and not moved, only digests are.

Defined results: null columns have a leaf of their own (`-`), empty ones are of length 0; null keys come first; rows with
one key stand in the order of their leaves, and rows that repeat have equal leaves and a proof each; a null tree name
is a tree of its own, the first; a single row is its own subroot and root, and its proof is the digest of nothing; an empty
table gives no rows; columns other than the named ones take no part.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import scratch_folder, written

FAN = 8
LEVELS = 3
RANGE_ROWS = 200_000
NODE = "tree string, pos long, hash string, total long"
PATH = "tree string, pos long, left array<string>, right array<string>, subroot string"


def measured(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon, and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[measured(v) for v in values]), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(parts: Sequence[str]) -> str:
    return sha256("".join(parts).encode("ascii")).hexdigest()


def reduction(nodes: list[str], total: int, levels: int) -> list[list[str]]:
    """The nodes of each level inside a superblock, the given ones first. `total` is the number of nodes that the whole tree has."""
    held = [nodes]
    for _ in range(levels):
        if total <= 1:
            break
        held.append([digest(held[-1][i : i + FAN]) for i in range(0, len(held[-1]), FAN)])
        total = -(-total // FAN)
    return held


def siblings(held: list[list[str]], at: int) -> tuple[list[str], list[str]]:
    """Per level what stands left and right of the way up from node `at`."""
    left, right = [], []
    for level in held[:-1]:
        first = at - at % FAN
        left.append("".join(level[first:at]))
        right.append("".join(level[at + 1 : first + FAN]))
        at //= FAN
    return left, right


def folded(leaf: str, left: Sequence[str], right: Sequence[str]) -> str:
    for a, b in zip(left, right):
        leaf = digest((a, leaf, b))
    return leaf


def numbered(nodes: DataFrame, order: list[str], folder: str) -> DataFrame:
    """`nodes` with `pos`, the place in their tree by `order`, from 0, and `total`, the number of the tree's nodes."""
    spark = nodes.sparkSession
    nodes = written(nodes, f"{folder}/rows")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-nodes.count() // RANGE_ROWS))
    keys = ["tree", *order, "__own"]
    ranges = (
        nodes.withColumn("__own", F.monotonically_increasing_id()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))).drop("__own")
    )
    ranges = written(ranges, f"{folder}/ranges")
    # A row for each tree and range, at most as many as there are trees and ranges together.
    runs = ranges.groupBy("tree", "__part").agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    before = Window.partitionBy("tree").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "tree", "__part", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
        F.sum("__n").over(Window.partitionBy("tree")).alias("total"))
    runs = written(runs, f"{folder}/runs")
    placed = ranges.join(runs, ["tree", "__part"]).withColumn("pos", F.col("__at") - F.col("__first") + F.col("__before"))
    return placed.drop("__part", "__at", "__first", "__before")


def in_superblocks(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / FAN**levels).cast("long"))


def tiers(nodes: DataFrame, levels: int, folder: str) -> list[DataFrame]:
    """`nodes` (tree, pos, hash, total), then those of their superblocks, and so on, until every tree has one node."""
    def reduce(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("pos")
        top = reduction(group["hash"].tolist(), int(group["total"].iat[0]), levels)[-1]
        return pd.DataFrame({"tree": [group["tree"].iat[0]], "pos": [int(group["block"].iat[0])], "hash": top,
                             "total": [-(-int(group["total"].iat[0]) // FAN**levels)]})

    held = [nodes]
    most = nodes.agg(F.max("total")).first()[0] or 0
    while most > 1:
        above = in_superblocks(held[-1], levels).groupBy("tree", "block").applyInPandas(reduce, NODE)
        held.append(written(above, f"{folder}/tier-{len(held)}"))
        most = -(-most // FAN**levels)
    return held


def with_outer(nodes: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """The way up from each node: its siblings in its superblock, joined to the outer ones of the superblock's node."""
    def extend(group: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        out = {"tree": [], "pos": [], "left": [], "right": [], "subroot": []}
        if len(group):
            group = group.sort_values("pos")
            held = reduction(group["hash"].tolist(), int(group["total"].iat[0]), levels)
            beyond = above.iloc[0]
            for at, (tree, pos) in enumerate(zip(group["tree"], group["pos"])):
                left, right = siblings(held, at)
                out["tree"].append(tree)
                out["pos"].append(pos)
                out["left"].append([*left, *beyond["left"]])
                out["right"].append([*right, *beyond["right"]])
                out["subroot"].append(beyond["subroot"])
        return pd.DataFrame(out)

    keys = ["tree", "block"]
    return in_superblocks(nodes, levels).groupBy(*keys).cogroup(outer.groupBy(*keys)).applyInPandas(extend, PATH)


def ways_up(held: list[DataFrame], outer: DataFrame, levels: int, folder: str) -> DataFrame:
    """The outer nodes of the lowest tier's superblocks; `outer` are those of the trees' roots."""
    for number in range(len(held) - 1, 0, -1):
        found = written(with_outer(held[number], outer, levels), f"{folder}/ways-{number}")
        outer = found.withColumnRenamed("pos", "block")
    return outer


def manifest(rows: DataFrame, values: Sequence[Column], key: str, tree: Column, presented: Sequence[Column] | None = None,
             levels: int = LEVELS, with_siblings: bool = False) -> DataFrame:
    """Per row: key, leaf, subroot, root, proof_sha256, folded_root, verified, and on demand the siblings left and right of its way up.

    `values` make the leaf, rows stand by `key` in the tree named `tree`. `presented` are the values that a holder of the
    row shows later: the root is folded anew from their leaf and the original siblings, and compared.
    """
    spark = rows.sparkSession
    folder = scratch_folder(spark, "merkle")
    kind = rows.schema[key].dataType
    schema = ("key string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
              + ", left array<string>, right array<string>" * with_siblings)
    leaves = rows.select(
        F.col(f"`{key}`").alias("key"), F.coalesce(F.concat(F.lit("+"), tree.cast("string")), F.lit("")).alias("tree"),
        leaf_digest(values).alias("hash"), (leaf_digest(presented) if presented else F.lit(None).cast("string")).alias("shown"))
    leaves = numbered(leaves, ["key", "hash"], f"{folder}/leaves").withColumn("key", F.col("key").cast("string"))
    held = tiers(leaves.select("tree", "pos", "hash", "total"), levels, f"{folder}/trees")
    roots = held[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "hash")
    roots = written(numbered(roots, ["name"], f"{folder}/roots"), f"{folder}/named")
    upper = tiers(roots.select("tree", "pos", "hash", "total"), levels, f"{folder}/upper")
    last = upper[-1].first()
    if last is None:
        return spark.createDataFrame([], schema).withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key)
    root = last.hash
    nothing = F.array().cast("array<string>")
    start = spark.range(1).select(F.lit("").alias("tree"), F.col("id").alias("block"), nothing.alias("left"), nothing.alias("right"),
                                  F.lit("").alias("subroot"))
    tops = written(with_outer(upper[0], ways_up(upper, start, levels, f"{folder}/upper"), levels), f"{folder}/tops")
    start = tops.select("pos", "left", "right").join(roots.select("pos", "name", "hash"), "pos").select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("block"), "left", "right", F.col("hash").alias("subroot"))
    outer = ways_up(held, start, levels, f"{folder}/trees")

    def finish(group: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        out = {c: [] for c in ("key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "left", "right")}
        if len(group):
            group = group.sort_values("pos")
            inside = reduction(group["hash"].tolist(), int(group["total"].iat[0]), levels)
            beyond = above.iloc[0]
            for at, (name, leaf, shown) in enumerate(zip(group["key"], group["hash"], group["shown"])):
                left, right = siblings(inside, at)
                left, right = [*left, *beyond["left"]], [*right, *beyond["right"]]
                again = folded(shown if isinstance(shown, str) else leaf, left, right)
                proof = digest([part for pair in zip(left, right) for part in pair])
                for c, x in zip(out, (name, leaf, beyond["subroot"], root, proof, again, again == root, left, right)):
                    out[c].append(x)
        return pd.DataFrame(out if with_siblings else {c: x for c, x in out.items() if c not in ("left", "right")})

    keys = ["tree", "block"]
    leaves = in_superblocks(leaves, levels).select(*keys, "pos", "key", "hash", "shown", "total")
    proved = leaves.groupBy(*keys).cogroup(outer.groupBy(*keys)).applyInPandas(finish, schema)
    return proved.withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key)
