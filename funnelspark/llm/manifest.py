"""Merkle manifest of a dataset with nested-interval labels.

Every group of rows has a tree of its own, and a tree over the groups' subroots gives the
root. A leaf has its rank in the tree; a node covers an interval of leaf ranks, eight
neighbouring nodes at most make their parent. An interval tells the bucket in which the
parent lies, so a join on tree and bucket, with containment checked, attaches it. What the parent's
interval holds besides that of the child are the siblings. Paths are handed down level by
level; each row then folds its own path.

Ranks come from range-partitioned rows: sums by partition and tree are added to row
numbers within them, so a tree with most of the rows is spread over all tasks. The number
of levels is the logarithm of the largest tree, and no join key has more than ``FANOUT``
children. Levels are written tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelspark.sources.storage import written

#: Children of a node: two to the power of ``BITS``.
BITS = 3
FANOUT = 1 << BITS

_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts' texts in a row."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_digest(fields: Sequence[Column]) -> Column:
    """The digest of values: each as UTF-8 byte count, ``:`` and text, or ``-`` for null."""
    texts = [field.cast("string") for field in fields]
    return digest(
        *[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    )


def ranked(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """``leaves`` with ``lo``, their rank in their ``tree`` (long), and ``size``, the tree's leaves.

    Leaves that agree in all of ``order`` take neighbouring ranks in the order of the files.
    """
    numbered = leaves.withColumn("nth", F.monotonically_increasing_id())
    keys = ["tree", *order, "nth"]
    dealt = written(
        numbered.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), "dealt"
    )
    sums = dealt.groupBy("part", "tree").agg(F.count("*").alias("n"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Rows by range are in order of the trees, so there are at most as many sums as
    # partitions and trees together.
    starts = sums.select(
        F.col("part").alias("p"),
        F.col("tree").alias("t"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy("tree")).alias("size"),
    )
    within = F.row_number().over(Window.partitionBy("part", "tree").orderBy(*order, "nth"))
    return (
        dealt.withColumn("within", within)
        .join(starts, (F.col("part") == F.col("p")) & (F.col("tree") == F.col("t")))
        .withColumn("lo", F.col("before") + F.col("within") - 1)
        .drop("part", "within", "before", "p", "t", "nth")
    )


def bucket(level: int) -> Column:
    """The number of the node at ``level`` whose interval holds ``lo``."""
    return F.shiftright("lo", BITS * level)


def levels(leaves: DataFrame, label: str) -> list[DataFrame]:
    """The nodes of all trees by level, from the leaves on: ``tree, size, lo, hi, digest``.

    A tree ends at the level where it has one node.
    """
    nodes = leaves.select("tree", "size", "lo", (F.col("lo") + 1).alias("hi"), "digest")
    found = [nodes]
    largest = leaves.agg(F.max("size")).first()[0] or 0
    while FANOUT ** (len(found) - 1) < largest:
        k = len(found)
        children = F.array_sort(F.collect_list(F.struct("lo", "hi", "digest")))
        parents = (
            found[-1].where(F.col("size") > FANOUT ** (k - 1))
            .groupBy("tree", "size", bucket(k).alias("bucket"))
            .agg(children.alias("children"))
        )
        digests = F.transform("children", lambda child: child["digest"])
        found.append(
            written(
                parents.select(
                    "tree", "size", F.col("children")[0]["lo"].alias("lo"),
                    F.element_at("children", -1)["hi"].alias("hi"),
                    F.sha2(F.array_join(digests, "").cast("binary"), 256).alias("digest"), "children",
                ),
                f"{label}-{k}",
            )
        )
    return found


def tops(nodes: list[DataFrame]) -> DataFrame:
    """The last node of every tree: ``tree, digest``."""
    last = None
    for k, level in enumerate(nodes):
        alone = F.col("size") <= FANOUT**k
        if k:
            alone = alone & (F.col("size") > FANOUT ** (k - 1))
        part = level.where(alone).select("tree", "digest")
        last = part if last is None else last.unionByName(part)
    return last


def paths(nodes: list[DataFrame], above: DataFrame, label: str) -> DataFrame:
    """``tree``, ``lo`` and ``path`` of every leaf: its siblings level by level, then those ``above``.

    ``above`` has a ``path`` for every tree. A step of a path has the digests left and
    right of the node on the way.
    """
    path = None
    for k in range(len(nodes) - 1, -1, -1):
        level = nodes[k]
        on_top = F.col("size") <= FANOUT**k
        if k:
            on_top = on_top & (F.col("size") > FANOUT ** (k - 1))
        names = ["tree", "lo", "hi", *(["children"] if k else [])]
        found = level.where(on_top).join(above, "tree").select(*names, "path")
        if path is not None:
            upper = path.select(
                F.col("tree").alias("t"), bucket(k + 1).alias("b"), F.col("lo").alias("from"),
                F.col("hi").alias("to"), "children", F.col("path").alias("rest"),
            )
            lower = level.where(F.col("size") > FANOUT**k).withColumnRenamed("children", "own") if k else level.where(
                F.col("size") > 1
            )
            contained = (
                (F.col("tree") == F.col("t")) & (bucket(k + 1) == F.col("b"))
                & (F.col("from") <= F.col("lo")) & (F.col("hi") <= F.col("to"))
            )

            def beside(test) -> Column:
                return F.array_join(F.transform(F.filter("children", test), lambda child: child["digest"]), "")

            step = F.struct(
                beside(lambda child: child["hi"] <= F.col("lo")).alias("left"),
                beside(lambda child: child["lo"] >= F.col("hi")).alias("right"),
            )
            joined = lower.join(upper, contained)
            own = [F.col("own").alias("children")] if k else []
            found = found.unionByName(
                joined.select("tree", "lo", "hi", *own, F.concat(F.array(step), "rest").alias("path"))
            )
        path = written(found, f"{label}-{k}") if k else found
    return path.select("tree", "lo", "path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the siblings of ``path`` give."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["left"], node, step["right"]))


def manifest(
    docs: DataFrame, fields: Sequence[str], group: str, order: str, tampered: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``order``, ``leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``fields`` make the leaf, rows with one value of ``group`` a tree whose leaves ascend by
    ``order``, and trees ascend by ``group``. ``tampered`` has other values for some fields, against which
    the original siblings are folded; without it every row verifies. Null in any field is a value
    of its own; null comes first in ``order`` and ``group``. Rows with one ``order`` follow
    by leaf, equal rows in any order. Texts are hashed whole, however long. Other columns
    of ``docs`` are not read. No rows give no rows.
    """
    changed = [(tampered or {}).get(name, F.col(name)) for name in fields]
    # A sign before each group makes null a tree that comes first.
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    leaves = written(
        docs.select(
            tree.alias("tree"), F.col(order).alias("key"),
            leaf_digest([F.col(name) for name in fields]).alias("digest"),
            leaf_digest(changed).alias("other") if tampered else F.lit(None).cast("string").alias("other"),
        ),
        "leaves",
    )
    leaves = written(ranked(leaves, ["key", "digest"]), "ranked")
    nodes = levels(leaves, "nodes")
    subroots = written(tops(nodes).withColumnRenamed("digest", "subroot"), "subroots")
    groups = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("subroot").alias("digest"))
    groups = written(ranked(groups, ["of"]), "groups")
    upper = levels(groups, "upper")
    root = tops(upper).select(F.col("digest").alias("root"), "tree")
    nothing = root.select("tree", F.expr(f"cast(array() AS {_PATH})").alias("path"))
    above = (
        paths(upper, nothing, "upper-paths").join(groups, ["tree", "lo"]).join(root, "tree")
        .select(F.col("of").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
    )
    above = written(above, "above")
    rows = paths(nodes, above.select("tree", "path"), "paths").join(leaves, ["tree", "lo"])
    rows = rows.join(above.select("tree", "subroot", "root"), "tree")
    siblings = F.transform("path", lambda step: F.concat(step["left"], step["right"]))
    return rows.select(
        F.col("key").alias(order), F.col("digest").alias("leaf"), "subroot", "root",
        F.sha2(F.array_join(siblings, "").cast("binary"), 256).alias("proof_sha256"),
        fold(F.coalesce("other", "digest"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
