"""Operator 13: a Merkle manifest by sibling-shift self-joins.

Rows are leaves of a tree per group; the group's roots, in the groups' order,
are the leaves of one upper tree.  A level's nodes are numbered from 0; the
siblings of node i have the numbers of its run of ``fanout`` without i itself.
Every node goes out once under each of these numbers and meets its siblings in
an equi-join of the level with itself, keyed by (tree, number).  So each node
has its siblings, which are its part of the proof, and the nodes in slot zero
hash their run into the parent.  Levels end when a tree has one node left.

The proofs are put together from the top: a node's path is its own siblings and
then its parent's path.

Numbers come from a range sort and the counts of its partitions, never from a
window over a group, and all keys hold the node's number, so a group with a
third of the rows spreads like any other.  The joins of rows are merge joins at
every size: what is shuffled grows with the rows.  Digests travel as 32 bytes; wherever
one is hashed again it is written as lowercase hex.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyload.llm.common import Scratch, pick

_PATH = "array<struct<before: binary, after: binary>>"


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _digest(*inputs: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*inputs), 256))


def leaf_digest(*columns: Column) -> Column:
    """SHA-256, as 32 bytes, of the columns: ``-`` for null, else the UTF-8 byte count, ``:`` and the value as text."""
    texts = [c.cast("string") for c in columns]
    return _digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def numbered(rows: DataFrame, order: list[Column], scratch: Scratch, name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` in ``order``, written with partition ``_p`` and position ``_m``; and of each partition its first ``_m`` and its number of rows before."""
    placed = rows.orderBy(*order).select("*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_m"))
    table = scratch.table(placed, name)
    counts = table.groupBy("_p").agg(F.min("_m").alias("_first"), F.count("*").alias("_n"))
    # one row for each partition of the sort
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return table, counts.select("_p", "_first", before.alias("_before"))


def _levels(nodes: DataFrame, most: int, fanout: int, scratch: Scratch, name: str) -> list[DataFrame]:
    """Levels of all trees, lowest first: ``tree, idx, n, node, before, after`` and ``row`` of the lowest.

    ``nodes`` has ``tree, idx, n`` (nodes of the tree at this level), ``node``
    and ``row``; ``most`` is the largest ``n``.  A tree's last level has one
    node, its root.
    """
    out, level = [], 0
    while True:
        run = F.col("idx") - F.col("idx") % fanout
        others = F.sequence(run, F.least(run + fanout, F.col("n")) - 1)
        sent = nodes.where("n > 1").select(
            F.col("tree").alias("_tree"), F.col("idx").alias("_from"), F.col("node").alias("_node"),
            F.explode(F.filter(others, lambda i: i != F.col("idx"))).alias("_to"))
        met = nodes.join(sent.hint("merge"), (F.col("tree") == F.col("_tree")) & (F.col("idx") == F.col("_to")), "left").groupBy("tree", "idx").agg(
            *[F.first(c).alias(c) for c in ("n", "node", "row")],
            F.sort_array(F.collect_list(F.when(F.col("_from").isNotNull(), F.struct(F.col("_from").alias("i"), F.col("_node").alias("d"))))).alias("_s"))
        side = lambda keep: F.unhex(F.array_join(F.transform(F.filter("_s", keep), lambda x: F.hex(x["d"])), ""))
        met = met.select("tree", "idx", "n", "node", side(lambda x: x["i"] < F.col("idx")).alias("before"),
                         side(lambda x: x["i"] > F.col("idx")).alias("after"), "row")
        table = scratch.table(met, f"{name}{level}")
        out.append(table)
        if most <= 1:
            return out
        most, level = -(-most // fanout), level + 1
        nodes = table.where((F.col("n") > 1) & (F.col("idx") % fanout == 0)).select(
            "tree", F.floor(F.col("idx") / fanout).alias("idx"), F.ceil(F.col("n") / fanout).alias("n"),
            _digest(_hex(F.concat("node", "after"))).alias("node"), F.lit(None).cast(nodes.schema["row"].dataType).alias("row"))


def _roots(levels: list[DataFrame]) -> DataFrame:
    roots = [t.where("n = 1").select("tree", "node") for t in levels]
    out = roots[0]
    for r in roots[1:]:
        out = out.unionByName(r)
    return out


def _paths(levels: list[DataFrame], tops: DataFrame, fanout: int, scratch: Scratch, name: str) -> DataFrame:
    """Of every lowest node ``tree, idx, node, row, path`` and the columns of ``tops`` (``tree, top``, others) of its tree."""
    own = F.array(F.struct("before", "after"))
    extra = [c for c in tops.columns if c not in ("tree", "top")]
    above = None
    for level in range(len(levels) - 1, -1, -1):
        rows = levels[level]
        root = rows.where("n = 1").join(tops, "tree").select("tree", "idx", "node", "row", F.col("top").alias("path"), *extra)
        if above is not None:
            up = above.select(F.col("tree").alias("_tree"), F.col("idx").alias("_idx"), F.col("path").alias("_path"), *extra)
            inner = rows.where("n > 1").join(up.hint("merge"), (F.col("tree") == F.col("_tree")) & (F.floor(F.col("idx") / fanout) == F.col("_idx")))
            root = root.unionByName(inner.select("tree", "idx", "node", "row", F.concat(own, F.col("_path")).alias("path"), *extra))
        # the lowest level is read once; the others by every level below
        above = root if level == 0 else scratch.table(root, f"{name}{level}")
    return above


def fold_path(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to, 32 bytes each."""
    return F.aggregate(path, leaf, lambda node, p: _digest(_hex(F.concat(p["before"], node, p["after"]))))


def proof_digest(path: Column) -> Column:
    """SHA-256, as lowercase hex, of all siblings from the leaf's level up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda p: _hex(F.concat(p["before"], p["after"]))), ""), 256)


def merkle_manifest(rows: DataFrame, fields: list[str], group_col: str = "source", order_col: str = "doc_id", fanout: int = 16,
                    altered: dict[str, Callable[[Column], Column]] | None = None,
                    altered_where: Callable[[Column], Column] | None = None) -> DataFrame:
    """Of every row: ``order_col, group_col, leaf, altered, subroot, root`` (32 bytes each) and ``path``.

    A leaf is the digest of ``fields``.  Per group, leaves ascend by
    ``order_col`` (null first); groups ascend bytewise (null first).  Rows that
    are equal in both come in the order of their leaves; equal leaves too are
    nodes of their own.  A tree's nodes are hashed in runs of ``fanout`` until
    one remains; a lone leaf is its tree's root.  ``path`` has one entry for
    each level up to ``root``: the digests before and after in the run.
    The column ``altered`` is the leaf that a row has once the functions of
    ``altered`` have changed its fields, in rows whose ``order_col`` fulfils
    ``altered_where``; null in others.  Null and empty fields, long texts and
    repeated rows are rows like all others; other columns are ignored; an empty
    table gives an empty result.
    """
    if fanout < 2:
        raise ValueError("fanout must be at least 2")
    spark = rows.sparkSession
    scratch = Scratch(spark, "merkle")
    names = {f"f{i}": f for i, f in enumerate(fields)}
    own = pick(rows, key=order_col, grp=group_col, **names)
    changed = leaf_digest(*[(altered or {}).get(f, lambda c: c)(F.col(n)) for n, f in names.items()])
    when = F.lit(False) if not altered else altered_where(F.col("key")) if altered_where else F.lit(True)
    leaves = scratch.table(own.select(
        "key", "grp", F.coalesce(F.concat(F.lit("="), F.col("grp").cast("string")), F.lit("-")).alias("g"),
        leaf_digest(*[F.col(n) for n in names]).alias("leaf"), F.when(when, changed).alias("altered"),
        F.monotonically_increasing_id().alias("row_no")), "leaves")
    # "-" sorts before "=", so rows without a group come first
    table, _ = numbered(leaves, [F.col("g"), F.col("key").asc_nulls_first(), F.col("leaf"), F.col("row_no")], scratch, "sorted")
    scratch.drop("leaves")
    parts = scratch.table(table.groupBy("_p", "g").agg(F.min("_m").alias("_first"), F.count("*").alias("_n")), "parts")
    by_part = Window.partitionBy("g").orderBy("_p")  # of a group, one row for each partition of the sort
    parts = parts.select("_p", "g", "_first", F.coalesce(F.sum("_n").over(by_part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
                         F.sum("_n").over(Window.partitionBy("g")).alias("n"))
    groups, ahead = numbered(parts.select("g", "n").distinct(), [F.col("g")], scratch, "groups")
    trees = scratch.table(groups.join(F.broadcast(ahead), "_p").select(
        "g", "n", (F.col("_before") + F.col("_m") - F.col("_first")).alias("tree")), "trees")
    size = trees.agg(F.max("n"), F.count("*")).head()
    if not size[1]:
        return table.select("key", "grp", "leaf", "altered", F.col("leaf").alias("subroot"), F.col("leaf").alias("root"),
                             F.lit(None).cast(_PATH).alias("path")).withColumnsRenamed({"key": order_col, "grp": group_col})
    placed = table.join(parts.join(trees.select("g", "tree"), "g").hint("merge"), ["_p", "g"]).select(
        "tree", (F.col("_before") + F.col("_m") - F.col("_first")).alias("idx"), "n", F.col("leaf").alias("node"),
        F.struct("key", "grp", "altered").alias("row"))
    levels = _levels(placed, size[0], fanout, scratch, "level")
    upper = _roots(levels).select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(size[1]).cast("long").alias("n"),
                                  "node", F.lit(None).cast("string").alias("row"))
    uppers = _levels(upper, size[1], fanout, scratch, "upper")
    root = _roots(uppers).select("tree", F.col("node").alias("root"), F.array().cast(_PATH).alias("top"))
    tops = scratch.table(_paths(uppers, root, fanout, scratch, "upper_path").select(
        F.col("idx").alias("tree"), F.col("node").alias("subroot"), "root", F.col("path").alias("top")), "tops")
    found = _paths(levels, tops, fanout, scratch, "path")
    return found.select(F.col("row.key").alias(order_col), F.col("row.grp").alias(group_col), F.col("node").alias("leaf"), F.col("row.altered").alias("altered"),
                        "subroot", "root", "path")


def verify_manifest(manifest: DataFrame) -> DataFrame:
    """``manifest`` with hex digests, ``proof_sha256``, ``folded_root`` (from the altered leaf, if there is one) and ``verified``."""
    folded = F.col("folded")
    plain = [c for c in manifest.columns if c not in ("leaf", "altered", "subroot", "root", "path")]
    return manifest.withColumn("folded", fold_path(F.coalesce("altered", "leaf"), F.col("path"))).select(
        *[F.col(f"`{c}`") for c in plain], _hex(F.col("leaf")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"), _hex(F.col("root")).alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"), _hex(folded).alias("folded_root"), (folded == F.col("root")).alias("verified"))
