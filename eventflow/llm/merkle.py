"""Merkle manifest of a dataset: a tree of fixed arity per group, and one over the groups.

Each row has a leaf digest. In a group, leaves stand in a given order, and every
``ARITY`` consecutive nodes become one parent, until one node is left: the group's
subroot. The subroots, in the order of their groups, become the root by the same rule.
A row's path holds, level by level, the digests before and after its node in its run; it
proves the row against the root without any other row.

Levels are climbed by lag and lead windows. A node stands on the row of its first leaf, so
at level ``k`` the siblings of a node are ``ARITY ** k`` rows away: lag and lead columns of
that fixed offset, masked by the node's slot in its run and by the number of nodes of the
level, hold them, and the row of the first child hashes the parent. On the way down the row
of a node takes its parent's path by lags of the same offsets. Windows lie within blocks
of ``ARITY ** LEVELS`` consecutive rows, so no window grows with the data, a group that
holds most rows is spread over its blocks, and one exchange of narrow rows (place, digest)
serves all levels of a block. The tops of the blocks, a ``ARITY ** LEVELS``-th of the rows,
climb on in the same way: a few rounds for any size. Paths are made from the top down, and
those of the leaves are never written.

Places come from a range-partitioned table of the narrow rows, numbered within each part
and moved by the counts of the parts before. Rows that are equal in every sort column are
told apart by a number given when the table is first written, so that they too can be
spread; their places are interchangeable, since their leaves are equal.

A null group is a group of its own, before the others. Null order columns come first. A null
leaf counts as the empty string. Repeated rows are leaves each. A group of one row has its
leaf as subroot, a table of one group its subroot as root. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventflow.llm.common import col, fresh, write_cut

ARITY = 3
LEVELS = 7
STEP = "struct<before:string,after:string>"


def leaf_digest(*values: Column) -> Column:
    """SHA-256 of the values, each ``-`` if null, else its UTF-8 length, ``:`` and itself."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[
        F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
        for t in texts]), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def proof(path: Column) -> Column:
    """The digests of a path in a row, from the leaf's siblings up."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def _placed(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` (with ``_g``) with each row's place ``_at`` in its group and the number
    ``_n`` of the group's rows."""
    parts = write_cut(rows.repartitionByRange("_g", *order, "_id")
                      .withColumn("_part", F.spark_partition_id()), "merkle-order")
    counts = parts.groupBy("_g", "_part").agg(F.count(F.lit(1)).alias("_c"))
    group = Window.partitionBy("_g")
    ahead = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_g", "_part", F.coalesce(F.sum("_c").over(ahead), F.lit(0)).alias("_ahead"),
                           F.sum("_c").over(group).alias("_n"))
    here = Window.partitionBy("_g", "_part").orderBy(*order, "_id")
    return (parts.withColumn("_here", F.row_number().over(here)).join(counts, ["_g", "_part"])
            .withColumn("_at", F.col("_ahead") + F.col("_here") - 1).drop("_part", "_here", "_ahead", "_id"))


def _climb(nodes: DataFrame) -> DataFrame:
    """``nodes`` (_g, _at, _n, _node, ...) with the levels of their blocks: on a node's row
    ``_h{k}`` is its digest at level k, ``_b{k}`` and ``_a{k}`` what stands before and after
    it in its run; all null on rows without a node, the latter two also at the last node."""
    d = nodes.selectExpr("*", f"_at div {ARITY ** LEVELS} AS _blk", "_node AS _h0")
    names = d.columns
    line = "OVER (PARTITION BY _g, _blk ORDER BY _at)"
    others = range(1, ARITY)
    for k in range(LEVELS):
        apart = ARITY ** k
        many, index, slot = f"_n > {apart}", f"_at div {apart}", f"_at div {apart} % {ARITY}"
        left = ", ".join(f"IF({slot} >= {i}, _l{i}, '')" for i in reversed(others))
        right = ", ".join(f"IF({slot} < {ARITY - i} AND ({index} + {i}) * {apart} < _n, _r{i}, '')" for i in others)
        d = d.selectExpr(*names, *[f"lag(_h{k}, {i * apart}) {line} AS _l{i}" for i in others],
                         *[f"lead(_h{k}, {i * apart}) {line} AS _r{i}" for i in others])
        node = f"_at % {apart} = 0"
        d = d.selectExpr(*names, f"IF({node} AND {many}, concat({left}), NULL) AS _b{k}",
                         f"IF({node} AND {many}, concat({right}), NULL) AS _a{k}",
                         f"CASE WHEN _at % {apart * ARITY} = 0 THEN IF({many}, sha2(concat(_h{k}, {right}), 256), "
                         f"_h{k}) END AS _h{k + 1}")
        names = [c for c in names if c != f"_h{k}"] + [f"_b{k}", f"_a{k}", f"_h{k + 1}"]
    return d


def _tops(nodes: DataFrame) -> DataFrame:
    """The tops of the blocks as the nodes of the next round."""
    wide = ARITY ** LEVELS
    return _climb(nodes).where(f"_at % {wide} = 0").selectExpr(
        "_g", "_blk AS _at", f"(_n + {wide - 1}) div {wide} AS _n", f"_h{LEVELS} AS _node")


def _descend(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """``nodes`` with their ``_path``, from ``above`` (_g, _blk, _path): the tops' paths."""
    top = above.selectExpr("_g", "_blk AS _top", "_path AS _up")
    d = _climb(nodes.withColumn("_top", F.expr(f"_at div {ARITY ** LEVELS}")).join(top, ["_g", "_top"]))
    line = "OVER (PARTITION BY _g, _blk ORDER BY _at)"
    names, others, path = d.columns, range(1, ARITY), "_up"
    for k in reversed(range(LEVELS)):
        apart = ARITY ** k
        if k < LEVELS - 1:  # the parent's path stands on the row of its first child
            d = d.selectExpr(*names, *[f"lag(_p{k + 1}, {i * apart}) {line} AS _q{i}" for i in others])
            path = (f"CASE _at div {apart} % {ARITY} WHEN 0 THEN _p{k + 1} "
                    + " ".join(f"WHEN {i} THEN _q{i}" for i in others) + " END")
        step = f"IF(_b{k} IS NULL, CAST(array() AS array<{STEP}>), array(named_struct('before', _b{k}, 'after', _a{k})))"
        names = [c for c in names if c not in (f"_b{k}", f"_a{k}", f"_p{k + 1}")]
        d = d.selectExpr(*names, f"IF(_at % {apart} = 0, concat({step}, {path}), NULL) AS _p{k}")
        names = names + [f"_p{k}"]
    return d.selectExpr(*nodes.columns, "_p0 AS _path")


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """The nodes of each round, the last with one row per group."""
    rounds, most = [nodes], nodes.agg(F.max("_n")).first()[0] or 0
    while most > 1:
        rounds.append(write_cut(_tops(rounds[-1]), "merkle-tops"))
        most = -(-most // ARITY ** LEVELS)
    return rounds


def _paths(rounds: list[DataFrame], top: DataFrame) -> DataFrame:
    """The nodes of the first round with their paths, from ``top`` (_g, _blk, _path): the
    path of each group's last node."""
    for i in reversed(range(1, len(rounds) - 1)):
        top = write_cut(_descend(rounds[i], top).select("_g", F.col("_at").alias("_blk"), "_path"), "merkle-paths")
    if len(rounds) > 1:
        return _descend(rounds[0], top)
    return rounds[0].join(top.drop("_blk"), "_g")


def manifest(rows: DataFrame, leaf: str = "leaf", group: str = "source", order: tuple = ("doc_id",),
             ) -> DataFrame:
    """``rows`` with a struct ``merkle`` (lengthened until it clashes with no column):
    subroot, root and path of each row. ``rows`` should be narrow: a digest, not the text;
    they are written once and then moved twice."""
    out = fresh("merkle", rows)
    key = F.coalesce(F.concat(F.lit("="), col(group).cast("string")), F.lit("-"))  # never null
    leaves = write_cut(rows.select(
        F.struct(*[col(c) for c in rows.columns]).alias("_row"), key.alias("_g"),
        F.coalesce(col(leaf).cast("string"), F.lit("")).alias("_node"),
        F.monotonically_increasing_id().alias("_id")), "merkle-leaves")
    by = [F.col("_row").getField(c).asc_nulls_first() for c in order]
    nodes = write_cut(_placed(leaves, [*by, F.col("_node")]), "merkle-places")
    rounds = _rounds(nodes.drop("_row"))
    subroots = rounds[-1].select("_g", "_node")
    # The subroots as one group of their own, in the order of their keys.
    tree = _rounds(write_cut(_placed(subroots.select(
        F.lit("").alias("_g"), F.col("_g").alias("_group"), "_node", F.lit(0).alias("_id")),
        [F.col("_group")]), "merkle-groups"))
    root = tree[-1].select(F.col("_node").alias("_root"))
    none = F.array().cast(f"array<{STEP}>").alias("_path")
    above = _paths(tree, tree[-1].select("_g", F.lit(0).cast("long").alias("_blk"), none))
    above = write_cut(above.crossJoin(F.broadcast(root)).select(  # one row
        F.col("_group").alias("_g"), F.lit(0).cast("long").alias("_blk"), "_path",
        F.col("_node").alias("_subroot"), "_root"), "merkle-above")
    full = _paths([nodes, *rounds[1:]], above.select("_g", "_blk", "_path"))
    return (full.join(above.select("_g", "_subroot", "_root"), "_g")
            .select("_row.*", F.struct(F.col("_subroot").alias("subroot"), F.col("_root").alias("root"),
                                       F.col("_path").alias("path")).alias(out)))
