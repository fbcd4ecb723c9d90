"""Merkle manifest of a dataset, with a proof for every row, by butterfly exchange.

Rows are leaves; those of a group are hashed ``fanout`` at a time, level by level, to a subroot, and
the subroots likewise to the root.  Leaves lie in blocks of ``fanout ** local`` consecutive ones (the
partitions of the method), each of which hashes its own subtree.  Then the blocks exchange: in round
``r`` those whose numbers differ only in digit ``r`` (to the base ``fanout``) swap the roots of what they
know, and each hashes the common ancestor for itself.  After the last round every block knows the
subroot and the siblings of all its ancestors; nothing is sent down again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.shared import join_hot, written

FANOUT = 16
#: Levels that a block hashes by itself.
LOCAL = 2
_NO_PROOF = "cast(array() as array<struct<left: string, right: string>>)"


def leaf_digest(*values: Column) -> Column:
    """Digest of a row's values: each ``-`` if NULL, else its UTF-8 length, a colon and the value."""

    def field(value: Column) -> Column:
        plain = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(plain).cast("string"), F.lit(":"), plain), F.lit("-"))

    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of its proof lead to."""
    return F.aggregate(proof, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def siblings(proof: Column) -> Column:
    """All digests of a proof as one text, from the leaf's level up, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")


def _parents(nodes: Column, fanout: int) -> Column:
    last = ((F.size(nodes) - 1) / fanout).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.sha2(F.array_join(F.slice(nodes, i * fanout + 1, fanout), ""), 256)
    )


def _in_blocks(leaves: DataFrame, fanout: int, local: int) -> DataFrame:
    """Blocks of each group: ``g``, ``block``, ``total`` (leaves of the group), ``members`` and, for each
    level that a block hashes, its nodes ``level1``, ``level2``...

    Leaves are dealt by range, so their order is known from the order within partitions and the
    number of rows in the partitions before; no group is ordered in one task.
    """
    order = ["g", "key", "leaf", "seq"]
    dealt = leaves.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = written(dealt.select("g", "leaf", "row", F.monotonically_increasing_id().alias("at")), "merkle-order")
    ordered = ordered.withColumn("part", F.shiftright("at", 33))
    runs = ordered.groupBy("g", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    group = Window.partitionBy("g")
    earlier = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "g",
        "part",
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(group).alias("total"),
    )
    placed = ordered.join(written(runs, "merkle-runs"), ["g", "part"]).withColumn("place", F.col("at") + F.col("shift"))
    blocks = (
        placed.withColumn("block", F.expr(f"place div {fanout**local}"))
        .groupBy("g", "block")
        .agg(F.max("total").alias("total"), F.array_sort(F.collect_list(F.struct("place", "leaf", "row"))).alias("members"))
        .withColumn("level0", F.transform("members", lambda m: m["leaf"]))
    )
    for i in range(local):
        nodes = F.when(F.col("total") > fanout**i, _parents(F.col(f"level{i}"), fanout)).otherwise(F.col(f"level{i}"))
        blocks = blocks.withColumn(f"level{i + 1}", nodes)
    return written(blocks.drop("level0"), "merkle-blocks")


def _exchange(state: DataFrame, span: int, fanout: int) -> DataFrame:
    """One round: blocks that know ``span`` blocks each learn of ``fanout`` times as many.

    The last stretch of ``span`` blocks may be short.  Its blocks then also speak at the places of those
    that are missing, so that every group of the exchange hears of it.
    """
    own = F.expr(f"block % {span}")
    short = F.expr(f"n - ((n - 1) div {span}) * {span}")
    in_last = F.expr(f"block div {span} = (n - 1) div {span} and ((n - 1) div {span}) % {fanout} > 0")
    speaks = F.when(in_last & (short < span), F.sequence(own, F.lit(span - 1).cast("long"), short)).otherwise(F.array(own))
    said = state.select(
        "g",
        "block",
        "n",
        "node",
        F.expr(f"block div {span * fanout}").alias("high"),
        F.expr(f"(block div {span}) % {fanout}").alias("digit"),
        F.explode(speaks).alias("seat"),
        "proof",
    )
    said = said.withColumn("proof", F.when(F.col("seat") == own, F.col("proof")))
    heard = Window.partitionBy("g", "high", "seat").orderBy("digit").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    told = said.withColumn("heard", F.collect_list(F.struct("digit", "node")).over(heard)).where(F.col("seat") == own)

    def side(wanted) -> Column:
        return F.array_join(F.transform(F.filter("heard", lambda h: wanted(h["digit"], F.col("digit"))), lambda h: h["node"]), "")

    sided = told.withColumn("s", F.struct(side(lambda a, b: a < b).alias("left"), side(lambda a, b: a > b).alias("right")))
    more = F.col("n") > span
    return sided.select(
        "g",
        "block",
        "n",
        F.when(more, F.sha2(F.concat("s.left", "node", "s.right"), 256)).otherwise(F.col("node")).alias("node"),
        F.when(more, F.concat("proof", F.array("s"))).otherwise(F.col("proof")).alias("proof"),
    )


def _upper(blocks: DataFrame, fanout: int, local: int) -> DataFrame:
    """For each block ``g``, ``block``, ``node`` (the subroot of its group) and ``proof`` (from its root up)."""
    size = fanout**local
    state = blocks.select(
        "g",
        "block",
        F.expr(f"(total + {size - 1}) div {size}").alias("n"),
        F.col(f"level{local}")[0].alias("node"),
        F.expr(_NO_PROOF).alias("proof"),
    )
    most = -(-(blocks.agg(F.max("total")).first()[0] or 0) // size)
    span = 1
    while span < most:
        state = _exchange(state, span, fanout)
        span *= fanout
    return written(state.select("g", "block", "node", "proof"), "merkle-upper")


def _opened(blocks: DataFrame, fanout: int, local: int, *carried: str) -> DataFrame:
    """The leaves of blocks: ``leaf``, ``row``, ``lower`` (the proof up to the block's root), and the carried columns."""
    blocks = blocks.withColumn("level0", F.transform("members", lambda m: m["leaf"]))
    level = [F.col(f"level{i}") for i in range(local)]

    def step(i: int, at: Column) -> Column:
        run = F.slice(level[i], (at / fanout ** (i + 1)).cast("int") * fanout + 1, fanout)
        own = (at / fanout**i).cast("int") % fanout
        sides = (F.array_join(F.slice(run, 1, own), "").alias("left"), F.array_join(F.slice(run, own + 2, fanout), "").alias("right"))
        return F.when(F.col("total") > fanout**i, F.array(F.struct(*sides))).otherwise(F.expr(_NO_PROOF))

    def open_one(m: Column, at: Column) -> Column:
        return F.struct(m["leaf"].alias("leaf"), m["row"].alias("row"), F.concat(*[step(i, at) for i in range(local)]).alias("lower"))

    return blocks.select(*carried, F.explode(F.transform("members", open_one)).alias("m")).select("m.*", *carried)


def manifest(
    rows: DataFrame,
    group: str = "source",
    order: Sequence[str] = ("doc_id",),
    leaf: str = "leaf",
    keep: Sequence[str] = (),
    fanout: int = FANOUT,
    local: int = LOCAL,
) -> DataFrame:
    """``row`` (the kept columns as a struct), ``leaf``, ``subroot``, ``root`` and ``proof`` of each row.

    ``leaf`` is a column of digests.  Within a group leaves ascend by ``order``; rows equal in it ascend by
    digest, and among equal digests any order gives the same tree (each row has its own place and proof).
    While a level has several nodes, each run of ``fanout`` of them becomes the digest of their hexadecimal
    digests, the last run with as few as one.  Groups ascend by value, NULL first; NULL in ``order`` comes
    first, too.  ``proof`` holds, from the leaf up to the root, the digests left and right of the way, each
    side as one text; a level on which a node is alone in its run has two empty texts.  Values are never
    looked at but through ``leaf``, so NULLs, empty and long texts need no care here; other columns and
    their names make no difference; kept columns must be of types that have an order.  Empty in, empty out.
    """
    named = [F.col(f"`{c}`") for c in keep]
    leaves = rows.select(
        F.struct(F.col(f"`{group}`").alias("value")).alias("g"),
        F.struct(*[F.col(f"`{c}`") for c in order]).alias("key"),
        F.col(f"`{leaf}`").alias("leaf"),
        F.struct(*named, F.lit(0).alias("none")).alias("row"),
        F.monotonically_increasing_id().alias("seq"),
    )
    blocks = _in_blocks(written(leaves, "merkle-leaves"), fanout, local)
    upper = _upper(blocks, fanout, local)
    # The subroots are the leaves of one more tree; every block knows its own, the first one tells.
    subroots = upper.where("block = 0").select(
        F.struct(F.lit(0).alias("value")).alias("g"),
        F.struct("g").alias("key"),
        F.col("node").alias("leaf"),
        F.struct("g").alias("row"),
        F.lit(0).cast("long").alias("seq"),
    )
    top = _in_blocks(written(subroots, "merkle-subroots"), fanout, local)
    top_proof = _upper(top, fanout, local).withColumnRenamed("proof", "upper")
    tops = _opened(top.join(top_proof, ["g", "block"]), fanout, local, "node", "upper").select(
        F.col("row.g").alias("g"), F.col("node").alias("root"), F.concat("lower", "upper").alias("top")
    )
    known = join_hot(upper, tops, ["g"]).select("g", "block", "node", "root", F.concat("proof", "top").alias("upper"))
    opened = _opened(blocks.join(known, ["g", "block"]), fanout, local, "node", "root", "upper")
    return opened.select(
        F.struct(*[F.col(f"row.`{c}`") for c in keep]).alias("row") if keep else F.col("row"),
        "leaf",
        F.col("node").alias("subroot"),
        "root",
        F.concat("lower", "upper").alias("proof"),
    )
