"""Merkle manifest of a table, one subtree per group, by slot pivots.

Every row is a leaf: the digest of its columns. In each group the leaves stand
in the order of one column; every ``fanout`` neighbours become their parent,
level by level, until one node, the subroot, remains. The subroots, ordered by
group, become the root in the same way.

A level is one pivot: nodes are grouped by their parent's place, and conditional
aggregates spread them into the columns ``c0`` ... ``c7`` by slot. The digest of
the concatenated columns is the parent; the columns without the own slot are a
node's siblings. Proofs are made from the top down: a parent's path (the siblings
of each level up to the root) is joined to its row of the pivot, one row to one
row, and each child puts its own siblings in front. So no join has a key with
more rows than one, and no task or driver holds a group or a level; what the
driver reads are row counts and the root.

Places inside a group of any size come from a sort by ranges of (group, order):
a row's number in its range plus the rows of the group in the ranges before,
which are summed over one row per range and group. Equal rows may fall into
different ranges, so a row repeated any number of times is split too.

A digest is lowercase hexadecimal SHA-256 of its inputs one after another; the
inputs of a leaf are ``-`` for null, else the length of the value's UTF-8 bytes,
``:`` and the value (numbers in decimal); those of a node are its children's
digests as text.

Nulls and edges: a null group is a group of its own and comes first; a null order
value comes first in its group; rows with equal order value stand by their leaf,
so equal rows are neighbours; a null or empty text is a leaf like any other; a
group of one row is its own subroot, a table of one group has that subroot as
root, and a lone row's path is empty; an empty table gives no rows. Columns that
are not named are ignored, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Rows of one range, as long as the ranges are no more than the shuffle partitions; beyond that, ROWS_AT_MOST.
ROWS_OF_RANGE, ROWS_AT_MOST = 20_000, 1_000_000
PATH = "array<struct<before:string,after:string>>"
PART_BITS = 33  # monotonically_increasing_id: partition above, row below
NODE = ("key", "n", "pos", "digest")


def leaf_digest(*values: Column) -> Column:
    """Digest of a row's values, each with its length, so that no two rows run together."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def siblings(path: Column) -> Column:
    """All siblings of a path as one text, level by level from the leaf, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def _in_order(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (key, ...) with ``pos``, the place in the key's rows by ``order``, and ``n``, how many those are."""
    spark = rows.sparkSession
    count = rows.count()
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, -(-count // ROWS_AT_MOST), min(shuffled, -(-count // ROWS_OF_RANGE)))
    by = [F.col(c).asc_nulls_first() for c in ("key", *order)]
    lines = stored(rows.repartitionByRange(ranges, *by).sortWithinPartitions(*by)
                   .withColumn("line", F.monotonically_increasing_id()), "manifest-lines")
    part = F.shiftright("line", PART_BITS).alias("part")
    runs = lines.groupBy("key", part).agg(F.min("line").alias("first"), F.count("*").alias("rows"))
    group = Window.partitionBy("key")  # one row per range that holds some of the group
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = stored(runs.select("key", "part", "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("ahead"),
                              F.sum("rows").over(group).alias("n")), "manifest-runs")
    return (lines.withColumn("part", F.shiftright("line", PART_BITS)).join(runs, ["key", "part"])
            .withColumn("pos", F.col("line") - F.col("first") + F.col("ahead")).drop("part", "line", "first", "ahead"))


def _levels(nodes: DataFrame, fanout: int, extra: list[str]) -> tuple[list[DataFrame], list[DataFrame]]:
    """The pivots of all levels, and at each level the nodes that remain alone.

    ``nodes`` has the columns of NODE and ``extra`` ones, which only the lowest
    pivot keeps beside the digests.
    """
    pivots, alone = [], [nodes.filter("n = 1")]
    largest = nodes.agg(F.max("n")).first()[0] or 0
    while fanout ** len(pivots) < largest:
        width = fanout ** len(pivots)
        child = F.struct("digest", *([] if pivots else extra))
        slots = [F.max(F.when(F.col("pos") % fanout == s, child)).alias(f"c{s}") for s in range(fanout)]
        above = F.expr(f"pos div {fanout}").alias("parent")
        pivots.append(stored(nodes.filter(F.col("n") > width).groupBy("key", "n", above).agg(*slots), "manifest-level"))
        parent = F.sha2(F.concat_ws("", *[F.col(f"c{s}.digest") for s in range(fanout)]), 256)  # an empty slot adds nothing
        nodes = pivots[-1].select("key", "n", F.col("parent").alias("pos"), parent.alias("digest"))
        alone.append(nodes.filter((F.col("n") > width) & (F.col("n") <= width * fanout)))
    return pivots, alone


def _descend(pivots: list[DataFrame], alone: list[DataFrame], tops: DataFrame, fanout: int, extra: list[str]) -> DataFrame:
    """(subroot, digest, extra..., path) of every leaf, given each key's ``tops``: (key, subroot, path)."""
    keep = ["key", "pos", "subroot", "path"]
    paths = None
    for level in range(len(pivots), -1, -1):
        own = ["digest", *extra] if level == 0 else []
        here = alone[level].join(tops, "key").select(*keep, *own)
        if paths is not None:
            digests = [F.col(f"c{s}.digest") for s in range(fanout)]
            below = (pivots[level].join(paths.withColumnRenamed("pos", "parent"), ["key", "parent"])
                     .select("*", F.posexplode(F.array_compact(F.array(*[f"c{s}" for s in range(fanout)]))).alias("slot", "child")))
            # the columns without the own slot's; slots fill from the left, so an element's place is its slot
            before = F.concat_ws("", *[F.when(F.col("slot") > s, d) for s, d in enumerate(digests)])
            after = F.concat_ws("", *[F.when(F.col("slot") < s, d) for s, d in enumerate(digests)])
            here = here.unionByName(below.select(
                "key", (F.col("parent") * fanout + F.col("slot")).alias("pos"), "subroot",
                F.concat(F.array(F.struct(before.alias("before"), after.alias("after"))), "path").alias("path"),
                *[F.col(f"child.{c}").alias(c) for c in own]))
        paths = here
    return paths


def merkle_manifest(docs: DataFrame, *, leaf_cols=("doc_id", "source", "lang", "n_chars", "text"),
                    group_col: str = "lang", order_col: str = "doc_id", fanout: int = 8,
                    carry: dict[str, Column] | None = None) -> DataFrame:
    """Every row's ``order_col``, ``leaf``, ``subroot``, ``root`` and ``path``, and the ``carry`` columns.

    ``path`` lists, from the row's level to the root's, the siblings ``before``
    and ``after`` the node as concatenated digests. ``carry`` names narrow
    expressions over ``docs`` that are wanted beside (such as another version's
    leaf digest). The texts are read once and do not move: what is shuffled are
    digests, once to put them in order, once per level (each an eighth of the
    one below) to pivot and once to hand paths down.
    """
    carry = carry or {}
    extra = ["id", *[f"x{i}" for i in range(len(carry))]]
    name = {c: docs[f"`{c}`"] for c in (*leaf_cols, group_col, order_col)}
    # a null group sorts before every other, and text keys need no null-safe joins
    key = F.coalesce(F.concat(F.lit("="), name[group_col].cast("string")), F.lit(""))
    rows = stored(docs.select(key.alias("key"), name[order_col].alias("id"),
                              leaf_digest(*[name[c] for c in leaf_cols]).alias("digest"),
                              *[e.alias(x) for x, e in zip(extra[1:], carry.values())],
                              F.monotonically_increasing_id().alias("salt")), "manifest-leaves")
    leaves = _in_order(rows, ["id", "digest", "salt"]).select(*NODE, *extra)
    pivots, alone = _levels(leaves, fanout, extra)
    subroots = alone[0].select("key", "digest")
    for nodes in alone[1:]:
        subroots = subroots.unionByName(nodes.select("key", "digest"))
    groups = stored(subroots.select(F.lit("").alias("key"), F.col("key").alias("group"), "digest"), "manifest-subroots")
    upper, last = _levels(_in_order(groups, ["group"]).select(*NODE, "group"), fanout, ["group"])
    top = last[-1].select("digest").first()  # the one node that is left
    root = F.lit(top[0] if top else None).cast("string")
    start = docs.sparkSession.range(1).select(F.lit("").alias("key"), root.alias("subroot"),
                                              F.array().cast(PATH).alias("path"))
    tops = stored(_descend(upper, last, start, fanout, ["group"]).select(
        F.col("group").alias("key"), F.col("digest").alias("subroot"), "path"), "manifest-tops")
    return _descend(pivots, alone, tops, fanout, extra).select(
        F.col("id").alias(order_col), F.col("digest").alias("leaf"), "subroot", root.alias("root"), "path",
        *[F.col(x).alias(c) for x, c in zip(extra[1:], carry)])
