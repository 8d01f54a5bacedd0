"""Merkle manifest of a dataset: a digest per row, per group and over all, with a proof for every row.

Rows of a group are leaves in their order; every ``fanout`` consecutive nodes become their parent
until one is left, the group's subroot. Subroots, in the order of their groups, are the leaves of the
last tree, whose top is the root. A run's last nodes may be fewer, even one, and still get a parent.

Leaves are numbered by a range sort and dealt into aligned partitions of 1024 (or the power of the
fanout below). A partition hashes its own levels. Then partitions swap their subtree roots round by
round, as in a butterfly: in round r, groups of ``EXCHANGE`` neighbouring subtrees are formed, and the
members of equal place within their subtrees trade roots, so each hashes the ancestors anew and adds
the siblings on its own path to its proof. After the last round every partition holds the top of its
tree and the whole upper part of its proofs; nothing is sent back down. A subtree at the end that has
fewer partitions than its neighbours sends its root to the places it lacks.

Defined cases: a null value is a value of its own in a leaf; rows of null group form the first group;
rows of null order key come first; rows of equal key are ordered by leaf, so equal rows are
interchangeable and each keeps a place; an empty table gives an empty manifest; columns that aren't
named take no part; a text is hashed whole, whatever its length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelane.llm.common import pieces, written

BLOCK_LEAVES = 1024
EXCHANGE = 64
ROWS_PER_RANGE = 200_000
_STEP = "struct<before:string,after:string>"


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts one after another, in lower-case hex."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as it enters a leaf: ``-`` for null, else its UTF-8 length, a colon, and itself."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: Sequence[Column]) -> Column:
    return digest(*[field(v) for v in values])


def folded(start: Column, proof: Column) -> Column:
    """The top that a leaf and a proof lead to."""
    return F.aggregate(proof, start, lambda node, step: digest(step["before"], node, step["after"]))


def siblings(proof: Column) -> Column:
    """All digests of a proof, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["before"], step["after"])), "")


def _power(fanout: int, most: int) -> int:
    """Levels of the largest full tree of at most ``most`` leaves, one level at least."""
    levels = 1
    while fanout ** (levels + 1) <= most:
        levels += 1
    return levels


def _placed(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Rows with their place in their tree and the number of the tree's leaves.

    Rows are ranged over all trees together, so a large tree has many ranges. Equal rows are told
    apart by a random number, which lets a range end among them.
    """
    ranges = pieces(rows.count(), ROWS_PER_RANGE)
    salted = rows.withColumn("_salt", F.rand(11))
    ranges = max(ranges, rows.sparkSession.sparkContext.defaultParallelism)
    ranged = salted.repartitionByRange(ranges, "tree", *order, "_salt").withColumn("_range", F.spark_partition_id())
    ranged = written(ranged, "leaves")
    counts = ranged.groupBy("tree", "_range").agg(F.count("*").alias("_rows"))
    tree = Window.partitionBy("tree")
    before = F.sum("_rows").over(tree.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(
        "tree", "_range", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_rows").over(tree).alias("total")
    )
    within = F.row_number().over(Window.partitionBy("tree", "_range").orderBy(*order, "_salt"))
    return (
        ranged.join(counts, ["tree", "_range"])
        .withColumn("place", (F.col("_before") + within - 1).cast("long"))
        .drop("_range", "_before", "_salt")
    )


def _left(total: Column, fanout: int, level: int) -> Column:
    """Nodes of a tree at a level."""
    power = F.lit(min(fanout**level, 1 << 62))
    return F.floor((total - 1) / power) + 1


def _climbed(frame: DataFrame, fanout: int, base: int, levels: int) -> DataFrame:
    """Columns up_0 (given) to up_<levels>: the digests of a subtree's nodes, level by level.

    A tree that is down to one node stays as it is.
    """
    for level in range(levels):
        nodes = F.col(f"up_{level}")
        last = F.floor((F.size(nodes) - 1) / fanout).cast("int")
        parents = F.transform(
            F.sequence(F.lit(0), last), lambda i: F.sha2(F.array_join(F.slice(nodes, i * fanout + 1, fanout), ""), 256)
        )
        more = _left(F.col("total"), fanout, base + level) > 1
        frame = frame.withColumn(f"up_{level + 1}", F.when(more, parents).otherwise(nodes))
    return frame


def _path(index: Column, fanout: int, base: int, levels: int) -> Column:
    """Siblings on the way from a node of up_0 to the top of its subtree."""
    steps = []
    for level in range(levels):
        nodes = F.col(f"up_{level}")
        at = F.floor(index / fanout**level).cast("int")
        first = at - at % fanout
        step = F.struct(
            F.array_join(F.slice(nodes, first + 1, at - first), "").alias("before"),
            F.array_join(F.slice(nodes, at + 2, first + fanout - at - 1), "").alias("after"),
        )
        more = _left(F.col("total"), fanout, base + level) > 1
        steps.append(F.when(more, F.array(step)).otherwise(F.array().cast(f"array<{_STEP}>")))
    return F.concat(*steps)


def _round(state: DataFrame, fanout: int, size: int, base: int, levels: int, leaves: int) -> DataFrame:
    """One round: subtrees of ``size`` partitions each trade roots within groups of fanout ** levels."""
    group = fanout**levels
    blocks = F.floor((F.col("total") - 1) / leaves) + 1
    at = state.select(
        "*",
        F.floor(F.col("block") / size).alias("node"),
        F.floor(F.col("block") / (size * group)).alias("grouped"),
        (F.col("block") % size).alias("slot"),
    ).withColumn("holders", F.least(F.lit(size), blocks - F.col("node") * size))
    own = F.struct("block", "node", "proof")
    sent = at.select("tree", "grouped", "slot", "total", "node", "digest", own.alias("own"))
    lacking = (F.col("slot") + F.col("holders") < size) & (F.col("node") > F.col("grouped") * group)
    filled = at.where(lacking).select(
        "tree",
        "grouped",
        F.explode(F.sequence(F.col("slot") + F.col("holders"), F.lit(size - 1).cast("long"), F.col("holders"))).alias("slot"),
        "total",
        "node",
        "digest",
        F.lit(None).cast(sent.schema["own"].dataType).alias("own"),
    )
    traded = (
        sent.unionByName(filled)
        .groupBy("tree", "grouped", "slot")
        .agg(
            F.max("total").alias("total"),
            F.array_sort(F.collect_list(F.struct("node", "digest"))).alias("nodes"),
            F.collect_list("own").alias("members"),
        )
        .withColumn("up_0", F.transform("nodes", lambda n: n["digest"]))
    )
    path = F.transform(
        "members",
        lambda m: F.struct(
            m["block"].alias("block"),
            F.concat(m["proof"], _path((m["node"] % group).cast("int"), fanout, base, levels)).alias("proof"),
        ),
    )
    climbed = _climbed(traded, fanout, base, levels)
    return climbed.select(
        "tree", "total", F.col(f"up_{levels}")[0].alias("digest"), F.inline(path)
    ).select("tree", "block", "total", "digest", "proof")


def _built(rows: DataFrame, order: list[Column], fanout: int) -> tuple[DataFrame, DataFrame]:
    """Partitions of leaves, and for each of them its tree's top and the upper part of its proofs.

    ``rows`` has tree (not null), digest, and columns to carry along.
    """
    levels = _power(fanout, BLOCK_LEAVES)
    leaves = fanout**levels
    placed = _placed(rows, order)
    carried = [c for c in placed.columns if c not in ("tree", "total", "place")]
    blocks = placed.groupBy("tree", F.floor(F.col("place") / leaves).alias("block")).agg(
        F.max("total").alias("total"), F.array_sort(F.collect_list(F.struct("place", *carried))).alias("leaves")
    )
    blocks = written(blocks, "blocks")
    bottom = blocks.withColumn("up_0", F.transform("leaves", lambda row: row["digest"]))
    state = _climbed(bottom, fanout, 0, levels).select(
        "tree",
        "block",
        "total",
        F.col(f"up_{levels}")[0].alias("digest"),
        F.array().cast(f"array<{_STEP}>").alias("proof"),
    )
    state = written(state, "swaps", light=True)
    most = (state.agg(F.max("block")).first()[0] or 0) + 1
    each, size, base = _power(fanout, EXCHANGE), 1, levels
    while size < most:
        state = written(_round(state, fanout, size, base, each, leaves), "swaps", light=True)
        size, base = size * fanout**each, base + each
    return blocks, state


def manifest(
    docs: DataFrame,
    fields: Sequence[str],
    key: str,
    group: str,
    fanout: int = 2,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """A row per row of ``docs``: its key, leaf, subroot, root, proof, and the ``carry`` columns.

    ``proof`` has a step per level with the digests before and after the node in its run.
    """
    if fanout < 2:
        raise ValueError("fanout must be 2 or more")
    extra = carry or {}
    name = F.col(group).cast("string")
    rows = docs.select(
        F.when(name.isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), name)).alias("tree"),
        F.col(key).alias("key"),
        leaf([F.col(f) for f in fields]).alias("digest"),
        F.struct(F.lit(0).alias("_"), *[c.alias(n) for n, c in extra.items()]).alias("carry"),
    )
    blocks, tops = _built(rows, [F.col("key").asc_nulls_first(), F.col("digest")], fanout)
    subroots = tops.where("block = 0").select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    parts, ends = _built(subroots, [F.col("name")], fanout)
    roots = _unfolded(parts, ends, fanout).select(
        F.col("row.name").alias("tree"), F.col("top").alias("root"), F.col("proof").alias("last")
    )
    ends = tops.join(roots, "tree").select(
        "tree", "block", "digest", "root", F.concat("proof", "last").alias("proof")
    )
    return _unfolded(blocks, ends, fanout, ["root"]).select(
        F.col("row.key").alias(key),
        F.col("row.digest").alias("leaf"),
        F.col("top").alias("subroot"),
        "root",
        "proof",
        *[F.col(f"row.carry.{n}").alias(n) for n in extra],
    )


def _unfolded(blocks: DataFrame, tops: DataFrame, fanout: int, more: Sequence[str] = ()) -> DataFrame:
    """A row per leaf with its whole proof: what its partition hashes, then what the rounds brought."""
    levels = _power(fanout, BLOCK_LEAVES)
    upper = tops.select("tree", "block", F.col("digest").alias("top"), F.col("proof").alias("upper"), *more)
    joined = blocks.join(upper, ["tree", "block"]).withColumn("up_0", F.transform("leaves", lambda row: row["digest"]))
    climbed = _climbed(joined, fanout, 0, levels)
    row = F.transform(
        "leaves",
        lambda r: F.struct(
            r.alias("row"),
            F.concat(_path((r["place"] % fanout**levels).cast("int"), fanout, 0, levels), F.col("upper")).alias("proof"),
        ),
    )
    return climbed.select("top", *more, F.inline(row))
