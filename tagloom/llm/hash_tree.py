"""Shards by a weighted hash tree of regions, racks and shards (operator 4). Columns and joins alone.

A document goes down the tree from the root. At each node every child draws a number from the
document's id and the child's name, divided by the child's weight (the shards below it): -ln(u) / w.
The least wins, which gives each child a share of the documents in proportion to its weight. If a weight
rises, only documents that now draw less there move, and all of them move into that child; other
subtrees keep what they have. A shard that is added as a region of its own therefore takes documents
into itself alone: the law held is `key`.

Slots count the documents of a shard from 0 without gaps. Rows are numbered by input
partition when they are written; numbers in a shard are the place in (shard, partition) plus the sizes of the
partitions before, so neither a shard nor a repeated id is ever sorted in one task.

A null text has size 1 and the checksum of the empty text; null ids draw like any one id; repeated rows share
a shard and get slots of their own. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import exact
from tagloom.session import cut_lineage

REGIONS, RACKS, SHARDS = 2, 2, 4  # regions, racks in a region, shards in a rack
Tree = dict[str, list[tuple[str, float]]]


def topology(added: int = 0, regions: int = REGIONS, racks: int = RACKS, shards: int = SHARDS) -> Tree:
    """Children and their weights by node; each added shard is a region of its own.

    Leaves are named by their shard number. The tree's size is that of the cluster, not of the data.
    """
    tree: Tree = {"": []}
    for r in range(regions):
        tree[""].append((f"r{r}", float(racks * shards)))
        tree[f"r{r}"] = [(f"r{r}k{k}", float(shards)) for k in range(racks)]
        for k in range(racks):
            first = (r * racks + k) * shards
            tree[f"r{r}k{k}"] = [(str(first + s), 1.0) for s in range(shards)]
    for a in range(added):
        region = f"r{regions + a}"
        tree[""].append((region, 1.0))
        tree[region] = [(f"{region}k0", 1.0)]
        tree[f"{region}k0"] = [(str(regions * racks * shards + a), 1.0)]
    return tree


def _draw(key: Column, name: Column, weight: Column) -> Column:
    """A number with mean 1 / weight, from key and name alone."""
    unit = (F.shiftrightunsigned(F.xxhash64(key, name), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(unit) / weight


def _descend(key: Column, tree: Tree, node: Column) -> Column:
    """The child that wins at the node."""
    cells = []
    for name, children in tree.items():
        cells += [F.lit(name), F.array(*(F.struct(F.lit(c).alias("name"), F.lit(w).alias("weight")) for c, w in children))]
    children = F.element_at(F.create_map(*cells), node)
    draws = F.transform(children, lambda c: F.struct(_draw(key, c["name"], c["weight"]).alias("draw"), c["name"].alias("name")))
    return F.array_min(draws)["name"]


def shard_of(key: Column, tree: Tree) -> Column:
    """Number of the shard of a key: three draws, by region, rack and shard."""
    by_level: list[Tree] = [{"": tree[""]}]
    while any(child in tree for children in by_level[-1].values() for child, _ in children):
        by_level.append({c: tree[c] for children in by_level[-1].values() for c, _ in children})
    node = F.lit("")
    for level in by_level:
        node = _descend(key, level, node)
    return node.cast("int")


def place(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) for every row."""
    key, text = exact(id_col), F.coalesce(exact(text_col), F.lit(""))
    rows = docs.select(
        key.alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows = rows.select(
        "*",
        shard_of(F.col("id"), topology()).alias("shard"),
        shard_of(F.col("id"), topology(added=1)).alias("grown_shard"),
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = cut_lineage(rows)  # partition and row numbers are fixed from here on
    sizes = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    own = Window.partitionBy("shard", "part").orderBy("row")
    numbered = rows.withColumn("place", F.row_number().over(own)).join(starts, ["shard", "part"])
    return numbered.select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("start") + F.col("place") - 1).cast("long").alias("slot"),
        "grown_shard",
    )
