"""Shards by a hierarchical weighted hash tree: a document descends from regions to racks to shards.

At every node each child draws ``-ln(u) / weight`` with ``u`` a hash of the document's id and the child's name,
and the smallest draw wins; a child gets documents in proportion to its weight, which is the sum of the weights
below it. A change of weight moves documents only into, out of or within subtrees whose weight changes, as all
other draws stay. A shard added in a region of its own (:func:`grown`) thus takes documents only into itself;
one added to a rack draws documents into that rack and region as well.

Everything is column expressions and window functions. A null id hashes like any other value, so such rows
share one shard; null texts have no bytes. Repeated rows get slots of their own. An empty table gives an empty
result. Columns other than ``doc_id`` and ``text`` take no part.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROW_BYTES = 8
SLOT_BUCKETS = 1024
_UNIT = float(1 << 53)


@dataclass(frozen=True)
class Shard:
    number: int
    region: str
    rack: str
    weight: float = 1.0


Tree = tuple[Shard, ...]


# Shards that share regions and racks; those added later stand in regions of their own.
FOUNDING = 24


def balanced(shards: int, racks: int = 2, per_rack: int = 4, founding: int = FOUNDING) -> Tree:
    """Equal shards, ``per_rack`` to a rack and ``racks`` to a region; beyond ``founding`` a region each.

    With ``founding`` shards or more, ``balanced(n + 1)`` is ``grown(balanced(n))``: the number of shards alone says
    where a row belongs, and one more shard takes rows only into itself. A smaller number of shards is a cluster that
    was founded with so many.
    """
    tree = tuple(
        Shard(i, f"region-{i // (racks * per_rack)}", f"rack-{i // per_rack}") for i in range(min(shards, founding))
    )
    for _ in range(founding, shards):
        tree = grown(tree)
    return tree


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """``tree`` with one more shard in a region and rack of its own."""
    number = max((s.number for s in tree), default=-1) + 1
    return (*tree, Shard(number, f"added-{number}", f"added-{number}", weight))


def _grouped(tree: Tree, attribute: str) -> dict[str, Tree]:
    groups: dict[str, list[Shard]] = {}
    for shard in tree:
        groups.setdefault(getattr(shard, attribute), []).append(shard)
    return {name: tuple(members) for name, members in groups.items()}


def _child(label: str, to: int, members: Tree) -> dict:
    return {"label": label, "to": to, "weight": sum(s.weight for s in members)}


def levels(tree: Tree) -> tuple[list[list[dict]], list[list[dict]], list[list[dict]]]:
    """The children of the root, of every region and of every rack, which a child names by its place (a shard by its number).

    Children without weight are left out: they get nothing.
    """
    regions, racks, leaves = [], [], []
    for region, members in _grouped(tree, "region").items():
        inside = []
        for rack, shards in _grouped(members, "rack").items():
            inside.append(_child(f"rack:{region}:{rack}", len(leaves), shards))
            leaves.append([_child(f"shard:{region}:{rack}:{s.number}", s.number, (s,)) for s in shards])
        regions.append(_child(f"region:{region}", len(racks), members))
        racks.append(inside)
    return tuple([[c for c in children if c["weight"] > 0] for children in nodes] for nodes in ([regions], racks, leaves))


def _descend(key: Column, nodes: list[list[dict]], at: Column) -> Column:
    """The place of the child with the smallest draw, of the children of node ``at``; null if there are none."""
    # One constant for all nodes of a level: the expression does not grow with the tree.
    known = F.from_json(F.lit(json.dumps(nodes)), "array<array<struct<label:string,to:int,weight:double>>>")

    def draw(child: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, child["label"]), 11).cast("double")
        return F.struct((-F.log((bits + 0.5) / _UNIT) / child["weight"]).alias("draw"), child["to"].alias("to"))

    return F.array_min(F.transform(F.get(known, at), draw))["to"]


def with_shard(df: DataFrame, key: str, tree: Tree, to: str) -> DataFrame:
    """``df`` with the number of the shard that ``key`` descends to."""
    if len({s.number for s in tree}) < len(tree):
        raise ValueError("shard numbers must differ")
    place = F.lit(0)
    for nodes in levels(tree):
        place = _descend(F.col(key), nodes, place)
    return df.withColumn(to, place)


def assign(docs: DataFrame, tree: Tree, buckets: int = SLOT_BUCKETS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row.

    A shard's slots are counted in buckets by hash of the id, each of which knows how many rows of its shard lie
    in the buckets before: no task numbers a whole shard.
    """
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    bucket = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("slot")), F.lit(buckets)).cast("int")
    placed = with_shard(with_shard(rows, "doc_id", tree, "shard"), "doc_id", grown(tree), "grown_shard")
    placed = placed.withColumn("bucket", bucket)
    # At most one row per shard and bucket; only ids are read for it.
    counts = with_shard(docs.select("doc_id"), "doc_id", tree, "shard").groupBy("shard", bucket.alias("bucket")).count()
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    numbered = placed.withColumn("within", F.row_number().over(inside) - 1)
    return numbered.join(offsets, ["shard", "bucket"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("offset") + F.col("within")).cast("long").alias("slot"),
        "grown_shard",
    )
