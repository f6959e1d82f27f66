"""Prefix trie of conversations by truncation peeling.

Conversations that are equal turn by turn are one sequence. From the deepest turn upwards, the sequences that end at
a depth merge with the nodes that survive there, each node gives its turn away, and what is left is grouped again
into the nodes of the depth above; counts, smallest members, leaves and saved tokens add up on the way, so that every
node is complete when its depth is reached.

A subtree of at most ``TURNS`` turns below its top (or with one sequence only) is peeled inside one task; tasks take
many of them, one after another. What they hand up, the tops of these subtrees, is peeled by Spark, one grouping per
depth, from the deepest top to the root. So no task holds more than a bounded subtree, and as many rounds are needed
as large subtrees are deep. Tops are looked for at depths 1, 2, 4, 8 and so on; a sequence that has none is its own.

Nodes are known by a chain of digests over role and text; texts themselves are read once and not moved. The turns of
one conversation stand in one row, as digests and lengths. Nodes under a frequent parent meet it spread over
``SALTS`` numbers. The ids that end at a node are joined to text in ranges of ids; the last step reads a node's
ranges one after another, since its digest is of one sequence of bytes.

Turns are in the order of ``turn``, null first, equal ones by the digest of role and text; repeated rows are turns of
their own. Null role or text is empty. Rows with a null ``conv_id`` belong to no conversation and are left out. An
empty table has no nodes. Columns other than the four named take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import written

# Turns below a subtree's top that one task may hold at a time.
TURNS = 20_000
SALTS = 64
# Ids that are joined to one piece of text: those that share all but their last bits.
RANGE_BITS = 14
ROOT = bytes(16)

SEQUENCES = "conv_id long, n_ends long, keys array<binary>, chars array<long>"
OUTPUT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
_SUMS = ("n_convs", "n_children", "leaves", "saved")
_LOCAL = "key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
_TOP = "key binary, depth long, conv_id long, n_convs long, n_children long, leaves long, saved long, keys array<binary>, chars array<long>"


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns`` with the turns of every conversation in order, as digest and code points of the text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    # The length of the role keeps role and text apart.
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.struct("turn", digest.alias("digest"), F.length(text).cast("long").alias("chars")).alias("t")
    )
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(ordered: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """:func:`turns` after the first ``h`` of each were replaced by those of the first conversation of its block.

    ``h`` is the crc32 of the id in decimal, modulo ``most``; an absent first conversation has no turns.
    """
    first = F.col("conv_id") - F.col("conv_id") % block
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)).cast("int")
    rows = ordered.select("conv_id", "turns", first.alias("base"), h.alias("h"))
    heads = ordered.where(F.col("conv_id") % block == 0)
    heads = heads.select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    size = F.size("turns")
    own = F.slice("turns", F.col("h") + 1, F.greatest(size - F.col("h"), F.lit(0)))
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    return rows.join(heads, "base", "left").select("conv_id", F.concat(head, own).alias("turns"))


def _chained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        every = []
        for digests in batch["digests"]:
            key, keys = ROOT, []
            for digest in digests:
                key = hashlib.blake2b(key + bytes(digest), digest_size=16).digest()
                keys.append(key)
            every.append(keys)
        yield pd.DataFrame({"conv_id": batch["conv_id"], "keys": every, "chars": batch["chars"]})


def chains(conversations: DataFrame) -> DataFrame:
    """``conv_id, keys, chars``: the node at each depth, and the code points of its last text."""
    flat = conversations.select("conv_id", F.col("turns.digest").alias("digests"), F.col("turns.chars").alias("chars"))
    return flat.mapInPandas(_chained, "conv_id long, keys array<binary>, chars array<long>")


def _end() -> Column:
    return F.coalesce(F.try_element_at("keys", F.lit(-1)), F.lit(ROOT))


def sequences(chained: DataFrame) -> DataFrame:
    """:data:`SEQUENCES`: conversations that are equal to the end as one, under their smallest id."""
    ends = chained.groupBy(_end().alias("end")).agg(F.count("*").alias("n_ends"), F.min("conv_id").alias("conv_id"))
    return chained.join(ends.drop("end"), "conv_id").select("conv_id", "n_ends", "keys", "chars")


def _salt(column: str | Column, salts: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(salts)).cast("int")


def _with_top(each: DataFrame, most_turns: int, salts: int) -> DataFrame:
    """Sequences with the ``top`` depth of the subtree that is peeled in one task."""
    depth = F.size("keys")
    places = F.filter(F.array(*[F.lit(1 << k) for k in range(31)]), lambda d: d <= depth)
    cuts = each.select("conv_id", depth.alias("depth"), F.explode(places).alias("cut"), "keys").select(
        "conv_id", "cut", F.element_at("keys", F.col("cut")).alias("key"), (F.col("depth") - F.col("cut") + 1).alias("below")
    )
    cuts = cuts.withColumn("salt", _salt("conv_id", salts))
    # Counted per salt first: one row for each salt that a subtree's sequences have.
    cells = cuts.groupBy("cut", "key", "salt").agg(F.sum("below").alias("below"), F.count("*").alias("n"))
    large = cells.groupBy("cut", "key").agg(F.sum("below").alias("below"), F.sum("n").alias("n"), F.collect_list("salt").alias("salts"))
    large = large.where((F.col("below") > most_turns) & (F.col("n") > 1)).select("cut", "key", F.explode("salts").alias("salt"))
    small = cuts.join(large, ["cut", "key", "salt"], "left_anti")
    tops = small.groupBy("conv_id").agg(F.min("cut").alias("top"))
    return each.join(tops, "conv_id", "left").withColumn("top", F.coalesce("top", F.size("keys")))

_PEELED = ", ".join([*_LOCAL.split(", "), *(part for part in _TOP.split(", ") if part not in _LOCAL.split(", "))])


class _Node:
    __slots__ = ("conv_id", "n_convs", "n_children", "leaves", "saved", "keys", "chars", "children")

    def __init__(self) -> None:
        self.conv_id, self.n_convs, self.n_children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.keys = self.chars = None
        self.children: list = []

    def member(self, conv_id: int, n: int, keys, chars) -> None:
        self.n_convs += n
        if self.conv_id is None or conv_id < self.conv_id:
            self.conv_id, self.keys, self.chars = conv_id, keys, chars


def peel(group: list[tuple], top: int) -> tuple[list[tuple], _Node]:
    """Nodes below depth ``top`` of sequences that share the first ``top`` turns, and their node at ``top``.

    The last is without its own text: other sequences may end there.
    """
    ended: dict[int, list[tuple]] = {}
    for row in group:
        ended.setdefault(len(row[2]), []).append(row)
    alive: dict[bytes, _Node] = {}
    out = []
    for depth in range(max(ended), top - 1, -1):
        for conv_id, n, keys, chars in ended.get(depth, ()):
            alive.setdefault(keys[depth - 1] if depth else ROOT, _Node()).member(conv_id, n, keys, chars)
        # Whole now: what ended here and what survived from below.
        for node in alive.values():
            out += [(key, c, d, node.conv_id, *rest) for key, c, d, *rest in node.children]
        if depth == top:
            break
        above: dict[bytes, _Node] = {}
        for key, node in alive.items():
            leaves = node.leaves if node.n_children else 1
            saved = node.saved + (node.n_convs - 1) * int(node.chars[depth - 1])
            parent = above.setdefault(node.keys[depth - 2] if depth > 1 else ROOT, _Node())
            parent.member(node.conv_id, node.n_convs, node.keys, node.chars)
            parent.n_children += 1
            parent.leaves += leaves
            parent.saved += saved
            parent.children.append((key, node.conv_id, depth, node.n_convs, node.n_children, leaves, saved))
        alive = above
    (node,) = alive.values()
    return out, node


def _peeled(batches: Iterator[pd.DataFrame], most_turns: int) -> Iterator[pd.DataFrame]:
    """Nodes below the tops, and the tops themselves (``keys`` not null), of rows in the order of their tops."""
    nodes: list[tuple] = []
    tops: list[tuple] = []

    def flush() -> pd.DataFrame:
        names = _names(_PEELED)
        below = [dict(zip(_names(_LOCAL), row)) for row in nodes]
        above = [dict(zip(_names(_TOP), row)) for row in tops]
        nodes.clear()
        tops.clear()
        rows = [[row.get(name) for name in names] for row in below + above]
        columns = {name: pd.Series([row[i] for row in rows], dtype=object) for i, name in enumerate(names)}
        return pd.DataFrame({n: c if n in ("key", "keys", "chars") else c.astype("Int64") for n, c in columns.items()})

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for conv_id, n, keys, chars, top in zip(*(batch[c] for c in ("conv_id", "n_ends", "keys", "chars", "top"))):
                yield (top, keys[top - 1] if top else ROOT), (conv_id, n, keys, chars)

    for (top, key), group in groupby(rows(), key=lambda row: row[0]):
        found, node = peel([row for _, row in group], top)
        nodes += found
        prefix = [bytes(k) for k in node.keys[:top]], [int(c) for c in node.chars[:top]]
        tops.append((key, top, node.conv_id, node.n_convs, node.n_children, node.leaves, node.saved, *prefix))
        if len(nodes) + len(tops) > most_turns:
            yield flush()
    if nodes or tops:
        yield flush()


def _grown(rows: DataFrame, depth: int) -> DataFrame:
    """Whole nodes of a depth from what ended there and what its children gave."""
    sums = [F.sum(c).alias(c) for c in _SUMS]
    both = F.min_by(F.struct("keys", "chars"), "conv_id").alias("path")
    found = F.collect_set("salt").alias("salts")
    nodes = rows.groupBy("key").agg(F.min("conv_id").alias("conv_id"), *sums, both, found)
    own = F.coalesce(F.try_element_at("path.chars", F.lit(depth)), F.lit(0)) if depth else F.lit(0)
    return nodes.select(
        "key", "conv_id", "n_convs", "n_children", F.when(F.col("n_children") == 0, 1).otherwise(F.col("leaves")).alias("n_leaves"),
        (F.col("saved") + (F.col("n_convs") - 1) * own).alias("saved_tokens"), "path.keys", "path.chars", "salts",
    )


def _raised(tops: DataFrame, salts: int) -> list[DataFrame]:
    """Nodes at and above the tops, one grouping per depth, written one after another."""
    deepest = tops.agg(F.max("depth")).first()[0]
    if deepest is None:
        return []
    below, out = None, []
    for depth in range(deepest, -1, -1):
        ended = tops.where(F.col("depth") == depth).select("key", "conv_id", *_SUMS, "keys", "chars", F.lit(None).cast("int").alias("salt"))
        given = ended
        if below is not None:
            parent = F.element_at("keys", depth) if depth else F.lit(ROOT)
            one = F.lit(1).cast("long")
            up = below.withColumn("parent", parent).withColumn("salt", _salt("key", salts))
            given = ended.unionByName(
                up.select(
                    F.col("parent").alias("key"), "conv_id", "n_convs", one.alias("n_children"), F.col("n_leaves").alias("leaves"),
                    F.col("saved_tokens").alias("saved"), "keys", "chars", "salt",
                )
            )
        nodes = written(_grown(given, depth), f"trie-depth-{depth}")
        if below is not None:
            # Children meet their parent under the salts that they have: a frequent parent is spread.
            spread = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.explode("salts").alias("salt"))
            out.append(_node_rows(up.join(spread, ["parent", "salt"]), depth + 1))
        below = nodes
    out.append(_node_rows(below.withColumn("parent_conv_id", F.lit(None).cast("long")), 0))
    return out


def _node_rows(rows: DataFrame, depth: int) -> DataFrame:
    return rows.withColumn("depth", F.lit(depth).cast("long")).select(*_names(_LOCAL))


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digest of the pieces of every node, rows in the order of node and piece."""
    state, current = None, None
    done: list[tuple] = []
    for batch in batches:
        for key, piece in zip(batch["end"], batch["piece"]):
            if key != current:
                if current is not None:
                    done.append((current, state.hexdigest()))
                state, current = hashlib.sha256(piece.encode()), key
            else:
                state.update(b"," + piece.encode())
        if done:
            yield pd.DataFrame(done, columns=["key", "ends_sha256"])
            done = []
    if current is not None:
        yield pd.DataFrame([(current, state.hexdigest())], columns=["key", "ends_sha256"])


def ends(chained: DataFrame, range_bits: int = RANGE_BITS) -> DataFrame:
    """``key, ends_sha256``: for each node where conversations end, the digest of their ids in ascending order."""
    rows = chained.select(_end().alias("end"), "conv_id", F.shiftright("conv_id", range_bits).alias("range"))
    pieces = rows.groupBy("end", "range").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("piece")
    )
    ordered = pieces.repartition("end").sortWithinPartitions("end", "range")
    return ordered.select("end", "piece").mapInPandas(_hashed, "key binary, ends_sha256 string")


def trie(conversations: DataFrame, most_turns: int = TURNS, salts: int = SALTS, range_bits: int = RANGE_BITS) -> DataFrame:
    """:data:`OUTPUT` for every node over ``conv_id, turns`` as :func:`turns` or :func:`rebuilt` give them."""
    chained = written(chains(conversations), "trie-chains")
    placed = _with_top(written(sequences(chained), "trie-sequences"), most_turns, salts)
    top = F.when(F.col("top") == 0, F.lit(ROOT)).otherwise(F.try_element_at("keys", F.col("top")))
    placed = placed.withColumn("top_key", top).repartition("top", "top_key").sortWithinPartitions("top", "top_key")
    peeled = written(placed.drop("top_key").mapInPandas(lambda batches: _peeled(batches, most_turns), _PEELED), "trie-peeled")
    nodes = peeled.where("keys is null").select(*_names(_LOCAL))
    for level in _raised(peeled.where("keys is not null"), salts):
        nodes = nodes.unionByName(level)
    found = nodes.join(ends(chained, range_bits), "key", "left")
    return found.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256))).select(*OUTPUT)
