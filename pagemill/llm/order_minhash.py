"""Near-duplicates by order MinHash, verified by banded alignment.

A text is its words in lower case. Its k-mers are ``K`` consecutive words with the number of their occurrence,
so that a repeated k-mer counts every time. Each of ``SKETCHES`` hash functions takes the ``LENGTH`` k-mers of
smallest hash, and keeps them in the order of the text: two texts share the sketch with a probability that
falls with their edit distance, moved passages included. Texts that share a sketch are candidates; a pair is
linked if its words align with at most ``1 - SIMILARITY`` edits per word of the longer text. Classes are the
connected components of links.

Equal texts are one vertex from the start. The texts of one sketch are compared in rounds: first one of them with all
others, then the next sixteen with those that are left. Where texts of different classes are still left, all of them
are compared, in blocks: every pair of blocks is a group of at most about twice ``BLOCK`` texts, so that a text moves
once for a block of others and not once for each of them. Each pair is compared once, in the first sketch that it
shares. Left out are only pairs that are of one class by the links found so far, which change no class, and pairs
whose numbers of words, in all or by classes of words, differ by more than the edits allow.

A text of fewer than ``K`` words is one k-mer of all its words; texts without words are equal if their
characters are. Null counts as empty. A row without an id takes the class of the texts equal to its own, or
none. Rows that repeat an id with an equal text are one document and share its class and mark; an id that
repeats with different texts is compared by one of them. Class ids are the smallest ``doc_id`` of the class. An empty table gives an empty result. Columns other than ``doc_id`` and
``text`` take no part.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.common import words, written
from pagemill.llm.components import components

K = 5
SKETCHES = 24
LENGTH = 4
SIMILARITY = 0.8
# Hash buckets that say which texts may be needed for alignment; their number bounds what is broadcast.
BUCKETS = 1 << 20
# Texts of one sketch that its others are compared with, round by round, before all that are left are compared.
ROUNDS = (1, 16)
# Texts of one sketch in a block.
BLOCK = 256
# Classes of words whose numbers are compared before an alignment: an edit changes those of two classes by one at most.
WORD_CLASSES = 128
# Edits up to which an alignment goes from edit to edit; beyond them it goes column by column.
FEW = 24
# Columns by which the band moves at a time.
_COLUMNS = 256
# Elements of the matrix of hashes that is held at a time.
_MATRIX = 1 << 19

_SEEDS = np.random.default_rng(20240607).integers(1, 1 << 63, size=256, dtype=np.uint64)
_POWERS = np.asarray([pow(0x9E3779B97F4A7C15, i, 1 << 64) for i in range(1, 257)], dtype=np.uint64)

SKETCHED = "doc_id long, node binary, n_words int, sketches array<long>, counts array<short>"


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers; wraps around."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_codes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, tokens), dtype=np.uint32, count=len(tokens))


def class_counts(codes: np.ndarray) -> np.ndarray:
    """Number of words of each class; cut off where it does not fit, which brings no two texts further apart."""
    return np.minimum(np.bincount(codes % WORD_CLASSES, minlength=WORD_CLASSES), 32_767).astype(np.int16)


def kmers(codes: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of the k-mers in the order of the text."""
    n = len(codes) - k + 1
    wide = codes.astype(np.uint64) + np.uint64(1)
    if n < 1:
        return _mix((wide * _POWERS[: len(wide)]).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(wide)))
    total = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        total += wide[i : i + n] * _POWERS[i]
    return _mix(total)


def with_occurrence(grams: np.ndarray) -> np.ndarray:
    """Different hashes for a k-mer's first, second, … occurrence."""
    order = np.argsort(grams, kind="stable")
    ordered = grams[order]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    nth = np.arange(len(grams)) - np.repeat(first, np.diff(np.append(first, len(grams))))
    out = np.empty_like(grams)
    out[order] = _mix(ordered + nth.astype(np.uint64) * _POWERS[1])
    return out


def sketches(codes: np.ndarray, k: int = K, count: int = SKETCHES, length: int = LENGTH) -> np.ndarray:
    """One key per hash function, of its smallest k-mers in the order of the text."""
    grams = kmers(codes, k)
    labelled = with_occurrence(grams)
    take = min(length, len(grams))
    at = np.empty((count, take), dtype=np.int64)
    step = max(1, _MATRIX // len(grams))
    for i in range(0, count, step):
        hashes = _mix(labelled[None, :] ^ _SEEDS[i : min(i + step, count), None])
        at[i : i + step] = np.argpartition(hashes, take - 1, axis=1)[:, :take]
    at.sort(axis=1)
    chosen = _mix(grams[at] * _POWERS[:take])
    return _mix(chosen.sum(axis=1, dtype=np.uint64) ^ _SEEDS[:count]).view(np.int64)


def distance(a: np.ndarray, b: np.ndarray, limit: int) -> int | None:
    """Edit distance of two sequences if at most ``limit``.

    For each number of edits, how far each diagonal of the band gets; runs of equal elements are free.
    """
    n, m = len(a), len(b)
    if abs(n - m) > limit:
        return None
    end = n - m
    width = 2 * limit + 3
    far = np.full(width, -1, dtype=np.int64)
    middle = limit + 1

    def slide(x: int, y: int) -> int:
        x0, step = x, 32
        while x < n and y < m:
            size = min(step, n - x, m - y)
            unequal = a[x : x + size] != b[y : y + size]
            first = int(unequal.argmax())
            if unequal[first]:
                return x + first - x0
            x, y, step = x + size, y + size, step * 4
        return x - x0

    far[middle] = slide(0, 0)
    if end == 0 and far[middle] >= n:
        return 0
    for edits in range(1, limit + 1):
        # Diagonals from which the end can still be reached.
        low = max(-edits, end - (limit - edits))
        high = min(edits, end + (limit - edits))
        if low > high:
            return None
        ks = np.arange(low, high + 1)
        here = slice(middle + low, middle + high + 1)
        left, right = slice(here.start - 1, here.stop - 1), slice(here.start + 1, here.stop + 1)
        changed = np.where(far[here] >= 0, far[here] + 1, -1)
        dropped = np.where(far[left] >= 0, far[left] + 1, -1)
        x = np.maximum(np.maximum(changed, dropped), far[right])
        x = np.minimum(x, np.minimum(n, m + ks))
        x[x < ks] = -1
        y = x - ks
        can = np.flatnonzero((x >= 0) & (x < n) & (y < m))
        can = can[a[x[can]] == b[y[can]]]
        for i in can:
            x[i] += slide(int(x[i]), int(y[i]))
        new = np.full(width, -1, dtype=np.int64)
        new[here] = x
        far = new
        if low <= end <= high and far[middle + end] >= n:
            return edits
    return None


def _places(rows: np.ndarray, wanted: set[int]) -> dict[int, int]:
    """For each wanted element, a number whose bits say where in ``rows`` it is."""
    if len(rows) <= 4_096:
        found: dict[int, int] = {}
        for i, value in enumerate(rows.tolist()):
            if value in wanted:
                found[value] = found.get(value, 0) | 1 << i
        return found
    order = np.argsort(rows, kind="stable")
    values, first = np.unique(rows[order], return_index=True)
    ends = np.append(first, len(rows))
    found = {}
    for n, value in enumerate(values.tolist()):
        if value in wanted:
            bits = np.zeros(len(rows), dtype=np.uint8)
            bits[order[ends[n] : ends[n + 1]]] = 1
            found[value] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
    return found


def band_distance(a: np.ndarray, b: np.ndarray, limit: int) -> int | None:
    """Edit distance of two sequences if at most ``limit``, for pairs with many edits.

    One column of the band at a time, as two long integers: the rows where the distance goes up and those where it
    goes down. The band moves by ``_COLUMNS`` columns at a time; rows that leave it above are shifted out, rows
    that enter below cost an edit each. No path of ``limit`` edits leaves the band.
    """
    n, m = len(a), len(b)
    if abs(n - m) > limit:
        return None
    low = high = 0
    up = down = score = 0
    for start in range(0, m, _COLUMNS):
        columns = b[start : start + _COLUMNS].tolist()
        new_low, new_high = min(max(0, start - limit), high), min(n, start + len(columns) + limit)
        up, down = up >> (new_low - low), down >> (new_low - low)
        up |= ((1 << (new_high - high)) - 1) << (high - new_low)
        score += new_high - high
        low, high = new_low, new_high
        size = high - low
        mask, bottom = (1 << size) - 1, size - 1
        places = _places(a[low:high], set(columns))
        for value in columns:
            equal = places.get(value, 0)
            same = (((equal & up) + up) ^ up) | equal | down
            right_up = down | (mask & ~(same | up))
            right_down = up & same
            if size:
                score += (right_up >> bottom & 1) - (right_down >> bottom & 1)
            else:
                score += 1
            right_up = (right_up << 1 | 1) & mask
            right_down = right_down << 1 & mask
            up = right_down | (mask & ~(same | right_up))
            down = right_up & same
    score += n - high
    return score if score <= limit else None


def similar(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether two word sequences align with at most ``1 - similarity`` edits per word of the longer."""
    longer = max(len(a), len(b))
    limit = int((1 - similarity) * longer + 1e-9)
    if abs(len(a) - len(b)) > limit:
        return False
    size = min(len(a), len(b))
    unequal = a[:size] != b[:size]
    head = int(unequal.argmax()) if unequal.any() else size
    a, b = a[head:], b[head:]
    size = min(len(a), len(b))
    unequal = a[len(a) - size :][::-1] != b[len(b) - size :][::-1]
    tail = int(unequal.argmax()) if unequal.any() else size
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if max(len(a), len(b)) <= limit:
        return True
    # Words that one side has and the other lacks need an edit each.
    values, where = np.unique(np.concatenate((a, b)), return_inverse=True)
    both = np.minimum(np.bincount(where[: len(a)], minlength=len(values)), np.bincount(where[len(a) :], minlength=len(values)))
    least = max(len(a), len(b)) - int(both.sum())
    if least > limit:
        return False
    if least <= FEW < limit and distance(a, b, FEW) is not None:
        return True
    return (distance if limit <= FEW else band_distance)(a, b, limit) is not None


def _sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    none = np.zeros(0, dtype=np.int64)
    for batch in batches:
        rows = []
        for text in batch["text"]:
            tokens = words(text)
            # Texts without words differ by their characters.
            content = b" ".join(tokens) if tokens else b"\n" + (text or "").encode("utf-8", "surrogatepass")
            node = hashlib.blake2b(content, digest_size=16).digest()
            codes = word_codes(tokens)
            rows.append((node, len(tokens), sketches(codes) if tokens else none, class_counts(codes)))
        out = pd.DataFrame(rows, columns=["node", "n_words", "sketches", "counts"])
        out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
        yield out


def _codes(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: word_codes(words(t)).tobytes(), na_action=None)


def _aligned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        near = [
            similar(np.frombuffer(a, dtype=np.uint32), np.frombuffer(b, dtype=np.uint32))
            for a, b in zip(batch["a"], batch["b"])
        ]
        yield batch[["leader_label", "label"]].set_axis(["u", "v"], axis=1)[np.asarray(near, dtype=bool)]


def _aligned_blocks(group: pd.DataFrame) -> pd.DataFrame:
    """Links between the classes of one block, or of two blocks, of the texts that share a sketch."""
    key, low, high = group["key"].iat[0], group["low"].iat[0], group["high"].iat[0]
    codes = [np.frombuffer(c, dtype=np.uint32) for c in group["codes"]]
    size, block, label = group["n_words"].to_numpy(), group["block"].to_numpy(), group["label"].to_numpy()
    sketches_, counts = np.stack(group["sketches"].to_list()), np.stack(group["counts"].to_list()).astype(np.int32)
    root = {x: x for x in label.tolist()}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    links = []
    for i in np.flatnonzero(block == low).tolist():
        js = np.arange(i + 1, len(group)) if low == high else np.flatnonzero(block == high)
        js = js[label[js] != label[i]]
        longer = np.maximum(size[js], size[i])
        js = js[np.minimum(size[js], size[i]) >= longer * SIMILARITY - 1e-9]
        same = sketches_[js] == sketches_[i]
        js = js[sketches_[i][same.argmax(axis=1)] == key]
        edits = np.floor(np.maximum(size[js], size[i]) * (1 - SIMILARITY) + 1e-9)
        js = js[np.abs(counts[js] - counts[i]).sum(axis=1) <= 2 * edits]
        for j in js.tolist():
            a, b = find(int(label[i])), find(int(label[j]))
            if a != b and similar(codes[i], codes[j]):
                root[a] = b
                links.append((label[i], label[j]))
    return pd.DataFrame(links, columns=["u", "v"], dtype="int64")


def _bucket(column: str) -> Column:
    return F.pmod(F.xxhash64(F.col(column)), F.lit(BUCKETS)).cast("int")


def _open(rows: DataFrame) -> DataFrame:
    """``rows`` whose sketch texts have that are not known to be of one class."""
    mixed = rows.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a != b").select("key")
    return rows.join(mixed, "key")


def _lengths_allow() -> Column:
    longer, shorter = F.greatest("n_words", "leader_n_words"), F.least("n_words", "leader_n_words")
    return shorter >= longer * SIMILARITY - 1e-9


def _words_allow() -> Column:
    """Whether the edits between a text and a leader can be few enough, by their numbers of words of each class."""
    longer = F.greatest("n_words", "leader_n_words")
    apart = F.expr("aggregate(zip_with(counts, leader_counts, (a, b) -> abs(int(a) - int(b))), 0, (s, x) -> s + x)")
    return apart <= 2 * F.floor(longer * (1 - SIMILARITY) + 1e-9)


def _involved(reps: DataFrame) -> DataFrame:
    """Texts that share sketches, with those sketches as ``keys`` and the number of texts that have them as ``weight``.

    Of many copies of a text with a few edits each, the text itself and those with the fewest edits have the
    largest weights: most of the others align with them.
    """
    members = reps.select("rep", F.explode("sketches").alias("key"))
    shared = members.groupBy("key").agg(F.count("*").alias("n"), F.min("rep").alias("a"), F.max("rep").alias("b"))
    own = members.join(shared.where("a != b").select("key", "n"), "key")
    own = own.groupBy("rep").agg(F.sum("n").alias("weight"), F.collect_set("key").alias("keys"))
    return reps.select("rep", "n_words", "sketches", "counts").join(own, "rep")


def _blocks(rows: DataFrame) -> DataFrame:
    """``rows`` with ``block``, once for every pair ``low, high`` of blocks of their sketch that theirs is in."""
    sizes = rows.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = rows.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return placed.select(*rows.columns, "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))


def _merged(roots: DataFrame, near: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``roots`` after ``near`` has linked classes, and the classes that have a new root."""
    new = components(near)
    later = new.select(F.col("id").alias("root"), F.col("root").alias("now"))
    moved = roots.join(later, "root", "left").select("id", F.coalesce("now", "root").alias("root"))
    return moved.unionByName(new), new


def class_roots(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``id, root``: the ``rep`` ids that are not the smallest of their class, with the smallest."""
    involved = written(_involved(nodes.where(F.col("rep").isNotNull())), "involved")
    texts = _codes_of(docs, involved.select("rep"))
    rows = involved.select("*", F.explode("keys").alias("key"), F.col("rep").alias("label")).drop("keys")
    roots = involved.select(F.col("rep").alias("id"), F.col("rep").alias("root")).limit(0)
    for leaders in ROUNDS:
        # Only as many rows of a sketch as there are leaders pass on to be ranked.
        rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("weight"), "rep"))
        first = rows.withColumn("rank", rank).where(F.col("rank") <= leaders)
        first = written(first.select("key", *(F.col(c).alias(f"leader_{c}") for c in rows.columns if c != "key")), "leaders")
        # A hot sketch is split by the join: it has few leaders and many rows.
        behind = (F.col("weight") < F.col("leader_weight")) | (
            (F.col("weight") == F.col("leader_weight")) & (F.col("rep") > F.col("leader_rep"))
        )
        here = F.expr("get(filter(sketches, (s, i) -> s = leader_sketches[i]), 0) = key")
        pairs = rows.join(first, "key").where(
            behind & (F.col("label") != F.col("leader_label")) & _lengths_allow() & here & _words_allow()
        )
        compared = (
            pairs.select("leader_rep", "leader_label", "rep", "label")
            .join(texts.select(F.col("rep").alias("leader_rep"), F.col("codes").alias("a")), "leader_rep")
            .join(texts.select("rep", F.col("codes").alias("b")), "rep")
        )
        roots, new = _merged(roots, compared.mapInPandas(_aligned, "u long, v long"))
        rest = rows.join(first.select("key", F.col("leader_rep").alias("rep")), ["key", "rep"], "left_anti")
        rest = rest.join(new.select(F.col("id").alias("label"), "root"), "label", "left")
        rest = rest.withColumn("label", F.coalesce("root", "label")).drop("root")
        # Texts of one class need no further comparison.
        rows = written(_open(rest), "open")
        if rows.isEmpty():
            return roots
    blocks = _blocks(rows.drop("weight").join(texts, "rep"))
    near = blocks.groupBy("key", "low", "high").applyInPandas(_aligned_blocks, "u long, v long")
    return _merged(roots, near)[0]


def _codes_of(docs: DataFrame, involved: DataFrame) -> DataFrame:
    """``rep, codes`` of the texts in ``involved``; others are dropped before their texts are shuffled."""
    few = involved.select(_bucket("rep").alias("bucket")).distinct()
    texts = docs.select("doc_id", "text").withColumn("bucket", _bucket("doc_id"))
    texts = texts.join(F.broadcast(few), "bucket", "left_semi")
    texts = texts.select(F.col("doc_id").alias("rep"), F.pandas_udf(_codes, "binary")("text").alias("codes"))
    texts = texts.join(involved, "rep", "left_semi")
    return written(texts.groupBy("rep").agg(F.min("codes").alias("codes")), "codes")


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id, copy_of, kept``: ``copy_of`` is the smallest id with the same words.

    ``kept`` marks the documents whose id is the class id, one per class.
    """
    sketched = written(docs.select("doc_id", "text").mapInPandas(_sketch, SKETCHED), "sketches")
    nodes = sketched.groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.first("n_words").alias("n_words"), F.first("sketches").alias("sketches"), F.first("counts").alias("counts")
    )
    nodes = written(nodes, "nodes")
    roots = class_roots(docs, nodes)
    again = sketched.select("doc_id", "node").join(nodes.select("node", "rep"), "node")
    placed = again.join(roots.withColumnRenamed("id", "rep"), "rep", "left")
    return placed.select(
        "doc_id",
        F.coalesce("root", "rep").alias("class_id"),
        F.col("rep").alias("copy_of"),
        F.col("doc_id").eqNullSafe(F.coalesce("root", "rep")).alias("kept"),
    )
