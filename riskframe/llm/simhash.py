"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints are 64-bit SimHashes of word shingles; two link when at most
``max_bits`` bits differ; a component is named by its smallest document id.

The join: with ``max_bits`` differing bits, at least one of ``max_bits + 1`` equal
blocks of a fingerprint is unchanged, so distinct fingerprints go once per block
to the groups (block, value).  A group larger than ``hot`` is dealt again by the
blocks of its remaining bits, as often as that helps, so that no frequent value
keeps its rows in one task.  Inside a group, fingerprints are sorted by Gray rank,
which puts those that differ in few low bits side by side; a tree over the sorted
list keeps in each upper node the mask and pattern of the bits its members share.
Node pairs whose shared bits already differ too often are dropped as a whole; node
pairs that cannot differ by more than ``max_bits`` link as a whole; others go down a
level.  A group returns a spanning forest of its links (not its pairs), and the
components of all forests together are found by ``connected_components``.

Defined results: null text counts as empty; a text without words has fingerprint
zero and links like any other; equal fingerprints always share a component; a null
id cannot name a component unless all of the component's ids are null; repeated
rows stay, each with its result; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm._common import cut, file_backed, located, only_at, pick, ship, table
from riskframe.llm.components import connected_components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Members of a lowest index node, and children of an upper one.
FAN = 16
#: Distinct fingerprints in a group above which it is dealt again by further bits.
HOT = 8_192
#: Node pairs compared at once.
PAIR_BLOCK = 1 << 18
#: Shingle hashes whose bits are counted at once.
HASH_BLOCK = 1 << 16


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of UTF-8 text: A-Z lower-cased, shingles with repeats, XXH64 seed 42,
    a bit is set when set in over half of the hashes."""
    import xxhash

    words = WORD.findall(text.lower())
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    digest, n = xxhash.xxh64_intdigest, len(words) - k + 1
    spans = zip(starts[:n].tolist(), ends[k - 1:].tolist())
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in spans), np.uint64, n)
    count = np.zeros(64, np.int64)
    for at in range(0, n, HASH_BLOCK):
        block = hashes[at:at + HASH_BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(count * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int, text_col: str = "text", fp_col: str = "fp") -> DataFrame:
    """The columns of ``docs`` without the text, and ``fp``: the 64 bits as a signed long."""
    ship(docs.sparkSession)
    rest = [c for c in docs.columns if c != text_col]
    schema = docs.select(*rest).schema.add(fp_col, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint((t.as_py() or "").encode("utf-8"), shingle) for t in batch.column(text_col)]
            signed = pa.array(np.array(fps, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), signed], [*rest, fp_col])

    return docs.mapInArrow(run, schema)


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each 64-bit value in the reflected Gray order."""
    rank = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    return rank


class GrayIndex:
    """Tree over fingerprints in Gray order; ``mask`` and ``pattern`` of a node are the
    bits its members share.  Level 0 holds the fingerprints themselves."""

    def __init__(self, fps: np.ndarray):
        fps = fps[np.argsort(gray_rank(fps), kind="stable")]
        self.patterns, self.masks = [fps], [np.full(len(fps), ~np.uint64(0))]
        while len(self.patterns[-1]) > 1:
            p, m = self.patterns[-1], self.masks[-1]
            at = np.arange(0, len(p), FAN)
            low = np.bitwise_and.reduceat(p | ~m, at)
            high = np.bitwise_or.reduceat(p & m, at)
            mask = np.bitwise_and.reduceat(m, at) & ~(low ^ high)
            self.patterns.append(low & mask)
            self.masks.append(mask)

    def _children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = len(self.patterns[level - 1])
        first = nodes * FAN
        return first, np.minimum(first + FAN, width) - first

    def forest(self, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Links that span every set of fingerprints joined by links of ``max_bits``."""
        fps = self.patterns[0]
        parent = np.arange(len(fps))
        top = len(self.patterns) - 1
        stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        a_out, b_out = [], []
        while stack:
            level, a, b = stack.pop()
            if len(a) > PAIR_BLOCK:
                stack.append((level, a[PAIR_BLOCK:], b[PAIR_BLOCK:]))
                a, b = a[:PAIR_BLOCK], b[:PAIR_BLOCK]
            p, m = self.patterns[level], self.masks[level]
            shared = m[a] & m[b]
            differ = np.bitwise_count((p[a] ^ p[b]) & shared).astype(np.int64)
            keep = differ <= max_bits  # accumulated differences prune whole groups
            a, b, differ, shared = a[keep], b[keep], differ[keep], shared[keep]
            if level == 0:
                new = a != b
                a_out.append(a[new])
                b_out.append(b[new])
                if sum(map(len, a_out)) > PAIR_BLOCK:
                    a_out, b_out, parent = self._merged(a_out, b_out, parent)
                continue
            whole = differ + np.bitwise_count(~shared) <= max_bits  # no members can differ more
            if whole.any():
                span = FAN ** level
                for x, y in zip(a[whole].tolist(), b[whole].tolist()):
                    xs = np.arange(x * span, min((x + 1) * span, len(fps)))
                    ys = np.arange(y * span, min((y + 1) * span, len(fps)))
                    a_out += [xs, ys]
                    b_out += [np.full(len(xs), xs[0]), np.full(len(ys), xs[0])]
                if sum(map(len, a_out)) > PAIR_BLOCK:
                    a_out, b_out, parent = self._merged(a_out, b_out, parent)
                a, b = a[~whole], b[~whole]
            step = max(1, PAIR_BLOCK // (FAN * FAN))
            for at in range(0, len(a), step):
                stack.append((level - 1, *self._pairs_below(level, a[at:at + step], b[at:at + step])))
        _, _, parent = self._merged(a_out, b_out, parent)
        child = np.flatnonzero(parent != np.arange(len(fps)))
        return fps[child], fps[parent[child]]

    def _pairs_below(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a0, na = self._children(level, a)
        b0, nb = self._children(level, b)
        count = na * nb
        pair = np.repeat(np.arange(len(a)), count)
        k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        x, y = a0[pair] + k // nb[pair], b0[pair] + k % nb[pair]
        half = (a[pair] != b[pair]) | (x <= y)  # a node with itself: each pair of children once
        return x[half], y[half]

    @staticmethod
    def _merged(a_out: list, b_out: list, parent: np.ndarray) -> tuple[list, list, np.ndarray]:
        """Fold links into ``parent`` (each member's least connected position)."""
        if a_out:
            a, b = np.concatenate(a_out), np.concatenate(b_out)
            while True:
                x, y = parent[a], parent[b]
                apart = x != y
                if not apart.any():
                    break
                a, b, x, y = a[apart], b[apart], x[apart], y[apart]
                np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
                while True:
                    up = parent[parent]
                    if (up == parent).all():
                        break
                    parent = up
        return [], [], parent


def _block_bits(total: int, blocks: int) -> list[tuple[int, int]]:
    """(shift, width) of ``blocks`` nearly equal blocks over the low ``total`` bits."""
    edge = [total * i // blocks for i in range(blocks + 1)]
    return [(edge[i], edge[i + 1] - edge[i]) for i in range(blocks)]


def _deal(rows: DataFrame, max_bits: int, hot: int) -> DataFrame:
    """(key, fp): groups that together hold every pair within ``max_bits``.

    ``rest`` lists the bits not yet fixed by the key; a hot group is dealt by blocks
    of those, again one more block than differing bits."""
    blocks = max_bits + 1

    def dealt(df: DataFrame, rest: list[int], tag: str) -> list[tuple[DataFrame, list[int]]]:
        out = []
        for i, (at, width) in enumerate(_block_bits(len(rest), blocks)):
            bits = rest[at:at + width]
            mask = sum(1 << b for b in bits)
            mask -= (mask >> 63) << 64
            left = [b for b in rest if b not in bits]
            key = F.concat_ws("/", *(["key"] if tag else []), F.lit(str(i)), F.col("fp").bitwiseAND(F.lit(mask)).cast("string"))
            out.append((df.select(key.alias("key"), "fp"), left))
        return out

    def union(frames: list[DataFrame]) -> DataFrame:
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    parts = dealt(rows, list(range(64)), "")
    all_keys = union([p for p, _ in parts])
    big = cut(all_keys.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > hot).select("key"))
    if big.isEmpty():
        return all_keys
    quiet = all_keys.join(big, "key", "left_anti")
    again = []
    for p, left in parts:  # two levels fix 16 + 12 of 64 bits at 3 differing bits
        again += [f for f, _ in dealt(p.join(big, "key", "left_semi"), left, "next")]
    return union([quiet, *again])


def link_forest(fps: DataFrame, max_bits: int, hot: int = HOT) -> DataFrame:
    """Distinct ``fp`` -> (a, b): spanning links of all groups."""
    spark = fps.sparkSession
    ship(spark)
    groups = _deal(fps.select("fp"), max_bits, hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts = None, []
        for batch in batches:
            keys = np.asarray(batch.column(0).to_pandas())
            values = batch.column(1).to_numpy(zero_copy_only=False)
            if not len(keys):
                continue
            border = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            for x, y in zip([0, *border.tolist()], [*border.tolist(), len(keys)]):
                if keys[x] != key:
                    yield from links(parts)
                    key, parts = keys[x], []
                parts.append(values[x:y])
        yield from links(parts)

    def links(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        members = np.concatenate(parts).view(np.uint64) if parts else np.zeros(0, np.uint64)
        if len(members) == 2:  # most groups
            if np.bitwise_count(members[0] ^ members[1]) <= max_bits:
                yield pa.RecordBatch.from_arrays([pa.array(members[:1].view(np.int64)), pa.array(members[1:].view(np.int64))], ["a", "b"])
        elif len(members) > 2:
            a, b = GrayIndex(members).forest(max_bits)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return groups.repartition(n, "key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def classes(fps: DataFrame, max_bits: int, hot: int = HOT) -> DataFrame:
    """Distinct ``fp`` -> (fp, root): ``root`` is one fingerprint of the component."""
    roots = connected_components(link_forest(fps, max_bits, hot))
    return fps.select("fp").join(roots, fps["fp"] == roots["vertex"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def simhash_components(docs: DataFrame, shingle: int, max_bits: int, id_col: str = "doc_id",
                       text_col: str = "text", hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: id, ``fingerprint`` (16 hex digits),
    ``component_id`` (smallest id reachable, itself included)."""
    rows = cut(fingerprints(pick(docs, id_col, text_col), shingle, text_col))
    # a fingerprint's smallest id is known before linking, so copies never meet as pairs
    distinct = cut(rows.groupBy("fp").agg(F.min(id_col).alias("first_id")))
    named = distinct.join(classes(distinct, max_bits, hot), "fp")
    named = named.join(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select("fp", "component_id")
    out = rows.join(named, "fp")
    return out.select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, shingle: int, max_bits: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each component the row
    with the smallest id (nulls last), the first by locator among repeated rows."""
    docs = file_backed(docs)
    rows = cut(fingerprints(located(pick(docs, id_col, text_col)), shingle, text_col))
    order = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "_path", "_row")
    distinct = cut(rows.groupBy("fp").agg(F.min(order).alias("first")))
    stays = (distinct.join(classes(distinct, max_bits), "fp").groupBy("root").agg(F.min("first").alias("first"))
             .select("first._path", "first._row"))
    return only_at(docs, stays)


#: The query's shingle length and distance are those of its contract.
SHINGLE, MAX_BITS = 3, 3


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"), SHINGLE, MAX_BITS)
