"""SimHash near-duplicates by a Gray-order hierarchical index.

Documents become 64-bit fingerprints; equal fingerprints collapse to their
smallest document before anything else. Two fingerprints with at most three
differing bits agree in one of four 16-bit blocks, so each fingerprint is dealt
once per block to the bucket of that block's value. A task sorts its buckets by
Gray rank, so that neighbours share bit patterns, and builds a tree over each
bucket: an upper node keeps the mask and value of the bits that all its members
share, less what its ancestors already hold. A search adds up the differences
on the way down and leaves a whole group as soon as they pass the limit; at a
leaf the sum is the Hamming distance. A bucket above ``bucket_rows`` is dealt
again by blocks of its other bits, which loses no link.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerguard.llm.common import NULL_ID, arrow_map, components, key_runs, keyed, signed, written

BITS = 64
SEED = 42
FAN = 16


def fingerprint(text: bytes, words_per_shingle: int = 3) -> int:
    """The SimHash of UTF-8 ``text``: a bit is 1 if set in over half the shingles' hashes."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= words_per_shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1)[:len(words) - words_per_shingle + 1]
    n = len(starts)
    stops = ends[words_per_shingle - 1:] - 1
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(line[a:b], SEED) for a, b in zip(starts.tolist(), stops.tolist())])
    count = np.zeros(BITS, np.int64)
    whole = np.frombuffer(hashes, np.uint8).reshape(n, 8)
    for a in range(0, n, 1 << 15):  # bounded memory for very long texts
        count += np.unpackbits(whole[a:a + (1 << 15)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > n).tobytes(), "big")


def fingerprints(docs: DataFrame, words_per_shingle: int = 3) -> DataFrame:
    """(k, r, fp) of ``keyed`` docs with a row hash r; fp is the fingerprint as a signed long."""
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, words_per_shingle) for t in batch.column("text").to_pylist()], np.uint64)
        return pa.record_batch([batch.column("k"), batch.column("r"), pa.array(signed(fps))], ["k", "r", "fp"])
    return arrow_map(docs.select("k", F.xxhash64("k", "text").alias("r"), "text"), step, "k long, r long, fp long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of a 64-bit word in the reflected Gray sequence."""
    x = x.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(shift)
    return x


class GrayIndex:
    """Trees over runs of Gray-sorted fingerprints; ``run`` numbers the run of each entry, ascending."""

    def __init__(self, fps: np.ndarray, run: np.ndarray):
        self.fps, self.run = fps, run
        ones = np.full(len(fps), ~np.uint64(0))
        #: per level, leaves first: first child, one past the last, shared mask, value, run
        self.levels = [(None, None, ones, fps, run)]
        while len(self.levels[-1][4]) and np.any(self.levels[-1][4][1:] == self.levels[-1][4][:-1]):
            _, _, mask, value, run = self.levels[-1]
            n = len(run)
            start = np.r_[True, run[1:] != run[:-1]]
            at = np.arange(n)
            begin = np.maximum.accumulate(np.where(start, at, 0))
            first = np.flatnonzero((at - begin) % FAN == 0)
            stop = np.r_[first[1:], n]
            all_and = np.bitwise_and.reduceat(value, first)
            all_or = np.bitwise_or.reduceat(value, first)
            shared = np.bitwise_and.reduceat(mask, first) & ~(all_and ^ all_or)
            self.levels.append((first, stop, shared, all_and & shared, run[first]))

    def links(self, limit: int, room: int = 1 << 20):
        """Yields (i, j, distance) arrays of all linked entries i < j of the same run."""
        top = len(self.levels) - 1
        if top == 0:
            return
        _, _, _, _, roots = self.levels[top]
        n = len(self.fps)
        root = np.searchsorted(roots, self.run)
        # a query cannot meet more leaves than its run holds; take queries so that room suffices
        size = np.bincount(root, minlength=len(roots))[root].astype(np.int64)
        part = np.cumsum(size) // room
        cuts = np.r_[0, np.flatnonzero(np.diff(part)) + 1, n]
        for a, b in zip(cuts[:-1], cuts[1:]):
            q = np.arange(a, b)
            q = q[size[a:b] > 1]
            node = root[q]
            above = np.zeros(len(q), np.uint64)  # bits that ancestors hold
            mask, value = self.levels[top][2], self.levels[top][3]
            diff = np.bitwise_count((self.fps[q] ^ value[node]) & mask[node]).astype(np.int64)
            for level in range(top, 0, -1):
                keep = diff <= limit
                q, node, diff = q[keep], node[keep], diff[keep]
                first, stop, mask, _, _ = self.levels[level]
                above = mask[node]
                width = stop[node] - first[node]
                off = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
                child = np.repeat(first[node], width) + off
                q, above = np.repeat(q, width), np.repeat(above, width)
                _, _, mask, value, _ = self.levels[level - 1]
                diff = np.repeat(diff, width) + np.bitwise_count((self.fps[q] ^ value[child]) & mask[child] & ~above)
                node = child
            keep = (diff <= limit) & (q < node)
            yield q[keep], node[keep], diff[keep]


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a[i] and b[i] in a forest whose roots are the least members."""
    while len(a):
        while True:
            a2, b2 = parent[a], parent[b]
            if np.array_equal(a2, a) and np.array_equal(b2, b):
                break
            a, b = a2, b2
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def bucket_stars(key: np.ndarray, fps: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (u, v) that connect exactly the fingerprints that links within buckets connect."""
    order = np.lexsort((gray_rank(fps), key))
    key, fps = key[order], fps[order]
    index = GrayIndex(fps, np.cumsum(np.r_[False, key[1:] != key[:-1]]))
    parent = np.arange(len(fps))
    for i, j, _ in index.links(limit):
        unite(parent, i, j)
    while not np.array_equal(parent[parent], parent):
        parent = parent[parent]
    at = np.flatnonzero(parent != np.arange(len(parent)))
    return fps[at], fps[parent[at]]


def _blocks(free: int, parts: int) -> list[int]:
    """Masks of the bits of ``free`` in ``parts`` blocks of about equal size."""
    bits = [b for b in range(BITS) if free >> b & 1]
    cut = [len(bits) * i // parts for i in range(parts + 1)]
    return [sum(1 << b for b in bits[x:y]) for x, y in zip(cut, cut[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def fingerprint_links(fps: DataFrame, limit: int = 3, bucket_rows: int = 200_000, depth: int = 4) -> DataFrame:
    """(u, v): edges that connect the distinct fingerprints ``fp`` within ``limit`` bits.

    The edges are stars, at most one per fingerprint and bucket it is in, not
    all pairs.
    """
    every = (1 << BITS) - 1
    # fixed: the mask of the bits on which the members of a bucket agree
    dealt, masks = fps.select("fp", F.lit(0).cast("long").alias("fixed")), [0]
    edges = None
    for level in range(depth):
        new = F.array(*[F.struct(F.lit(_signed(m)).alias("old"),
                                 F.array(*[F.lit(_signed(m | b)) for b in _blocks(~m & every, limit + 1)]).alias("new"))
                        for m in masks])
        dealt = dealt.select("fp", F.explode(F.filter(new, lambda c: c["old"] == F.col("fixed"))[0]["new"])
                             .alias("fixed"))
        masks = sorted({m | b for m in masks for b in _blocks(~m & every, limit + 1)})
        dealt = dealt.withColumn("key", F.xxhash64("fixed", F.col("fp").bitwiseAND(F.col("fixed"))))
        last = level == depth - 1
        hot = None if last else written(dealt.groupBy("key").count().where(F.col("count") > bucket_rows)
                                        .select("key"), "hot-buckets")
        more = hot is not None and not hot.isEmpty()
        found = _stars(dealt.join(hot, "key", "left_anti") if more else dealt, limit)
        edges = found if edges is None else edges.union(found)
        if not more:
            break
        dealt = written(dealt.join(hot, "key", "left_semi").select("fp", "fixed"), "hot-fingerprints")
    return edges


def _stars(dealt: DataFrame, limit: int) -> DataFrame:
    """Edges within the buckets ``key``; a bucket is whole in one task, and no larger than allowed."""
    def run(batches):
        for rows in key_runs(batches, "key", 1 << 18):
            u, v = bucket_stars(np.asarray(rows["key"]), np.asarray(rows["fp"]).view(np.uint64), limit)
            yield pa.record_batch([pa.array(signed(u)), pa.array(signed(v))], ["u", "v"])
    return (dealt.select("key", "fp").repartition("key").sortWithinPartitions("key")
            .mapInArrow(run, "u long, v long"))


def near_groups(docs: DataFrame, words_per_shingle: int = 3, limit: int = 3, bucket_rows: int = 200_000) -> DataFrame:
    """(k, r, fp, group, component): each row's fingerprint, its group and the least doc_id in it.

    Words are runs of what is not ASCII white space, A-Z lower-cased; a text of
    fewer words than a shingle has one shingle, one without words (or null) the
    fingerprint 0, which links like any other. A null doc_id sorts after all
    others; rows that repeat a doc_id link by their own texts alone. An empty
    table gives an empty result. There are no ties: a component is named by its
    least doc_id.
    """
    fps = written(fingerprints(keyed(docs), words_per_shingle), "simhash")
    nodes = written(fps.groupBy("fp").agg(F.min("k").alias("id")), "simhash-nodes")
    reach = written(components(fingerprint_links(nodes, limit, bucket_rows)), "simhash-reach")
    least = (reach.join(nodes, reach["node"] == nodes["fp"]).groupBy("component")
             .agg(F.min("id").alias("least")))
    named = nodes.join(reach.join(least, "component").withColumnRenamed("node", "fp"), "fp", "left")
    return fps.join(named.select("fp", F.coalesce("component", "fp").alias("group"),
                                 F.coalesce("least", "id").alias("component")), "fp")


def keep_one(docs: DataFrame, words_per_shingle: int = 3, limit: int = 3) -> DataFrame:
    """The rows of ``docs`` of which one stays for each group: that of the least doc_id.

    Of rows equal in id and text one stays; null ids come last, so a group of
    null ids alone keeps one row too.
    """
    one = (near_groups(docs, words_per_shingle, limit).groupBy("group")
           .agg(F.min(F.struct("k", "r")).alias("one")).select(F.col("one.k").alias("_k"), F.col("one.r").alias("_row")))
    text = F.coalesce(docs["text"], F.lit("")).cast("binary")
    rows = docs.withColumn("_k", F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID)))
    rows = rows.withColumn("_row", F.xxhash64("_k", text))
    return rows.join(one, ["_k", "_row"], "left_semi").dropDuplicates(["_k", "_row"]).drop("_k", "_row")
