"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch holds the k least distinct hashes of a text's word shingles. Sketches
of parts merge into the sketch of the whole, and estimate resemblance,
containment and the number of distinct shingles.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerguard.llm.common import NULL_ID, arrow_map, keyed, ship, steps

SIZE = 128
WORDS = 5


def sketch(text: bytes, size: int = SIZE, words: int = WORDS) -> np.ndarray:
    """The ``size`` least distinct hashes of shingles of ``words`` words, A-Z lower-cased.

    Fewer words are one shingle, none give the empty sketch.
    """
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    line = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    stops = np.cumsum(lengths + 1) - 1
    starts = stops - lengths
    n = max(1, len(found) - words + 1)
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(line[a:b]) for a, b in zip(starts[:n].tolist(), stops[-n:].tolist())])
    hashes = np.frombuffer(hashes, ">u8").astype(np.uint64)
    if n > 8 * size:  # all duplicates of the least hashes are among these
        least = np.unique(np.partition(hashes, 4 * size)[:4 * size + 1])
        if len(least) > size:
            return least[:size]
    return np.unique(hashes)[:size]


def merge(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The sketch of both texts' shingles together."""
    return np.union1d(a, b)[:size]


def resemblance(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Estimated Jaccard likeness of the shingle sets; 1 for two empty ones."""
    both = merge(a, b, size)
    if not len(both):
        return 1.0
    return float(np.isin(both, np.intersect1d(a, b, assume_unique=True)).mean())


def distinct(a: np.ndarray, size: int = SIZE) -> float:
    """Estimated number of distinct shingles; exact below ``size``."""
    if len(a) < size:
        return float(len(a))
    return (size - 1) / ((float(a[-1]) + 1) / 2.0 ** 64)


def containment(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Estimated part of ``a``'s shingles that ``b`` has too; 1 for an empty ``a``."""
    if not len(a):
        return 1.0
    common = resemblance(a, b, size) * distinct(merge(a, b, size), size)
    return min(1.0, common / distinct(a, size))


def encode(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").tobytes()).decode()


def decode(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), ">u8").astype(np.uint64)


def document_sketches(docs: DataFrame, *columns: str, size: int = SIZE, words: int = WORDS) -> DataFrame:
    """(k, fingerprint, columns...) of each row of ``docs``; null texts are empty."""
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [encode(sketch(t, size, words)) for t in batch.column("text").to_pylist()]
        return pa.record_batch([batch.column("k"), pa.array(made, pa.string()), *[batch.column(c) for c in columns]],
                               ["k", "fingerprint", *columns])
    types = dict(docs.dtypes)
    return arrow_map(keyed(docs, *columns), step,
                     ", ".join(["k long, fingerprint string", *[f"`{c}` {types[c]}" for c in columns]]))


def merged_sketches(sketches: DataFrame, group: str, size: int = SIZE, salts: int = 64) -> DataFrame:
    """(group, fingerprint): the sketch of all rows of each group.

    Each group is first cut down to ``size`` hashes in ``salts`` parts, so that
    a hot group is spread and its last task gets salts * size hashes at most.
    """
    def explode(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = [decode(x) for x in batch.column("fingerprint").to_pylist()]
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        at = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        # order-preserving signed form
        return pa.record_batch([batch.column("g").take(pa.array(at)),
                                pa.array((flat ^ np.uint64(1 << 63)).view(np.int64))], ["g", "h"])
    kind = dict(sketches.dtypes)[group]
    rows = arrow_map(sketches.select(F.col(group).alias("g"), "fingerprint"), explode, f"g {kind}, h long", "fingerprint")
    rows = rows.distinct().withColumn("salt", F.pmod(F.xxhash64("h"), F.lit(salts)))
    part = Window.partitionBy("g", "salt").orderBy("h")
    rows = rows.withColumn("n", F.row_number().over(part)).where(F.col("n") <= size)
    rows = rows.groupBy("g").agg(F.slice(F.array_sort(F.collect_list("h")), 1, size).alias("h"))

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [encode(np.array(x, np.int64).view(np.uint64) ^ np.uint64(1 << 63)) for x in batch.column("h").to_pylist()]
        return pa.record_batch([batch.column("g"), pa.array(made, pa.string())], [group, "fingerprint"])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pack(batch)
    return rows.select("g", "h").mapInArrow(run, f"`{group}` {kind}, fingerprint string")


def in_order(docs: DataFrame, rows: int = 2000, most: int = 10_000) -> DataFrame:
    """``keyed`` docs as (part, ghost, k, text): sorted parts, each closed by the row that follows it.

    Parts are ranges of k between quantiles, about ``rows`` documents each but
    ``most`` parts at most (a part is sorted by Spark, with spilling, and read
    as a stream). The first rows of a part come again as ghosts at the end of
    the part before, those of the first part at the end of the last.
    """
    ship(docs.sparkSession)
    n, low = docs.agg(F.count("*"), F.min("k")).first()
    cuts = min(most, n // rows)
    bounds = []
    if cuts > 1:
        at = [i / cuts for i in range(1, cuts)]
        bounds = sorted(set(docs.agg(F.percentile_approx("k", at, 10 * cuts).alias("q")).first()["q"]) - {low})
    bounds = np.array(bounds, np.int64)

    def run(batches):
        for batch in steps(batches):
            k = np.asarray(batch.column("k"))
            part = np.searchsorted(bounds, k, "right")
            first = np.flatnonzero((part > 0) & (bounds[np.maximum(part, 1) - 1] == k) if len(bounds) else k < k)
            wrap = np.flatnonzero(k == low)
            rows = np.r_[np.arange(len(k)), first, wrap]
            parts = np.r_[part, part[first] - 1, np.full(len(wrap), len(bounds))]
            ghost = np.repeat([0, 1, 2], [len(k), len(first), len(wrap)])
            for a in range(0, len(rows), len(k)):
                took = batch.take(pa.array(rows[a:a + len(k)]))
                yield pa.record_batch([pa.array(parts[a:a + len(k)].astype(np.int32)),
                                       pa.array(ghost[a:a + len(k)].astype(np.int32)), took.column("k"),
                                       took.column("text")], ["part", "ghost", "k", "text"])
    return (docs.mapInArrow(run, "part int, ghost int, k long, text binary")
            .repartition("part").sortWithinPartitions("part", "ghost", "k", "text"))


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, n_distinct double")


def edited_fingerprints(docs: DataFrame, size: int = SIZE, words: int = WORDS) -> DataFrame:
    """Fingerprints of each document and its edited text, and their likenesses.

    Edited: the last half (rounded down) of the code points replaced by as many
    first ones (or all) of the next document by doc_id; the first follows the
    last. Null texts are empty; null ids come last; rows that repeat a doc_id
    follow each other by text. A single document follows itself; an empty table
    gives an empty result.
    """
    def row(k: int, text: bytes, own: np.ndarray, after: bytes, following: np.ndarray) -> tuple:
        chars = text.decode("utf-8", "replace")
        half = len(chars) // 2
        # the first ``half`` code points lie in the first 4 * half bytes
        edited = (chars[:len(chars) - half] + after[:4 * half].decode("utf-8", "ignore")[:half]).encode()
        new = sketch(edited, size, words)
        return (None if k == NULL_ID else k, len(chars), hashlib.sha256(edited).hexdigest(), encode(own), encode(new),
                resemblance(own, new, size), resemblance(own, following, size), distinct(own, size))

    def run(batches):
        held = None
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.float64()]
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for batch in steps(batches):
            out = []
            for part, ghost, k, text in zip(*(batch.column(c).to_pylist() for c in ("part", "ghost", "k", "text"))):
                if ghost and held and (held[0] != part or held[1]):
                    continue  # a further ghost of the same part
                own = sketch(text, size, words)
                if held and held[0] == part and not held[1]:
                    out.append(row(*held[2:], text, own))
                held = (part, ghost, k, text, own)
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
    return in_order(keyed(docs), 2000).mapInArrow(run, SCHEMA)
