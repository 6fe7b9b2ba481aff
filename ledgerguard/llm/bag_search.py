"""Ranked lexical search over classes of equal bags.

A document's score depends on its length and on how often it holds the items'
terms, nothing else. So each document is cut down to its bag: the counts of the
terms that some item has. Documents with the same bag and the same length
measure m form a class, found by hash and told apart by the bags themselves.
Each class is scored once for all items; the documents of the best classes are
then listed by ascending doc_id.
"""

from __future__ import annotations

import math
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerguard.llm.common import arrow_map, ship, written

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

TOP = 50

#: Items are scored in blocks whose (item, term) pairs have about so many bytes; one block is broadcast at a time.
BLOCK_BYTES = 32 << 20

#: (class, item) cells and term occurrences that a task holds at a time.
CELLS = 1 << 21


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, with repeats; A-Z lower-cased."""
    return WORD.findall(text.lower())


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): the different terms of each item; rows that share an item_id are one item."""
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [sorted(set(terms(t))) for t in batch.column("text").to_pylist()]
        at = pa.array(np.repeat(np.arange(len(found)), list(map(len, found))))
        return pa.record_batch([batch.column("item_id").take(at), pa.array([t for x in found for t in x], pa.binary())],
                               ["item_id", "term"])
    rows = items.select(items["item_id"], F.coalesce(items["text"], F.lit("")).cast("binary").alias("text"))
    return arrow_map(rows, step, f"item_id {dict(items.dtypes)['item_id']}, term binary").distinct()


def bags(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(doc_id, n, bag): n terms in all; the bag holds (term number, count) of ``vocabulary``, as uint32, by number."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})
    size = len(vocabulary)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        look, n, ids = shared.value.get, [], []
        for text in batch.column("text").to_pylist():
            found = terms(text)
            n.append(len(found))
            ids.append(np.fromiter(map(look, found, repeat(-1)), np.int64, len(found)))
        row = np.repeat(np.arange(len(n)), n)
        term = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        keys, counts = np.unique((row * size + term)[term >= 0], return_counts=True)
        pairs = np.stack([keys % max(size, 1), counts], axis=1).astype("<u4")
        cuts = np.searchsorted(keys, np.arange(len(n) + 1) * size)
        made = [pairs[a:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        return pa.record_batch([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(made, pa.binary())],
                               ["doc_id", "n", "bag"])
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                       F.coalesce(docs["text"], F.lit("")).cast("binary").alias("text"))
    return arrow_map(rows, step, "doc_id long, n long, bag binary")


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, count) of every pair of a column of bags."""
    found = column.to_pylist()
    pairs = np.frombuffer(b"".join(found), "<u4").reshape(-1, 2).astype(np.int64)
    return np.repeat(np.arange(len(found)), [len(x) // 8 for x in found]), pairs[:, 0], pairs[:, 1]


def document_counts(rows: DataFrame, size: int) -> np.ndarray:
    """In how many rows of ``bags`` each of ``size`` terms occurs; a task sends its own sums."""
    def run(batches):
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(_unpacked(batch.column("bag"))[1], minlength=size)
        held = np.flatnonzero(df)
        yield pa.record_batch([pa.array(held), pa.array(df[held])], ["t", "n"])
    out = np.zeros(size, np.int64)
    for r in rows.select("bag").mapInArrow(run, "t long, n long").groupBy("t").agg(F.sum("n").alias("n")).collect():
        out[r["t"]] = r["n"]
    return out


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))) of each term."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)


class Best:
    """The ``top`` classes of each item so far: by score, then by least doc_id, null ids last."""

    def __init__(self, items: int, top: int):
        self.top, self.least = top, np.ones(items, np.int64)
        self.kept: tuple[np.ndarray, ...] = ()

    def add(self, scores: np.ndarray, first: np.ndarray, null: np.ndarray, *keys: np.ndarray) -> None:
        """``scores`` by class and item; the rest by class."""
        which, item = np.nonzero(scores >= self.least)
        new = (item, scores[which, item], null[which], first[which], *[k[which] for k in keys])
        if not self.kept:
            self.kept = tuple(x[:0] for x in new)
        rows = tuple(map(np.concatenate, zip(self.kept, new)))
        order = np.lexsort((rows[3], rows[2], -rows[1], rows[0]))
        rows = tuple(x[order] for x in rows)
        start = np.searchsorted(rows[0], np.arange(len(self.least)))
        place = np.arange(len(order)) - start[rows[0]]
        full = place == self.top - 1  # an equal score may still win by its doc_id
        self.least[rows[0][full]] = rows[1][full]
        self.kept = tuple(x[place < self.top] for x in rows)


def scored_classes(classes: DataFrame, weight: np.ndarray, holders: list[np.ndarray], items: int, top: int) -> DataFrame:
    """(item, score, first, h, g, m): the best ``top`` classes of each item in each task.

    ``holders``: the items of each term. A class below ``top`` others that come
    first cannot place a document: each of them has one that comes before.
    """
    count = np.array([len(x) for x in holders], np.int64)
    begin = np.r_[0, np.cumsum(count)]
    shared = classes.sparkSession.sparkContext.broadcast(
        (weight, count, begin, np.concatenate(holders) if holders else np.zeros(0, np.int64)))

    def run(batches):
        weight, count, begin, flat = shared.value
        best = Best(items, top)
        for batch in batches:
            row, term, tf = _unpacked(batch.column("bag"))
            cells = np.maximum(np.bincount(row, count[term], batch.num_rows), items)
            part = (np.cumsum(cells) // CELLS).astype(np.int64)
            m = np.asarray(batch.column("m"))
            worth = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[row]))
            null = np.asarray(batch.column("first").is_null())
            first = np.asarray(batch.column("first").fill_null(0))
            h, g = np.asarray(batch.column("h")), np.asarray(batch.column("g"))
            for p in np.unique(part).tolist():
                a, b = np.searchsorted(part, [p, p + 1])
                x, y = np.searchsorted(row, [a, b])
                n = count[term[x:y]]
                at = np.repeat(begin[term[x:y]] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
                scores = np.zeros((b - a) * items, np.int64)
                np.add.at(scores, np.repeat(row[x:y] - a, n) * items + flat[at], np.repeat(worth[x:y], n))
                best.add(scores.reshape(-1, items), first[a:b], null[a:b], h[a:b], g[a:b], m[a:b])
        if best.kept:
            item, score, null, first, h, g, m = best.kept
            yield pa.record_batch([pa.array(item.astype(np.int32)), pa.array(score), pa.array(first, mask=null),
                                   pa.array(h), pa.array(g), pa.array(m)], ["item", "score", "first", "h", "g", "m"])
    return classes.select("h", "g", "m", "bag", "first").mapInArrow(
        run, "item int, score long, first long, h long, g long, m long")


def _block(docs: DataFrame, pairs: list[tuple], top: int) -> DataFrame | None:
    """(item_id, rank, doc_id, score) of the items in ``pairs`` (item_id, term); None without any."""
    vocabulary = sorted({t for _, t in pairs})
    ids = list(dict.fromkeys(i for i, _ in pairs))
    number, place = {t: i for i, t in enumerate(vocabulary)}, {x: i for i, x in enumerate(ids)}
    holders: list[list[int]] = [[] for _ in vocabulary]
    for item, term in pairs:
        holders[number[term]].append(place[item])
    rows = written(bags(docs, vocabulary), "bags")
    total = rows.agg(F.count_if(F.col("n") > 0).alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")).first()
    if not total["L"]:
        return None
    weight = weights(document_counts(rows, len(vocabulary)), total["N"])

    # m is 100 - 50 + 50 n N div L
    keyed = rows.where(F.length("bag") > 0).withColumn(
        "m", F.expr(f"50 + (50 * n * {total['N']}L) div {total['L']}L"))
    keyed = keyed.withColumns({"h": F.xxhash64("bag", "m"), "g": F.xxhash64("m", "bag")})
    # grouped by hash and by the bag itself: equal hashes of different bags stay two classes
    classes = written(keyed.groupBy("h", "g", "m", "bag").agg(F.min("doc_id").alias("first")), "bag-classes")
    found = scored_classes(classes, weight, [np.array(x, np.int64) for x in holders], len(ids), top)
    by_item = Window.partitionBy("item")
    best = found.withColumn("_r", F.row_number().over(
        by_item.orderBy(F.col("score").desc(), F.col("first").asc_nulls_last()))).where(F.col("_r") <= top)
    best = written(best.select("item", "score", "h", "g", "m"), "best-classes")

    key = ["h", "g", "m"]
    chosen = classes.join(best.select(*key).distinct(), key, "left_semi").select(*key, F.col("bag").alias("_bag"))
    members = keyed.join(chosen, key).where(F.col("bag") == F.col("_bag")).select(*key, "doc_id")
    ascending = F.col("doc_id").asc_nulls_last()
    members = members.withColumn("_r", F.row_number().over(Window.partitionBy(*key).orderBy(ascending)))
    members = members.where(F.col("_r") <= top).drop("_r")
    ranked = best.join(members, key).withColumn(
        "rank", F.row_number().over(by_item.orderBy(F.col("score").desc(), ascending))).where(F.col("rank") <= top)
    names = docs.sparkSession.createDataFrame([(i, x) for x, i in place.items()], f"item int, item_id {_kind(ids)}")
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")


def _kind(ids: list) -> str:
    return "string" if any(isinstance(x, str) for x in ids) else "long"


def ranked_documents(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item with a score above 0.

    Equal scores rank by ascending doc_id, null ids last; rows that repeat a
    doc_id are documents of their own. Items that share an item_id are one, and
    so are all whose id is null. Null and empty texts have no terms: such items
    find nothing, such documents are never found nor counted. A very long text
    is one bag. Without terms in ``docs`` or ``items`` the result is empty.
    """
    pairs = written(item_terms(items), "item-terms")
    size = pairs.agg(F.coalesce(F.sum(F.octet_length("term") + 16), F.lit(0)).alias("b")).first()["b"]
    blocks = max(1, -(-size // block_bytes))
    pairs = pairs.withColumn("_block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    out = None
    for b in range(blocks):
        block = pairs.where(F.col("_block") == b).select("item_id", "term").collect()  # block_bytes, about
        part = _block(docs, [(r["item_id"], bytes(r["term"])) for r in block], top) if block else None
        if part is not None:
            out = part if out is None else out.union(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out.withColumn("rank", F.col("rank").cast("int"))
