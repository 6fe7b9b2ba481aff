"""Line dedup over levelled sorted runs of line hashes.

The index holds the hashes of all lines seen so far as sorted runs: Parquet
folders, range-free, hash-partitioned and sorted by hash. A batch of documents
merge-anti-joins the runs: a line that a run holds was seen in a smaller
document and goes; the others stay once and form a new run on level 0. When a
level has ``fanout`` runs they are merged into one run of the next level, so
that a batch meets O(fanout * log(batches)) runs.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerguard.llm.common import ASCII_SPACE, NULL_ID, arrow_map, keyed, written
from ledgerguard.session import fresh_path

MIN_KEY = 10

LINES = "h1 long, h2 long, k long, part int"


def line_keys(text: bytes) -> list[bytes | None]:
    """The key of each line of ``text``; None where it is too short to count."""
    keys = [line.strip(ASCII_SPACE) for line in text.lower().split(b"\n")]
    return [key if len(key) >= MIN_KEY and (len(key) >= 4 * MIN_KEY or len(key.decode("utf-8", "replace")) >= MIN_KEY)
            else None for key in keys]


def _hashes(keys) -> np.ndarray:
    """128-bit hashes as an (n, 2) array of signed 64-bit numbers."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), "<i8").reshape(-1, 2)


def line_hashes(docs: DataFrame) -> DataFrame:
    """(h1, h2, k, part): each line key of each document of ``keyed`` docs, once per row.

    ``part`` hashes the row's text: it keeps rows of one doc_id apart.
    """
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, parts, out = [], [], []
        for k, part, text in zip(*(batch.column(c).to_pylist() for c in ("k", "part", "text"))):
            keys = set(line_keys(text)) - {None}
            ids += [k] * len(keys)
            parts += [part] * len(keys)
            out += keys
        h = _hashes(out)
        return pa.record_batch([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(ids, pa.int64()),
                                pa.array(parts, pa.int32())], ["h1", "h2", "k", "part"])
    return arrow_map(docs.select("k", F.hash("text").alias("part"), "text"), step, LINES)


class LineRuns:
    """The levelled index. Its runs live in the shared folder; only their paths are held here."""

    def __init__(self, spark: SparkSession, fanout: int = 2):
        if fanout < 2:
            raise ValueError("fanout is 2 or more")
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[str]] = []

    def runs(self) -> list[DataFrame]:
        return [self.spark.read.schema("h1 long, h2 long, first long").parquet(p)
                for level in self.levels for p in level]

    def _write(self, rows: DataFrame) -> str:
        path = fresh_path(self.spark, "line-run")
        rows.sortWithinPartitions("h1", "h2").write.parquet(path)
        return path

    def add(self, lines: DataFrame) -> None:
        """Add a batch, lines (h1, h2, k) of documents larger than all before."""
        firsts = lines.groupBy("h1", "h2").agg(F.min("k").alias("first"))
        for run in self.runs():  # merge anti join: both sides sorted by hash
            firsts = firsts.join(run.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(self._write(firsts))
        self._compact()

    def _compact(self) -> None:
        for i in range(64):
            if i == len(self.levels) or len(self.levels[i]) < self.fanout:
                return
            read = self.spark.read.schema("h1 long, h2 long, first long")
            merged = reduce(DataFrame.union, [read.parquet(p) for p in self.levels[i]])
            if i + 1 == len(self.levels):
                self.levels.append([])
            self.levels[i + 1].append(self._write(merged.repartition("h1", "h2")))
            self.levels[i] = []

    def all(self) -> DataFrame:
        """(h1, h2, first): every line hash with the smallest document that holds it."""
        return reduce(DataFrame.union, self.runs())


def batch_bounds(docs: DataFrame, batches: int) -> list[int]:
    """Quantiles of k that cut the documents into ``batches`` ascending ranges."""
    at = [i / batches for i in range(1, batches)]
    return sorted(set(docs.agg(F.percentile_approx("k", at, 10_000).alias("q")).first()["q"] or [])) if at else []


def dropped_lines(docs: DataFrame, batches: int = 4, fanout: int = 2) -> DataFrame:
    """(k, part, h1, h2): the line keys that each row of each document loses."""
    spark = docs.sparkSession
    lines = written(line_hashes(docs), "lines")
    bounds = batch_bounds(docs.select("k"), batches)
    index = LineRuns(spark, fanout)
    for low, high in zip([None, *bounds], [*bounds, None]):
        part = lines
        if low is not None:
            part = part.where(F.col("k") >= low)
        if high is not None:
            part = part.where(F.col("k") < high)
        index.add(part)
    return lines.join(index.all(), ["h1", "h2"]).where("k > first").select("k", "part", "h1", "h2")


SCHEMA = "k long, n_lines long, n_dropped long, kept string"


def dedup_lines(docs: DataFrame, *columns: str, batches: int = 4, fanout: int = 2, digest: bool = False) -> DataFrame:
    """``docs`` with the lines dropped that a smaller doc_id holds: (k, n_lines, n_dropped, kept, columns...).

    A line's key is the line without ASCII white space at its ends and with A-Z
    lower-cased; keys of at least 10 code points count. ``kept`` is the text of
    the lines that stay, or its SHA-256 with ``digest``.

    Null or empty texts are one empty line. A null doc_id sorts after all others
    and null ids are one document; rows that repeat a doc_id are one document
    and lose the same keys. An empty table gives an empty result. A line that
    very many documents hold is one row per document in a join that Spark splits
    when skewed, and one row per run.
    """
    rows = keyed(docs, *columns)
    gone = dropped_lines(rows, batches, fanout)
    # a row's own dropped keys: at most its lines, however many rows share the doc_id
    gone = gone.groupBy(F.col("k").alias("_k"), F.col("part").alias("_part")).agg(
        F.collect_set(F.struct("h1", "h2")).alias("_gone"))
    rows = rows.join(gone, (F.col("k") == F.col("_k")) & (F.hash("text") == F.col("_part")), "left").drop("_k", "_part")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_lines, n_dropped, kept = [], [], []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column("_gone").to_pylist()):
            n, dropped = text.count(b"\n") + 1, 0
            if gone:
                drop = {(g["h1"], g["h2"]) for g in gone}
                keys = line_keys(text)
                hashes = iter(map(tuple, _hashes([x for x in keys if x is not None]).tolist()))
                stay = [x is None or next(hashes) not in drop for x in keys]
                text = b"\n".join(line for line, ok in zip(text.split(b"\n"), stay) if ok)
                dropped = n - sum(stay)
            n_lines.append(n)
            n_dropped.append(dropped)
            kept.append(hashlib.sha256(text).hexdigest() if digest else text.decode("utf-8", "replace"))
        made = [batch.column("k"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
                pa.array(kept, pa.string())]
        return pa.record_batch(made + [batch.column(c) for c in columns],
                               ["k", "n_lines", "n_dropped", "kept", *columns])

    types = dict(docs.dtypes)
    return arrow_map(rows, step, ", ".join([SCHEMA, *[f"`{c}` {types[c]}" for c in columns]]))


__all__ = ["LineRuns", "dedup_lines", "dropped_lines", "line_hashes", "line_keys", "NULL_ID"]
