"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerguard.session import fresh_path
from ledgerguard.session import ship_code as ship

#: A null id sorts after every other id and counts as one id.
NULL_ID = (1 << 63) - 1

#: ASCII white space, the only white space that separates words.
ASCII_SPACE = b" \t\n\x0b\x0c\r"

#: Bytes of text that one step of a Python task holds at a time.
STEP_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """``docs`` as (k, text as UTF-8 bytes, columns...): k is doc_id, NULL_ID for null.

    Only named columns are kept, so extra columns of any name do no harm. A
    null text is an empty one.
    """
    text = F.coalesce(docs["text"], F.lit("")).cast("binary")
    return docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID)).alias("k"),
                       text.alias("text"), *[docs[c] for c in columns])


def doc_id(k: str = "k"):
    """The doc_id column that ``keyed`` made ``k`` of."""
    return F.when(F.col(k) != NULL_ID, F.col(k)).alias("doc_id")


def written(df: DataFrame, kind: str) -> DataFrame:
    """``df`` stored as Parquet in the shared folder and read back.

    It cuts the lineage: what follows survives a lost executor without the
    work before it being done again.
    """
    spark = df.sparkSession
    path = fresh_path(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def steps(batches: Iterator[pa.RecordBatch], size: str = "text",
          limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Record batches cut into slices of about ``limit`` bytes of column ``size``, or of bytes that it counts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(size)
        length = np.asarray((column if pa.types.is_integer(column.type) else pc.binary_length(column)).fill_null(0))
        part = np.cumsum(length, dtype=np.int64) // limit
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(int(a), int(b - a))


def arrow_map(df: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str,
              size: str = "text", limit: int = STEP_BYTES) -> DataFrame:
    """``mapInArrow`` of a function of one bounded slice of rows."""
    ship(df.sparkSession)

    def run(batches):
        for batch in steps(batches, size, limit):
            yield step(batch)
    return df.mapInArrow(run, schema)


def key_runs(batches: Iterator[pa.RecordBatch], key: str, rows: int) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows and whole runs of ``key``, from batches sorted by it."""
    held, n = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        whole = pa.Table.from_batches(held).combine_chunks()
        values = np.asarray(whole[key])
        cut = int(np.searchsorted(values, values[-1], "left"))
        if cut:
            yield whole.slice(0, cut)
            held, n = whole.slice(cut).to_batches(), whole.num_rows - cut
        else:  # one run so far; let it double before looking again
            rows = max(rows, 2 * n)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """The SplitMix64 finaliser, a bijection of 64-bit numbers."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def numbered(rows: DataFrame, group: str, order: list[str], number: str,
             block: int = 50_000) -> DataFrame:
    """``rows`` with ``number``: their place from 0 in ``order`` within ``group``.

    ``order[0]`` is a long. No group meets in one task: the range is cut at
    quantiles into blocks of about ``block`` rows (1000 blocks at most, sorted
    with spilling), numbered each for itself and then moved by the count of the
    blocks before. Rows equal in all of
    ``order`` are interchangeable.
    """
    n = rows.count()
    first = order[0]
    cuts = min(1000, max(1, -(-n // block)))
    bounds = []
    if cuts > 1:
        at = [i / cuts for i in range(1, cuts)]
        bounds = sorted(set(rows.agg(F.percentile_approx(first, at, 10 * cuts).alias("q"))
                            .first()["q"] or []))
    col = F.lit(0)
    if bounds:  # binary search by array functions: the number of bounds below the value
        col = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col(first)))
    rows = rows.withColumn("_block", col)
    counts = rows.groupBy(group, "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(group, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(group, "_block").orderBy(*order)
    rows = rows.withColumn("_at", F.row_number().over(inside) - 1)
    return (rows.join(counts, [group, "_block"])
            .withColumn(number, (F.col("_base") + F.col("_at")).cast("long"))
            .drop("_block", "_at", "_base"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (u, v) reaches.

    Alternating large-star and small-star steps; every step is joins and
    partially aggregated minima, and each round is stored in the shared
    folder. Nodes without edges are not returned.
    """
    spark = edges.sparkSession

    def signature(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v") % 1000003), F.lit(0)),
                           F.coalesce(F.sum(F.hash("u", "v").cast("long")), F.lit(0))).first())

    # every edge points from the larger node u to the smaller node v
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                  .distinct(), "edges")
    last = signature(now)
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        # large star: larger neighbours of u go to the least of u and its neighbours
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        # small star: smaller neighbours of u, and u, go to the least of them
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        now = written(small, "edges")
        sign = signature(now)
        if sign == last:
            break
        last = sign
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
