"""Vector codes: product codebooks trained by integer k-means, assigned with LAESA pivots.

Vectors become integers, floor(4096 x), and are cut into equal parts; each part
position has a codebook of its own. The distances of every part to a few fixed
pivots are computed once and stored with the vectors. In each round the
distances from the pivots to the present entries bound every part-entry distance
from below, by the triangle inequality: entries are tried in the order of their
bounds, and one whose bound passes the least distance found is never evaluated.
What is evaluated is exact, in 64-bit integers; bounds only decide what is not.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerguard.llm.common import ship, written

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
PIVOTS = 4

#: Vectors that a task holds at a time.
SLICE = 4096


def farthest(points: np.ndarray, n: int) -> np.ndarray:
    """``n`` of ``points`` (at most all): the first, then each the farthest from those before."""
    chosen, best = [0], ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(points)):
        chosen.append(int(np.argmax(best)))
        best = np.minimum(best, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distance of each point to each pivot, of exact integer squares."""
    squares = np.stack([((points - p) ** 2).sum(axis=1) for p in pivots], axis=1)
    return np.sqrt(squares.astype(np.float64))


def nearest(points: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray):
    """(entry, squared distance, exact evaluations) of the nearest entry of each point; ties to the lower index.

    ``to_pivots``: the points' distances to ``pivots``.
    """
    rows, n = len(points), len(entries)
    entry_pivots = distances(entries, pivots)
    bound = np.zeros((rows, n))
    for p in range(len(pivots)):
        a, b = to_pivots[:, p, None], entry_pivots[None, :, p]
        # the roots are off by some 2**-53 of themselves at most
        np.maximum(bound, np.abs(a - b) - 1e-12 * (a + b), out=bound)
    bound *= bound * (1 - 1e-12)  # now of the square, still a lower bound
    order = np.argsort(bound, axis=1, kind="stable")
    best, which = np.full(rows, np.iinfo(np.int64).max), np.full(rows, n)
    left, evaluated = np.arange(rows), 0
    for k in range(n):
        entry = order[left, k]
        # an entry that ties may still win by its index
        left = left[bound[left, entry] <= best[left]]
        if not len(left):
            break
        entry = order[left, k]
        square = ((points[left] - entries[entry]) ** 2).sum(axis=1)
        evaluated += len(left)
        better = (square < best[left]) | ((square == best[left]) & (entry < which[left]))
        best[left[better]], which[left[better]] = square[better], entry[better]
    return which, best, evaluated


def reach(dim: int) -> int:
    """Greatest integer component whose squared distances over ``dim`` of them fit 64 bits."""
    return (1 << ((62 - int(dim).bit_length()) // 2 - 1)) - 1


def integer_vectors(vectors: DataFrame, dim: int, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v): vectors of ``dim`` finite components as int64 bytes; all others go."""
    ship(vectors.sparkSession)
    most = reach(dim)

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE):
                rows = batch.slice(a, SLICE)
                column = rows.column("x")
                sized = pc.equal(pc.list_value_length(column), dim).fill_null(False)
                rows, column = rows.filter(sized), column.filter(sized)
                if not rows.num_rows:
                    continue
                flat = column.flatten()
                x = np.asarray(flat.cast(pa.float64()).fill_null(float("nan"))).reshape(-1, dim)
                good = np.isfinite(x).all(axis=1)
                v = np.floor(np.clip(x[good] * scale, -float(most), float(most))).astype(np.int64)
                kept = rows.filter(pa.array(good))
                yield pa.record_batch([kept.column("vec_id"), kept.column("label"),
                                       pa.array([r.tobytes() for r in v], pa.binary())], ["vec_id", "label", "v"])
    label = vectors.schema["label"].dataType.simpleString()
    return (vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["label"].alias("label"),
                           vectors["embedding"].cast("array<double>").alias("x"))
            .mapInArrow(run, f"vec_id long, label {label}, v binary"))


def usable_dimension(vectors: DataFrame, parts: int = PARTS) -> int | None:
    """Length of the usable vector of the smallest vec_id (ties: the shortest), None if there is none.

    Usable: not empty, cut into equal parts, no null and no non-finite component.
    """
    x = vectors["embedding"].cast("array<double>")
    # infinities and NaN are the values that x - x does not bring to 0
    good = F.forall(x, lambda e: e.isNotNull() & F.equal_null(e - e, F.lit(0.0)))
    rows = vectors.where((F.size(x) > 0) & (F.size(x) % parts == 0) & good)
    first = (rows.select(vectors["vec_id"].cast("long").alias("vec_id"), F.size(x).alias("n"))
             .orderBy(F.col("vec_id").asc_nulls_last(), "n").first())
    return first["n"] if first else None


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, dim)


def _slices(batches):
    for batch in batches:
        for a in range(0, batch.num_rows, SLICE):
            if rows := batch.slice(a, SLICE):
                yield rows


def with_pivot_distances(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``rows`` with ``d``: float64 bytes of each part's distances to its position's pivots (part, pivot, position)."""
    parts, n, width = pivots.shape

    def run(batches):
        for batch in _slices(batches):
            v = _matrix(batch.column("v"), parts * width).reshape(-1, parts, width)
            d = np.stack([distances(v[:, p], pivots[p]) for p in range(parts)], axis=1)
            yield pa.record_batch([*batch.columns, pa.array([r.tobytes() for r in d], pa.binary())],
                                  [*batch.schema.names, "d"])
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{kinds}, d binary")


def _assigned(batch: pa.RecordBatch, books: np.ndarray, pivots: np.ndarray):
    """(v, entries, squared distances) by row and part."""
    parts, n, width = pivots.shape
    v = _matrix(batch.column("v"), parts * width).reshape(-1, parts, width)
    d = np.frombuffer(b"".join(batch.column("d").to_pylist()), np.float64).reshape(-1, parts, n)
    found = [nearest(v[:, p], d[:, p], books[p], pivots[p])[:2] for p in range(parts)]
    return v, np.stack([x[0] for x in found], axis=1), np.stack([x[1] for x in found], axis=1)


def updated(rows: DataFrame, books: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The codebooks after one round: each entry the floored mean of its parts, unused ones unchanged.

    A task sums its own parts; what reaches the driver is one sum for each entry.
    """
    parts, entries, width = books.shape

    def run(batches):
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in _slices(batches):
            v, which, _ = _assigned(batch, books, pivots)
            for p in range(parts):
                np.add.at(sums[p], which[:, p], v[:, p])
                counts[p] += np.bincount(which[:, p], minlength=entries)
        p, e = np.nonzero(counts)
        yield pa.record_batch([pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(counts[p, e]),
                               pa.array(list(sums[p, e]), pa.list_(pa.int64()))], ["p", "e", "n", "s"])
    part = rows.mapInArrow(run, "p int, e int, n long, s array<bigint>")
    # decimals: the sums of a task fit 64 bits, those of all tasks need not
    sums = [F.sum(F.get("s", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    books = books.copy()
    for r in part.groupBy("p", "e").agg(F.sum("n").alias("n"), *sums).collect():
        books[r["p"], r["e"]] = [int(r[f"s{i}"]) // r["n"] for i in range(width)]
    return books


def trained(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
            scale: int = SCALE, n_pivots: int = PIVOTS):
    """(vectors as integers with pivot distances, codebooks, pivots); None without a usable vector.

    Codebooks start as the parts of the first ``entries`` vectors by vec_id
    (repeated ids by their integers; null ids last). Pivots are chosen among
    these for their mutual distance and never move.
    """
    dim = usable_dimension(vectors, parts)
    if dim is None:
        return None
    rows = written(integer_vectors(vectors, dim, scale), "integer-vectors")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    books = np.stack([np.frombuffer(r["v"], np.int64).reshape(parts, -1) for r in first], axis=1)
    pivots = np.stack([farthest(books[p], n_pivots) for p in range(parts)])
    rows = written(with_pivot_distances(rows, pivots), "pivot-distances")
    for _ in range(rounds):
        books = updated(rows, books, pivots)
    return rows, books, pivots


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
               scale: int = SCALE, n_pivots: int = PIVOTS) -> tuple[DataFrame, np.ndarray | None]:
    """((vec_id, label, code, error) of each usable vector, codebooks by part, entry and position).

    ``code``: one byte for each part; ``error``: the summed squared distances.
    Dropped: null vectors, those with null or non-finite components, empty ones
    and those that cannot be cut into ``parts`` equal parts or whose length is
    not that of the first. Components so large that squared distances would pass
    64 bits (2**26 at 64 dimensions) count as the largest that do not. Repeated
    rows and ids are rows like others, null ids sort last, fewer vectors than
    ``entries`` make smaller codebooks; without usable vectors the result is
    empty and the codebooks are None.
    """
    made = trained(vectors, parts, entries, rounds, scale, n_pivots)
    label = vectors.schema["label"].dataType.simpleString()
    schema = f"vec_id long, label {label}, code binary, error long"
    if made is None:
        return vectors.sparkSession.createDataFrame([], schema), None
    rows, books, pivots = made

    def run(batches):
        for batch in _slices(batches):
            _, which, square = _assigned(batch, books, pivots)
            yield pa.record_batch([batch.column("vec_id"), batch.column("label"),
                                   pa.array([r.tobytes() for r in which.astype(np.uint8)], pa.binary()),
                                   pa.array(square.sum(axis=1))], ["vec_id", "label", "code", "error"])
    return rows.mapInArrow(run, schema), books


def codebook_digest(books: np.ndarray) -> str:
    """SHA-256 of all integer components, comma-joined, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def coded_vectors(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code in hex, error, label_error, codebooks_sha256) of each usable vector."""
    rows, books = compressed(vectors, parts, entries, rounds)
    if books is None:
        return rows.select("vec_id", F.hex("code").alias("code"), "error", F.col("error").alias("label_error"),
                           F.lit("").alias("codebooks_sha256"))
    rows = written(rows, "codes")
    sums = rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return rows.join(sums, rows["label"].eqNullSafe(sums["_label"])).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(codebook_digest(books)).alias("codebooks_sha256"))
