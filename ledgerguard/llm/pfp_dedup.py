"""Suffix-array dedup by prefix-free parsing.

Every byte covered by a string of ``length`` bytes that starts at two or more
places of the corpus goes. The places are found as prefix-free parsing finds
the corpus order of suffixes, in tasks that each hold a slice of it:

1. Parse. A rolling hash of ``width`` bytes marks triggers: a place is one if
   its hash is the least in some window of ``length`` bytes. Phrases lie
   between triggers. The windows that start in a phrase and share their trigger
   form one row: the phrase part before the trigger (head), the text from the
   trigger on (what the parse goes on with). Equal windows have the same
   trigger at the same offset, so only rows with the same trigger string
   (``core``) can meet.
2. Easy phrases. Rows equal as a whole are counted; all their windows repeat.
   Rows whose core occurs once repeat nowhere. Equal rows that follow each other
   in a text, as in a run of one byte or phrase, are one row with their number.
3. Hard phrases: rows that share the core but differ as a whole. Their texts
   meet by core. The suffix array of the dictionary (heads, compared from the
   trigger backwards) and that of the parse (texts from the trigger on), each
   with its common-prefix lengths, combine into the corpus order of the windows
   of each offset: order by head suffix, then by rank in the parse. Windows that
   are neighbours there with a common prefix of ``length`` repeat.

A core with more than ``bucket_rows`` different rows does not meet in one task:
the windows of its rows are hashed one by one and counted with partial
aggregation, to the same result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerguard.llm.common import arrow_map, key_runs, keyed, mix, signed, written

LENGTH = 400
WIDTH = 64
PLACE = 28  # bits of a place within a segment
SEGMENT = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _both_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS[size] = (_powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size))
    up, down = _POWERS[size]
    return up[:n], down[:n]


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit rolling hash of each ``width`` bytes of ``data``."""
    up, down = _both_powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * up, out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * down[:len(data) - width + 1])


def sliding_least(x: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` neighbours, by block prefixes and suffixes."""
    n = len(x)
    blocks = -(-n // size)
    full = np.full(blocks * size, ~np.uint64(0))
    full[:n] = x
    full = full.reshape(blocks, size)
    before = np.minimum.accumulate(full, axis=1).ravel()
    after = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n - size + 1], before[size - 1:n])


def segments(text: bytes, length: int = LENGTH, width: int = WIDTH):
    """Rows of windows that share their trigger, by segment: arrays (core, first start, windows, trigger - first start)."""
    for a in range(0, len(text) - length + 1, SEGMENT):
        data = np.frombuffer(text, np.uint8, min(len(text) - a, SEGMENT + length - 1), a)
        hashes = rolling(data, width)
        place = np.arange(len(hashes), dtype=np.uint64)
        low = np.uint64((1 << PLACE) - 1)
        trigger = (sliding_least((hashes & ~low) | place, length - width + 1) & low).astype(np.int64)
        first = np.r_[0, np.flatnonzero(trigger[1:] != trigger[:-1]) + 1]
        at = trigger[first]
        yield hashes[at], first + a, np.diff(np.r_[first, len(trigger)]), at - first


_NONE = np.zeros(0, np.int64)


def parse(text: bytes, length: int = LENGTH, width: int = WIDTH):
    """``segments`` of the whole text in one."""
    parts = list(segments(text, length, width))
    return tuple(map(np.concatenate, zip(*parts))) if parts else (_NONE.view(np.uint64), _NONE, _NONE, _NONE)


def runs(text: bytes, length: int, core: np.ndarray, start: np.ndarray, n: np.ndarray, offset: np.ndarray):
    """Rows of a segment that follow each other and are equal as a whole: (first of each run, rows in it)."""
    same = np.r_[False, (core[1:] == core[:-1]) & (n[1:] == n[:-1]) & (offset[1:] == offset[:-1])]
    at = np.flatnonzero(same)
    same[at] = [text[a:a + size] == text[b:b + size] for a, b, size in
                zip(start[at - 1].tolist(), start[at].tolist(), (n[at] - 1 + length).tolist())]
    first = np.flatnonzero(~same)
    return first, np.diff(np.r_[first, len(core)])


def phrase_rows(docs: DataFrame, length: int, width: int) -> DataFrame:
    """(core, whole, r, start, windows, offset, times): ``whole`` hashes all the bytes of the row's windows.

    ``times`` such rows, equal as a whole, follow each other from ``start`` on.
    """
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        out, wholes, ids = [], [], []
        for r, text in zip(batch.column("r").to_pylist(), batch.column("text").to_pylist()):
            view = memoryview(text)
            for rows in segments(text, length, width):
                first, times = runs(text, length, *rows)
                core, start, n, offset = (x[first] for x in rows)
                ids += [r] * len(core)
                wholes += [xxhash.xxh3_64_intdigest(view[a:b])
                           for a, b in zip(start.tolist(), (start + n - 1 + length).tolist())]
                out.append((core, start, n, offset, times))
        core, start, n, offset, times = map(np.concatenate, zip(*out)) if out else (*parse(b""), _NONE)
        return pa.record_batch([pa.array(signed(core)), pa.array(signed(np.array(wholes, np.uint64))),
                                pa.array(ids, pa.binary()), pa.array(start.astype(np.int32)),
                                pa.array(n.astype(np.int32)), pa.array(offset.astype(np.int32)),
                                pa.array(times.astype(np.int32))],
                               ["core", "whole", "r", "start", "n", "offset", "times"])
    return arrow_map(docs, step, "core long, whole long, r binary, start int, n int, offset int, times int")


def _adjacent(core: np.ndarray, strings: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of ``strings`` within ``core``, and each one's common prefix with the one before (-1: other core)."""
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    order = np.array(sorted(range(len(strings)), key=lambda i: (core[i], strings[i])), np.int64)
    flat = np.frombuffer(b"".join([strings[i].ljust(size, b"\0") for i in order.tolist()]), np.uint8)
    flat = flat.reshape(len(strings), size)
    same = np.concatenate([flat[1:] == flat[:-1], np.zeros((len(strings) - 1, 1), bool)], axis=1)
    common = np.minimum(np.argmin(same, axis=1), np.minimum(lengths[order][1:], lengths[order][:-1]))
    common[core[order][1:] != core[order][:-1]] = -1
    return order, np.r_[-1, common]


def combine(core: np.ndarray, heads: list[bytes], rights: list[bytes], n: np.ndarray, length: int) -> np.ndarray:
    """repeats[i, h]: whether the window of row i that starts h bytes before the trigger repeats.

    Groups of equal head suffixes (dictionary) and of equal parse texts are
    ranges of the two suffix arrays; a window's class is the pair of its ranges.
    """
    rows, most = len(core), max(map(len, heads))
    offset = np.fromiter(map(len, heads), np.int64, rows)
    head_order, head_common = _adjacent(core, [x[::-1] for x in heads], most + 1)
    parse_order, parse_common = _adjacent(core, rights, length)
    repeats = np.zeros((rows, most + 1), bool)
    head_range, parse_range = np.empty(rows, np.int64), np.empty(rows, np.int64)
    for h in range(most + 1):
        has = np.flatnonzero((h <= offset) & (h > offset - n))
        if len(has) < 2:
            continue
        head_range[head_order] = np.cumsum(head_common < h)
        parse_range[parse_order] = np.cumsum(parse_common < length - h)
        _, which, many = np.unique(head_range[has] * (rows + 1) + parse_range[has], return_inverse=True,
                                   return_counts=True)
        repeats[has, h] = many[which] > 1
    return repeats


def _spans(r: np.ndarray, trigger: np.ndarray, repeats: np.ndarray, length: int):
    """(r, start, stop) of the bytes that runs of repeating windows cover."""
    flags = np.pad(repeats[:, ::-1], ((0, 0), (1, 1)))  # ascending window starts
    edge = np.diff(flags.astype(np.int8), axis=1)
    row, a = np.nonzero(edge == 1)
    _, b = np.nonzero(edge == -1)
    base = trigger[row] - (repeats.shape[1] - 1)
    return r[row], base + a, base + b - 1 + length


def repeated_spans(docs: DataFrame, length: int = LENGTH, width: int = WIDTH,
                   bucket_rows: int = 50_000) -> DataFrame:
    """(r, start, stop): spans, maybe overlapping, that cover what repeats. ``docs``: (r, text bytes)."""
    rows = written(phrase_rows(docs, length, width), "phrases")
    one = F.min(F.struct("r", "start", "n", "offset")).alias("one")
    kinds = written(rows.groupBy("core", "whole").agg(F.sum("times").alias("times"), one)
                    .select("core", "whole", "times", "one.*"), "phrase-kinds")
    easy = rows.join(kinds.where("times > 1").select("core", "whole"), ["core", "whole"], "left_semi")
    spans = easy.select("r", "start", (F.col("start") + F.col("times") * F.col("n") - 1 + length).alias("stop"))

    cores = kinds.groupBy("core").count().where("count > 1")
    hard = kinds.join(cores, "core").select("r", F.struct("core", "start", "n", "offset", (F.col("times") > 1)
                                            .alias("easy"), (F.col("count") > bucket_rows).alias("hot")).alias("row"))
    hard = hard.groupBy("r").agg(F.collect_list("row").alias("rows"))  # at most the phrases of a document
    packed = _packed(docs).join(hard, "r")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        out, unpack = [], zstandard.ZstdDecompressor()
        for r, text, rows in zip(*(batch.column(c).to_pylist() for c in ("r", "packed", "rows"))):
            text = unpack.decompress(text)
            for x in rows:
                at = x["start"] + x["offset"]
                out.append((x["core"], r, x["start"], x["n"], x["easy"], x["hot"],
                            text[x["start"]:at], text[at:x["start"] + x["n"] - 1 + length]))
        kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary(), pa.binary()]
        columns = zip(*out) if out else [[]] * len(kinds)
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)],
                               ["core", "r", "start", "n", "easy", "hot", "head", "right"])
    texts = written(arrow_map(packed, cut, "core long, r binary, start int, n int, easy boolean, hot boolean, "
                              "head binary, right binary", "n_bytes"), "hard-phrases")

    def order(batches):
        for part in key_runs(batches, "core", 1 << 13):
            heads, n = part["head"].to_pylist(), np.asarray(part["n"]).astype(np.int64)
            repeats = combine(np.asarray(part["core"]), heads, part["right"].to_pylist(), n, length)
            repeats[np.asarray(part["easy"])] = False  # theirs are known
            trigger = np.asarray(part["start"]) + np.fromiter(map(len, heads), np.int64, len(heads))
            r, a, b = _spans(np.array(part["r"].to_pylist(), object), trigger, repeats, length)
            yield pa.record_batch([pa.array(r, pa.binary()), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))],
                                  ["r", "start", "stop"])
    cold = (texts.where("not hot").drop("hot").repartition("core").sortWithinPartitions("core")
            .mapInArrow(order, "r binary, start int, stop int"))
    spans = spans.union(cold)

    hot = texts.where("hot")
    if not hot.isEmpty():
        def windows(batch: pa.RecordBatch) -> pa.RecordBatch:
            found, ids, at = [], [], []
            for r, a, n, head, right in zip(*(batch.column(c).to_pylist() for c in ("r", "start", "n", "head", "right"))):
                whole = memoryview(head + right)
                found += [xxhash.xxh3_128_digest(whole[i:i + length]) for i in range(n)]
                ids += [r] * n
                at += range(a, a + n)
            return pa.record_batch([pa.array(found, pa.binary()), pa.array(ids, pa.binary()), pa.array(at, pa.int32())],
                                   ["window", "r", "start"])
        single = arrow_map(hot.select("r", "start", "n", "head", "right"), windows,
                           "window binary, r binary, start int", "right")
        twice = single.groupBy("window").count().where("count > 1").select("window")
        # windows whose starts follow each other are one span, so that a text has few
        place = F.dense_rank().over(Window.partitionBy("r").orderBy("start"))
        found = single.join(twice, "window", "left_semi").select("r", "start", (F.col("start") - place).alias("run"))
        spans = spans.union(found.groupBy("r", "run").agg(F.min("start").alias("start"),
                                                          (F.max("start") + length).alias("stop")).drop("run"))
    return spans


def _row_key():
    """The rows' key ``r``: k and a hash of the text, 16 bytes; rows equal in both are interchangeable."""
    return F.unhex(F.concat(*[F.lpad(F.hex(x), 16, "0") for x in (F.col("k"), F.xxhash64("text"))]))


def _packed(docs: DataFrame, *columns: str) -> DataFrame:
    """``docs`` with the text compressed, for joins that move it.

    What reads it goes in steps of ``n_bytes``, the text's length: packed texts
    of a few MB can be of any size.
    """
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        packer, texts = zstandard.ZstdCompressor(level=3), batch.column("text").to_pylist()
        return pa.record_batch([batch.column("r"), pa.array(map(packer.compress, texts), pa.binary()),
                                pa.array(map(len, texts), pa.int64()), *[batch.column(c) for c in columns]],
                               ["r", "packed", "n_bytes", *columns])
    types = dict(docs.dtypes)
    return arrow_map(docs.select("r", "text", *columns), step,
                     ", ".join(["r binary, packed binary, n_bytes long", *[f"`{c}` {types[c]}" for c in columns]]))


def uncovered(text: bytes, spans: list) -> tuple[bytes, int, int]:
    """(text without the spans, bytes removed, maximal removed runs)."""
    kept, last, removed, runs = [], 0, 0, 0
    for a, b in sorted(spans):
        if a > last or not runs:
            kept.append(text[last:a])
            removed += b - a
            runs += 1
            last = b
        elif b > last:
            removed += b - last
            last = b
    kept.append(text[last:])
    return b"".join(kept), removed, runs


def drop_repeats(docs: DataFrame, *columns: str, length: int = LENGTH, width: int = WIDTH,
                 bucket_rows: int = 50_000, digest: bool = False) -> DataFrame:
    """``docs`` without repeated strings: (k, n_bytes, n_removed, n_spans, kept, columns...).

    ``kept`` is the text that stays (bytes of a code point cut in two go with
    it); with ``digest`` a column ``kept_sha256`` of the remaining bytes follows
    it. All strings are judged on the input; overlaps count; matches never cross
    documents.

    Null texts are empty; texts below ``length`` bytes stay whole. Repeated rows
    repeat each other, so both lose what is long enough, whatever their doc_id;
    null ids are ids like others. An empty table gives an empty result. A run of
    one repeated byte or phrase gives one row for each segment of its text.
    """
    rows = keyed(docs, *columns)
    rows = rows.withColumn("r", _row_key())
    spans = repeated_spans(rows.select("r", "text"), length, width, bucket_rows)
    # a row's own spans; rows equal in id and text share r and their spans
    spans = spans.groupBy("r").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    joined = _packed(rows, "k", *columns).join(spans, "r", "left")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        unpack, out = zstandard.ZstdDecompressor(), []
        for text, spans in zip(batch.column("packed").to_pylist(), batch.column("spans").to_pylist()):
            text = unpack.decompress(text)
            kept, removed, runs = uncovered(text, [(x["start"], x["stop"]) for x in spans or ()])
            out.append((len(text), removed, runs, kept.decode("utf-8", "ignore"),
                        hashlib.sha256(kept).hexdigest() if digest else None))
        made = [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 3 + [pa.string()] * 2)]
        return pa.record_batch([batch.column("k"), *made[:4 + digest], *[batch.column(c) for c in columns]],
                               ["k", "n_bytes", "n_removed", "n_spans", "kept", *hashes, *columns])

    types, hashes = dict(docs.dtypes), ["kept_sha256"] * digest
    return arrow_map(joined, step, ", ".join(["k long, n_bytes long, n_removed long, n_spans long, kept string",
                                              *[f"{c} string" for c in hashes],
                                              *[f"`{c}` {types[c]}" for c in columns]]), "n_bytes")
