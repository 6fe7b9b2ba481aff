"""Best-fit packing of token pieces by linear grouping.

Only the histogram of piece lengths, at most ``capacity`` numbers, reaches the
driver. There the plan is made on run-length encoded lengths:

1. lengths above ``capacity * small`` are cut, from the largest, into groups of
   equal cardinality and rounded up to the largest of their group;
2. the configurations of these few sizes are optimised by the configuration
   linear program (column generation, priced by a knapsack), rounded down;
3. actual lengths take the slots of their group;
4. what is left, and the small lengths, go where they fit best, largest first.

The plan says, for each length, which ranks of that length go to which
sequences at which offset; its size depends on the capacity, not on the rows.
Pieces are ranked within their length without any group meeting in one task,
and find their place in the plan by their rank.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerguard.llm.common import NULL_ID, arrow_map, keyed, numbered, written

CAPACITY = 2048
GROUPS = 128
SMALL = 1 / 4

# ---------------------------------------------------------------- tokens

#: Printable ASCII, ASCII white space and the Latin-1 letters: here the
#: tokenizer's normaliser only lower-cases, and its classes are these.
_LATIN = "À-ÖØ-öø-ÿ"
_PLAIN = re.compile(f"[ \t\n\x0b\x0c\r!-~{_LATIN}]*").fullmatch
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LATIN}]+|[0-9]|[^ \t\n\x0b\x0c\ra-z0-9{_LATIN}]+").findall


class WordIds(dict):
    """The ids (uint32, little-endian bytes) of single words, by the tokenizer's model; a bounded cache."""

    MOST = 1 << 19

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenize = tokenizer.model.tokenize
        # the byte-level alphabet of the non-ASCII letters of _LATIN
        self.letters = {c: tokenizer.pre_tokenizer.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)
                        if chr(c).isalpha()}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.MOST:
            self.clear()
        ids = np.array([t.id for t in self.tokenize(word.translate(self.letters))], "<u4").tobytes()
        self[word] = ids
        return ids


_TOKENIZERS: dict[str, tuple] = {}


def encoder(path: str):
    """text -> ids as little-endian uint32 bytes, equal to the tokenizer's without special tokens."""
    if path not in _TOKENIZERS:
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        _TOKENIZERS[path] = (tokenizer, WordIds(tokenizer))
    tokenizer, words = _TOKENIZERS[path]

    def encode(text: str) -> bytes:
        if _PLAIN(text) and "<|" not in text:
            return b"".join(map(words.__getitem__, _WORDS(text.lower())))
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    return encode


PIECES = "k long, piece int, start long, length int, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of each document of ``keyed`` docs: its ids, closed by id 0, cut at ``capacity``.

    ``tokenizer``: a path, or None for the public word_bpe_49k.json as it lies
    on each executor.
    """
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        path = tokenizer
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path("word_bpe_49k.json")
        encode, out = encoder(path), []
        for k, text in zip(batch.column("k").to_pylist(), batch.column("text").to_pylist()):
            ids = encode(text.decode("utf-8", "replace")) + b"\0\0\0\0"
            for i, a in enumerate(range(0, len(ids), 4 * capacity)):
                piece = ids[a:a + 4 * capacity]
                out.append((k, i, a // 4, len(piece) // 4, zlib.crc32(piece)))
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                               ["k", "piece", "start", "length", "ids_crc32"])
    return arrow_map(docs, step, PIECES)


# ---------------------------------------------------------------- plan

def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """An optimal basis of the configuration linear program: (counts per size, how often)."""
    m = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    inverse, x = np.diag(1 / np.diag(basis)), demand / np.diag(basis)
    for _ in range(10 * m):  # a plan needs no last decimals: later rounds gain little
        price = inverse.sum(axis=0)
        # the most valuable configuration: a knapsack, one item more in each round
        best = np.zeros(capacity + 1)
        choice = []
        for _ in range(capacity // int(sizes.min())):
            gain = np.full((m + 1, capacity + 1), -1.0)
            gain[m] = best
            for i, s in enumerate(sizes):
                gain[i, s:] = best[:capacity + 1 - s] + price[i]
            choice.append(gain.argmax(axis=0))
            best = gain.max(axis=0)
        if best[capacity] <= 1 + 1e-9:
            break
        new, room = np.zeros(m), capacity
        for pick in reversed(choice):
            i = pick[room]
            if i < m:
                new[i] += 1
                room -= sizes[i]
        # pivot: the new configuration takes the place of the first that runs out
        step = (inverse * new).sum(axis=1)
        can = step > 1e-9
        ratio = np.where(can, np.maximum(x, 0) / np.where(can, step, 1), np.inf)
        out = int(ratio.argmin())
        basis[:, out] = new
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        x = x - step * ratio[out]
        x[out] = ratio[out]
    x = np.maximum(x, 0)
    return [(basis[:, j].astype(int), x[j]) for j in range(m)]


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS,
         small: float = SMALL) -> list[tuple[list[tuple[int, int]], int]]:
    """Sequences as classes: ([(length, how many in a sequence)...], number of sequences)."""
    lengths = sorted(histogram, reverse=True)
    large = [x for x in lengths if x > capacity * small]
    classes: list[list] = []  # [room, contents, sequences]
    left = {x: histogram[x] for x in lengths}
    total = sum(histogram[x] for x in large)
    if total:
        # equal-cardinality groups: consecutive items of the descending order
        edges = [total * g // groups for g in range(groups + 1)]
        queues, at = [[] for _ in range(groups)], 0
        for x in large:
            n = histogram[x]
            for g in range(groups):
                take = min(at + n, edges[g + 1]) - max(at, edges[g])
                if take > 0:
                    queues[g].append([x, take])
            at += n
        queues = [q for q in queues if q]
        rounded = [q[0][0] for q in queues]
        sizes = sorted(set(rounded), reverse=True)  # groups that round to one size are one
        queue = {s: [run for r, q in zip(rounded, queues) if r == s for run in q] for s in sizes}
        demand = np.array([sum(n for _, n in queue[s]) for s in sizes], float)
        for counts, times in configurations(np.array(sizes), demand, capacity):
            times = int(times + 1e-6)
            if not times:
                continue
            times = min([times] + [sum(n for _, n in queue[s]) // c for s, c in zip(sizes, counts) if c])
            if not times:
                continue
            # each slot takes the next ``times`` items of its group, as runs; the
            # smallest slot stays open, for the largest length that fits the
            # room which actual lengths leave
            slots, open_slot = [], max(i for i, c in enumerate(counts) if c) if counts.sum() > 1 else -1
            for i, (s, c) in enumerate(zip(sizes, counts)):
                for _ in range(c - (i == open_slot)):
                    need, runs = times, []
                    while need:
                        run = queue[s][0]
                        take = min(need, run[1])
                        runs.append((run[0], take))
                        left[run[0]] -= take
                        run[1] -= take
                        need -= take
                        if not run[1]:
                            queue[s].pop(0)
                    slots.append(runs)
            cuts = sorted({c for runs in slots for c in np.cumsum([n for _, n in runs]).tolist()})
            begin = 0
            for end in cuts:
                content = []
                for runs in slots:
                    upto = 0
                    for x, n in runs:
                        upto += n
                        if begin < upto:
                            content.append((x, 1))
                            break
                classes.append([capacity - sum(x for x, _ in content), content, end - begin])
                begin = end
    # best fit, largest first; equal rooms in the order they arose
    rooms: list[list] = [[] for _ in range(capacity + 1)]
    for c in classes:
        rooms[c[0]].append(c)
    for x in lengths:
        n, room = left[x], x
        while n:
            while room <= capacity and not rooms[room]:
                room += 1
            if room > capacity:
                each = capacity // x
                full, rest = divmod(n, each)
                if full:
                    rooms[capacity - each * x].append([capacity - each * x, [(x, each)], full])
                if rest:
                    rooms[capacity - rest * x].append([capacity - rest * x, [(x, rest)], 1])
                break
            kind = rooms[room].pop()
            each = room // x
            full = min(kind[2], n // each)
            if full:
                rooms[room - each * x].append([room - each * x, kind[1] + [(x, each)], full])
            n -= full * each
            spare = kind[2] - full
            if spare and n:  # fewer than ``each`` are left
                rooms[room - n * x].append([room - n * x, kind[1] + [(x, n)], 1])
                n, spare = 0, spare - 1
            if spare:
                rooms[room].append([room, kind[1], spare])
    return [(content, number) for room in rooms for _, content, number in room if number]


def places(classes: list[tuple[list[tuple[int, int]], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, how many in a sequence, offset), sorted."""
    out, ranks, base = [], {}, 0
    for content, number in classes:
        offset = 0
        for x, each in content:
            first = ranks.get(x, 0)
            out.append((x, first, base, each, offset))
            ranks[x] = first + each * number
            offset += x * each
        base += number
    out.sort()
    return np.array(out, np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, groups: int = GROUPS,
         small: float = SMALL) -> DataFrame:
    """Pieces of ``docs`` with (sequence_id, offset): (doc_id, piece, start, length, ids_crc32, ...).

    A null or empty text is the closing id alone. Null ids stay null; rows that
    repeat a doc_id are packed each for itself; equal rows are interchangeable.
    An empty table gives an empty result.
    """
    rows = written(pieces(keyed(docs), tokenizer, capacity), "pieces")
    histogram = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}  # at most ``capacity`` rows
    table = places(plan(histogram, capacity, groups, small))
    ranked = numbered(rows, "length", ["k", "piece", "ids_crc32", "start"], "rank")

    def run(batches):
        # one sorted key for (length, first rank): ranks are below 2^48
        key = (table[:, 0] << 48) + table[:, 1]
        for batch in batches:
            length, rank = np.asarray(batch.column("length")).astype(np.int64), np.asarray(batch.column("rank"))
            row = table[np.searchsorted(key, (length << 48) + rank, "right") - 1]
            into = rank - row[:, 1]
            k = batch.column("k").to_numpy()
            yield pa.record_batch(
                [pa.array(k, mask=k == NULL_ID), *[batch.column(c) for c in ("piece", "start")],
                 pa.array(length), batch.column("ids_crc32"),
                 pa.array(row[:, 2] + into // np.maximum(row[:, 3], 1)),
                 pa.array(row[:, 4] + into % np.maximum(row[:, 3], 1) * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return ranked.select("k", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
