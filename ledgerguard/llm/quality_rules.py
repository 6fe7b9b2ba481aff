"""Quality rules by compression bands.

A text is kept if it passes the base rules (enough words, few repeated word
windows) and its zstandard ratios (compressed bytes / bytes) lie in bands: the
whole text in the band of its length, every chunk in the band of its size. Chunks of
each size lie side by side from the start, and one more at the very end, so that
every byte of a text lies in a judged chunk, the text itself if it is shorter
than the smallest chunk. A ratio below its band tells repetitive text, one above it incompressible text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from ledgerguard.llm.common import NULL_ID, arrow_map, keyed, ship, steps

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class Bands:
    """Limits: (bytes up to, lowest ratio, highest ratio), the last open-ended.

    Short texts compress badly (frame header, no history) and long ones better,
    so the band moves down with the length. ``chunks``: (bytes, lowest ratio,
    highest ratio) of the chunks of each size that a text is long enough for.
    The upper limits lie below base64 at each length (0.844 at 512 bytes, 0.798
    at 1024, 0.774 at 2048, 0.764 at 4000) and above prose; the densest script,
    Han characters drawn at random by Zipf's law, has 0.836, 0.762, 0.701, 0.667.
    """
    whole: tuple = ((128, 0.35, 1.08), (256, 0.35, 0.94), (512, 0.34, 0.84), (640, 0.34, 0.825), (768, 0.34, 0.81),
                    (1024, 0.34, 0.79), (2048, 0.33, 0.76), (4096, 0.33, 0.73), (16384, 0.30, 0.73),
                    (65536, 0.27, 0.70), (None, 0.24, 0.70))
    chunks: tuple = ((512, 0.33, 0.84), (1024, 0.33, 0.785), (2048, 0.33, 0.73))
    level: int = 3
    min_words: int = 20
    max_repeat_percent: int = 30


def repeated_words(ids: np.ndarray, n_ids: int) -> int:
    """Words in 8-word windows found twice or more; ``ids`` numbers equal words equally.

    Windows of 1, 2, 4 and 8 words get exact ranks by doubling.
    """
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    rank, base = ids.astype(np.int64), n_ids
    for width in (1, 2, 4):
        pair = rank[:-width] * base + rank[width:]
        values, rank = np.unique(pair, return_inverse=True)
        base = len(values)
    if base == n:
        return 0
    seen = np.bincount(rank, minlength=base)[rank] > 1
    edge = np.zeros(len(ids) + 1, np.int32)
    at = np.flatnonzero(seen)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base_measures(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of UTF-8 bytes."""
    words = text.split()  # bytes.split() knows ASCII white space alone
    n = len(words)
    follow = len(text.translate(None, _NOT_FOLLOW))  # continuation bytes are no code points
    chars = len(text.translate(None, SPACE)) - follow
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = text.split(b"\n")
    dup = 0
    if len(set(lines)) < len(lines):
        full = [x for x in lines if x.strip(SPACE)]
        dup = len(full) - len(set(full))
    repeat = 0
    if n > WINDOW:
        number: dict[bytes, int] = {}
        ids = [number.setdefault(w, len(number)) for w in words]
        repeat = repeated_words(np.asarray(ids), len(number)) if len(number) < n else 0
    return n, chars, symbols, dup, repeat


_NOT_FOLLOW = bytes(b for b in range(256) if not 0x80 <= b < 0xC0)


def band_verdict(text: bytes, bands: Bands, packer) -> tuple[float, float, float, bool]:
    """(whole ratio, lowest and highest chunk ratio, inside all bands)."""
    if not text:
        return 0.0, 0.0, 0.0, False
    whole = len(packer.compress(text)) / len(text)
    low, high = next((lo, hi) for top, lo, hi in bands.whole if top is None or len(text) <= top)
    ok = low <= whole <= high
    ratios = []
    for size, low, high in bands.chunks:
        if len(text) >= size:
            starts = {*range(0, len(text) - size + 1, size), len(text) - size}
            some = [len(packer.compress(text[a:a + size])) / size for a in starts]
            ok = ok and low <= min(some) and max(some) <= high
            ratios += some
    least, most = min(ratios, default=whole), max(ratios, default=whole)
    return whole, least, most, ok


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "whole_ratio double, least_chunk_ratio double, most_chunk_ratio double, base_failed boolean, kept boolean")


def keep_good(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they are; one narrow pass."""
    ship(docs.sparkSession)

    def run(batches):
        packer = zstandard.ZstdCompressor(level=bands.level)
        for batch in steps(batches):
            good = []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                n, _, _, _, repeat = base_measures(text or b"")
                good.append(n >= bands.min_words and 100 * repeat <= bands.max_repeat_percent * n
                            and band_verdict(text, bands, packer)[3])
            yield batch.filter(pa.array(good, pa.bool_()))
    return docs.mapInArrow(run, docs.schema)


def quality_rules(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """Measures and verdict of every row of ``docs`` (doc_id, text; more columns are ignored).

    One narrow pass, no shuffle; a text is judged by itself, so copies get the
    same verdict. Null or empty texts have no words, fail the base rules and
    are not kept. Null ids stay null, repeated rows give repeated results, an
    empty table gives an empty result.
    """
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        packer = zstandard.ZstdCompressor(level=bands.level)
        out = []
        for text in batch.column("text").to_pylist():
            n, chars, symbols, dup, repeat = base_measures(text)
            whole, least, most, ok = band_verdict(text, bands, packer)
            failed = n < bands.min_words or 100 * repeat > bands.max_repeat_percent * n
            out.append((n, chars, symbols, dup, repeat, whole, least, most, failed, ok and not failed))
        ids = batch.column("k").to_numpy()
        kinds = [pa.int64()] * 5 + [pa.float64()] * 3 + [pa.bool_()] * 2
        return pa.record_batch([pa.array(ids, mask=ids == NULL_ID), *map(pa.array, zip(*out), kinds)],
                               [c.split()[0] for c in SCHEMA.split(", ")])

    return arrow_map(keyed(docs), step, SCHEMA)
