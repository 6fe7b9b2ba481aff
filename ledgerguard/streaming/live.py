"""Trailing-window travel without waiting for the watermark: alerts in the batch of the second row.

``transformWithState`` keeps, for each shard of the users and bucket of event time
(``BUCKET`` windows wide), what decides the rule and nothing else:

- value state ``context``: first and last time of each (user, slice, country), and
  how many chunks of waiting rows were written;
- map state ``waiting``: chunks of the bucket's rows that nothing had flagged yet, as
  a later arrival of an earlier row may still do so. They are read only if a
  user of several countries got new context;
- one event-time timer at the end of the bucket. No row of it can arrive once
  the watermark has passed that, so the timer empties both.

Calls to the state store cost far more than the values they carry, so a
micro-batch takes a few of them for a shard and bucket, however many users and rows it
has there; the context is read and written whole. Each column of a row is converted
on its way to Python, so a transaction comes as one JSON message and leaves as one.

A row is sent to its own bucket, where it is judged; one of the bucket's last
window is also sent to the next, where it is context only. A busy user's rows are
thus dealt over the buckets, and a row is compared with the slices and countries
of its user there, not with rows.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerguard.config import DEFAULT_CONFIG, ScreeningConfig
from ledgerguard.operators.travel import slicing
from ledgerguard.schema import EVENT_TIME, TRANSACTION_COLUMNS, TRANSACTION_SCHEMA
from ledgerguard.session import ship_code
from ledgerguard.streaming.stateful import with_event_watermark

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Windows in a bucket: wider ones send fewer rows twice, narrower ones deal a busy user out more finely.
BUCKET = 6
#: Shards of the users: fewer ones call the state store less often, more ones deal the newest bucket over more tasks.
SHARDS = 32
#: Rows of a chunk of waiting rows, at most.
CHUNK = 4096
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def decided(t: int, country: str, context: dict[tuple[int, str], tuple[int, int]], window: int) -> bool:
    """Whether ``context`` has another country in ``[t - window, t]``."""
    return any(c != country and last >= t - window and first <= t for (_, c), (first, last) in context.items())


def told(message: str) -> tuple[str, int, str]:
    """(user, event time in microseconds, country) of a message."""
    m = json.loads(message)
    return m["user_id"], m["_t"], m["country"]


class TrailingTravelProcessor(StatefulProcessor):
    """State of one (shard, bucket), whose key is one number; see the module."""

    def __init__(self, window: int, slice_: int, shards: int):
        self.window, self.slice, self.span, self.shards = window, slice_, BUCKET * window, shards

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.context = handle.getValueState("context", "chunks int, user_id array<string>, slice array<long>, "
                                            "country array<string>, first array<long>, last array<long>")
        self.waiting = handle.getMapState("waiting", "chunk int", "messages array<string>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        bucket, chunks, context = key[0] // self.shards, 0, defaultdict(dict)
        state = self.context.get()
        if state is None:
            self.handle.registerTimer((bucket + 1) * self.span // 1000)
        else:
            chunks = state[0]
            for user, slice_, country, first, last in zip(*state[1:]):
                context[user][slice_, country] = first, last
        changed, own = set(), []
        for row in rows:  # of one shard, bucket and micro-batch
            user, t, country = told(row["message"])
            seen, k = context[user], (t // self.slice, country)
            first, last = seen.get(k, (t, t))
            if k not in seen or t < first or t > last:
                seen[k] = min(first, t), max(last, t)
                changed.add(user)
            if t // self.span == bucket:
                own.append((row["message"], user, t, country))
        abroad = {user for user, seen in context.items() if len({c for _, c in seen}) > 1}
        changed &= abroad
        if chunks and changed:
            rest = {}  # of the chunks that lose rows
            for (chunk,), (messages,) in self.waiting.iterator():
                flagged = [user in changed and decided(t, country, context[user], self.window)
                           for user, t, country in map(told, messages)]
                if any(flagged):
                    yield from (Row(message=m) for m, hit in zip(messages, flagged) if hit)
                    rest[chunk] = [m for m, hit in zip(messages, flagged) if not hit]
            for chunk, messages in rest.items():
                if messages:
                    self.waiting.updateValue((chunk,), (messages,))
                else:
                    self.waiting.removeKey((chunk,))
        waits = []
        for message, user, t, country in own:
            if user in abroad and decided(t, country, context[user], self.window):
                yield Row(message=message)
            else:
                waits.append(message)
        for at in range(0, len(waits), CHUNK):
            self.waiting.updateValue((chunks,), (waits[at:at + CHUNK],))
            chunks += 1
        entries = [(user, *k, *v) for user, seen in context.items() for k, v in seen.items()]
        self.context.update((chunks, *map(list, zip(*entries))))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.context.clear()
        self.waiting.clear()
        return iter([])

    def close(self) -> None:
        pass


def live_travel(stream: DataFrame, cfg: ScreeningConfig = DEFAULT_CONFIG, shards: int = SHARDS) -> DataFrame:
    """Rows that trailing travel flags, in the micro-batch in which the second row of the pair arrives (``append``).

    Needs the RocksDB state store: see ``rocksdb``. A checkpoint holds for one number of ``shards``.
    """
    w, k, g = slicing(cfg)
    if k < 2:
        raise ValueError("trailing travel on a stream needs two slices in a window at least")
    ship_code(stream.sparkSession)
    rows = with_event_watermark(stream, cfg).where(
        F.col("user_id").isNotNull() & F.col("country").isNotNull() & F.col(EVENT_TIME).isNotNull())
    t = F.unix_micros(F.col(EVENT_TIME))
    span = BUCKET * w
    bucket = F.floor(t / F.lit(span))
    near_end = t >= (bucket + 1) * F.lit(span) - F.lit(w)
    rows = (rows.withColumn("_t", t)
            .withColumn("_bucket", F.explode(F.when(near_end, F.array(bucket, bucket + 1)).otherwise(F.array(bucket))))
            .select(F.to_json(F.struct(*TRANSACTION_COLUMNS, "_t")).alias("message"), EVENT_TIME,
                    (F.col("_bucket") * shards + F.pmod(F.xxhash64("user_id"), F.lit(shards))).alias("_cell")))
    alerts = rows.groupBy("_cell").transformWithState(
        TrailingTravelProcessor(w, g, shards), "message string", "Append", "EventTime")
    return alerts.select(F.from_json("message", TRANSACTION_SCHEMA).alias("m")).select("m.*")


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, as ``transformWithState`` requires."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)
