"""One commit for all that a batch writes.

Files of a table lie in folders ``attempt=<a>`` (lakes: ``date=<d>/attempt=<a>``).
An attempt is one try of one batch of one writer. Nothing of it counts until its
marker, a small file in ``commits/`` beside the tables, says so, and the marker
is written last: alerts, lakes, quarantine and metrics of a batch appear at
once. A batch that runs again writes another attempt, and its marker takes the
place of the batch's former one, so readers see the old rows or the new ones.

``compact_days`` rewrites days of a lake into few files. A marker for each day
makes the new attempt visible and the old ones of that day invisible in one
step; ``vacuum`` later deletes what no marker shows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerguard.session import delete_path, glob_exists, path_exists

#: Readers filter by a list up to this many attempts, so that only their folders are scanned, and by a join beyond.
LISTED = 1000

#: The folder name of rows without a date.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"

#: In place of a day, for tables without dates: all of it.
WHOLE = "whole"

#: Size of the files of a compacted day.
FILE_BYTES = 256 << 20


def commit_root(path: str) -> str:
    """The marker folder of the table at ``path``: beside it."""
    return f"{path.rstrip('/').rsplit('/', 1)[0]}/commits"


def new_attempt() -> str:
    return uuid.uuid4().hex


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def _put(spark: SparkSession, path: str, content: dict) -> None:
    """``content`` as a JSON file, there whole or not at all: written aside, then renamed over ``path``."""
    jpath, fs = _fs(spark, path)
    fs.mkdirs(jpath.getParent())
    aside, _ = _fs(spark, f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    out.write((json.dumps(content) + "\n").encode())
    out.close()
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    array = spark._sc._gateway.new_array(options, 1)
    array[0] = options.OVERWRITE
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    files.rename(aside, jpath, array)


def commit(spark: SparkSession, root: str, run_id: str, batch_id: int, attempt: str) -> None:
    """Make ``attempt`` the visible one of batch ``batch_id`` of ``run_id``."""
    _put(spark, f"{root}/batches/{run_id}-{int(batch_id)}.json",
         {"run_id": run_id, "batch_id": int(batch_id), "attempt": attempt})


@dataclass(frozen=True)
class Visible:
    """What markers show of one table: attempts, and those that a compaction has replaced, by date."""

    attempts: frozenset[str]
    compacted: dict[str, str]  # date: its compacted attempt
    replaced: dict[str, frozenset[str]]

    def of(self, rows: DataFrame) -> DataFrame:
        """The visible ones of a table's ``rows`` (which have ``attempt``), without that column."""
        spark, names = rows.sparkSession, sorted(self.attempts | set(self.compacted.values()))
        if len(names) <= LISTED:
            rows = rows.where(F.col("attempt").isin(names) if names else F.lit(False))
        else:
            rows = rows.join(spark.createDataFrame([(a,) for a in names], "attempt string"), "attempt", "left_semi")
        gone = [(d, a) for d, found in self.replaced.items() for a in sorted(found)]
        if gone and "date" not in rows.columns:
            gone = spark.createDataFrame(gone, "_date string, attempt string")
            rows = rows.join(gone.select("attempt"), "attempt", "left_anti")
        elif gone:
            gone = spark.createDataFrame(gone, "_date string, _attempt string")
            rows = rows.join(gone, (F.coalesce(F.col("date").cast("string"), F.lit(NO_DATE)) == F.col("_date"))
                             & (F.col("attempt") == F.col("_attempt")), "left_anti")
        return rows.drop("attempt")

    def on(self, day: str, attempt: str) -> bool:
        """Whether ``attempt`` is visible on ``day``."""
        return attempt == self.compacted.get(day) or (attempt in self.attempts and attempt not in self.replaced.get(day, ()))


def _marker_name(day: str) -> str:
    """File name of a day's marker; readers skip names that begin with an underscore."""
    return f"{day.strip('_')}.json"


def _markers(spark: SparkSession, folder: str, day: str | None = None) -> list[dict]:
    pattern = f"{folder}/{_marker_name(day) if day else '*.json'}"
    if not glob_exists(spark, pattern):
        return []
    # one line each; the markers of batches that no compaction has taken in yet, and one for each compacted day
    return [json.loads(r["value"]) for r in spark.read.text(pattern).collect()]


def visible(spark: SparkSession, path: str, day: str | None = None) -> Visible | None:
    """What is visible of the table at ``path``, read now; None if nothing was ever committed there.

    Read before the table's files are listed: what is visible then has its files.
    """
    root, name = commit_root(path), path.rstrip("/").rsplit("/", 1)[1]
    if not path_exists(spark, root):
        return None
    days = _markers(spark, f"{root}/days/{name}", day)
    return Visible(frozenset(m["attempt"] for m in _markers(spark, f"{root}/batches")),
                   {m["date"]: m["attempt"] for m in days}, {m["date"]: frozenset(m["replaces"]) for m in days})


def visible_days(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The visible attempts of each day of a lake, from one listing of its folders."""
    seen, out = visible(spark, path), {}
    if seen is None:
        return out
    pattern, fs = _fs(spark, f"{path}/date=*/attempt=*")
    for status in fs.globStatus(pattern) or []:
        day, attempt = (p.split("=", 1)[1] for p in status.getPath().toString().rsplit("/", 2)[1:])
        if seen.on(day, attempt):
            out.setdefault(day, []).append(attempt)
    return {day: sorted(found) for day, found in sorted(out.items())}


def read_days(spark: SparkSession, path: str, days: dict[str, list[str]], schema: StructType) -> DataFrame:
    """The rows of some days' attempts (as ``visible_days`` gives them): those folders alone are listed and read."""
    folders = [f"{path}/date={day}/attempt={a}" for day, found in days.items() for a in found]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def commit_day(spark: SparkSession, path: str, day: str, attempt: str, **more) -> None:
    """Make ``attempt`` the one that shows ``day`` of the table at ``path``; its batches' own attempts still show."""
    _put(spark, f"{commit_root(path)}/days/{path.rstrip('/').rsplit('/', 1)[1]}/{_marker_name(day)}",
         {"date": day, "attempt": attempt, "replaces": [], **more})


def day_markers(spark: SparkSession, path: str) -> dict[str, dict]:
    """The day markers of a table, as written."""
    return {m["date"]: m for m in _markers(spark, f"{commit_root(path)}/days/{path.rstrip('/').rsplit('/', 1)[1]}")}


def _folder_bytes(spark: SparkSession, folder: str) -> int:
    jpath, fs = _fs(spark, folder)
    return int(fs.getContentSummary(jpath).getLength())


def _attempts_of(spark: SparkSession, folder: str) -> list[str]:
    """Attempts with a folder below ``folder``."""
    jpath, fs = _fs(spark, folder)
    if not fs.exists(jpath):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(jpath) if s.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith("attempt="))


def compact_days(spark: SparkSession, path: str, days: list[str], file_bytes: int = FILE_BYTES) -> dict[str, int]:
    """Rewrite closed days ('yyyy-MM-dd') of the lake at ``path`` into files of about ``file_bytes``, in one job.

    Readers see the same rows before, meanwhile and after; each day changes over
    by a marker of its own. Batches that commit meanwhile or later stay beside
    the new files until the day is compacted again. Returns the number of files
    of each day that was rewritten.
    """
    seen = visible(spark, path)
    if seen is None:
        return {}
    taken, files = {}, {}
    for day in days:
        folder = f"{path}/date={day}"
        found = [a for a in _attempts_of(spark, folder) if seen.on(day, a)]
        if found and found != [seen.compacted.get(day)]:
            taken[day] = found
            size = sum(_folder_bytes(spark, f"{folder}/attempt={a}") for a in found)
            files[day] = max(1, -(-size // file_bytes))
    if not taken:
        return {}
    attempt = new_attempt()
    rows = spark.read.option("basePath", path).parquet(
        *[f"{path}/date={day}/attempt={a}" for day, found in taken.items() for a in found]).drop("attempt")
    # a day's rows are dealt over as many parts as it gets files
    day = F.coalesce(F.col("date").cast("string"), F.lit(NO_DATE))
    parts = F.coalesce(F.create_map(*[F.lit(x) for kv in files.items() for x in kv])[day], F.lit(1))
    rows = rows.withColumn("_part", F.pmod(F.xxhash64(*[c for c in rows.columns if c != "date"]), parts))
    # an attempt for each day: its marker must not show another day's files
    (rows.repartition(sum(files.values()), "date", "_part").drop("_part")
     .withColumn("attempt", F.concat(F.lit(f"{attempt}-"), day))
     .write.mode("append").partitionBy("date", "attempt").parquet(path))
    for day, found in taken.items():
        commit_day(spark, path, day, f"{attempt}-{day}",
                   replaces=sorted(set(found) | seen.replaced.get(day, frozenset())))
    return files


def compact_table(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                  file_bytes: int = FILE_BYTES) -> int:
    """Rewrite a table without dates (alerts, quarantine, late rows, metrics) into few files, as ``compact_days`` does a day.

    Returns the number of files, 0 where there is nothing to do.
    """
    seen = visible(spark, path)
    taken = [] if seen is None else [a for a in _attempts_of(spark, path) if seen.on(WHOLE, a)]
    if not taken or taken == [seen.compacted.get(WHOLE)]:
        return 0
    files = max(1, -(-sum(_folder_bytes(spark, f"{path}/attempt={a}") for a in taken) // file_bytes))
    attempt = new_attempt()
    rows = spark.read.schema(schema).format(fmt).load([f"{path}/attempt={a}" for a in taken])
    rows.repartition(files).write.format(fmt).save(f"{path}/attempt={attempt}")
    commit_day(spark, path, WHOLE, attempt, replaces=sorted(set(taken) | seen.replaced.get(WHOLE, frozenset())))
    return files


def vacuum(spark: SparkSession, path: str, day: str, older_than_s: float = 24 * 3600.0) -> list[str]:
    """Delete folders of ``day`` (``WHOLE``: of a table without dates) that no marker shows and that have not changed for ``older_than_s`` seconds.

    That is long enough for readers that began before and writers that have not
    committed yet. Returns the attempts deleted.
    """
    seen = visible(spark, path, day)
    folder, gone = path if day == WHOLE else f"{path}/date={day}", []
    if seen is None:
        return gone
    _, fs = _fs(spark, folder)
    now = spark._jvm.java.lang.System.currentTimeMillis()
    for attempt in _attempts_of(spark, folder):
        at, _ = _fs(spark, f"{folder}/attempt={attempt}")
        if not seen.on(day, attempt) and now - fs.getFileStatus(at).getModificationTime() >= older_than_s * 1000:
            delete_path(spark, f"{folder}/attempt={attempt}")
            gone.append(attempt)
    return gone


def fold_markers(spark: SparkSession, root: str, tables: list[str]) -> int:
    """Delete the markers of batches all of whose rows have moved into compacted files; their number.

    Such a batch has no folder left in any of ``tables``, which must be all that
    commit under ``root`` (``vacuum`` has been there), so its marker shows nothing.
    """
    left = set()
    for path in tables:
        for pattern in (f"{path}/date=*/attempt=*", f"{path}/attempt=*"):
            jpath, fs = _fs(spark, pattern)
            left |= {s.getPath().getName().split("=", 1)[1] for s in fs.globStatus(jpath) or []}
    done = 0
    for m in _markers(spark, f"{root}/batches"):
        if m["attempt"] not in left:
            delete_path(spark, f"{root}/batches/{m['run_id']}-{m['batch_id']}.json")
            done += 1
    return done


__all__ = ["commit", "commit_root", "new_attempt", "visible", "Visible", "visible_days", "read_days", "commit_day",
           "day_markers", "compact_days", "compact_table", "vacuum", "fold_markers"]
