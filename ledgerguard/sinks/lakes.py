"""Date-partitioned Parquet lakes (valid and fraud)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerguard.sinks.commits import commit, commit_root, new_attempt


def write_attempt(rows: DataFrame, path: str, attempt: str, run_id: str, batch_id: int) -> None:
    """Lake rows (which carry ``date``) as files of ``attempt``, not visible before its commit.

    They go to ``date=<d>/attempt=<a>``: ``date`` stands outermost, so a report
    on one day lists one folder; rows are rebalanced on it into few files of even
    size. ``run_id`` and ``batch_id`` are columns.
    """
    (rows.hint("rebalance", "date").withColumns({
        "run_id": F.lit(run_id), "batch_id": F.lit(int(batch_id)).cast("long"), "attempt": F.lit(attempt)})
     .write.mode("append").partitionBy("date", "attempt").parquet(path))


def write_lake(rows: DataFrame, path: str, batch_id: int = 0, run_id: str | None = None) -> None:
    """Write one lake by itself and commit it; rows of an earlier try of the same run and batch go.

    Without ``run_id`` the rows are a run of their own and are added.
    """
    attempt = new_attempt()
    run_id = run_id or f"append-{attempt}"
    write_attempt(rows, path, attempt, run_id, batch_id)
    commit(rows.sparkSession, commit_root(path), run_id, batch_id, attempt)


def write_report(table: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Persist a report table (small by construction) as one file."""
    table.coalesce(1).write.mode("overwrite").format(fmt).option("header", "true").save(path)


def write_report_text(lines: DataFrame, path: str) -> None:
    """Report lines (already ordered) as one text file; a few dozen lines."""
    lines.select("line").coalesce(1).write.mode("overwrite").text(path)
