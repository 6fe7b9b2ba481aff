"""Replay a table as a time-ordered stream of files.

Used to drive the streaming operators from the given tables: the rows are
range-partitioned by an order column into ``n`` files (rows of one value stay in
one file, and the file order is that of the column), written once to the shared
folder, and read back with ``maxFilesPerTrigger=1``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



def write_replay(rows: DataFrame, path: str, n_files: int, fmt: str = "text",
                 value_col: str = "value", order_col: str = "_replay_date",
                 file_col: str | None = None) -> str:
    """Write ``rows`` as ``n_files`` files in time order; returns ``path``.

    ``file_col`` (an int from 0), where given, says which file a row goes to;
    otherwise ``order_col`` is cut into ranges of about equal size.
    ``rows`` must carry ``order_col``; for ``fmt="text"`` only
    ``value_col`` is written, one message per line.
    """
    order_col = file_col or order_col
    chunks = rows.repartitionById(n_files, F.col(file_col)) if file_col \
        else rows.repartitionByRange(n_files, F.col(order_col))
    if fmt == "text":
        chunks.select(value_col).write.mode("overwrite").text(path)
    else:
        chunks.drop(order_col).write.mode("overwrite").format(fmt).save(path)
    _order_file_times(rows.sparkSession, path)
    return path


def _order_file_times(spark: SparkSession, path: str) -> None:
    """Give the data files increasing modification times in part-number order.

    The file stream source takes files oldest first; parallel writers finish
    in any order, so the times are set explicitly (metadata only, one call per
    file).
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(str(st.getPath().toString()) for st in fs.listStatus(root)
                   if st.getPath().getName().startswith("part-"))
    base = 1_000_000_000_000
    for i, name in enumerate(names):
        file = jvm.org.apache.hadoop.fs.Path(name)
        fs.setTimes(file, base + i * 1000, -1)
        if fs.getFileStatus(file).getModificationTime() != base + i * 1000:
            raise RuntimeError(f"{name} keeps its write time: a replay out of order would drop late rows")
