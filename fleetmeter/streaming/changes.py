"""Tables fed by a stream.

A stream batch writes its *reduced* rows to a folder named by the batch, so a repeated batch
overwrites its own folder and nothing else. A fold reduces the folders up to a batch into one. The
table is the reduction of its live folders: the last committed fold and the committed batches after it, so a row
counts once and reductions may add up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Reduce = Callable[[DataFrame], DataFrame]

_FOLDER = "folder"


def batch_folder(batch_id: int) -> str:
    return f"b{batch_id:012d}"


def _folded_folder(through: int) -> str:
    return f"f{through:012d}"


def write(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/{_FOLDER}={batch_folder(batch_id)}")


def read(spark: SparkSession, path: str, reduce: Reduce) -> DataFrame:
    return reduce(_rows(spark, path, live(spark, path)))


def _rows(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    places = [f"{path}/{_FOLDER}={n}" for n in names]
    return spark.read.option("basePath", path).parquet(*(places or [path])).drop(_FOLDER)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Folder names of the table; a listing of one directory, no data is read."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(root)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{_FOLDER}="))


def _committed(spark: SparkSession, path: str, name: str) -> bool:
    """Whether the job that wrote the folder has ended; a failed one leaves the folder without the marker."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{_FOLDER}={name}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def live(spark: SparkSession, path: str, through: int | None = None) -> list[str]:
    """The folders that make up the table, or what it was after batch ``through``."""
    names = [n for n in folders(spark, path) if through is None or int(n[1:]) <= through]
    names = [n for n in names if _committed(spark, path, n)]
    folds = [n for n in names if n.startswith("f")][-1:]
    since = int(folds[0][1:]) if folds else -1
    return folds + [n for n in names if n.startswith("b") and int(n[1:]) > since]


def fold(spark: SparkSession, path: str, through: int, reduce: Reduce) -> None:
    """Fold the folders up to batch ``through`` into one.

    The folders that went in stay for readers that have listed them, until the next fold. What a
    failed fold has left counts for nothing: its sources are folded again, and only folders that a
    committed fold covers are removed. Call it only for batches that are complete.
    """
    old = [n for n in folders(spark, path) if int(n[1:]) <= through]
    fresh = live(spark, path, through)
    if len(fresh) < 2:
        return
    target = _folded_folder(through)
    reduce(_rows(spark, path, fresh)).write.mode("overwrite").parquet(f"{path}/{_FOLDER}={target}")
    if not _committed(spark, path, target):
        raise RuntimeError(f"{path}: the fold through batch {through} has no commit marker")
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for name in set(old) - {*fresh, target}:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{_FOLDER}={name}"), True)
