"""Folders that hold one complete write per batch: ``<folder>/batch_id=<n>``."""

from __future__ import annotations

from pyspark.sql import SparkSession

_DONE = "_SUCCESS"


def batch_folder(folder: str, batch_id: int) -> str:
    return f"{folder.rstrip('/')}/batch_id={batch_id}"


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    files, hadoop = _path(spark, path)
    return files.exists(hadoop)


def make_folder(spark: SparkSession, path: str) -> None:
    files, hadoop = _path(spark, path)
    files.mkdirs(hadoop)


def is_complete(spark: SparkSession, path: str) -> bool:
    """A write to ``path`` has been committed as a whole."""
    return exists(spark, f"{path.rstrip('/')}/{_DONE}")


def publish(spark: SparkSession, staged: str, target: str) -> None:
    """Move a complete write to its place, in one step where the file system can.

    What an incomplete write left at ``target`` is replaced.
    """
    files, source = _path(spark, staged)
    _, goal = _path(spark, target)
    files.delete(goal, True)
    files.mkdirs(goal.getParent())
    if not files.rename(source, goal):
        raise OSError(f"could not move {staged} to {target}")


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder, if it is there."""
    files, hadoop = _path(spark, path)
    files.delete(hadoop, True)


def drop_batch(spark: SparkSession, folder: str, batch_id: int) -> None:
    """Remove what one batch wrote, if it is there."""
    drop_folder(spark, batch_folder(folder, batch_id))


def children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it is not there."""
    files, hadoop = _path(spark, path)
    return [entry.getPath().getName() for entry in files.listStatus(hadoop)] if files.exists(hadoop) else []


def latest_batch(spark: SparkSession, folder: str) -> int | None:
    """The highest batch written completely, or None."""
    files, hadoop = _path(spark, folder)
    if not files.exists(hadoop):
        return None
    names = (entry.getPath().getName() for entry in files.listStatus(hadoop))
    numbers = sorted((int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id=")), reverse=True)
    return next((n for n in numbers if is_complete(spark, batch_folder(folder, n))), None)
