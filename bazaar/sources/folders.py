"""Folder operations of the shared file system (metadata only; data never passes the driver)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _at(spark, path)
    return bool(fs.exists(p))


def finished(spark: SparkSession, path: str) -> bool:
    """Written by a job that has ended."""
    return exists(spark, f"{path}/_SUCCESS")


def children(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in a folder, hidden ones too."""
    p, fs = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _at(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, old: str, new: str) -> None:
    """Rename a folder; the new place must be free."""
    a, fs = _at(spark, old)
    b, _ = _at(spark, new)
    fs.mkdirs(b.getParent())
    if fs.exists(b) or not fs.rename(a, b):
        raise OSError(f"cannot move {old} to {new}")


def settle_table(spark: SparkSession, path: str) -> None:
    """Bring a table back whose swap (see `swap_table`) was cut short."""
    root, name = path.rstrip("/").rsplit("/", 1)
    fresh, old = f"{root}/_next_{name}", f"{root}/_old_{name}"
    if not exists(spark, path):
        if finished(spark, fresh):
            move(spark, fresh, path)
        elif exists(spark, old):
            move(spark, old, path)
    if exists(spark, path):
        delete(spark, old)


def swap_table(spark: SparkSession, path: str, write) -> None:
    """Replace a whole table: `write(folder)` writes it aside, then it takes the old one's place."""
    root, name = path.rstrip("/").rsplit("/", 1)
    fresh, old = f"{root}/_next_{name}", f"{root}/_old_{name}"
    settle_table(spark, path)
    delete(spark, fresh)
    write(fresh)
    if exists(spark, path):
        move(spark, path, old)
    move(spark, fresh, path)
    delete(spark, old)
