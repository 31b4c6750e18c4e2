"""Stored folders that are replaced whole: a reader finds the earlier rows until the new ones are complete."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

_STAGED, _OLD = "._staged-", "._old-"


def _folder(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system of a path, as Spark resolves it, and the path in it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a folder, an earlier one that a broken-off replacement moved aside included."""
    recover(spark, path)
    files, where = _folder(spark, path)
    return files.exists(where)


def recover(spark: SparkSession, path: str) -> None:
    """Put back the earlier folder where a replacement broke off between its two renames."""
    files, where = _folder(spark, path)
    if files.exists(where) or not files.exists(where.getParent()):
        return
    kept = [s.getPath() for s in files.listStatus(where.getParent()) if s.getPath().getName().startswith(where.getName() + _OLD)]
    if kept:
        files.rename(kept[0], where)


def replaced(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let `write` fill a folder beside `path`, then put it in the place of `path`.

    What stood there before goes only after the new folder is complete and in
    place. If `write` fails, its folder goes and the earlier one is untouched.
    """
    recover(spark, path)
    files, where = _folder(spark, path)
    mark = uuid.uuid4().hex
    staged, old = f"{path.rstrip('/')}{_STAGED}{mark}", f"{path.rstrip('/')}{_OLD}{mark}"
    staged_path, old_path = _folder(spark, staged)[1], _folder(spark, old)[1]
    try:
        write(staged)
    except BaseException:
        files.delete(staged_path, True)
        raise
    had = files.exists(where)
    if had and not files.rename(where, old_path):
        raise OSError(f"cannot move {path} aside")
    if not files.rename(staged_path, where):
        if had:
            files.rename(old_path, where)
        raise OSError(f"cannot put {staged} in the place of {path}")
    if had:
        files.delete(old_path, True)


def removed(spark: SparkSession, paths: list[str]) -> None:
    """Folders that are to go, where they are there."""
    for path in paths:
        files, where = _folder(spark, path)
        files.delete(where, True)
