"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_unset: list[str] = []


def use_where_unset(folder: str) -> None:
    """Stage in ``folder`` where a session names none. The setting is a static one, so a running session can't
    be given it any more; ``folder`` must be shared by all executors as well."""
    _unset[:] = [folder]


def stage_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, which all executors must share."""
    root = spark.conf.get(_SETTING, None) or next(iter(_unset), None)
    if not root:
        raise ValueError(f"{_SETTING} must name a folder that all executors share")
    return root.rstrip("/")


_FOLDER: ContextVar[str | None] = ContextVar("spanloom_stage_folder", default=None)


@contextmanager
def stage_folder(spark: SparkSession, name: str) -> Iterator[None]:
    """Stages made inside share one folder, which ``remove_stages`` removes. What an earlier try of the
    same name left is removed first."""
    remove_stages(spark, name)
    token = _FOLDER.set(name)
    try:
        yield
    finally:
        _FOLDER.reset(token)


def remove_stages(spark: SparkSession, name: str) -> None:
    """Remove the folder of ``stage_folder``; the tables read from it can't be read any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{stage_root(spark)}/spanloom/{name}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage_path(spark: SparkSession, name: str) -> str:
    own = [_FOLDER.get()] if _FOLDER.get() else []
    return "/".join([stage_root(spark), "spanloom", *own, uuid.uuid4().hex, name])


_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str, drop_shuffles: bool = False, **options: str) -> DataFrame:
    """Write ``df`` once as a table and read it back.

    It cuts the plan where several later branches need the same expensive rows: they read the few
    columns they want from the table, and lost executors cost no recomputation from the start. ``options`` go to the Parquet writer.
    With ``drop_shuffles`` the shuffle files behind the table go as soon as it is written: chains of many
    tables then hold little more than their tables.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    before = spark.conf.get(_CLEAN_UP, None)  # None where the session doesn't name it
    if drop_shuffles:
        spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        if drop_shuffles:
            spark.conf.unset(_CLEAN_UP) if before is None else spark.conf.set(_CLEAN_UP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged = path
    return out


def unstage(*tables: DataFrame) -> None:
    """Remove tables that ``stage`` returned, once nothing that is still to run reads them."""
    for table in tables:
        jvm = table.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(table._staged)
        path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
