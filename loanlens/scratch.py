"""Where intermediate tables live.

Lineage is cut only through storage every executor can reach: the folder the
cluster names in ``spark.checkpoint.dir``.  A session without one gets a folder of its
own, removed at the end, but only if its executors are threads of the driver.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Shared folder of the session; also set as its checkpoint folder."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[0-9*, ]+\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="loanlens-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a folder nobody else uses, below the shared folder."""
    root = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder of whatever file system Spark keeps it in."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def complete_folders(spark: SparkSession, path: str) -> list[PurePosixPath]:
    """Success marks of the folders below a folder, none if it does not exist."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return [PurePosixPath(status.getPath().toUri().getPath()) for status in found or ()]


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly below a folder, none if it does not exist."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(status.getPath().getName() for status in found or ())


@contextmanager
def temporary(spark: SparkSession, name: str) -> Iterator[str]:
    """A new folder that is removed at the end, whether or not the work succeeded."""
    path = new_folder(spark, name)
    try:
        yield path
    finally:
        remove(spark, path)


# Fixed value: the largest method, in bytes, that Java compiles.
_COMPILED_BYTES = "8000"
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Within it, stages over many derived columns run as compiled code.

    Spark makes one method of a stage.  Above this size Java interprets it for good;
    with the limit Spark evaluates the stage's operators one by one, in small methods.
    Results are the same.
    """
    before = spark.conf.get(_METHOD_LIMIT, None)
    spark.conf.set(_METHOD_LIMIT, _COMPILED_BYTES)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_METHOD_LIMIT)
        else:
            spark.conf.set(_METHOD_LIMIT, before)


_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidied(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a query go when the query ends.

    Otherwise they stay until the driver's Java happens to collect the query's plan, so
    that steps which each need little disk add up.  For work whose results are stored;
    a stage that is wanted again after all is computed again.
    """
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLE_CLEANUP)
        else:
            spark.conf.set(_SHUFFLE_CLEANUP, before)


def materialise(df: DataFrame) -> DataFrame:
    """Computes ``df`` once into reliable storage and reads it from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
