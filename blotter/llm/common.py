"""Shared folder, written intermediate tables, file access and null handling."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_ROOT: list[str] = []
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once per application.

    Functions that run in tasks are imported there by name, so that a worker
    keeps its tokenizer and caches from task to task; executors that have the
    package installed use either copy alike.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="blotter-package-"), "blotter_package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(target)  # the driver serves it; no shared folder is needed


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a purely local session (tests) that does not name one gets a scratch
    folder; a cluster without the setting is refused, because its machines
    would not see each other's files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
    if not _LOCAL_ROOT:
        _LOCAL_ROOT.append("file://" + tempfile.mkdtemp(prefix="blotter-shared-"))
    return _LOCAL_ROOT[0]


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared root; every call gives another one."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there.

    Lost executors cost only the tasks that read the table, never the work
    that made it.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names.

    Whatever else the table holds, including columns that bear one of the
    operator's internal names, is left behind here.
    """
    ship_package(df.sparkSession)
    return df.select(*[df[f"`{source}`"].alias(name) for name, source in columns.items()])


def text_or_empty(column="text"):
    return F.coalesce(F.col(column), F.lit(""))


def file_system(uri: str):
    """pyarrow file system and path of a URI or plain path (file, hdfs, s3, ...)."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri)
