"""Create-or-replace of a table as one step.

A table is a folder with one sub-folder for each version and a pointer, a small file that names the current one:

    <path>/versions/v-<unique>/...   <path>/_current

A writer fills a new version folder and then moves a new pointer over the old one, which file systems do as
one step. Until then readers see the old table; a writer that dies leaves a folder that nothing points to, and a reader that
has opened a version keeps reading it. ``remove_versions`` deletes what is not current.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

POINTER = "_current"


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder of the current version; None where nothing has been committed."""
    fs, pointer = _path(spark, f"{path.rstrip('/')}/{POINTER}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        name = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return f"{path.rstrip('/')}/versions/{name.strip()}"


def commit(spark: SparkSession, path: str, version: str) -> None:
    """Make ``version`` the current one: write a pointer beside the old and move it over it."""
    root = path.rstrip("/")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, fresh = _path(spark, f"{root}/{POINTER}.{version}")
    out = fs.create(fresh, True)
    out.write(bytearray(version, "utf-8"))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), conf).rename(
        fresh, jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}"), how)


def replace_table(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Run ``write`` on a new version folder and commit it; returns the folder. If ``write`` fails, the old table stays."""
    version = f"v-{uuid.uuid4().hex}"
    folder = f"{path.rstrip('/')}/versions/{version}"
    write(folder)
    commit(spark, path, version)
    return folder


def remove_versions(spark: SparkSession, path: str) -> int:
    """Delete all versions but the current one; returns how many. Only when no one reads or writes them any more."""
    keep = current_version(spark, path)
    fs, root = _path(spark, f"{path.rstrip('/')}/versions")
    if keep is None or not fs.exists(root):
        return 0
    gone = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName() != keep.rsplit("/", 1)[1]]
    for p in gone:
        fs.delete(p, True)
    return len(gone)
