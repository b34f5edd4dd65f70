"""Tables the flows share, written once per session.

The source system curates once into a warehouse table and every later job
reads that table.  Here the raw, curated and prediction tables of an input
folder are written to the shared checkpoint folder the first time a query
needs them and read back by every later query of the same session.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import materialize

_lock = threading.Lock()
_building: dict[tuple, threading.Lock] = {}
_kept: dict[tuple, tuple[tuple, object]] = {}


def _input_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Path, length and time of change of the input files, as the file system of the path tells them."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    state, folders = [], [path]
    while folders:
        folder = folders.pop()
        for f in fs.listStatus(folder) if fs.exists(folder) else []:
            if f.isDirectory():
                folders.append(f.getPath())
            else:
                state.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(state))


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]):
    """What ``build`` made for this session, folder and name, made again when the input files have changed."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    state = _input_state(spark, sf_dir)
    with _lock:
        own = _building.setdefault(key, threading.Lock())
    with own:  # another thread that wants the same table waits instead of writing it again
        if key not in _kept or _kept[key][0] != state:
            _kept[key] = (state, build())
        return _kept[key][1]


def shared(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table ``name`` for ``sf_dir``, built and written on first use."""
    return _once(spark, sf_dir, "table " + name, lambda: materialize(build(), name))


def clear() -> None:
    with _lock:
        _building.clear()
        _kept.clear()


def memo(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]) -> object:
    """A fitted object (model, preprocessor) for ``sf_dir``, built on first use."""
    return _once(spark, sf_dir, "object " + name, build)
