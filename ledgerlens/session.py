"""Session construction and cluster-shared scratch locations."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings every ledgerlens session relies on.  The session time zone is
# pinned to UTC so hour / day-of-week extraction matches the warehouse
# semantics of the curation rules.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ledgerlens", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the ledgerlens defaults applied."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the SQL settings that can change on a live session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


_local_dirs: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a session of one machine (master ``local``) gets a temporary folder,
    registered as the context's checkpoint folder so that later calls agree; on a cluster that
    folder would be a different disk for each executor, so an unset setting is an error.
    """
    d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001 - not readable as a session setting
            d = None
    if not d:
        app = spark.sparkContext.applicationId
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="ledgerlens-")
        d = _local_dirs[app]
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/ledgerlens/{name}-{uuid.uuid4().hex[:12]}"


# Tables whose rows are megabytes each: Parquet checks its sizes after every row, not after 100, and closes a row group
# at about 16 MB, so that neither its writer nor a reader's batch holds hundreds of rows.
_WIDE_ROWS = {"parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "1", "parquet.enable.dictionary": "false"}


def materialize(df, name: str = "table", wide: bool = False):
    """Cut lineage for a DataFrame that several passes will read.

    The rows are written once as parquet under ``spark.checkpoint.dir`` (a
    shared folder on a cluster) and read back: later passes scan columnar
    files (with pruning and pushdown) instead of recomputing joins and
    windows, and a lost executor costs a re-read, not a replay.  (An RDD
    ``checkpoint()`` would compute the plan twice and store rows, not columns.)
    ``wide``: a row holds up to megabytes (a block of points, of tree rows).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").options(**(_WIDE_ROWS if wide else {})).parquet(path)
    return spark.read.parquet(path)


def side_by_side(works: list[Callable[[], object]], most: int = 4) -> list:
    """What independent pieces of work return, in their order; up to ``most`` at a time submit jobs, so that short jobs
    of one fill the cores while another waits for its driver."""
    own = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(most) as pool:
        return [w.result() for w in [pool.submit(own(w)) for w in works]]


def scale_conf(input_bytes: int, executors: int, cores_per_executor: int,
               partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Cluster settings sized from the input volume.

    * shuffle partitions ~ input / ``partition_bytes`` (at least two waves of
      the cluster's cores), coalesced at run time by AQE to the same target
      size, so no task's share outgrows executor memory;
    * scans split files into ``partition_bytes`` pieces;
    * static broadcast joins are off: estimated sizes of derived tables are
      not trusted; AQE broadcasts a side only after measuring it below 64 MB
      (the size check), and splits skewed partitions of sort-merge joins.
    """
    cores = max(1, executors * cores_per_executor)
    parts = max(2 * cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }
