"""Session helpers.

The session is created by the caller on a cluster; these helpers only
fill in settings that are missing (local runs and tests).
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "cohortlens") -> SparkSession:
    """Return the active session, or build a local one for tests/bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster `spark.checkpoint.dir` names a shared folder and is used
    as is. Only when it is unset and the master is local (tests, single
    machine) a scratch folder is created and registered with the
    SparkContext; any other master needs the setting.
    """
    sc = spark.sparkContext
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(conf)
        return conf
    current = sc.getCheckpointDir()
    if current:
        # setCheckpointDir appends a per-application folder; use its parent
        return current.rsplit("/", 1)[0]
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    base = tempfile.mkdtemp(prefix="cohortlens-ckpt-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    sc.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for written tables.
    The folder's scheme stays, so file:, hdfs: and the like all work."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers of all executors (once for
    each application), so that functions running there can import it where it
    is not installed."""
    sc = spark.sparkContext
    if getattr(sc, "_cohortlens_shipped", False):
        return
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="cohortlens-zip-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "cohortlens.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for top, _, names in os.walk(os.path.join(home, "cohortlens")):
            for name in sorted(names):
                if name.endswith(".py"):
                    file = os.path.join(top, name)
                    out.write(file, os.path.relpath(file, home))
    sc.addPyFile(path)
    sc._cohortlens_shipped = True


def materialize(df, eager: bool = True):
    """Cut the lineage of a table reused by iterative jobs.

    Uses a reliable checkpoint in the shared checkpoint folder (never a
    local checkpoint), so a lost executor does not force a recompute of
    the whole upstream plan.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


class IterativeFrame:
    """Keeps the working table of an iterative algorithm cheap to reread.

    Each `step` persists the new table (memory, spilling to disk) and drops
    the previous one; every `every` steps the table is instead written as a
    reliable checkpoint, so lineage stays bounded and a lost executor only
    recomputes from the last checkpoint (the scheme of Spark ML's periodic
    checkpointer).
    """

    def __init__(self, every: int = 10):
        self.every, self.n, self.prev = every, 0, None

    def step(self, df):
        from pyspark import StorageLevel
        self.n += 1
        if self.n % self.every == 0:
            out = materialize(df)
        else:
            out = df.persist(StorageLevel.MEMORY_AND_DISK)
            out.count()
        self.release()
        self.prev = out
        return out

    def release(self):
        if self.prev is not None:
            self.prev.unpersist()
            self.prev = None


SPREAD_ROWS = 100_000


def spread(df, per_core: int = 1, rows: int | None = None):
    """Round-robin the rows over (cores x per_core) partitions before a
    table is checkpointed for iterative fits: AQE may have coalesced a small
    upstream stage into fewer partitions than there are cores. A partition
    takes `SPREAD_ROWS` rows at most, so larger tables get more of them;
    `rows` is the table's count where it is known."""
    n = df.sparkSession.sparkContext.defaultParallelism * per_core
    return df.repartition(max(n, -(-(df.count() if rows is None else rows) // SPREAD_ROWS)))


def cluster_settings(total_cores: int, input_bytes: int) -> dict:
    """Suggested settings for a cluster run (applied by the caller at
    session build time): about 3 shuffle partitions per core but at least
    one per 256 MB of input, 256 MB scan splits, AQE coalescing to 128 MB
    and skew-join splitting."""
    parts = max(3 * total_cores, input_bytes // (256 * 1024 * 1024))
    return {
        "spark.sql.shuffle.partitions": str(int(parts)),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    }
