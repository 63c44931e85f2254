"""Spark session and shared-storage helpers."""

from __future__ import annotations

import atexit
import contextlib
import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "churnlens", extra: dict | None = None) -> SparkSession:
    """Session with the settings every job here assumes.

    UTC session zone (timestamps are timezone-naive anyway), AQE on with
    partition coalescing and skew-join splitting, UI off.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and scratch tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).
    Where neither is set a local master gets a fresh folder; any other
    master is an error, as its executors would not see this machine's disk.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not is_local(sc.master):
            raise ValueError(f"spark.checkpoint.dir is not set: tables between jobs need a folder that all "
                             f"executors of {sc.master} share")
        d = tempfile.mkdtemp(prefix="churnlens-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def is_local(master: str) -> bool:
    """Whether driver and executors are one process ("local", "local[8]")."""
    return master == "local" or master.startswith("local[")


def scratch_root(spark: SparkSession) -> str:
    """This application's folder of scratch tables."""
    return f"{shared_dir(spark).rstrip('/')}/churnlens/{spark.sparkContext.applicationId}"


_ROOTS: dict[str, SparkSession] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the application's scratch folder, which goes
    when the session is released or the process ends."""
    root = scratch_root(spark)
    if root not in _ROOTS:
        if not _ROOTS:
            atexit.register(_release_all)
        _ROOTS[root] = spark
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def release_scratch(spark: SparkSession) -> None:
    """Delete the application's scratch tables: to be called once no frame reads them."""
    root = scratch_root(spark)
    drop_scratch(spark, root)
    _ROOTS.pop(root, None)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete one scratch folder: to be called once no frame reads it."""
    if not f"{path}/".startswith(f"{scratch_root(spark)}/"):
        raise ValueError(f"{path} is not among the application's scratch tables")
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def _release_all() -> None:
    for spark in list(_ROOTS.values()):
        with contextlib.suppress(Exception):  # the session may be gone with the process
            release_scratch(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application: as a zip in the shared folder, added like
    ``--py-files``, so workers need no path to it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, os.path.dirname(root)))
    target = sc._jvm.org.apache.hadoop.fs.Path(f"{scratch_path(spark, 'package')}/churnlens.zip")
    stream = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target)
    stream.write(bytearray(body.getvalue()))
    stream.close()
    sc.addPyFile(target.toString())
    _SHIPPED.add(sc.applicationId)


SHUFFLE_TASK_INPUT = 4 << 20    # bytes of source files per shuffle partition
SHUFFLE_TASK_BYTES = 16 << 20   # bytes that adaptive execution puts into one task
SCAN_TASK_BYTES = 32 << 20      # bytes of files read by one task


def bound_tasks(spark: SparkSession, input_bytes: int) -> None:
    """Let the number of tasks follow the input, so that what one task sorts or aggregates does not grow with it.

    Settings of the session, as a result is planned only when it is run: more shuffle partitions where the input asks for
    more (adaptive execution joins small ones), and smaller tasks where the session allows larger ones. Never the
    other way, so a stricter session keeps its own.
    """
    conf, size = spark.conf, spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    key = "spark.sql.shuffle.partitions"
    conf.set(key, str(max(int(conf.get(key)), -(-input_bytes // SHUFFLE_TASK_INPUT))))
    for key, most in (("spark.sql.adaptive.advisoryPartitionSizeInBytes", SHUFFLE_TASK_BYTES),
                      ("spark.sql.files.maxPartitionBytes", SCAN_TASK_BYTES)):
        if size(conf.get(key)) > most:
            conf.set(key, f"{most}b")


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession):
    """What is run here drops its shuffle files as it ends, not when the driver next collects garbage. For frames that
    are run once, as those of a write: a second run of the same frame computes its stages again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def materialize(df, name: str = "intermediate", partition_by: str | None = None, files: int = 2):
    """Cut lineage: write the frame as a Parquet table in the shared folder
    and read it back (eager).

    Used where one intermediate feeds several branches of a plan, so it is
    computed once instead of once per branch, and a lost executor replays
    from the written files rather than from the sources. Parquet keeps it
    columnar and gives the planner real file sizes. ``partition_by`` lays the
    table out in folders by that column, each of at most ``files`` files, so
    that later filters on it skip whole folders.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if not partition_by:
        with freed_shuffles(spark):
            df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    rest = [c for c in df.columns if c != partition_by]
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rest]), F.lit(int(files)))
    with freed_shuffles(spark):
        df.repartition(F.col(partition_by), spread).write.mode("overwrite").partitionBy(partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*[F.col(f"`{c}`") for c in df.columns])
