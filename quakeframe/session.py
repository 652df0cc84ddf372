"""Session helpers. The caller owns the session; nothing here builds or stops one
except ``local_session`` for tests and the bench."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid
import zipfile
from contextlib import contextmanager, suppress

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
TRIM_COMMAND = "systemTrimNativeHeap"  # the JVM's name for jcmd's System.trim_native_heap


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder under the cluster's shared checkpoint location.

    Reads ``spark.checkpoint.dir`` from the session. When it is unset it falls
    back to a folder under ``spark.sql.warehouse.dir``, unless that is a local
    path and the master is not: each executor would then write its own disk.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None)
    if not base:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        local_path = warehouse.startswith(("file:", "/"))
        if local_path and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        base = warehouse.rstrip("/") + "/_quakeframe"
    return f"{base.rstrip('/')}/{name}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint`` and MLlib checkpointing use the shared dir."""
    path = spark.conf.get(CHECKPOINT_CONF, None) or shared_dir(spark, "checkpoints")
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per context.

    A cluster that has it installed loses nothing; elsewhere functions that run
    in workers would fail to import. Only the driver reads the archive it writes
    here; Spark serves it to the executors.
    """
    sc = spark.sparkContext
    if getattr(sc, "_quakeframe_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="quakeframe-"), "quakeframe.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.join("quakeframe", os.path.relpath(path, root)))
    sc.addPyFile(archive)
    sc._quakeframe_shipped = True


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, scratch: str | None = None) -> SparkSession:
    """A local session for tests / bench: UI off, AQE on, UTC, warehouse under ``scratch``."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quakeframe")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("QF_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if scratch:
        # No spark.checkpoint.dir here: one configured for the cluster
        # (spark-defaults, submit options) is used as is, and where none is set
        # ``shared_dir`` falls back to the warehouse folder under ``scratch``.
        b = b.config("spark.sql.warehouse.dir", f"{scratch}/warehouse").config("spark.local.dir", f"{scratch}/local")
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _folder(spark: SparkSession, path: str):
    """(file system, path) of the session's Hadoop configuration."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _folder(spark, path)
    return fs.exists(p)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the partition folders (``column=value``) right under ``path``."""
    fs, p = _folder(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() and "=" in s.getPath().getName())


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = _folder(spark, path)
    fs.delete(p, True)


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """``source`` takes the place of ``target``."""
    fs, old = _folder(spark, target)
    fs.delete(old, True)
    fs.mkdirs(old.getParent())
    if not fs.rename(_folder(spark, source)[1], old):
        raise OSError(f"could not move {source} to {target}")


def add_files(spark: SparkSession, source: str, target: str) -> None:
    """The files of ``source`` join those of ``target``; Spark's file names are unique."""
    fs, new = _folder(spark, source)
    into = _folder(spark, target)[1]
    for status in fs.listStatus(new):
        if not fs.rename(status.getPath(), into):
            raise OSError(f"could not move {status.getPath()} to {target}")


def release(spark: SparkSession) -> None:
    """Let go of what finished plans hold in the driver, for jobs of many plans.

    Python's handles on them lie in reference cycles; once those are gone the JVM can
    drop plans, broadcasts and shuffles, and gives the heap it no longer needs back.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    trim_native_heap(spark)


def trim_native_heap(spark: SparkSession) -> None:
    """Give back the memory outside the heap that the JVM has freed (of compiled plans,
    codecs, buffers) but its C allocator keeps: with many threads it keeps the most that
    each has ever used. Does nothing on a JVM without that command."""
    jvm = spark.sparkContext._jvm
    # The server's own class is hidden in its module; its interface has the method.
    server = jvm.java.lang.Class.forName("javax.management.MBeanServer")
    invoke = next(m for m in server.getMethods() if m.getName() == "invoke")
    call = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)  # the command takes no arguments: the last two stay null
    call[0], call[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), TRIM_COMMAND
    with suppress(Py4JJavaError):
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), call)


_SCOPES: list[list[str]] = []


@contextmanager
def temporary_tables(spark: SparkSession):
    """Inside this block, folders of ``materialize`` and ``scratch_dir`` are noted and
    deleted at its end. Results must be written or collected inside it."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            delete_folder(spark, path)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder's path under the shared folder; like the tables of
    ``materialize`` it goes when the ``temporary_tables`` block ends."""
    path = shared_dir(spark, f"tmp/{name}-{uuid.uuid4().hex}")
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a Parquet table under the shared folder and read it back.

    Used where one intermediate table feeds several consumers: it is computed
    by one job, read back columnar (pruned per consumer), and lineage is cut,
    so a lost executor re-reads files instead of recomputing the input. The
    table stays until the caller's ``temporary_tables`` block ends; without one,
    until the folder is cleaned.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
