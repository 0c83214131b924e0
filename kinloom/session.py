"""Session helpers: a configured session for local use, and durable intermediate results.

Nothing here touches settings that a cluster has made: the checkpoint folder is read from the session
(``spark.checkpoint.dir``) and a temporary one is used only where none is set.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_OWN_DIRS: list[str] = []
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and for ``bench.py``; on a cluster use the session that spark-submit gives."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("kinloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Set by the cluster; a temporary local one only where it is unset."""
    sc = spark.sparkContext
    known = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if known is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        known = tempfile.mkdtemp(prefix="kinloom-")
        _OWN_DIRS.append(known)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(known)
    return known


@atexit.register
def _clean_up() -> None:
    for path in _OWN_DIRS:
        shutil.rmtree(path, ignore_errors=True)


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` as Parquet in this application's part of the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, keeps columns prunable and gives the planner true sizes
    (which decide between broadcast and shuffle joins later on). ``release`` removes it before the application's end.
    The shuffle files of the job that wrote it are removed: nothing will read them.
    """
    spark = df.sparkSession
    root = application_dir(spark)
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    was = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")  # for this job only; else they stay until the driver collects its garbage
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if was is None else spark.conf.set(_CLEANUP, was)
    out = spark.read.schema(df.schema).parquet(path)
    out._kinloom_path = path
    return out


def application_dir(spark: SparkSession) -> str:
    """The folder of this application's own intermediate tables, removed when it ends; no other application writes or removes there."""
    sc = spark.sparkContext
    root = f"{shared_dir(spark)}/kinloom-{sc.applicationId}"
    if getattr(sc, "_kinloom_root", None) != root:
        hadoop_path(spark, root)[0].deleteOnExit(hadoop_path(spark, root)[1])
        sc._kinloom_root = root
    return root


def hadoop_path(spark: SparkSession, path: str) -> tuple:
    """(file system, path) of Hadoop for a path on any file system."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def release(*tables: DataFrame) -> None:
    """Remove materialized tables that nothing will read again."""
    for df in tables:
        if path := getattr(df, "_kinloom_path", None):
            fs, p = hadoop_path(df.sparkSession, path)
            fs.delete(p, True)


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Mark ``df`` for broadcast only if it truly has at most ``max_rows`` rows; else leave the choice to the planner.

    The count stops at ``max_rows + 1``, so the check itself is bounded.
    """
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, so that functions run there find it wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_kinloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="kinloom-package-")) / "kinloom_package.zip"
    _OWN_DIRS.append(str(target.parent))
    with zipfile.ZipFile(target, "w") as z:
        for path in root.rglob("*.py"):
            z.write(path, path.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._kinloom_shipped = True
