"""Sessions, and the shared folder in which lineage is cut."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "quern", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, which every executor can reach.

    Only where the session names none and runs on one machine is a temporary folder set.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir", None)
    if folder:
        return folder
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    temporary = tempfile.mkdtemp(prefix="quern-")
    atexit.register(shutil.rmtree, temporary, ignore_errors=True)
    context.setCheckpointDir("file://" + temporary)
    return context.getCheckpointDir()


def _run_folder(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables."""
    return f"{shared_dir(spark).rstrip('/')}/quern-{spark.sparkContext.applicationId}"


def _held(spark: SparkSession) -> tuple:
    """The folder of intermediate tables with its file system, in the JVM."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_run_folder(spark))
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written once into the shared folder and read back: later uses do not run its plan again.

    The files survive the loss of any executor, unlike cached blocks. They lie in one folder of the application, which
    `release` removes, and the end of the driver at the latest.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path of its own among the intermediate tables."""
    folder = _run_folder(spark)
    if folder not in _kept:
        system, path = _held(spark)
        system.mkdirs(path)
        system.deleteOnExit(path)
        _kept.add(folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


_kept: set[str] = set()


def release(spark: SparkSession) -> None:
    """Removes all intermediate tables of this application. Frames that were made before and not yet written need them,
    so it is called when results have been written."""
    folder = _run_folder(spark)
    if folder in _kept:
        system, path = _held(spark)
        system.delete(path, True)
        _kept.discard(folder)
