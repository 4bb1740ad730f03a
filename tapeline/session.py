"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def package_root() -> str:
    return os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _let_workers_import() -> None:
    """Python workers of a local session find this package whatever folder it was started from."""
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if package_root() not in paths:
        os.environ["PYTHONPATH"] = os.pathsep.join([package_root(), *filter(None, paths)])


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors of a cluster that does not have it installed."""
    with tempfile.TemporaryDirectory() as folder:
        with zipfile.ZipFile(packed := os.path.join(folder, "tapeline.zip"), "w") as z:
            for here, _, names in os.walk(os.path.join(package_root(), "tapeline")):
                for name in names:
                    if name.endswith(".py"):
                        z.write(full := os.path.join(here, name), os.path.relpath(full, package_root()))
        spark.sparkContext.addPyFile(packed)


def build_session(app: str = "tapeline", cores: str | int = "*", partitions: int | None = None) -> SparkSession:
    """A local session for tests and benches; on a cluster use the one you are given."""
    n = os.cpu_count() if cores == "*" else int(cores)
    _let_workers_import()
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    if SparkSession.getActiveSession() is None:
        builder = builder.config("spark.checkpoint.dir", os.environ.get("TAPELINE_SHARED_DIR") or tempfile.mkdtemp(prefix="spark-"))
    return (
        builder
        .config("spark.sql.shuffle.partitions", str(partitions or n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "Asia/Shanghai")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TAPELINE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def bound_rows(df: DataFrame, rows: int) -> DataFrame:
    """``df``, with the session's Arrow batches held to ``rows`` rows where they are long texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(key)) <= rows:
        df.sparkSession.conf.set(key, str(rows))
    return df


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    ``build_session`` names one for its own single-machine sessions; a cluster that names none is an error, as a folder
    of one machine would lose what other executors write.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise RuntimeError("spark.checkpoint.dir names no folder; set it to one that the driver and all executors share")
    return root.rstrip("/")


@cache
def _run_folder(root: str, app: str) -> str:
    return f"{root}/tapeline/{app}-{uuid.uuid4().hex[:8]}"


def run_folder(spark: SparkSession) -> str:
    """This application's own folder below the shared one."""
    return _run_folder(shared_root(spark), spark.sparkContext.applicationId)


def clear_work(spark: SparkSession) -> None:
    """Removes all tables and stream folders this application has staged; results that still read them end."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder for staged tables and stream checkpoints."""
    return f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write a table that several later steps read to the shared folder and read it back.

    This computes it once, cuts its lineage, and survives the loss of executors.
    """
    path = work_path(df.sparkSession, label)
    df.write.mode("overwrite").option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
