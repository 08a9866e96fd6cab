"""Session settings, the package on the executors, and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Merge sessions inside each task before the shuffle, for hot keys.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(app: str = "clipsense", master: str | None = None, scratch: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings and the package on its executors.

    ``scratch`` is the folder for intermediate tables, which all executors must
    reach; without it ``spark.checkpoint.dir`` has to name one.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if scratch:
        conf = {"spark.checkpoint.dir": scratch, **conf}
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


#: Applications that have the package, and the folder its archive is served from while the driver lives.
_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors, which otherwise need it installed.

    Tasks name functions of the package, they do not carry their code.
    """
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    folder = _SHIPPED[application] = tempfile.TemporaryDirectory(prefix="clipsense-package-")
    package = os.path.dirname(os.path.abspath(__file__))
    spark.sparkContext.addPyFile(
        shutil.make_archive(os.path.join(folder.name, "clipsense"), "zip", os.path.dirname(package), os.path.basename(package))
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master, as in
    tests, may fall back on a temporary folder of the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="clipsense-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def run_folder(spark: SparkSession) -> str:
    """All intermediate tables of one application lie below this folder."""
    return f"{shared_folder(spark)}/clipsense/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the application's folder."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clean_up(spark: SparkSession) -> bool:
    """Delete the application's intermediate tables, once no result reads them any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Deletes a run's shuffle files when it has ended, not when the driver happens to collect garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the files.

    Cuts the lineage like a reliable checkpoint, and survives lost executors.
    What was shuffled for it is deleted, nothing reads it again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "staged")
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    read = spark.read.schema(df.schema).parquet(path)
    read.staged_at = path
    return read


def forget(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in frames:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
