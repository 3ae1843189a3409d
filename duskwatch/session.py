"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "duskwatch", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def use_utc(spark: SparkSession) -> None:
    """Bucket text is UTC everywhere, so timestamp text must be rendered in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give executors this package, once per application: their Python functions import it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="duskwatch-"), "duskwatch.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(here)))
    sc.addPyFile(path)  # Spark's own file server hands it to the executors
    _SHIPPED.add(sc.applicationId)


def prepare(spark: SparkSession) -> None:
    use_utc(spark)
    ship_package(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables, which driver and executors share.

    It is the one in ``spark.checkpoint.dir`` or given to ``setCheckpointDir``. Where
    neither is set, a session whose executors are threads of the driver gets a temporary
    one; any other session gets an error, since executors do not see the driver's disk.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="duskwatch-"))
    return sc.getCheckpointDir().rstrip("/")


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one. The caller's job owns it and may delete it once its results are written."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared work folder and read it back.

    Used where several branches need one costly result: it is computed once, and a lost
    executor costs a re-read instead of a recomputation.
    """
    path = work_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
