"""Session building and the shared folder for cut lineage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_cleaned: set[str] = set()


def get_session(app: str = "evigraph", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator assumes (UTC, AQE, skew join)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir as the cluster set it.

    Where the session names none (tests, local runs), a folder of our own is made
    once per application and removed when Python ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get().rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        _own[app] = tempfile.mkdtemp(prefix="evigraph-")
        atexit.register(shutil.rmtree, _own[app], True)
    return "file://" + _own[app]


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in this application's own part of it, which is
    deleted when Python ends."""
    app = spark.sparkContext.applicationId
    if app not in _cleaned:
        _cleaned.add(app)
        atexit.register(_clean_at_exit, spark, os.path.join(shared_dir(spark), "evigraph", app))
    return os.path.join(shared_dir(spark), "evigraph", spark.sparkContext.applicationId, f"{name}-{uuid.uuid4().hex}")


def _clean_at_exit(spark: SparkSession, path: str) -> None:
    try:
        remove(path, spark)
    except Exception:  # noqa: BLE001 - the JVM may be gone already; then nothing can be deleted from here
        pass


def clean(spark: SparkSession) -> None:
    """Delete all that this application wrote into the shared folder; no result may still be read from it."""
    remove(os.path.join(shared_dir(spark), "evigraph", spark.sparkContext.applicationId), spark)


def materialise(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back.

    Cuts the lineage: a lost executor costs no recomputation, and the plan that
    follows starts at a table scan with known size.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(df_or_path: DataFrame | str, spark: SparkSession | None = None) -> None:
    """Delete a materialised table (its files may no longer be read)."""
    if isinstance(df_or_path, DataFrame):
        spark, paths = df_or_path.sparkSession, {f.rsplit("/", 1)[0] for f in df_or_path.inputFiles()}
    else:
        paths = {df_or_path}
    jvm = spark._jvm
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
