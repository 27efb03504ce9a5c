"""Session settings the library relies on, and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "lexaloom", cores: str = "*", **conf: str) -> SparkSession:
    """A session for tests and local runs; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; one of our own only where none is named and all run on this machine (tests). On a cluster without one nothing could be read back, so that is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if spark not in _OWN:
        _OWN[spark] = tempfile.mkdtemp(prefix="lexaloom-")
        atexit.register(shutil.rmtree, _OWN[spark], ignore_errors=True)
    return _OWN[spark]


_OWN: dict[SparkSession, str] = {}


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once as a compressed table in the shared checkpoint folder and read from there.

    This cuts its lineage: a later stage that loses an executor reads the table
    again instead of computing it anew. Tables stay until they are ``dropped`` or
    the application ends.
    """
    spark = df.sparkSession
    path = f"{_shared_folder(spark).rstrip('/')}/lexaloom-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(_remove, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def dropped(df: DataFrame) -> None:
    """Removes the table of a ``cut`` that nothing reads any more."""
    _remove(df.sparkSession, _PATHS.pop(df))


def _remove(spark: SparkSession, path: str) -> None:
    try:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001 - the session has ended already
        return
