"""Session set-up and the shared folder that jobs may write to."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators count on: skewed join partitions are split by
# AQE even where the split costs one more shuffle downstream.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_own_folders: dict[str, str] = {}
_written: dict[tuple[str, str, str], str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Gives a session that is being set up the settings the operators count on."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", name: str = "tidemark") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def _base(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; where it is unset and all runs in this process, a folder of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is not None:
        return base.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, _own_folders[app], ignore_errors=True)
    return _own_folders[app]


def _application_folder(spark: SparkSession) -> str:
    return f"{_base(spark)}/tidemark/{spark.sparkContext.applicationId}"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder the cluster shares (`spark.checkpoint.dir`)."""
    return f"{_application_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def clear_shared_folders(spark: SparkSession) -> None:
    """Deletes all that this application wrote to shared folders; frames that read it end with it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    for key in [k for k in _written if k[0] == spark.sparkContext.applicationId]:
        del _written[key]


def written_once(
    spark: SparkSession, purpose: str, source: str, write: Callable[[str], None]
) -> str:
    """Path of what `write` puts there for a source, written by the first call of an application."""
    key = (spark.sparkContext.applicationId, purpose, source)
    if key not in _written:
        path = shared_folder(spark, purpose)
        write(path)
        _written[key] = path
    return _written[key]


def stored(df: DataFrame) -> DataFrame:
    """The same rows, written to and read back from the shared folder."""
    path = shared_folder(df.sparkSession, "stored")
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._stored_at = path
    return found


def discard(*frames: DataFrame) -> None:
    """Deletes what `stored` wrote for these frames, once all that reads them is written itself; other
    frames are left alone."""
    for df in frames:
        path = getattr(df, "_stored_at", None)
        if path is not None:
            place = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
