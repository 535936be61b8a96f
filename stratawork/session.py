"""Session construction and the plumbing that several packages share."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def build_session(app: str = "stratawork", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings that the library expects of a cluster."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Make this package importable by Python workers that do not see the repository."""
    app = spark.sparkContext.applicationId
    known = [os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if app in _shipped or str(ROOT) in known:
        return
    target = Path(tempfile.mkdtemp(prefix="stratawork-")) / "stratawork.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted((ROOT / "stratawork").rglob("*.py")):
            z.write(p, p.relative_to(ROOT))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share.

    Only a local master, whose executors are the driver's own process, may do
    without: it gets a folder below the temporary one. On a cluster without
    the setting this raises, as executors would write where others cannot read.
    A folder without a scheme is of the default file system, as for Spark's own
    writers, and comes back with that scheme.
    """
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if given:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(given)
        return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(f"file://{tempfile.gettempdir()}/checkpoints/stratawork")
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def delete(spark: SparkSession, uri: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_kept: list[tuple[SparkSession, str]] = []


def _clean() -> None:
    for spark, uri in _kept:
        try:
            if uri.startswith("file:"):
                shutil.rmtree(re.sub("^file:/*", "/", uri), ignore_errors=True)
            else:
                delete(spark, uri)
        except Exception:  # the session may be gone: the cluster's own clean-up takes over
            pass


def own_folder(spark: SparkSession, what: str) -> str:
    """A new name in the shared folder; what is there goes when the driver ends."""
    if not _kept:
        atexit.register(_clean)
    uri = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
    _kept.append((spark, uri))
    return uri


def written(spark: SparkSession, df: DataFrame, what: str) -> DataFrame:
    """``df`` as a table in the shared folder: planned once, and read again by whatever needs it."""
    uri = own_folder(spark, what)
    df.write.parquet(uri)
    return spark.read.schema(df.schema).parquet(uri)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables; ``sf_dir`` may be any path that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
