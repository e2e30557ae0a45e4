"""Session settings and stored intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_written: list[tuple[SparkSession, str]] = []
_shipped: set[str] = set()


def session(app: str = "textmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that the operators expect; any of them may be overridden."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once an application, so that they need no installation or path."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="textmill-")) / "textmill.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent).as_posix())
    sc.addPyFile(str(archive))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. The cluster names it; a local temporary one serves only local masters."""
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
    local = "file://" + tempfile.mkdtemp(prefix="textmill-")
    spark.conf.set(CHECKPOINT_DIR, local)
    _written.append((spark, local))
    return local


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage, survives the loss of executors, and later
    reads take only the columns they need. The files go when the driver ends."""
    spark = df.sparkSession
    path = temporary(spark, f"{shared_dir(spark)}/textmill-{uuid.uuid4().hex}") + f"/{label}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def temporary(spark: SparkSession, path: str) -> str:
    """path, a folder that goes when the driver ends."""
    _written.append((spark, path))
    return path


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            jvm = spark.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # noqa: BLE001, S112 - that session may be gone already; others may not
            continue


def spread(df: DataFrame) -> DataFrame:
    """df over as many tasks as there are cores, if a small input came in fewer; large inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the tables, a Parquet file or folder each."""
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")
