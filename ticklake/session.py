"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are planned for. Broadcasts are never hinted: Spark checks the size of a
# side against its threshold, statically or at run time, and otherwise shuffles; AQE then splits
# hot partitions of joins and of rebalanced writes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Compressed files grow in memory; without this a file size is taken for the broadcast size.
    "spark.sql.sources.fileCompressionFactor": "4.0",
}


def local_session(cores: int | str = 8, app: str = "ticklake", **extra: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name that every executor can reach.

    It lies under ``spark.checkpoint.dir``. Only a local session may go without that setting;
    it then gets a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        shared = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/ticklake/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as they are now, written to the shared folder.

    Later commits cannot change them, a lost executor cannot take them along, and their size is
    known to the planner, which then broadcasts them if they are small.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def existing(spark: SparkSession, names: Sequence[str]) -> tuple[list[str], list[str]]:
    """(there, absent): file or folder names, patterns among them, by whether anything is there now."""
    there, absent = [], []
    conf = spark._jsc.hadoopConfiguration()
    for name in names:
        place = spark._jvm.org.apache.hadoop.fs.Path(name)
        try:
            found = place.getFileSystem(conf).globStatus(place)
        except Exception as error:  # an absent parent folder may be reported as an error
            if "FileNotFound" not in str(error):
                raise
            found = None
        (there if found else absent).append(name)
    return there, absent


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Names of what matches a pattern; nothing is read."""
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return [f.getPath().toString() for f in found or []]


def drop(spark: SparkSession, name: str) -> bool:
    """Delete a file or folder with all it holds; whether it was there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(name)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def write_new(spark: SparkSession, name: str, text: str) -> None:
    """Write a small file that isn't there yet; that it is there is an error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(name)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, name: str) -> str:
    """A small file's text."""
    place = spark._jvm.org.apache.hadoop.fs.Path(name)
    read = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(read)).decode()
    finally:
        read.close()


def escaped(spark: SparkSession, value: str) -> str:
    """A partition value as it is spelled in its folder's name."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
