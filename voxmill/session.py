"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Event times are zone-free, so the session zone only
# matters for "now" columns; AQE picks partition counts and splits skewed join sides.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    A local master may go without it (tests); on a cluster a machine-local folder
    would not survive the loss of an executor, so there the setting is required.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="voxmill-"))
    return context.getCheckpointDir()


_WRITTEN: list[str] = []  # intermediate tables of this driver that nobody has removed yet


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables that are written inside are removed at the end.

    Results are lazy and read these tables, so they have to be written or counted inside.
    """
    before = len(_WRITTEN)
    try:
        yield
    finally:
        jvm, configuration = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in _WRITTEN[before:]:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(configuration).delete(place, True)
        del _WRITTEN[before:]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/voxmill-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
