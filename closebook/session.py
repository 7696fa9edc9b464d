"""Session settings and the shared folder for data that outlives a stage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the engine is written for. All but the time zone are
# defaults of Spark 4; they are named so that a cluster profile that turns
# them off is noticed.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, which all executors share.

    Where it is unset, a local master (tests, trials) uses a folder in the warehouse;
    a cluster is refused, because a folder of one machine would not do.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    held = spark.sparkContext.getCheckpointDir()
    if held:
        return held.rsplit("/", 1)[0]
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/shared"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder, deleted when the session's JVM ends."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # Only a path that exists can be marked; whoever writes it wants it to be new.
    system.mkdirs(place)
    system.deleteOnExit(place)
    system.delete(place, True)
    return path


def cut_lineage(df: DataFrame, name: str = "hand-off") -> DataFrame:
    """Computed once and written to the shared folder: read back after an executor loss,
    and its size is known to later joins."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
