"""What the operators of this package share: tables, hand-overs, free names, hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.session import fresh_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written once to the shared folder and read back, and its path, for ``remove``.

    Cuts the lineage, survives lost executors, and gives later joins the real
    size of the data.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def hand_over(df: DataFrame, name: str) -> DataFrame:
    """``written`` for as long as the session lasts."""
    return written(df, name)[0]


def small_batches(spark: SparkSession) -> None:
    """Rows and bytes of text that go to Python at once.

    Bounds what a worker and its executor hold beside the heap; long texts count by bytes.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def free_prefix(*frames: DataFrame) -> str:
    """A prefix no column of the frames starts with, for working columns."""
    taken = {name.lower() for df in frames for name in df.columns}
    prefix = "_w_"
    while any(name.startswith(prefix) for name in taken):
        prefix = "_" + prefix
    return prefix


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns whose names an operator is going to write."""
    gone = {name.lower() for name in names}
    return df.select(*[df[name] for name in df.columns if name.lower() not in gone])


def text_key(value: Column) -> Column:
    """A string that is never null: equal for equal values, of its own for null."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def unit(hashed: Column) -> Column:
    """A 64-bit hash as a double in [0, 1)."""
    return F.shiftrightunsigned(hashed, 11).cast("double") * F.lit(2.0**-53)


def fold_of(key: Column) -> Column:
    """crc32 of the key's text modulo 5; null keys count as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 5


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate files that nothing reads any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
