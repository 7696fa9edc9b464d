"""Delimited text: semicolon and decimal comma by default, any directory size."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closebook.functions import money
from closebook.sources.tables import FILE_ROWS, gathered


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def typed(raw: DataFrame, schema: str, decimal: str = ",") -> DataFrame:
    """All-text columns -> the declared types, taken by name."""
    declared = T.StructType.fromDDL(schema)
    missing = [f.name for f in declared if f.name not in raw.columns]
    if missing:
        raise ValueError(f"columns not in the file: {missing}")
    columns = []
    for field in declared:
        text = F.col(_quoted(field.name))
        if isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            if decimal == ",":
                text = money.point_text(text)
            value = text.cast(field.dataType)
            if not isinstance(field.dataType, T.DecimalType):
                value = money.null_if_nan(value)
        else:
            value = text.cast(field.dataType)
        columns.append(value.alias(field.name))
    return raw.select(*columns)


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: str,
    sep: str = ";",
    decimal: str = ",",
) -> DataFrame:
    """File or folder with a header line; columns are found by name.

    Every file's header is checked against the first one, and a row with too
    many or too few fields stops the job instead of shifting amounts.
    """
    raw = spark.read.csv(
        path, sep=sep, header=True, mode="FAILFAST", enforceSchema=False
    )
    return typed(raw, schema, decimal)


def field_names(dictionary: DataFrame, position: str = "Position") -> list[str]:
    """Technical names of a field dictionary by their position in the file.

    A dictionary has one row per column of the file.
    """
    rows = dictionary.select("Field", position).orderBy(position).collect()
    places = [row[position] for row in rows]
    if None in places or len(set(places)) < len(places):
        raise ValueError("each field of a dictionary needs a position of its own")
    return [row["Field"] for row in rows]


def read_headerless(
    spark: SparkSession, path: str | list[str], names: Iterable[str], sep: str = ";"
) -> DataFrame:
    """Files without a header, every column text, names given from outside."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.csv(path, sep=sep, header=False, schema=schema, mode="FAILFAST")


def rename_by_dictionary(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Technical names -> business names; names not listed stay.

    Only the entries for the file's own columns are fetched.
    """
    own = F.col("Field").isin(df.columns)
    pairs = dictionary.select("Field", "Name").filter(own).collect()
    return df.withColumnsRenamed({row["Field"]: row["Name"] for row in pairs})


def with_source(df: DataFrame, length: int | None = None) -> DataFrame:
    """Provenance column ``src``: the file name or its first characters."""
    name = F.col("_metadata.file_name")
    return df.withColumn("src", name if length is None else F.substring(name, 1, length))


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str = ";",
    decimal: str = ",",
    mode: str = "errorifexists",
    file_rows: int = FILE_ROWS,
) -> None:
    """A file with a header for each task and ``file_rows`` rows; amounts exact and in plain notation."""
    columns = []
    for field in df.schema:
        value = F.col(_quoted(field.name))
        fractional = isinstance(
            field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)
        )
        if fractional and decimal == ",":
            value = money.to_decimal_comma(value)
        columns.append(value.alias(field.name))
    writer = df.select(*columns).write.option("maxRecordsPerFile", file_rows)
    writer.csv(path, sep=sep, header=True, mode=mode)


def write_by_source(
    df: DataFrame, path: str, sep: str = ";", mode: str = "errorifexists", file_rows: int = FILE_ROWS
) -> None:
    """Files of at most ``file_rows`` rows with a header, in one folder for each value of ``src``."""
    writer = gathered(df, ["src"]).write.option("maxRecordsPerFile", file_rows)
    writer.partitionBy("src").csv(path, sep=sep, header=True, mode=mode)
