"""Reading raw events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.schema import CLICK_SCHEMA, FILE_COLUMN


def read_clicks(
    spark: SparkSession,
    path: str | list[str],
    by_file: bool = True,
    schema: T.StructType = CLICK_SCHEMA,
    full_path: bool = True,
    corrupt: str | None = None,
) -> DataFrame:
    """JSON lines, gzipped or not, as a table of clicks.

    The schema is given, so there is no inference pass over the files. Whole
    numbers may be written as such, with decimals or in quotes; what is none is
    null. Lines that do not parse become rows of nulls, as permissive reading has
    it, and are kept in the column ``corrupt`` if it is named. ``by_file`` adds
    the path of the file as a column, or its name alone without ``full_path``,
    if names do not repeat between folders.
    """
    reader = spark.read.schema(_as_text(schema, corrupt)).option("mode", "PERMISSIVE")
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    clicks = reader.json(path)
    columns = [*_numbers(schema), *([F.col(corrupt)] if corrupt else [])]
    if by_file:
        columns.append(_source(full_path))
    return clicks.select(*columns)


def input_files(spark: SparkSession, path: str | list[str], full_path: bool = True) -> DataFrame:
    """A row (``file``) for each file that ``read_clicks`` finds there, also for those
    without a line or a byte. They come from the listing that Spark's driver makes of
    any input; none is opened."""
    names = spark.read.format("binaryFile").load(path).inputFiles()
    found = spark.createDataFrame([(n,) for n in names], f"{FILE_COLUMN} string")
    # As rows name their file: a local one with a single slash.
    name = F.regexp_replace(FILE_COLUMN, "^([A-Za-z0-9+.-]+):///", "$1:/")
    return found.select((name if full_path else F.substring_index(name, "/", -1)).alias(FILE_COLUMN)).distinct()


def _as_text(schema: T.StructType, corrupt: str | None = None) -> T.StructType:
    """``schema`` with whole numbers as they stand in the file."""
    fields = [
        T.StructField(f.name, T.StringType() if f.dataType == T.LongType() else f.dataType)
        for f in schema.fields
    ]
    return T.StructType(fields + ([T.StructField(corrupt, T.StringType())] if corrupt else []))


def _numbers(schema: T.StructType) -> list[Column]:
    """The columns of ``schema``, numbers read from their text."""
    return [
        F.expr(f"try_cast(try_cast(`{f.name}` as decimal(38,9)) as bigint)").alias(f.name)
        if f.dataType == T.LongType()
        else F.col(f"`{f.name}`")
        for f in schema.fields
    ]


def _source(full_path: bool) -> Column:
    return F.col("_metadata.file_path" if full_path else "_metadata.file_name").alias(FILE_COLUMN)


def stream_clicks(
    spark: SparkSession,
    path: str,
    by_file: bool = True,
    schema: T.StructType = CLICK_SCHEMA,
    files_per_batch: int = 1,
    full_path: bool = True,
    corrupt: str | None = None,
) -> DataFrame:
    """The same files as a stream, in arrival order. Broken lines are kept in the
    column ``corrupt``, if it is named; ``quarantine`` has a sink for them."""
    reader = spark.readStream.schema(_as_text(schema, corrupt))
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    clicks = reader.option("maxFilesPerTrigger", files_per_batch).json(path)
    kept = [F.col(corrupt)] if corrupt else []
    return clicks.select(*_numbers(schema), *kept, *([_source(full_path)] if by_file else []))


def read_saved(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Read back events saved as JSON. Without ``schema`` types are inferred:
    times come back as text, columns in alphabetical order, and a column that
    held nothing but nulls is missing."""
    reader = spark.read
    return (reader.schema(schema) if schema is not None else reader).json(path)
