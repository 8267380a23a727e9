"""Running a stream over what has arrived, into files of the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickspark.sources.shared import shared_path

BATCH_COLUMN = "batch"


def start_batches(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    of_batch: Callable[[DataFrame], DataFrame] = lambda df: df,
    output_mode: str = "append",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write ``of_batch`` of every micro-batch to ``out/batch=<id>``.

    A batch that is run again after a failure replaces its own folder, so each
    counts once.
    """

    def write(df: DataFrame, batch: int) -> None:
        of_batch(df).write.mode("overwrite").parquet(f"{out}/{BATCH_COLUMN}={batch}")

    return (
        stream.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(write)
        .start()
    )


def start_quarantined(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    corrupt: str,
    of_batch: Callable[[DataFrame], DataFrame] = lambda df: df,
    trigger: dict | None = None,
) -> StreamingQuery:
    """``start_batches`` for rows without a broken line; rows with one (``corrupt`` is
    not null) go to ``read_quarantine``. A batch is parsed once and written by kind;
    run again, it replaces its rows of either kind."""

    def write(df: DataFrame, batch: int) -> None:
        lines = f"{out}/lines/{BATCH_COLUMN}={batch}"
        kind = F.when(F.col(corrupt).isNull(), "good").otherwise("broken")
        df.withColumn("__kind", kind).write.mode("overwrite").partitionBy("__kind").parquet(lines)
        read = df.sparkSession.read.schema(df.schema.add("__kind", "string")).parquet(lines)
        good = read.where("__kind = 'good'").drop("__kind", corrupt)
        of_batch(good).write.mode("overwrite").parquet(f"{out}/results/{BATCH_COLUMN}={batch}")

    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(write)
        .start()
    )


def read_quarantine(spark: SparkSession, out: str, columns: list[str]) -> DataFrame:
    """The broken lines of ``start_quarantined``, with their ``batch``; of the other
    columns those that a line has all the same, such as the file."""
    rows = spark.read.parquet(f"{out}/lines").where("__kind = 'broken'")
    return rows.select(*columns, BATCH_COLUMN)


def read_results(spark: SparkSession, out: str) -> DataFrame:
    """What ``of_batch`` made of the other rows."""
    return read_batches(spark, f"{out}/results")


_MERGED = "_merged"  # no reader takes a folder of this name for data


def _folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the folders ``<prefix><number>`` whose writing has ended."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []
    names = [s.getPath().getName() for s in system.listStatus(root)]
    numbers = (int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))
    return sorted(n for n in numbers if system.exists(hadoop.Path(f"{path}/{prefix}{n}/_SUCCESS")))


def _removed(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def compact(
    spark: SparkSession,
    out: str,
    keep: int = 10,
    of_parts: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> int | None:
    """Merge all batches of ``out`` but the last ``keep`` into one versioned part.

    A query that restarts runs its last batch again and no earlier one, so the
    merged batches (``keep`` is 1 or more) never come again. ``of_parts`` is applied
    to the rows of the last version and of the batches: it must give the same from
    what it made before, as sums do. The new version is whole before what it replaces
    goes, and readers take the highest that is whole and only batches above it, so
    that a run that breaks off at any point does no harm and may be repeated. Returns
    the last batch that is merged, if there is any.
    """
    if keep < 1:
        raise ValueError("the last batch may run again and cannot be merged")
    batches, versions = _folders(spark, out, f"{BATCH_COLUMN}="), _folders(spark, f"{out}/{_MERGED}", "upto=")
    due = [b for b in batches[:-keep] if not versions or b > versions[-1]]
    if due:
        rows = read_batches(spark, out, upto=due[-1])
        of_parts(rows).write.mode("overwrite").parquet(f"{out}/{_MERGED}/upto={due[-1]}")
        versions = [*versions, due[-1]]
    for batch in batches:
        if versions and batch <= versions[-1]:
            _removed(spark, f"{out}/{BATCH_COLUMN}={batch}")
    for version in versions[:-1]:
        _removed(spark, f"{out}/{_MERGED}/upto={version}")
    return versions[-1] if versions else None


def read_batches(
    spark: SparkSession, out: str, last_only: bool = False, upto: int | None = None
) -> DataFrame:
    """What ``start_batches`` wrote and ``compact`` merged, to batch ``upto`` if given.
    ``last_only`` for the complete output mode, in which each batch holds the whole
    result."""
    versions = _folders(spark, f"{out}/{_MERGED}", "upto=")
    if versions:
        batches = _folders(spark, out, f"{BATCH_COLUMN}=")
        above = [b for b in batches if b > versions[-1] and (upto is None or b <= upto)]
        paths = [f"{out}/{_MERGED}/upto={versions[-1]}", *(f"{out}/{BATCH_COLUMN}={b}" for b in above)]
        return spark.read.parquet(*paths)
    rows = spark.read.parquet(out)
    if upto is not None:
        rows = rows.where(rows[BATCH_COLUMN] <= upto)
    if last_only:
        last = rows.agg({BATCH_COLUMN: "max"}).first()[0]
        rows = rows.where(rows[BATCH_COLUMN] == last)
    return rows.drop(BATCH_COLUMN)


def run_available(
    spark: SparkSession,
    stream: DataFrame,
    name: str,
    of_batch: Callable[[DataFrame], DataFrame] = lambda df: df,
    output_mode: str = "append",
) -> DataFrame:
    """Process everything that has arrived, stop, and return the result."""
    base = shared_path(spark, name)
    query = start_batches(
        stream, f"{base}/out", f"{base}/checkpoint", of_batch, output_mode
    )
    query.awaitTermination()
    return read_batches(spark, f"{base}/out", last_only=output_mode == "complete")
