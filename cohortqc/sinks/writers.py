"""All output goes through Spark's writers; nothing is written per run by hand."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortqc import schemas
from cohortqc.operators.alignments import coordinate_sort


def _typed(rows: DataFrame, stage: str) -> DataFrame:
    return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schemas.STAGES[stage].fields])


def write_stage(rows: DataFrame, path: str, stage: str) -> None:
    """Append the rows of many runs to a stage table, cast to the stage's schema."""
    _typed(rows, stage).write.mode("append").parquet(path)


def write_batch(rows: DataFrame, path: str, stage: str, batch: str) -> None:
    """Put the rows of one batch into a stage store. A batch has a folder of its own, and writing it replaces that
    folder only: the same batch written twice, or by two jobs at once, is there once."""
    (_typed(rows, stage).withColumn("batch", F.lit(batch)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path))


def write_status(rows: DataFrame, path: str) -> None:
    """Append to the status table."""
    rows.write.mode("append").parquet(path)


def write_features(features: DataFrame, path: str) -> None:
    """The feature matrix in key order (first column)."""
    features.orderBy(features.columns[0]).write.mode("overwrite").parquet(path)


def write_result_csv(result: DataFrame, path: str) -> None:
    """The labelled result as CSV with header, key column first."""
    result.write.mode("overwrite").option("header", True).csv(path)


def fastq_text(reads: DataFrame) -> DataFrame:
    """Four lines per read in one string column, for a text sink that adds the last line break."""
    return reads.select("srr", "mate", F.concat_ws("\n", "h1", "seq", "h2", "qual").alias("value"))


def write_clean_fastq(reads: DataFrame, path: str, compression: str = "gzip", partitions: int | None = None) -> None:
    """FASTQ text in ``srr=…/mate=…`` folders. Mates stay aligned by sorting on the read number inside each file.

    Range-partitioning on (run, mate, read number) spreads a large run over many files instead of one task. AQE goes by bytes
    and leaves very many small runs to a few tasks; ``partitions`` gives a number.
    """
    keys = ["srr", "mate", "read_no"]
    ranged = reads.repartitionByRange(partitions, *keys) if partitions else reads.repartitionByRange(*keys)
    ordered = ranged.sortWithinPartitions(*keys)
    fastq_text(ordered).write.mode("overwrite").partitionBy("srr", "mate").text(path, compression=compression)


def mark_done(runs: DataFrame, path: str) -> None:
    """Append finished runs to the done table."""
    runs.select("srr", F.current_timestamp().alias("finished_at")).write.mode("append").parquet(path)


def sorted_files(rows: int, per_file: int = 1_000_000, least: int = 12) -> int:
    """How many files a sorted table of so many rows gets: a task sorts one file, whatever the size of the table."""
    return max(least, -(-rows // per_file))


def write_sorted(alignments: DataFrame, path: str, partitions: int | None = None) -> None:
    """Alignments in coordinate order: file by file in ranges, sorted inside each file, so a reader of one region skips
    all other files and row groups by their statistics."""
    coordinate_sort(alignments, partitions).write.mode("overwrite").parquet(path)


def order_breaks(spark, path: str, keys: list[str]) -> DataFrame:
    """How a written table departs from the order of ``keys``: ``inside``, rows that come before their predecessor in
    the same file, and ``between``, files that begin before the file in front of them ends; files count in the order of
    their names. Nothing is sorted: places in the files are compared."""
    rows = spark.read.parquet(path).select(F.col("_metadata.file_name").alias("file"),
                                           F.col("_metadata.row_index").alias("at"), F.struct(*keys).alias("key"))
    in_file = W.partitionBy("file").orderBy("at")
    inside = F.count_if(F.col("key") < F.col("before"))
    files = rows.withColumn("before", F.lag("key").over(in_file)).groupBy("file").agg(
        inside.alias("inside"), F.min("key").alias("low"), F.max("key").alias("high"))
    # one row per file
    order = W.orderBy("file")
    return files.withColumn("last", F.max("high").over(order.rowsBetween(W.unboundedPreceding, -1))).agg(
        F.sum("inside").alias("inside"), F.count_if(F.col("low") < F.col("last")).alias("between"))


def write_done_list(done: DataFrame, path: str) -> None:
    """The done list as TSV with a leading unnamed number column."""
    (done.select("srr").distinct().select(F.monotonically_increasing_id().alias(" "), "srr")
     .withColumnRenamed(" ", "").write.mode("overwrite").option("header", True).option("sep", "\t").csv(path))
