"""Incremental stage stores: what is pending, what is new, append without rewriting."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortqc import schemas
from cohortqc.sinks.writers import write_batch
from cohortqc.sources.tables import read_stage_folder, read_store


def pending_runs(manifest: DataFrame, done: DataFrame) -> DataFrame:
    return manifest.join(done.select("srr"), "srr", "left_anti").select(*manifest.columns)


def resume(runs: DataFrame, stage_rows: DataFrame) -> DataFrame:
    """Runs that still lack a row of this stage."""
    return runs.join(stage_rows.select("srr"), "srr", "left_anti").select(*runs.columns)


def store_keys(store: DataFrame) -> DataFrame:
    return store.select("srr").distinct()


def new_keys(done: DataFrame, folder: DataFrame, store: DataFrame) -> DataFrame:
    """done ∩ (folder − store), as set operations on keys."""
    return done.select("srr").intersect(folder.select("srr").subtract(store.select("srr")))


def new_samples(folder: DataFrame, done: DataFrame, store: DataFrame) -> DataFrame:
    """Folder rows of done runs that the store does not hold yet."""
    return (folder.join(done.select("srr"), "srr", "left_semi")
            .join(store.select("srr"), "srr", "left_anti").select(*folder.columns))


def union_rows(store: DataFrame, new: DataFrame) -> DataFrame:
    """Append by name, missing columns null, nothing removed."""
    return store.unionByName(new, allowMissingColumns=True)


def batch_id(rows: DataFrame) -> str | None:
    """A name for a batch that depends on its runs alone, whatever their order; None for no runs."""
    runs = rows.select("srr").distinct().agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("srr")).alias("a"), F.bit_xor(F.xxhash64(F.lit(1), "srr")).alias("b")).first()
    return f"{runs['n']}-{runs['a'] & (2 ** 64 - 1):016x}{runs['b'] & (2 ** 64 - 1):016x}" if runs["n"] else None


def append_new(spark: SparkSession, done: DataFrame, folder_path: str, store_path: str, stage: str) -> None:
    """Add the new rows of one stage to its store, as one batch named after its runs. Other batches are never rewritten;
    the same batch again, from a job that is repeated or runs at the same time, replaces its own files.

    No store is created when there is nothing to put into it.
    """
    new = new_samples(read_stage_folder(spark, folder_path, stage), done, read_store(spark, store_path, stage))
    batch = batch_id(new)
    if batch is not None:
        write_batch(new, store_path, stage, batch)


def append_all(spark: SparkSession, done: DataFrame, root: str) -> None:
    """All ten stages: ``<root>/<stage>/`` into ``<root>/<stage>.parquet``."""
    for stage in schemas.STAGES:
        append_new(spark, done, f"{root}/{stage}", f"{root}/{stage}.parquet", stage)


def duplicate_keys(store: DataFrame) -> DataFrame:
    """Keys that a store holds more than once."""
    return store.groupBy("srr").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
