"""Incremental ingest as streams; batch and stream share one store, a plain Parquet table."""
from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession

from cohortqc import schemas
from cohortqc.operators.store import append_new
from cohortqc.session import path_exists
from cohortqc.sources.tables import read_done


def arrivals(spark: SparkSession, schema, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of the keys that arrive in a table."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).select("srr")


def stream_stage(spark: SparkSession, stage: str, folder_path: str, done_path: str, store_path: str,
                 checkpoint_path: str, max_files: int | None = None):
    """Append the stage rows of finished runs to the store; returns the started query.

    New files in the done table or in the stage folder start a batch; a batch takes whatever the store lacks of all
    finished runs, so a stage row that arrives after its run is done is taken too, and a repeated batch adds nothing.
    No keyed state is held. ``availableNow`` works off what is there and stops; the checkpoint makes the next call go
    on from there.
    """
    keys = arrivals(spark, schemas.DONE, done_path, max_files)
    if path_exists(spark, folder_path):
        keys = keys.unionByName(arrivals(spark, schemas.STAGES[stage], folder_path, max_files))

    def take(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        append_new(session, read_done(session, done_path), folder_path, store_path, stage)

    return (keys.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint_path)
            .trigger(availableNow=True).start())


def stream_all(spark: SparkSession, root: str, done_path: str, checkpoint_root: str, timeout: int | None = None) -> None:
    """One pass over all ten stages. Their streams run side by side, each with a store and a checkpoint of its own; a
    stream that fails stops the call once the others were waited for."""
    queries = [stream_stage(spark, stage, f"{root}/{stage}", done_path, f"{root}/{stage}.parquet",
                            f"{checkpoint_root}/{stage}") for stage in schemas.STAGES]
    failed = []
    for query in queries:
        try:
            query.awaitTermination(timeout)
        except StreamingQueryException as error:
            failed.append(error)
    if failed:
        raise failed[0]
