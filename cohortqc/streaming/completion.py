"""Runs that become complete, as a stream: a keyed state machine over status rows.

The state of a run is the newest attempt at each of its stages (a dozen rows at most) and what was last said about it.
Rows may come in any order and any batch; an older attempt never undoes a newer one. State lives in RocksDB with the
checkpoint, so a stopped stream goes on where it was.
"""
from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cohortqc import schemas
from cohortqc.operators.status import DONE, FAILED, OK, REQUIRED, WAITING

CHANGES = "srr string, n int, state string, failed array<string>"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class RunProgress(StatefulProcessor):
    """Emits a run whenever it becomes done or failed, or waits again after a failure was mended; ``n`` counts what was
    said about it."""

    def __init__(self, required: tuple[str, ...]):
        self.required = required

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.stages = handle.getMapState("stages", "stage string", "attempt bigint, status string")
        self.said = handle.getValueState("said", "n int, state string, failed string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest = {}
        for batch in rows:
            for stage, attempt, status in zip(batch["stage"], batch["attempt"], batch["status"]):
                rank = (int(attempt), status != OK, status)
                if stage in self.required and rank > newest.get(stage, (-1,)):
                    newest[stage] = rank
        for stage, rank in newest.items():
            old = self.stages.getValue((stage,)) if self.stages.containsKey((stage,)) else None
            if old is None or rank > (int(old[0]), old[1] != OK, old[1]):
                self.stages.updateValue((stage,), (rank[0], rank[2]))
        held = {k[0]: v[1] for k, v in self.stages.iterator()}
        failed = sorted(stage for stage, status in held.items() if status != OK)
        state = FAILED if failed else DONE if len(held) == len(self.required) else WAITING
        n, before, before_failed = self.said.get() if self.said.exists() else (0, WAITING, "")
        if (state, ",".join(failed)) != (before, before_failed):
            self.said.update((n + 1, state, ",".join(failed)))
            yield pd.DataFrame({"srr": [key[0]], "n": [n + 1], "state": [state], "failed": [failed]})

    def close(self) -> None:
        pass


def stream_states(spark: SparkSession, status_path: str, out_path: str, checkpoint_path: str,
                  required: tuple[str, ...] = REQUIRED, max_files: int | None = None):
    """Append the changes of state that new status rows bring to ``out_path``; returns the started query.

    ``availableNow`` works off what is there and stops; the next call goes on from the checkpoint.
    """
    # set at the session: the provider of a stream is taken from it when the stream starts
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    reader = spark.readStream.schema(schemas.STATUS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    changes = reader.parquet(status_path).groupBy("srr").transformWithStateInPandas(
        RunProgress(required), outputStructType=CHANGES, outputMode="Append", timeMode="None")
    return (changes.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint_path)
            .outputMode("append").trigger(availableNow=True).start())


def latest_states(changes: DataFrame) -> DataFrame:
    """srr, state, failed: what was said last about every run."""
    return changes.groupBy("srr").agg(F.max(F.struct("n", "state", "failed")).alias("last")).select(
        "srr", "last.state", "last.failed")
