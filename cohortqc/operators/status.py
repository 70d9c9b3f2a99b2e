"""Which runs are done: attempts at stages, the state of a run, what is still missing.

The status table is only appended to: (srr, stage, attempt, status). The newest attempt at a stage decides, whatever
came before and in whatever order rows arrive; of two rows for one attempt a failure decides. A run is done only when
every required stage reported and its newest attempt is ok, so a missing log is never taken for success and a repeated
run can become done.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortqc import schemas

OK = "ok"
DONE, FAILED, WAITING = "done", "failed", "waiting"
REQUIRED = tuple(sorted(schemas.STAGES))


def merged(status: DataFrame) -> DataFrame:
    """One row per run, stage and attempt: a failure beats ok."""
    worst = F.max(F.struct((F.col("status") != OK).alias("bad"), "status"))
    return status.groupBy("srr", "stage", "attempt").agg(worst.alias("_worst")).select(
        "srr", "stage", "attempt", F.col("_worst.status").alias("status"))


def latest(status: DataFrame) -> DataFrame:
    """srr, stage, attempt, status: what counts for every run and stage. A combining aggregate."""
    order = F.max(F.struct("attempt", (F.col("status") != OK).alias("bad"), "status"))
    return status.groupBy("srr", "stage").agg(order.alias("_last")).select(
        "srr", "stage", F.col("_last.attempt").alias("attempt"), F.col("_last.status").alias("status"))


def present(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows that stand in stage tables as attempt 0: a stage whose log says nothing is done when its row is there, and
    any explicit report overrules it."""
    rows = [df.select("srr", F.lit(name).alias("stage"), F.lit(0).cast("bigint").alias("attempt"), F.lit(OK).alias("status"))
            for name, df in stages.items()]
    return reduce(DataFrame.unionByName, rows).distinct()


def _state(failed: Column, n_ok: Column, required: tuple[str, ...]) -> Column:
    return F.when(F.size(failed) > 0, FAILED).when(n_ok == len(required), DONE).otherwise(WAITING)


def run_states(runs: DataFrame, status: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """srr, state, failed, missing: one row for each of ``runs``, also for those that reported nothing. ``failed`` and
    ``missing`` are sorted stage names; stages that are not required do not count."""
    newest = latest(status.where(F.col("stage").isin(*required)))
    ok = F.col("status") == OK
    by_run = newest.groupBy("srr").agg(
        F.sort_array(F.collect_set(F.when(~ok, F.col("stage")))).alias("failed"), F.collect_set("stage").alias("_seen"),
        F.count_if(ok).alias("_ok"))
    none = F.array().cast("array<string>")
    joined = runs.select("srr").distinct().join(by_run, "srr", "left").select(
        "srr", F.coalesce("failed", none).alias("failed"), F.coalesce("_seen", none).alias("_seen"),
        F.coalesce("_ok", F.lit(0)).alias("_ok"))
    needed = F.array(*[F.lit(s) for s in sorted(required)])
    return joined.select("srr", _state(F.col("failed"), F.col("_ok"), required).alias("state"), "failed",
                         F.array_except(needed, "_seen").alias("missing"))


def unrecorded(status: DataFrame, known: DataFrame) -> DataFrame:
    """Rows that the table lacks, so a repeated call appends nothing."""
    key = [f.name for f in schemas.STATUS.fields]
    return status.select(*key).distinct().join(known, key, "left_anti")
