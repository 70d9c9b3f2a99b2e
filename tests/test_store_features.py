"""Stores, streams, stage alignment, roll-up."""
import pytest
from pyspark.sql import functions as F

from cohortqc import schemas, sinks
from cohortqc.operators import features as X
from cohortqc.operators import status as ST
from cohortqc.operators import store as S
from cohortqc.session import path_exists
from cohortqc.sources import tables
from cohortqc.streaming.completion import CHANGES, latest_states, stream_states
from cohortqc.streaming.ingest import stream_all, stream_stage


def trim_rows(spark, *names):
    return spark.createDataFrame([(n, 10, 9, 1) for n in names], schemas.STAGES["atropos"])


def runs(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "srr string")


def keys(spark, path):
    return sorted(r.srr for r in tables.read_store(spark, path, "atropos").collect())


@pytest.mark.parametrize("way", ["batch", "stream"])
def test_append_once(spark, tmp_path, way):
    root, store = str(tmp_path), str(tmp_path / "atropos.parquet")
    sinks.write_stage(trim_rows(spark, "a", "b", "c", "d"), f"{root}/atropos", "atropos")

    def ingest():
        if way == "batch":
            S.append_new(spark, tables.read_done(spark, f"{root}/done"), f"{root}/atropos", store, "atropos")
        else:
            stream_stage(spark, "atropos", f"{root}/atropos", f"{root}/done", store,
                         f"{root}/checkpoint").awaitTermination()

    sinks.mark_done(runs(spark, "a", "b", "zz"), f"{root}/done")
    ingest()
    assert keys(spark, store) == ["a", "b"]
    sinks.mark_done(runs(spark, "b", "c"), f"{root}/done")
    ingest()
    ingest()
    assert keys(spark, store) == ["a", "b", "c"]


def test_late_stage_rows_reach_the_batch_store(spark, tmp_path):
    root, store = str(tmp_path), str(tmp_path / "atropos.parquet")
    done = runs(spark, "a", "b")
    sinks.write_stage(trim_rows(spark, "a"), f"{root}/atropos", "atropos")
    S.append_new(spark, done, f"{root}/atropos", store, "atropos")
    sinks.write_stage(trim_rows(spark, "b"), f"{root}/atropos", "atropos")
    S.append_new(spark, done, f"{root}/atropos", store, "atropos")
    assert keys(spark, store) == ["a", "b"]


def test_stream_and_batch_share_one_store(spark, tmp_path):
    root, store = str(tmp_path), str(tmp_path / "atropos.parquet")

    def stream():
        stream_stage(spark, "atropos", f"{root}/atropos", f"{root}/done", store, f"{root}/checkpoint").awaitTermination()

    sinks.write_stage(trim_rows(spark, "a"), f"{root}/atropos", "atropos")
    sinks.mark_done(runs(spark, "a", "b", "c"), f"{root}/done")
    stream()
    assert keys(spark, store) == ["a"]
    sinks.write_stage(trim_rows(spark, "b"), f"{root}/atropos", "atropos")  # after its run was done
    stream()
    assert keys(spark, store) == ["a", "b"]
    sinks.write_stage(trim_rows(spark, "c"), f"{root}/atropos", "atropos")
    for _ in range(2):
        S.append_new(spark, tables.read_done(spark, f"{root}/done"), f"{root}/atropos", store, "atropos")
    stream()
    assert keys(spark, store) == ["a", "b", "c"]


def test_the_same_batch_twice_is_there_once(spark, tmp_path):
    """Two jobs that saw the same store before either wrote, and a batch that is written again."""
    store = str(tmp_path / "atropos.parquet")
    rows = trim_rows(spark, "a", "b")
    for _ in range(2):
        sinks.write_batch(rows, store, "atropos", S.batch_id(rows))
    sinks.write_batch(trim_rows(spark, "c"), store, "atropos", S.batch_id(trim_rows(spark, "c")))
    assert keys(spark, store) == ["a", "b", "c"]
    assert tables.read_store(spark, store, "atropos").columns == schemas.STAGES["atropos"].names
    assert S.batch_id(trim_rows(spark, "b", "a")) == S.batch_id(rows) != S.batch_id(trim_rows(spark, "a"))
    assert S.batch_id(rows.where("false")) is None


def status_rows(spark, *rows):
    return spark.createDataFrame(rows, schemas.STATUS)


def test_newest_attempt_decides(spark):
    runs_ = runs(spark, "a", "b", "c", "d")
    status = status_rows(spark, ("a", "x", 1, "failed"), ("a", "x", 2, "ok"), ("a", "y", 1, "ok"), ("b", "x", 3, "bad"),
                         ("b", "x", 2, "ok"), ("b", "y", 1, "ok"), ("c", "x", 1, "ok"), ("c", "x", 1, "late failure"),
                         ("c", "y", 1, "ok"), ("c", "unknown", 1, "failed"))
    got = {r.srr: (r.state, r.failed, r.missing) for r in ST.run_states(runs_, status, ("x", "y")).collect()}
    assert got == {"a": ("done", [], []), "b": ("failed", ["x"], []), "c": ("failed", ["x"], []), "d": ("waiting", [], ["x", "y"])}


def test_states_as_a_stream(spark, tmp_path):
    """Rows out of order over three starts of one stream; what it said last is what the batch says."""
    root, waves = str(tmp_path), [
        [("a", "x", 2, "ok"), ("b", "x", 1, "failed"), ("c", "x", 1, "ok")],
        [("a", "x", 1, "failed"), ("a", "y", 1, "ok"), ("b", "y", 4, "ok"), ("b", "x", 2, "ok"), ("c", "z", 1, "failed")],
        [("c", "y", 1, "failed"), ("b", "x", 3, "failed"), ("a", "y", 1, "ok")]]
    heard = []
    for wave in waves:
        status_rows(spark, *wave).repartition(2).write.mode("append").parquet(f"{root}/status")
        stream_states(spark, f"{root}/status", f"{root}/changes", f"{root}/checkpoint", ("x", "y"), 1).awaitTermination()
        changes = spark.read.schema(CHANGES).parquet(f"{root}/changes")
        heard.append({r.srr: r.state for r in latest_states(changes).collect()})
    assert heard[1]["a"] == "done" and heard[1]["b"] == "done" and heard[2]["b"] == "failed" and heard[2]["c"] == "failed"
    everything = status_rows(spark, *[r for w in waves for r in w])
    batch = {r.srr: r.state for r in ST.run_states(runs(spark, "a", "b", "c"), everything, ("x", "y")).collect()}
    assert heard[2] == batch
    numbers = changes.groupBy("srr").agg(F.max("n").alias("m"), F.count("*").alias("k")).collect()
    assert all(r.m == r.k for r in numbers)


def test_no_empty_store(spark, tmp_path):
    S.append_all(spark, runs(spark, "a"), str(tmp_path))
    assert not path_exists(spark, str(tmp_path / "atropos.parquet"))


def test_one_file_per_run_folder(spark, tmp_path):
    import pandas as pd
    folder = tmp_path / "atropos"
    folder.mkdir()
    for name in ("r1", "r2"):
        pd.DataFrame({"total_processed": [5], "total_written": [4], "too_short": [1]}).to_parquet(
            folder / f"{name}.parquet")
    assert sorted(r.srr for r in tables.read_stage_folder(spark, str(folder), "atropos").collect()) == ["r1", "r2"]


def test_stream_of_all_stages(spark, tmp_path):
    root = str(tmp_path)
    sinks.write_stage(trim_rows(spark, "a", "b"), f"{root}/atropos", "atropos")
    sinks.write_stage(spark.createDataFrame([("a", "same_strand")], schemas.STAGES["strand"]), f"{root}/strand", "strand")
    sinks.mark_done(runs(spark, "a"), f"{root}/done")
    stream_all(spark, root, f"{root}/done", f"{root}/checkpoints")
    assert keys(spark, f"{root}/atropos.parquet") == ["a"]
    assert tables.read_store(spark, f"{root}/strand.parquet", "strand").count() == 1


def test_union_keeps_everything(spark):
    got = S.union_rows(runs(spark, "a", "b"), runs(spark, "b").withColumn("x", F.lit(1)))
    assert sorted((r.srr, r.x) for r in got.collect() if r.x is None) == [("a", None), ("b", None)]
    assert got.count() == 3


def test_done_list(spark, tmp_path):
    sinks.write_done_list(runs(spark, "a", "b", "a"), str(tmp_path / "done"))
    text = "".join(p.read_text() for p in (tmp_path / "done").glob("*.csv"))
    assert sorted(line.split("\t")[1] for line in text.splitlines() if "srr" not in line) == ["a", "b"]


def test_align_keeps_done_runs_only_and_refuses_duplicates(spark):
    tables_ = {"one": spark.createDataFrame([("a", 1), ("b", 2)], "srr string, x int"),
               "two": spark.createDataFrame([("b", 3), ("c", 4)], "srr string, y int")}
    assert sorted(tuple(r) for r in X.align(tables_).collect()) == [("a", 1, None), ("b", 2, 3), ("c", None, 4)]
    kept = X.align(tables_, keep=runs(spark, "b", "d"))
    assert sorted(tuple(r) for r in kept.collect()) == [("b", 2, 3), ("d", None, None)]
    tables_["two"] = tables_["two"].union(tables_["two"])
    with pytest.raises(Exception, match="more than one row for run"):
        X.align(tables_).collect()
    with pytest.raises(ValueError):
        X.align({"one": tables_["one"], "again": tables_["one"]})


def test_tertiles_count_nulls_as_zero(spark):
    df = spark.createDataFrame([("a", [1.0] * 101), ("b", [None] * 101), ("c", None)], schemas.STAGES["genebody_coverage"])
    got = {r.srr: (r.gene_body_five_prime, r.gene_body_middle, r.gene_body_three_prime)
           for r in X.gene_body_tertiles(df).collect()}
    assert got == {"a": (33.0, 35.0, 33.0), "b": (0.0, 0.0, 0.0), "c": (0.0, 0.0, 0.0)}


def test_roll_up_of_nothing(spark):
    columns = ", ".join(f"`{c}` double" for c in schemas.FEATURE_AGG)
    rows = spark.createDataFrame([("r1", "e1", *[None] * 21), ("r2", None, *[1.0] * 21)], f"srr string, srx string, {columns}")
    [row] = X.experiment_features(rows).collect()
    assert row.srx == "e1" and row.number_reads == 0.0 and row.percent_alignment is None
    assert X.experiment_features(rows).columns == ["srx", *schemas.FEATURES]


def test_streams_of_all_stages_run_side_by_side(spark, tmp_path, monkeypatch):
    from cohortqc.streaming import ingest
    told = []

    class Started:
        def __init__(self, stage):
            told.append(("start", stage))
            self.stage = stage

        def awaitTermination(self, timeout=None):
            told.append(("wait", self.stage))

    monkeypatch.setattr(ingest, "stream_stage", lambda spark, stage, *paths: Started(stage))
    ingest.stream_all(spark, str(tmp_path), f"{tmp_path}/done", f"{tmp_path}/checkpoints")
    assert told == [(what, stage) for what in ("start", "wait") for stage in schemas.STAGES]


def test_stage_views_from_shared_aggregates_are_those_of_the_sql(spark):
    from cohortqc.workload import views
    orders = [(1, "F", "5-LOW", 10.5), (1, "P", "1-URGENT", 7.25), (1, "P", "1-URGENT", 7.25), (2, None, None, None),
              (None, "O", "2-HIGH", 3.0), (None, "F", None, 400000.75), (3, "O", "3-MEDIUM", 0.5), (3, None, "4-NOT", -2.5)]
    spark.createDataFrame(orders, "o_custkey long, o_orderstatus string, o_orderpriority string, o_totalprice double"
                          ).createOrReplaceTempView("few_orders")

    def rows(text, among):
        above = ", ".join(f"{v} AS ({among[v].replace('FROM orders', 'FROM few_orders', 1) if v == 'orders_v' else among[v]})"
                          for v in views.needed((text,), among))
        return sorted(map(tuple, spark.sql(f"WITH {above} SELECT * FROM {text}").collect()), key=str)

    for name in set(views._FROM_RUNS) & set(views.VIEWS):
        assert rows(name, views.SPARK_VIEWS) == rows(name, views.VIEWS), name
    assert "run_sums_v" in views.needed(("hisat2_v",), views.SPARK_VIEWS)
