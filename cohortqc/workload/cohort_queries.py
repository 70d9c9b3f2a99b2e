"""Manifest, stores, stage alignment, features."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortqc import schemas, sinks
from cohortqc.operators import features as X
from cohortqc.operators import store as S
from cohortqc.plans import jobs
from cohortqc.session import empty, shared_folder
from cohortqc.sources import tables
from cohortqc.streaming.ingest import stream_all, stream_stage
from cohortqc.workload.registry import query, rounded
from cohortqc.workload.views import ctes, load

STAGE_VIEWS = ("layout_v", "fastq_screen_v", "atropos_v", "hisat2_v", "aln_stats_v", "rnaseqmetrics_v",
               "markduplicates_v", "count_summary_v")


# the stages that lack runs in the views with gaps
GAPS = ("atropos", "hisat2", "aln_stats", "rnaseqmetrics", "markduplicates", "count_summary", "genebody_coverage")


def _view(stage: str, gaps: bool) -> str:
    name = "coverage" if stage == "genebody_coverage" else stage
    return f"{name}_gaps_v" if gaps and stage in GAPS else f"{name}_v"


def stages(spark: SparkSession, sf: str, gaps: bool = False) -> dict[str, DataFrame]:
    names = [*[name[:-2] for name in STAGE_VIEWS], "genebody_coverage"]
    out = {name: load(spark, sf, _view(name, gaps)) for name in names}
    out["aln_stats"] = out["aln_stats"].withColumnRenamed("percent_reverse", "Percent Reverse")
    return out


def workflow(spark: SparkSession, sf: str, gaps: bool = False) -> DataFrame:
    return X.workflow_table(stages(spark, sf, gaps), load(spark, sf, "done_v"), load(spark, sf, "manifest_v"))


_TERTILES = """tertiles AS (
    SELECT srr, coalesce(list_sum(coverage[1:33]), 0) AS gene_body_five_prime,
           coalesce(list_sum(coverage[34:68]), 0) AS gene_body_middle,
           coalesce(list_sum(coverage[69:101]), 0) AS gene_body_three_prime
    FROM coverage_v)"""


def _workflow_sql(gaps: bool = False) -> str:
    v = lambda stage: _view(stage, gaps)
    views = ctes(*[v(name[:-2]) for name in STAGE_VIEWS], v("genebody_coverage"), "manifest_v", "done_v")
    return views + ", " + _TERTILES.replace("coverage_v", v("genebody_coverage")) + f""", workflow AS (
    SELECT d.srr, m.srx, f.pct_reads_mapped AS percent_rrna_reads, t.too_short AS number_reads_too_short,
           h.num_reads AS number_reads, h.num_multimappers AS number_multimapping_reads,
           h.per_alignment AS percent_alignment, a.reads_MQ0, a.average_quality, a.percent_reverse,
           r.percent_utr_bases, r.percent_intronic_bases, r.percent_intergenic_bases, r.percent_mrna_bases,
           r.median_cv_coverage, u.percent_duplication, c.number_genic_reads, c.percent_genes_on,
           c.number_junction_reads, c.number_junctions_on, coalesce(g.gene_body_five_prime, 0) AS gene_body_five_prime,
           coalesce(g.gene_body_middle, 0) AS gene_body_middle,
           coalesce(g.gene_body_three_prime, 0) AS gene_body_three_prime
    FROM done_v d LEFT JOIN fastq_screen_v f ON d.srr = f.srr AND f.reference = 'rRNA'
    LEFT JOIN {v("atropos")} t ON d.srr = t.srr LEFT JOIN {v("hisat2")} h ON d.srr = h.srr
    LEFT JOIN {v("aln_stats")} a ON d.srr = a.srr LEFT JOIN {v("rnaseqmetrics")} r ON d.srr = r.srr
    LEFT JOIN {v("markduplicates")} u ON d.srr = u.srr LEFT JOIN {v("count_summary")} c ON d.srr = c.srr
    LEFT JOIN tertiles g ON d.srr = g.srr LEFT JOIN manifest_v m ON d.srr = m.srr)"""


_WORKFLOW = _workflow_sql()

_SUMS = [schemas.FEATURE_RENAME.get(n, n) for n, how in schemas.FEATURE_AGG.items() if how == "sum"]


def _feature_sql(group: bool, gaps: bool = False) -> str:
    def column(name: str) -> str:
        if not group:
            return f"round(CAST({name} AS DOUBLE), 6) AS {name}"
        if name in _SUMS:
            return f"round(CAST(coalesce(sum({name}), 0) AS DOUBLE), 6) AS {name}"
        return f"round(avg(CAST({name} AS DOUBLE)), 6) AS {name}"

    columns = ", ".join(column(n) for n in schemas.FEATURES)
    if group:
        return f"WITH {_workflow_sql(gaps)} SELECT srx, {columns} FROM workflow WHERE srx IS NOT NULL GROUP BY srx"
    return f"WITH {_workflow_sql(gaps)} SELECT srr, {columns} FROM workflow"


@query("experiment_features", _feature_sql(group=True))
def experiment_features(spark, sf):
    return rounded(X.experiment_features(workflow(spark, sf)))


@query("run_features", _feature_sql(group=False))
def run_features(spark, sf):
    return rounded(X.run_features(workflow(spark, sf)))


@query("features_sink", f"""WITH {_WORKFLOW} SELECT count(DISTINCT srx) AS n, min(srx) AS first_key, max(srx) AS last_key,
    0 AS inside, 0 AS between FROM workflow""")
def features_sink(spark, sf):
    """The written feature matrix, and how often its files depart from the order of its key."""
    path = shared_folder(spark, "features-sink")
    sinks.write_features(X.experiment_features(workflow(spark, sf)), path)
    breaks = sinks.order_breaks(spark, path, ["srx"])
    return spark.read.parquet(path).agg(
        F.count("srx").alias("n"), F.min("srx").alias("first_key"), F.max("srx").alias("last_key")).select(
        "*", *[breaks.select(c).scalar().cast("int").alias(c) for c in ("inside", "between")])


@query("result_csv", f"""WITH {_WORKFLOW} SELECT srx, CASE WHEN sum(number_reads) > 20000 THEN 'Outlier' ELSE 'Inliers' END AS labels
    FROM workflow WHERE srx IS NOT NULL GROUP BY srx""")
def result_csv(spark, sf):
    """A labelled matrix through the CSV sink: header, key first, labels last."""
    path = shared_folder(spark, "result")
    matrix = X.experiment_features(workflow(spark, sf))
    sinks.write_result_csv(matrix.withColumn("labels", F.when(F.col("number_reads") > 20000, "Outlier").otherwise("Inliers")), path)
    back = spark.read.option("header", True).csv(path)
    return back.select(back.columns[0], back.columns[-1])


@query("experiment_features_gaps", _feature_sql(group=True, gaps=True))
def experiment_features_gaps(spark, sf):
    """Stages that lack runs: what is missing adds nothing to a sum and does not count in a mean."""
    return rounded(X.experiment_features(workflow(spark, sf, gaps=True)))


@query("complete_features", _feature_sql(group=False, gaps=True) + " WHERE " + " AND ".join(
    f"{n} IS NOT NULL" for n in schemas.FEATURES))
def complete_features(spark, sf):
    return rounded(X.drop_incomplete(X.run_features(workflow(spark, sf, gaps=True))))


@query("stage_alignment", f"""WITH {ctes('layout_v', 'atropos_gaps_v', 'hisat2_gaps_v', 'markduplicates_gaps_v')}
    SELECT coalesce(l.srr, t.srr, h.srr, u.srr) AS srr, l.layout, t.too_short, round(h.num_reads, 6) AS num_reads,
           round(u.percent_duplication, 6) AS percent_duplication
    FROM layout_v l FULL JOIN atropos_gaps_v t ON l.srr = t.srr FULL JOIN hisat2_gaps_v h ON coalesce(l.srr, t.srr) = h.srr
    FULL JOIN markduplicates_gaps_v u ON coalesce(l.srr, t.srr, h.srr) = u.srr""")
def stage_alignment(spark, sf):
    wanted = {"layout": "layout", "atropos": "too_short", "hisat2": "num_reads",
              "markduplicates": "percent_duplication"}
    return rounded(X.align({s: load(spark, sf, _view(s, gaps=True)).select("srr", c) for s, c in wanted.items()}))


@query("gene_body_tertiles", f"""WITH {ctes('coverage_v')}, {_TERTILES}
    SELECT srr, round(gene_body_five_prime, 6) AS gene_body_five_prime, round(gene_body_middle, 6) AS gene_body_middle,
           round(gene_body_three_prime, 6) AS gene_body_three_prime FROM tertiles""")
def gene_body_tertiles(spark, sf):
    return rounded(X.gene_body_tertiles(load(spark, sf, "coverage_v")))


@query("coverage_columns", f"""WITH {ctes('coverage_v')}
    SELECT srr, {', '.join(f'coverage[{i + 1}] AS pos_{i}' for i in range(schemas.N_COVERAGE))} FROM coverage_v""")
def coverage_columns(spark, sf):
    return X.coverage_columns(load(spark, sf, "coverage_v"))


@query("screen_wide", f"""WITH {ctes('fastq_screen_v')}
    SELECT srr, max(CASE WHEN reference = 'rRNA' THEN pct_reads_mapped END) AS "rRNA_pct_reads_mapped",
           max(CASE WHEN reference = 'dm6' THEN pct_reads_mapped END) AS dm6_pct_reads_mapped,
           max(CASE WHEN reference = 'ecoli' THEN pct_reads_mapped END) AS ecoli_pct_reads_mapped
    FROM fastq_screen_v GROUP BY srr""")
def screen_wide(spark, sf):
    from cohortqc.operators.reports import screen_wide as pivot
    return pivot(load(spark, sf, "fastq_screen_v"), ["rRNA", "dm6", "ecoli"])


@query("rrna_check", f"""WITH {ctes('fastq_screen_v')}
    SELECT 'rrna_reference_present' AS "check", count(*) FILTER (reference = 'rRNA') > 0 AS passed FROM fastq_screen_v""")
def rrna_check(spark, sf):
    return X.check_rrna({"fastq_screen": load(spark, sf, "fastq_screen_v")})


@query("manifest_scan", f"WITH {ctes('manifest_v')} SELECT srx, srr FROM manifest_v")
def manifest_scan(spark, sf):
    path = shared_folder(spark, "manifest")
    load(spark, sf, "manifest_v").write.option("header", True).option("sep", "\t").csv(path)
    return tables.read_manifest(spark, path)


@query("manifest_runs", f"""WITH {ctes('manifest_v', 'done_v')}
    SELECT srx, srr FROM manifest_v m WHERE NOT EXISTS (SELECT 1 FROM done_v d WHERE d.srr = m.srr)""")
def manifest_runs(spark, sf):
    return S.pending_runs(load(spark, sf, "manifest_v"), load(spark, sf, "done_v"))


@query("stage_resume", f"""WITH {ctes('manifest_v', 'atropos_gaps_v')}
    SELECT srx, srr FROM manifest_v WHERE srr NOT IN (SELECT srr FROM atropos_gaps_v)""")
def stage_resume(spark, sf):
    return S.resume(load(spark, sf, "manifest_v"), load(spark, sf, "atropos_gaps_v"))


_STORE = "old AS (SELECT * FROM atropos_v WHERE total_processed > 11000)"


def _old(spark, sf):
    return load(spark, sf, "atropos_v").where("total_processed > 11000")


@query("new_samples", f"""WITH {ctes('atropos_v', 'done_v')}, {_STORE}
    SELECT * FROM atropos_v WHERE srr IN (SELECT srr FROM done_v) AND srr NOT IN (SELECT srr FROM old)""")
def new_samples(spark, sf):
    return S.new_samples(load(spark, sf, "atropos_v"), load(spark, sf, "done_v"), _old(spark, sf))


@query("new_keys", f"""WITH {ctes('atropos_v', 'done_v')}, {_STORE}
    SELECT srr FROM done_v INTERSECT (SELECT srr FROM atropos_v EXCEPT SELECT srr FROM old)""")
def new_keys(spark, sf):
    return S.new_keys(load(spark, sf, "done_v"), load(spark, sf, "atropos_v"), _old(spark, sf))


@query("store_union", f"""WITH {ctes('atropos_v', 'layout_v')}
    SELECT srr, too_short, NULL AS layout FROM atropos_v UNION ALL SELECT srr, NULL, layout FROM layout_v""")
def store_union(spark, sf):
    return S.union_rows(load(spark, sf, "atropos_v").select("srr", "too_short"),
                        load(spark, sf, "layout_v").select("srr", "layout"))


@query("store_keys", f"""WITH {ctes('fastq_screen_v')} SELECT DISTINCT srr FROM fastq_screen_v""")
def store_keys(spark, sf):
    return S.store_keys(load(spark, sf, "fastq_screen_v"))


_APPENDED = f"""WITH {ctes('atropos_v', 'orders_v')}
    SELECT * FROM atropos_v WHERE srr IN (SELECT srr FROM orders_v WHERE o_orderstatus <> 'P')"""


def _waves(spark, sf):
    """Two waves of finished runs; the second repeats most of the first."""
    orders = load(spark, sf, "orders_v")
    return [orders.where(F.col("o_orderstatus") == s).select("srr").distinct() for s in ("F", "O")]


@query("store_append", _APPENDED)
def store_append(spark, sf):
    root = shared_folder(spark, "store")
    sinks.write_stage(load(spark, sf, "atropos_v"), f"{root}/atropos", "atropos")
    for done in _waves(spark, sf):
        sinks.mark_done(done, f"{root}/done")
        S.append_new(spark, tables.read_done(spark, f"{root}/done"), f"{root}/atropos", f"{root}/atropos.parquet",
                     "atropos")
    return tables.read_store(spark, f"{root}/atropos.parquet", "atropos")


@query("stage_stream", _APPENDED)
def stage_stream(spark, sf):
    root = shared_folder(spark, "stream")
    sinks.write_stage(load(spark, sf, "atropos_v"), f"{root}/atropos", "atropos")
    for done in _waves(spark, sf):
        sinks.mark_done(done, f"{root}/done")
        stream_stage(spark, "atropos", f"{root}/atropos", f"{root}/done", f"{root}/atropos.parquet",
                     f"{root}/checkpoint").awaitTermination()
    return tables.read_store(spark, f"{root}/atropos.parquet", "atropos")


# ---- whole jobs through files: stage folders, stores, the feature matrix ---------------------------------------------

def _stage_folders(spark, sf, root: str) -> str:
    for stage, rows in stages(spark, sf).items():
        typed = empty(spark, schemas.STAGES[stage]).unionByName(rows, allowMissingColumns=True)
        sinks.write_stage(typed, f"{root}/{stage}", stage)
    sinks.mark_done(load(spark, sf, "done_v"), f"{root}/done")
    return root


@query("features_job", _feature_sql(group=True))
def features_job(spark, sf):
    """Stores and matrix as the batch job builds them."""
    root = _stage_folders(spark, sf, shared_folder(spark, "features-job"))
    done = tables.read_done(spark, f"{root}/done")
    jobs.build_feature_store(spark, done, root)
    return rounded(jobs.build_features(spark, load(spark, sf, "manifest_v"), done, root))


@query("features_stream_job", _feature_sql(group=False))
def features_stream_job(spark, sf):
    """The same from stores that ten streams fill, by run."""
    root = _stage_folders(spark, sf, shared_folder(spark, "features-stream"))
    stream_all(spark, root, f"{root}/done", f"{root}/checkpoints")
    done = tables.read_done(spark, f"{root}/done")
    return rounded(jobs.build_features(spark, load(spark, sf, "manifest_v"), done, root, by_experiment=False))


@query("run_all_job", f"SELECT *, true AS labelled FROM ({_feature_sql(group=True)}) t")
def run_all_job(spark, sf):
    """Stage folders to the labelled result file, which is read back; the labels themselves are checked elsewhere."""
    root = shared_folder(spark, "run-all")
    done = tables.read_done(spark, f"{_stage_folders(spark, sf, f'{root}/Features')}/done")
    jobs.run_all(spark, load(spark, sf, "manifest_v"), done, root, nulls="median")
    result = spark.read.option("header", True).csv(f"{root}/result.csv")
    return rounded(result.select("srx", *[F.col(c).cast("double").alias(c) for c in schemas.FEATURES],
                                 F.col("labels").isin("Inliers", "Outlier").alias("labelled")))
