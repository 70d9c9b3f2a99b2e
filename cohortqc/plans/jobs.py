"""The jobs a user runs. Work starts at the writes, and where a fit or a check needs numbers first."""
from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortqc import schemas
from cohortqc.operators import alignments as A
from cohortqc.operators import coverage as V
from cohortqc.operators import explain, features, iforest, reads, reports, status, store
from cohortqc.session import empty, path_exists, written
from cohortqc.sinks import writers
from cohortqc.sources import fastq, tables


def _known_runs(spark: SparkSession, path: str) -> DataFrame:
    """Runs of a table that may not exist yet."""
    return spark.read.parquet(path).select("srr") if path_exists(spark, path) else empty(spark, "srr string")


def qc_reads(spark: SparkSession, fastq_dir: str, manifest: DataFrame, out: str, min_library: int = reads.MIN_LIBRARY,
             empty_bytes: int = reads.EMPTY_BYTES, pattern: str = fastq.FILE_NAME) -> DataFrame:
    """FASTQ folder to clean reads (``<out>/reads``), library statistics (``<out>/libraries``), which it returns, and the
    ``layout`` stage (``<out>/Features/layout``). Files whose names tell no run are named in ``<out>/unfit_files``.

    Only runs without a row in ``<out>/libraries`` are processed; runs of the manifest without files get a
    ``download_bad`` row. The raw reads are written to parquet first: they are used twice, and compressed FASTQ can only
    be read front to back.
    """
    known = _known_runs(spark, f"{out}/libraries")
    todo = manifest.select("srr").distinct().join(known, "srr", "left_anti")
    files = fastq.folder_of(spark, fastq_dir)
    roles = fastq.file_roles(fastq.list_files(spark, files, pattern)).join(todo, "srr", "left_semi")
    (fastq.read_fastq(spark, files, pattern).join(todo, "srr", "left_semi")
     .write.mode("overwrite").partitionBy("mate").parquet(f"{out}/raw"))
    raw = spark.read.schema(schemas.READS).parquet(f"{out}/raw")
    stats = reads.library_stats(raw, roles, min_library, empty_bytes).unionByName(
        fastq.missing_runs(todo, roles).select("srr", F.lit("download_bad").alias("status")), allowMissingColumns=True)
    stats.write.mode("append").parquet(f"{out}/libraries")
    fastq.unfit_files(spark, files, pattern).write.mode("overwrite").parquet(f"{out}/unfit_files")
    libraries = spark.read.parquet(f"{out}/libraries")
    reads.clean_reads(raw, libraries).write.mode("append").partitionBy("mate").parquet(f"{out}/reads")
    layouts = libraries.where("layout IS NOT NULL").join(_known_runs(spark, f"{out}/Features/layout"), "srr", "left_anti")
    writers.write_stage(layouts, f"{out}/Features/layout", "layout")
    return libraries


def ingest_reports(report: DataFrame, stage: str, second: DataFrame | None = None) -> DataFrame:
    """Stage rows from one kind of report. ``second`` is the other report where a stage needs two (bamtools for
    ``aln_stats``, the second-strand summary for ``strand``). ``count_summary`` takes gene counts and junction counts as
    ``read_counts`` gives them."""
    if stage == "fastq_screen":
        return reports.screen_summary(reports.screen_metrics(report))
    if stage == "atropos":
        return reports.trim_log(report).where("status = 'ok'").drop("status")
    if stage == "hisat2":
        return reports.alignment_gate(reports.aligner_log(report)).drop("status")
    if stage == "aln_stats":
        return reports.alignment_stats(reports.samtools_stats(report), reports.bamtools_stats(second))
    if stage == "strand":
        return reports.strand_call(reports.rna_summary(report), reports.rna_summary(second))
    if stage == "rnaseqmetrics":
        return reports.rna_projection(reports.rna_summary(report))
    if stage == "genebody_coverage":
        return reports.coverage_histogram(report)
    if stage == "markduplicates":
        return reports.duplicate_metrics(report)
    if stage == "count_summary":
        return A.count_table_summary(report).join(A.junction_summary(second), "srr", "left")
    raise ValueError(f"no report parser for stage {stage!r}")


def log_status(logs: DataFrame, attempt: int = 1) -> DataFrame:
    """srr, stage, attempt, status of every log: its phrases are missing, it cannot be read, its numbers are below the
    gate, or it is ok. Logs with a column ``attempt`` tell theirs; the others are of the given attempt."""
    told = logs if "attempt" in logs.columns else logs.withColumn("attempt", F.lit(attempt).cast("bigint"))
    carry = ("attempt",)
    parts = [reports.completion(told),
             reports.trim_log(told.where("stage = 'atropos'"), carry=carry).withColumn("stage", F.lit("atropos")),
             reports.alignment_gate(reports.aligner_log(told.where("stage = 'hisat2'"), carry)).withColumn(
                 "stage", F.lit("hisat2"))]
    columns = [f.name for f in schemas.STATUS.fields]
    return status.merged(reduce(DataFrame.unionByName, [p.select(*columns) for p in parts]))


def finish_runs(spark: SparkSession, runs: DataFrame, logs: DataFrame, out: str, attempt: int = 1,
                required: tuple[str, ...] = status.REQUIRED) -> DataFrame:
    """Records what the logs say in ``<out>/Features/status``, marks the runs that are now complete as done
    (``<out>/Features/done``) and returns the state of every run (srr, state, failed, missing).

    The newest attempt at a stage decides, so a repeated run can become done. A stage without a log counts as ok once
    its row is in ``<out>/Features/<stage>``. A run that reported nothing is waiting. A repeated call records and marks
    nothing again.
    """
    root = f"{out}/Features"
    wanted = runs.select("srr").distinct()
    known = tables.read_status(spark, f"{root}/status")
    new = status.unrecorded(log_status(logs, attempt).join(wanted, "srr", "left_semi"), known)
    writers.write_status(new, f"{root}/status")
    stages = {name: tables.read_stage_folder(spark, f"{root}/{name}", name) for name in required}
    reported = tables.read_status(spark, f"{root}/status").unionByName(status.present(stages))
    states = written(status.run_states(wanted, reported, required), "run-states")
    finished = states.where(F.col("state") == status.DONE).join(tables.read_done(spark, f"{root}/done"), "srr", "left_anti")
    writers.mark_done(finished, f"{root}/done")
    return states


# what the stage tables are made of: the kinds of reports a stage takes
STAGE_REPORTS = {
    "fastq_screen": ("fastq_screen",), "atropos": ("atropos",), "hisat2": ("hisat2",), "aln_stats": ("aln_stats", "bam_stats"),
    "strand": ("strand_first", "strand_second"), "rnaseqmetrics": ("rnaseqmetrics",), "genebody_coverage": ("rnaseqmetrics",),
    "markduplicates": ("markduplicates",),
}


def ingest_logs(spark: SparkSession, runs: DataFrame, logs: DataFrame, out: str, attempt: int = 1,
                required: tuple[str, ...] = status.REQUIRED) -> DataFrame:
    """Reports of all kinds (srr, stage, body, attempt where they differ) to the stage tables under ``<out>/Features``,
    the status table and the done table; returns the state of every run.

    Only the newest log of a run and kind is read, and only if it is ok; a run that a stage table holds already is left
    as it is.
    """
    told = logs if "attempt" in logs.columns else logs.withColumn("attempt", F.lit(attempt).cast("bigint"))
    good = status.latest(log_status(told)).where(F.col("status") == status.OK).select("srr", "stage", "attempt")
    told = written(told.join(good, ["srr", "stage", "attempt"], "left_semi").select("srr", "stage", "body"), "good-logs")
    for stage, kinds in STAGE_REPORTS.items():
        parts = [told.where(F.col("stage") == kind) for kind in kinds]
        rows = ingest_reports(parts[0], stage, *parts[1:])
        # a stage that takes two reports has no row before both are there
        for part in parts[1:]:
            rows = rows.join(part.select("srr"), "srr", "left_semi").join(parts[0].select("srr"), "srr", "left_semi")
        path = f"{out}/Features/{stage}"
        writers.write_stage(rows.join(_known_runs(spark, path).distinct(), "srr", "left_anti"), path, stage)
    return finish_runs(spark, runs, logs, out, attempt, required)


def alignment_features(alignments: DataFrame, exons: DataFrame, transcripts: DataFrame,
                       layout: DataFrame, min_mapq: int = 20) -> dict[str, DataFrame]:
    """The stage tables that external programs would report, computed from the alignments themselves.

    The alignments are read three times: for what their flags say (a row per run), for the collapsed store, and for the
    pairs, and only pairs are brought together by name. The three results are written; every stage table is worked out
    from them.
    """
    flags = written(A.flag_summary(alignments, min_mapq), "alignment-flags")
    filtered = A.mapq_filter(alignments, min_mapq)
    equal = written(A.collapse(filtered), "alignment-store")
    pairs = written(A.pair_rows(filtered).drop("qname"), "alignment-pairs")
    cigars = A.parsed_cigars(equal)  # those of the pairs among them
    strand = written(V.strand_from_agreement(V.strand_agreement(equal, exons, cigars=cigars)), "alignment-strand")
    modes = A.count_modes(layout, strand)
    genes = A.gene_counts_by_mode(equal, exons, modes, pairs=pairs, cigars=cigars)
    junctions = A.junction_summary(A.junction_counts(equal))
    stretches = V.depth_stretches(equal, transcripts, cigars=cigars)
    columns = lambda stage: [F.col(f"`{f.name}`") for f in schemas.STAGES[stage].fields]
    return {
        "hisat2": flags.where("n_primary > 0").select(*columns("hisat2")),
        "aln_stats": flags.where("n_good > 0").select(*columns("aln_stats")),
        "markduplicates": A.duplication_of(equal, pairs),
        "strand": strand,
        "rnaseqmetrics": V.base_classes(equal, transcripts, cigars=cigars).select(
            "srr", "percent_coding_bases", "percent_utr_bases", "percent_intronic_bases", "percent_intergenic_bases",
            "percent_mrna_bases").join(V.coverage_evenness(stretches), "srr", "left"),
        "genebody_coverage": V.gene_body_coverage(stretches),
        "count_summary": A.gene_count_summary(genes, flags.select("srr"), exons, modes).join(
            junctions, "srr", "left").na.fill(0, ["number_junction_reads", "number_junctions_on"]),
    }


def build_feature_store(spark: SparkSession, done: DataFrame, root: str) -> None:
    store.append_all(spark, done, root)


def build_features(spark: SparkSession, manifest: DataFrame, done: DataFrame, root: str,
                   by_experiment: bool | None = None) -> DataFrame:
    """Feature matrix from the stores, written to ``<root>/features.parquet``.

    By experiment when the manifest names experiments, by run otherwise.
    """
    stages = {name: tables.read_store(spark, f"{root}/{name}.parquet", name) for name in features.USED}
    workflow = features.workflow_table(stages, done.select("srr").distinct(), manifest)
    if by_experiment is None:
        by_experiment = not manifest.where("srx IS NOT NULL").isEmpty()
    matrix = features.experiment_features(workflow) if by_experiment else features.run_features(workflow)
    writers.write_features(matrix, f"{root}/features.parquet")
    return tables.read_features(spark, f"{root}/features.parquet")


@dataclass
class Detection:
    """Labels and checks of a feature matrix; the attribution is worked out when first asked for."""

    key: str
    columns: list[str]
    rows: DataFrame
    nodes: pd.DataFrame
    strict: bool = False

    @cached_property
    def forest(self) -> iforest.Forest:
        return iforest.Forest(self.nodes)

    @property
    def trees(self) -> DataFrame:
        return self.rows.sparkSession.createDataFrame(self.nodes, iforest.TREES_SCHEMA)

    @cached_property
    def scored(self) -> DataFrame:
        return iforest.score(self.rows, self.forest, self.columns)

    @property
    def result(self) -> DataFrame:
        return iforest.label(self.scored).select(self.key, *self.columns, "labels")

    @property
    def checks(self) -> DataFrame:
        return iforest.share_check(self.scored, strict=self.strict)

    @cached_property
    def _test(self) -> DataFrame:
        return iforest.score(self.rows.where("split = 'test'"), self.forest, self.columns)

    @cached_property
    def explainer(self) -> explain.Explainer:
        return explain.Explainer.build(self.forest, iforest.inliers(self._test), self.columns)

    @property
    def expected_value(self) -> float:
        return self.explainer.expected_value()

    @cached_property
    def shap(self) -> DataFrame:
        return explain.shap_long(self._test, self.key, self.explainer, self.columns, carry=("is_inlier", "is_outlier"))

    @property
    def importance(self) -> DataFrame:
        return explain.importance(self.shap)


def detect(matrix: DataFrame, key: str, out: str | None = None, nulls: str = "error", n_trees: int = iforest.N_TREES,
           seed: int = iforest.SEED, strict: bool = False) -> Detection:
    """Label the unusual rows of a feature matrix and say which features made them so.

    ``strict`` raises when the outlier shares of train and test differ. The node table that comes to the driver has at
    most ``n_trees`` × 511 rows.
    """
    columns = [c for c in matrix.columns if c != key]
    rows = iforest.split_rows(iforest.handle_nulls(matrix, columns, nulls), key, seed)
    nodes = iforest.fit(rows.where("split = 'train'"), key, columns, n_trees=n_trees, seed=seed).toPandas()
    found = Detection(key, columns, rows, nodes, strict)
    if strict:
        found.checks.collect()
    if out:
        writers.write_result_csv(found.result, f"{out}/result.csv")
    return found


def run_all(spark: SparkSession, manifest: DataFrame, done: DataFrame | None, out: str, logs: DataFrame | None = None,
            required: tuple[str, ...] = status.REQUIRED, **detect_options) -> Detection:
    """Stores, features, detection; Features live under ``<out>/Features``, the result at ``<out>/result.csv``.

    With ``logs`` the runs they complete are marked first, and the done table is read again; ``done`` may then be None.
    """
    root = f"{out}/Features"
    if logs is not None:
        finish_runs(spark, manifest, logs, out, required=required)
        done = tables.read_done(spark, f"{root}/done")
    build_feature_store(spark, done, root)
    matrix = build_features(spark, manifest, done, root)
    return detect(matrix, matrix.columns[0], out, **detect_options)
