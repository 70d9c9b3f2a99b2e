"""Run-level feature rows and their roll-up to experiments."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortqc import schemas

# ---- Fixed values: the three stretches of the 101 coverage positions, as (first position, length). -----------------
TERTILES = {
    "gene_body_five_prime": (0, 33),
    "gene_body_middle": (33, 35),
    "gene_body_three_prime": (68, 33),
}

# Stage columns the feature matrix uses; the rest is pruned before anything is shuffled.
USED = {
    "fastq_screen": ["rRNA_pct_reads_mapped"],
    "atropos": ["too_short"],
    "hisat2": ["num_reads", "num_multimappers", "per_alignment"],
    "aln_stats": ["reads_MQ0", "average_quality", "Percent Reverse"],
    "rnaseqmetrics": ["percent_utr_bases", "percent_intronic_bases", "percent_intergenic_bases",
                      "percent_mrna_bases", "median_cv_coverage"],
    "genebody_coverage": list(TERTILES),
    "markduplicates": ["percent_duplication"],
    "count_summary": ["number_genic_reads", "percent_genes_on", "number_junction_reads", "number_junctions_on"],
    "layout": [],
}


def gene_body_tertiles(rows: DataFrame, coverage: str = "coverage") -> DataFrame:
    """Sum the coverage array over its three stretches (nulls count 0) and drop it."""
    def total(first: int, n: int) -> Column:
        return F.aggregate(F.slice(F.col(coverage), first + 1, n), F.lit(0.0),
                           lambda acc, x: acc + F.coalesce(x, F.lit(0.0)))

    sums = {name: F.coalesce(total(first, n), F.lit(0.0)) for name, (first, n) in TERTILES.items()}
    return rows.withColumns(sums).drop(coverage)


def coverage_columns(rows: DataFrame) -> DataFrame:
    """The coverage array as columns pos_0 … pos_100."""
    return rows.select(*[c for c in rows.columns if c != "coverage"],
                       *[F.get("coverage", F.lit(i)).alias(f"pos_{i}") for i in range(schemas.N_COVERAGE)])


def align(tables: dict[str, DataFrame], keep: DataFrame | None = None) -> DataFrame:
    """Stage tables side by side, one row per run: a full outer alignment on ``srr``.

    All tables go through one union and one aggregate. That is a single shuffle of narrow rows instead of a chain of
    full joins, each with its own sort, and it counts the rows of a run per stage on the way: a run that a stage holds
    twice fails the query instead of multiplying rows. With ``keep`` only its runs remain, absent ones as null rows.
    """
    def quoted(df: DataFrame) -> list[str]:
        return [f"`{c}`" for c in df.columns if c != "srr"]

    columns = [c for df in tables.values() for c in quoted(df)]
    if len(set(columns)) != len(columns):
        raise ValueError("stage tables share column names besides srr")
    # a stage's bit: if the sum of a run's bits is not their union, some stage came twice
    parts = [df.selectExpr("srr", f"{1 << i}L AS _bit", *quoted(df)) for i, df in enumerate(tables.values())]
    if keep is not None:
        parts.append(keep.selectExpr("srr", "0L AS _bit"))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    grouped = rows.groupBy("srr").agg(
        F.expr("sum(_bit) <> bit_or(_bit)").alias("_twice"), F.expr("bool_or(_bit = 0)").alias("_kept"),
        *[F.expr(f"max({c}) AS {c}") for c in columns])
    if keep is not None:
        grouped = grouped.where("_kept")
    message = "'a stage holds more than one row for run ' || srr"
    return grouped.selectExpr(f"CASE WHEN _twice THEN raise_error({message}) ELSE srr END AS srr", *columns)


def stage_inputs(stages: dict[str, DataFrame], rrna: str = "rRNA") -> dict[str, DataFrame]:
    """The used columns of each stage, with coverage reduced to tertiles and the screen to the rRNA share."""
    out = {}
    for name, columns in USED.items():
        df = stages[name]
        if name == "genebody_coverage":
            df = gene_body_tertiles(df)
        elif name == "fastq_screen" and "reference" in df.columns:
            df = df.where(F.col("reference") == rrna).withColumnRenamed("pct_reads_mapped", "rRNA_pct_reads_mapped")
        out[name] = df.select("srr", *[f"`{c}`" for c in columns])
    return out


def workflow_table(stages: dict[str, DataFrame], done: DataFrame, manifest: DataFrame) -> DataFrame:
    """One row per done run with every used column and the run's experiment."""
    rows = align(stage_inputs(stages), keep=done)
    # a run without coverage sums to 0, like a run whose coverage is all missing
    rows = rows.na.fill(0.0, list(TERTILES))
    return rows.join(manifest, "srr", "left")


def run_features(workflow: DataFrame) -> DataFrame:
    """The 21 features per run."""
    return workflow.selectExpr("srr", *[
        f"CAST(`{c}` AS DOUBLE) AS {schemas.FEATURE_RENAME.get(c, c)}" for c in schemas.FEATURE_AGG])


def experiment_features(workflow: DataFrame) -> DataFrame:
    """The 21 features per experiment. Runs without experiment drop out; a sum of nothing is 0, a mean null."""
    def agg(name: str, how: str) -> Column:
        value = f"CAST(`{name}` AS DOUBLE)"
        rolled = f"coalesce(sum({value}), 0D)" if how == "sum" else f"avg({value})"
        return F.expr(f"{rolled} AS {schemas.FEATURE_RENAME.get(name, name)}")

    return workflow.where("srx IS NOT NULL").groupBy("srx").agg(
        *[agg(name, how) for name, how in schemas.FEATURE_AGG.items()])


def drop_incomplete(features: DataFrame) -> DataFrame:
    return features.na.drop()


def check_rrna(stages: dict[str, DataFrame], rrna: str = "rRNA") -> DataFrame:
    """One check row: does any screen row name the rRNA reference at all?"""
    screen = stages["fastq_screen"]
    return screen.agg(F.count_if(F.col("reference") == rrna).alias("n")).select(
        F.lit("rrna_reference_present").alias("check"), (F.col("n") > 0).alias("passed"))
