"""Table schemas and the fixed vocabulary of the feature matrix."""
from __future__ import annotations

from pyspark.sql import types as T

N_COVERAGE = 101


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_S, _L, _D, _I = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType()

MANIFEST = _schema(("srx", _S), ("srr", _S))
READS = _schema(("srr", _S), ("mate", _I), ("read_no", _L), ("h1", _S), ("seq", _S), ("h2", _S), ("qual", _S))
REPORTS = _schema(("srr", _S), ("stage", _S), ("body", _S))
DONE = _schema(("srr", _S), ("finished_at", T.TimestampType()))
STATUS = _schema(("srr", _S), ("stage", _S), ("attempt", _L), ("status", _S))
ALIGNMENTS = _schema(
    ("srr", _S), ("qname", _S), ("flag", _I), ("ref", _S), ("pos", _L), ("mapq", _I), ("cigar", _S),
    ("rnext", _S), ("pnext", _L), ("tlen", _L), ("seq", _S), ("qual", _S), ("nh", _I),
)
EXONS = _schema(("gene_id", _S), ("tx_id", _S), ("ref", _S), ("start", _L), ("end", _L), ("strand", _S))
TRANSCRIPTS = _schema(
    ("gene", _S), ("tx", _S), ("ref", _S), ("strand", _S), ("tx_start", _L), ("tx_end", _L),
    ("cds_start", _L), ("cds_end", _L), ("exon_starts", T.ArrayType(_L)), ("exon_ends", T.ArrayType(_L)),
)

# ---- Fixed values: names and types of the ten stage tables. ------------------------------------------------------
STAGES: dict[str, T.StructType] = {
    "aln_stats": _schema(
        ("srr", _S), ("reads_MQ0", _L), ("average_quality", _D), ("insert_size_average", _D),
        ("insert_size_standard_deviation", _D), ("inward_oriented_pairs", _L), ("outward_oriented_pairs", _L),
        ("pairs_with_other_orientation", _L), ("pairs_on_different_chromosomes", _L),
        ("Percent Forward", _D), ("Percent Reverse", _D)),
    "atropos": _schema(("srr", _S), ("total_processed", _L), ("total_written", _L), ("too_short", _L)),
    "count_summary": _schema(
        ("srr", _S), ("number_genic_reads", _L), ("percent_genes_on", _D), ("number_junction_reads", _L),
        ("number_junctions_on", _L)),
    # long form; `operators.reports.screen_wide` pivots it on request
    "fastq_screen": _schema(("srr", _S), ("reference", _S), ("pct_reads_mapped", _D)),
    # coverage is one array of 101 values; `operators.features.coverage_columns` widens it at a sink
    "genebody_coverage": _schema(("srr", _S), ("coverage", T.ArrayType(_D))),
    "hisat2": _schema(
        ("srr", _S), ("num_reads", _D), ("num_reads_paired", _D), ("num_reads_unpaired", _D),
        ("num_concordant_reads_unaligned", _D), ("num_concordant_reads_uniquely_aligned", _D),
        ("num_concordant_multimappers", _D), ("num_discordant_reads_aligned", _D), ("num_unaligned", _D),
        ("num_uniquely_aligned", _D), ("num_multimappers", _D), ("per_alignment", _D)),
    "markduplicates": _schema(
        ("srr", _S), ("unpaired_reads_examined", _L), ("read_pairs_examined", _L), ("unpaired_read_duplicates", _L),
        ("read_pair_duplicates", _L), ("percent_duplication", _D), ("estimated_library_size", _L)),
    "rnaseqmetrics": _schema(
        ("srr", _S), ("percent_coding_bases", _D), ("percent_utr_bases", _D), ("percent_intronic_bases", _D),
        ("percent_intergenic_bases", _D), ("percent_mrna_bases", _D), ("median_cv_coverage", _D),
        ("median_5prime_bias", _D), ("median_3prime_bias", _D), ("median_5prime_to_3prime_bias", _D)),
    "strand": _schema(("srr", _S), ("strand", _S)),
    "layout": _schema(
        ("srr", _S), ("layout", _S), ("libsize", _L), ("avgLen_R1", _D), ("avgLen_R2", _D)),
}

# ---- Fixed values: how each run-level column rolls up to an experiment. -------------------------------------------
FEATURE_AGG: dict[str, str] = {
    "rRNA_pct_reads_mapped": "mean",
    "too_short": "sum",
    "num_reads": "sum",
    "num_multimappers": "sum",
    "per_alignment": "mean",
    "reads_MQ0": "sum",
    "average_quality": "mean",
    "Percent Reverse": "mean",
    "percent_utr_bases": "mean",
    "percent_intronic_bases": "mean",
    "percent_intergenic_bases": "mean",
    "percent_mrna_bases": "mean",
    "median_cv_coverage": "mean",
    "percent_duplication": "mean",
    "number_genic_reads": "sum",
    "percent_genes_on": "mean",
    "number_junction_reads": "sum",
    "number_junctions_on": "sum",
    "gene_body_five_prime": "mean",
    "gene_body_middle": "mean",
    "gene_body_three_prime": "mean",
}

# ---- Fixed values: output names that differ from the stage column. ------------------------------------------------
FEATURE_RENAME: dict[str, str] = {
    "rRNA_pct_reads_mapped": "percent_rrna_reads",
    "too_short": "number_reads_too_short",
    "num_reads": "number_reads",
    "num_multimappers": "number_multimapping_reads",
    "per_alignment": "percent_alignment",
    "Percent Reverse": "percent_reverse",
}

# ---- Fixed values: display labels of the features. ----------------------------------------------------------------
FEATURE_LABELS: dict[str, str] = {
    "percent_alignment": "Reads Aligned (%)",
    "percent_duplication": "Duplicated Reads (%)",
    "percent_genes_on": "Gene Expressed (%)",
    "number_junction_reads": "Reads at Exon Junctions (#)",
    "percent_utr_bases": "UTR Bases (%)",
    "gene_body_three_prime": "3' Gene Body Coverage (avg)",
    "percent_intergenic_bases": "Intergenic Bases (%)",
    "percent_reverse": "Reverse Oriented Reads (%)",
    "number_genic_reads": "Genic Reads (#)",
    "gene_body_middle": "Middle Gene Body Coverage (avg)",
    "number_reads": "Total Reads (#)",
    "median_cv_coverage": "Coef Var Coverage (median)",
    "gene_body_five_prime": "5' Gene Body Coverage (avg)",
    "percent_mrna_bases": "mRNA Bases (%)",
    "reads_MQ0": "Reads 0 Mapping Quality (#)",
    "percent_rrna_reads": "rRNA Reads (%)",
    "number_junctions_on": "Exon Junctions Touched (#)",
    "percent_intronic_bases": "Intronic Bases (%)",
    "number_multimapping_reads": "Multimapping Reads (#)",
    "average_quality": "Quality Score (avg)",
    "number_reads_too_short": "Reads Too Short (#)",
}

FEATURES: list[str] = [FEATURE_RENAME.get(name, name) for name in FEATURE_AGG]
