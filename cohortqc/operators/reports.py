"""Tool reports to typed stage rows.

A report is one row with its whole text. All parsers but the screen's work inside that row with array functions, so
they add no shuffle: a folder of a million reports is one map stage.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortqc import schemas
from cohortqc.functions import text as X

# ---- Fixed values: line patterns of the reports. ------------------------------------------------------------------
SCREEN_LINE = (r"^(\S+)\s+(\d+)\s+(\d+)\s+-?([\d\.]+)\s+(\d+)\s+([\d\.]+)\s+(\d+)\s+([\d\.]+)"
               r"\s+(\d+)\s+([\d\.]+)\s+(\d+)\s+([\d\.]+)$")
ALIGNER_LINE = r"^([\d\.]+)[%]*\s([\(\)\d\.%]*\s)?(.*)$"
SAMTOOLS_LINE = r"^SN\s+(.+?):\s+([\d\.]+)\s.*$"
BAMTOOLS_LINE = r"^(.+?):\s+(\d+).*$"
TRIM_PROCESSED = r"Total read.*processed:\s+(\d+)"
TRIM_WRITTEN = r"(?:Read|Pair)s written \(passing filters\):\s+(\d+)"
TRIM_SHORT = r"(?:Read|Pair)s that were too short:\s+(\d+)"

# ---- Fixed values: the metrics of a screen line, in line order. ---------------------------------------------------
SCREEN_METRICS = [
    ("reads_processed_count", "bigint"),
    ("unmapped_count", "bigint"),
    ("unmapped_percent", "double"),
    ("one_hit_one_library_count", "bigint"),
    ("one_hit_one_library_percent", "double"),
    ("multiple_hits_one_library_count", "bigint"),
    ("multiple_hits_one_library_percent", "double"),
    ("one_hit_multiple_libraries_count", "bigint"),
    ("one_hit_multiple_libraries_percent", "double"),
    ("multiple_hits_multiple_libraries_count", "bigint"),
    ("multiple_hits_multiple_libraries_percent", "double"),
]

# ---- Fixed values: phrases of the aligner's summary and the column each one fills. --------------------------------
ALIGNER_PHRASES = {
    "reads; of these:": "num_reads",
    "were paired; of these:": "num_reads_paired",
    "were unpaired; of these:": "num_reads_unpaired",
    "aligned concordantly 0 times": "num_concordant_reads_unaligned",
    "aligned concordantly exactly 1 time": "num_concordant_reads_uniquely_aligned",
    "aligned concordantly >1 times": "num_concordant_multimappers",
    "aligned discordantly 1 time": "num_discordant_reads_aligned",
    "aligned 0 times": "num_unaligned",
    "aligned exactly 1 time": "num_uniquely_aligned",
    "aligned >1 times": "num_multimappers",
    "overall alignment rate": "per_alignment",
}

# ---- Fixed values: summary numbers kept from the alignment statistics. --------------------------------------------
SAMTOOLS_COLUMNS = [
    "reads_MQ0", "average_quality", "insert_size_average", "insert_size_standard_deviation",
    "inward_oriented_pairs", "outward_oriented_pairs", "pairs_with_other_orientation",
    "pairs_on_different_chromosomes",
]
BAMTOOLS_PERCENTS = {
    "Percent Mapped": "Mapped reads",
    "Percent Forward": "Forward strand",
    "Percent Reverse": "Reverse strand",
    "Percent Failed QC": "Failed QC",
    "Percent Duplicates": "Duplicates",
    "Percent Paired-end": "Paired-end reads",
}

# ---- Fixed values: the columns of the RNA metrics summary. --------------------------------------------------------
RNA_LONGS = [
    "CODING_BASES", "CORRECT_STRAND_READS", "IGNORED_READS", "INCORRECT_STRAND_READS", "INTERGENIC_BASES",
    "INTRONIC_BASES", "PF_ALIGNED_BASES", "PF_BASES", "UTR_BASES",
]
RNA_DOUBLES = [
    "LIBRARY", "MEDIAN_3PRIME_BIAS", "MEDIAN_5PRIME_BIAS", "MEDIAN_5PRIME_TO_3PRIME_BIAS", "MEDIAN_CV_COVERAGE",
    "NUM_R1_TRANSCRIPT_STRAND_READS", "NUM_R2_TRANSCRIPT_STRAND_READS", "NUM_UNEXPLAINED_READS", "PCT_CODING_BASES",
    "PCT_CORRECT_STRAND_READS", "PCT_INTERGENIC_BASES", "PCT_INTRONIC_BASES", "PCT_MRNA_BASES",
    "PCT_R1_TRANSCRIPT_STRAND_READS", "PCT_R2_TRANSCRIPT_STRAND_READS", "PCT_RIBOSOMAL_BASES", "PCT_USABLE_BASES",
    "PCT_UTR_BASES", "READ_GROUP", "RIBOSOMAL_BASES", "SAMPLE",
]
RNA_PROJECTION = [
    "PCT_CODING_BASES", "PCT_UTR_BASES", "PCT_INTRONIC_BASES", "PCT_INTERGENIC_BASES", "PCT_MRNA_BASES",
    "MEDIAN_CV_COVERAGE", "MEDIAN_5PRIME_BIAS", "MEDIAN_3PRIME_BIAS", "MEDIAN_5PRIME_TO_3PRIME_BIAS",
]

# ---- Fixed values: what a finished tool's log must (or must not) say. ---------------------------------------------
COMPLETION = {
    "fastq_screen": ("Processing complete",),
    "rnaseqmetrics": ("CollectRnaSeqMetrics done",),
    "markduplicates": ("MarkDuplicates done",),
    "count_summary": ("Read assignment finished", "Summary of counting results"),
}
FORBIDDEN = {"aln_stats": "error"}


def report_lines(reports: DataFrame) -> DataFrame:
    """One row per line of a report, for ad-hoc scans."""
    return reports.select("srr", "stage", F.posexplode(X.lines(F.col("body"))).alias("line_no", "line"))


# ---- screen -------------------------------------------------------------------------------------------------------

def screen_metrics(reports: DataFrame) -> DataFrame:
    """Eleven metrics per run and reference genome. Lines of another shape are ignored."""
    hits = (reports.select("srr", F.explode(X.lines(F.col("body"))).alias("line"))
            .where(F.col("line").rlike(SCREEN_LINE)))
    group = lambda i: F.regexp_extract("line", SCREEN_LINE, i)
    return hits.select("srr", group(1).alias("reference"),
                       *[group(i + 2).cast(dtype).alias(name) for i, (name, dtype) in enumerate(SCREEN_METRICS)])


def screen_long(metrics: DataFrame) -> DataFrame:
    """(run, reference, type, value) rows."""
    names = [name for name, _ in SCREEN_METRICS]
    return (metrics.select("srr", "reference", *[F.col(n).cast("double").alias(n) for n in names])
            .unpivot(["srr", "reference"], names, "type", "value"))


def wide(long: DataFrame, keys: list[str], name: str, value: str, names: list[str]) -> DataFrame:
    """Long to wide for known names: conditional aggregates, so one shuffle where a pivot takes two."""
    return long.groupBy(*keys).agg(*[F.max(F.when(F.col(name) == n, F.col(value))).alias(n) for n in names])


def unstack(long: DataFrame) -> DataFrame:
    """(run, reference, type, value) rows to one row per run and reference."""
    return wide(long, ["srr", "reference"], "type", "value", [name for name, _ in SCREEN_METRICS])


def screen_summary(metrics: DataFrame) -> DataFrame:
    """Percent of reads mapping to one reference only, long form."""
    filled = metrics.na.fill(0)
    hit = F.col("one_hit_one_library_count") + F.col("multiple_hits_one_library_count")
    return filled.select("srr", "reference", X.percent(hit, F.col("reads_processed_count")).alias("pct_reads_mapped"))


def screen_wide(summary: DataFrame, references: list[str]) -> DataFrame:
    """One row per run with ``<reference>_pct_reads_mapped`` columns."""
    return wide(summary, ["srr"], "reference", "pct_reads_mapped", references).withColumnsRenamed(
        {r: f"{r}_pct_reads_mapped" for r in references})


# ---- trimming -----------------------------------------------------------------------------------------------------

def trim_log(reports: DataFrame, min_written: int = 1_000, carry: tuple[str, ...] = ()) -> DataFrame:
    """Counts of the trim log (first match wins) and a status; nothing is lost when a log cannot be read. ``carry``
    names columns that come along."""
    body = F.translate("body", ",", "")

    def first(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(body, pattern, 1), F.lit("")).try_cast("bigint")

    row = reports.select("srr", *carry, first(TRIM_PROCESSED).alias("total_processed"),
                         first(TRIM_WRITTEN).alias("total_written"), first(TRIM_SHORT).alias("too_short"))
    missing = F.col("total_processed").isNull() | F.col("total_written").isNull() | F.col("too_short").isNull()
    return row.withColumn("status", F.when(missing, "parse_error")
                          .when(F.col("total_written") < min_written, "too_few_reads").otherwise("ok"))


# ---- alignment ----------------------------------------------------------------------------------------------------

def aligner_log(reports: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Eleven numbers of the aligner's summary; the last line with a phrase wins, absent ones are null. ``carry`` names
    columns that come along."""
    rows = F.transform(X.lines(F.col("body")), lambda r: F.regexp_replace(r, r"^\s+|\s+$", ""))
    kept = F.filter(rows, lambda r: ~(r.startswith("Warning") | r.startswith("---")) & r.rlike(ALIGNER_LINE))
    pairs = F.transform(kept, lambda r: F.struct(
        F.regexp_extract(r, ALIGNER_LINE, 3).alias("name"), F.regexp_extract(r, ALIGNER_LINE, 1).alias("value")))
    return reports.select("srr", *carry, pairs.alias("_pairs")).select(
        "srr", *carry, *[X.last_value(F.col("_pairs"), phrase).try_cast("double").alias(name)
                         for phrase, name in ALIGNER_PHRASES.items()])


def alignment_gate(rows: DataFrame, min_unique: int = 1_000, min_percent: float = 1.0) -> DataFrame:
    """Missing numbers count 0; rows below the gate keep their numbers and carry a status."""
    filled = rows.na.fill(0, list(ALIGNER_PHRASES.values()))
    unique = F.col("num_concordant_reads_uniquely_aligned") + F.col("num_uniquely_aligned")
    poor = (F.col("per_alignment") < min_percent) | (unique < min_unique)
    return filled.withColumn("status", F.when(poor, "poor_alignment").otherwise("ok"))


def _named_values(pattern: str, name: Column) -> Column:
    # the patterns want a character after the value, which a split line has lost
    rows = F.filter(F.transform(X.lines(F.col("body")), lambda r: F.concat(r, F.lit("\n"))),
                    lambda r: r.rlike(pattern))
    return F.transform(rows, lambda r: F.struct(
        name(F.regexp_extract(r, pattern, 1)).alias("name"), F.regexp_extract(r, pattern, 2).alias("value")))


def samtools_stats(reports: DataFrame) -> DataFrame:
    """The eight summary numbers that are kept, as doubles where they can be fractions and as longs where not."""
    pairs = _named_values(SAMTOOLS_LINE, lambda n: F.translate(n, " ", "_"))
    types = {f.name: f.dataType for f in schemas.STAGES["aln_stats"].fields}
    return reports.select("srr", pairs.alias("_pairs")).select(
        "srr", *[X.last_value(F.col("_pairs"), c).try_cast("double").cast(types[c]).alias(c)
                 for c in SAMTOOLS_COLUMNS])


def bamtools_stats(reports: DataFrame) -> DataFrame:
    """Six percentages of all reads."""
    pairs = _named_values(BAMTOOLS_LINE, lambda n: F.replace(n, F.lit("'"), F.lit("")))

    def count(name: str) -> Column:
        return X.last_value(F.col("_pairs"), name).try_cast("bigint")

    return reports.select("srr", pairs.alias("_pairs")).select(
        "srr", *[X.percent(count(part), count("Total reads")).alias(name)
                 for name, part in BAMTOOLS_PERCENTS.items()])


def alignment_stats(samtools: DataFrame, bamtools: DataFrame) -> DataFrame:
    """The two statistics side by side: the ``aln_stats`` stage row."""
    return samtools.join(bamtools.select("srr", "Percent Forward", "Percent Reverse"), "srr", "full")


# ---- RNA metrics --------------------------------------------------------------------------------------------------

def _two_lines(before: str) -> tuple[Column, Column]:
    """Fields of two consecutive lines of the report; ``before`` is the pattern that leads up to the first."""
    pattern = rf"(?:^|\n){before}([^\n]*)\n([^\n]*)"
    return tuple(X.fields(F.regexp_replace(F.regexp_extract("body", pattern, i), "\r$", "")) for i in (1, 2))


def rna_summary(reports: DataFrame) -> DataFrame:
    """Thirty typed columns of the RNA metrics summary; ``?`` is null."""
    header, values = _two_lines("(?=PF_BASES)")
    split = reports.select("srr", header.alias("_h"), values.alias("_v"))

    def value(name: str) -> Column:
        return X.number(X.by_header(F.col("_h"), F.col("_v"), name))

    return split.select("srr", *[value(c).cast("bigint").alias(c) for c in RNA_LONGS],
                        *[value(c).alias(c) for c in RNA_DOUBLES])


def rna_projection(summary: DataFrame) -> DataFrame:
    """The ``rnaseqmetrics`` stage row: nine columns, missing is 0, fractions become percents."""
    def column(c: str) -> Column:
        filled = F.coalesce(F.col(c), F.lit(0.0))
        return (filled * 100 if c.startswith("PCT_") else filled).alias(c.lower().replace("pct_", "percent_"))

    return summary.select("srr", *[column(c) for c in RNA_PROJECTION])


def coverage_histogram(reports: DataFrame) -> DataFrame:
    """The 101 normalised coverage values as one array (``genebody_coverage`` stage row); null where a report has any
    other number of rows."""
    table = F.regexp_extract("body", r"(?:^|\n)normalized[^\n]*\n([\s\S]*)", 1)
    rows = F.filter(X.lines(table), lambda r: (r != "") & ~r.startswith("#"))
    values = F.transform(rows, lambda r: X.number(F.get(X.fields(r), 1)))
    return reports.select("srr", F.when(F.size(values) == schemas.N_COVERAGE, values).alias("coverage"))


def strand_call(first: DataFrame, second: DataFrame, threshold: float = 0.75) -> DataFrame:
    """Strandedness from the summaries under first- and second-strand assumption; a missing share is no evidence. A run
    that lacks one of its two summaries has no strand (null), and stays visible."""
    def share(summary: DataFrame, name: str) -> DataFrame:
        return summary.select("srr", F.coalesce(F.col("PCT_CORRECT_STRAND_READS") >= threshold, F.lit(False)).alias(name))

    strand = F.when(F.col("_first"), "same_strand").when(F.col("_second"), "opposite_strand").otherwise("unstranded")
    complete = F.col("_first").isNotNull() & F.col("_second").isNotNull()
    return share(first, "_first").join(share(second, "_second"), "srr", "full").select(
        "srr", F.when(complete, strand).alias("strand"))


# ---- duplicates ---------------------------------------------------------------------------------------------------

def duplicate_metrics(reports: DataFrame) -> DataFrame:
    """The ``markduplicates`` stage row: six columns, missing is 0, the fraction becomes a percent."""
    header, values = _two_lines(r"## METRICS CLASS[^\n]*\n")
    split = reports.select("srr", header.alias("_h"), values.alias("_v"))

    def column(field) -> Column:
        value = F.coalesce(X.number(X.by_header(F.col("_h"), F.col("_v"), field.name.upper())), F.lit(0.0))
        return (value * 100 if field.name.startswith("percent") else value).cast(field.dataType).alias(field.name)

    return split.select("srr", *[column(f) for f in schemas.STAGES["markduplicates"].fields if f.name != "srr"])


# ---- completion ---------------------------------------------------------------------------------------------------

def completion(reports: DataFrame) -> DataFrame:
    """Add ``status``: failed when the stage's required phrase is absent or its forbidden word present."""
    status = F.lit("ok")
    for stage, phrases in COMPLETION.items():
        found = F.lit(False)
        for phrase in phrases:
            found = found | F.col("body").contains(phrase)
        status = F.when((F.col("stage") == stage) & ~found, "failed").otherwise(status)
    for stage, word in FORBIDDEN.items():
        status = F.when((F.col("stage") == stage) & F.lower("body").contains(word), "failed").otherwise(status)
    return reports.withColumn("status", status)
