"""Report parsers. The texts are built in Spark from per-run numbers; the SQL computes on the numbers alone."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortqc.operators import reports as P
from cohortqc.operators.status import REQUIRED
from cohortqc.operators.status import run_states as run_state_table
from cohortqc.plans import jobs
from cohortqc.session import shared_folder, written
from cohortqc.sources import tables
from cohortqc.streaming.completion import CHANGES, latest_states, stream_states
from cohortqc.workload.registry import query, rounded
from cohortqc.workload.views import ctes, load, stored

N = ctes("numbers_v")


def _reports(spark, sf, stage: str, body: Column, variant: str = "", rows: DataFrame | None = None) -> DataFrame:
    """The reports as a pipeline has them: texts on disk, written once per session. With ``rows`` the texts of other
    runs, not written."""
    if rows is not None:
        return rows.select("*", F.lit(stage).alias("stage"), body.alias("body"))
    return stored(spark, sf, f"report-{stage}{variant}", lambda: load(spark, sf, "numbers_v").select(
        "srr", F.lit(stage).alias("stage"), body.alias("body")))


def _text(*lines) -> Column:
    """Lines joined with line breaks; every line is a list of columns and literals."""
    def line(parts):
        parts = parts if isinstance(parts, tuple) else (parts,)
        return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.concat_ws("\n", *[line(x) for x in lines], F.lit(""))


def c(text: str) -> Column:
    return F.expr(text)


# ---- screen -------------------------------------------------------------------------------------------------------

def _screen(spark, sf, rows=None):
    def genome(name, one, multi):
        return (f"{name}\t", c("n * 1000"), "\t", c(f"n * 1000 - {one} - {multi}"), "\t-", c("nf"), ".25\t", c(one),
                "\t1.5\t", c(multi), "\t0.5\t", c("no"), "\t0\t", c("np"), "\t0.75")
    return _reports(spark, sf, "fastq_screen", _text(
        "#Fastq_screen version: 0.14.0", "Genome\t#Reads_processed\t#Unmapped", genome("rRNA", "nf * 10", "no"),
        genome("dm6", "no * 20", "np"), genome("ecoli", "np * 5", "nf"), "", "%Hit_no_genomes: 3.25"), rows=rows)


_SCREEN = f"""WITH {N}, metrics AS (
    SELECT srr, 'rRNA' AS reference, nf * 10 AS one, no AS multi, * EXCLUDE (srr) FROM numbers_v
    UNION ALL SELECT srr, 'dm6', no * 20, np, * EXCLUDE (srr) FROM numbers_v
    UNION ALL SELECT srr, 'ecoli', np * 5, nf, * EXCLUDE (srr) FROM numbers_v)"""


@query("screen_metrics", f"""{_SCREEN} SELECT srr, reference, n * 1000 AS reads_processed_count,
    n * 1000 - one - multi AS unmapped_count, nf + 0.25::DOUBLE AS unmapped_percent, one AS one_hit_one_library_count,
    1.5::DOUBLE AS one_hit_one_library_percent, multi AS multiple_hits_one_library_count,
    0.5::DOUBLE AS multiple_hits_one_library_percent, no AS one_hit_multiple_libraries_count,
    0::DOUBLE AS one_hit_multiple_libraries_percent, np AS multiple_hits_multiple_libraries_count,
    0.75::DOUBLE AS multiple_hits_multiple_libraries_percent FROM metrics""")
def screen_metrics(spark, sf):
    return P.screen_metrics(_screen(spark, sf))


@query("screen_unstack", f"""{_SCREEN} SELECT srr, reference, (n * 1000)::DOUBLE AS reads_processed_count,
    (n * 1000 - one - multi)::DOUBLE AS unmapped_count, one::DOUBLE AS one_hit_one_library_count FROM metrics""")
def screen_unstack(spark, sf):
    return P.unstack(P.screen_long(P.screen_metrics(_screen(spark, sf)))).select(
        "srr", "reference", "reads_processed_count", "unmapped_count", "one_hit_one_library_count")


@query("screen_summary", f"""{_SCREEN} SELECT srr,
    round(max((one + multi) / (n * 1000) * 100) FILTER (reference = 'rRNA'), 6) AS "rRNA_pct_reads_mapped",
    round(max((one + multi) / (n * 1000) * 100) FILTER (reference = 'dm6'), 6) AS dm6_pct_reads_mapped,
    round(max((one + multi) / (n * 1000) * 100) FILTER (reference = 'ecoli'), 6) AS ecoli_pct_reads_mapped
    FROM metrics GROUP BY srr""")
def screen_summary(spark, sf):
    return rounded(P.screen_wide(P.screen_summary(P.screen_metrics(_screen(spark, sf))), ["rRNA", "dm6", "ecoli"]))


# ---- trimming and alignment ---------------------------------------------------------------------------------------

def _comma(text: str) -> Column:
    return F.format_number(c(text), 0)


def _share(part: str, of: str):
    """A percentage as the tools print it."""
    return F.format_string("%.1f%%", c(part) * 100 / F.greatest(c(of), F.lit(1)))


def _trim(spark, sf, rows=None):
    written = "n * 1000 - np * 900"
    single = _text("Reads                     records  fraction", ("Total reads processed:      ", _comma("n * 1100")),
                   ("Reads that were too short:     ", _comma("nf * 7"), "      ", _share("nf * 7", "n * 1100")),
                   ("Reads written (passing filters):       ", _comma(written), "     ", _share(written, "n * 1100")))
    pairs = _text("Pairs                     records  fraction", ("Total read pairs processed:   ", _comma("n * 1100")),
                  ("Read 1 with adapter:      ", _comma("nf * 3"), "     ", _share("nf * 3", "n * 1100")),
                  ("Pairs that were too short:     ", _comma("nf * 7"), "      ", _share("nf * 7", "n * 1100")),
                  ("Pairs written (passing filters):       ", _comma(written), "     ", _share(written, "n * 1100")))
    broken = F.lit("ERROR: cannot open file")
    body = F.when(c("no = 0"), broken).when(c("nf > no"), pairs).otherwise(single)
    return _reports(spark, sf, "atropos", body, rows=rows)


@query("trim_log", f"""WITH {N} SELECT srr, CASE WHEN no > 0 THEN n * 1100 END AS total_processed,
    CASE WHEN no > 0 THEN n * 1000 - np * 900 END AS total_written, CASE WHEN no > 0 THEN nf * 7 END AS too_short,
    CASE WHEN no = 0 THEN 'parse_error' WHEN n * 1000 - np * 900 < 1000 THEN 'too_few_reads' ELSE 'ok' END AS status
    FROM numbers_v""")
def trim_log(spark, sf):
    return P.trim_log(_trim(spark, sf))


def _aligner(spark, sf, rows=None):
    def line(indent: int, count: str, of: str, text: str):
        return " " * indent, c(count), " (", _share(count, of), f") {text}"

    single = _text((c("n * 1000"), " reads; of these:"), line(2, "n * 1000", "n * 1000", "were unpaired; of these:"),
                   line(4, "np * 100", "n * 1000", "aligned 0 times"),
                   line(4, "no * 200", "n * 1000", "aligned exactly 1 time"),
                   line(4, "nf * 10", "n * 1000", "aligned >1 times"), (c("no * 3"), ".5% overall alignment rate"))
    pairs = _text("Warning: skipped 3 reads; of these:", (c("n * 500"), " reads; of these:"),
                  line(2, "n * 500", "n * 500", "were paired; of these:"),
                  line(4, "nf * 11", "n * 500", "aligned concordantly 0 times"),
                  line(4, "no * 90", "n * 500", "aligned concordantly exactly 1 time"),
                  line(4, "np * 3", "n * 500", "aligned concordantly >1 times"), "    ----",
                  ("    ", c("nf * 11"), " pairs aligned concordantly 0 times; of these:"),
                  line(6, "nf * 2", "nf * 11", "aligned discordantly 1 time"), "    ----",
                  ("      ", c("nf * 18"), " mates make up the pairs; of these:"),
                  line(8, "nf * 5", "nf * 18", "aligned 0 times"), line(8, "nf * 7", "nf * 18", "aligned exactly 1 time"),
                  line(8, "nf * 6", "nf * 18", "aligned >1 times"), (c("n * 5"), ".25% overall alignment rate"))
    return _reports(spark, sf, "hisat2", F.when(c("nf > no"), pairs).otherwise(single), rows=rows)


_ALIGNER = f"""WITH {N}, parsed AS (
    SELECT srr, CASE WHEN pe THEN n * 500 ELSE n * 1000 END AS num_reads, CASE WHEN pe THEN n * 500 END AS num_reads_paired,
      CASE WHEN NOT pe THEN n * 1000 END AS num_reads_unpaired,
      CASE WHEN pe THEN nf * 11 END AS num_concordant_reads_unaligned,
      CASE WHEN pe THEN no * 90 END AS num_concordant_reads_uniquely_aligned,
      CASE WHEN pe THEN np * 3 END AS num_concordant_multimappers,
      CASE WHEN pe THEN nf * 2 END AS num_discordant_reads_aligned,
      CASE WHEN pe THEN nf * 5 ELSE np * 100 END AS num_unaligned,
      CASE WHEN pe THEN nf * 7 ELSE no * 200 END AS num_uniquely_aligned,
      CASE WHEN pe THEN nf * 6 ELSE nf * 10 END AS num_multimappers,
      CASE WHEN pe THEN n * 5 + 0.25 ELSE no * 3 + 0.5 END AS per_alignment
    FROM (SELECT *, nf > no AS pe FROM numbers_v) t)"""


@query("aligner_log", f"{_ALIGNER} SELECT srr, {', '.join(f'{v}::DOUBLE AS {v}' for v in P.ALIGNER_PHRASES.values())} "
                      "FROM parsed")
def aligner_log(spark, sf):
    return P.aligner_log(_aligner(spark, sf))


@query("alignment_gate", f"""{_ALIGNER} SELECT srr, num_concordant_multimappers_0 AS num_concordant_multimappers,
    CASE WHEN per_alignment < 1 OR coalesce(num_concordant_reads_uniquely_aligned, 0) + num_uniquely_aligned < 1000
    THEN 'poor_alignment' ELSE 'ok' END AS status
    FROM (SELECT *, coalesce(num_concordant_multimappers, 0)::DOUBLE AS num_concordant_multimappers_0 FROM parsed) t""")
def alignment_gate(spark, sf):
    return P.alignment_gate(P.aligner_log(_aligner(spark, sf))).select("srr", "num_concordant_multimappers", "status")


def _samtools(spark, sf, rows=None):
    return _reports(spark, sf, "aln_stats", _text(
        "# This file was produced by samtools stats", "CHK\t1\t2\t3", ("SN\traw total sequences:\t", c("n * 1000")),
        ("SN\treads MQ0:\t", c("np * 3"), "\t# mapped and MQ=0"), ("SN\taverage quality:\t", c("n + 20"), ".5"),
        ("SN\tinsert size average:\t", c("no * 10"), ".0"), "SN\tinsert size standard deviation:\t12.5",
        ("SN\tinward oriented pairs:\t", c("nf")), ("SN\toutward oriented pairs:\t", c("no")),
        ("SN\tpairs with other orientation:\t", c("np")), ("SN\tpairs on different chromosomes:\t", c("n")),
        "FFQ\t1\t0"), rows=rows)


@query("samtools_stats", f"""WITH {N} SELECT srr, np * 3 AS "reads_MQ0", n + 20.5::DOUBLE AS average_quality,
    (no * 10)::DOUBLE AS insert_size_average, 12.5::DOUBLE AS insert_size_standard_deviation,
    nf AS inward_oriented_pairs, no AS outward_oriented_pairs, np AS pairs_with_other_orientation,
    n AS pairs_on_different_chromosomes FROM numbers_v""")
def samtools_stats(spark, sf):
    return P.samtools_stats(_samtools(spark, sf))


def _bamtools(spark, sf, rows=None):
    return _reports(spark, sf, "bam_stats", _text(
        "**********************************************", "Stats for BAM file(s): ", "",
        ("Total reads:       ", c("n * 1000")), ("Mapped reads:      ", c("n * 1000 - nf"), "\t(99%)"),
        ("Forward strand:    ", c("no * 10"), "\t(50%)"), ("Reverse strand:    ", c("n * 1000 - no * 10"), "\t(50%)"),
        ("Failed QC:         ", c("0 * n"), "\t(0%)"), ("Duplicates:        ", c("np * 2"), "\t(0%)"),
        ("Paired-end reads:  ", c("nf * 2"), "\t(0%)"), ("'Proper-pairs':    ", c("nf"))), rows=rows)


@query("bamtools_stats", f"""WITH {N} SELECT srr, round((n * 1000 - nf) / (n * 1000) * 100, 6) AS "Percent Mapped",
    round(no * 10 / (n * 1000) * 100, 6) AS "Percent Forward",
    round((n * 1000 - no * 10) / (n * 1000) * 100, 6) AS "Percent Reverse", 0::DOUBLE AS "Percent Failed QC",
    round(np * 2 / (n * 1000) * 100, 6) AS "Percent Duplicates",
    round(nf * 2 / (n * 1000) * 100, 6) AS "Percent Paired-end" FROM numbers_v""")
def bamtools_stats(spark, sf):
    return rounded(P.bamtools_stats(_bamtools(spark, sf)))


@query("alignment_reports", f"""WITH {N} SELECT srr, np * 3 AS "reads_MQ0", n + 20.5::DOUBLE AS average_quality,
    round(no * 10 / (n * 1000) * 100, 6) AS "Percent Forward",
    round((n * 1000 - no * 10) / (n * 1000) * 100, 6) AS "Percent Reverse" FROM numbers_v""")
def alignment_reports(spark, sf):
    joined = P.alignment_stats(P.samtools_stats(_samtools(spark, sf)), P.bamtools_stats(_bamtools(spark, sf)))
    return rounded(joined.select("srr", "reads_MQ0", "average_quality", "Percent Forward", "Percent Reverse"))


# ---- RNA metrics and duplicates -----------------------------------------------------------------------------------

_RNA_COLUMNS = ["PF_BASES", "PF_ALIGNED_BASES", "RIBOSOMAL_BASES", "CODING_BASES", "UTR_BASES", "INTRONIC_BASES",
                "INTERGENIC_BASES", "IGNORED_READS", "CORRECT_STRAND_READS", "INCORRECT_STRAND_READS",
                "PCT_CODING_BASES", "PCT_UTR_BASES", "PCT_INTRONIC_BASES", "PCT_INTERGENIC_BASES", "PCT_MRNA_BASES",
                "PCT_CORRECT_STRAND_READS", "MEDIAN_CV_COVERAGE", "MEDIAN_5PRIME_BIAS", "MEDIAN_3PRIME_BIAS",
                "MEDIAN_5PRIME_TO_3PRIME_BIAS", "SAMPLE", "LIBRARY", "READ_GROUP"]


def _rna(spark, sf, correct: str = "nf", rows=None):
    def fraction(part):
        return F.format_string("%d.%02d", c(f"{part} * 100 div n div 100").cast("int"),
                               c(f"{part} * 100 div n % 100").cast("int"))
    values = [c("n * 5000"), c("n * 4000"), "\t".join([""]), c("nf * 100"), c("no * 100"), c("np * 100"), c("n * 7"),
              "0", c("nf"), c("no"), fraction("nf"), fraction("no"), fraction("np"), "0.25", fraction("(nf + no)"),
              F.when(c("np = 0"), "?").otherwise(fraction(correct)), "0.5", "?", "1.25", "0.75", "", "", ""]
    row = [values[0]]
    for v in values[1:]:
        row += ["\t", v]
    histogram = F.concat_ws("\n", F.transform(F.sequence(F.lit(0), F.lit(100)), lambda i: F.concat(
        i.cast("string"), F.lit("\t"), F.floor((F.col("n") * i) % 97 / 10).cast("string"), F.lit("."),
        ((F.col("n") * i) % 97 % 10).cast("string"))))
    return _reports(spark, sf, "rnaseqmetrics", _text(
        "## htsjdk.samtools.metrics.StringHeader", "# CollectRnaSeqMetrics", "## METRICS CLASS\tRnaSeqMetrics",
        "\t".join(_RNA_COLUMNS), tuple(row), "", "## HISTOGRAM\tjava.lang.Integer",
        "normalized_position\tAll_Reads.normalized_coverage", (histogram,)), f"-{correct}", rows)


_RNA_VALUES = {
    "PF_BASES": "n * 5000", "PF_ALIGNED_BASES": "n * 4000", "CODING_BASES": "nf * 100", "UTR_BASES": "no * 100",
    "INTRONIC_BASES": "np * 100", "INTERGENIC_BASES": "n * 7", "IGNORED_READS": "0", "CORRECT_STRAND_READS": "nf",
    "INCORRECT_STRAND_READS": "no", "PCT_CODING_BASES": "(nf * 100 // n) / 100", "PCT_UTR_BASES": "(no * 100 // n) / 100",
    "PCT_INTRONIC_BASES": "(np * 100 // n) / 100", "PCT_INTERGENIC_BASES": "0.25",
    "PCT_MRNA_BASES": "((nf + no) * 100 // n) / 100",
    "PCT_CORRECT_STRAND_READS": "CASE WHEN np > 0 THEN (nf * 100 // n) / 100 END", "MEDIAN_CV_COVERAGE": "0.5",
    "MEDIAN_3PRIME_BIAS": "1.25", "MEDIAN_5PRIME_TO_3PRIME_BIAS": "0.75"}


def _rna_column(name: str) -> str:
    value = _RNA_VALUES.get(name, "NULL")  # what the report leaves out or marks with a question mark
    return f'({value})::BIGINT AS "{name}"' if name in P.RNA_LONGS else f'round(({value})::DOUBLE, 6) AS "{name}"'


@query("picard_summary", f"""WITH {N} SELECT srr, {', '.join(map(_rna_column, [*P.RNA_LONGS, *P.RNA_DOUBLES]))}
    FROM numbers_v""")
def picard_summary(spark, sf):
    return rounded(P.rna_summary(_rna(spark, sf)))


@query("picard_projection", f"""WITH {N} SELECT srr, (nf * 100 // n)::DOUBLE AS percent_coding_bases,
    (no * 100 // n)::DOUBLE AS percent_utr_bases, (np * 100 // n)::DOUBLE AS percent_intronic_bases,
    25::DOUBLE AS percent_intergenic_bases, ((nf + no) * 100 // n)::DOUBLE AS percent_mrna_bases,
    0.5::DOUBLE AS median_cv_coverage, 0::DOUBLE AS median_5prime_bias, 1.25::DOUBLE AS median_3prime_bias,
    0.75::DOUBLE AS median_5prime_to_3prime_bias FROM numbers_v""")
def picard_projection(spark, sf):
    return rounded(P.rna_projection(P.rna_summary(_rna(spark, sf))))


@query("picard_histogram", f"""WITH {N} SELECT srr, pos::INTEGER AS pos, round((n * pos) % 97 / 10, 6) AS coverage
    FROM (SELECT *, unnest(range(0, 101)) AS pos FROM numbers_v) t""")
def picard_histogram(spark, sf):
    return rounded(P.coverage_histogram(_rna(spark, sf)).select("srr", F.posexplode("coverage").alias("pos", "coverage")))


@query("strand_call", f"""WITH {N} SELECT srr, CASE WHEN np > 0 AND nf * 100 // n >= 75 THEN 'same_strand'
    WHEN np > 0 AND no * 100 // n >= 75 THEN 'opposite_strand' ELSE 'unstranded' END AS strand FROM numbers_v""")
def strand_call(spark, sf):
    return P.strand_call(P.rna_summary(_rna(spark, sf, "nf")), P.rna_summary(_rna(spark, sf, "no")))


def _markdup(spark, sf, rows=None):
    names = ["LIBRARY", "UNPAIRED_READS_EXAMINED", "READ_PAIRS_EXAMINED", "SECONDARY_OR_SUPPLEMENTARY_RDS",
             "UNMAPPED_READS", "UNPAIRED_READ_DUPLICATES", "READ_PAIR_DUPLICATES", "READ_PAIR_OPTICAL_DUPLICATES",
             "PERCENT_DUPLICATION", "ESTIMATED_LIBRARY_SIZE"]
    size = F.when(c("np = 0"), "").otherwise(c("np * 1000").cast("string"))
    share = F.format_string("%d.%02d", c("nf * 100 div n div 100").cast("int"), c("nf * 100 div n % 100").cast("int"))
    body = _text("## htsjdk.samtools.metrics.StringHeader", "# MarkDuplicates", "",
                 "## METRICS CLASS\tpicard.sam.DuplicationMetrics", "\t".join(names),
                 ("Unknown\t", c("n * 10"), "\t", c("nf * 10"), "\t0\t3\t", c("n"), "\t", c("nf"), "\t0\t", share, "\t",
                  size), "", "## HISTOGRAM\tjava.lang.Double")
    return _reports(spark, sf, "markduplicates", body, rows=rows)


@query("markdup_metrics", f"""WITH {N} SELECT srr, n * 10 AS unpaired_reads_examined, nf * 10 AS read_pairs_examined,
    n AS unpaired_read_duplicates, nf AS read_pair_duplicates, (nf * 100 // n)::DOUBLE AS percent_duplication,
    CASE WHEN np = 0 THEN 0 ELSE np * 1000 END AS estimated_library_size FROM numbers_v""")
def markdup_metrics(spark, sf):
    return rounded(P.duplicate_metrics(_markdup(spark, sf)))


@query("completion_markers", f"""WITH {N} SELECT srr, CASE WHEN nf > no THEN 'markduplicates' WHEN np > no THEN 'aln_stats'
      ELSE 'count_summary' END AS stage,
    CASE WHEN nf > no THEN CASE WHEN np > 2 THEN 'ok' ELSE 'failed' END
         WHEN np > no THEN CASE WHEN np > 2 THEN 'failed' ELSE 'ok' END
         WHEN np > 2 OR np = 0 THEN 'ok' ELSE 'failed' END AS status FROM numbers_v""")
def completion_markers(spark, sf):
    rows = load(spark, sf, "numbers_v")
    stage = F.expr("CASE WHEN nf > no THEN 'markduplicates' WHEN np > no THEN 'aln_stats' ELSE 'count_summary' END")
    body = F.when(c("np > 2"), "step 1\nMarkDuplicates done.\nRead assignment finished, no Error") \
        .when(c("np = 0"), "Summary of counting results").otherwise("step 1")
    return P.completion(rows.select("srr", stage.alias("stage"), body.alias("body"))).select("srr", "stage", "status")


@query("report_scan", f"""WITH {N} SELECT srr, 16 AS n_lines, n * 500 AS first_number FROM numbers_v WHERE nf > no
    UNION ALL SELECT srr, 7, n * 1000 FROM numbers_v WHERE nf <= no""")
def report_scan(spark, sf):
    """Line-oriented scan of the aligner's reports: how many lines, and the number before ``reads; of these``."""
    number = F.regexp_extract("line", r"^(\d+) reads; of these:", 1)
    return P.report_lines(_aligner(spark, sf)).groupBy("srr").agg(
        F.count(F.lit(1)).cast("int").alias("n_lines"), F.max(F.nullif(number, F.lit("")).cast("bigint")).alias("first_number"))


@query("count_table_scan", f"""WITH {ctes('orders_v')} SELECT count(*) AS n_rows,
    sum(floor(o_totalprice))::BIGINT AS total FROM orders_v""")
def count_table_scan(spark, sf):
    """Count tables written as text and read back by their last column."""
    path = shared_folder(spark, "counts")
    rows = load(spark, sf, "orders_v").select(
        F.pmod(F.xxhash64("srr"), F.lit(8)).alias("run"), F.lit(2).alias("place"),
        F.concat_ws("\t", "srr", "o_orderpriority", F.floor("o_totalprice").cast("string")).alias("value"))
    # every file starts with its comment and its header, as the counter writes them
    heads = rows.select("run").distinct().select("run", F.posexplode(F.array(
        F.lit("# Program: counter"), F.lit("Geneid\tChr\trun.bam"))).alias("place", "value"))
    (rows.unionByName(heads).repartition("run").sortWithinPartitions("run", "place").select("run", "value")
     .write.partitionBy("run").text(path))
    return tables.read_counts(spark, path).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("count").alias("total"))


# ---- whole ingest of logs: report files of two attempts to stage tables, states and done marks ------------------------

_STAGES = ("aln_stats", "atropos", "fastq_screen", "genebody_coverage", "hisat2", "markduplicates", "rnaseqmetrics", "strand")
_SITES = """sites AS (SELECT 'N' || CAST(o_custkey % 20 AS VARCHAR) AS srr, count(*) AS n,
    count(*) FILTER (o_orderstatus = 'F') AS nf, count(*) FILTER (o_orderstatus = 'O') AS no,
    count(*) FILTER (o_orderstatus = 'P') AS np FROM orders GROUP BY ALL)"""


def _sites(spark, sf) -> DataFrame:
    """Few runs with many orders each: report files are one per run, kind and attempt."""
    status = F.col("o_orderstatus")
    return spark.read.parquet(f"{sf}/orders.parquet").groupBy(
        F.concat(F.lit("N"), (F.col("o_custkey") % 20).cast("string")).alias("srr")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(status == "F").alias("nf"), F.count_if(status == "O").alias("no"),
        F.count_if(status == "P").alias("np"))


def _site_logs(spark, sf) -> DataFrame:
    """srr, stage, attempt, body: a third of the runs have a broken trim log first, half of those again the second time;
    a fifth never get a duplicate report."""
    rows = written(_sites(spark, sf), "sites")
    finished = lambda df, line: df.withColumn("body", F.concat(F.lit(f"# {line}\n"), "body"))
    renamed = lambda df, stage: df.withColumn("stage", F.lit(stage))
    rna = finished(_rna(spark, sf, "nf", rows), "CollectRnaSeqMetrics done")
    first = [finished(_screen(spark, sf, rows), "Processing complete"), _aligner(spark, sf, rows), _samtools(spark, sf, rows),
             _bamtools(spark, sf, rows), rna, renamed(rna, "strand_first"),
             renamed(finished(_rna(spark, sf, "no", rows), "CollectRnaSeqMetrics done"), "strand_second"),
             finished(_markdup(spark, sf, rows.where("n % 5 <> 0")), "MarkDuplicates done")]
    one = F.lit(1).cast("bigint")
    trim = _trim(spark, sf, rows).withColumn("attempt", F.explode(F.array(one, one + 1))).where("attempt = 1 OR n % 3 = 0")
    broken = F.expr("n % 3 = 0 AND (attempt = 1 OR n % 2 = 1)")
    trim = trim.withColumn("body", F.when(broken, "ERROR: killed").otherwise(F.col("body")))
    logs = reduce(DataFrame.unionByName, [df.withColumn("attempt", one) for df in first] + [trim])
    return logs.select("srr", "stage", "attempt", "body")


@query("ingest_job", f"""WITH {_SITES}, judged AS (SELECT *,
      no = 0 OR n * 1000 - np * 900 < 1000 OR (n % 3 = 0 AND n % 2 = 1) AS bad_trim,
      CASE WHEN nf > no THEN n * 5 + 0.25 < 1 OR no * 90 + nf * 7 < 1000 ELSE no * 3 + 0.5 < 1 OR no * 200 < 1000 END AS bad_aln
    FROM sites)
    SELECT srr, CASE WHEN bad_trim OR bad_aln THEN 'failed' WHEN n % 5 = 0 THEN 'waiting' ELSE 'done' END AS state,
      concat_ws(',', CASE WHEN bad_trim THEN 'atropos' END, CASE WHEN bad_aln THEN 'hisat2' END) AS failed,
      CASE WHEN n % 5 = 0 THEN 'markduplicates' ELSE '' END AS missing,
      CASE WHEN bad_trim THEN NULL ELSE nf * 7 END AS too_short, CASE WHEN n % 5 = 0 THEN NULL ELSE n * 10 END AS examined,
      CASE WHEN np > 0 AND nf * 100 // n >= 75 THEN 'same_strand' WHEN np > 0 AND no * 100 // n >= 75 THEN 'opposite_strand'
           ELSE 'unstranded' END AS strand,
      CASE WHEN bad_trim OR bad_aln OR n % 5 = 0 THEN false ELSE true END AS marked FROM judged""")
def ingest_job(spark, sf):
    """Report files of two attempts, read back by their paths, through the job that fills the stage tables."""
    root = shared_folder(spark, "ingest")
    _site_logs(spark, sf).repartition(1).write.partitionBy("attempt", "stage", "srr").option("lineSep", "\n").text(f"{root}/reports")
    runs = _sites(spark, sf).select("srr")
    pattern = r"/srr=([^/]+)/"
    kinds = sorted({kind for kinds in jobs.STAGE_REPORTS.values() for kind in kinds})
    for attempt in (1, 2):
        logs = [tables.read_reports(spark, f"{root}/reports/attempt={attempt}/stage={kind}", kind, pattern)
                for kind in (kinds if attempt == 1 else ("atropos",))]
        states = jobs.ingest_logs(spark, runs, reduce(DataFrame.unionByName, logs), f"{root}/out", attempt, _STAGES)
    at = f"{root}/out/Features"
    table = lambda stage: tables.read_stage_folder(spark, f"{at}/{stage}", stage)
    done = tables.read_done(spark, f"{at}/done").groupBy("srr").agg((F.count(F.lit(1)) == 1).alias("marked"))
    return (states.join(table("atropos").select("srr", "too_short"), "srr", "left")
            .join(table("markduplicates").select("srr", F.col("unpaired_reads_examined").alias("examined")), "srr", "left")
            .join(table("strand"), "srr", "left").join(done, "srr", "left")
            .select("srr", "state", F.concat_ws(",", "failed").alias("failed"), F.concat_ws(",", "missing").alias("missing"),
                    "too_short", "examined", "strand", F.coalesce("marked", F.lit(False)).alias("marked")))


# ---- status rows in any order -----------------------------------------------------------------------------------------

_EVENTS = f"""events AS (SELECT 'E' || CAST(o_custkey % 60 AS VARCHAR) AS srr,
      {list(REQUIRED)}[CAST(floor(o_totalprice) AS BIGINT) % {len(REQUIRED)} + 1] AS stage, o_orderkey AS attempt,
      CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'failed' ELSE 'ok' END AS status FROM orders),
    newest AS (SELECT srr, stage, arg_max(status, attempt) AS status FROM events GROUP BY srr, stage),
    states AS (SELECT srr, list_sort(coalesce(list(stage) FILTER (status <> 'ok'), [])) AS failed,
      list_sort(list_filter({list(REQUIRED)}, lambda s: NOT list_contains(list(stage), s))) AS missing FROM newest GROUP BY srr)"""
_STATE = "CASE WHEN len(failed) > 0 THEN 'failed' WHEN len(missing) = 0 THEN 'done' ELSE 'waiting' END"


def _events(spark, sf) -> DataFrame:
    """Every order reports a stage; the newest attempts come mixed with old ones."""
    stage = F.get(F.array(*[F.lit(s) for s in REQUIRED]), (F.floor("o_totalprice") % len(REQUIRED)).cast("int"))
    return spark.read.parquet(f"{sf}/orders.parquet").select(
        F.concat(F.lit("E"), (F.col("o_custkey") % 60).cast("string")).alias("srr"), stage.alias("stage"),
        F.col("o_orderkey").alias("attempt"), F.expr("CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'failed' ELSE 'ok' END AS status"),
        F.col("o_orderpriority").alias("wave"))


@query("run_states", f"""WITH {_EVENTS} SELECT srr, {_STATE} AS state, array_to_string(failed, ',') AS failed,
    array_to_string(missing, ',') AS missing FROM states""")
def run_states(spark, sf):
    events = _events(spark, sf)
    states = run_state_table(events.select("srr").distinct(), events.drop("wave"))
    return states.select("srr", "state", F.concat_ws(",", "failed").alias("failed"), F.concat_ws(",", "missing").alias("missing"))


@query("run_states_stream", f"""WITH {_EVENTS} SELECT srr, {_STATE} AS state, array_to_string(failed, ',') AS failed
    FROM states WHERE len(failed) > 0 OR len(missing) = 0""")
def run_states_stream(spark, sf):
    """The same as a stream that is stopped and started again; every start finds new files, old attempts among them."""
    root = shared_folder(spark, "states")
    events = written(_events(spark, sf), "status-events")
    for wave in ("wave < '3'", "wave >= '3'"):
        events.where(wave).drop("wave").write.mode("append").parquet(f"{root}/status")
        stream_states(spark, f"{root}/status", f"{root}/changes", f"{root}/checkpoint", max_files=4).awaitTermination()
    found = latest_states(spark.read.schema(CHANGES).parquet(f"{root}/changes")).where("state <> 'waiting'")
    return found.select("srr", "state", F.concat_ws(",", "failed").alias("failed"))
