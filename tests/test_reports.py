"""Golden report texts and gates."""
import pytest

from cohortqc import schemas
from cohortqc.operators import reports as P
from cohortqc.plans.jobs import ingest_reports
from cohortqc.sources import tables


def report(spark, body, stage="x", srr="SRR1"):
    return spark.createDataFrame([(srr, stage, body)], schemas.REPORTS)


SCREEN = """#Fastq_screen version: 0.15.3\t#Aligner: bowtie2
adapters\t2000\t2000\t100.00\t0\t0.00\t0\t0.00\t0\t0.00\t0\t0.00
dm6\t2000\t500\t25.00\t1200\t60.00\t200\t10.00\t60\t3.00\t40\t2.00
ecoli\t2000\t1999\t-100.00\t1\t0.05\t0\t0.00\t0\t0.00\t0\t0.00

%Hit_no_genomes: 12.50
"""


def test_screen(spark):
    metrics = P.screen_metrics(report(spark, SCREEN))
    got = {r.reference: r.pct_reads_mapped for r in P.screen_summary(metrics).collect()}
    assert got["adapters"] == 0 and got["dm6"] == pytest.approx(70.0, abs=1e-9)
    assert got["ecoli"] == pytest.approx(0.05, abs=1e-9)
    assert metrics.where("reference = 'ecoli'").first().unmapped_percent == 100.0
    assert P.screen_metrics(report(spark, "nothing here")).count() == 0


TRIM_SE = """Reads      records  fraction
---------- ------- ---------
Total reads processed:                  12,400
Reads with adapter:                        310      2.5%
Reads that were too short:                 400      3.2%
Reads written (passing filters):        12,000     96.8%
"""
TRIM_PE = """Pairs      records  fraction
Total read pairs processed:              6,250
Read 1 with adapter:                       125      2.0%
Pairs that were too short:                 250      4.0%
Pairs written (passing filters):         6,000     96.0%
"""


@pytest.mark.parametrize("text, numbers, status", [
    (TRIM_SE, (12400, 12000, 400), "ok"), (TRIM_PE, (6250, 6000, 250), "ok"), ("ERROR", (None,) * 3, "parse_error"),
    (TRIM_PE.replace("6,000", "999"), (6250, 999, 250), "too_few_reads"),
    (TRIM_PE + TRIM_SE, (6250, 6000, 250), "ok")])
def test_trim_log(spark, text, numbers, status):
    row = P.trim_log(report(spark, text)).first()
    assert (row.total_processed, row.total_written, row.too_short) == numbers and row.status == status


ALIGN_SE = """12000 reads; of these:
  12000 (100.00%) were unpaired; of these:
    600 (5.00%) aligned 0 times
    10800 (90.00%) aligned exactly 1 time
    600 (5.00%) aligned >1 times
95.00% overall alignment rate
"""
ALIGN_PE = """6000 reads; of these:
  6000 (100.00%) were paired; of these:
    5100 (85.00%) aligned concordantly 0 times
    840 (14.00%) aligned concordantly exactly 1 time
    60 (1.00%) aligned concordantly >1 times
    ----
    5100 pairs aligned concordantly 0 times; of these:
      102 (2.00%) aligned discordantly 1 time
    ----
    4998 pairs aligned 0 times concordantly or discordantly; of these:
      9996 mates make up the pairs; of these:
        9846 (98.50%) aligned 0 times
        90 (0.90%) aligned exactly 1 time
        60 (0.60%) aligned >1 times
17.95% overall alignment rate
"""


def test_aligner_log(spark):
    se = P.aligner_log(report(spark, ALIGN_SE)).first().asDict()
    assert (se["num_reads"], se["num_reads_unpaired"], se["num_unaligned"], se["num_uniquely_aligned"],
            se["num_multimappers"], se["per_alignment"], se["num_reads_paired"]) == (
        12000, 12000, 600, 10800, 600, 95.0, None)
    pe = P.aligner_log(report(spark, ALIGN_PE)).first().asDict()
    assert [pe[c] for c in P.ALIGNER_PHRASES.values()] == [6000, 6000, None, 5100, 840, 60, 102, 9846, 90, 60, 17.95]


def test_alignment_gate(spark):
    def status(text):
        return P.alignment_gate(P.aligner_log(report(spark, text))).first().status
    assert status(ALIGN_SE) == "ok" and status(ALIGN_PE) == "poor_alignment"
    assert status(ALIGN_SE.replace("95.00%", "0.99%")) == "poor_alignment"
    assert status(ALIGN_SE.replace("95.00%", "1.0%")) == "ok"
    assert status(ALIGN_PE.replace("840", "910")) == "ok"


def test_last_phrase_wins_and_warnings_are_skipped(spark):
    text = "Warning: 5 reads; of these:\n10 reads; of these:\n20 reads; of these:\n---\n"
    assert P.aligner_log(report(spark, text)).first().num_reads == 20


def test_samtools_needs_a_summary_line(spark):
    text = "SN\treads MQ0:\t7\t# comment\nSN\taverage quality:\t35\nXX\treads MQ0:\t9\n"
    row = P.samtools_stats(report(spark, text)).first()
    assert row.reads_MQ0 == 7 and row.average_quality == 35.0 and row.inward_oriented_pairs is None


def test_picard_empty_report_gives_nulls(spark):
    row = P.rna_summary(report(spark, "no table")).first()
    assert row.PF_BASES is None and P.rna_projection(P.rna_summary(report(spark, ""))).first().percent_mrna_bases == 0


def test_strand_threshold(spark):
    def summary(share):
        return P.rna_summary(report(spark, f"## METRICS\nPF_BASES\tPCT_CORRECT_STRAND_READS\n1\t{share}\n"))
    def call(a, b):
        return P.strand_call(summary(a), summary(b)).first().strand
    assert call("0.75", "0.9") == "same_strand" and call("0.74", "0.75") == "opposite_strand"
    assert call("?", "0.1") == "unstranded"


@pytest.mark.parametrize("stage, log, status", [
    ("fastq_screen", "Processing complete", "ok"), ("fastq_screen", "Processing", "failed"),
    ("rnaseqmetrics", "picard.analysis.CollectRnaSeqMetrics done.", "ok"), ("markduplicates", "", "failed"),
    ("count_summary", "Summary of counting results", "ok"), ("count_summary", "Read assignment finished", "ok"),
    ("aln_stats", "some ERROR here", "failed"), ("aln_stats", "", "ok")])
def test_completion(spark, stage, log, status):
    assert P.completion(report(spark, log, stage)).first().status == status


def test_report_files_and_ingest(spark, tmp_path):
    (tmp_path / "SRR7_screen.txt").write_text(SCREEN)
    (tmp_path / "SRR8.log").write_text(TRIM_SE)
    rows = tables.read_reports(spark, str(tmp_path), "x")
    assert sorted(r.srr for r in rows.collect()) == ["SRR7", "SRR8"]
    assert ingest_reports(rows, "fastq_screen").count() == 3
    assert [r.srr for r in ingest_reports(rows, "atropos").collect()] == ["SRR8"]


def test_manifest(spark, tmp_path):
    two = tmp_path / "two.txt"
    two.write_text("#comment\nx\ty\nSRX1\tSRR1\nSRX1\tSRR2\n")
    assert [tuple(r) for r in tables.read_manifest(spark, str(two)).collect()] == [("SRX1", "SRR1"), ("SRX1", "SRR2")]
    one = tmp_path / "one.txt"
    one.write_text("srr\nSRR1\n")
    assert tuple(tables.read_manifest(spark, str(one)).first()) == (None, "SRR1")
    three = tmp_path / "three.txt"
    three.write_text("a\tb\tc\n1\t2\t3\n")
    with pytest.raises(ValueError):
        tables.read_manifest(spark, str(three))


def test_counts_sam_and_annotation(spark, tmp_path):
    (tmp_path / "SRR1.counts").write_text("# cmd\nGeneid\tLength\tSRR1.bam\ng1\t10\t3\ng2\t20\t0\n")
    assert sorted((r.srr, r["count"]) for r in tables.read_counts(spark, str(tmp_path / "SRR1.counts")).collect()) == [
        ("SRR1", 0), ("SRR1", 3)]
    (tmp_path / "SRR1.sam").write_text(
        "@HD\tVN:1.0\nr1\t16\tchr1\t5\t60\t4M\t*\t0\t0\tACGT\tIIII\tAS:i:0\tNH:i:2\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tA\tI\n")
    rows = tables.read_sam(spark, str(tmp_path / "SRR1.sam")).collect()
    assert [(r.qname, r.flag, r.pos, r.nh) for r in rows] == [("r1", 16, 5, 2), ("r2", 4, 0, None)]
    (tmp_path / "a.gtf").write_text(
        'c1\ts\texon\t5\t9\t.\t+\t.\tgene_id "g1"; transcript_id "t1";\nc1\ts\tgene\t1\t9\t.\t+\t.\tgene_id "g1";\n')
    assert [tuple(r) for r in tables.read_gtf(spark, str(tmp_path / "a.gtf")).collect()] == [
        ("g1", "t1", "c1", 5, 9, "+")]
    (tmp_path / "a.refflat").write_text("g1\tt1\tc1\t-\t4\t20\t6\t18\t2\t4,15,\t9,20,\n")
    row = tables.read_refflat(spark, str(tmp_path / "a.refflat")).first()
    assert (row.tx_start, row.cds_start, row.cds_end, row.exon_starts, row.exon_ends) == (5, 7, 18, [5, 16], [9, 20])


def test_counts_that_are_no_numbers_are_errors(spark, tmp_path):
    (tmp_path / "SRR1.counts").write_text("# cmd\ng0\t5\ng1\t3\n")  # the header is the first line, whatever it holds
    assert [r["count"] for r in tables.read_counts(spark, str(tmp_path / "SRR1.counts")).collect()] == [3]
    (tmp_path / "SRR2.counts").write_text("Geneid\tSRR2.bam\ng1\t3.5\n")
    with pytest.raises(Exception, match="no count in"):
        tables.read_counts(spark, str(tmp_path / "SRR2.counts")).collect()


@pytest.mark.parametrize("rows, known", [(100, False), (101, True), (102, False)])
def test_coverage_needs_all_rows(spark, rows, known):
    body = "normalized_position\tAll_Reads.normalized_coverage\n" + "".join(f"{i}\t{i / 10}\n" for i in range(rows))
    got = P.coverage_histogram(report(spark, body)).first().coverage
    assert (got is not None) == known and (not known or got[100] == 10.0)
