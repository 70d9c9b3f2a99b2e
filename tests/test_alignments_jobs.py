"""Interval joins under skew, CIGAR expressions, whole jobs."""
import gzip

import pytest
from pyspark.sql import functions as F

from cohortqc import schemas, sinks
from cohortqc.functions import cigar as C
from cohortqc.operators import alignments as A
from cohortqc.operators import coverage as V
from cohortqc.operators import intervals as I
from cohortqc.plans import jobs
from cohortqc.session import written
from cohortqc.sources import tables


@pytest.mark.parametrize("cigar, blocks, gaps, length, forward, reverse", [
    ("50M", [(100, 149)], [], 50, 100, 149), ("5S45M", [(100, 144)], [], 45, 95, 144),
    ("3H2S10M4S", [(100, 109)], [], 10, 95, 113), ("10M5N10M", [(100, 109), (115, 124)], [(110, 114)], 25, 100, 124),
    ("5=1X4M2D3M2I1M", [(100, 104), (105, 105), (106, 109), (112, 114), (115, 115)], [], 16, 100, 115),
    ("4M1P4M", [(100, 103), (104, 107)], [], 8, 100, 107)])
def test_cigar(spark, cigar, blocks, gaps, length, forward, reverse):
    pos, c = F.col("p"), F.col("c")
    row = spark.createDataFrame([(100, cigar)], "p bigint, c string").select(
        C.blocks(pos, c).alias("b"), C.junctions(pos, c).alias("j"), C.reference_length(c).alias("n"),
        C.aligned_length(c).alias("a"), C.unclipped_five_prime(pos, c, F.lit(False)).alias("f"),
        C.unclipped_five_prime(pos, c, F.lit(True)).alias("r")).first()
    assert [tuple(x) for x in row.b] == blocks and [tuple(x) for x in row.j] == gaps
    assert (row.n, row.f, row.r) == (length, forward, reverse) and row.a == sum(e - s + 1 for s, e in blocks)


@pytest.mark.parametrize("max_rows", [1_000_000, 0])
@pytest.mark.parametrize("width", [7, 1000])
def test_overlap_join_equals_the_raw_predicate(spark, max_rows, width):
    # one reference holds most rows, and one position a third of them
    big = spark.range(600).select(
        F.col("id"), F.when(F.col("id") % 10 == 0, "c2").otherwise("c1").alias("ref"),
        F.when(F.col("id") < 200, 500).otherwise(F.col("id") * 37 % 1000).alias("start")).withColumn(
        "end", F.col("start") + F.col("id") % 23)
    small = spark.range(90).select(
        F.concat(F.lit("g"), "id").alias("gene"), F.when(F.col("id") % 4 == 0, "c2").otherwise("c1").alias("ref"),
        (F.col("id") * 11).alias("start"), (F.col("id") * 11 + F.col("id") % 40).alias("end"))
    got = I.overlap_join(big, small, width=width, max_rows=max_rows).select("id", "s_gene")
    raw = big.alias("a").join(small.alias("b"), F.expr(
        "a.ref = b.ref AND a.start <= b.end AND b.start <= a.end")).select("id", "gene")
    want = sorted(map(tuple, raw.collect()))
    assert len(want) > 500 and sorted(map(tuple, got.collect())) == want


def test_long_rows_touch_two_bins_at_most(spark):
    """Whatever its length a row is put into one bin or two, and is found from every base of it."""
    rows = spark.createDataFrame([("c", 10 ** k + 7 * k, 2 * 10 ** k + 13, k) for k in range(1, 10)],
                                 "ref string, start long, end long, k int")
    binned = I.in_bins(rows)
    assert max(r["count"] for r in binned.groupBy("k").count().collect()) <= 2
    counted = I.level_rows(rows)
    assert sum(counted.values()) == binned.count() and len(counted) == 5
    points = rows.selectExpr("ref", "inline(array(struct(start, start AS end), struct(end AS start, end), "
                             "struct(cast((start + end) / 2 AS long) AS start, cast((start + end) / 2 AS long) AS end)))")
    got = I.overlap_join(points, rows).select("start", "s_k").distinct().count()
    want = points.alias("a").join(rows.alias("b"), F.expr("a.start <= b.end AND b.start <= a.end")).select(
        "a.start", "k").distinct().count()
    assert got == want


def annotation(spark, introns=(300, 5_000, 400_000)):
    """Transcripts with introns of all sizes, two of each."""
    rows = []
    for i, gap in enumerate(introns):
        at = 1_000_000 * i + 500
        for j in range(2):
            starts, ends = [at + 20 * j, at + 200 + gap], [at + 200, at + 400 + gap]
            rows.append((f"g{i}", f"t{i}.{j}", "c", "+", starts[0], ends[1], starts[0] + 30, ends[1] - 30, starts, ends))
    return spark.createDataFrame(rows, schemas.TRANSCRIPTS)


def aligned(spark, n=400):
    rows = [("r" if i % 3 else "hot", f"q{i}", 16 if i % 4 == 0 else 0, "c",
             1_000_000 * (i % 3) + 450 + 13 * i % 800 + (i % 7) * 40_000 * (i % 2), 60,
             "30M5000N20M" if i % 5 == 0 else "50M", "*", 0, 0, "*", "I" * 50, None) for i in range(n)]
    return spark.createDataFrame(rows, schemas.ALIGNMENTS)


def test_an_intron_is_one_row(spark):
    regions = V.transcript_regions(annotation(spark))
    segments = V.class_segments(regions)
    assert segments.where("cls = 'intronic'").count() <= 2 * 3
    assert sum(I.level_rows(segments).values()) <= 2 * regions.count()


def test_classes_and_depth_are_the_same_without_broadcast(spark):
    reads, transcripts = aligned(spark), annotation(spark)
    for operator in (V.base_classes, V.depth_stretches):
        fast, slow = (operator(reads, transcripts, max_rows=m).collect() for m in (10 ** 6, 0))
        assert sorted(fast) == sorted(slow) and fast
    assert all(r.intronic_bases > 0 and r.coding_bases > 0 for r in V.base_classes(reads, transcripts).collect())


def test_alignment_features_reads_the_alignments_three_times(spark, tmp_path, monkeypatch):
    """Every stage table comes from the three tables that are written; the alignments may be gone by then."""
    path = f"{tmp_path}/alignments"
    aligned(spark).unionByName(spark.createDataFrame(paired_reads(40, 99, 147), schemas.ALIGNMENTS)).write.parquet(path)
    source = spark.read.schema(schemas.ALIGNMENTS).parquet(path)
    scans = []

    def counted(df, name):
        scans.append(sum(path in f for f in df.inputFiles()) > 0)
        return written(df, name)

    monkeypatch.setattr(jobs, "written", counted)
    exons = spark.createDataFrame([("g0", "t", "c", 500, 900, "+")], schemas.EXONS)
    layout = spark.createDataFrame([("r", "SE"), ("hot", "SE"), ("p", "PE")], "srr string, layout string")
    out = jobs.alignment_features(source, exons, annotation(spark), layout)
    assert sum(scans) == 3
    for rows in out.values():
        assert not any(path in f for f in rows.inputFiles())
    alone = {"hisat2": A.aligner_stage(source), "aln_stats": A.alignment_stats(source),
             "markduplicates": A.duplication_rate(A.mapq_filter(source)),
             "genebody_coverage": V.gene_body_coverage(V.depth_stretches(A.mapq_filter(source), annotation(spark)))}
    for stage, rows in alone.items():
        columns = [f"`{f.name}`" for f in schemas.STAGES[stage].fields]
        got, want = (sorted(map(repr, df.select(*columns).collect())) for df in (out[stage], rows))
        assert got == want, stage


def test_ends_on_two_references(spark):
    """Pairs across chromosomes are copies only if each end lies on the same one."""
    def pair(name, ref1, pos1, ref2, pos2):
        return [("p", name, 65, ref1, pos1, 60, "5M", ref2, pos2, 0, "*", "IIIII", 1),
                ("p", name, 129, ref2, pos2, 60, "5M", ref1, pos1, 0, "*", "IIIII", 1)]

    reads = spark.createDataFrame(pair("a", "c", 10, "d", 20) + pair("b", "c", 20, "d", 10) + pair("e", "d", 20, "c", 10),
                                  schemas.ALIGNMENTS)
    assert {r.qname for r in A.mark_duplicates(reads).where("is_duplicate").collect()} == {"e"}
    assert A.duplication_rate(reads).first().read_pair_duplicates == 1


def test_groups_of_copies_are_combined_by_hash(spark):
    plan = A.duplication_rate(aligned(spark))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_counting_is_the_same_without_broadcast(spark):
    reads = spark.createDataFrame(
        [("r", f"q{i}", 0, "c", 100 + i % 50, 60, "30M", "*", 0, 0, "*", "I" * 30, None) for i in range(300)],
        schemas.ALIGNMENTS)
    exons = spark.createDataFrame([("g1", "t1", "c", 90, 125, "+"), ("g2", "t2", "c", 140, 200, "-")], schemas.EXONS)
    fast, slow = (A.gene_counts(reads, exons, width=16, max_rows=m).collect() for m in (10 ** 6, 0))
    assert sorted(fast) == sorted(slow) and {r.gene_id for r in fast} == {"g1", "g2"}
    # starts 100..110 touch g1 only, 111..125 both, 126..149 g2 only; 6 reads per start
    assert {r.gene_id: r["count"] for r in fast} == {"g1": 66, "g2": 144}


def test_one_pile_of_copies(spark):
    n = 5000
    reads = spark.range(n).select(
        F.lit("r").alias("srr"), F.concat(F.lit("q"), "id").alias("qname"), F.lit(0).alias("flag"), F.lit("c").alias("ref"),
        F.lit(100).cast("bigint").alias("pos"), F.lit(60).alias("mapq"), F.lit("5M").alias("cigar"),
        F.lit("*").alias("rnext"), F.lit(0).cast("bigint").alias("pnext"), F.lit(0).cast("bigint").alias("tlen"),
        F.lit("*").alias("seq"), F.lit("IIIII").alias("qual"), F.lit(1).alias("nh"))
    marked = A.mark_duplicates(reads)
    assert [r.qname for r in marked.where("NOT is_duplicate").collect()] == ["q0"] and marked.count() == n
    row = A.duplication_rate(reads).first()
    assert (row.unpaired_reads_examined, row.unpaired_read_duplicates) == (n, n - 1)


def test_region_precedence(spark):
    transcripts = spark.createDataFrame(
        [("g", "t1", "c", "+", 1, 100, 21, 80, [1, 61], [40, 100]), ("g", "t2", "c", "+", 31, 70, 71, 70, [31], [70])],
        schemas.TRANSCRIPTS)
    segments = V.class_segments(V.transcript_regions(transcripts), width=16)
    bases = {p: r.cls for r in segments.collect() for p in range(r.start, r.end + 1)}
    def expected(p):
        if (p <= 40 or 61 <= p) and 21 <= p <= 80:
            return "coding"
        return "utr" if p <= 40 or p >= 61 or 31 <= p <= 70 else "intronic"
    assert bases == {p: expected(p) for p in range(1, 101)}


def test_order_breaks_are_found(spark, tmp_path):
    rows = spark.range(300).select(F.lit("c").alias("ref"), (F.col("id") * 7919 % 97).alias("pos"), F.col("id").cast("string").alias("qname"))
    keys = ["ref", "pos", "qname"]
    sinks.write_sorted(rows, f"{tmp_path}/sorted", 4)
    assert tuple(sinks.order_breaks(spark, f"{tmp_path}/sorted", keys).first()) == (0, 0)
    rows.repartition(3).sortWithinPartitions(*keys).write.parquet(f"{tmp_path}/loose")  # sorted files that overlap
    inside, between = sinks.order_breaks(spark, f"{tmp_path}/loose", keys).first()
    assert inside == 0 and between == 2
    rows.coalesce(1).write.parquet(f"{tmp_path}/raw")
    assert sinks.order_breaks(spark, f"{tmp_path}/raw", keys).first()[0] > 50


def test_coordinate_sort(spark):
    rows = spark.range(500).select(F.lit("c").alias("ref"), (F.col("id") * 7919 % 50).alias("pos"),
                                   F.col("id").cast("string").alias("qname"))
    got = [(r.ref, r.pos, r.qname) for r in A.coordinate_sort(rows, 4).collect()]
    assert got == sorted(got)


def test_alignment_features(spark, tmp_path):
    reads = []
    for i in range(40):
        reads.append(("s", f"a{i}", 16 if i % 8 == 0 else 0, "c", 100 + 5 * i, 60, "50M", "*", 0, 0, "*", "I" * 50, 1))
    reads.append(("s", "u", 4, "*", 0, 0, "*", "*", 0, 0, "*", "I" * 50, None))
    reads.append(("s", "j", 0, "c", 150, 60, "10M100N40M", "*", 0, 0, "*", "I" * 50, 1))
    alignments = spark.createDataFrame(reads, schemas.ALIGNMENTS)
    exons = spark.createDataFrame([("g1", "t1", "c", 90, 400, "+"), ("g2", "t2", "d", 1, 9, "+")], schemas.EXONS)
    transcripts = spark.createDataFrame(
        [("g1", "t1", "c", "+", 90, 400, 100, 390, [90], [400])], schemas.TRANSCRIPTS)
    layout = spark.createDataFrame([("s", "SE")], "srr string, layout string")
    out = jobs.alignment_features(alignments, exons, transcripts, layout)
    assert set(out) == {"hisat2", "aln_stats", "markduplicates", "strand", "rnaseqmetrics", "genebody_coverage",
                        "count_summary"}
    assert out["strand"].first().strand == "same_strand"
    counts = out["count_summary"].first()
    assert (counts.number_genic_reads, counts.percent_genes_on) == (36, 50.0)
    assert (counts.number_junction_reads, counts.number_junctions_on) == (1, 1)
    assert out["hisat2"].first().num_unaligned == 1 and out["aln_stats"].first().reads_MQ0 == 0
    coverage = out["genebody_coverage"].first().coverage
    assert len(coverage) == 101 and sum(coverage) / 101 == pytest.approx(1, abs=0.05)
    metrics = out["rnaseqmetrics"].first()
    assert metrics.percent_coding_bases > 99 and metrics.percent_intergenic_bases == 0
    for stage, rows in out.items():
        sinks.write_stage(rows, f"{tmp_path}/{stage}", stage)
        assert tables.read_store(spark, f"{tmp_path}/{stage}", stage).count() == 1, stage


def fastq_lines(srr, mate, n):
    return "".join(f"@{srr}.{i}/{mate} length=30\n{'ACGTN' * 6}\n+\n{'I' * 30}\n" for i in range(n))


def test_qc_reads_job(spark, tmp_path):
    folder, out = tmp_path / "fastq", str(tmp_path / "out")
    folder.mkdir()
    for name, text in {"SRR1_1": fastq_lines("SRR1", 1, 40), "SRR1_2": fastq_lines("SRR1", 2, 40),
                       "SRR2": fastq_lines("SRR2", 1, 30), "SRR3": fastq_lines("SRR3", 1, 5)}.items():
        with gzip.open(folder / f"{name}.fastq.gz", "wt") as f:
            f.write(text)
    manifest = spark.createDataFrame([("e", s) for s in ("SRR1", "SRR2", "SRR3", "SRR9")], schemas.MANIFEST)
    libraries = jobs.qc_reads(spark, str(folder), manifest, out, min_library=20, empty_bytes=10)
    got = {r.srr: (r.layout, r.libsize, r.status) for r in libraries.collect()}
    assert got == {"SRR1": ("PE", 40, "ok"), "SRR2": ("SE", 30, "ok"), "SRR3": ("SE", 5, "too_few_reads"),
                   "SRR9": (None, None, "download_bad")}
    clean = spark.read.parquet(f"{out}/reads").groupBy("srr").count().collect()
    assert {r.srr: r["count"] for r in clean} == {"SRR1": 80, "SRR2": 30}
    again = jobs.qc_reads(spark, str(folder), manifest, out, min_library=20, empty_bytes=10)
    assert again.count() == 4 and spark.read.parquet(f"{out}/reads").count() == 110
    layouts = spark.read.parquet(f"{out}/Features/layout").collect()
    assert sorted((r.srr, r.layout) for r in layouts) == [("SRR1", "PE"), ("SRR2", "SE"), ("SRR3", "SE")]
    assert spark.read.parquet(f"{out}/unfit_files").count() == 0


TRIM = "Total reads processed: 5,000\nReads that were too short: 10\nReads written (passing filters): 4,990\n"
ALIGNED = ("5000 reads; of these:\n  5000 (100.00%) were unpaired; of these:\n    4000 (80.00%) aligned exactly 1 time\n"
           "80.00% overall alignment rate\n")
NEEDED = ("atropos", "fastq_screen", "hisat2")


def states(df):
    return {r.srr: (r.state, r.failed, r.missing) for r in df.collect()}


def test_failed_and_silent_runs_are_not_done(spark, tmp_path):
    logs = spark.createDataFrame(
        [(s, stage, body) for s in "abce" for stage, body in (
            ("atropos", TRIM), ("hisat2", ALIGNED), ("fastq_screen", "Processing complete"))
         if (s, stage) not in {("b", "atropos"), ("c", "hisat2")}]
        + [("b", "atropos", "ERROR"), ("c", "hisat2", ALIGNED.replace("80.00% overall", "0.10% overall")),
           ("d", "atropos", TRIM), ("e", "markduplicates", "stopped")], schemas.REPORTS)
    runs = spark.createDataFrame([(s,) for s in "abcdef"], "srr string")
    for _ in range(2):  # a second call adds nothing to any table
        found = jobs.finish_runs(spark, runs, logs, str(tmp_path), required=NEEDED)
    assert states(found) == {
        "a": ("done", [], []), "b": ("failed", ["atropos"], []), "c": ("failed", ["hisat2"], []),
        "d": ("waiting", [], ["fastq_screen", "hisat2"]), "e": ("done", [], []),
        "f": ("waiting", [], ["atropos", "fastq_screen", "hisat2"])}
    assert sorted(r.srr for r in tables.read_done(spark, f"{tmp_path}/Features/done").collect()) == ["a", "e"]
    assert tables.read_status(spark, f"{tmp_path}/Features/status").count() == logs.count()


def test_a_repeated_run_becomes_done(spark, tmp_path):
    runs = spark.createDataFrame([("a",), ("b",)], "srr string")

    def finish(attempt, *logs):
        return states(jobs.finish_runs(spark, runs, spark.createDataFrame(list(logs), schemas.REPORTS), str(tmp_path), attempt, NEEDED))

    first = finish(1, ("a", "atropos", "ERROR"), ("a", "hisat2", ALIGNED), ("a", "fastq_screen", "Processing complete"))
    assert first["a"][0] == "failed"
    assert finish(2, ("a", "atropos", TRIM))["a"] == ("done", [], [])
    # an old report that comes late changes nothing, a newer one does
    assert finish(1, ("a", "hisat2", "nothing"))["a"][0] == "failed"  # same attempt: the failure decides
    assert finish(3, ("a", "hisat2", ALIGNED))["a"][0] == "done"
    assert finish(2, ("a", "hisat2", "nothing"))["a"][0] == "done"
    assert [r.srr for r in tables.read_done(spark, f"{tmp_path}/Features/done").collect()] == ["a"]


def test_rows_in_stage_tables_count_until_a_report_speaks(spark, tmp_path):
    runs = spark.createDataFrame([("a",), ("b",)], "srr string")
    rows = spark.createDataFrame([("a", "same_strand"), ("b", "unstranded")], schemas.STAGES["strand"])
    sinks.write_stage(rows, f"{tmp_path}/Features/strand", "strand")
    logs = spark.createDataFrame([("a", "atropos", TRIM), ("b", "atropos", TRIM), ("b", "strand", "x")], schemas.REPORTS)
    found = jobs.finish_runs(spark, runs, logs.where("stage = 'atropos'"), str(tmp_path), required=("atropos", "strand"))
    assert {k: v[0] for k, v in states(found).items()} == {"a": "done", "b": "done"}
    assert tables.read_done(spark, f"{tmp_path}/Features/done").count() == 2


def test_count_summary_from_tables(spark, tmp_path):
    for kind, lines in {"genes": "g1\t10\t3\ng2\t20\t0\n", "junctions": "g1\tx\t4\ng1\ty\t0\n"}.items():
        (tmp_path / kind).mkdir()
        (tmp_path / kind / "SRR1.counts").write_text("# cmd\nGeneid\tLength\tSRR1.bam\n" + lines)
    genes, junctions = (tables.read_counts(spark, str(tmp_path / k)) for k in ("genes", "junctions"))
    row = jobs.ingest_reports(genes, "count_summary", junctions).first()
    assert (row.srr, row.number_genic_reads, row.percent_genes_on) == ("SRR1", 3, 50.0)
    assert (row.number_junction_reads, row.number_junctions_on) == (4, 2)


def test_run_all(spark, tmp_path):
    root = f"{tmp_path}/Features"
    n = 120
    ids = spark.range(n).select(F.concat(F.lit("r"), "id").alias("srr"), F.rand(5).alias("x"), F.rand(6).alias("y"))
    for stage, schema in schemas.STAGES.items():
        def column(f):
            if f.name == "srr":
                return F.col("srr")
            if f.name == "coverage":
                return F.transform(F.sequence(F.lit(0), F.lit(100)), lambda i: F.col("x") * i).alias("coverage")
            if f.dataType == schemas.T.StringType():
                return F.lit("rRNA").alias(f.name)
            return ((F.col("x") + F.lit(len(f.name)) * F.col("y")) * 100).cast(f.dataType).alias(f.name)
        sinks.write_stage(ids.select(*[column(f) for f in schema.fields]), f"{root}/{stage}", stage)
    manifest = ids.select(F.concat(F.lit("e"), F.floor(F.col("x") * 60).cast("string")).alias("srx"), "srr")
    sinks.mark_done(ids, f"{root}/done")
    done = tables.read_done(spark, f"{root}/done")
    found = jobs.run_all(spark, manifest, done, str(tmp_path), n_trees=10, nulls="drop")
    assert found.result.columns[0] == "srx"
    assert found.result.count() == spark.read.parquet(f"{root}/features.parquet").count() > 30
    assert spark.read.option("header", True).csv(f"{tmp_path}/result.csv").count() == found.result.count()
    for stage in schemas.STAGES:
        assert tables.read_store(spark, f"{root}/{stage}.parquet", stage).count() == n


def paired_reads(n, first_flag, second_flag, lone=False):
    """Pairs of which mate 1 has the first flag; ``lone`` leaves the second mates out."""
    rows = []
    for i in range(n):
        rows.append(("p", f"q{i}", first_flag, "c", 100 + i, 60, "30M", "=", 150 + i, 80, "*", "I" * 30, 1))
        if not lone:
            rows.append(("p", f"q{i}", second_flag, "c", 150 + i, 60, "30M", "=", 100 + i, -80, "*", "I" * 30, 1))
    return rows


@pytest.mark.parametrize("flags, strand", [((99, 147), "same_strand"), ((83, 163), "opposite_strand")])
def test_strand_of_pairs(spark, flags, strand):
    reads = spark.createDataFrame(paired_reads(40, *flags), schemas.ALIGNMENTS)
    exons = spark.createDataFrame([("g1", "t1", "c", 50, 400, "+")], schemas.EXONS)
    found = V.strand_agreement(reads, exons)
    assert found.first().correct_strand_share == (1.0 if strand == "same_strand" else 0.0)
    assert V.strand_from_agreement(found).first().strand == strand


def test_lone_mates_are_no_pairs(spark):
    reads = spark.createDataFrame(paired_reads(40, 99, 147, lone=True), schemas.ALIGNMENTS)
    row = A.duplication_rate(reads).first()
    assert (row.read_pairs_examined, row.unpaired_reads_examined) == (0, 40)
    assert A.mark_duplicates(reads).where("is_pair").count() == 0


def test_runs_without_a_layout_stay_visible(spark):
    reads = spark.createDataFrame(
        [(srr, f"q{i}", 0, "c", 100 + i, 60, "30M", "*", 0, 0, "*", "I" * 30, None) for srr in ("a", "b") for i in range(5)],
        schemas.ALIGNMENTS)
    exons = spark.createDataFrame([("g1", "t1", "c", 90, 200, "+")], schemas.EXONS)
    modes = A.count_modes(spark.createDataFrame([("a", "SE")], "srr string, layout string"),
                          spark.createDataFrame([], "srr string, strand string"))
    counts = A.gene_counts_by_mode(reads, exons, modes)
    got = {r.srr: (r.number_genic_reads, r.percent_genes_on) for r in
           A.gene_count_summary(counts, reads.select("srr"), exons, modes).collect()}
    assert got == {"a": (5, 100.0), "b": (None, None)}
