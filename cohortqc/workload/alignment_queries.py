"""Alignment statistics, duplicates, counting, region classes, coverage."""
from __future__ import annotations

from pyspark.sql import functions as F

from cohortqc import schemas, sinks
from cohortqc.functions import cigar as C
from cohortqc.operators import alignments as A
from cohortqc.operators import coverage as V
from cohortqc.operators import features as X
from cohortqc.operators import intervals as I
from cohortqc.plans import jobs
from cohortqc.session import shared_folder
from cohortqc.sources import tables
from cohortqc.workload.registry import ORACLES, query, rounded
from cohortqc.workload.views import ctes, load


def reads(spark, sf):
    return load(spark, sf, "alignments_v")


def good(spark, sf):
    return A.mapped(A.mapq_filter(reads(spark, sf)))


# What the five alignment shapes of the fixture mean, written out by hand: aligned blocks, introns, reference bases.
_SHAPES = """blocks(cigar, a, b) AS (VALUES ('50M', 0, 49), ('20M300N30M', 0, 19), ('20M300N30M', 320, 349),
      ('5S45M', 0, 44), ('25M2I10M3D13M', 0, 24), ('25M2I10M3D13M', 25, 34), ('25M2I10M3D13M', 38, 50),
      ('10M120N20M200N20M', 0, 9), ('10M120N20M200N20M', 130, 149), ('10M120N20M200N20M', 350, 369)),
    introns(cigar, a, b) AS (VALUES ('20M300N30M', 20, 319), ('10M120N20M200N20M', 10, 129),
      ('10M120N20M200N20M', 150, 349)),
    spans(cigar, len) AS (VALUES ('50M', 50), ('20M300N30M', 350), ('5S45M', 45), ('25M2I10M3D13M', 51),
      ('10M120N20M200N20M', 370))"""
_ALN = f"""{ctes('alignments_v')}, {_SHAPES},
    good AS (SELECT *, row_number() OVER () AS rid, flag = 16 AS rev FROM alignments_v WHERE mapq >= 20 AND flag <> 4),
    pieces AS (SELECT g.rid, g.srr, g.ref, g.rev, g.pos + b.a AS a, g.pos + b.b AS b
               FROM good g JOIN blocks b ON g.cigar = b.cigar)"""
_QUALITY = ("list_sum(list_transform(range(1, length(qual) + 1), lambda i: CASE WHEN ascii(substr(qual, i, 1)) - 33 >= {0} "
            "THEN ascii(substr(qual, i, 1)) - 33 ELSE 0 END))")


@query("mapq_filter", f"WITH {ctes('alignments_v')} SELECT srr, qname, mapq FROM alignments_v WHERE mapq >= 20")
def mapq_filter(spark, sf):
    return A.mapq_filter(reads(spark, sf)).select("srr", "qname", "mapq")


@query("coordinate_sort", f"""WITH {ctes('alignments_v')}
    SELECT ref, count(*) AS n, min(pos) AS first_pos, max(pos) AS last_pos, 0 AS inside, 0 AS between FROM alignments_v
    GROUP BY ref""")
def coordinate_sort(spark, sf):
    """The sorted sink, and how often its files depart from the order: rows are compared by their places in the files."""
    path = shared_folder(spark, "sorted")
    rows = reads(spark, sf)
    sinks.write_sorted(rows, path, sinks.sorted_files(rows.count()))
    breaks = sinks.order_breaks(spark, path, ["ref", "pos", "qname"]).select(
        F.col("inside").cast("int").alias("inside"), F.col("between").cast("int").alias("between"))
    by_ref = spark.read.parquet(path).groupBy("ref").agg(
        F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"))
    return by_ref.select("*", breaks.select("inside").scalar().alias("inside"), breaks.select("between").scalar().alias("between"))


def _stats_sql(rows: str) -> str:
    left = "(flag & 1 = 1 AND flag & 8 = 0 AND (rnext = '=' OR rnext = ref) AND tlen > 0)"
    return f"""SELECT srr, count(*) FILTER (mapq = 0) AS "reads_MQ0",
      round(sum({_QUALITY.format(0)}) / sum(length(qual)), 6) AS average_quality,
      round(coalesce(avg(tlen) FILTER ({left}), 0), 6) AS insert_size_average,
      round(coalesce(stddev_pop(tlen) FILTER ({left}), 0), 6) AS insert_size_standard_deviation,
      count(*) FILTER ({left} AND flag & 16 = 0 AND flag & 32 > 0) AS inward_oriented_pairs,
      count(*) FILTER ({left} AND flag & 16 > 0 AND flag & 32 = 0) AS outward_oriented_pairs,
      count(*) FILTER ({left} AND (flag & 16 > 0) = (flag & 32 > 0)) AS pairs_with_other_orientation,
      count(*) FILTER (flag & 1 = 1 AND flag & 8 = 0 AND rnext <> '=' AND rnext <> ref AND flag & 64 > 0)
        AS pairs_on_different_chromosomes,
      round(count(*) FILTER (flag & 16 = 0) * 100 / count(*), 6) AS "Percent Forward",
      round(count(*) FILTER (flag & 16 > 0) * 100 / count(*), 6) AS "Percent Reverse"
      FROM {rows} GROUP BY srr"""


@query("aln_stats", f"WITH {_ALN} {_stats_sql('good')}")
def aln_stats(spark, sf):
    return rounded(A.alignment_stats(reads(spark, sf)))


@query("aln_stats_paired", f"""WITH {ctes('paired_v')},
    mapped AS (SELECT * FROM paired_v WHERE flag & 4 = 0) {_stats_sql('mapped')}""")
def aln_stats_paired(spark, sf):
    return rounded(A.alignment_stats(load(spark, sf, "paired_v"), min_mapq=None))


def _counts_sql(view: str) -> str:
    return f"""WITH {ctes(view)} SELECT srr, count(*) AS num_reads, count(*) FILTER (flag & 1 > 0) AS num_reads_paired,
      count(*) FILTER (flag & 1 = 0) AS num_reads_unpaired, count(*) FILTER (flag & 4 > 0) AS num_unaligned,
      count(*) FILTER (flag & 4 = 0 AND mapq > 1) AS num_uniquely_aligned,
      count(*) FILTER (flag & 4 = 0 AND mapq <= 1) AS num_multimappers,
      round(count(*) FILTER (flag & 4 = 0) * 100 / count(*), 6) AS per_alignment FROM {view} GROUP BY srr"""


@query("aligner_counts", _counts_sql("alignments_v"))
def aligner_counts(spark, sf):
    return rounded(A.aligner_counts(reads(spark, sf)))


@query("aligner_counts_paired", _counts_sql("paired_v"))
def aligner_counts_paired(spark, sf):
    return rounded(A.aligner_counts(load(spark, sf, "paired_v")))


def _stage_sql(view: str) -> str:
    return f"""WITH {ctes(view)}, f AS (SELECT srr, flag & 1 > 0 AS pe, flag & 64 > 0 AS one, flag & 4 = 0 AS ok,
        flag & 3 = 3 AND flag & 12 = 0 AS proper, flag & 4 = 0 AND mapq > 1 AS uniq, flag & 4 = 0 AND mapq <= 1 AS multi,
        flag & 3 = 1 AND flag & 12 = 0 AND mapq > 1 AS disc FROM {view})
      SELECT srr, count(*) FILTER (NOT pe OR one)::DOUBLE AS num_reads, count(*) FILTER (one)::DOUBLE AS num_reads_paired,
        count(*) FILTER (NOT pe)::DOUBLE AS num_reads_unpaired,
        count(*) FILTER (one AND NOT proper)::DOUBLE AS num_concordant_reads_unaligned,
        count(*) FILTER (one AND proper AND uniq)::DOUBLE AS num_concordant_reads_uniquely_aligned,
        count(*) FILTER (one AND proper AND multi)::DOUBLE AS num_concordant_multimappers,
        count(*) FILTER (one AND disc)::DOUBLE AS num_discordant_reads_aligned,
        count(*) FILTER (NOT proper AND NOT disc AND NOT ok)::DOUBLE AS num_unaligned,
        count(*) FILTER (NOT proper AND NOT disc AND uniq)::DOUBLE AS num_uniquely_aligned,
        count(*) FILTER (NOT proper AND NOT disc AND multi)::DOUBLE AS num_multimappers,
        round(count(*) FILTER (ok) * 100 / count(*), 6) AS per_alignment FROM f GROUP BY srr"""


@query("aligner_stage", _stage_sql("alignments_v"))
def aligner_stage(spark, sf):
    return rounded(A.aligner_stage(reads(spark, sf)))


@query("aligner_stage_paired", _stage_sql("paired_v"))
def aligner_stage_paired(spark, sf):
    return rounded(A.aligner_stage(load(spark, sf, "paired_v")))


_FIVE_PRIME = """CASE WHEN flag & 16 > 0 THEN pos + len - 1 WHEN cigar = '5S45M' THEN pos - 5 ELSE pos END"""
_SINGLE_ENDS = f"""templates AS (SELECT srr, qname, ref, {_FIVE_PRIME} AS e1, flag & 16 AS r1, NULL AS e2, false AS is_pair,
      {_QUALITY.format(15)} AS score FROM alignments_v JOIN spans USING (cigar) WHERE flag <> 4)"""
_PAIR_ENDS = f"""templates AS (
      SELECT srr, qname, CAST([min(e), max(e)] AS VARCHAR) AS ref, 0 AS e1, 0 AS r1, NULL AS e2, true AS is_pair, sum(q) AS score
      FROM (SELECT srr, qname, {_QUALITY.format(15)} AS q,
              struct_pack(ref := ref, p := CASE WHEN flag & 16 > 0 THEN pos + 49 ELSE pos END, r := flag & 16) AS e
            FROM paired_v WHERE flag & 12 = 0) t GROUP BY srr, qname
      UNION ALL
      SELECT srr, qname, ref, CASE WHEN flag & 16 > 0 THEN pos + 49 ELSE pos END, flag & 16, NULL, false,
             {_QUALITY.format(15)} FROM paired_v WHERE flag & 4 = 0 AND flag & 8 > 0)"""
_MARKED = """marked AS (SELECT srr, qname, is_pair, row_number() OVER (
      PARTITION BY srr, is_pair, ref, e1, r1 ORDER BY score DESC, qname) > 1 AS is_duplicate FROM templates)"""
_RATE = """SELECT srr, count(*) FILTER (NOT is_pair) AS unpaired_reads_examined,
    count(*) FILTER (is_pair) AS read_pairs_examined,
    count(*) FILTER (NOT is_pair AND is_duplicate) AS unpaired_read_duplicates,
    count(*) FILTER (is_pair AND is_duplicate) AS read_pair_duplicates,
    round(sum(CASE WHEN NOT is_duplicate THEN 0 WHEN is_pair THEN 2 ELSE 1 END)
          / sum(CASE WHEN is_pair THEN 2 ELSE 1 END) * 100, 6) AS percent_duplication,
    NULL::BIGINT AS estimated_library_size FROM marked GROUP BY srr"""
_DUP_SINGLE = f"WITH {ctes('alignments_v')}, {_SHAPES}, {_SINGLE_ENDS}, {_MARKED}"
_DUP_PAIRED = f"WITH {ctes('paired_v')}, {_PAIR_ENDS}, {_MARKED}"


@query("mark_duplicates", f"{_DUP_SINGLE} SELECT * FROM marked")
def mark_duplicates(spark, sf):
    return A.mark_duplicates(reads(spark, sf))


@query("mark_duplicates_paired", f"{_DUP_PAIRED} SELECT * FROM marked")
def mark_duplicates_paired(spark, sf):
    return A.mark_duplicates(load(spark, sf, "paired_v"))


@query("duplication_rate", f"{_DUP_SINGLE} {_RATE}")
def duplication_rate(spark, sf):
    return rounded(A.duplication_rate(reads(spark, sf)))


@query("duplication_rate_paired", f"{_DUP_PAIRED} {_RATE}")
def duplication_rate_paired(spark, sf):
    return rounded(A.duplication_rate(load(spark, sf, "paired_v")))


# ---- alignments and annotation as files -------------------------------------------------------------------------------

@query("sam_scan", f"""WITH {ctes('alignments_v')} SELECT srr, qname, flag, ref, pos, mapq, cigar, rnext, pnext, tlen, seq, qual,
    CASE WHEN mapq > 30 THEN 1 + flag // 16 END AS nh FROM alignments_v""")
def sam_scan(spark, sf):
    """SAM text with headers and optional tags, a file per run, read back."""
    path = shared_folder(spark, "sam")
    fields = [F.col(c).cast("string") for c in schemas.ALIGNMENTS.names[1:12]]
    tag = F.when(F.col("mapq") > 30, F.concat(F.lit("NH:i:"), (1 + F.floor(F.col("flag") / 16)).cast("string")))
    rows = reads(spark, sf).select("srr", F.lit(1).alias("place"), F.concat_ws("\t", *fields, F.lit("AS:i:0"), tag).alias("value"))
    heads = rows.select("srr").distinct().select("srr", F.lit(0).alias("place"), F.explode(F.array(
        F.lit("@HD\tVN:1.6"), F.lit("@SQ\tSN:chr1\tLN:1000000"))).alias("value"))
    (rows.unionByName(heads).repartition("srr").sortWithinPartitions("srr", "place").select("srr", "value")
     .write.partitionBy("srr").text(path))
    return tables.read_sam(spark, path, r"/srr=([^/]+)/")


@query("gtf_scan", f"""WITH {ctes('exons_v')} SELECT gene_id, tx_id, ref, start, "end", strand FROM exons_v""")
def gtf_scan(spark, sf):
    """A GTF with comments and with lines of other kinds than exons."""
    path = shared_folder(spark, "gtf")

    def line(kind: str):
        name = F.concat(F.lit('gene_id "'), "gene_id", F.lit('"; transcript_id "'), "tx_id", F.lit('"; level 2;'))
        return F.concat_ws("\t", "ref", F.lit("own"), F.lit(kind), F.col("start").cast("string"), F.col("end").cast("string"),
                           F.lit("."), "strand", F.lit("."), name)

    rows = load(spark, sf, "exons_v").select(F.explode(F.array(F.lit("#!made of parts"), line("exon"), line("CDS"))).alias("value"))
    rows.write.text(path)
    return tables.read_gtf(spark, path)


@query("refflat_scan", f"""WITH {ctes('transcripts_v')} SELECT gene, tx, ref, strand, tx_start, tx_end, cds_start, cds_end,
    array_to_string(exon_starts, ',') AS exon_starts, array_to_string(exon_ends, ',') AS exon_ends FROM transcripts_v""")
def refflat_scan(spark, sf):
    """refFlat text, whose starts count from 0 and whose lists end in a comma."""
    path = shared_folder(spark, "refflat")
    ends = lambda c, shift: F.concat(F.concat_ws(",", F.transform(c, lambda x: (x - shift).cast("string"))), F.lit(","))
    text = lambda c, shift=0: (F.col(c) - shift).cast("string")
    load(spark, sf, "transcripts_v").select(F.concat_ws(
        "\t", "gene", "tx", "ref", "strand", text("tx_start", 1), text("tx_end"), text("cds_start", 1), text("cds_end"),
        F.size("exon_starts").cast("string"), ends("exon_starts", 1), ends("exon_ends", 0)).alias("value")).write.text(path)
    return tables.read_refflat(spark, path).selectExpr(
        "gene", "tx", "ref", "strand", "tx_start", "tx_end", "cds_start", "cds_end", "concat_ws(',', transform(exon_starts, x -> string(x))) AS exon_starts",
        "concat_ws(',', transform(exon_ends, x -> string(x))) AS exon_ends")


@query("repeated_names", f"""WITH {ctes('alignments_v')} SELECT srr, qname, false AS "second", count(*) AS n
    FROM alignments_v GROUP BY srr, qname HAVING count(*) > 1""")
def repeated_names(spark, sf):
    return A.repeated_names(reads(spark, sf))


# ---- overlaps and counting ----------------------------------------------------------------------------------------

@query("interval_overlaps", f"""WITH {_ALN}, {ctes('exons_v')}
    SELECT p.srr, e.gene_id, count(*) AS n_pairs, sum(least(p.b, e."end") - greatest(p.a, e.start) + 1)::BIGINT AS n_bases
    FROM pieces p JOIN exons_v e ON p.ref = e.ref AND p.a <= e."end" AND e.start <= p.b GROUP BY p.srr, e.gene_id""")
def interval_overlaps(spark, sf):
    blocks = good(spark, sf).select("srr", "qname", "ref", F.inline(C.blocks(F.col("pos"), F.col("cigar"))))
    bases = F.least("end", "s_end") - F.greatest("start", "s_start") + 1
    return (I.overlap_join(blocks, load(spark, sf, "exons_v")).groupBy("srr", F.col("s_gene_id").alias("gene_id"))
            .agg(F.count(F.lit(1)).alias("n_pairs"), F.sum(bases).alias("n_bases")))


def _genes_sql(match: str = "true") -> str:
    return f"""WITH {_ALN}, {ctes('exons_v')}, hits AS (
      SELECT p.rid, any_value(p.srr) AS srr, any_value(p.rev) AS rev, min(e.gene_id) AS gene_id,
             min(e.strand) AS strand
      FROM pieces p JOIN exons_v e ON p.ref = e.ref AND p.a <= e."end" AND e.start <= p.b AND {match}
      GROUP BY p.rid HAVING count(DISTINCT e.gene_id) = 1),
      counts AS (SELECT srr, gene_id, count(*) AS "count" FROM hits GROUP BY srr, gene_id)"""


@query("gene_counts", f"{_genes_sql()} SELECT * FROM counts")
def gene_counts(spark, sf):
    return A.gene_counts(good(spark, sf), load(spark, sf, "exons_v"))


@query("gene_counts_same_strand", f"""{_genes_sql("p.rev = (e.strand = '-')")} SELECT * FROM counts""")
def gene_counts_same_strand(spark, sf):
    return A.gene_counts(good(spark, sf), load(spark, sf, "exons_v"), strand_mode=1)


@query("gene_counts_opposite_strand", f"""{_genes_sql("p.rev <> (e.strand = '-')")} SELECT * FROM counts""")
def gene_counts_opposite_strand(spark, sf):
    return A.gene_counts(good(spark, sf), load(spark, sf, "exons_v"), strand_mode=2)


_FRAGMENTS = f"""WITH {ctes('paired_v', 'exons_v')}, ends AS (
      SELECT *, pos + 49 AS last, flag & 128 > 0 AS second FROM paired_v WHERE flag & 13 = 1),
    frags AS (SELECT srr, qname FROM ends GROUP BY srr, qname
              HAVING count(*) FILTER (second) = 1 AND count(*) FILTER (NOT second) = 1 AND count(DISTINCT ref) = 1
                 AND max(last) - min(pos) + 1 BETWEEN 50 AND 600),
    hits AS (SELECT t.srr, t.qname, min(x.gene_id) AS gene_id FROM frags t JOIN ends e ON t.srr = e.srr AND t.qname = e.qname
             JOIN exons_v x ON e.ref = x.ref AND e.pos <= x."end" AND x.start <= e.last
             GROUP BY t.srr, t.qname HAVING count(DISTINCT x.gene_id) = 1)"""


@query("gene_counts_paired", f"""{_FRAGMENTS} SELECT srr, gene_id, count(*) AS "count" FROM hits GROUP BY srr, gene_id""")
def gene_counts_paired(spark, sf):
    return A.gene_counts(load(spark, sf, "paired_v"), load(spark, sf, "exons_v"), paired=True)


_MODES = """layouts AS (SELECT srr, CASE WHEN count(*) % 2 = 0 THEN 'PE' ELSE 'SE' END AS layout,
    CASE count(*) % 3 WHEN 0 THEN 'same_strand' WHEN 1 THEN 'opposite_strand' ELSE 'unstranded' END AS strand
    FROM {0} GROUP BY srr)"""


def _layouts(df):
    n = F.count(F.lit(1))
    return df.groupBy("srr").agg(
        F.when(n % 2 == 0, "PE").otherwise("SE").alias("layout"),
        F.when(n % 3 == 0, "same_strand").when(n % 3 == 1, "opposite_strand").otherwise("unstranded").alias("strand"))


@query("count_modes", f"""WITH {ctes('alignments_v')}, {_MODES.format('alignments_v')}
    SELECT srr, layout = 'PE' AS paired, CASE strand WHEN 'same_strand' THEN 1 WHEN 'opposite_strand' THEN 2 ELSE 0 END
      AS strand_mode FROM layouts""")
def count_modes(spark, sf):
    runs = _layouts(reads(spark, sf))
    return A.count_modes(runs.drop("strand"), runs.drop("layout"))


@query("gene_counts_by_mode", f"""{_genes_sql('''CASE (SELECT strand FROM layouts l WHERE l.srr = p.srr)
        WHEN 'same_strand' THEN p.rev = (e.strand = '-') WHEN 'opposite_strand' THEN p.rev <> (e.strand = '-')
        ELSE true END''').replace(', hits AS', ', ' + _MODES.format('good') + ', hits AS', 1)}
    SELECT * FROM counts""")
def gene_counts_by_mode(spark, sf):
    rows = good(spark, sf)
    runs = _layouts(rows)
    modes = A.count_modes(runs.withColumn("layout", F.lit("SE")), runs)
    return A.gene_counts_by_mode(rows, load(spark, sf, "exons_v"), modes)


@query("gene_count_summary", f"""{_genes_sql()} SELECT r.srr, coalesce(sum("count"), 0)::BIGINT AS number_genic_reads,
    round(count("count") * 100 / (SELECT count(DISTINCT gene_id) FROM exons_v), 6) AS percent_genes_on
    FROM (SELECT DISTINCT srr FROM alignments_v) r LEFT JOIN counts c ON r.srr = c.srr GROUP BY r.srr""")
def gene_count_summary(spark, sf):
    exons = load(spark, sf, "exons_v")
    return rounded(A.gene_count_summary(A.gene_counts(good(spark, sf), exons), reads(spark, sf), exons))


@query("count_table_summary", f"""WITH {ctes('orders_v')} SELECT srr, sum(floor(o_totalprice / 250000))::BIGINT
    AS number_genic_reads, round(avg((o_totalprice >= 250000)::INT) * 100, 6) AS percent_genes_on
    FROM orders_v GROUP BY srr""")
def count_table_summary(spark, sf):
    return rounded(A.count_table_summary(load(spark, sf, "orders_v").select(
        "srr", F.floor(F.col("o_totalprice") / 250000).alias("count"))))


_JUNCTIONS = f"""WITH {_ALN}, j AS (SELECT g.srr, g.ref, g.pos + i.a AS start, g.pos + i.b AS "end", count(*) AS "count"
    FROM good g JOIN introns i ON g.cigar = i.cigar GROUP BY ALL)"""


@query("junction_counts", f"{_JUNCTIONS} SELECT * FROM j")
def junction_counts(spark, sf):
    return A.junction_counts(good(spark, sf))


@query("junction_summary", f"""{_JUNCTIONS} SELECT srr, sum("count")::BIGINT AS number_junction_reads,
    count(*) AS number_junctions_on FROM j GROUP BY srr""")
def junction_summary(spark, sf):
    return A.junction_summary(A.junction_counts(good(spark, sf)))


# ---- region classes and coverage, against base-by-base SQL --------------------------------------------------------

_TX = """tx AS (SELECT tx, ref, strand, cds_start, cds_end, unnest(exon_starts) AS s, unnest(exon_ends) AS e,
               unnest(range(0, len(exon_starts))) AS i, len(exon_starts) AS n_exons FROM transcripts_v)"""


@query("base_classes", f"""WITH {_ALN}, {ctes('transcripts_v')}, {_TX},
    marked AS (
      SELECT ref, unnest(range(s, e + 1)) AS p, cds_start, cds_end, 'exon' AS kind FROM tx
      UNION ALL
      SELECT a.ref, unnest(range(a.e + 1, b.s)), 0, -1, 'intron' FROM tx a JOIN tx b ON a.tx = b.tx AND b.i = a.i + 1),
    genome AS (SELECT ref, p, min(CASE WHEN kind = 'intron' THEN 3 WHEN p BETWEEN cds_start AND cds_end THEN 1 ELSE 2 END) AS cls
               FROM marked GROUP BY ref, p),
    bases AS (SELECT srr, ref, unnest(range(a, b + 1)) AS p FROM pieces),
    found AS (SELECT srr, coalesce(cls, 4) AS cls FROM bases LEFT JOIN genome USING (ref, p)),
    sums AS (SELECT srr, count(*) AS aligned_bases, count(*) FILTER (cls = 1) AS coding_bases,
               count(*) FILTER (cls = 2) AS utr_bases, count(*) FILTER (cls = 3) AS intronic_bases,
               count(*) FILTER (cls = 4) AS intergenic_bases FROM found GROUP BY srr)
    SELECT *, round(coding_bases * 100 / aligned_bases, 6) AS percent_coding_bases,
      round(utr_bases * 100 / aligned_bases, 6) AS percent_utr_bases,
      round(intronic_bases * 100 / aligned_bases, 6) AS percent_intronic_bases,
      round(intergenic_bases * 100 / aligned_bases, 6) AS percent_intergenic_bases,
      round((coding_bases + utr_bases) * 100 / aligned_bases, 6) AS percent_mrna_bases FROM sums""")
def base_classes(spark, sf):
    return rounded(V.base_classes(good(spark, sf), load(spark, sf, "transcripts_v")))


_DEPTH = f"""WITH {_ALN}, {ctes('transcripts_v')}, {_TX},
    placed AS (SELECT *, sum(e - s + 1) OVER (PARTITION BY tx) AS len,
                 sum(e - s + 1) OVER (PARTITION BY tx ORDER BY i) - (e - s + 1) AS off FROM tx),
    long_tx AS (SELECT * FROM placed WHERE len >= 101),
    met AS (SELECT p.srr, t.tx, t.strand, t.len::BIGINT AS len, t.off::BIGINT AS off, t.s,
              unnest(range(greatest(p.a, t.s), least(p.b, t.e) + 1)) AS p
            FROM pieces p JOIN long_tx t ON p.ref = t.ref AND p.a <= t.e AND t.s <= p.b),
    depth AS (SELECT srr, tx, len, CASE WHEN strand = '-' THEN len - 1 - (off + p - s) ELSE off + p - s END AS x,
                count(*) AS d FROM met GROUP BY ALL),
    per_tx AS (SELECT srr, tx, len, sum(d) AS s1, sum(d * d) AS s2, coalesce(sum(d) FILTER (x < least(100, len)), 0) AS five,
                 coalesce(sum(d) FILTER (x >= len - least(100, len)), 0) AS three, least(100, len) AS ends
               FROM depth GROUP BY srr, tx, len)"""


@query("depth_stretches", f"""{_DEPTH} SELECT srr, tx, len AS tx_len, count(*) AS n_bases, sum(d)::BIGINT AS total,
    max(d) AS deepest FROM depth GROUP BY srr, tx, len""")
def depth_stretches(spark, sf):
    size = F.col("b") - F.col("a") + 1
    return (V.depth_stretches(good(spark, sf), load(spark, sf, "transcripts_v")).groupBy("srr", "tx", "tx_len")
            .agg(F.sum(size).alias("n_bases"), F.sum(size * F.col("depth")).alias("total"),
                 F.max("depth").alias("deepest")))


@query("gene_body_coverage", f"""{_DEPTH},
    sized AS (SELECT len, x * 100 // (len - 1) AS position, count(*) AS size
              FROM (SELECT len, unnest(range(0, len)) AS x FROM (SELECT DISTINCT len FROM per_tx) l) t GROUP BY ALL),
    binned AS (SELECT d.srr, d.tx, d.len, x * 100 // (d.len - 1) AS position, sum(d) AS d FROM depth d GROUP BY ALL),
    shares AS (SELECT b.srr, b.position, sum(b.d / s.size / (t.s1 / t.len)) AS v
               FROM binned b JOIN sized s ON b.len = s.len AND b.position = s.position
               JOIN per_tx t ON b.srr = t.srr AND b.tx = t.tx GROUP BY ALL),
    runs AS (SELECT srr, count(*) AS n_tx FROM per_tx GROUP BY srr)
    SELECT r.srr, p.position::INTEGER AS position, round(coalesce(v, 0) / n_tx, 6) AS coverage
    FROM runs r CROSS JOIN (SELECT unnest(range(0, 101)) AS position) p LEFT JOIN shares s
    ON r.srr = s.srr AND p.position = s.position""")
def gene_body_coverage(spark, sf):
    rows = V.gene_body_coverage(V.depth_stretches(good(spark, sf), load(spark, sf, "transcripts_v")))
    return rounded(rows.select("srr", F.posexplode("coverage").alias("position", "coverage")))


@query("coverage_evenness", f"""{_DEPTH}, even AS (
      SELECT srr, sqrt(greatest(s2 / len - (s1 / len) * (s1 / len), 0)) / (s1 / len) AS cv, five / ends / (s1 / len) AS b5,
             three / ends / (s1 / len) AS b3, five / nullif(CAST(three AS DOUBLE), 0) AS b53 FROM per_tx)
    SELECT srr, round(median(cv), 6) AS median_cv_coverage, round(median(b5), 6) AS median_5prime_bias,
      round(median(b3), 6) AS median_3prime_bias, round(median(b53), 6) AS median_5prime_to_3prime_bias
    FROM even GROUP BY srr""")
def coverage_evenness(spark, sf):
    return rounded(V.coverage_evenness(V.depth_stretches(good(spark, sf), load(spark, sf, "transcripts_v"))))


_AGREE = f"""{_genes_sql()}, agree AS (SELECT srr, count(*) AS reads_on_genes,
    count(*) FILTER (rev = (strand = '-')) / count(*) AS share FROM hits GROUP BY srr)"""


@query("strand_agreement", f"{_AGREE} SELECT srr, reads_on_genes, round(share, 6) AS correct_strand_share FROM agree")
def strand_agreement(spark, sf):
    return rounded(V.strand_agreement(good(spark, sf), load(spark, sf, "exons_v")))


@query("strand_from_alignments", f"""{_AGREE} SELECT srr, CASE WHEN share >= 0.5 THEN 'same_strand'
    WHEN 1 - share >= 0.5 THEN 'opposite_strand' ELSE 'unstranded' END AS strand FROM agree""")
def strand_from_alignments(spark, sf):
    return V.strand_from_agreement(V.strand_agreement(good(spark, sf), load(spark, sf, "exons_v")), threshold=0.5)


# ---- a cohort of single-end and paired runs together ------------------------------------------------------------------

# the names that the single-end statements start from, over both kinds of runs
_MIX = f"""{ctes('alignments_v', 'paired_v')}, {_SHAPES},
    mixed AS (SELECT * FROM alignments_v UNION ALL SELECT 'PE' || srr, * EXCLUDE (srr) FROM paired_v),
    good AS (SELECT *, row_number() OVER () AS rid, (flag & 16 > 0) <> (flag & 129 = 129) AS rev
             FROM mixed WHERE mapq >= 20 AND flag & 4 = 0),
    pieces AS (SELECT g.rid, g.srr, g.ref, g.rev, g.pos + b.a AS a, g.pos + b.b AS b
               FROM good g JOIN blocks b ON g.cigar = b.cigar)"""


def _mixed(spark, sf):
    pairs = load(spark, sf, "paired_v")
    return reads(spark, sf).unionByName(pairs.withColumn("srr", F.concat(F.lit("PE"), "srr")))


def _mixed_layout(rows):
    paired = F.col("srr").startswith("PE")
    return rows.select("srr").distinct().withColumn("layout", F.when(paired, "PE").otherwise("SE"))


def _over_mix(name: str) -> str:
    return f"({ORACLES[name].replace(_ALN, _MIX)})"


# a unit is what counts once: a read of a single-end run, or a pair of a paired one with the strand of its first mate
def _mixed_genes(rule: str) -> str:
    return f"""spans_of AS (SELECT g.*, g.pos + s.len - 1 AS last, flag & 128 > 0 AS second FROM good g JOIN spans s ON g.cigar = s.cigar),
    frags AS (SELECT srr, qname, bool_or(flag & 64 > 0 AND flag & 16 > 0) AS rev FROM spans_of
              WHERE srr LIKE 'PE%' AND flag & 9 = 1 GROUP BY srr, qname
              HAVING count(*) FILTER (second) = 1 AND count(*) FILTER (NOT second) = 1 AND count(DISTINCT ref) = 1
                 AND max(last) - min(pos) + 1 BETWEEN 50 AND 600),
    units AS (SELECT 'r' || rid AS unit, srr, ref, rev, a, b FROM pieces WHERE srr NOT LIKE 'PE%'
      UNION ALL SELECT t.srr || '/' || t.qname, t.srr, p.ref, t.rev, p.a, p.b
      FROM frags t JOIN good g ON g.srr = t.srr AND g.qname = t.qname AND g.flag & 9 = 1 JOIN pieces p ON p.rid = g.rid),
    hits AS (SELECT u.unit, any_value(u.srr) AS srr, min(e.gene_id) AS gene_id
      FROM units u JOIN exons_v e ON u.ref = e.ref AND u.a <= e."end" AND e.start <= u.b AND {rule}
      GROUP BY u.unit HAVING count(DISTINCT e.gene_id) = 1),
    counts AS (SELECT srr, gene_id, count(*) AS "count" FROM hits GROUP BY srr, gene_id)"""


@query("gene_counts_mixed", f"""WITH {_MIX}, {ctes('exons_v')}, strands AS (SELECT srr, count(*) % 3 AS s FROM mixed GROUP BY srr),
    {_mixed_genes("""CASE (SELECT s FROM strands x WHERE x.srr = u.srr) WHEN 0 THEN u.rev = (e.strand = '-')
      WHEN 1 THEN u.rev <> (e.strand = '-') ELSE true END""")}
    SELECT * FROM counts""")
def gene_counts_mixed(spark, sf):
    """Single reads and pairs counted together, some runs stranded."""
    rows = _mixed(spark, sf)
    modes = A.count_modes(_mixed_layout(rows), _layouts(rows))
    return A.gene_counts_by_mode(A.mapq_filter(rows), load(spark, sf, "exons_v"), modes)


_CALLED = """CASE WHEN (SELECT correct_strand_share FROM agreed x WHERE x.srr = u.srr) >= 0.75 THEN u.rev = (e.strand = '-')
      WHEN (SELECT 1 - correct_strand_share FROM agreed x WHERE x.srr = u.srr) >= 0.75 THEN u.rev <> (e.strand = '-')
      ELSE true END"""


@query("alignment_features", f"""WITH {_MIX}, {ctes('exons_v')}, agreed AS {_over_mix('strand_agreement')}, {_mixed_genes(_CALLED)},
    ends AS (SELECT srr, qname, flag & 9 = 1 AS mated, struct_pack(ref := ref, p := {_FIVE_PRIME}, r := flag & 16) AS e
             FROM good JOIN spans USING (cigar)),
    templates AS (SELECT srr, CAST([e] AS VARCHAR) AS k, false AS is_pair FROM ends WHERE NOT mated
      UNION ALL SELECT srr, CAST(CASE WHEN count(*) > 1 THEN [min(e), max(e)] ELSE [min(e)] END AS VARCHAR), count(*) > 1
      FROM ends WHERE mated GROUP BY srr, qname),
    copies AS (SELECT srr, is_pair, k, count(*) AS n FROM templates GROUP BY ALL),
    dups AS (SELECT srr, sum(n - 1) FILTER (is_pair) AS pd, sum((n - 1) * CASE WHEN is_pair THEN 2 ELSE 1 END)
        / sum(n * CASE WHEN is_pair THEN 2 ELSE 1 END) * 100 AS percent_duplication FROM copies GROUP BY srr),
    genic AS (SELECT srr, sum("count")::BIGINT AS number_genic_reads,
        count(*) * 100 / (SELECT count(DISTINCT gene_id) FROM exons_v) AS percent_genes_on FROM counts GROUP BY srr)
    SELECT h.srr, h.num_reads, h.num_multimappers, h.num_discordant_reads_aligned, h.per_alignment, a."reads_MQ0",
      a.average_quality, a.inward_oriented_pairs, a."Percent Reverse", coalesce(d.pd, 0)::BIGINT AS read_pair_duplicates,
      round(d.percent_duplication, 6) AS percent_duplication,
      CASE WHEN s.correct_strand_share >= 0.75 THEN 'same_strand' WHEN 1 - s.correct_strand_share >= 0.75 THEN 'opposite_strand'
           ELSE 'unstranded' END AS strand,
      b.percent_coding_bases, b.percent_intronic_bases, c.median_cv_coverage, c.median_5prime_to_3prime_bias,
      coalesce(g.number_genic_reads, 0) AS number_genic_reads, round(coalesce(g.percent_genes_on, 0), 6) AS percent_genes_on,
      coalesce(j.number_junction_reads, 0) AS number_junction_reads, coalesce(j.number_junctions_on, 0) AS number_junctions_on
    FROM ({_stage_sql('paired_v').replace('FROM paired_v)', 'FROM mixed)').replace(ctes('paired_v'), _MIX)}) h
    LEFT JOIN {_over_mix('aln_stats')} a ON a.srr = h.srr LEFT JOIN dups d ON d.srr = h.srr
    LEFT JOIN agreed s ON s.srr = h.srr LEFT JOIN {_over_mix('base_classes')} b ON b.srr = h.srr
    LEFT JOIN {_over_mix('coverage_evenness')} c ON c.srr = h.srr LEFT JOIN genic g ON g.srr = h.srr
    LEFT JOIN {_over_mix('junction_summary')} j ON j.srr = h.srr""")
def alignment_features(spark, sf):
    """The job from alignments to stage tables, its tables side by side."""
    rows = _mixed(spark, sf)
    out = jobs.alignment_features(rows, load(spark, sf, "exons_v"), load(spark, sf, "transcripts_v"), _mixed_layout(rows))
    wanted = {"hisat2": ["num_reads", "num_multimappers", "num_discordant_reads_aligned", "per_alignment"],
              "aln_stats": ["reads_MQ0", "average_quality", "inward_oriented_pairs", "Percent Reverse"],
              "markduplicates": ["read_pair_duplicates", "percent_duplication"], "strand": ["strand"],
              "rnaseqmetrics": ["percent_coding_bases", "percent_intronic_bases", "median_cv_coverage",
                                "median_5prime_to_3prime_bias"],
              "count_summary": ["number_genic_reads", "percent_genes_on", "number_junction_reads", "number_junctions_on"]}
    return rounded(X.align({stage: out[stage].select("srr", *columns) for stage, columns in wanted.items()}))
