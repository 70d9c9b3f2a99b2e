"""Where the aligned bases lie: region classes, transcript coverage, strand agreement.

Nothing is expanded to single bases. Depth is kept as changes at positions; running sums turn the changes of one
transcript (or one bin of the genome) into stretches of equal depth, so every window group is bounded by the length of
a transcript or the width of a bin, however deep the sequencing is.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortqc import schemas
from cohortqc.functions import cigar as C
from cohortqc.operators.alignments import (
    MINUS, PLUS, UNMAPPED, block_rows, fragments, has, is_collapsed, numbered_genes, placed_blocks, primary, shape_key,
)
from cohortqc.operators.intervals import BIN_WIDTH, FACTOR, clip_to_bins, overlap_join
from cohortqc.session import BROADCAST_ROWS, written

CLASSES = ("coding", "utr", "intronic")
END_BASES = 100


# ---- annotation ---------------------------------------------------------------------------------------------------

def transcript_regions(transcripts: DataFrame) -> DataFrame:
    """``(ref, start, end, cls)`` of every transcript: coding and UTR parts of the exons, and the introns between.

    A transcript without coding sequence (its end before its start) is all UTR.
    """
    exon = (transcripts.where(F.size("exon_starts") > 0)
            .select("ref", "cds_start", "cds_end", F.explode(F.arrays_zip("exon_starts", "exon_ends")).alias("_e"))
            .select("ref", "cds_start", "cds_end", F.col("_e.exon_starts").alias("s"), F.col("_e.exon_ends").alias("e")))
    coding = F.col("cds_start") <= F.col("cds_end")
    c0, c1 = F.greatest("s", "cds_start"), F.least("e", "cds_end")

    def part(start: Column, end: Column, cls: str) -> Column:
        return F.struct(start.alias("start"), end.alias("end"), F.lit(cls).alias("cls"))

    pieces = F.when(coding, F.array(
        part(c0, c1, "coding"),
        part(F.col("s"), F.least(F.col("e"), F.col("cds_start") - 1), "utr"),
        part(F.greatest(F.col("s"), F.col("cds_end") + 1), F.col("e"), "utr"),
    )).otherwise(F.array(part(F.col("s"), F.col("e"), "utr")))
    exonic = exon.select("ref", F.inline(pieces))
    n = F.size("exon_starts")
    gaps = F.zip_with(F.slice("exon_ends", F.lit(1), n - 1), F.slice("exon_starts", F.lit(2), n - 1),
                      lambda before, following: F.struct((before + 1).alias("start"), (following - 1).alias("end")))
    introns = transcripts.where(n > 1).select("ref", F.inline(gaps)).withColumn("cls", F.lit("intronic"))
    return exonic.unionByName(introns).where(F.col("start") <= F.col("end"))


def class_segments(regions: DataFrame, width: int = BIN_WIDTH) -> DataFrame:
    """Disjoint stretches ``(ref, start, end, cls)``; where classes overlap, coding beats UTR beats intronic.

    The genome is flattened in wide slices, each on its own; a region is cut at their borders only, and neighbouring
    stretches of one class inside a slice are one row, so an intron stays one row.
    """
    pieces = clip_to_bins(regions, width * FACTOR ** 2)
    edges = F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("d")),
                    F.struct((F.col("end") + 1).alias("at"), F.lit(-1).alias("d")))
    change = (pieces.select("ref", "bin", "cls", F.inline(edges)).groupBy("ref", "bin", "at")
              .agg(*[F.sum(F.when(F.col("cls") == c, F.col("d")).otherwise(0)).alias(c) for c in CLASSES]))
    order = W.partitionBy("ref", "bin").orderBy("at")
    running = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    depth = change.select("ref", "bin", "at", *[F.sum(c).over(running).alias(c) for c in CLASSES])
    cls = F.when(F.col("coding") > 0, "coding").when(F.col("utr") > 0, "utr").when(F.col("intronic") > 0, "intronic")
    # a class holds until the next change of class
    marked = depth.select("ref", "bin", "at", cls.alias("cls")).withColumn("before", F.lag("cls").over(order))
    turns = marked.where(~F.col("cls").eqNullSafe(F.col("before")))
    return turns.select("ref", F.col("at").alias("start"), (F.lead("at").over(order) - 1).alias("end"), "cls").where(
        "cls IS NOT NULL")


def transcript_exons(transcripts: DataFrame, min_length: int) -> DataFrame:
    """Exons with their offset in the transcript, for transcripts of at least ``min_length`` exonic bases."""
    lengths = F.zip_with("exon_starts", "exon_ends", lambda s, e: e - s + 1)

    def total(array: Column) -> Column:
        return F.aggregate(array, F.lit(0).cast("bigint"), lambda acc, x: acc + x)

    return (transcripts.withColumn("_len", lengths).withColumn("tx_len", total(F.col("_len")))
            .where(F.col("tx_len") >= min_length)
            .select("tx", "ref", "strand", "tx_len", "_len",
                    F.posexplode(F.arrays_zip("exon_starts", "exon_ends")).alias("_i", "_e"))
            .select("tx", "ref", "strand", "tx_len", F.col("_e.exon_starts").alias("start"),
                    F.col("_e.exon_ends").alias("end"),
                    total(F.slice("_len", F.lit(1), F.col("_i"))).alias("offset")))


# ---- alignments ---------------------------------------------------------------------------------------------------

def aligned_shapes(alignments: DataFrame) -> DataFrame:
    """Equal alignments of a run collapsed to one row with a count, before anything is expanded or joined; rows of
    ``collapse`` are taken as they are."""
    if is_collapsed(alignments):
        return alignments.select("srr", "ref", "pos", "cigar", "n")
    return (alignments.where(primary() & ~has(UNMAPPED)).groupBy("srr", "ref", "pos", "cigar")
            .agg(F.count(F.lit(1)).alias("n")))


def aligned_blocks(shapes: DataFrame, cigars: DataFrame | None = None) -> DataFrame:
    """Aligned blocks with run and count; ``cigars`` takes ``parsed_cigars`` where they are at hand."""
    if cigars is not None:
        return placed_blocks(shapes, cigars, "srr", "ref", "n")
    return shapes.select("srr", "ref", "n", F.inline(C.blocks(F.col("pos"), F.col("cigar"))))


def base_classes(alignments: DataFrame, transcripts: DataFrame, width: int = BIN_WIDTH,
                 max_rows: int = BROADCAST_ROWS, cigars: DataFrame | None = None) -> DataFrame:
    """Per run: aligned bases by class, and the percentages of the ``rnaseqmetrics`` stage."""
    shapes = aligned_shapes(alignments)
    length = C.aligned_length(F.col("cigar")) if cigars is None else F.col("aligned")
    sized = shapes if cigars is None else shapes.join(cigars.select("cigar", "aligned"), "cigar", "left")
    total = sized.groupBy("srr").agg(F.sum(F.col("n") * length).alias("aligned"))
    segments = written(class_segments(transcript_regions(transcripts), width), "class-segments")
    met = overlap_join(aligned_blocks(shapes, cigars), segments, width, max_rows)
    overlap = (F.least("end", "s_end") - F.greatest("start", "s_start") + 1) * F.col("n")
    found = met.groupBy("srr").agg(*[F.coalesce(F.sum(F.when(F.col("s_cls") == c, overlap)), F.lit(0)).alias(f"{c}_bases")
                                     for c in CLASSES])
    counts = total.join(found, "srr", "left").na.fill(0).withColumn(
        "intergenic_bases", F.col("aligned") - F.col("coding_bases") - F.col("utr_bases") - F.col("intronic_bases"))

    def percent(c: Column, name: str) -> Column:
        return F.coalesce(F.try_divide(c * 100, F.col("aligned")), F.lit(0.0)).alias(name)

    return counts.select(
        "srr", F.col("aligned").alias("aligned_bases"), "coding_bases", "utr_bases", "intronic_bases",
        "intergenic_bases",
        *[percent(F.col(f"{c}_bases"), f"percent_{c}_bases") for c in (*CLASSES, "intergenic")],
        percent(F.col("coding_bases") + F.col("utr_bases"), "percent_mrna_bases"))


def depth_stretches(alignments: DataFrame, transcripts: DataFrame, min_length: int = schemas.N_COVERAGE,
                    width: int = BIN_WIDTH, max_rows: int = BROADCAST_ROWS, cigars: DataFrame | None = None) -> DataFrame:
    """Per run and transcript: stretches ``[a, b]`` of equal, positive depth, in transcript coordinates from the 5'
    end."""
    exons = transcript_exons(transcripts, min_length)
    met = overlap_join(aligned_blocks(aligned_shapes(alignments), cigars), exons, width=width, max_rows=max_rows)
    lo, hi = F.greatest("start", "s_start"), F.least("end", "s_end")
    a = F.col("s_offset") + lo - F.col("s_start")
    b = F.col("s_offset") + hi - F.col("s_start")
    minus = F.col("s_strand") == "-"
    last = F.col("s_tx_len") - 1
    placed = met.select("srr", F.col("s_tx").alias("tx"), F.col("s_tx_len").alias("tx_len"), "n",
                        F.when(minus, last - b).otherwise(a).alias("a"), F.when(minus, last - a).otherwise(b).alias("b"))
    edges = F.array(F.struct(F.col("a").alias("at"), F.col("n").alias("d")),
                    F.struct((F.col("b") + 1).alias("at"), (-F.col("n")).alias("d")))
    # dealt once, before a piece becomes two edges, and sorted once: no aggregate holds the edges of a task. The last
    # edge of a place knows the depth up to the next one. The transcript leads the sort: names of runs are much alike
    change = placed.repartition("srr", "tx", "tx_len").select("srr", "tx", "tx_len", F.inline(edges))
    order = W.partitionBy("tx", "srr", "tx_len").orderBy("at")
    return (change.select("srr", "tx", "tx_len", F.col("at").alias("a"), (F.lead("at").over(order) - 1).alias("b"),
                          F.sum("d").over(order.rangeBetween(W.unboundedPreceding, W.currentRow)).alias("depth"))
            .where("depth > 0 AND b >= a"))


def _overlap(a: Column, b: Column) -> Column:
    return F.greatest(F.least(F.col("b"), b) - F.greatest(F.col("a"), a) + 1, F.lit(0))


def gene_body_coverage(stretches: DataFrame) -> DataFrame:
    """101 relative positions per run: depth in the position over the transcript's mean, averaged over the covered
    transcripts (``genebody_coverage`` stage row). Transcripts have at least 101 bases, so no position is empty."""
    last = F.col("tx_len") - 1
    transcript = W.partitionBy("srr", "tx", "tx_len")
    position = lambda x: F.floor(x * 100 / last)
    cut = stretches.select(
        "srr", "tx_len", "a", "b", "depth",
        (F.sum(F.col("depth") * (F.col("b") - F.col("a") + 1)).over(transcript) / F.col("tx_len")).alias("mean"),
        (F.min("a").over(transcript) == F.col("a")).alias("leads"))
    # in a select of its own: beside a window, the window would see the exploded rows
    cut = cut.withColumn("position", F.explode(F.sequence(position(F.col("a")), position(F.col("b")))))
    first = F.ceil(F.col("position") * last / 100)
    end = F.least(F.ceil((F.col("position") + 1) * last / 100) - 1, last)
    value = F.col("depth") * _overlap(first, end) / (end - first + 1) / F.col("mean")
    # every covered transcript is counted once, at the first position of its first stretch
    counted = F.count_if(F.col("leads") & (F.col("position") == position(F.col("a"))))
    summed = (cut.groupBy("srr", "position").agg(F.sum(value).alias("v"), counted.alias("n"))
              .groupBy("srr").agg(F.map_from_entries(F.collect_list(F.struct("position", "v"))).alias("m"),
                                  F.sum("n").alias("n_tx")))
    values = F.transform(F.sequence(F.lit(0), F.lit(schemas.N_COVERAGE - 1)), lambda i: F.coalesce(
        F.try_element_at("m", i.cast("bigint")), F.lit(0.0)) / F.col("n_tx"))
    return summed.select("srr", values.alias("coverage"))


def transcript_evenness(stretches: DataFrame) -> DataFrame:
    """Per run and transcript: variation of the depth, and both ends over the mean."""
    size = F.col("b") - F.col("a") + 1
    zero, last = F.lit(0), F.col("tx_len") - 1
    end = F.least(F.lit(END_BASES), F.col("tx_len"))
    sums = stretches.groupBy("srr", "tx", "tx_len").agg(
        F.sum(F.col("depth") * size).alias("s1"), F.sum(F.col("depth") * F.col("depth") * size).alias("s2"),
        F.sum(F.col("depth") * _overlap(zero, end - 1)).alias("five"),
        F.sum(F.col("depth") * _overlap(last - end + 1, last)).alias("three"))
    mean = F.col("s1") / F.col("tx_len")
    variance = F.greatest(F.col("s2") / F.col("tx_len") - mean * mean, F.lit(0.0))
    return sums.select(
        "srr", "tx", (F.sqrt(variance) / mean).alias("cv"), (F.col("five") / end / mean).alias("bias5"),
        (F.col("three") / end / mean).alias("bias3"), F.try_divide("five", "three").alias("bias5to3"))


def coverage_evenness(stretches: DataFrame) -> DataFrame:
    """Per run: medians over the covered transcripts (columns of the ``rnaseqmetrics`` stage)."""
    return transcript_evenness(stretches).groupBy("srr").agg(
        F.median("cv").alias("median_cv_coverage"), F.median("bias5").alias("median_5prime_bias"),
        F.median("bias3").alias("median_3prime_bias"), F.median("bias5to3").alias("median_5prime_to_3prime_bias"))


def strand_agreement(alignments: DataFrame, exons: DataFrame, width: int = BIN_WIDTH,
                     max_rows: int = BROADCAST_ROWS, cigars: DataFrame | None = None) -> DataFrame:
    """Per run: reads on exactly one gene, and the share of them that lie on the gene's strand."""
    shapes = fragments(alignments)
    numbered, _ = numbered_genes(exons)
    pairs = overlap_join(block_rows(shapes, cigars=cigars), numbered, width=width, max_rows=max_rows)
    reads = (pairs.groupBy(*shape_key(shapes)).agg(F.min("s_gene_no").alias("g0"), F.max("s_gene_no").alias("g1"),
                                                   F.min("s_strand").alias("strand"), F.max("n").alias("n"))
             .where(F.col("g0") == F.col("g1")))
    agrees = F.when(F.col("reverse"), MINUS).otherwise(PLUS) == F.col("strand")
    on = F.coalesce(F.sum(F.when(agrees, F.col("n"))), F.lit(0))
    return reads.groupBy("srr").agg(F.sum("n").alias("reads_on_genes"),
                                    (on / F.sum("n")).alias("correct_strand_share"))


def strand_from_agreement(agreement: DataFrame, threshold: float = 0.75) -> DataFrame:
    """Strandedness from the measured share; reversing the assumption turns the share into its complement."""
    share = F.col("correct_strand_share")
    return agreement.select("srr", F.when(share >= threshold, "same_strand")
                            .when(1 - share >= threshold, "opposite_strand").otherwise("unstranded").alias("strand"))


