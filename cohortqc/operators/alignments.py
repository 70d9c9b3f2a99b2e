"""Statistics, duplicates, gene and junction counts from an alignments table."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortqc.functions import cigar as C
from cohortqc.functions.quality import quality_sum
from cohortqc.operators.intervals import BIN_WIDTH, overlap_join
from cohortqc.session import BROADCAST_ROWS, written

# ---- Fixed values: bits of the alignment flag. --------------------------------------------------------------------
PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED = 1, 2, 4, 8
REVERSE, MATE_REVERSE, FIRST, SECOND = 16, 32, 64, 128
SECONDARY, QC_FAIL, DUPLICATE, SUPPLEMENTARY = 256, 512, 1024, 2048


def has(bit: int, flag: Column | None = None) -> Column:
    return (F.col("flag") if flag is None else flag).bitwiseAND(bit) != 0


def primary() -> Column:
    return ~has(SECONDARY | SUPPLEMENTARY)


def mapped(alignments: DataFrame) -> DataFrame:
    return alignments.where(~has(UNMAPPED))


def mapq_filter(alignments: DataFrame, min_mapq: int = 20) -> DataFrame:
    return alignments.where(F.col("mapq") >= min_mapq)


def coordinate_sort(alignments: DataFrame, partitions: int | None = None) -> DataFrame:
    """Total order by reference and position. The name is part of the range key, so a pile-up on one position is
    spread over partitions instead of filling one."""
    keys = [F.col("ref"), F.col("pos"), F.col("qname")]
    ranged = (alignments.repartitionByRange(partitions, *keys) if partitions
              else alignments.repartitionByRange(*keys))
    return ranged.sortWithinPartitions(*keys)


def _stats_columns(within: Column) -> list[Column]:
    """Aggregates of the ``aln_stats`` stage over the rows that ``within`` names. Insert sizes and orientation are read
    from the leftmost mate of a pair on one chromosome."""
    quality = quality_sum(F.when(within, F.col("qual")))
    pair = within & has(PAIRED) & ~has(MATE_UNMAPPED)
    same_ref = (F.col("rnext") == "=") | (F.col("rnext") == F.col("ref"))
    leftmost = pair & same_ref & (F.col("tlen") > 0)
    reverse, mate_reverse = has(REVERSE), has(MATE_REVERSE)
    size = F.when(leftmost, F.col("tlen").cast("double"))
    n = F.count_if(within)
    return [
        F.count_if(within & (F.col("mapq") == 0)).alias("reads_MQ0"),
        F.try_divide(F.sum(quality), F.sum(F.when(within, F.length("qual")))).alias("average_quality"),
        F.coalesce(F.avg(size), F.lit(0.0)).alias("insert_size_average"),
        F.coalesce(F.stddev_pop(size), F.lit(0.0)).alias("insert_size_standard_deviation"),
        F.count_if(leftmost & ~reverse & mate_reverse).alias("inward_oriented_pairs"),
        F.count_if(leftmost & reverse & ~mate_reverse).alias("outward_oriented_pairs"),
        F.count_if(leftmost & (reverse == mate_reverse)).alias("pairs_with_other_orientation"),
        F.count_if(pair & ~same_ref & has(FIRST)).alias("pairs_on_different_chromosomes"),
        F.try_divide(F.count_if(within & ~reverse) * 100, n).alias("Percent Forward"),
        F.try_divide(F.count_if(within & reverse) * 100, n).alias("Percent Reverse")]


def alignment_stats(alignments: DataFrame, min_mapq: int | None = 20) -> DataFrame:
    """Per run: the ``aln_stats`` stage row, computed from the alignments.

    By default the mapping-quality filter comes first, so ``reads_MQ0`` is 0; pass ``min_mapq=None`` for all reads.
    """
    rows = mapq_filter(alignments, min_mapq) if min_mapq is not None else alignments
    return rows.where(primary() & ~has(UNMAPPED)).groupBy("srr").agg(*_stats_columns(F.lit(True)))


def aligner_counts(alignments: DataFrame) -> DataFrame:
    """Per run: reads, paired, unpaired, unaligned, unique, multi-mapped and percent aligned, from the flags.

    A read is multi-mapped when NH says so, or, without NH, when its mapping quality is 0 or 1.
    """
    rows = alignments.where(primary())
    unaligned = has(UNMAPPED)
    nh = F.col("nh") if "nh" in alignments.columns else F.lit(None).cast("int")
    multi = ~unaligned & F.when(nh.isNotNull(), nh > 1).otherwise(F.col("mapq") <= 1)
    n, n_unaligned, n_multi = F.count(F.lit(1)), F.count_if(unaligned), F.count_if(multi)
    return rows.groupBy("srr").agg(
        n.alias("num_reads"), F.count_if(has(PAIRED)).alias("num_reads_paired"),
        F.count_if(~has(PAIRED)).alias("num_reads_unpaired"), n_unaligned.alias("num_unaligned"),
        (n - n_unaligned - n_multi).alias("num_uniquely_aligned"), n_multi.alias("num_multimappers"),
        ((n - n_unaligned) * 100 / n).alias("per_alignment"))


def _stage_columns(within: Column, nh: Column) -> list[Column]:
    """Aggregates of the ``hisat2`` stage over the rows that ``within`` names."""
    mapped_read = ~has(UNMAPPED)
    multi = mapped_read & F.when(nh.isNotNull(), nh > 1).otherwise(F.col("mapq") <= 1)
    unique = mapped_read & ~multi
    paired, first = has(PAIRED), has(FIRST)
    proper = paired & has(PROPER) & mapped_read & ~has(MATE_UNMAPPED)
    discordant = paired & ~proper & unique & ~has(MATE_UNMAPPED)
    alone = ~proper & ~discordant

    def count(condition: Column, name: str) -> Column:
        return F.count_if(within & condition).cast("double").alias(name)

    return [
        count(~paired | first, "num_reads"), count(paired & first, "num_reads_paired"),
        count(~paired, "num_reads_unpaired"), count(first & paired & ~proper, "num_concordant_reads_unaligned"),
        count(first & proper & unique, "num_concordant_reads_uniquely_aligned"),
        count(first & proper & multi, "num_concordant_multimappers"),
        count(first & discordant, "num_discordant_reads_aligned"), count(alone & ~mapped_read, "num_unaligned"),
        count(alone & unique, "num_uniquely_aligned"), count(alone & multi, "num_multimappers"),
        F.try_divide(F.count_if(within & mapped_read) * 100, F.count_if(within)).alias("per_alignment")]


def _hits_column(alignments: DataFrame) -> Column:
    return F.col("nh") if "nh" in alignments.columns else F.lit(None).cast("int")


def aligner_stage(alignments: DataFrame) -> DataFrame:
    """The ``hisat2`` stage row from the flags, with the aligner's own bookkeeping.

    A pair counts once and is concordant when flagged proper; it is discordant when both mates are uniquely aligned but
    not proper. The mates of all other pairs are counted one by one, together with unpaired reads.
    """
    return alignments.where(primary()).groupBy("srr").agg(*_stage_columns(F.lit(True), _hits_column(alignments)))


def flag_summary(alignments: DataFrame, min_mapq: int | None = 20) -> DataFrame:
    """What the flags of every run say, in one pass: ``n_primary`` with the columns of ``aligner_stage`` over primary
    alignments, and ``n_good`` with those of ``alignment_stats`` over the mapped ones that pass the quality filter."""
    within = primary()
    good = within & ~has(UNMAPPED)
    if min_mapq is not None:
        good = good & (F.col("mapq") >= min_mapq)
    return alignments.groupBy("srr").agg(
        F.count_if(within).alias("n_primary"), *_stage_columns(within, _hits_column(alignments)),
        F.count_if(good).alias("n_good"), *_stats_columns(good))


# ---- equal alignments and pairs as single rows --------------------------------------------------------------------

def collapse(alignments: DataFrame) -> DataFrame:
    """Mapped primary alignments of a run that agree in place, CIGAR and strand as one row with a count ``n``.

    ``reverse`` is the strand as aligned, ``second`` marks second mates, ``alone`` reads that are templates as they
    stand: single, or with an unmapped mate. A pile-up costs one row, and whatever only adds up alignments (depth, classes,
    junctions, genes of single reads) reads these rows instead of the alignments.
    """
    return alignments.where(primary() & ~has(UNMAPPED)).groupBy(
        "srr", "ref", "pos", "cigar", has(REVERSE).alias("reverse"), (has(PAIRED) & has(SECOND)).alias("second"),
        (~(has(PAIRED) & ~has(MATE_UNMAPPED))).alias("alone")).agg(F.count(F.lit(1)).alias("n"))


def is_collapsed(rows: DataFrame) -> bool:
    """Whether rows come from ``collapse``."""
    return "n" in rows.columns and "flag" not in rows.columns


ENDS = ("ref_low", "ref_high", "end_low", "end_high", "mix")


def _end(reverse: Column) -> tuple[Column, Column]:
    """An alignment's 5' end as two numbers: its reference by a 64-bit hash, its place and strand exactly."""
    place = C.unclipped_five_prime(F.col("pos"), F.col("cigar"), reverse)
    return F.xxhash64("ref"), place * 2 + reverse.cast("bigint")


def _lone_ends(reverse: Column) -> list[Column]:
    ref, place = _end(reverse)
    return [c.alias(name) for c, name in zip((ref, ref, place, place, F.lit(0).cast("bigint")), ENDS)]


def _pair_ends() -> list[Column]:
    """Both ends of a name in a fixed order, from combining aggregates of numbers. Where the references differ, ``mix``
    tells which end lies on which."""
    ref, place = _end(has(REVERSE))
    return [c.alias(name) for c, name in zip(
        (F.min(ref), F.max(ref), F.min(place), F.max(place), F.bit_xor(F.xxhash64(ref, place))), ENDS)]


def pair_rows(alignments: DataFrame) -> DataFrame:
    """One row per name of the mapped reads whose mate is mapped too: ``n_ends``, both ends, and both places and CIGARs
    with the strand of mate 1, for duplicates and for counting."""
    second = has(SECOND)

    def of(mate: Column, value: str) -> Column:
        return F.max(F.when(mate, F.col(value)))

    last = F.col("pos") + C.reference_length(F.col("cigar")) - 1
    return alignments.where(primary() & ~has(UNMAPPED) & has(PAIRED) & ~has(MATE_UNMAPPED)).groupBy("srr", "qname").agg(
        F.count(F.lit(1)).alias("n_ends"), *_pair_ends(), F.min("ref").alias("ref"), F.max("ref").alias("ref2"),
        F.count_if(~second).alias("n_first"), F.count_if(second).alias("n_second"), F.min("pos").alias("from"),
        F.max(last).alias("to"), F.bool_or(~second & (has(REVERSE) != second)).alias("reverse"),
        of(~second, "pos").alias("pos"), of(~second, "cigar").alias("cigar"),
        of(second, "pos").alias("pos2"), of(second, "cigar").alias("cigar2"))


# ---- duplicates ---------------------------------------------------------------------------------------------------

def _as_templates(pairs: DataFrame, *carry: str) -> DataFrame:
    """Rows per name as templates; an end whose mate is not there stands alone."""
    pair = F.col("n_ends") > 1
    return pairs.select("srr", *carry, pair.alias("is_pair"), *ENDS[:-1],
                        F.when(pair, F.col("mix")).otherwise(0).alias("mix"))


def _templates(alignments: DataFrame) -> DataFrame:
    """srr, qname, is_pair, the ends and the summed base quality of each template.

    A single read, or a read whose mate is unmapped or not among the alignments, is a template as it stands; only true
    pairs are brought together, by an aggregate of numbers.
    """
    score = F.col("score") if "score" in alignments.columns else quality_sum(F.col("qual"), at_least=15)
    rows = alignments.where(primary() & ~has(UNMAPPED)).withColumn("score", score.cast("bigint"))
    both = has(PAIRED) & ~has(MATE_UNMAPPED)
    singles = rows.where(~both).select("srr", "qname", F.lit(False).alias("is_pair"), *_lone_ends(has(REVERSE)), "score")
    pairs = rows.where(both).groupBy("srr", "qname").agg(
        F.count(F.lit(1)).alias("n_ends"), *_pair_ends(), F.sum("score").alias("score"))
    return singles.unionByName(_as_templates(pairs, "qname", "score"))


def repeated_names(alignments: DataFrame) -> DataFrame:
    """Names that occur more than once per run and mate. Template operators expect this to be empty."""
    return (alignments.where(primary()).groupBy("srr", "qname", has(SECOND).alias("second"))
            .agg(F.count(F.lit(1)).alias("n")).where("n > 1"))


TEMPLATE = ("srr", "is_pair", *ENDS)


def mark_duplicates(alignments: DataFrame) -> DataFrame:
    """Per template (srr, qname): is it a copy of a better one at the same place? The highest score stays, then the
    first name.

    The templates are written: their names are needed only where copies were found. Copies and best score come from a
    hash aggregate of numbers; the first name is sought among the copies that share the best score. No window over the
    copies: a group that holds a third of the data is combined before it is shuffled, and its rows meet the one row of
    their group in a join that can be split.
    """
    key = list(TEMPLATE)
    templates = written(_templates(alignments), "templates")
    groups = templates.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"), F.max("score").alias("best"))
    rated = templates.join(groups, key)
    first = rated.where((F.col("copies") > 1) & (F.col("score") == F.col("best"))).groupBy(*key).agg(
        F.min("qname").alias("kept"))
    return rated.join(first, key, "left").select(
        "srr", "qname", "is_pair", (F.col("kept").isNotNull() & (F.col("qname") != F.col("kept"))).alias("is_duplicate"))


def _duplication(templates: DataFrame) -> DataFrame:
    """The ``markduplicates`` stage row of templates with a count ``n``. Only group sizes matter, so nothing is joined
    back."""
    groups = templates.groupBy(*TEMPLATE).agg(F.sum("n").alias("copies"))
    one, two = F.when(~F.col("is_pair"), F.col("copies")), F.when(F.col("is_pair"), F.col("copies"))

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))

    counts = groups.groupBy("srr").agg(
        total(one).alias("unpaired_reads_examined"), total(two).alias("read_pairs_examined"),
        total(one - 1).alias("unpaired_read_duplicates"), total(two - 1).alias("read_pair_duplicates"))
    rate = F.try_divide(F.col("unpaired_read_duplicates") + 2 * F.col("read_pair_duplicates"),
                        F.col("unpaired_reads_examined") + 2 * F.col("read_pairs_examined")) * 100
    return counts.select("*", F.coalesce(rate, F.lit(0.0)).alias("percent_duplication"),
                         F.lit(None).cast("bigint").alias("estimated_library_size"))


def duplication_rate(alignments: DataFrame) -> DataFrame:
    """The ``markduplicates`` stage row of alignments."""
    rows = alignments.where(primary() & ~has(UNMAPPED))
    both = has(PAIRED) & ~has(MATE_UNMAPPED)
    one = F.lit(1).cast("bigint").alias("n")
    singles = rows.where(~both).select("srr", F.lit(False).alias("is_pair"), *_lone_ends(has(REVERSE)), one)
    pairs = rows.where(both).groupBy("srr", "qname").agg(F.count(F.lit(1)).alias("n_ends"), *_pair_ends())
    return _duplication(singles.unionByName(_as_templates(pairs).select("*", one)))


def duplication_of(collapsed: DataFrame, pairs: DataFrame) -> DataFrame:
    """The same from ``collapse`` and ``pair_rows``."""
    singles = collapsed.where("alone").select("srr", F.lit(False).alias("is_pair"), *_lone_ends(F.col("reverse")), "n")
    return _duplication(singles.unionByName(_as_templates(pairs).select("*", F.lit(1).cast("bigint").alias("n"))))


# ---- fragments, genes, junctions ----------------------------------------------------------------------------------

def count_modes(layout: DataFrame, strand: DataFrame) -> DataFrame:
    """Per run: how to count. Pairs only for PE runs; 1 same strand, 2 opposite strand, 0 unstranded."""
    mode = (F.when(F.col("strand") == "same_strand", 1).when(F.col("strand") == "opposite_strand", 2).otherwise(0))
    return (layout.select("srr", "layout").join(strand.select("srr", "strand"), "srr", "left")
            .select("srr", (F.col("layout") == "PE").alias("paired"), mode.alias("strand_mode")))


SHAPE = ("srr", "ref", "reverse", "pos", "cigar", "pos2", "cigar2")


def shape_key(shapes: DataFrame) -> list[str]:
    """Columns that identify a shape; single reads have no second end."""
    return [c for c in SHAPE if c in shapes.columns]


def fragments(alignments: DataFrame, paired: bool = False, min_size: int = 50, max_size: int = 600) -> DataFrame:
    """Countable fragments, collapsed to distinct shapes with a count ``n``.

    Single reads are their own fragment; taken one by one, the second mate of a pair counts on the other strand. Of
    pairs, both ends must be mapped to one chromosome and span 50 to 600 bases; the strand is that of mate 1. Copies of
    one shape become one row before any CIGAR is expanded and before anything is joined, so a pile-up costs one row per
    run and shape. Rows of ``collapse`` (for single reads) and of ``pair_rows`` (for pairs) are taken too.
    """
    if paired:
        pairs = alignments if "n_ends" in alignments.columns else pair_rows(alignments)
        shapes = pairs.where((F.col("n_first") == 1) & (F.col("n_second") == 1) & (F.col("ref") == F.col("ref2"))
                             & (F.col("to") - F.col("from") + 1).between(min_size, max_size))
        return shapes.groupBy(*SHAPE).agg(F.count(F.lit(1)).alias("n"))
    if is_collapsed(alignments):
        shapes = alignments.withColumn("reverse", F.col("reverse") != F.col("second"))
        return shapes.groupBy(*shape_key(shapes)).agg(F.sum("n").alias("n"))
    shapes = alignments.where(primary() & ~has(UNMAPPED)).select(
        "srr", "ref", (has(REVERSE) != (has(PAIRED) & has(SECOND))).alias("reverse"), "pos", "cigar")
    return shapes.groupBy(*shape_key(shapes)).agg(F.count(F.lit(1)).alias("n"))


def parsed_cigars(rows: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """cigar, ``parts`` (its aligned blocks, counted from 0) and ``aligned`` (their length) of all CIGARs of some rows, each
    parsed once. Many rows share few CIGARs, so the table is broadcast where it is counted as small."""
    cigar = F.col("cigar")
    found = written(rows.select("cigar").where(cigar.isNotNull()).distinct().select(
        "cigar", C.blocks(F.lit(0).cast("bigint"), cigar).alias("parts"), C.aligned_length(cigar).alias("aligned")), "cigars")
    return F.broadcast(found) if found.count() <= max_rows else found


def placed_blocks(rows: DataFrame, cigars: DataFrame, *columns: str) -> DataFrame:
    """The given columns with start and end of every aligned block, from a table of parsed CIGARs that holds all of ``rows``."""
    parts, at = F.col("parts"), rows.join(cigars.select("cigar", "parts"), "cigar")
    if "cigar2" in rows.columns:
        shift = (F.col("pos2") - F.col("pos")).cast("bigint")
        moved = F.transform("parts2", lambda b: F.struct((b["start"] + shift).alias("start"), (b["end"] + shift).alias("end")))
        at = at.join(cigars.select(F.col("cigar").alias("cigar2"), F.col("parts").alias("parts2")), "cigar2", "left")
        parts = F.when(F.col("cigar2").isNull(), parts).otherwise(F.concat(parts, moved))
    kept = list(dict.fromkeys(columns))
    pos = F.col("pos").cast("bigint")
    blocks = at.select(*kept, pos.alias("_pos"), F.inline(parts))
    return blocks.select(*kept, (F.col("_pos") + F.col("start")).alias("start"), (F.col("_pos") + F.col("end")).alias("end"))


def block_rows(shapes: DataFrame, *carry: str, cigars: DataFrame | None = None) -> DataFrame:
    """One row per aligned block of a shape, both ends of a pair included; ``cigars`` takes ``parsed_cigars`` where they are
    at hand.

    The blocks are computed inside the generator: Spark would turn an array column into a "not empty" filter, push it
    below the aggregate and so parse every CIGAR of the input.
    """
    if cigars is not None:
        return placed_blocks(shapes, cigars, *shape_key(shapes), "n", *carry)
    blocks = C.blocks(F.col("pos"), F.col("cigar"))
    if "cigar2" in shapes.columns:
        blocks = F.concat(blocks, F.when(F.col("cigar2").isNotNull(), C.blocks(F.col("pos2"), F.col("cigar2")))
                          .otherwise(F.array().cast(C.INTERVALS)))
    return shapes.select(*shape_key(shapes), "n", *carry, F.inline(blocks))


# strands as numbers that sort as the texts do
PLUS, MINUS = 1, 3


def numbered_genes(exons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Exons as numbers (``gene_no``, ref, start, end, ``strand`` as ``PLUS`` or ``MINUS``) and the genes' names by number.

    Aggregates of numbers are hash aggregates; the least and greatest of texts would sort all overlaps.
    """
    genes = written(exons.where("gene_id IS NOT NULL").select("gene_id").distinct().withColumn(
        "gene_no", F.monotonically_increasing_id()), "genes")
    s = F.col("strand")
    strand = F.when(s < "+", 0).when(s == "+", PLUS).when(s < "-", 2).when(s == "-", MINUS).when(s > "-", 4)
    numbered = exons.join(genes, "gene_id", "left").select("gene_no", "ref", "start", "end", strand.alias("strand"))
    return written(numbered, "gene-exons"), genes


def gene_hits(shapes: DataFrame, exons: DataFrame, strand_mode: int | str = 0, width: int = BIN_WIDTH,
              max_rows: int = BROADCAST_ROWS, cigars: DataFrame | None = None) -> DataFrame:
    """Shapes that touch exactly one gene: ``(srr, gene_no, n)`` per shape, genes and strands as ``numbered_genes`` has
    them.

    ``strand_mode`` 1 wants the gene on the fragment's strand, 2 on the other one, 0 does not care; a column name
    takes the mode from each shape. The shapes arrive partitioned by their key and keep that through the broadcast
    join, so regrouping them needs no second shuffle.
    """
    by_column = isinstance(strand_mode, str)
    mode = F.col(strand_mode) if by_column else F.lit(strand_mode)
    blocks = block_rows(shapes, *([strand_mode] if by_column else []), cigars=cigars)
    pairs = overlap_join(blocks, exons, width=width, max_rows=max_rows)
    same = F.when(F.col("reverse"), MINUS).otherwise(PLUS) == F.col("s_strand")
    return (pairs.where((mode == 0) | ((mode == 1) & same) | ((mode == 2) & ~same))
            .groupBy(*shape_key(shapes)).agg(F.min("s_gene_no").alias("gene_no"), F.max("s_gene_no").alias("_other"),
                                 F.max("n").alias("n"))
            .where(F.col("gene_no") == F.col("_other")).select("srr", "gene_no", "n"))


def _hit_counts(shapes: DataFrame, exons: DataFrame, strand_mode: int | str, width: int, max_rows: int,
                cigars: DataFrame | None = None) -> DataFrame:
    """Shapes per run and gene; names come back once the hits are counted."""
    numbered, genes = numbered_genes(exons)
    hits = gene_hits(shapes, numbered, strand_mode, width, max_rows, cigars)
    return (hits.groupBy("srr", "gene_no").agg(F.sum("n").alias("count")).join(genes, "gene_no")
            .select("srr", "gene_id", "count"))


def gene_counts(alignments: DataFrame, exons: DataFrame, paired: bool = False, strand_mode: int = 0,
                width: int = BIN_WIDTH, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Reads (or pairs) per run and gene, for genes that have any; see ``gene_count_summary`` for the zeros."""
    return _hit_counts(fragments(alignments, paired), exons, strand_mode, width, max_rows)


def gene_counts_by_mode(alignments: DataFrame, exons: DataFrame, modes: DataFrame, width: int = BIN_WIDTH,
                        max_rows: int = BROADCAST_ROWS, pairs: DataFrame | None = None,
                        cigars: DataFrame | None = None) -> DataFrame:
    """Gene counts of a whole cohort, each run counted in its own mode (``count_modes``).

    Single reads and pairs are collapsed separately and then counted together; ``pairs`` takes ``pair_rows`` where they
    are at hand. The run table joins without a hint: AQE broadcasts it when it measures it as small and splits a dominant
    run otherwise.
    """
    def of(rows: DataFrame, paired: bool) -> DataFrame:
        return fragments(rows.join(modes.where(F.col("paired") == paired).select("srr"), "srr", "left_semi"), paired)

    shapes = of(alignments, False).unionByName(of(alignments if pairs is None else pairs, True), allowMissingColumns=True)
    return _hit_counts(shapes.join(modes.select("srr", "strand_mode"), "srr"), exons, "strand_mode", width, max_rows, cigars)


def gene_count_summary(counts: DataFrame, runs: DataFrame, exons: DataFrame,
                       counted: DataFrame | None = None) -> DataFrame:
    """Per run: genic reads and the percent of all genes with any read. Genes without reads need no rows: they only
    add to the denominator, which is one number. With ``counted`` (the runs that could be counted), other runs get null
    instead of zero."""
    n_genes = exons.agg(F.count_distinct("gene_id").alias("v")).scalar()
    per_run = counts.groupBy("srr").agg(F.sum("count").alias("_sum"), F.count_if(F.col("count") > 0).alias("_on"))
    known = runs.select("srr").distinct().join(per_run, "srr", "left")
    zero = F.lit(0)
    if counted is not None:
        known = known.join(counted.select("srr", F.lit(True).alias("_counted")).distinct(), "srr", "left")
        zero = F.when(F.col("_counted"), 0)
    return known.select("srr", F.coalesce("_sum", zero).alias("number_genic_reads"),
                        (F.coalesce(F.col("_on"), zero) * 100 / n_genes).alias("percent_genes_on"))


def count_table_summary(counts: DataFrame) -> DataFrame:
    """Summary of count tables that list every gene, zeros included."""
    return counts.groupBy("srr").agg(
        F.sum("count").alias("number_genic_reads"),
        (F.count_if(F.col("count") > 0) * 100 / F.count(F.lit(1))).alias("percent_genes_on"))


def junction_counts(alignments: DataFrame) -> DataFrame:
    """Reads per run and intron (the gaps of the alignment). Equal alignments are collapsed before their gaps are
    expanded; rows of ``collapse`` are taken as they are."""
    shapes = alignments.where(F.col("cigar").contains("N"))
    if not is_collapsed(alignments):
        shapes = shapes.where(primary() & ~has(UNMAPPED)).groupBy("srr", "ref", "pos", "cigar").agg(
            F.count(F.lit(1)).alias("n"))
    gaps = shapes.select("srr", "ref", F.explode(C.junctions(F.col("pos"), F.col("cigar"))).alias("_j"), "n")
    return (gaps.groupBy("srr", "ref", F.col("_j.start").alias("start"), F.col("_j.end").alias("end"))
            .agg(F.sum("n").alias("count")))


def junction_summary(counts: DataFrame) -> DataFrame:
    """Sum of junction counts and the number of rows, zeros included."""
    return counts.groupBy("srr").agg(F.sum("count").alias("number_junction_reads"),
                                     F.count(F.lit(1)).alias("number_junctions_on"))
