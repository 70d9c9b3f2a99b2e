"""Read filtering, mate pairing, layout and library statistics, trimming, screening subset."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortqc.functions import reads as R
from cohortqc.functions.quality import quality_cut

MIN_LIBRARY = 100_000
EMPTY_BYTES = 1_000
MIN_TRIMMED = 1_000


def decoded(reads: DataFrame) -> DataFrame:
    """The four text columns of a read as clean ASCII."""
    return reads.withColumns({c: R.decode(F.col(c)) for c in ("h1", "seq", "h2", "qual")})


def read_validity(reads: DataFrame, strict_header: bool = False) -> DataFrame:
    """Add ``reject_reason`` to single reads; null marks a good read."""
    return reads.withColumn(
        "reject_reason", R.reject_reason(F.col("h1"), F.col("seq"), F.col("qual"), strict_header))


def valid_reads(reads: DataFrame, strict_header: bool = False) -> DataFrame:
    return read_validity(reads, strict_header).where("reject_reason IS NULL").drop("reject_reason")


def pair_mates(reads: DataFrame, how: str = "full") -> DataFrame:
    """Mates 1 and 2 side by side, matched by position; a missing side is null.

    The key holds the read number, so the shuffle is even however large one run is.
    """
    def side(mate: int) -> DataFrame:
        return (reads.where(F.col("mate") == mate)
                .select("srr", "read_no", F.struct("h1", "seq", "h2", "qual").alias(f"r{mate}")))

    return side(1).join(side(2), ["srr", "read_no"], how)


def pair_verdicts(reads: DataFrame, strict_header: bool = False) -> DataFrame:
    """Per position: which mates exist, the verdict on each and on the pair, lengths and the colour-space test.

    Each read is judged where it lies; only verdict, length and header are shuffled to meet the mate, no sequence and
    no quality string. One scan and one exchange bring both mates together. A read number that a mate holds twice is an
    error: pairs would multiply.
    """
    judged = read_validity(reads, strict_header).select(
        "srr", "read_no", "mate", F.struct("h1", F.length("seq").alias("len"), R.is_abi(F.col("seq")).alias("abi"),
                                           F.col("reject_reason").alias("reason")).alias("r"))

    met = judged.groupBy("srr", "read_no").agg(
        *[F.max(F.when(F.col("mate") == m, F.col("r"))).alias(f"r{m}") for m in (1, 2)],
        *[F.count_if(F.col("mate") == m).alias(f"_n{m}") for m in (1, 2)])
    twice = F.raise_error(F.concat(F.lit("read number held twice in run "), "srr"))
    met = met.select("srr", "read_no", *[F.when(F.col(f"_n{m}") <= 1, F.col(f"r{m}")).otherwise(twice).alias(f"r{m}")
                                         for m in (1, 2)])
    both = F.col("r1").isNotNull() & F.col("r2").isNotNull()
    pair = R.pair_reject_reason(F.col("r1.reason"), F.col("r2.reason"), F.col("r1.h1"), F.col("r2.h1"))
    return met.select("srr", "read_no", "r1", "r2", both.alias("complete"), F.when(both, pair).alias("reject_reason"))


def pair_validity(reads: DataFrame, strict_header: bool = False) -> DataFrame:
    """``reject_reason`` of every complete pair, null for good ones. Pairs with a missing side belong to the layout
    call, not here."""
    return pair_verdicts(reads, strict_header).where("complete").select("srr", "read_no", "reject_reason")


def valid_pairs(reads: DataFrame, strict_header: bool = False) -> DataFrame:
    """Good pairs side by side."""
    # mates are judged before they meet, so a bad one is not shuffled at all
    good = pair_mates(valid_reads(reads, strict_header), "inner")
    return good.where(~R.is_different_header(F.col("r1.h1"), F.col("r2.h1")))


def abi_runs(reads: DataFrame) -> DataFrame:
    """Per run: does the first read of either mate look like colour space?

    Reads are numbered from zero, so the filter reaches the scan and one row per file is left; runs come from their
    keys alone.
    """
    runs = reads.select("srr").distinct()
    first = reads.where("read_no = 0").groupBy("srr").agg(
        F.bool_or(F.coalesce(R.is_abi(F.col("seq")), F.lit(False))).alias("is_abi"))
    return runs.join(first, "srr", "left").select("srr", F.coalesce("is_abi", F.lit(False)).alias("is_abi"))


def layout_call(n1: Column, n2: Column, n_mixed: Column, paired: Column, size1: Column, size2: Column) -> Column:
    """SE, PE, keep_R1 or keep_R2 of a run.

    Mixed-up mates are noticed before the shorter file ends, so they decide first and keep the file that is not
    smaller; otherwise the longer mate is kept.
    """
    return (F.when(~paired, "SE")
            .when(n_mixed > 0, F.when(size1 < size2, "keep_R2").otherwise("keep_R1"))
            .when(n1 < n2, "keep_R2")
            .when(n1 > n2, "keep_R1")
            .otherwise("PE"))


def library_stats(reads: DataFrame, files: DataFrame, min_library: int = MIN_LIBRARY,
                  empty_bytes: int = EMPTY_BYTES, strict_header: bool = False) -> DataFrame:
    """One row per run: layout, library size, mean read lengths, rejects by reason and acceptance status.

    ``files`` holds ``(srr, paired, size1, size2)``, the roles and sizes found by ``sources.fastq.file_roles``; a run
    without files has no row. The counters of all three ways to read a run (as pairs, as mate 1, as mate 2) come out of
    one pass; the layout then picks its own.
    """
    verdict = pair_verdicts(reads, strict_header).select(
        "srr", "read_no", "r1", "r2",
        F.when(F.col("r1").isNotNull(), F.coalesce("r1.reason", F.lit("ok"))).alias("v1"),
        F.when(F.col("r2").isNotNull(), F.coalesce("r2.reason", F.lit("ok"))).alias("v2"),
        F.when(F.col("complete"), F.coalesce("reject_reason", F.lit("ok"))).alias("vp"))
    aggs = [F.count("v1").alias("n1"), F.count("v2").alias("n2"), F.count_if(F.col("vp") == R.MIXED).alias("n_mixed"),
            F.min_by("r1.abi", F.when(F.col("v1").isNotNull(), F.col("read_no"))).alias("abi1"),
            F.min_by("r2.abi", F.when(F.col("v2").isNotNull(), F.col("read_no"))).alias("abi2")]
    for v in ("v1", "v2", "vp"):
        aggs += [F.count_if(F.col(v) == what).alias(f"{v}_{name}") for what, name in (
            ("ok", "ok"), (R.INCOMPLETE, "incomplete"), (R.BAD_ENCODING, "bad"), (R.UNEQUAL, "unequal"))]
    for v, r in (("v1", "r1"), ("v2", "r2"), ("vp", "r1"), ("vp", "r2")):
        aggs.append(F.sum(F.when(F.col(v) == "ok", F.col(r)["len"])).alias(f"{v}_{r}_len"))
    counted = verdict.groupBy("srr").agg(*aggs)

    # a run with files but no reads at all still gets its row
    runs = files.join(counted, "srr", "left").na.fill(0, [c for c in counted.columns if c != "srr" and "abi" not in c])
    runs = runs.withColumn("layout", layout_call(
        F.col("n1"), F.col("n2"), F.col("n_mixed"), F.col("paired"), F.col("size1"), F.col("size2")))

    def chosen(suffix: str) -> Column:
        return (F.when(F.col("layout") == "PE", F.col(f"vp_{suffix}"))
                .when(F.col("layout") == "keep_R2", F.col(f"v2_{suffix}"))
                .otherwise(F.col(f"v1_{suffix}")))

    libsize = chosen("ok")
    first_len = (F.when(F.col("layout") == "PE", F.col("vp_r1_len"))
                 .when(F.col("layout") == "keep_R2", F.col("v2_r2_len")).otherwise(F.col("v1_r1_len")))
    empty_run = (F.coalesce("size1", F.lit(0)) <= empty_bytes) & (F.coalesce("size2", F.lit(0)) <= empty_bytes)
    status = (F.when(F.coalesce("abi1", F.lit(False)) | F.coalesce("abi2", F.lit(False)), "abi_solid")
              .when(empty_run, "download_bad")
              .when(libsize < min_library, "too_few_reads")
              .otherwise("ok"))
    return runs.select(
        "srr", "layout", libsize.alias("libsize"),
        F.try_divide(first_len, libsize).alias("avgLen_R1"),
        F.when(F.col("layout") == "PE", F.try_divide(F.col("vp_r2_len"), libsize)).otherwise(0.0).alias("avgLen_R2"),
        chosen("incomplete").alias("n_incomplete"), chosen("bad").alias("n_bad_encoding"),
        chosen("unequal").alias("n_unequal_length"), status.alias("status"))


def clean_reads(reads: DataFrame, layout: DataFrame, strict_header: bool = False) -> DataFrame:
    """The reads that survive: whole good pairs of PE runs, good reads of the kept mate of every other run.

    ``layout`` has one row per run. Only accepted runs pass. The joins carry no hint: the run table is broadcast when
    AQE measures it as small, and a run that dominates is split by AQE otherwise.
    """
    accepted = layout.where("status = 'ok'").select("srr", "layout")
    single = (valid_reads(reads, strict_header).join(accepted.where("layout <> 'PE'"), "srr")
              .where(F.when(F.col("layout") == "keep_R2", F.col("mate") == 2).otherwise(F.col("mate") == 1))
              .select("srr", "mate", "read_no", "h1", "seq", "h2", "qual"))
    pe = reads.join(accepted.where("layout = 'PE'").select("srr"), "srr", "left_semi")
    mates = F.array(*[F.struct(F.lit(m).alias("mate"), f"r{m}.h1", f"r{m}.seq", f"r{m}.h2", f"r{m}.qual")
                      for m in (1, 2)])
    paired = (valid_pairs(pe, strict_header)
              .select("srr", "read_no", F.inline(mates))
              .select("srr", "mate", "read_no", "h1", "seq", "h2", "qual"))
    return single.unionByName(paired)


def quality_trim(reads: DataFrame, cutoff: int = 20) -> DataFrame:
    """Cut the 3' end of every read at the quality cutoff."""
    kept = quality_cut(F.col("qual"), cutoff)
    return (reads.withColumn("_n", kept)
            .withColumns({"seq": F.substring(F.col("seq"), F.lit(1), F.col("_n").cast("int")),
                          "qual": F.substring(F.col("qual"), F.lit(1), F.col("_n").cast("int"))})
            .drop("_n"))


def long_enough(reads: DataFrame, min_length: int = 25) -> DataFrame:
    return reads.where(F.length("seq") >= min_length)


def trim_counts(reads: DataFrame, paired: bool = False, cutoff: int = 20, min_length: int = 25) -> DataFrame:
    """Per run: templates processed, written and dropped as too short after trimming.

    Only the kept length is computed, no trimmed string. Mates of a pair count once, and fall together.
    """
    short = (quality_cut(F.col("qual"), cutoff) < min_length).alias("short")
    marked = reads.select("srr", "read_no", short)
    if paired:
        marked = marked.groupBy("srr", "read_no").agg(F.bool_or("short").alias("short"))
    return marked.groupBy("srr").agg(
        F.count(F.lit(1)).alias("total_processed"),
        F.count_if(~F.col("short")).alias("total_written"),
        F.count_if(F.col("short")).alias("too_short"))


def trim_gate(counts: DataFrame, min_written: int = MIN_TRIMMED) -> DataFrame:
    return counts.withColumn("status", F.when(F.col("total_written") < min_written, "too_few_reads").otherwise("ok"))


def subset_reads(reads: DataFrame, n: int = 100_000, buckets: int = 4096) -> DataFrame:
    """At most ``n`` reads of every run, chosen by the hash of (run, read number): exact and repeatable.

    A window over all reads of a run would put a dominant run into one task. Instead the hashes of a run are counted
    in ``buckets`` ranges (map-side), the range holding the n-th read is found on at most ``buckets`` rows per run, and
    reads above it are dropped before any shuffle. The rest is ranked inside (run, range) groups, which are small and
    spread over all tasks; ranks matter only in the range of the n-th read.
    """
    digest = F.md5(F.concat_ws(":", F.col("srr"), F.col("read_no").cast("string")))
    width = (1 << 32) // buckets
    keyed = reads.withColumn("_h", digest).withColumn(
        "_b", F.floor(F.conv(F.substring("_h", 1, 8), 16, 10).cast("bigint") / width).cast("int"))
    running = W.partitionBy("srr").orderBy("_b").rowsBetween(W.unboundedPreceding, W.currentRow)
    cut = (keyed.groupBy("srr", "_b").agg(F.count(F.lit(1)).alias("_c"))
           .withColumn("_upto", F.sum("_c").over(running))
           .where((F.col("_upto") >= n) & (F.col("_upto") - F.col("_c") < n))
           .select("srr", F.col("_b").alias("_cut"), (n - (F.col("_upto") - F.col("_c"))).alias("_left")))
    near = keyed.join(cut, "srr", "left").where(F.col("_cut").isNull() | (F.col("_b") <= F.col("_cut")))
    rank = F.row_number().over(W.partitionBy("srr", "_b").orderBy("_h", "read_no"))
    passes = F.col("_cut").isNull() | (F.col("_b") < F.col("_cut")) | (F.col("_rn") <= F.col("_left"))
    return near.withColumn("_rn", rank).where(passes).select(*reads.columns)
