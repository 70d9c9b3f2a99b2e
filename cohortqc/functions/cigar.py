"""Expressions over a CIGAR string: aligned blocks, junctions, reference span, unclipped 5' end."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OP = r"(\d+)([MIDNSHP=X])"
INTERVALS = "array<struct<start:bigint,end:bigint>>"


def _ops(cigar: Column) -> Column:
    """``[(n, op), …]`` of a CIGAR string."""
    lengths = F.regexp_extract_all(cigar, F.lit(_OP), F.lit(1))
    codes = F.regexp_extract_all(cigar, F.lit(_OP), F.lit(2))
    return F.zip_with(lengths, codes, lambda n, op: F.struct(n.cast("bigint").alias("n"), op.alias("op")))


def _walk(pos: Column, cigar: Column, wanted: tuple[str, ...]) -> Column:
    """Reference intervals (1-based, inclusive) of the operations in ``wanted``."""
    def step(acc, o):
        end = acc["at"] + o["n"] - 1
        moved = F.when(o["op"].isin("M", "D", "N", "=", "X"), acc["at"] + o["n"]).otherwise(acc["at"])
        interval = F.array(F.struct(acc["at"].alias("start"), end.alias("end")))
        found = F.when(o["op"].isin(*wanted), F.concat(acc["found"], interval)).otherwise(acc["found"])
        return F.struct(moved.alias("at"), found.alias("found"))

    start = F.struct(pos.cast("bigint").alias("at"), F.array().cast(INTERVALS).alias("found"))
    return F.aggregate(_ops(cigar), start, step, lambda acc: acc["found"])


def _matched(cigar: Column) -> Column:
    """Length of an alignment that is one match, null for any other."""
    return F.when(cigar.rlike(r"^\d+M$"), F.substring(cigar, F.lit(1), F.length(cigar) - 1).try_cast("bigint"))


def blocks(pos: Column, cigar: Column) -> Column:
    """Aligned blocks: runs of M, = or X. Deletions, introns and clips are not aligned bases."""
    n = _matched(cigar)
    whole = F.array(F.struct(pos.cast("bigint").alias("start"), (pos + n - 1).cast("bigint").alias("end")))
    return F.when(n.isNotNull(), whole).otherwise(_walk(pos, cigar, ("M", "=", "X")))


def junctions(pos: Column, cigar: Column) -> Column:
    """Introns: the reference intervals skipped by N."""
    return (F.when(cigar.contains("N"), _walk(pos, cigar, ("N",)))
            .otherwise(F.array().cast(INTERVALS)))


def _total(cigar: Column, codes: str) -> Column:
    parts = F.regexp_extract_all(cigar, F.lit(rf"(\d+)[{codes}]"), F.lit(1))
    return F.coalesce(_matched(cigar), F.aggregate(parts, F.lit(0).cast("bigint"), lambda acc, n: acc + n.cast("bigint")))


def reference_length(cigar: Column) -> Column:
    """Reference bases spanned, introns and deletions included."""
    return _total(cigar, "MDN=X")


def aligned_length(cigar: Column) -> Column:
    """Bases aligned to the reference: the summed length of the blocks."""
    return _total(cigar, "M=X")


def _clip(cigar: Column, pattern: str) -> Column:
    run = F.regexp_extract(cigar, pattern, 1)
    total = F.aggregate(F.regexp_extract_all(run, F.lit(r"(\d+)"), F.lit(1)),
                        F.lit(0).cast("bigint"), lambda acc, n: acc + n.cast("bigint"))
    return F.when(cigar.contains("S") | cigar.contains("H"), total).otherwise(0)


def unclipped_five_prime(pos: Column, cigar: Column, reverse: Column) -> Column:
    """Where the read's 5' end would align had nothing been clipped."""
    left = pos - _clip(cigar, r"^((?:\d+[SH])+)")
    right = pos + reference_length(cigar) - 1 + _clip(cigar, r"((?:\d+[SH])+)$")
    return F.when(reverse, right).otherwise(left).cast("bigint")
