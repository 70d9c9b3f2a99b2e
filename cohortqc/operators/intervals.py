"""Overlap join on hierarchical bins.

A range predicate alone makes Spark compare every pair of rows. Five levels of bins, each sixteen times as wide as the
one below and the last as wide as any axis, turn it into an equality on (ref, level, bin) plus a cheap test. A row of the
annotation lives on the level whose bins are just wide enough for it, so it touches one bin or two, whether it is an exon
or an intron of a million bases. A block asks for its bins on every level that the annotation uses. Each overlapping pair
is produced once, in the one bin that holds the larger start, so no distinct is needed.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortqc.session import BROADCAST_ROWS

BIN_WIDTH = 1_000
LEVELS, FACTOR = 5, 16


def level_widths(width: int = BIN_WIDTH) -> list[int]:
    """Bin widths of the levels; one bin of the last holds any axis."""
    return [width * FACTOR ** level for level in range(LEVELS - 1)] + [2 ** 62]


def bin_range(start: Column, end: Column, width: int) -> Column:
    return F.sequence(F.floor(start / width), F.floor(end / width))


def row_level(start: Column, end: Column, width: int = BIN_WIDTH) -> Column:
    """The lowest level whose bins are at least as wide as the row is long."""
    level = F.lit(LEVELS - 1)
    for number, w in reversed(list(enumerate(level_widths(width)[:-1]))):
        level = F.when(end - start < w, number).otherwise(level)
    return level


def _at_level(level: Column, width: int, value) -> Column:
    """``value(bin width)`` of the row's level."""
    chosen = value(level_widths(width)[-1])
    for number, w in reversed(list(enumerate(level_widths(width)[:-1]))):
        chosen = F.when(level == number, value(w)).otherwise(chosen)
    return chosen


def level_rows(rows: DataFrame, width: int = BIN_WIDTH, start: str = "start", end: str = "end") -> dict[int, int]:
    """How many binned rows each level will hold, for the levels in use: one aggregate, nothing is expanded."""
    s, e = F.col(start), F.col(end)
    level = row_level(s, e, width)
    bins = _at_level(level, width, lambda w: F.floor(e / w) - F.floor(s / w) + 1)
    found = rows.select(level.alias("level"), bins.alias("n")).groupBy("level").agg(F.sum("n").alias("n")).collect()
    return {r["level"]: r["n"] for r in found}


def in_bins(rows: DataFrame, width: int = BIN_WIDTH, start: str = "start", end: str = "end") -> DataFrame:
    """Add ``_level`` and ``_bin``: a row for the one or two bins of its level that it touches."""
    s, e = F.col(start), F.col(end)
    leveled = rows.withColumn("_level", row_level(s, e, width))
    return leveled.withColumn("_bin", F.explode(_at_level(F.col("_level"), width, lambda w: bin_range(s, e, w))))


def probes(rows: DataFrame, levels: list[int], width: int = BIN_WIDTH) -> DataFrame:
    """Add ``_level`` and ``_bin``: a row for each bin of the given levels that [start, end] touches. The bins of all levels
    are numbered through, so one plain sequence is exploded and no array of structs is built for a row."""
    first = {level: F.floor(F.col("start") / level_widths(width)[level]) for level in levels}
    upto, total = {}, F.lit(0).cast("bigint")
    for level in levels:
        upto[level] = total
        total = total + F.floor(F.col("end") / level_widths(width)[level]) - first[level] + 1
    numbered = rows.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), total - 1)).alias("_k"))
    level, at = F.lit(levels[0]), first[levels[0]] + F.col("_k")
    for higher in levels[1:]:
        level = F.when(F.col("_k") >= upto[higher], higher).otherwise(level)
        at = F.when(F.col("_k") >= upto[higher], first[higher] + F.col("_k") - upto[higher]).otherwise(at)
    return numbered.select(*[F.col(f"`{c}`") for c in rows.columns], level.alias("_level"), at.alias("_bin"))


def equi_join(big: DataFrame, small: DataFrame, on: list[str], small_rows: int, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Inner join of many rows with fewer.

    If ``small`` is known to be small (``small_rows`` was counted) it is broadcast and ``big`` does not move. Otherwise
    both sides are shuffled once, no row is repeated, and hash tables of ``small`` spare the sort of both sides; a hot
    key of ``big`` is split by AQE. The hint also keeps Spark from broadcasting on its own: it estimates exploded rows by
    the size of the file they come from.
    """
    return big.join(F.broadcast(small) if small_rows <= max_rows else small.hint("shuffle_hash"), on)


def overlap_join(big: DataFrame, small: DataFrame, width: int = BIN_WIDTH, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """All pairs of rows with equal ``ref`` whose inclusive [start, end] share a base.

    ``big`` keeps its names; the columns of ``small`` come out with the prefix ``s_``. ``small`` is read twice: to count
    its rows by level and to join.
    """
    right = small.select(*[F.col(c).alias(c if c == "ref" else f"s_{c}") for c in small.columns])
    rows = level_rows(right, width, "s_start", "s_end")
    left = probes(big, sorted(rows) or [0], width)
    pairs = equi_join(left, in_bins(right, width, "s_start", "s_end"), ["ref", "_level", "_bin"], sum(rows.values()),
                      max_rows)
    home = _at_level(F.col("_level"), width, lambda w: F.floor(F.greatest("start", "s_start") / w))
    return (pairs.where((F.col("start") <= F.col("s_end")) & (F.col("s_start") <= F.col("end")) & (F.col("_bin") == home))
            .drop("_level", "_bin"))


def clip_to_bins(rows: DataFrame, width: int) -> DataFrame:
    """Cut [start, end] at bin borders: one row per bin, with the part that lies inside."""
    cut = rows.withColumn("bin", F.explode(bin_range(F.col("start"), F.col("end"), width)))
    return cut.withColumns({"start": F.greatest(F.col("start"), F.col("bin") * width),
                            "end": F.least(F.col("end"), (F.col("bin") + 1) * width - 1)})
