"""What must not grow faster than the input: shuffles, sorts, broadcasts and arrays of the steps that larger tables broke."""
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cohortqc import schemas, sinks
from cohortqc.functions import quality
from cohortqc.operators import alignments as A
from cohortqc.operators import coverage as V
from cohortqc.operators import intervals as I
from cohortqc.workload import views


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def reads(spark):
    return spark.createDataFrame(
        [("r", f"q{i}", 16 * (i % 2), "c", 100 + i % 50, 60, "30M", "*", 0, 0, "*", "I" * 30, None) for i in range(60)],
        schemas.ALIGNMENTS)


def test_blocks_of_parsed_cigars_are_those_of_every_row(spark):
    """The job parses each CIGAR once; no row's pattern is matched again, and pairs keep the blocks of both ends."""
    cigars = ["50M", "5S45M", "20M300N30M", "25M2I10M3D13M", "10M120N20M200N20M", "3=2X", "10S", "*", "", "7M2P3M", None]
    rows = spark.createDataFrame([(f"r{i % 3}", "c", False, 10 * i, a, 10 * i + 7 * j, b, 1 + j) for i, a in enumerate(cigars)
                                  for j, b in enumerate(cigars)], "srr string, ref string, reverse boolean, pos long, cigar string, "
                                 "pos2 long, cigar2 string, n long")
    lone, parsed = rows.drop("pos2", "cigar2"), A.parsed_cigars(rows)
    assert parsed.count() == len(cigars) - 1
    for shapes in (rows, lone):
        found = A.block_rows(shapes, cigars=parsed)
        assert "regexp" not in plan(found)
        assert sorted(map(str, found.collect())) == sorted(map(str, A.block_rows(shapes).collect()))
    assert sorted(map(str, V.aligned_blocks(lone, parsed).collect())) == sorted(map(str, V.aligned_blocks(lone).collect()))
    assert sorted(map(str, A.block_rows(rows, cigars=A.parsed_cigars(rows, max_rows=0)).collect())) == sorted(
        map(str, A.block_rows(rows).collect()))


def test_probes_number_bins_through_all_levels(spark):
    rows = spark.createDataFrame([("c", 5, 9), ("c", 90, 450), ("c", 399, 400), ("c", 0, 5000)], "ref string, start long, end long")
    found = I.probes(rows, [0, 1, 4], 25)
    assert "transform" not in plan(found)
    got = sorted((r.start, r["_level"], r["_bin"]) for r in found.collect())
    assert got == sorted((a, level, b) for a, e in ((5, 9), (90, 450), (399, 400), (0, 5000)) for level in (0, 1, 4)
                         for b in range(a // I.level_widths(25)[level], e // I.level_widths(25)[level] + 1))


def test_large_annotation_is_neither_repeated_nor_broadcast(spark):
    big = spark.createDataFrame([("c", 5, 9)], "ref string, start long, end long")
    small = spark.createDataFrame([(["c"], 1, 6, "x")], "refs array<string>, start long, end long, k string").select(
        F.explode("refs").alias("ref"), "start", "end", "k")
    joined = I.overlap_join(big, small, max_rows=0)
    text = plan(joined)
    assert "ShuffledHashJoin" in text and "BroadcastHashJoin" not in text and "_salt" not in text
    assert [r.s_k for r in joined.collect()] == ["x"]


def test_gene_counts_sort_no_overlaps(spark):
    exons = spark.createDataFrame([("g1", "t", "c", 90, 125, "+"), ("g2", "t", "c", 140, 200, "-"), (None, "t", "c", 90, 95, "."),
                                   ("g1", "t", "c", 126, 130, None)], schemas.EXONS)
    for found in (A.gene_counts(reads(spark), exons), V.strand_agreement(reads(spark), exons)):
        assert "SortAggregate" not in plan(found) and found.count()


def test_strands_as_numbers_sort_as_texts_do(spark):
    strands = ["!", "+", "+x", ",", "-", ".", "?", None]
    exons = spark.createDataFrame([("g", "t", "c", i, i, s) for i, s in enumerate(strands)], schemas.EXONS)
    numbered, genes = A.numbered_genes(exons)
    assert genes.count() == 1
    assert [r.strand for r in numbered.orderBy("start").collect()] == [0, A.PLUS, 2, 2, A.MINUS, 4, 4, None]


def test_depth_is_dealt_once(spark):
    transcripts = spark.createDataFrame([("g", "t", "c", "+", 1, 400, 1, 400, [1], [400])], schemas.TRANSCRIPTS)
    found = V.depth_stretches(reads(spark), transcripts)
    assert plan(found).count("Exchange hashpartitioning(srr#") == 2  # equal alignments, then transcripts
    assert found.agg(F.sum(F.col("depth") * (F.col("b") - F.col("a") + 1))).first()[0] == 60 * 30


def test_stored_views_are_dealt_without_a_sort(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(views, "written", lambda df, name: taken.append(df) or df)
    rows = spark.range(1000).select(F.col("id"), F.array("id").alias("ids"), F.lit(None).cast("string").alias("none"))
    assert views._written(spark, "x", rows).count() == 1000
    assert "RoundRobin" not in plan(taken[0]) and "Sort" not in plan(taken[0])
    assert taken[0].select(F.spark_partition_id()).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    views.stored(spark, "/none", "y", lambda: rows, dealt=False)
    assert "Exchange" not in plan(taken[1])


def test_sorted_files_grow_with_the_table():
    assert [sinks.sorted_files(n) for n in (0, 600_000, 12_000_001, 216_000_000)] == [12, 12, 13, 216]


def test_a_large_batch_of_qualities_takes_bounded_memory():
    rng = np.random.default_rng(3)
    strings = [bytes(rng.integers(33, 74, 1500, np.uint8)).decode() for _ in range(4000)] + [None, ""]
    batch = pa.array(strings)
    tracemalloc.start()
    kept, added = quality.kept_lengths(batch, 20), quality.sums(batch, 15)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20
    for i in (0, 1777, 3999, 4000, 4001):
        assert kept[i] == quality.kept_lengths(batch.slice(i, 1), 20)[0] and added[i] == quality.sums(batch.slice(i, 1), 15)[0]
    assert quality.sums(batch.slice(0, 0)).to_pylist() == []
