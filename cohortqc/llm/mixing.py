"""Mixing sources to target weights by Pfair scheduling, with DataFrame functions only.

Targets are whole shares: of every cycle of L blocks a source gets q. Its k-th block may not start before
floor((k - 1) L / q) and must be done by ceil(k L / q); earliest deadline first over the released blocks keeps every
source less than one block off its target at every slot. After L slots all sources are exactly on target, so one cycle
is scheduled (L is a parameter, a few more than ``RESOLUTION``, and one slot needs a few steps per source) and every
block of any corpus finds its slot by arithmetic: cycle times L, plus the slot of its turn within the cycle.

Blocks are counted without ranking a source in one task: rows fall into ranges of a hash, ranges are counted, running
sums give each range its first rank, and only rows within a range are ranked.

All rows are kept. A source that runs out leaves its later slots empty, the rest keep theirs; ``on_target`` tells up to
where every source still has blocks. Within a source, order is by md5 of the id, then id.

Defined results: a null source is a source of its own; a null id counts as empty text in the hash; rows with equal ids
take neighbouring ranks in any order. An empty table gives an empty result. Texts are not read.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortqc.llm.common import parts, written

RESOLUTION = 1000
BLOCK_DOCS = 16
ROWS_PER_RANGE = 10_000


def _key():
    """Sources as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-"))


def root_targets(docs: DataFrame) -> DataFrame:
    """mix_source, weight: the square root of a source's rows, which lifts small sources and holds back large ones."""
    return docs.groupBy(_key().alias("mix_source")).agg(F.sqrt(F.count("*")).alias("weight"))


def given_targets(spark: SparkSession, weights: dict[str | None, float]) -> DataFrame:
    """The same table from weights by source; each must be above zero."""
    if not weights or any(not w > 0 for w in weights.values()):
        raise ValueError("every source needs a weight above zero")
    rows = [("-" if s is None else f"={s}", float(w)) for s, w in weights.items()]
    return spark.createDataFrame(rows, "mix_source string, weight double")


def shares(targets: DataFrame) -> DataFrame:
    """mix_source, q, cycle: whole shares of a cycle, at least one each."""
    total = targets.agg(F.sum("weight").alias("total")).scalar()
    q = targets.select("mix_source", F.greatest(
        F.lit(1), F.round(F.col("weight") / total * RESOLUTION)).cast("int").alias("q"))
    return q.select("mix_source", "q", q.agg(F.sum("q").cast("int").alias("cycle")).scalar().alias("cycle"))


def cycle_slots(shares_: DataFrame) -> DataFrame:
    """mix_source, turn, turn_slot: which slot of a cycle each block of a source takes, by earliest deadline first."""
    row = shares_.groupBy("cycle").agg(F.sort_array(F.collect_list(F.struct("mix_source", "q"))).alias("all"))
    q = lambda i: F.get(F.col("all"), i)["q"]
    cycle = F.col("cycle")

    def slot(state, t):
        done = state["done"]
        waiting = F.filter(
            F.transform(done, lambda n, i: F.struct(
                F.ceil((n + 1) * cycle / q(i)).alias("deadline"), i.alias("i"),
                ((n < q(i)) & (F.floor(n * cycle / q(i)) <= t - 1)).alias("released"))),
            lambda x: x["released"])
        first = F.array_min(waiting)["i"]
        return F.struct(F.transform(done, lambda n, i: n + (i == first).cast("int")).alias("done"),
                        F.array_append(state["picked"], first).alias("picked"))

    start = F.struct(F.transform("all", lambda x: F.lit(0)).alias("done"), F.array().cast("array<int>").alias("picked"))
    picked = row.select("all", F.aggregate(F.sequence(F.lit(1), cycle), start, slot)["picked"].alias("picked"))
    slots = picked.select("all", F.posexplode("picked")).select(
        F.get("all", F.col("col"))["mix_source"].alias("mix_source"), F.col("pos").cast("bigint").alias("turn_slot"))
    turn = F.row_number().over(Window.partitionBy("mix_source").orderBy("turn_slot")) - 1
    return slots.select("mix_source", turn.cast("bigint").alias("turn"), "turn_slot")


def mixed(spark: SparkSession, docs: DataFrame, targets: DataFrame, carry: list | None = None) -> DataFrame:
    """doc_id, source, source_rank, block, release, deadline, slot, place, on_target and the columns of ``carry``: one
    row for each row of ``docs``; a source without a target gets null slots."""
    ranges = parts(spark, docs.count(), ROWS_PER_RANGE)
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    keyed = docs.select("doc_id", "source", *(carry or []), _key().alias("mix_source"), order.alias("mix_order"))
    at = F.conv(F.substring("mix_order", 1, 8), 16, 10).cast("bigint") * ranges / (1 << 32)
    keyed = keyed.withColumn("mix_range", F.floor(at))
    counts = keyed.groupBy("mix_source", "mix_range").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("mix_source").orderBy("mix_range")) - F.col("n")
    first = written(spark, counts.select("mix_source", "mix_range", before.alias("first_rank"), "n"), "mix-ranges")

    plan = written(spark, shares(targets), "mix-shares")
    slots = written(spark, cycle_slots(plan), "mix-slots")
    ends = first.groupBy("mix_source").agg(F.sum("n").alias("rows"))
    last = ends.join(plan, "mix_source").withColumn("k", F.floor((F.col("rows") - 1) / BLOCK_DOCS))
    last = last.select("mix_source", "cycle", F.floor(F.col("k") / F.col("q")).alias("lap"),
                       (F.col("k") % F.col("q")).alias("turn"))
    horizon = last.join(slots, ["mix_source", "turn"]).agg(
        F.min(F.col("lap") * F.col("cycle") + F.col("turn_slot")).alias("horizon")).scalar()

    rank = F.row_number().over(Window.partitionBy("mix_source", "mix_range").orderBy("mix_order", "doc_id"))
    ranked = keyed.join(first.drop("n"), ["mix_source", "mix_range"]).withColumn(
        "source_rank", F.col("first_rank") + rank - 1)
    k = F.floor(F.col("source_rank") / BLOCK_DOCS)
    placed = (ranked.withColumn("block", k).join(plan, "mix_source", "left")
              .withColumn("turn", F.col("block") % F.col("q")).join(slots, ["mix_source", "turn"], "left"))
    slot = F.floor(F.col("block") / F.col("q")) * F.col("cycle") + F.col("turn_slot")
    return placed.select(
        "doc_id", "source", *([c for c in ("mix_doc",) if c in placed.columns]), "source_rank", "block",
        F.floor(F.col("block") * F.col("cycle") / F.col("q")).alias("release"),
        F.ceil((F.col("block") + 1) * F.col("cycle") / F.col("q")).alias("deadline"), slot.alias("slot"),
        (F.col("source_rank") % BLOCK_DOCS).alias("place"), (slot <= horizon).alias("on_target"))


def mix_rows(spark: SparkSession, docs: DataFrame, targets: DataFrame) -> DataFrame:
    """The rows of ``docs`` in mixed order, all columns unchanged; rows of sources without a target come last."""
    packed = docs.select("doc_id", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("mix_doc"))
    rows = mixed(spark, packed, targets, ["mix_doc"])
    return rows.orderBy(F.col("slot").asc_nulls_last(), "place").select("mix_doc.*")
