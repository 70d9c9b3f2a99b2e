"""Exact dedup: partitions send Golomb-coded sorted hashes to owners, get duplicate bitmaps back, and shuffle only
suspects for byte verification.

1. Each partition of the input takes the 64-bit fingerprints of its normalised texts (the head of their SHA-256),
   splits them by owner (equal ranges of the hash space), sorts each share and writes one row per owner: the distinct
   hashes as Golomb-Rice codes of their gaps, and, staying at home, ids and lengths of the rows behind each hash.
   A hash that a partition holds a million times is sent once.
2. An owner merges the code streams it receives and answers each with a bitmap: which of its hashes occur elsewhere.
3. Rows with a marked hash are suspects. Their texts are shuffled and grouped by the bytes themselves; the map side
   combines copies, so a text that a third of all rows hold arrives once per task. A fingerprint shared by two texts
   leaves two groups; a SHA-256 shared by two texts is an error, never a merged group.
4. Of each group the row with the most code points in the original text, then the smallest doc_id, stays.

Defined results: a null text is empty, and empty texts are copies of each other. Rows that repeat a doc_id with the
same text share one verdict (``kept`` marks the id; ``drop_copies`` keeps one of the rows). A null doc_id loses ties
against others and is compared as a value of its own. An empty table gives an empty result.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortqc.llm.common import SPACES, parts, whole, written

HASHES_PER_OWNER = 500_000

HOME = ("block long, owner int, n_hashes int, code binary, again binary, slots binary, doc_ids array<bigint>, "
        "n_cps array<int>, digests array<binary>")


def golomb_encode(values: np.ndarray) -> bytes:
    """Sorted distinct unsigned 64-bit values: the first in full, then the gaps as Golomb-Rice codes; a byte gives the
    number of low bits, the quotients follow in unary, then the low bits, all packed."""
    gaps = np.diff(values)
    mean = int(values[-1] - values[0]) // max(1, len(gaps)) if len(values) else 0
    low = max(0, mean.bit_length() - 1)
    quotients = (gaps >> np.uint64(low)).astype(np.int64)
    unary = np.zeros(int(quotients.sum()) + len(gaps), np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    shifts = np.arange(low, dtype=np.uint64)[::-1]
    rest = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel()
    first = values[:1].astype(">u8").tobytes()
    return first + bytes([low]) + np.packbits(np.concatenate([unary, rest])).tobytes()


def golomb_decode(code: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    first, low = np.frombuffer(code, ">u8", 1).astype(np.uint64), code[8]
    if n == 1:
        return first
    bits = np.unpackbits(np.frombuffer(code, np.uint8, offset=9))
    ends = np.flatnonzero(bits)[:n - 1]
    quotients = (np.diff(ends, prepend=-1) - 1).astype(np.uint64)
    rest = bits[ends[-1] + 1:ends[-1] + 1 + (n - 1) * low].reshape(n - 1, low)
    lows = np.zeros(n - 1, np.uint64)
    for column in range(low):
        lows = (lows << np.uint64(1)) | rest[:, column].astype(np.uint64)
    return np.cumsum(np.concatenate([first, (quotients << np.uint64(low)) | lows]), dtype=np.uint64)


def bitmap(flags: np.ndarray) -> bytes:
    return np.packbits(flags.astype(np.uint8)).tobytes()


def flags_of(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8))[:n].astype(bool)


def _send(owners: int):
    schema = pa.schema([
        ("block", pa.int64()), ("owner", pa.int32()), ("n_hashes", pa.int32()), ("code", pa.binary()),
        ("again", pa.binary()), ("slots", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
        ("n_cps", pa.list_(pa.int32())), ("digests", pa.list_(pa.binary()))])

    def run(batches):
        table = pa.Table.from_batches(batches)
        digests = table.column("digest").to_pylist()
        prints = np.frombuffer(b"".join(d[:8] for d in digests), ">u8").astype(np.uint64)
        order = np.argsort(prints, kind="stable")
        table, prints = table.take(pa.array(order)), prints[order]
        # owner: which of `owners` equal ranges of the upper 32 bits
        owner = ((prints >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int64)
        block = table.column("block")[0].as_py()
        for o in np.unique(owner):
            lo, hi = np.searchsorted(owner, [o, o + 1])
            values, slots, times = np.unique(prints[lo:hi], return_inverse=True, return_counts=True)
            rows = table.slice(lo, hi - lo)
            yield pa.RecordBatch.from_pylist([{
                "block": block, "owner": int(o), "n_hashes": len(values), "code": golomb_encode(values),
                "again": bitmap(times > 1), "slots": slots.astype("<u4").tobytes(),
                "doc_ids": rows.column("doc_id").to_pylist(), "n_cps": rows.column("n_cp").to_pylist(),
                "digests": rows.column("digest").to_pylist()}], schema=schema)

    def guarded(batches):
        batches = [b for b in batches if b.num_rows]
        if batches:
            yield from run(batches)
    return guarded


def _answer(messages: pa.Table) -> pa.Table:
    """Bitmaps of one owner: for each stream, which of its hashes another stream holds too."""
    counts = messages.column("n_hashes").to_pylist()
    streams = [golomb_decode(c, n) for c, n in zip(messages.column("code").to_pylist(), counts)]
    values, places, times = np.unique(np.concatenate(streams), return_inverse=True, return_counts=True)
    shared = (times > 1)[places]
    cuts = np.cumsum(counts)[:-1]
    return pa.table({"block": messages.column("block").cast(pa.int64()),
                     "owner": messages.column("owner").cast(pa.int32()),
                     "shared": pa.array([bitmap(s) for s in np.split(shared, cuts)], pa.binary())})


def _unroll(batches):
    for batch in batches:
        for row in batch.to_pylist():
            marked = flags_of(row["again"], row["n_hashes"]) | flags_of(row["shared"], row["n_hashes"])
            slots = np.frombuffer(row["slots"], "<u4")
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(row["n_cps"], pa.int32()),
                 pa.array(row["digests"], pa.binary()), pa.array(marked[slots])],
                names=["doc_id", "n_cp", "digest", "suspect"])


def normalised(docs: DataFrame) -> DataFrame:
    """doc_id, normalised text, its digest, code points of the original text."""
    text = whole("text")
    rows = docs.select("doc_id", F.translate(text, SPACES, "").alias("norm"), F.length(text).alias("n_cp"))
    return rows.select("doc_id", "norm", "n_cp", F.unhex(F.sha2("norm", 256)).alias("digest"))


def marked_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_cp, digest, suspect: one row for each row of ``docs``; suspects share their fingerprint."""
    owners = parts(spark, docs.count(), HASHES_PER_OWNER)
    sent = normalised(docs).select(F.spark_partition_id().cast("bigint").alias("block"), "doc_id", "n_cp", "digest")
    home = written(spark, sent.mapInArrow(_send(owners), HOME), "dedup-home")
    answers = (home.select("block", "owner", "n_hashes", "code").groupBy("owner")
               .applyInArrow(_answer, "block long, owner int, shared binary"))
    joined = home.drop("code").join(answers, ["block", "owner"])
    return written(spark, joined.select("n_hashes", "again", "shared", "slots", "doc_ids", "n_cps", "digests").mapInArrow(
        _unroll, "doc_id long, n_cp int, digest binary, suspect boolean"), "dedup-rows")


def verified(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """digest: of every normalised text among the suspects, compared byte for byte."""
    wanted = rows.where("suspect").select(F.col("doc_id").alias("s_id"), F.col("digest").alias("s_digest")).distinct()
    texts = normalised(docs).join(
        wanted, F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("digest") == F.col("s_digest")), "left_semi")
    distinct = texts.groupBy("digest", "norm").agg(F.count("*").alias("copies"))
    return distinct.groupBy("digest").agg(F.count("*").alias("n_texts"), F.sum("copies").alias("group_size")).select(
        "digest", F.when(F.col("n_texts") == 1, F.col("group_size"))
        .otherwise(F.raise_error(F.lit("two texts share one SHA-256 digest"))).alias("group_size"))


def _best(rows: DataFrame) -> DataFrame:
    """digest, keep_id, keep_cp, n_best: of every group the row that stays, and how many rows repeat it."""
    key = F.struct(F.col("n_cp"), F.col("doc_id").isNotNull().alias("has_id"), (-F.col("doc_id")).alias("low_id"))
    by_row = rows.groupBy("digest", "n_cp", "doc_id").agg(F.count("*").alias("n_same"))
    best = by_row.groupBy("digest").agg(F.max(F.struct(*[key[f].alias(f) for f in ("n_cp", "has_id", "low_id")],
                                                       "n_same")).alias("b"))
    return best.select("digest", (-F.col("b.low_id")).alias("keep_id"), F.col("b.n_cp").alias("keep_cp"),
                       F.col("b.n_same").alias("n_best"))


def exact_groups(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, n_cp: one row for each row of ``docs``."""
    rows = marked_rows(spark, docs)
    single = rows.where("NOT suspect").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "n_cp")
    # written, so that the join with the members stands alone and a group with many members can be split
    groups = written(spark, verified(docs, rows).join(_best(rows.where("suspect")), "digest"), "dedup-groups")
    members = rows.where("suspect").select("doc_id", "n_cp", "digest").join(groups, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "n_cp")
    return single.unionByName(members)


def drop_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one per distinct normalised text, all their columns unchanged."""
    rows = marked_rows(spark, docs)
    groups = written(spark, verified(docs, rows).join(_best(rows.where("suspect")), "digest"), "dedup-groups")
    stays = rows.where("NOT suspect").select("doc_id", "digest", F.col("n_cp").alias("keep_cp"),
                                             F.lit(1).cast("bigint").alias("n_best")).unionByName(
        groups.select(F.col("keep_id").alias("doc_id"), "digest", "keep_cp", "n_best"))
    text = whole("text")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.length(text).alias("n_cp"),
                         F.unhex(F.sha2(F.translate(text, SPACES, ""), 256)).alias("digest"))
    kept = packed.join(stays.select(F.col("doc_id").alias("s_id"), F.col("digest").alias("s_digest"), "keep_cp", "n_best"),
                       (F.col("digest") == F.col("s_digest")) & F.col("doc.doc_id").eqNullSafe(F.col("s_id"))
                       & (F.col("n_cp") == F.col("keep_cp")))
    # rows that repeat the one that stays: any one of them, their texts differ in white space at most
    once = kept.where("n_best > 1").dropDuplicates(["digest"])
    return kept.where("n_best = 1").select("doc.*").unionByName(once.select("doc.*"))
