"""SimHash near-dedup: fingerprints embedded as bit counts of segments, a grid range join under Manhattan distance,
exact verification, components.

A fingerprint's 64 bits form 32 segments of two bits; its image is the vector of their bit counts. The Manhattan
distance of two images never exceeds the Hamming distance of the fingerprints, so the join in the image space loses no
link. The grid: coordinates form six blocks, and images within distance 3 differ in at most three of them, so they lie
in one cell of at least one of the 20 grids that three blocks span. Cells with one fingerprint are dropped after a
count; fuller cells are cut into chunks, and pairs of chunks are the units of work, so no task holds more than two
chunks of a cell. Within a unit, candidates pass the Manhattan bound, then the exact Hamming test, and only links that
join two groups of that unit are emitted, never all pairs.

Equal fingerprints are one node throughout: thousands of copies cost one row.

Defined results: a null or empty text has fingerprint zero and links like any other. A null doc_id is never a
component's smallest id unless all its ids are null. Repeated rows share a component. An empty table gives an empty
result.
"""
from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortqc.llm.common import parts, whole, written
from cohortqc.llm.components import components

SHINGLE, SEED, MAX_BITS = 3, 42, 3
# Segments of each block: 32 in all.
BLOCKS = [6, 6, 5, 5, 5, 5]
ODD_BITS = 0x5555555555555555
CHUNK = 1024
ROWS_PER_PART = 500_000


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """Hashes of the shingles, repeats included; a text with fewer words is one shingle, an empty one has none."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    starts = np.cumsum([0] + [len(t) + 1 for t in tokens])
    n = max(1, len(tokens) - words + 1)
    ends = (starts[min(words, len(tokens)):] - 1)[:n]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends.tolist())], np.uint64)


def print_of(hashes: np.ndarray) -> int:
    """A bit is 1 if set in over half the hashes; zero if there are none."""
    n, ones = len(hashes), np.zeros(64, np.int64)
    if not n:
        return 0
    for low in range(0, n, 65_536):
        bits = np.unpackbits(hashes[low:low + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def simhash(text: str, words: int = SHINGLE) -> int:
    """The fingerprint of a text's shingles, repeats included."""
    return print_of(shingle_hashes(text, words))


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _prints(batches):
    for batch in batches:
        found = [simhash(t or "") for t in batch.column("text").to_pylist()]
        at = batch.schema.get_field_index("text")
        yield batch.remove_column(at).append_column("print", _signed(found))


def fingerprints(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """doc_id, digest (of the text), print (the fingerprint as a signed long) of every row."""
    if words != SHINGLE:
        raise ValueError("the fingerprint is defined on three words")
    text = whole("text")
    rows = docs.select("doc_id", F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))
    return rows.mapInArrow(_prints, "doc_id long, digest binary, print long")


def _cells(nodes: DataFrame) -> DataFrame:
    """print, cell: the cell of each fingerprint in each of the 20 grids.

    A segment's count is written in unary (00, 01, 11): the number of bits by which two images differ is then their
    Manhattan distance.
    """
    x, odd = F.col("print"), F.lit(ODD_BITS)
    high = F.call_function("shiftrightunsigned", x, F.lit(1))
    image = F.call_function("shiftleft", high.bitwiseAND(x).bitwiseAND(odd), F.lit(1)).bitwiseOR(
        high.bitwiseOR(x).bitwiseAND(odd))
    grids, low, masks = [], 0, []
    for segments in BLOCKS:
        masks.append(((1 << 2 * segments) - 1) << low)
        low += 2 * segments
    for number, chosen in enumerate(combinations(masks, len(BLOCKS) - MAX_BITS)):
        mask = sum(chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        grids.append(F.xxhash64(F.lit(number), image.bitwiseAND(F.lit(signed))))
    return nodes.select("print", F.explode(F.array(*grids)).alias("cell"))


def _units(spark: SparkSession, cells: DataFrame) -> DataFrame:
    """unit, print: fingerprints of one cell, cut into pairs of chunks."""
    sizes = cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    mine = F.pmod(F.xxhash64("print", F.lit(1)), F.col("chunks")).cast("int")
    full = cells.join(sizes, "cell").select("cell", "print", chunks.alias("chunks"))
    full = full.select("cell", "print", "chunks", mine.alias("mine"))
    return full.select(F.explode(F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1), lambda other: F.xxhash64(
            F.col("cell"), F.least(F.col("mine"), other), F.greatest(F.col("mine"), other)))).alias("unit"), "print")


def image(prints: np.ndarray) -> np.ndarray:
    """Bit counts of the two-bit segments, in unary."""
    odd, high = np.uint64(ODD_BITS), prints >> np.uint64(1)
    return ((high & prints & odd) << np.uint64(1)) | ((high | prints) & odd)


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    near = np.bitwise_count(image(a) ^ image(b)) <= MAX_BITS
    near[near] = np.bitwise_count(a[near] ^ b[near]) <= MAX_BITS
    return near


def links(units: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected within each unit; rows come sorted by unit. Row i meets row i + shift for
    growing shifts, all units at once; two rows that links already connect are not compared again."""
    root = np.arange(len(prints))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    left, right = [], []
    at, shift = np.arange(len(prints)), 0
    while len(at):
        shift += 1
        at = at[at + shift < len(prints)]
        at = at[units[at] == units[at + shift]]
        for low in range(0, len(at), 100_000):
            i = at[low:low + 100_000]
            i = i[root[i] != root[i + shift]]
            for k in i[_near(prints[i], prints[i + shift])].tolist():
                a, b = find(k), find(k + shift)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    left.append(k), right.append(k + shift)
    return prints[left], prints[right]


def _link_batches(batches):
    """Rows arrive sorted by unit; a unit that continues in the next batch is carried over."""
    rest_u, rest_p = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def emit(units, prints):
        a, b = links(units, prints)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["hi", "lo"])

    for batch in batches:
        units = np.concatenate([rest_u, batch.column("unit").to_numpy(zero_copy_only=False)])
        prints = np.concatenate([rest_p, batch.column("print").to_numpy(zero_copy_only=False).view(np.uint64)])
        cut = np.searchsorted(units, units[-1]) if len(units) else 0
        rest_u, rest_p = units[cut:], prints[cut:]
        if cut:
            yield emit(units[:cut], prints[:cut])
    if len(rest_u):
        yield emit(rest_u, rest_p)


def near_links(spark: SparkSession, nodes: DataFrame) -> DataFrame:
    """hi, lo: links between distinct fingerprints that connect all those within ``MAX_BITS`` of each other."""
    cells = _cells(nodes)
    units = _units(spark, cells)
    n = parts(spark, nodes.count() * 2, ROWS_PER_PART)
    dealt = units.repartition(n, "unit").sortWithinPartitions("unit")
    return dealt.mapInArrow(_link_batches, "hi long, lo long")


def near_groups(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, digest, print, component_id, component: one row for each row of ``docs``; ``component`` is the smallest
    fingerprint of the group, which also tells groups apart whose ids are null."""
    rows = written(spark, fingerprints(docs), "simhash-prints")
    nodes = written(spark, rows.groupBy("print").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    roots = components(spark, near_links(spark, nodes.select("print")))
    labelled = nodes.join(roots, nodes["print"] == roots["node"], "left").select(
        "print", "first_id", F.coalesce("root", "print").alias("component"))
    labelled = written(spark, labelled, "simhash-labelled")
    smallest = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = labelled.join(smallest, "component").select("print", "component", "component_id")
    return rows.join(named, "print").select("doc_id", "digest", "print", "component_id", "component")


def drop_near(spark: SparkSession, docs: DataFrame, groups=near_groups) -> DataFrame:
    """Of each group (by ``groups``, see ``near_groups``) the row with the smallest doc_id (null last, then by the text's digest), all columns unchanged; of
    rows that repeat it, one."""
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("digest").alias("digest"),
                     F.col("n").alias("n"))
    by_row = groups(spark, docs).groupBy("component", "doc_id", "digest").agg(F.count("*").alias("n"))
    keep = written(spark, by_row.groupBy("component").agg(F.min(order).alias("k")).select(
        F.col("k.id").alias("k_id"), F.col("k.digest").alias("k_digest"), F.col("k.n").alias("n")), "simhash-kept")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                         F.unhex(F.sha2(whole("text"), 256)).alias("digest"))
    kept = packed.join(keep, (F.col("digest") == F.col("k_digest")) & F.col("doc.doc_id").eqNullSafe(F.col("k_id")))
    once = kept.where("n > 1").dropDuplicates(["digest", "k_id"])
    return kept.where("n = 1").select("doc.*").unionByName(once.select("doc.*"))
