"""Line dedup: hashes of lines are range-partitioned with a secondary sort by document and position, first occurrences
are streamed, and per-document bitmaps go back instead of text.

1. One pass over the texts cuts them into lines and writes a row per line: two 64-bit hashes of its key, the document
   and the position. Texts stay where they are.
2. The rows are range-partitioned by (hash, slice of documents) and sorted by document and position behind it. The
   slice only cuts lines that very many documents hold: the slices of one hash are neighbours in the order, so a rare
   line stays in one place and a hot one is dealt to as many partitions as its rows need.
3. Within a slice the sorted rows are streamed: a row that differs in document from the row before it is the first
   occurrence there. Slices become one row each (documents, first occurrence), and a combining aggregate puts the
   slices of a hash together. Lines in at least ``min_docs`` documents are the frequent ones.
4. The rows of frequent lines become bits, 32 positions to a word, combined on the map side; each document gets back
   the few words that have a bit set, and drops those lines from its text.

A line's key is the line without the characters [\\x20\\x09-\\x0D] at both ends, with A-Z in lower case. The two hashes
make 128 bits; keys are taken as equal if both agree.

Defined results: a null or empty text is one empty line. Keys of fewer than ``min_chars`` code points are never dropped.
Rows that repeat a doc_id with the same text are one document, each row gets its own result; a null doc_id is a value
of its own. With ``keep_first`` the first of the occurrences stays, in the order of doc_id (null first), hash of the
text, position. An empty table gives an empty result. Other columns are not read, whatever their names; ``drop_lines``
hands them on unchanged.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortqc.llm.common import LOWER, SPACES, UPPER, parts, whole, written
from cohortqc.session import BROADCAST_ROWS

MIN_DOCS = 10
MIN_CHARS = 1
# rows of one line that a slice holds in the mean, and rows of a range partition
SLICE_ROWS = 50_000
RANGE_ROWS = 2_000_000
# positions in a word of the bitmap
WORD = 32


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def text_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _documents(docs: DataFrame) -> DataFrame:
    """doc_id, text, tag: the tag tells texts of one doc_id apart."""
    return docs.select("doc_id", whole("text").alias("text")).withColumn("tag", F.xxhash64("text"))


def hashed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """h1, h2, doc_id, tag, pos: one row for each line whose key has at least ``min_chars`` code points."""
    lines = _documents(docs).select("doc_id", "tag", F.posexplode(text_lines(F.col("text"))).alias("pos", "line"))
    keys = lines.select("doc_id", "tag", "pos", line_key(F.col("line")).alias("key"))
    return keys.where(F.length("key") >= max(1, min_chars)).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "tag", "pos")


def frequent_lines(spark: SparkSession, lines: DataFrame, rows: int, min_docs: int = MIN_DOCS) -> DataFrame:
    """h1, h2, n_docs, first: the lines that at least ``min_docs`` documents hold, and where each occurs first."""
    slices = max(1, math.ceil(rows / SLICE_ROWS))
    order = ["doc_id", "tag", "pos"]
    sliced = lines.withColumn("slice", F.pmod(F.xxhash64("doc_id", "tag"), F.lit(slices)))
    ranged = sliced.repartitionByRange(parts(spark, rows, RANGE_ROWS), "h1", "h2", "slice").sortWithinPartitions(
        "h1", "h2", "slice", *order)
    stream = W.partitionBy("h1", "h2", "slice").orderBy(*order)
    place = F.struct("doc_id", "tag")
    first = ranged.withColumn("opens", ~place.eqNullSafe(F.lag(place).over(stream)))
    by_slice = first.where("opens").groupBy("h1", "h2", "slice").agg(
        F.count("*").alias("n"), F.min(F.struct(*order)).alias("first"))
    return by_slice.groupBy("h1", "h2").agg(F.sum("n").alias("n_docs"), F.min("first").alias("first")).where(
        F.col("n_docs") >= min_docs)


def drop_bitmaps(spark: SparkSession, docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                 keep_first: bool = False) -> DataFrame:
    """doc_id, tag, words: for each document that loses lines the words of its bitmap that have a bit set (the word's
    number in the upper 32 bits, ``WORD`` positions in the lower), in order."""
    lines = written(spark, hashed_lines(docs, min_chars), "line-hashes")
    frequent = written(spark, frequent_lines(spark, lines, lines.count(), min_docs), "line-frequent")
    small = frequent.count() <= BROADCAST_ROWS
    found = lines.join(F.broadcast(frequent) if small else frequent, ["h1", "h2"])
    if keep_first:
        found = found.where(F.struct("doc_id", "tag", "pos") != F.col("first"))
    bit = F.expr(f"shiftleft(1L, pos % {WORD})")
    by_word = found.groupBy("doc_id", "tag", F.expr(f"cast(pos div {WORD} as bigint)").alias("word")).agg(
        F.bit_or(bit).alias("bits"))
    return by_word.groupBy("doc_id", "tag").agg(F.sort_array(F.collect_list(
        F.shiftleft("word", WORD).bitwiseOR(F.col("bits")))).alias("words"))


def dropped_positions(words: Column) -> Column:
    """The positions (from 0) whose bits are set, in order."""
    def of_word(word: Column) -> Column:
        marked = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)),
                          lambda b: F.call_function("getbit", word, b) == 1)
        return F.transform(marked, lambda b: (F.shiftright(word, WORD) * WORD).cast("int") + b)
    return F.flatten(F.transform(words, of_word))


def lines_left(lines: Column, dropped: Column) -> Column:
    """The lines between the dropped positions, in time linear in both."""
    starts = F.concat(F.array(F.lit(0)), F.transform(dropped, lambda p: p + 1))
    ends = F.concat(dropped, F.array(F.size(lines)))
    return F.flatten(F.transform(F.arrays_zip(starts.alias("s"), ends.alias("e")),
                                 lambda r: F.slice(lines, r["s"] + 1, r["e"] - r["s"])))


def _marked(spark: SparkSession, docs: DataFrame, **rules) -> DataFrame:
    """doc (all columns), words: every row of ``docs`` with its bitmap, null where nothing goes. Bitmaps that are few
    words altogether are sent to the texts; else both are shuffled."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")).withColumn(
        "tag", F.xxhash64(whole("doc.text")))
    marks = written(spark, drop_bitmaps(spark, docs, **rules), "line-bitmaps").select(
        F.col("doc_id").alias("m_id"), F.col("tag").alias("m_tag"), "words")
    size = marks.agg(F.sum(F.size("words") + 4)).first()[0] or 0
    # an id that is null joins like any other value
    return rows.join(F.broadcast(marks) if size <= BROADCAST_ROWS else marks,
                     F.col("doc.doc_id").eqNullSafe(F.col("m_id")) & (F.col("tag") == F.col("m_tag")), "left").select(
        "doc", "words")


def _kept_text(text: Column, words: Column) -> Column:
    left = F.array_join(lines_left(text_lines(text), dropped_positions(words)), "\n")
    return F.when(words.isNull(), text).otherwise(left)


def line_dedup(spark: SparkSession, docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
               keep_first: bool = False) -> DataFrame:
    """doc_id, n_lines, n_dropped, words (the bitmap), kept_sha256: one row for each row of ``docs``."""
    marked = _marked(spark, docs.select("doc_id", "text"), min_docs=min_docs, min_chars=min_chars, keep_first=keep_first)
    text, words = whole("doc.text"), F.col("words")
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    dropped = F.aggregate(words, F.lit(0).cast("bigint"),
                          lambda n, w: n + F.bit_count(w.bitwiseAND(F.lit(2 ** WORD - 1))))
    return marked.select(
        "doc.doc_id", (breaks + 1).cast("bigint").alias("n_lines"),
        F.coalesce(dropped, F.lit(0)).cast("bigint").alias("n_dropped"), "words",
        F.sha2(_kept_text(text, words), 256).alias("kept_sha256"))


def drop_lines(spark: SparkSession, docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
               keep_first: bool = False) -> DataFrame:
    """The rows of ``docs`` with their texts' repeated lines gone; a null text stays null."""
    marked = _marked(spark, docs, min_docs=min_docs, min_chars=min_chars, keep_first=keep_first)
    kept = F.when(F.col("doc.text").isNotNull(), _kept_text(whole("doc.text"), F.col("words")))
    return marked.select(*[kept.alias(c) if c == "text" else F.col(f"doc.`{c}`") for c in docs.columns])
