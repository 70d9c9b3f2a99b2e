"""Spelling variant grouping with asymmetric q-chunks.

1. Words are counted over all texts with a combining aggregate; only words that occur often enough go on.
2. Of two words one edit apart let the longer (of equal lengths the later) be the chunk side. It contributes two
   disjoint chunks, its halves: one edit lies in one of them and leaves the other whole. The other word contributes its
   positional grams of the same lengths, at the chunk's place or one place before it, where an edit may have shifted it.
3. A chunk alone would be a hot key: thousands of words begin alike. The half that holds the edit is itself two
   disjoint chunks, of which again one is whole; so every key is a chunk together with a whole quarter of the other half
   at its own place (shift nought or one). A key then leaves open one quarter of the word only, so few words share it,
   however large the vocabulary. Each word gives four keys as chunk side and eight as gram side.
4. Pairs that meet are verified by their edit distance and counted once.
5. Every word's form is its most frequent near word, if that is frequent enough; forms are followed to the last one by
   doubling, a few joins since each step multiplies the frequency.

Defined results: a null text has no words. Repeated rows count as often as they stand there. Of forms equally frequent
the first in code-point order is taken. A word without a near word is its own root. An empty table gives an empty
result. Other columns are not read, whatever their names. A word as long as a text is compared whole.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortqc.llm.common import LOWER, UPPER, whole, written

LETTER = "[A-Za-z\\u00C0-\\u00FF]"
MIN_CHARS = 7
MIN_COUNT = 2
FORM_RATIO = 10
QUARTERS = 4
# longer words are compared by arrays of letters: the edit distance walks a word once for each of its letters
LONG_WORD = 256


def runs(docs: DataFrame, least: int) -> DataFrame:
    """doc_id, run: every maximal run of at least ``least`` letters, in lower case."""
    found = F.regexp_extract_all(whole("text"), F.lit(f"{LETTER}{{{least},}}"), F.lit(0))
    return docs.select("doc_id", F.explode(found).alias("run")).select(
        "doc_id", F.translate("run", UPPER, LOWER).alias("run"))


def with_slips(runs_: DataFrame, one_in: int) -> DataFrame:
    """The runs as words, of which a hash of document and run makes about one in ``one_in`` lose a letter. A null
    doc_id counts as empty text."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    hit = runs_.select("run", h.alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    slipped = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return hit.select(F.when(F.col("h") % one_in == 0, slipped).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n: distinct words of at least ``min_chars`` code points that occur at least ``min_count`` times."""
    counted = words.where(F.length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= min_count)


def _borders(length: Column) -> list[Column]:
    """Where the quarters of a word begin, and its end: the halves are cut in two again."""
    half = F.floor(length / 2)
    return [F.lit(0), F.floor(half / 2), half, half + F.floor((length - half) / 2), length]


def _keys(word: Column, length: Column, long: Column) -> Column:
    """Keys of a word against chunk sides of ``long`` code points: for each quarter that an edit may lie in, the half
    that is whole with the whole quarter beside it. What stands behind the edit is shifted by the lengths' difference."""
    cut = _borders(long)
    shift = long - length
    return F.array(*[F.struct(
        long.cast("int").alias("long"), F.lit(q).alias("quarter"),
        F.concat(F.substring(word, F.lit(1), cut[q].cast("int")),
                 F.substring(word, (cut[q + 1] - shift + 1).cast("int"), (long - cut[q + 1]).cast("int"))).alias("rest"))
        for q in range(QUARTERS)])


def one_edit(word: Column, near: Column) -> Column:
    """Whether two different words, the first as long as the other or one longer, are one edit apart."""
    letters = lambda w: F.split(w, "")
    differs = F.zip_with(letters(word), letters(near), lambda x, y: ~x.eqNullSafe(y))
    # behind the first letter that differs both must go on alike
    at = F.array_position(differs, F.lit(True)).cast("int")
    behind = F.length(near) - F.length(word) + at + 1
    whole_length = F.length(word)
    linear = (at > 0) & (F.substring(word, at + 1, whole_length) == F.substring(near, behind, whole_length))
    return F.when(F.length(word) > LONG_WORD, linear).otherwise(F.levenshtein(word, near, 1) == 1)


def near_pairs(vocab: DataFrame) -> DataFrame:
    """word, n, near, near_n: every pair of words one inserted, deleted or replaced code point apart, once, the chunk
    side first."""
    sized = vocab.withColumn("length", F.length("word"))
    chunks = sized.select("word", "n", "length", F.inline(_keys(F.col("word"), F.col("length"), F.col("length"))))
    grams = sized.select(
        F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("length").alias("near_length"),
        F.inline(F.concat(_keys(F.col("word"), F.col("length"), F.col("length")),
                          _keys(F.col("word"), F.col("length"), F.col("length") + 1))))
    ordered = (F.col("length") > F.col("near_length")) | (F.col("word") > F.col("near"))
    met = chunks.join(grams, ["long", "quarter", "rest"]).where(ordered & one_edit(F.col("word"), F.col("near")))
    return met.select("word", "n", "near", "near_n").distinct()


def forms(vocab: DataFrame, pairs: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """word, n, n_near, form, form_n: the most frequent near word where it is at least ``ratio`` times as frequent."""
    both = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"),
                                          F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best"))
    form_n = -F.col("best.rank")
    taken = form_n >= ratio * F.col("n")
    return vocab.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(taken, F.col("best.near")).alias("form"), F.when(taken, form_n).alias("form_n"))


def roots(spark: SparkSession, found: DataFrame) -> DataFrame:
    """word, root: for every word that has a form, the last of its chain of forms. Each round doubles the steps taken;
    frequency grows along a chain, so it has no loop and ends soon."""
    links = written(spark, found.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-links")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = written(spark, links.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-links")
        if links.where("moved").isEmpty():
            return links.select("word", "root")
        links = links.drop("moved")


def group_variants(spark: SparkSession, vocab: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """word, n, n_near, form, form_n, root for every word of a vocabulary (word, n)."""
    vocab = written(spark, vocab, "spelling-words")
    pairs = written(spark, near_pairs(vocab), "spelling-pairs")  # read from both ends
    found = written(spark, forms(vocab, pairs, ratio), "spelling-forms")
    return found.join(roots(spark, found), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def spelling_variants(spark: SparkSession, docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
                      ratio: int = FORM_RATIO, slip_one_in: int | None = None) -> DataFrame:
    """The variants among the words of all texts. ``slip_one_in`` makes about one occurrence in so many lose a letter
    first, as a planted misspelling."""
    found = runs(docs, min_chars)
    words = with_slips(found, slip_one_in) if slip_one_in else found.select(F.col("run").alias("word"))
    return group_variants(spark, vocabulary(words, min_chars, min_count), ratio)
