"""Best-fit packing: best-fit decreasing with a segment tree over remaining capacities.

Documents are tokenised where they lie; only piece records travel. Pieces are dealt by a hash of their row number into
groups of about ``PIECES_PER_GROUP``; a group is packed in one task, and large groups lose next to nothing against one
packing of everything (the README has the figures). ``pack_mixed`` deals pieces by their document's mixed place instead:
groups are consecutive ranges of slots, and sequences are numbered in the order of their first pieces.

Defined results: a null or empty text is the end token alone. Texts beyond the capacity become one short first piece
and full pieces; a full piece is a sequence of its own. Rows that repeat are packed once each. An empty table gives an
empty result.
"""
from __future__ import annotations

import os
import re
import zlib
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortqc.llm import mixing
from cohortqc.llm.common import whole, written

CAPACITY, END = 2048, 0
PIECES_PER_GROUP = 8192
# ranges of slots whose pieces are counted, for each group
STEPS_PER_GROUP = 8
CACHE_ENTRIES, CACHE_CHARS, TEXTS_AT_ONCE = 800_000, 48, 64
# in a chain of stages workers outlive their stage, and what they remember lies beside the other stages' memory
CHAIN_CACHE_ENTRIES = 100_000
# unknown chunks that go to the tokenizer as one text; its time a chunk grows with the text
CHUNKS_AT_ONCE = 1024

# White space of the byte-level pre-tokenizer's pattern.
BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# No token spans two of these chunks: a token holds a space only in front or within a run of white space.
CHUNKS = re.compile(f" ?[^{BLANK}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")


# What keeps a text from the quick cut: white space other than blanks and line breaks, the sign it uses itself, and
# white space beside white space.
SLOW = [c for c in map(chr, range(0x3001)) if re.match(f"[\0{BLANK}]", c) and c not in " \n"] + ["  ", " \n", "\n ", "\n\n"]

# Signs that close a chunk. After a letter they are a word of their own for the pre-tokenizer's pattern; letters that all
# versions of Unicode know lie below LETTERS_BELOW.
SIGNS, LETTERS_BELOW = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~", "\u0250"


def stem_of(chunk: str) -> str:
    """The chunk without its closing signs, where no token spans the place between; else all of it."""
    stem = chunk.rstrip(SIGNS)
    return stem if stem and stem[-1] < LETTERS_BELOW and stem[-1].isalpha() else chunk


def chunks(text: str) -> list[str]:
    """The text in chunks that no token spans. Where white space is single blanks and line breaks, each blank opens a
    chunk and each line break is one: the pattern would find the same."""
    if any(c in text for c in SLOW):
        return CHUNKS.findall(text)
    return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")


class ByteBpe:
    """Token ids by the tokenizers library. Texts repeat their words, so the ids of short chunks are remembered, up to
    a bound."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.entries = CACHE_ENTRIES
        vocab = self.tokenizer.get_vocab()
        # a byte-level token has one sign for every byte it stands for
        self.sizes = np.zeros(max(vocab.values()) + 1, np.int64)
        self.sizes[list(vocab.values())] = [len(token) for token in vocab]

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of chunks without inner white space, from one text: none of its tokens spans two of them, as each starts
        with its blank or follows a line break. Tokens are told apart by the bytes they stand for; should one span a
        border after all, every chunk is encoded by itself."""
        apart = [w if w[0] == " " else "\n" + w for w in words]
        borders = np.cumsum(list(map(len, map(str.encode, apart))))
        [raw] = self._encode(["".join(apart)])
        upto = np.cumsum(self.sizes[np.frombuffer(raw, np.uint32)])
        ends = np.searchsorted(upto, borders) + 1
        if ends[-1] != len(upto) or not np.array_equal(upto[ends - 1], borders):
            return self._encode(words)
        # the line break is a token of its own
        starts = np.concatenate([[0], ends[:-1]]) + np.fromiter((w[0] != " " for w in words), bool, len(words))
        return [raw[4 * s:4 * e] for s, e in zip(starts.tolist(), ends.tolist())]

    def _learn(self, new: list[str]) -> list[str]:
        """Looks up the ids of new chunks; gives those too long to be remembered. Chunks that end in signs are put together
        from their stem, which other chunks share, and the signs."""
        others = [c for c in new if c.isspace()]
        words = [c for c in new if not c.isspace()] if others else new
        stems = list(map(stem_of, words))
        ended = [(c, s, c[len(s):]) for c, s in zip(words, stems) if s != c]
        lacking = list({*stems, *[tail for _, _, tail in ended]}.difference(self.known))
        for low in range(0, len(lacking), CHUNKS_AT_ONCE):
            part = lacking[low:low + CHUNKS_AT_ONCE]
            self.known.update(zip(part, self._encode_words(part)))
        for c, stem, tail in ended:
            self.known[c] = self.known[stem] + self.known[tail]
        self.known.update(zip(others, self._encode(others)))
        return [c for c in chain(new, lacking) if len(c) > CACHE_CHARS]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        odd = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        cut = [[] if i in odd else chunks(t) for i, t in enumerate(texts)]
        if len(self.known) > self.entries:
            self.known.clear()
        self.known[""] = b""
        new = list(set(chain.from_iterable(cut)).difference(self.known))
        long = self._learn(new)
        found = [b"".join(map(self.known.__getitem__, chunks)) for chunks in cut]
        for c in long:
            self.known.pop(c, None)
        for i in odd:  # a special string splits its text before white space is looked at
            found[i] = self._encode([texts[i]])[0]
        return found


_TOKENIZERS: dict[str, ByteBpe] = {}


def byte_bpe(path: str) -> ByteBpe:
    """The worker's tokenizer; a worker keeps it from task to task."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = ByteBpe(path)
    return _TOKENIZERS[path]


def cut_lengths(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document of n tokens; the first piece may be shorter."""
    return ([n % capacity] if n % capacity else []) + [capacity] * (n // capacity)


PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"


def _pieces(path: str, capacity: int, with_ids: bool, carry: list[str], entries: int):
    def run(batches):
        tokenizer = byte_bpe(path)
        tokenizer.entries = entries
        for batch in batches:
            texts, doc_ids = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            rows = batch.column("row").to_pylist()
            carried = [batch.column(c).to_pylist() for c in carry]
            for low in range(0, len(texts), TEXTS_AT_ONCE):
                out = []
                for k, ids in enumerate(tokenizer.ids(texts[low:low + TEXTS_AT_ONCE]), low):
                    ids += END.to_bytes(4, "little")
                    start = 0
                    for piece, length in enumerate(cut_lengths(len(ids) // 4, capacity)):
                        part = ids[4 * start:4 * (start + length)]
                        out.append((doc_ids[k], rows[k], piece, start, length, zlib.crc32(part), part, *[c[k] for c in carried]))
                        start += length
                columns = list(zip(*out))
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
                names = ["doc_id", "row", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array([np.frombuffer(b, "<i4") for b in columns[6]], pa.list_(pa.int32())))
                    names.append("ids")
                for c, values in zip(carry, columns[7:]):
                    arrays.append(pa.array(values, batch.schema.field(c).type))
                    names.append(c)
                yield pa.RecordBatch.from_arrays(arrays, names=names)
    return run


def tokenised_pieces(spark: SparkSession, docs: DataFrame, path: str, capacity: int = CAPACITY,
                     with_ids: bool = False, carry: list[str] | None = None, entries: int = CACHE_ENTRIES) -> DataFrame:
    """doc_id, row, piece, start, length, ids_crc32 (and ids, and the columns ``carry``) of every piece, written once."""
    carry = carry or []
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), whole("text").alias("text"), *carry)
    schema = PIECES + (", ids array<int>" if with_ids else "") + "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in carry)
    return written(spark, rows.mapInArrow(_pieces(path, capacity, with_ids, carry, entries), schema), "packing-pieces")


class CapacityTree:
    """Open bins by remaining capacity, in a segment tree: a node knows the smallest capacity in its span that some bin
    has left at or above a wanted size is found by one walk from the root."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.leaves)  # bins below each node
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, left: int, number: int) -> None:
        self.bins[left].append(number)
        self._count(left, 1)

    def _count(self, left: int, change: int) -> None:
        node = left + self.leaves
        while node:
            self.open[node] += change
            node >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """The open bin with the least capacity of at least ``size``, removed: its capacity and number."""
        node = size + self.leaves
        while not self.open[node]:  # up to the first subtree on the right that holds a bin
            while node & 1:
                node >>= 1
            if node == 0:
                return None
            node += 1
            if node & (node - 1) == 0:  # past the right edge
                return None
        while node < self.leaves:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        left = node - self.leaves
        number = self.bins[left].pop()
        self._count(left, -1)
        return left, number


def best_fit(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Bin and offset of each item; items are placed in falling order of length, each into the fullest bin it fits."""
    tree, placed, n_bins = CapacityTree(capacity), [(0, 0)] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[i])
        if found is None:
            left, number = capacity, n_bins
            n_bins += 1
        else:
            left, number = found
        placed[i] = (number, capacity - left)
        if left > lengths[i]:
            tree.add(left - lengths[i], number)
    return placed


def _pack_group(capacity: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("row", "ascending"), ("piece", "ascending")])
        placed = best_fit(table.column("length").to_pylist(), capacity)
        first = key[0].as_py() << 32
        return (table.append_column("sequence_id", pa.array([first + b for b, _ in placed], pa.int64()))
                .append_column("offset", pa.array([o for _, o in placed], pa.int64())).drop_columns(["grp"]))
    return run


def packed(spark: SparkSession, pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with sequence_id and offset."""
    partial = pieces.where(F.col("length") < capacity)
    groups = max(1, round(partial.count() / PIECES_PER_GROUP))
    dealt = partial.withColumn("grp", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)))
    names = [f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields]
    packed_ = dealt.groupBy("grp").applyInArrow(_pack_group(capacity), ", ".join([*names, "sequence_id long", "offset long"]))
    # full pieces: numbers no group uses, by row and piece
    full = pieces.where(F.col("length") == capacity).withColumns({
        "sequence_id": -1 - F.xxhash64("row", "piece").bitwiseAND(F.lit((1 << 62) - 1)), "offset": F.lit(0).cast("bigint")})
    return packed_.unionByName(full)


def sequences(packed_pieces: DataFrame) -> DataFrame:
    """sequence_id, ids: the packed sequences themselves, from pieces that carry ids. A sequence is bounded by the
    capacity, and so is the group that builds it."""
    parts_ = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed_pieces.groupBy("sequence_id").agg(F.flatten(F.transform(parts_, lambda p: p["ids"])).alias("ids"))


def mixed_places(spark: SparkSession, docs: DataFrame, pieces: DataFrame) -> DataFrame:
    """The pieces with the slot and the place that mixing gives their document. Mixing keeps all rows, so the targets of
    its result are those it was made with; only ids and sources travel."""
    first = pieces.where("piece = 0").select("doc_id", "source", F.struct("row").alias("mix_doc"))
    placed = mixing.mixed(spark, first, mixing.root_targets(docs), ["mix_doc"])
    return pieces.join(placed.select(F.col("mix_doc.row").alias("row"), "slot", "place"), "row")


def _pack_range(capacity: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("slot", "place", "row", "piece")])
        placed = best_fit(table.column("length").to_pylist(), capacity)
        number: dict[int, int] = {}
        for b, _ in placed:
            number.setdefault(b, len(number))
        first = key[0].as_py() << 32
        return (table.append_column("sequence_id", pa.array([first + number[b] for b, _ in placed], pa.int64()))
                .append_column("offset", pa.array([o for _, o in placed], pa.int64())).drop_columns(["grp"]))
    return run


def packed_in_order(spark: SparkSession, pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with sequence_id and offset, from pieces with slot and place; sequence ids follow the slots."""
    about = pieces.agg(F.count("*").alias("n"), F.max("slot").alias("last")).first()
    steps = max(1, round(about["n"] / PIECES_PER_GROUP)) * STEPS_PER_GROUP
    width = max(1, -(-((about["last"] or 0) + 1) // steps))
    stepped = pieces.withColumn("step", F.floor(F.col("slot") / width))
    counts = stepped.groupBy("step").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("step")) - F.col("n")
    groups = counts.select("step", F.floor(before / PIECES_PER_GROUP).alias("grp"))
    names = [f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields]
    return stepped.join(groups, "step").drop("step").select(*pieces.columns, "grp").groupBy("grp").applyInArrow(
        _pack_range(capacity), ", ".join([*names, "sequence_id long", "offset long"]))


def pack_mixed(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    """As ``pack_documents``, for documents that ``mixing.mix_rows`` has mixed to their root targets: sequences, read by
    number, hold the sources in the mixed order."""
    pieces = tokenised_pieces(spark, docs, path, carry=["source"], entries=CHAIN_CACHE_ENTRIES)
    placed = written(spark, mixed_places(spark, docs, pieces), "packing-places")
    return packed_in_order(spark, placed).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def pack_documents(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every row of ``docs``."""
    return packed(spark, tokenised_pieces(spark, docs, path)).drop("row")
