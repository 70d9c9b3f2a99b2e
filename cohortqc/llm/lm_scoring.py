"""Language-model scores by logistic context mixing: hashed-context bit predictors, gated weights, an adaptive
refinement, total bits.

A text is coded as its tokens, each byte by byte and bit by bit, with a closing mark; the end of a text is the empty
token. Five predictors look up counts of the coming bit under hashed contexts: the last one, two, three and four bytes
of the text, whichever tokens they belong to (a blank stands between two), and all of the token so far. Their log odds are mixed by weights that a gate picks, here the confidence (counts
seen) of the two longest contexts; a refinement table then corrects the mixed probability by what really followed it.
Bit probabilities multiply to a probability of the text that sums to one over all texts.

Each domain (the languages training documents name, ``DOMAINS`` of them at most, and one for the rest) has contexts of
its own. A text's domain is hidden: its probability is the mixture over domains, each weighed by its share of training
documents, so the first words of a text decide by which domain the rest is coded. The text's own language is never
looked at.

Four bytes of context reach past a token's start only from its first ``HEAD`` bytes (the closing mark counts as one). Such
a byte is coded once per distinct window of five bytes, the others depend on their token alone and are coded once per
distinct token: the score is that of the whole text, byte by byte, and no occurrence is coded twice. Each block of texts
(``BLOCK_BYTES`` at most) sends its windows with their training counts and its distinct tokens with the documents that
hold them; the vocabulary meets its counts and its code length, and the numbers return to the block. A frequent token is
one row per block. Windows are scored where the texts lie, in a second reading, each once a task; their sums return to the
rows by the texts' digests.

Learning is distributed and online: counts add up over tasks; each task runs through its training tokens in small
steps, predicting every bit from counts without the occurrence at hand and correcting the weights of the gate in use
by an online Newton step; weights are averaged over tasks after each of ``ROUNDS``. Tables have fixed sizes
(``TABLE_BITS``), whatever the corpus; counts and code lengths of tokens are kept for all of them.

Defined results: a null text is the end token alone. A null id counts as empty text in the fold. Without training
tokens every base probability is one over one unseen kind, and the model mixes with untrained weights. Repeated rows
count as often as they occur. An empty table gives an empty result.
"""
from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortqc.llm.common import doc_crc, whole, written

BLOCK_BYTES, BLOCK_DOCS = 32 << 20, 60_000
TABLE_BITS = (16, 18, 20, 20, 21)  # of the five predictors
CHUNK_BITS = 15
COUNT_TASKS, STEP_BYTES, ROUNDS, RIDGE = 12, 16_384, 2, 5.0
DOMAINS = 7
GATES, REFINE_STEPS = 64, 33
CLOSE = 0x20
# bytes of a token whose last four bytes of context reach past its start
HEAD = 3
PRIOR = 0.1
BASE, APART = 0x9E3779B97F4A7C15, 0xA24BAED4963EE407
SLICE_BYTES, HEADS_KEPT = 4 << 20, 2_000_000

SENT = ("block long, token binary, n_train array<bigint>, docs binary, doc_ids array<bigint>, "
        "held_out array<boolean>, n_tokens array<bigint>, n_bytes array<bigint>, digests array<binary>, head long, n long")


# windows: a byte of a token's head, below the four bytes before it

def streams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts as their model reads them, each behind ``HEAD`` + 1 blanks: tokens closed by blanks, one more for the end.
    The bytes, and the number of each one's text."""
    words = [b" ".join(t.lower().split()) for t in texts]
    coded = [b"    " + w + (b"  " if w else b" ") for w in words]
    return np.frombuffer(b"".join(coded), np.uint8), np.repeat(np.arange(len(texts)), [len(c) for c in coded])


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The windows of all heads, as numbers, and the text of each."""
    joined, owner = streams(texts)
    blank = joined == CLOSE
    head = np.zeros(len(joined), bool)
    for back in range(1, HEAD + 1):
        head[back:] |= blank[:-back]
    lead = np.flatnonzero(np.diff(owner, prepend=-1))
    for k in range(HEAD + 1):
        head[lead + k] = False
    at = np.flatnonzero(head)
    found = joined[at].astype(np.int64)
    for back in range(1, HEAD + 2):
        found |= joined[at - back].astype(np.int64) << (8 * back)
    return found, owner[at]


def slices(texts: list[bytes]):
    """Bounds of runs of texts of about ``SLICE_BYTES``."""
    low, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= SLICE_BYTES or i == len(texts) - 1:
            yield low, i + 1
            low, size = i + 1, 0


def counted_heads(texts: list[bytes], domain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows with the domain of their text (the last eighth of the number), and how often they occur."""
    kinds, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for low, high in slices(texts):
        found, owner = windows(texts[low:high])
        new, n = np.unique(found * (DOMAINS + 1) + domain[low:high][owner], return_counts=True)
        kinds, place = np.unique(np.concatenate([kinds, new]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([counts, n]), len(kinds)).astype(np.int64)
    return kinds, counts


def head_contexts(window: np.ndarray, domain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The coded byte of each window, and the hash of its context under each predictor, as ``contexts`` gives them for the
    other bytes."""
    before = [(window >> (8 * k)) & 255 for k in range(HEAD + 2)]
    wide = [b.astype(np.uint64) + np.uint64(1) for b in before]
    found = np.zeros((len(TABLE_BITS), len(window)), np.uint64)
    history = np.zeros(len(window), np.uint64)
    for order in range(1, len(TABLE_BITS)):
        history = history | (wide[order] << np.uint64(9 * (order - 1)))
        found[order - 1] = history
    base = np.uint64(BASE)
    one, two = wide[1] * base + np.uint64(1), (wide[2] + wide[1] * base) * base + np.uint64(2)
    found[-1] = np.where(before[1] == CLOSE, np.uint64(0), np.where(before[2] == CLOSE, one, two))
    return before[0].astype(np.uint8), found + (domain.astype(np.uint64) + np.uint64(1)) * np.uint64(APART)


def digest_of(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16).digest()


# texts to distinct tokens with postings

def _postings(texts: list[str], train: np.ndarray, domains: np.ndarray, n_domains: int):
    """The distinct tokens, where each one's documents begin and end, the documents, and how often training documents of
    each domain hold it. A block's texts are millions of words: each array over them goes as soon as the next is made."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string())))
    words, owner = lists.flatten(), pc.list_parent_indices(lists).to_numpy().astype("<u2")
    del lists
    full = pc.greater(pc.binary_length(words), 0)
    owner, words = owner[full.to_numpy(zero_copy_only=False)], words.filter(full)
    coded = words.dictionary_encode()
    del words, full
    key = coded.indices.to_numpy().astype(np.int64)
    dictionary = coded.dictionary
    del coded
    key *= len(texts)
    key += owner
    del owner
    key.sort()
    doc = (key % len(texts)).astype("<u2")
    key //= len(texts)
    cuts = np.searchsorted(key, np.arange(len(dictionary) + 1))
    learns = train[doc]
    key = key[learns]
    key *= n_domains
    key += domains[doc[learns]]
    return dictionary, cuts, doc, np.bincount(key, minlength=len(dictionary) * n_domains)


def _block(number: int, columns: list[list], n_domains: int, schema: pa.Schema):
    """One row of documents, then one row for each distinct token (the empty one is the end of a text): how often
    training documents of each domain hold it, and the documents that hold it, once for each time."""
    texts, doc_ids, held, domain = columns
    columns.clear()
    train, domains = ~np.array(held, bool), np.array(domain)
    dictionary, cuts, doc, learned = _postings(texts, train, domains, n_domains)
    n_tokens, n_words = len(dictionary), np.bincount(doc, minlength=len(texts))
    ends = np.bincount(domains[train], minlength=n_domains)
    n_texts, raw = len(texts), [t.encode("utf-8", "surrogatepass") for t in texts]
    del texts
    yield pa.RecordBatch.from_pylist([{
        "block": number, "doc_ids": doc_ids, "held_out": held, "n_tokens": (n_words + 1).tolist(),
        "n_bytes": [len(t) for t in raw], "digests": [digest_of(t) for t in raw]}], schema=schema)
    raw = [t for t, learn in zip(raw, train) if learn]
    pa.default_memory_pool().release_unused()
    heads, n_heads = counted_heads(raw, domains[train])
    del raw
    for low in range(0, len(heads), 100_000):
        n = len(heads[low:low + 100_000])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, number)), *[pa.nulls(n, f.type) for f in list(schema)[1:9]],
             pa.array(heads[low:low + n]), pa.array(n_heads[low:low + n])], schema=schema)
    yield pa.RecordBatch.from_pylist([{
        "block": number, "token": b"", "n_train": ends.tolist(),
        "docs": np.arange(n_texts, dtype="<u2").tobytes()}], schema=schema)
    packed = pa.py_buffer(doc)
    offsets = pa.py_buffer((2 * cuts).astype("<i4").tobytes())
    for low in range(0, n_tokens, 20_000):
        n = min(20_000, n_tokens - low)
        postings = pa.Array.from_buffers(pa.binary(), n, [None, offsets, packed], offset=low)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, number)), dictionary.slice(low, n).cast(pa.large_binary()).cast(pa.binary()),
             pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * n_domains, pa.int32()),
                                      pa.array(learned[low * n_domains:(low + n) * n_domains])), postings,
             *[pa.nulls(n, f.type) for f in list(schema)[4:]]], schema=schema)


def _blocks(n_domains: int, schema: pa.Schema):
    def run(batches):
        number, rows, size = None, [], 0
        for batch in batches:
            parts_, doc_ids, held, domain = (batch.column(c).to_pylist() for c in ("part", "doc_id", "held_out", "domain"))
            for i, text in enumerate(batch.column("text")):
                number = parts_[i] << 32 if number is None else number
                rows.append((text.as_py(), doc_ids[i], held[i], domain[i]))
                size += len(rows[-1][0])
                if size >= BLOCK_BYTES or len(rows) >= BLOCK_DOCS:
                    columns, rows, size = list(map(list, zip(*rows))), [], 0
                    yield from _block(number, columns, n_domains, schema)
                    number += 1
            batch = text = None
        if rows:
            columns, rows = list(map(list, zip(*rows))), []
            yield from _block(number, columns, n_domains, schema)
    return run


def domains_of(docs: DataFrame, held_out: Column) -> tuple[list[str], np.ndarray]:
    """The most frequent languages of training documents, and the share of each domain: theirs, then that of the rest if
    there is any."""
    counts = docs.where(~held_out).groupBy("lang").agg(F.count("*").alias("n"))
    top = counts.where("lang IS NOT NULL").orderBy(F.desc("n"), "lang").limit(DOMAINS).collect()
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rest = total - sum(r["n"] for r in top)
    n = np.array([r["n"] for r in top] + ([rest] if rest or not top else []), np.float64)
    return [r["lang"] for r in top], (n + 0.5) / (n + 0.5).sum()


def sent_tokens(spark: SparkSession, docs: DataFrame, held_out: Column, langs: list[str], n_domains: int) -> DataFrame:
    schema = pa.schema([("block", pa.int64()), ("token", pa.binary()), ("n_train", pa.list_(pa.int64())), ("docs", pa.binary()),
                        ("doc_ids", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())),
                        ("n_tokens", pa.list_(pa.int64())), ("n_bytes", pa.list_(pa.int64())),
                        ("digests", pa.list_(pa.binary())), ("head", pa.int64()), ("n", pa.int64())])
    domain = F.lit(n_domains - 1)
    for k, lang in enumerate(langs):
        domain = F.when(F.col("lang") == lang, k).otherwise(domain)
    rows = docs.select(F.spark_partition_id().cast("bigint").alias("part"), "doc_id", held_out.alias("held_out"),
                       domain.alias("domain"), whole("text").alias("text"))
    return written(spark, rows.mapInArrow(_blocks(n_domains, schema), SENT), "lm-tokens")


# the model

def contexts(tokens: list[bytes], domain: np.ndarray, skip: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every byte of the closed tokens, but for the first ``skip`` of each: the byte, the number of its token, and the
    hash of its context, in the token's domain, under each predictor. What stands before a token is not known here:
    bytes whose context reaches there (``HEAD`` of them) are for ``head_contexts``."""
    joined = np.frombuffer(b"".join(t + bytes([CLOSE]) for t in tokens), np.uint8)
    sizes = np.array([len(t) + 1 for t in tokens])
    starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = np.arange(len(joined)) - starts
    wide = joined.astype(np.uint64) + np.uint64(1)
    found = np.zeros((len(TABLE_BITS), len(joined)), np.uint64)
    history = np.zeros(len(joined), np.uint64)
    for order in range(1, len(TABLE_BITS)):
        before = np.zeros(len(joined), np.uint64)
        before[order:] = wide[:-order]
        before[place < order] = 0
        history = history | (before << np.uint64(9 * (order - 1)))
        found[order - 1] = history
    # hash of the token so far: a running polynomial, cut at the token's start by the inverse of its base there
    base = BASE
    inverse = pow(base, -1, 1 << 64)
    powers = np.ones(len(joined) + 1, np.uint64)
    powers[1:] = np.uint64(base)
    powers = np.multiply.accumulate(powers)
    backs = np.full(len(joined) + 1, inverse, np.uint64)
    backs[0] = 1
    backs = np.multiply.accumulate(backs)
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(wide * powers[:-1], dtype=np.uint64)])
    found[-1] = (running[:-1] - running[starts]) * backs[starts] * np.uint64(base) + place.astype(np.uint64)
    owner = np.repeat(np.arange(len(tokens)), sizes)
    if skip:
        joined, owner, found = joined[place >= skip], owner[place >= skip], found[:, place >= skip]
    return joined, owner, found + (domain[owner].astype(np.uint64) + np.uint64(1)) * np.uint64(APART)


def slots(joined: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Bits (byte by byte, first bit first) and their slot in each predictor's table: a hash of the context and the
    bits of the byte before this one."""
    shifts = np.arange(7, -1, -1)
    wide = joined.astype(np.int64)[:, None]
    bits = ((wide >> shifts) & 1).ravel()
    node = ((1 << (7 - shifts)) | (wide >> (shifts + 1))).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    at = []
    for k, size in enumerate(TABLE_BITS):
        mixed = (found[k] + np.uint64(k)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        spread = (mixed[:, None] ^ node) * np.uint64(0x9E3779B97F4A7C15)
        at.append((spread >> np.uint64(64 - size)).view(np.int64).ravel())
    return bits, at


def steps_of(tokens: list[bytes], domain: np.ndarray, weights: np.ndarray):
    """Tokens in small runs of about ``STEP_BYTES``."""
    low, size = 0, 0
    for i, token in enumerate(tokens):
        size += len(token) + 1
        if size >= STEP_BYTES or i == len(tokens) - 1:
            yield tokens[low:i + 1], domain[low:i + 1], weights[low:i + 1]
            low, size = i + 1, 0


def _training_steps(batches):
    """Bytes to learn from, in small steps: the byte, its contexts and its count. Tokens past their heads and windows, each
    once for every domain that has it."""
    for batch in batches:
        kept = batch.filter(pc.is_valid(batch.column("token")))
        if kept.num_rows:
            tokens = kept.column("token").to_pylist()
            counts = np.array(kept.column("c").to_pylist(), np.float64)
            at, domain = np.nonzero(counts)
            long = [i for i in range(len(at)) if len(tokens[at[i]]) >= HEAD]
            at, domain = at[long], domain[long]
            for part, where, c in steps_of([tokens[i] for i in at], domain, counts[at, domain]):
                joined, owner, found = contexts(part, where, HEAD)
                yield joined, found, c[owner]
        kept = batch.filter(pc.is_valid(batch.column("head")))
        heads, n = (kept.column(c).to_numpy(zero_copy_only=False) for c in ("head", "n"))
        for low in range(0, len(heads), STEP_BYTES):
            window, domain = np.divmod(heads[low:low + STEP_BYTES], DOMAINS + 1)
            yield *head_contexts(window, domain), n[low:low + STEP_BYTES].astype(np.float64)


def empty_tables() -> list[np.ndarray]:
    return [np.zeros((2, 1 << b)) for b in TABLE_BITS]


def add_counts(tables: list[np.ndarray], tokens: list[bytes], domain: np.ndarray, weights: np.ndarray) -> None:
    joined, owner, found = contexts(tokens, domain)
    add_bits(tables, joined, found, weights[owner])


def add_bits(tables: list[np.ndarray], joined: np.ndarray, found: np.ndarray, weights: np.ndarray) -> None:
    bits, at = slots(joined, found)
    c = np.repeat(weights, 8)
    for k, table in enumerate(tables):
        np.add.at(table.reshape(-1), bits * table.shape[1] + at[k], c)


def _count_tables(batches):
    """Bit counts of one task, in chunks of table slots."""
    tables = empty_tables()
    for step in _training_steps(batches):
        add_bits(tables, *step)
    width = 1 << CHUNK_BITS
    for k, table in enumerate(tables):
        for low in range(0, table.shape[1], width):
            part = table[:, low:low + width].astype("<f4")
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([low], pa.int64()),
                                                  pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], names=["k", "low", "counts"])


def _sum_chunks(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(zlib.decompress(b), "<f4").astype(np.float64) for b in table.column("counts").to_pylist())
    return pa.table({"k": pa.array([key[0].as_py()], pa.int32()), "low": pa.array([key[1].as_py()], pa.int64()),
                     "counts": pa.array([total.astype("<f4").tobytes()], pa.binary())})


def lookups(tables: list[np.ndarray], seen: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per predictor the log odds and the confidence of every slot. With ``seen`` occurrences of the coming bit taken
    out of its counts there is a table for either bit, zero first."""
    found = []
    for zero, one in tables:
        odds, sure = [], []
        for bit in (0, 1) if seen else (0,):
            o = np.maximum(one - seen * bit, 0.0)
            z = np.maximum(zero - seen * (1 - bit), 0.0)
            odds.append(np.clip(np.log((o + 0.3) / (z + 0.3)), -12, 12).astype(np.float32))
            sure.append(np.minimum(np.log2(o + z + 1.0), 7.0).astype(np.uint8))
        found.append((np.concatenate(odds), np.concatenate(sure)))
    return found


def inputs(found: list[tuple[np.ndarray, np.ndarray]], bits: np.ndarray, at: list[np.ndarray], seen: int):
    """Log odds of every predictor, one for each bit (a bias last), and the gate."""
    odds, sure = np.empty((len(found) + 1, bits.size), np.float32), []
    for k, (table, confidence) in enumerate(found):
        place = at[k] + bits * (len(table) // 2) if seen else at[k]
        odds[k] = table[place]
        if k >= len(found) - 2:
            sure.append(confidence[place])
    odds[-1] = 0.3
    return odds, (sure[0] * np.uint8(8) + sure[1]).astype(np.int64)


def mix(weights: np.ndarray, odds: np.ndarray, gate: np.ndarray) -> np.ndarray:
    by_input = np.ascontiguousarray(weights.T, np.float32)
    total = by_input[0][gate] * odds[0]
    for k in range(1, len(odds)):
        total += by_input[k][gate] * odds[k]
    return total


def squash(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -11.0, 11.0)))


def start_weights() -> np.ndarray:
    return np.full((GATES, len(TABLE_BITS) + 1), 1.0 / len(TABLE_BITS))


def learn_step(weights: np.ndarray, curved: np.ndarray, odds: np.ndarray, gate: np.ndarray, bits: np.ndarray, c: np.ndarray) -> None:
    """One online Newton step: the errors of the bits move the weights of their gates, against the curvature met so
    far."""
    p = squash(mix(weights, odds, gate))
    error, size = (bits - p) * c, len(odds)
    slope = np.stack([np.bincount(gate, error * odds[k], GATES) for k in range(size)], axis=1)
    heft = c * p * (1 - p)
    for i in range(size):
        scaled = heft * odds[i]
        for j in range(i + 1):
            part = np.bincount(gate, scaled * odds[j], GATES)
            curved[:, i, j] += part
            if i != j:
                curved[:, j, i] += part
    weights += np.linalg.solve(curved + RIDGE * np.eye(size), slope[:, :, None])[:, :, 0]


def _learn(tables, start: np.ndarray):
    def run(batches):
        weights, used, found_odds = start.copy(), np.zeros(GATES), None
        curved = np.zeros((GATES, start.shape[1], start.shape[1]))
        for joined, found, c in _training_steps(batches):
            found_odds = found_odds or lookups(tables.value, 1)
            bits, at = slots(joined, found)
            odds, gate = inputs(found_odds, bits, at, 1)
            each = np.repeat(c, 8)
            learn_step(weights, curved, odds, gate, bits, each)
            used += np.bincount(gate, each, GATES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(GATES)), pa.array(used),
                                          pa.array(weights.tolist(), pa.list_(pa.float64()))], names=["gate", "used", "w"])
    return run


def refine_place(mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower grid step of a mixed log odds in [-11, 11], and how far it lies towards the next."""
    x = (np.clip(mixed, -11, 11) + 11) / 22 * (REFINE_STEPS - 1)
    low = np.minimum(x.astype(np.int64), REFINE_STEPS - 2)
    return low, x - low


def _refine(tables, weights: np.ndarray):
    """What followed each mixed probability, by gate."""
    def run(batches):
        total, ones, found_odds = np.zeros((GATES, REFINE_STEPS)), np.zeros((GATES, REFINE_STEPS)), None
        for joined, found, c in _training_steps(batches):
            bits, at = slots(joined, found)
            found_odds = found_odds or lookups(tables.value, 1)
            odds, gate = inputs(found_odds, bits, at, 1)
            low, far = refine_place(mix(weights, odds, gate))
            w = np.repeat(c, 8)
            for step, share in ((low, 1 - far), (low + 1, far)):
                total += np.bincount(gate * REFINE_STEPS + step, w * share, GATES * REFINE_STEPS).reshape(total.shape)
                ones += np.bincount(gate * REFINE_STEPS + step, w * share * bits, GATES * REFINE_STEPS).reshape(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(GATES * REFINE_STEPS)), pa.array(total.ravel()), pa.array(ones.ravel())],
                                         names=["at", "total", "ones"])
    return run


def byte_scores(joined: np.ndarray, found: np.ndarray, found_odds: list, weights: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """log10 probability of each byte in its context."""
    bits, at = slots(joined, found)
    odds, gate = inputs(found_odds, bits, at, 0)
    mixed = mix(weights, odds, gate)
    place, far = refine_place(mixed)
    place += gate * REFINE_STEPS
    p = (squash(mixed) + flat[place] * (1 - far) + flat[place + 1] * far) / 2
    chosen = np.where(bits == 1, p, 1 - p).reshape(-1, 8)
    return np.log10(chosen.prod(axis=1, dtype=np.float64))


def token_scores(tokens: list[bytes], n_domains: int, found_odds: list, weights: np.ndarray, refined: np.ndarray,
                 skip: int = 0) -> np.ndarray:
    """log10 probability of each token past its first ``skip`` bytes, in each domain."""
    out = np.zeros((n_domains, len(tokens)))
    flat = refined.astype(np.float32).ravel()
    long = np.flatnonzero(np.array([len(t) >= skip for t in tokens], bool))
    coded = [tokens[i] for i in long]
    for k in range(n_domains):
        low = 0
        for part, domain, _ in steps_of(coded, np.full(len(coded), k), np.ones(len(coded))):
            joined, owner, found = contexts(part, domain, skip)
            by_byte = byte_scores(joined, found, found_odds, weights, flat)
            out[k, long[low:low + len(part)]] = np.bincount(owner, weights=by_byte, minlength=len(part))
            low += len(part)
    return out.T


def head_scores(window: np.ndarray, n_domains: int, found_odds: list, weights: np.ndarray, refined: np.ndarray) -> np.ndarray:
    """log10 probability of the byte of each window, in each domain."""
    out = np.zeros((len(window), n_domains), np.float32)
    flat = refined.astype(np.float32).ravel()
    for k in range(n_domains):
        for low in range(0, len(window), STEP_BYTES):
            part = window[low:low + STEP_BYTES]
            out[low:low + STEP_BYTES, k] = byte_scores(*head_contexts(part, np.full(len(part), k)), found_odds, weights, flat)
    return out


def _score_heads(n_domains: int, tables, weights: np.ndarray, refined: np.ndarray):
    """The heads of each text, in each domain. A task scores each window once, until it holds ``HEADS_KEPT``."""
    def run(batches):
        found_odds, known, scores = None, np.zeros(0, np.int64), np.zeros((0, n_domains), np.float32)
        for batch in batches:
            texts = [t.encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
            for low, high in slices(texts):
                found_odds = found_odds or lookups(tables.value, 0)
                part = texts[low:high]
                found, owner = windows(part)
                kinds, place = np.unique(found, return_inverse=True)
                new = np.setdiff1d(kinds, known, assume_unique=True)
                if len(known) + len(new) > HEADS_KEPT:
                    known, scores, new = known[:0], scores[:0], kinds
                known = np.concatenate([known, new])
                order = np.argsort(known)
                scores = np.concatenate([scores, head_scores(new, n_domains, found_odds, weights, refined)])[order]
                known = known[order]
                at = np.searchsorted(known, kinds)[place]
                sums = np.stack([np.bincount(owner, scores[at, k], len(part)) for k in range(n_domains)], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([digest_of(t) for t in part], pa.binary()), pa.array(list(sums), pa.list_(pa.float64()))],
                    names=["digest", "heads"])
    return run


def _score_vocabulary(n_domains: int, tables, weights: np.ndarray, refined: np.ndarray):
    def run(batches):
        found_odds = None
        for batch in batches:
            if batch.num_rows:
                found_odds = found_odds or lookups(tables.value, 0)
                scores = token_scores(batch.column("token").to_pylist(), n_domains, found_odds, weights, refined, HEAD)
                c = np.array(batch.column("c").to_pylist(), np.int64).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("token"), pa.array(c), pa.array([row.tobytes() for row in scores.astype("<f4")], pa.binary())],
                    names=["token", "c", "scores"])
    return run


def train(spark: SparkSession, vocabulary: DataFrame, heads: DataFrame):
    """Count tables (broadcast; their size is fixed), weights by gate, refinement by gate."""
    known = vocabulary.where(F.exists("c", lambda n: n > 0))
    learned = known.unionByName(heads, allowMissingColumns=True).coalesce(COUNT_TASKS)
    chunks = (learned.mapInArrow(_count_tables, "k int, low long, counts binary").groupBy("k", "low")
              .applyInArrow(_sum_chunks, "k int, low long, counts binary").toArrow())
    tables = [np.zeros((2, 1 << b), np.float32) for b in TABLE_BITS]
    for k, low, counts in zip(*(chunks.column(c).to_pylist() for c in ("k", "low", "counts"))):
        part = np.frombuffer(counts, "<f4").reshape(2, -1)
        tables[k][:, low:low + part.shape[1]] = part
    shared = spark.sparkContext.broadcast(tables)
    weights = start_weights()
    for _ in range(ROUNDS):
        found = learned.mapInArrow(_learn(shared, weights), "gate long, used double, w array<double>").collect()
        total, used = np.zeros_like(weights), np.zeros(GATES)
        for gate, n, w in sorted(found):
            total[gate] += n * np.array(w)
            used[gate] += n
        weights = np.where(used[:, None] > 0, total / np.maximum(used, 1e-12)[:, None], weights)
    summed = learned.mapInArrow(_refine(shared, weights), "at long, total double, ones double").groupBy("at").agg(
        F.sum("total").alias("total"), F.sum("ones").alias("ones")).collect()
    refined = np.tile(squash(np.linspace(-11, 11, REFINE_STEPS)), (GATES, 1)).ravel()
    for at, total, ones in summed:
        refined[at] = (ones + 4 * refined[at]) / (total + 4)
    return shared, weights, np.clip(refined.reshape(GATES, REFINE_STEPS), 1e-5, 1 - 1e-5)


# back to the documents

OUT = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]
GATHERED = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
            "n_bytes long, digest binary, tails array<double>")


def _gather(n_train: int, kinds: int, n_domains: int):
    scale = math.log10(n_train + PRIOR * (kinds + 1))

    def run(key: tuple[pa.Scalar, ...], postings: pa.Table, about: pa.Table) -> pa.Table:
        row = about.to_pylist()[0]
        n = len(row["doc_ids"])
        packed = postings.column("docs").to_pylist()
        sizes = [len(b) // 2 for b in packed]
        docs = np.frombuffer(b"".join(packed), "<u2").astype(np.int64)
        c = np.repeat(postings.column("c").to_numpy().astype(np.float64), sizes)
        by_token = np.frombuffer(b"".join(postings.column("scores").to_pylist()), "<f4").astype(np.float64).reshape(-1, n_domains)
        tails = np.stack([np.bincount(docs, np.repeat(by_token[:, k], sizes), n) for k in range(n_domains)], axis=1)
        n_tokens = np.array(row["n_tokens"], np.int64)
        return pa.table({
            "doc_id": pa.array(row["doc_ids"], pa.int64()), "held_out": pa.array(row["held_out"]), "n_tokens": n_tokens,
            "n_known": np.bincount(docs, c > 0, n).astype(np.int64), "train_tokens": np.full(n, n_train),
            "base_score": np.bincount(docs, np.log10(c + PRIOR), n) - n_tokens * scale,
            "n_bytes": pa.array(row["n_bytes"], pa.int64()), "digest": pa.array(row["digests"], pa.binary()),
            "tails": pa.array(list(tails), pa.list_(pa.float64()))})
    return run


def mixed_domains(rows: DataFrame, shares: np.ndarray) -> DataFrame:
    """``OUT``: the probability of a text is the mixture of its domains' ones."""
    logs = F.array(*[F.lit(float(x)) for x in np.log10(shares)])
    added = F.zip_with(F.zip_with("tails", "heads", lambda a, b: a + b), logs, lambda a, b: a + b)
    best = rows.withColumn("by_domain", added).withColumn("best", F.array_max("by_domain"))
    powers = F.transform("by_domain", lambda x: F.pow(F.lit(10.0), x - F.col("best")))
    total = F.col("best") + F.log10(F.aggregate(powers, F.lit(0.0), lambda a, x: a + x))
    return best.withColumn("score", total).withColumn(
        "bits_per_byte", -F.col("score") / math.log10(2) / F.greatest("n_bytes", F.lit(1))).select(*OUT)


def lm_scores(spark: SparkSession, docs: DataFrame, held_out: Column) -> DataFrame:
    """One row (columns ``OUT``) for each row of ``docs``; rows marked held out are scored, not learned."""
    langs, shares = domains_of(docs, held_out)
    sent = sent_tokens(spark, docs, held_out, langs, len(shares))
    tokens = sent.where("token IS NOT NULL")
    sums = F.array(*[F.sum(F.get("n_train", F.lit(k))) for k in range(len(shares))])
    vocabulary = written(spark, tokens.groupBy("token").agg(sums.alias("c")), "lm-vocabulary")
    count = F.aggregate("c", F.lit(0).cast("bigint"), lambda a, n: a + n)
    known = vocabulary.select(count.alias("c")).agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    heads = written(spark, sent.where("head IS NOT NULL").groupBy("head").agg(F.sum("n").alias("n")), "lm-heads")
    model = train(spark, vocabulary, heads)
    scored = written(spark, vocabulary.mapInArrow(_score_vocabulary(len(shares), *model), "token binary, c long, scores binary"),
                     "lm-scored")
    back = tokens.select("block", "token", "docs").join(scored, "token").select("block", "docs", "c", "scores")
    about = sent.where("doc_ids IS NOT NULL").select(
        F.col("block").alias("about_block"), "doc_ids", "held_out", "n_tokens", "n_bytes", "digests")
    rows = back.groupBy("block").cogroup(about.groupBy("about_block")).applyInArrow(
        _gather(known["n"], known["v"], len(shares)), GATHERED)
    texts = docs.select(whole("text").alias("text")).mapInArrow(
        _score_heads(len(shares), *model), "digest binary, heads array<double>")
    return mixed_domains(rows.join(written(spark, texts, "lm-texts").dropDuplicates(["digest"]), "digest"), shares)


def contract_fold() -> Column:
    return F.pmod(doc_crc(), F.lit(10)) == 0
