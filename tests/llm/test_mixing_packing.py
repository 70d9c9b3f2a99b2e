"""Mixing and packing against plain versions."""
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cohortqc.llm import mixing as M
from cohortqc.llm import packing as P
from tests.llm.fixture import counter, rows, table

BPE = public_tokenizers.path("byte_bpe_50k.json")


def cycle_by_hand(q):
    """Earliest deadline first over one cycle; ties by name."""
    total, done, order = sum(q.values()), dict.fromkeys(q, 0), []
    for t in range(total):
        ready = [(-(-(n + 1) * total // q[s]), s) for s, n in done.items() if n < q[s] and n * total // q[s] <= t]
        order.append(min(ready)[1])
        done[order[-1]] += 1
    return order


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 1, "b": 1}, {"a": 5, "b": 3, "c": 0.5, None: 1}, {f"s{i}": i * i + 1 for i in range(25)}])
def test_less_than_one_block_off_at_every_slot(spark, weights):
    shares = M.shares(M.given_targets(spark, weights))
    q = {r.mix_source: r.q for r in shares.collect()}
    slots = sorted((r.turn_slot, r.mix_source, r.turn) for r in M.cycle_slots(shares).collect())
    total = sum(q.values())
    assert [s for s, *_ in slots] == list(range(total))
    done = dict.fromkeys(q, 0)
    for t, source, turn in slots:
        assert turn == done[source]
        done[source] += 1
        for s in q:
            assert abs(done[s] - q[s] * (t + 1) / total) < 1
        assert turn * total // q[source] <= t < -(-(turn + 1) * total // q[source])
    assert [s for _, s, _ in slots] == cycle_by_hand(q)


def test_every_row_gets_its_place(spark):
    docs = table(spark).repartition(6)
    got = M.mixed(spark, docs, M.root_targets(docs)).collect()
    key = lambda s: "-" if s is None else f"={s}"
    shares = {r.mix_source: r.q for r in M.shares(M.root_targets(docs)).collect()}
    order, by_source = cycle_by_hand(shares), {}
    turns = {s: [t for t, x in enumerate(order) if x == s] for s in shares}
    for d, _, _, s, *_ in rows():
        by_source.setdefault(key(s), []).append((hashlib.md5(("" if d is None else str(d)).encode()).hexdigest(), d or -1, d, s))
    want = []
    for k, members in by_source.items():
        for rank, (*_, d, s) in enumerate(sorted(members, key=lambda m: m[:2])):
            block = rank // M.BLOCK_DOCS
            want.append((d, s, rank, block, block // shares[k] * len(order) + turns[k][block % shares[k]], rank % M.BLOCK_DOCS))
    assert counter((r.doc_id, r.source, r.source_rank, r.block, r.slot, r.place) for r in got) == counter(want)


def test_sources_without_a_target_come_last(spark):
    docs = table(spark)
    out = M.mix_rows(spark, docs, M.given_targets(spark, {"s0": 1.0, "s1": 2.0}))
    assert out.columns == docs.columns
    found = [(r.doc_id, r.text, r.source) for r in out.collect()]
    assert counter(found) == counter((r[0], r[1], r[3]) for r in rows())
    named = [s in ("s0", "s1") for *_, s in found]
    assert named == sorted(named, reverse=True)
    with pytest.raises(ValueError):
        M.given_targets(spark, {"a": 0})


def test_mixing_uses_no_python(spark):
    docs = table(spark)
    plan = M.mixed(spark, docs, M.root_targets(docs))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan


def test_empty_tables(spark):
    docs = table(spark, [])
    assert M.mixed(spark, docs, M.root_targets(docs)).count() == 0
    assert M.mix_rows(spark, docs, M.root_targets(docs)).count() == 0
    assert P.pack_documents(spark, docs, BPE).count() == 0


ODD = ["", " ", "  ", "a  b", "a \n b", "\n\n a\n\n\nb ", "x\x85y \x1c z", "it's  we'll\t'tis", "<|endoftext|>", "a  <|endoftext|> b",
       "1234 56", "ab　cd  ef", "é" * 100, "漢字かな混じり文", "a" * 500, "... ?! --", "  x", "​zero​", "﻿ b", "🙂 🙂🙂"]


def test_remembered_chunks_give_the_tokenizers_ids():
    tokenizer, plain = P.ByteBpe(BPE), Tokenizer.from_file(BPE)
    rnd = random.Random(2)
    alphabet = ["a", "B", "é", " ", "  ", "\n", "\t", "'s", "9", ".", " ", " ", "\x1c", "\x85", "漢", "<|endoftext|>", "\r\n"]
    texts = ODD + ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(40))) for _ in range(3000)]
    for low in range(0, len(texts), 100):
        part = texts[low:low + 100]
        for text, ids in zip(part, tokenizer.ids(part)):
            assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def best_fit_by_hand(lengths, capacity):
    left, out = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [(room, b) for b, room in enumerate(left) if room >= lengths[i]]
        b = min(fits)[1] if fits else len(left)
        if not fits:
            left.append(capacity)
        out[i] = left[b]
        left[b] -= lengths[i]
    return len(left), [out[i] for i in range(len(lengths))]


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_takes_the_tightest_bin(seed):
    rnd = random.Random(seed)
    lengths = [rnd.randint(1, rnd.choice([5, 60, 100])) for _ in range(400)]
    placed = P.best_fit(lengths, 100)
    bins, room = best_fit_by_hand(lengths, 100)
    assert len({b for b, _ in placed}) == bins
    assert [100 - o for _, o in placed] == room  # the same room was taken by each item


def test_packing(spark):
    given_rows = rows()
    got = P.pack_documents(spark, table(spark).repartition(4), BPE).collect()
    plain = Tokenizer.from_file(BPE)
    want = []
    for d, t, *_ in given_rows:
        ids, start = plain.encode(t or "", add_special_tokens=False).ids + [0], 0
        lengths = ([len(ids) % 2048] if len(ids) % 2048 else []) + [2048] * (len(ids) // 2048)
        for piece, n in enumerate(lengths):
            want.append((d, piece, start, n, zlib.crc32(np.array(ids[start:start + n], "<u4").tobytes())))
            start += n
    assert counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == counter(want)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    total = sum(r.length for r in got)
    assert len(bins) <= -(-total // 2048) + 2


def test_sequences_hold_the_ids(spark):
    pieces = P.packed(spark, P.tokenised_pieces(spark, table(spark), BPE, with_ids=True))
    ids = {r.sequence_id: r.ids for r in P.sequences(pieces).collect()}
    for r in pieces.collect():
        part = ids[r.sequence_id][r.offset:r.offset + r.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32


def test_unknown_chunks_reach_the_tokenizer_in_short_runs(monkeypatch):
    """Its time a chunk grows with the length of the run."""
    tokenizer, lengths = P.ByteBpe(BPE), []
    encode = tokenizer._encode
    monkeypatch.setattr(tokenizer, "_encode", lambda texts: lengths.extend(len(t) for t in texts) or encode(texts))
    text = " ".join(f"word{k:05}x" for k in range(6000))
    [got] = tokenizer.ids([text])
    assert max(lengths) <= 16_384
    assert np.frombuffer(got, "<u4").tolist() == Tokenizer.from_file(BPE).encode(text, add_special_tokens=False).ids


def test_chunks_that_end_in_signs_share_their_stem(monkeypatch):
    """The tokenizer meets a word once, whatever signs close it; ids are those of the whole text all the same."""
    tokenizer, plain, met = P.ByteBpe(BPE), Tokenizer.from_file(BPE), []
    monkeypatch.setattr(tokenizer, "_encode_words", lambda words, f=tokenizer._encode_words: (met.extend(words), f(words))[1])
    text = "alpha alpha, alpha. alpha.*** alpha beta, it's 's ' , a1, \u00e9t\u00e9! \u0416\u0436. \U0001F600! x\u00b2, don't' \"q\" ..a.. \n,\nb,"
    long = "w" * 60
    for t in (text, f"{long}, {long}. {long}", f" {long},"):
        assert tokenizer.ids([t])[0] == np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    assert met.count(" alpha") == 1 and not [w for w in met if w.startswith(" alpha") and w != " alpha"]
    assert not [c for c in tokenizer.known if len(c) > P.CACHE_CHARS]
    letters = random.Random(5)
    for _ in range(300):
        t = "".join(letters.choices("aZ\u00e9\u00aa\u0250\u02b0 '.,!*#\n1\u00b2s\u0301\u4e2d", k=40))
        assert tokenizer.ids([t])[0] == np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t
