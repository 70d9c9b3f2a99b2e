"""Learning of the language-model scores sees every bit."""
import numpy as np
from pyspark.sql import functions as F

from cohortqc.llm import lm_scoring as LM


def test_curvature_is_that_of_all_bits():
    rnd, n, size = np.random.default_rng(3), 800, len(LM.TABLE_BITS) + 1
    odds, gate = rnd.normal(0, 2, (size, n)).astype(np.float32), np.tile(np.arange(8), n // 8)  # a gate for each bit of a byte
    bits, c = rnd.integers(0, 2, n), rnd.integers(1, 5, n).astype(float)
    weights = LM.start_weights()
    p = LM.squash(LM.mix(weights, odds, gate))
    want = np.zeros((LM.GATES, size, size))
    for e in range(n):
        want[gate[e]] += c[e] * p[e] * (1 - p[e]) * np.outer(odds[:, e], odds[:, e])
    curved = np.zeros_like(want)
    LM.learn_step(weights, curved, odds, gate, bits, c)
    assert np.allclose(curved, want, rtol=1e-4)


def test_a_predictor_sees_four_bytes():
    joined, _, found = LM.contexts([b"abcde", b"xbcde", b"abcdz", b"qabcdz"], np.zeros(4, int))
    last = np.flatnonzero(joined == LM.CLOSE) - 1  # of the last byte of each token
    assert len(found) == 5 and LM.ROUNDS == 2
    assert found[2][last[0]] == found[2][last[1]] and found[3][last[0]] != found[3][last[1]]
    assert found[3][last[2]] == found[3][last[3]] and found[4][last[2]] != found[4][last[3]]


TEXTS = [b"The cat  sat\ton a mat", b"a mat on sat cat the", b"", b" x ", "no été abcdefgh\n".encode()]


def test_every_byte_is_coded_once_with_four_bytes_of_the_text_before_it():
    stream = {t: b"    " + b"".join(w + b" " for w in t.lower().split()) + b" " for t in TEXTS}
    found, owner = LM.windows(TEXTS)
    for k, text in enumerate(TEXTS):
        s = stream[text]
        heads = [p for p in range(4, len(s)) if b" " in s[p - 3:p]]
        assert [int.from_bytes(s[p - 4:p + 1]) for p in heads] == found[owner == k].tolist()
        tokens = s[4:-1].split(b" ")[:-1] + [b""]
        tails = LM.contexts(tokens, np.zeros(len(tokens), int), LM.HEAD)[0]
        rest = bytes(s[p] for p in range(4, len(s)) if p not in heads)
        assert bytes(tails[:len(rest)]) == rest and len(rest) == sum(max(0, len(t) + 1 - LM.HEAD) for t in tokens)


def test_heads_and_tails_share_the_contexts_within_a_token():
    [one] = [w for w in LM.windows([b"abcd"])[0] if w & 0xFFFF == int.from_bytes(b"bc")]
    coded, found = LM.head_contexts(np.array([one]), np.array([2]))
    joined, _, whole = LM.contexts([b"abcd"], np.array([2]))
    assert coded[0] == joined[2] and found[[0, 1, 4], 0].tolist() == whole[[0, 1, 4], 2].tolist()
    first = [LM.head_contexts(np.array([LM.windows([text])[0][2]]), np.array([2])) for text in (b"y abcd", b"z abcd")]
    assert [c[0] for c, _ in first] == [ord("a")] * 2 and (first[0][1] != first[1][1]).ravel().tolist() == [False, True, True, True, False]


def test_the_order_of_words_changes_the_score(spark):
    docs = [(i, "the cat sat on the mat", "en") for i in range(30)] + [(100, "mat the on sat cat the", "en"), (101, None, None)]
    rows = LM.lm_scores(spark, spark.createDataFrame(docs, "doc_id long, text string, lang string"), F.col("doc_id") >= 100).collect()
    score = {r.doc_id: r.score for r in rows}
    assert len(rows) == 32 and len({score[i] for i in range(30)}) == 1 and score[0] > score[100] + 1


def test_a_block_lets_its_words_go():
    """Once the first rows of a block leave, its words are no longer held: only distinct tokens and places of documents are."""
    import pyarrow as pa
    texts = [" ".join(f"w{(i * j) % 97} Other\tword  ä" for j in range(400)) for i in range(600)]
    n, size = len(texts), sum(len(t.encode()) for t in texts)
    rows = pa.table({"part": pa.array([2] * n), "text": texts, "doc_id": pa.array(range(n)), "held_out": [i % 4 == 0 for i in range(n)],
                     "domain": [i % 2 for i in range(n)]})
    longs = pa.list_(pa.int64())
    schema = pa.schema([("block", pa.int64()), ("token", pa.binary()), ("n_train", longs), ("docs", pa.binary()), ("doc_ids", longs),
                        ("held_out", pa.list_(pa.bool_())), ("n_tokens", longs), ("n_bytes", longs),
                        ("digests", pa.list_(pa.binary())), ("head", pa.int64()), ("n", pa.int64())])
    batches = rows.to_batches()
    before = pa.total_allocated_bytes()
    found = LM._blocks(2, schema)(batches)
    out = [next(found)]
    assert pa.total_allocated_bytes() - before < size / 2
    out += found
    got = {t: (c, np.frombuffer(d, "<u2").tolist()) for b in out for t, c, d in zip(*(b.column(c).to_pylist() for c in ("token", "n_train", "docs"))) if t}
    split = [t.encode().lower().split() for t in texts]
    assert set(got) == {w for t in split for w in t}
    for word in (b"w5", b"other", "ä".encode()):
        assert got[word][1] == [i for i, t in enumerate(split) for w in t if w == word]
        assert got[word][0] == [sum(t.count(word) for i, t in enumerate(split) if i % 4 and i % 2 == k) for k in range(2)]

