"""Spelling variants against a plain version."""
import collections
import random
import re
import zlib

from cohortqc.llm import spelling as S
from tests.llm.fixture import counter, lower, rows, small, table

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    """One inserted, deleted or replaced code point apart."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def words_by_hand(given_rows, one_in=None):
    count = collections.Counter()
    for d, t, *_ in given_rows:
        for run in RUN.findall(t or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if one_in and h % one_in == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}


def groups_by_hand(vocab, ratio=10):
    beside = {w: [v for v in vocab if near(w, v)] for w in vocab}
    form = {}
    for w in vocab:
        best = min(beside[w], key=lambda v: (-vocab[v], v), default=None)
        if best is not None and vocab[best] >= ratio * vocab[w]:
            form[w] = best
    out = []
    for w, n in vocab.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, n, len(beside[w]), form.get(w), vocab[form[w]] if w in form else None, root))
    return out


def as_rows(df):
    return counter(df.select("word", "n", "n_near", "form", "form_n", "root").collect())


def spelled(seed=5, docs=120):
    """Words of a small alphabet, so that many are near each other, with slips in all places."""
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abé") for _ in range(rnd.randrange(6, 12))) for _ in range(60)]

    def slip(w):
        at, kind = rnd.randrange(len(w) + 1), rnd.randrange(4)
        return [w, w[:at] + "x" + w[at:], w[:at] + w[at + 1:], w[:at] + "b" + w[at + 1:]][kind]

    out = []
    for i in range(docs):
        words = [base[min(int(rnd.expovariate(0.12)), 59)] for _ in range(60)]
        words = [slip(w) if rnd.random() < 0.1 else w for w in words]
        out.append((i, " ".join(w.upper() if rnd.random() < 0.1 else w for w in words)))
    return out


def test_near_pairs_against_all_pairs(spark):
    rnd = random.Random(3)
    words = {"".join(rnd.choice("abcé") for _ in range(rnd.randrange(7, 11))) for _ in range(250)}
    words |= {w[:i] + c + w[j:] for w in list(words)[:60] for i in (0, 3, len(w)) for j in (i, i + 1) for c in ("", "z")}
    words = {w for w in words if len(w) >= 7}
    got = S.near_pairs(spark.createDataFrame([(w, 1) for w in words], "word string, n long")).collect()
    pairs = [frozenset((r.word, r.near)) for r in got]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {frozenset((a, b)) for a in words for b in words if a < b and near(a, b)}


def test_every_edit_of_long_and_short_words(spark):
    """Each place of an edit, each length: no quarter is missed."""
    words, pairs = set(), set()
    for length in range(7, 20):
        word = "".join(chr(ord("a") + i) for i in range(length))
        for i in range(length + 1):
            for other in (word[:i] + "é" + word[i:], word[:i] + "é" + word[i + 1:], word[:i] + word[i + 1:]):
                if len(other) >= 7 and other != word:
                    words |= {word, other}
                    pairs.add(frozenset((word, other)))
    got = S.near_pairs(spark.createDataFrame([(w, 1) for w in words], "word string, n long")).collect()
    assert pairs <= {frozenset((r.word, r.near)) for r in got}


def test_groups_against_plain(spark):
    given = spelled()
    for one_in in (None, 31, 3):
        got = S.spelling_variants(spark, small(spark, given), slip_one_in=one_in)
        want = groups_by_hand(words_by_hand(given, one_in))
        assert any(r[3] for r in want) and as_rows(got) == counter(want)


def test_fixture_table(spark):
    got = S.spelling_variants(spark, table(spark).repartition(5), slip_one_in=31)
    assert as_rows(got) == counter(groups_by_hand(words_by_hand(rows(), 31)))


def test_long_chain_of_forms(spark):
    """Eight forms in a row, each ten times as frequent as the one before."""
    vocab = {"abcdefghijklmnop"[:8 + i]: 10 ** i for i in range(9)}
    got = S.group_variants(spark, spark.createDataFrame(list(vocab.items()), "word string, n long"))
    assert as_rows(got) == counter(groups_by_hand(vocab))
    assert {r.root for r in got.collect()} == {"abcdefghijklmnop"}


def test_ties_take_the_first_word(spark):
    vocab = {"aaaaaaa": 1, "aaaaaab": 50, "aaaaaac": 50, "baaaaaa": 49}
    got = {r.word: r for r in S.group_variants(spark, spark.createDataFrame(list(vocab.items()), "word string, n long")).collect()}
    assert got["aaaaaaa"].form == "aaaaaab" and got["aaaaaaa"].n_near == 3 and got["aaaaaac"].form is None


def test_empty_null_and_very_long(spark):
    assert S.spelling_variants(spark, table(spark, [])).count() == 0
    assert S.spelling_variants(spark, small(spark, [(1, None), (None, ""), (2, "short")])).count() == 0
    long = "x" * 200_000
    got = S.spelling_variants(spark, small(spark, [(1, long), (2, long + " " + long[:-1]), (3, long[:-1])]))
    assert sorted((len(r.word), r.n, r.n_near) for r in got.collect()) == [(199_999, 2, 1), (200_000, 2, 1)]


def test_long_words_are_compared_alike(spark, monkeypatch):
    """The comparison for long words gives what the edit distance gives."""
    monkeypatch.setattr(S, "LONG_WORD", 0)
    test_every_edit_of_long_and_short_words(spark)
    rnd = random.Random(9)
    words = {"".join(rnd.choice("ab") for _ in range(rnd.randrange(7, 10))) for _ in range(150)}
    got = S.near_pairs(spark.createDataFrame([(w, 1) for w in words], "word string, n long")).collect()
    assert {frozenset((r.word, r.near)) for r in got} == {frozenset((a, b)) for a in words for b in words if a < b and near(a, b)}


def test_no_pair_is_made_by_a_cross_join(spark):
    vocab = spark.createDataFrame([("aaaaaaa", 1)], "word string, n long")
    plan = S.near_pairs(vocab)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
