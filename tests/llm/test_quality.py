"""Quality rules against plain counts and a plain minimum-covariance-determinant fit."""
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortqc.llm import quality_rules as Q
from cohortqc.llm.common import written
from tests.llm.fixture import WORD, counter, prose, rows, small, table


def counts_by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    times = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if times[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in Q.SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered))


def test_counts(spark):
    given_rows = rows()
    got = Q.quality_rules(spark, table(spark).repartition(3))
    want = []
    for d, t, *_ in given_rows:
        n = counts_by_hand(t)
        want.append((d, *n, n[0] < 50 or 100 * n[4] > 50 * n[0]))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert counter(got.select(*names).collect()) == counter(want)
    assert got.where("base_failed AND kept").count() == 0


@pytest.mark.parametrize("text", ["a b a b a b a b", "a b c a b c a b", "a b c d a b c", "x x x x", "x x x", "a b", "a",
                                  "a b c b c a b c b", "p q r s p q r s p q r"])
def test_repeats(spark, text):
    got = small(spark, [(1, text)]).select(Q.counts(F.col("text"))["n_repeat_words"].alias("n")).first().n
    assert got == counts_by_hand(text)[4]


def corpus(n=400, bad=40):
    rnd, out = random.Random(3), []
    for i in range(n):
        text = prose(i, 60 + rnd.randrange(300), 5000)
        if i < bad:
            text = " ".join(w + "###" for w in text.split())
        out.append((i, text, "en" if i % 2 else None, f"s{i % 3}" if i % 40 else "rare", None, 5, "x", True, "g", "d", "n", 1, 2, "w"))
    return out


def features(text):
    n = counts_by_hand(text)
    lines = len([x for x in text.split("\n") if WORD.search(x)])
    share = lambda a, b: np.arcsin(np.sqrt(min(a / max(b, 1), 1)))
    return [np.log(max(n[1] / max(n[0], 1), 1)), share(n[2], n[1]), share(n[3], lines), share(n[4], n[0])]


def fit_by_hand(x):
    """Minimum covariance determinant with many random starts, exact order statistics and matrix algebra."""
    floor, h, rnd = np.array([Q.FLOORS[f] for f in Q.FEATURES]), int(np.ceil(Q.CORE * len(x))), np.random.default_rng(1)

    def raised(c):
        c = c.copy()
        np.fill_diagonal(c, np.maximum(np.diag(c), floor ** 2))
        return c

    def step(m, c):
        d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
        core = x[np.argsort(d, kind="stable")[:h]]
        return core.mean(axis=0), raised(np.cov(core.T, bias=True) * Q.CONSISTENCY)

    def settled(m, c):
        while True:
            after = step(m, c)
            if np.linalg.slogdet(after[1])[1] >= np.linalg.slogdet(c)[1] - Q.SETTLED:
                return m, c
            m, c = after
    starts = [x[rnd.choice(len(x), Q.START_ROWS, replace=False)] for _ in range(100)]
    found = [settled(*step(*step(s.mean(axis=0), raised(np.cov(s.T, bias=True))))) for s in starts]
    m, c = min(found, key=lambda f: np.linalg.slogdet(f[1])[1])
    return m, np.linalg.inv(c), np.linalg.slogdet(c)[1]


def test_outliers_against_a_plain_fit(spark):
    given_rows = corpus()
    got = {r.doc_id: r for r in Q.quality_rules(spark, table(spark, given_rows)).collect()}
    groups = {}
    for r in given_rows:
        groups.setdefault((r[2], r[3]), []).append(r)
    checked = 0
    for key, members in groups.items():
        if len(members) < Q.MIN_ROWS:
            continue
        x = np.array([features(r[1]) for r in members])
        m, inverse, _ = fit_by_hand(x)
        for r, v in zip(members, x):
            want = (v - m) @ inverse @ (v - m)
            assert got[r[0]].distance == pytest.approx(want, rel=0.02, abs=0.02)
            checked += 1
    assert checked > 300
    assert all(got[i].kept == (i >= 40) for i in range(400))


def crowded(n=600):
    """Two fifths of the points in a tight cloud aside: the medians' start is drawn towards it."""
    rnd = np.random.default_rng(5)
    main = rnd.normal([1.5, 0.5, 1.0, 0.8], [0.3, 0.2, 0.4, 0.5], (n - n // 5, 4))
    return np.vstack([main, rnd.normal([3.0, 1.4, 3.0, 3.0], 0.1, (n // 5, 4))])


def test_least_determinant_of_all_starts(spark):
    x = crowded()
    columns = ["grp string", "draw long", *[f"x_{f} double" for f in Q.FEATURES]]
    draws = random.Random(2)
    rows_ = written(spark, spark.createDataFrame([("g", draws.getrandbits(63), *map(float, v)) for v in x], ", ".join(columns)), "test-rows")
    factors = Q._factored(Q._start(spark, rows_).unionByName(Q._drawn_starts(rows_)), 1.0)
    assert sorted(r.start for r in factors.collect()) == list(range(Q.STARTS + 1))
    for _ in range(Q.SCREEN_STEPS):
        factors = Q._concentrate(spark, rows_, factors)
    least = min(factors.collect(), key=lambda r: (r.logdet, r.start))
    got = Q._settled(spark, rows_, factors.where(F.col("start") == least.start)).first()
    m, _, logdet = fit_by_hand(x)
    assert got.logdet <= least.logdet and got.logdet == pytest.approx(logdet, abs=0.02)
    assert [got.m_0, got.m_1, got.m_2, got.m_3] == pytest.approx(list(m), abs=0.02)


def test_equal_hashes_need_equal_words(spark, monkeypatch):
    """With every window on one hash, neighbours still count by their words alone: nothing is counted too often."""
    monkeypatch.setattr(Q.F, "xxhash64", lambda *c: F.lit(7).cast("bigint"))
    got = small(spark, [(1, "a b c d e f g h"), (2, "a a a a")]).select("doc_id", Q.counts(F.col("text"))["n_repeat_words"].alias("n")).collect()
    assert {r.doc_id: r.n for r in got} == {1: 0, 2: 4}


def test_small_groups_use_their_language_then_the_base_rule(spark):
    given_rows = corpus() + [(1000 + i, prose(i, 100), "xx", "s1", None, 5, "x", True, "g", "d", "n", 1, 2, "w") for i in range(3)]
    got = {r.doc_id: r for r in Q.quality_rules(spark, table(spark, given_rows)).collect()}
    assert got[40].distance is not None  # source "rare", judged by its language
    assert got[1000].distance is None and got[1000].kept


def test_stage_keeps_columns_and_verdicts(spark):
    docs = table(spark, corpus())
    kept = Q.keep_good(spark, docs)
    assert kept.columns == docs.columns
    verdicts = {r.doc_id for r in Q.quality_rules(spark, docs).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == verdicts and kept.count() == 360


def test_empty_table(spark):
    assert Q.quality_rules(spark, table(spark, [])).count() == 0 and Q.keep_good(spark, table(spark, [])).count() == 0


def test_no_python_on_the_main_path(spark):
    plan = Q.quality_rules(spark, table(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
