"""Line dedup against a plain version."""
import collections
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortqc.llm import line_dedup as L
from tests.llm.fixture import counter, lower, rows, small, table


def key(line):
    return lower(line.strip(" \t\n\x0b\x0c\r"))


def lines_by_hand(given_rows, min_docs, min_chars=1, keep_first=False):
    """doc_id, lines, dropped positions, kept text of every row."""
    nodes = {(d, t or "") for d, t, *_ in given_rows}
    holders = collections.defaultdict(set)
    for d, t in nodes:
        for line in t.split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add((d, t))
    frequent = {k for k, who in holders.items() if len(who) >= min_docs}
    out, first = [], set()
    order = sorted(given_rows, key=lambda r: (r[0] is not None, r[0] or 0))
    seen = {}
    for d, t, *_ in order:
        lines = (t or "").split("\n")
        if (d, t or "") not in seen:
            gone = []
            for i, line in enumerate(lines):
                if key(line) in frequent:
                    if keep_first and key(line) not in first:
                        first.add(key(line))
                    else:
                        gone.append(i)
            seen[d, t or ""] = gone
        gone = seen[d, t or ""]
        kept = "\n".join(line for i, line in enumerate(lines) if i not in gone)
        out.append((d, len(lines), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def shared_lines():
    """Documents that share lines in all sorts of ways, a hot one among them."""
    out = [(i, f"own {i}\n  Shared Line \nlicense\n\nown {i}", "en", "s") for i in range(12)]
    out += [(100 + i, "hot\n" * 50 + f"tail {i}", "en", "s") for i in range(40)]
    out += [(200, "shared line", "en", "s"), (201, "SHARED LINE\t\r", "en", "s"), (202, None, "en", "s"), (203, "", "en", "s"),
            (204, "\n\n\n", "en", "s"), (205, "ends\n", "en", "s"), (None, "hot\nhot", "en", "s"), (None, "license", None, None),
            (206, "\n".join(f"l{i}" for i in range(70)) + "\nhot\n" + "\n".join("license" for _ in range(70)), "en", "s"),
            (207, "É\né\nstraße", "en", "s"), (208, " hot ", "en", "s"), (100, "hot\n" * 50 + "tail 0", "en", "s")]
    return [(d, t, lang, s, None, 5, "x", True, "g", "d", "n", 1, 2, "w") for d, t, lang, s in out]


@pytest.mark.parametrize("min_docs,min_chars", [(1, 1), (3, 1), (10, 1), (10, 8), (60, 1)])
def test_against_plain(spark, min_docs, min_chars):
    given_rows = rows() + shared_lines()
    got = L.line_dedup(spark, table(spark, given_rows).repartition(5), min_docs, min_chars)
    assert counter(got.drop("words").collect()) == counter(r[:4] for r in lines_by_hand(given_rows, min_docs, min_chars))


def test_slices_and_shuffled_joins_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(L, "SLICE_ROWS", 50)
    monkeypatch.setattr(L, "BROADCAST_ROWS", 0)
    given_rows = shared_lines()
    got = L.line_dedup(spark, table(spark, given_rows).repartition(5), 10)
    assert counter(got.drop("words").collect()) == counter(r[:4] for r in lines_by_hand(given_rows, 10))


def test_first_occurrence_stays(spark):
    given_rows = shared_lines()
    # two rows with the id null are in no order that shows in their rows, so only one of them is given
    given_rows = [r for r in given_rows if r[1] != "license"]
    got = L.line_dedup(spark, table(spark, given_rows).repartition(3), 10, keep_first=True)
    assert counter(got.drop("words").collect()) == counter(r[:4] for r in lines_by_hand(given_rows, 10, keep_first=True))


def test_drop_lines_keeps_columns(spark):
    given_rows = shared_lines()
    docs = table(spark, given_rows)
    got = L.drop_lines(spark, docs, 10)
    assert got.columns == docs.columns
    want = collections.Counter((r[0], r[4]) for r in lines_by_hand(given_rows, 10))
    assert collections.Counter((r.doc_id, r.text or "") for r in got.collect()) == want
    assert got.where("doc_id = 202").first().text is None


def test_empty_table(spark):
    assert L.line_dedup(spark, table(spark, [])).count() == 0


def test_one_very_long_document(spark):
    text = "\n".join(f"line {i % 1000}" for i in range(100_000))
    got = L.line_dedup(spark, small(spark, [(1, text), (2, "line 1\nline 2")]), 2).drop("words")
    want = lines_by_hand([(1, text), (2, "line 1\nline 2")], 2)
    assert counter(got.collect()) == counter(r[:4] for r in want)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 200), max_size=60, unique=True))
def test_bitmap_round_trip(spark, positions):
    words = collections.defaultdict(int)
    for p in positions:
        words[p // L.WORD] |= 1 << p % L.WORD
    packed = sorted((w << L.WORD) | b for w, b in words.items())
    row = spark.createDataFrame([(packed, [str(i) for i in range(201)])], "words array<bigint>, lines array<string>").select(
        L.dropped_positions(F.col("words")).alias("p"),
        L.lines_left(F.col("lines"), L.dropped_positions(F.col("words"))).alias("left")).first()
    assert row.p == sorted(positions)
    assert row.left == [str(i) for i in range(201) if i not in positions]


def test_ranges_need_no_further_shuffle_of_lines(spark):
    """The stream runs on the range partitions: one exchange by range, one of the slices' sums."""
    lines = L.hashed_lines(table(spark), 1)
    plan = L.frequent_lines(spark, lines, 1000, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan and "Arrow" not in plan
