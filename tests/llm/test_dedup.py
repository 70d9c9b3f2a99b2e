"""Exact and near dedup against plain versions."""
import hashlib
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortqc.llm import exact_dedup as E
from cohortqc.llm import simhash_dedup as S
from cohortqc.llm import components as C
from cohortqc.llm.components import components
from tests.llm.fixture import WORD, counter, lower, prose, rows, small, table


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2 ** 64 - 1), min_size=1, max_size=300))
def test_golomb_round_trip(values):
    ordered = np.array(sorted(values), np.uint64)
    assert (E.golomb_decode(E.golomb_encode(ordered), len(ordered)) == ordered).all()


def test_golomb_far_values():
    ordered = np.array([0, 1, 2, 3, 2 ** 64 - 1], np.uint64)
    assert (E.golomb_decode(E.golomb_encode(ordered), 5) == ordered).all()
    dense = np.arange(1000, dtype=np.uint64) + np.uint64(2 ** 63)
    assert len(E.golomb_encode(dense)) < 300


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def exact_by_hand(given_rows):
    groups = {}
    for d, t, *_ in given_rows:
        groups.setdefault(squeezed(t), []).append((-len(t or ""), d is None, d or 0, d))
    out = []
    for d, t, *_ in given_rows:
        key = squeezed(t)
        keep = min(groups[key], key=lambda x: x[:3])[3]
        out.append((d, keep, len(groups[key]), d == keep, hashlib.sha256(key.encode()).hexdigest()))
    return out


def test_exact_groups(spark):
    got = E.exact_groups(spark, table(spark).repartition(5)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert counter(got.collect()) == counter(exact_by_hand(rows()))


def test_drop_copies_keeps_one_of_each_text(spark):
    docs = table(spark).repartition(4)
    kept = E.drop_copies(spark, docs)
    assert kept.columns == docs.columns
    found = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(found) == len({squeezed(t) for _, t in found}) == len({squeezed(t) for _, t, *_ in rows()})
    want = {squeezed(t): k for (d, t, *_), (_, k, *_) in zip(rows(), exact_by_hand(rows()))}
    assert {squeezed(t): d for d, t in found} == want


def test_two_texts_under_one_fingerprint_stay_apart(spark, monkeypatch):
    docs = small(spark, [(1, "a"), (2, "b"), (3, "a ")])
    marked = E.marked_rows(spark, docs)
    everything = marked.drop("suspect").selectExpr("*", "true AS suspect")  # as if all fingerprints met
    sizes = {bytes(r.digest): r.group_size for r in E.verified(docs, everything).collect()}
    assert sorted(sizes.values()) == [1, 2]


@pytest.mark.parametrize("fn", [E.exact_groups, E.drop_copies, S.near_groups, S.drop_near])
def test_empty_table(spark, fn):
    assert fn(spark, table(spark, [])).count() == 0


def print_by_hand(text):
    words = WORD.findall(lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(prints):
    nodes = sorted(set(prints))
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_near_groups(spark):
    given_rows = rows()
    got = S.near_groups(spark, table(spark).repartition(5)).collect()
    prints = [print_by_hand(t) for _, t, *_ in given_rows]
    root, ids = components_by_hand(prints), {}
    for (d, *_), p in zip(given_rows, prints):
        ids.setdefault(root[p], []).append(d)
    smallest = {k: min((d for d in v if d is not None), default=None) for k, v in ids.items()}
    want = counter((d, p - (1 << 64) if p >> 63 else p, smallest[root[p]]) for (d, *_), p in zip(given_rows, prints))
    assert counter((r.doc_id, r["print"], r.component_id) for r in got) == want
    assert len(set(smallest)) < len(set(prints))  # some different fingerprints are linked


def test_drop_near_keeps_one_of_each_group(spark):
    docs = table(spark)
    kept = S.drop_near(spark, docs)
    assert kept.columns == docs.columns
    root = components_by_hand([print_by_hand(t) for _, t, *_ in rows()])
    found = [root[print_by_hand(r.text)] for r in kept.collect()]
    assert len(found) == len(set(found)) == len(set(root.values()))


@pytest.mark.parametrize("chunk", [4, 1024])
def test_links_of_a_crowded_cell(spark, monkeypatch, chunk):
    """A chain and a cloud of fingerprints: cutting cells into chunks loses no link."""
    monkeypatch.setattr(S, "CHUNK", chunk)
    rnd = np.random.default_rng(5)
    centre, prints = int(rnd.integers(0, 2 ** 63)), set()
    for _ in range(120):
        prints.add(centre ^ sum(1 << int(b) for b in rnd.choice(20, rnd.integers(0, 7), replace=False)))
    step = int(rnd.integers(0, 2 ** 63))
    for b in range(0, 60, 3):  # each a link from the last, far from the first
        step ^= 0b111 << b
        prints.add(step)
    prints |= {int(x) for x in rnd.integers(0, 2 ** 63, 50)}
    nodes = spark.createDataFrame([(p,) for p in prints], "print long")
    found = {r.node: r.root for r in components(spark, S.near_links(spark, nodes)).collect()}
    groups, want = {}, {}
    for p in prints:
        groups.setdefault(found.get(p, p), set()).add(p)
    for p, r in components_by_hand(prints).items():
        want.setdefault(r, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
    assert max(map(len, want.values())) >= 20


def test_image_distance_is_a_lower_bound():
    rnd = np.random.default_rng(1)
    a, b = (rnd.integers(0, 2 ** 63, 2000).astype(np.uint64) for _ in range(2))
    counts = lambda x: np.stack([np.bitwise_count((x >> np.uint64(s)) & np.uint64(3)) for s in range(0, 64, 2)], 1).astype(int)
    manhattan = np.abs(counts(a) - counts(b)).sum(axis=1)
    assert (np.bitwise_count(S.image(a) ^ S.image(b)) == manhattan).all()
    assert (manhattan <= np.bitwise_count(a ^ b)).all()


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100)] + [(500, i) for i in range(501, 560)] + [(900, 900), (7, 7)]
    got = {r.node: r.root for r in components(spark, spark.createDataFrame(edges, "hi long, lo long")).collect()}
    assert got == {**{i: 0 for i in range(101)}, **{i: 500 for i in range(500, 560)}}


def test_components_that_are_stars_take_no_round(spark, monkeypatch):
    """A round more only to see that nothing changes costs as much as any other."""
    rounds = []
    monkeypatch.setattr(C, "written", lambda s, df, name, f=C.written: (rounds.append(name), f(s, df, name))[1])
    stars = [(k, 0) for k in range(1, 40)] + [(k, 50) for k in range(51, 60)] + [(50, 51), (70, 70)]
    got = {r.node: r.root for r in C.components(spark, spark.createDataFrame(stars, "hi long, lo long")).collect()}
    assert got == {**{k: 0 for k in range(40)}, **{k: 50 for k in range(50, 60)}} and len(rounds) == 1
    chain = [(3, 1), (3, 2), (4, 2)]
    assert {r.root for r in C.components(spark, spark.createDataFrame(chain, "hi long, lo long")).collect()} == {1}


def test_very_long_text(spark):
    long = prose(9, 60_000)
    got = {r.doc_id: r for r in S.near_groups(spark, small(spark, [(1, long), (2, long + " end")])).collect()}
    assert got[1].component_id == got[2].component_id == 1
