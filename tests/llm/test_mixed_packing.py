"""Sequences follow the mixed order of their documents."""
import collections
import math

import corpus_pipeline
from cohortqc.llm import mixing as M
from cohortqc.llm import packing as P
from cohortqc.llm.common import written
from tests.llm.fixture import prose, table


def test_every_prefix_of_sequences_is_on_target(spark, monkeypatch):
    monkeypatch.setattr(P, "PIECES_PER_GROUP", 64)
    sizes = {"a": 1600, "b": 400, "c": 100}
    given = [(10000 * k + i, prose(i, 40 + 30 * k), "en", s, None, 5, "x", True, "g", "d", "n", 1, 2, "w")
             for k, (s, n) in enumerate(sizes.items(), 1) for i in range(n)]
    given.append((9999, prose(1, 3000), "en", "a", None, 5, "x", True, "g", "d", "n", 1, 2, "w"))
    docs = table(spark, given)
    stages = dict(corpus_pipeline.STAGES)
    # files in another order than the rows were written in
    docs = written(spark, stages["source_mixing"](spark, docs, ""), "test-mixed").repartition(7)
    slots = {r.doc_id: r for r in M.mixed(spark, docs, M.root_targets(docs)).collect()}
    got = sorted(stages["best_fit_packing"](spark, docs, "").collect(), key=lambda r: r.sequence_id)
    assert {r.doc_id for r in got} == {g[0] for g in given}
    by_sequence = collections.defaultdict(int)
    for r in got:
        by_sequence[r.sequence_id] += r.length
    assert max(by_sequence.values()) <= P.CAPACITY
    ranges = collections.defaultdict(set)
    for r in got:
        ranges[r.sequence_id >> 32].add(slots[r.doc_id].slot)
    ordered = [ranges[g] for g in sorted(ranges)]
    assert len(ordered) > 20 and all(max(a) < min(b) for a, b in zip(ordered, ordered[1:]))
    source = {g[0]: g[3] for g in given}
    total = sum(math.sqrt(n) for n in sizes.values())
    done, n = collections.Counter(), 0
    for r in got:
        if not slots[r.doc_id].on_target:
            break
        if r.piece == 0:
            done[source[r.doc_id]] += 1
            n += 1
            for s, size in sizes.items():
                # under way: a group of 64 pieces and up to one step (here a slot of 16 documents) more, and a block of 16
                assert abs(done[s] - n * math.sqrt(size) / total) < 64 + 16 + 16
    assert n > 250
