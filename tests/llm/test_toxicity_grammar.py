"""The composed grammar against all paths of its parts, and reported speech in its forms."""
import itertools
import math

import pytest

from cohortqc.llm import toxicity as X

G = X.Grammar(X.fixed_lexicon())


def paths(part, kinds):
    """Every sequence of states, with its weights by place; those that no arc allows are left out."""
    for states in itertools.product(range(len(part.arcs)), repeat=len(kinds) + 1):
        steps = [part.arcs[a][k] for a, k in zip(states, kinds)]
        if states[0] == 0 and all(step[0] == b for step, b in zip(steps, states[1:])):
            yield states[-1], [step[1] for step in steps], [step[2] for step in steps]


def by_all_paths(kinds):
    found = [list(paths(part, kinds)) for part in X.machines()]
    assert all(len(f) == 1 for f in found)  # every part is deterministic and stops nowhere
    total = 0.0
    for combination in itertools.product(*found):
        for channel, weight, kind in ((0, X.INSULT_WEIGHT, X.INSULT), (1, X.THREAT_WEIGHT, X.THREAT)):
            end = math.prod(part.finals[c[0]][channel] for part, c in zip(X.machines(), combination))
            total += end * sum(weight * math.prod(c[1 + channel][i] for c in combination)
                               for i, k in enumerate(kinds) if k == kind)
    return total


WORD_OF = {X.OTHER: "table", X.INSULT: "idiot", X.THREAT: "kill", X.TARGET: "you", X.NEGATION: "not", X.REPORT: "said",
           X.OPENING: "«", X.CLOSING: "»", X.TURNING: '"'}


@pytest.mark.parametrize("n", [1, 2, 3])
def test_composed_equals_all_paths(n):
    for kinds in itertools.product(WORD_OF, repeat=n):
        scores = G.sentence(" ".join(WORD_OF[k] for k in kinds))
        assert scores == pytest.approx([by_all_paths(kinds)])


def test_composition_keeps_reachable_states_only():
    sizes = [len(p.arcs) for p in X.machines()]
    assert sizes == [1, 1, 2, X.NEGATION_REACH + 1, 3]
    assert len(G.machine.arcs) == math.prod(sizes)
    assert len(X.compose([X.machines()[2]]).arcs) == 2


def test_reported_speech_damps_alike_in_all_forms():
    plain = X.INSULT_WEIGHT * X.TARGETED
    forms = ["she said you idiot", 'she said "you idiot"', "she said: you idiot", 'she said: "you idiot"', "she said «you idiot»",
             "er sagte: „du idiot“", '"you idiot", she said', '"Hello. you idiot. Bye." she said']
    for form in forms:
        assert G.evidence(form)[0] == pytest.approx(plain * X.REPORTED), form


def test_reported_speech_ends():
    plain = X.INSULT_WEIGHT * X.TARGETED
    for text in ["she said hello. you idiot", 'she said "hello" you idiot', 'an open " quote\nyou idiot', "she said\nyou idiot",
                 'he said: "fine". And you idiot']:
        assert G.evidence(text)[0] == pytest.approx(plain), text


def test_marks_are_followed_over_long_lines():
    quoted, plain = X.INSULT_WEIGHT * X.TARGETED * X.REPORTED, X.INSULT_WEIGHT * X.TARGETED
    line = "A word. " * 2000
    assert G.evidence(f'{line}"{line}you idiot. {line}you idiot." {line}you idiot. {line}') == pytest.approx((plain, 2 * quoted + plain))


def test_negation_reaches_three_words():
    base = X.INSULT_WEIGHT
    assert G.evidence("not a b idiot")[0] == pytest.approx(base * X.NEGATED)
    assert G.evidence("not a b c idiot")[0] == base
    assert G.evidence("not. idiot")[0] == base
