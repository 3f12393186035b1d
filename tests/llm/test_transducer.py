"""The machines against regular expressions, which say the same for one pattern, and their composition with scopes."""

import random
import re

import pytest

from loomline.llm import abuse
from loomline.llm.transducer import Grammar, Machine, Pattern, Scope


@pytest.mark.parametrize("pattern", ["A[^.,]{0,2}I|A,A[^.,]?I", "Q-?G[^.]*M[^.]*E|E-?Q-?G", "[AI][^.]{0,8}D|Y[^.]{0,2}D", "I", "-Q[.]"])
def test_patterns_equal_regular_expressions(pattern):
    rng = random.Random(4)
    for _ in range(400):
        text = "".join(rng.choice("AIYDQGME-,.") for _ in range(rng.randrange(12)))
        p = Pattern(pattern)
        state = p.start
        for s in text:
            state = p.step(state, s)
        assert (state is None) == (re.search(pattern, text) is not None), text


def test_sums_greatest_weights_and_remembered_moves():
    weighted = [("AB", 1.0), ("B[^.]*C", 0.5), ("C", -0.25)]
    most, total = Machine(Grammar(weighted, max)), Machine(Grammar(weighted, sum))
    for _ in range(2):
        assert most.score("AB-C") == 1.0 and total.score("AB-C") == 1.25 and total.score("C") == -0.25 and most.score("") == 0
    assert len(most.states) < 20


def test_scopes_compose():
    drop = Scope({("s", "A"): ("s", "B")}, lambda s, c: (s, c), "s")
    again = Scope({("s", "B"): ("s", "C")}, lambda s, c: (s, c), "s")
    assert Machine(Grammar([("C", 1.0)], max), drop, again).score("A") == 1.0 and Machine(Grammar([("C", 1.0)], max), again, drop).score("A") == 0


def test_denial_and_report_mark_what_they_cover():
    def written(scope, text):
        state, out = scope.start, ""
        for s in text:
            state, s = scope.step(state, s)
            out += s
        return out

    mark = abuse.MARK
    assert written(abuse.DENIED, "YN-I") == f"YN-{mark['I']}" and written(abuse.DENIED, "N-I") == "N-I" and written(abuse.DENIED, "YNb-I") == "YNb-I"
    assert written(abuse.REPORTED, "YI-S-YI.YI") == f"YI-S-{mark['Y']}{mark['I']}.YI"
