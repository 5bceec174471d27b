"""Every form of a pattern fires its voter: the gates before the patterns leave none out."""

import itertools
import re

from tillroll.llm.toxicity import INSULTS, PATTERNS, Voters


def _expanded(form):
    parts = [list(c[1:-1]) if c[0] == "[" else [c[-1]] for c in re.findall(r"\[[^]]+\]|\\.|.", form)]
    return ["".join(x) for x in itertools.product(*parts)]


def test_every_form_fires_its_voter():
    voters = Voters([])
    disguised = [x for f in PATTERNS["disguised"].removeprefix(r"\b(?:").removesuffix(r")\b").split("|") for x in _expanded(f)]
    assert {"id10t", "1d10t", "scvm", "st*p!d"} <= set(disguised)
    commands = ["shut up", "go to hell", "get lost", "drop dead", "kill yourself", "screw you", "piss off", "hate you",
                "nobody likes you", "nobody loves you"]
    forms = {"disguised": [f"a{x}" if x[0] == "!" else x for x in disguised], "command": commands,
             "address": [f"you {w}" for w in INSULTS], "intensified": [f"such a {w}" for w in INSULTS]}
    for name, texts in forms.items():
        for t in texts:
            assert voters.patterns[name].search(t) and voters.votes(f"Well, {t.capitalize()} .") & voters.bit[name], (name, t)
