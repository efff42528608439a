"""The transducer of token counts: its states, arcs and annotations."""

from __future__ import annotations

import itertools
import random

import pytest

from lendgrid.llm import token_counts
from lendgrid.llm.queries import tokenizer_path
from lendgrid.llm.token_counts import MARK, Automaton, Pieces

SCORES = {x: -i for i, x in enumerate(["ab", "bc", "abc", "aa", "ca", "aab", "cab", "abab"], 1)} | {"a": -90.0, "b": -91.0, "c": -92.0}


def test_arcs_add_up_to_the_encoding():
    pieces = Pieces(SCORES)
    automaton = Automaton(pieces)
    for n in range(8):
        for text in map("".join, itertools.product("abcé", repeat=n)):
            assert automaton.count(text) == sum(2 if x == "é" else 1 for x in pieces.encode(text)), text
    # A finite automaton: longer texts add no states, and every arc leads to one.
    r = random.Random(1)
    for i in range(1200):
        text = "".join(r.choices("abcé", k=60))
        assert automaton.count(text) == sum(2 if x == "é" else 1 for x in pieces.encode(text))
        if i == 800:
            known = len(automaton.states)
    assert len(automaton.states) == known < 200
    assert all(0 <= target < known for arcs in automaton.arcs for target, _ in arcs.values())


def test_an_arc_by_hand():
    automaton = Automaton(Pieces(SCORES))
    state, change = automaton.step(0, "a")
    assert automaton.states[state] == ("a", (("a", 0), (None, 1))) and change == 1
    state, change = automaton.step(state, "b")  # a and b are joined: one token still
    assert automaton.states[state][0] == "ab" and automaton.states[state][1][0] == ("ab", 0) and change == 0
    after, change = automaton.step(state, "c")  # ab is joined before bc, and abc then has both
    assert automaton.states[after][1][0] == ("abc", 0) and change == 0
    assert automaton.step(after, "é")[1] == 2  # two bytes
    assert automaton.arcs[0].keys() == {"a"}


def test_valid_pairs_are_those_that_encode_to_themselves():
    pieces = Pieces(SCORES)
    whole = [x for x in SCORES if pieces.encode(x) == [x]]
    for left, right in itertools.product(whole, repeat=2):
        assert pieces.valid(left, right) == (pieces.encode(left + right) == [left, right]), (left, right)


def test_states_of_the_model_and_their_bound(monkeypatch):
    t = token_counts.Transducer(tokenizer_path("piece_bpe_32k.model"))
    assert t.compiled
    automaton = t.arcs.automaton
    text = "the quick brown fox jumped over thirteen lazy dogs " * 3
    want = len(t.processor.encode(text))
    assert t.count(text) == want
    assert len(automaton.states) > 40 and all(automaton.states[target][0] in automaton.pieces.prefixes for arcs in automaton.arcs for target, _ in arcs.values())
    path = 0
    total = 0
    for c in MARK + "jumped":
        path, change = automaton.arcs[path][c]
        total += change
    assert total == len(t.processor.encode("jumped"))
    monkeypatch.setattr(token_counts, "MOST_STATES", 30)  # a full table is compiled anew
    monkeypatch.setattr(token_counts, "MOST_SEGMENTS", 3)
    monkeypatch.setattr(token_counts, "MOST_PAIRS", 5)
    assert t.count(text + "x" * 500) == len(t.processor.encode(text + "x" * 500))


@pytest.mark.parametrize("seed", range(3))
def test_counts_equal_the_library_on_odd_texts(seed):
    t = token_counts.load(tokenizer_path("piece_bpe_32k.model"))
    r = random.Random(seed)
    pool = ["the", "ing", " ", "  ", "a", "é", "日", "\n", "\t", "𝄞", "_", MARK, "1", "<s>", "<0x41>", "<unk>", "'s", "ﬁ", "\x00", "Ä", "\r", "...", "À"]
    for _ in range(1500):
        text = "".join(r.choices(pool, k=r.randint(0, 40)))
        assert t.count(text) == len(t.processor.encode(text)), text
