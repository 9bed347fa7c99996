"""Deviation of the mix from the weights themselves, over many cycles."""

from __future__ import annotations

from collections import Counter
from fractions import Fraction

import pytest

from tripmarts.llm import mixing
from tripmarts.llm.queries import MIX_WEIGHTS, OTHER_WEIGHT

ODD = {"a": 0.1234567, "b": 0.3333333, "c": 0.0012345, "d": 0.5419755}


@pytest.mark.parametrize("weights", [MIX_WEIGHTS | {mixing.OTHER: OTHER_WEIGHT}, ODD])
def test_no_source_is_a_block_off_its_weight(weights):
    blocks = dict.fromkeys(weights, 4000)
    rows = mixing.schedule(blocks, weights)
    end = min(row[2] for row in rows if row[2] > 0)
    slots = sorted(
        (slot + turn * cycle, name)
        for name, _, start, own, cycle in rows if start == 0
        for turn in range(-(-end // cycle)) for slot in own if slot + turn * cycle < end
    )
    assert [slot for slot, _ in slots] == list(range(end)) and end > 4000
    exact = {name: Fraction(str(weight)) for name, weight in weights.items()}
    total, had = sum(exact.values()), Counter()
    for slot, name in slots:
        had[name] += 1
        assert abs(had[name] - exact[name] / total * (slot + 1)) < 1
    assert all(abs(had[name] - exact[name] / total * end) < 1 for name in weights)


def test_every_block_has_its_slot_once():
    blocks = {"a": 37, "b": 5, "c": 90, "d": 260, "e": 3}
    rows, found = mixing.schedule(blocks, ODD), []
    for name, count in blocks.items():
        phases = sorted(row[1:] for row in rows if row[0] == name)
        for block in range(count):
            first, start, own, cycle = [phase for phase in phases if phase[0] <= block][-1]
            turn, rest = divmod(block - first, len(own))
            found.append(start + turn * cycle + own[rest])
    assert sorted(found) == list(range(sum(blocks.values())))
