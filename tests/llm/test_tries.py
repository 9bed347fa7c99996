"""The prefix trie against brute force: ties, NULLs, long conversations over several chunks and bands."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from tripmarts.llm import common, tries

DDL = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def brute(rows):
    said = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            said.setdefault(conv_id, []).append((turn is not None, turn or 0, role, digest(role, text), text))
    said = {c: [(r, x) for *_, r, _, x in sorted(turns)] for c, turns in said.items()}
    members = {}
    for c in said:
        h = zlib.crc32(str(c).encode()) % 9
        whole = tuple(said.get(c - c % 5, [])[:h] + said[c][h:])
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], []).append((c, d == len(whole)))
    children, leaves, saved = {}, dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node, ids in members.items():
        size = (len(ids) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += size
    out = []
    for node, ids in members.items():
        ends = ",".join(map(str, sorted(c for c, last in ids if last)))
        out.append((
            min(ids)[0], len(node), min(members[node[:-1]])[0] if node else None, len(ids), children.get(node, 0),
            leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[:2], r[2] or -1, r[3:]))


@pytest.mark.parametrize(("height", "levels"), [(8, 4), (2, 2)])
def test_equals_brute_force(spark, monkeypatch, height, levels):
    draw = random.Random(height)
    rows = [
        (c, t if draw.random() < 0.9 else None, draw.choice(["u", "a", None]), draw.choice(["x", "é", None]))
        for c in draw.sample(range(60), 40) for t in range(draw.choice([1, 2, 3, 8, 30]))
    ]
    rows += [(None, 1, "u", "x")] + [(c, t, "u", "same") for c in range(100, 130) for t in range(5)]
    rows += [(200, t, "u", "z") for t in range(300)] + [(31, 0, "u", "x")] * 2
    monkeypatch.setattr(tries, "PART_ROWS", 37)
    monkeypatch.setattr(tries, "PIECE", 3)
    monkeypatch.setattr(common, "HOT_ROWS", 20)
    made = spark.createDataFrame(rows, DDL).repartition(4)
    assert in_order(tries.prefix_trie(made, height, levels).collect()) == in_order(brute(rows))


def test_no_conversations_no_nodes(spark):
    assert tries.prefix_trie(spark.createDataFrame([], DDL)).collect() == []
    assert tries.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], DDL)).collect() == []


def test_clashing_columns_are_not_read(spark):
    rows = [(1, 0, "user", "hello"), (2, 0, "user", "hello")]
    wide = spark.createDataFrame(rows, DDL).selectExpr("*", "'k' AS key", "7 AS depth", "1 AS part", "'p' AS paths", "0 AS bytes")
    assert in_order(tries.prefix_trie(wide).collect()) == in_order(brute(rows))


def test_paths_name_the_nodes_of_a_band():
    paths = tries.Paths(b"0", range(3), 2)
    found = {depth: paths.above(depth, str(depth).encode()) for depth in range(1, 9)}
    assert found[3] == [[b"2"]] and found[4] == [[b"2", b"3"], [b"0", b"2"], [b"0"]]
    assert found[6] == [[b"4", b"5"], [b"4"]] and found[8][2] == [b"0", b"4"]
