"""Decontamination against brute force, with small shards and blocks."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from tripmarts.llm import suffixes
from tripmarts.llm.common import kept

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(documents, items, least=10):
    out = []
    for doc_id, text in documents:
        said, hit, names = words(text), set(), set()
        for item_id, item in items:
            item = words(item)
            size = min(least, len(item))
            windows = {tuple(item[o : o + size]) for o in range(len(item) - size + 1)} if item else set()
            for place in range(len(said) - size + 1):
                if tuple(said[place : place + size]) in windows:
                    hit |= set(range(place, place + size))
                    names.add("" if item_id is None else str(item_id))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc_id, len(said), len(hit), len(names), digest, bool(hit)))
    return out


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(3)

    def some(lengths):
        return " ".join(draw.choices(["a", "b", "C", "dé", "e1"][:3], k=draw.choice(lengths)))

    documents = [(n if n % 7 else None, some([0, 1, 5, 30, 200])) for n in range(60)] + [(5, None), (5, ""), (5, "a B c")]
    items = [(n, some([0, 3, 9, 10, 14, 40])) for n in range(12)] + [(3, "a b a"), (None, "a a a a b b"), (77, None)]
    return documents, items


def frames(spark, documents, items):
    return (
        spark.createDataFrame(documents, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
    )


@pytest.mark.parametrize(("shard_words", "block"), [(100, 1 << 24), (1 << 21, 64)])
def test_equals_brute_force(spark, monkeypatch, texts, shard_words, block):
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", block)
    documents, items = frames(spark, *texts)
    index = kept(suffixes.build_index(documents, shard_words=shard_words), "index")
    found = suffixes.contamination(suffixes.find_matches(index, items))
    assert in_order(found.collect()) == in_order(brute(*texts))


def test_clean_documents_stay_with_all_columns(spark, texts):
    documents, items = frames(spark, *texts)
    wide = documents.selectExpr("*", "1 AS mark", "'s' AS shard", "2 AS n_words", "0 AS start")
    clean = suffixes.drop_contaminated(wide, items)
    assert clean.columns == wide.columns
    expected = [row for row, found in zip(texts[0], brute(*texts), strict=True) if not found[-1]]
    assert sorted(map(str, (tuple(r)[:2] for r in clean.collect()))) == sorted(map(str, expected))


def test_matches_are_as_long_as_they_can_be(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    documents = [(1, f"x {item[:-9]} y"), (2, f"{item}, {item}"), (3, "one two three")]
    made, items = frames(spark, documents, [(9, item)])
    found = {r.doc_id: r for r in suffixes.find_matches(suffixes.build_index(made), items).collect()}
    assert (found[1].start, found[1].length, found[1].item_start) == ([1], [12], [0])
    assert (found[2].start, found[2].length, found[2].item_id) == ([0, 13], [13, 13], [9, 9])
    assert found[3].start == []


def test_empty_tables(spark):
    documents, items = frames(spark, [], [(1, "a b")])
    assert suffixes.contamination(suffixes.find_matches(suffixes.build_index(documents), items)).collect() == []
    documents, items = frames(spark, [(1, "a b")], [])
    found = suffixes.contamination(suffixes.find_matches(suffixes.build_index(documents), items)).collect()
    assert [tuple(r) for r in found] == [(1, 2, 0, 0, hashlib.sha256(b"").hexdigest(), False)]


def test_suffixes_are_in_order():
    draw = random.Random(1)
    for _ in range(300):
        texts = [[draw.choice([1, 2]) for _ in range(draw.choice([0, 1, 2, 5, 7, 30]))] for _ in range(3)]
        codes, ends = np.array(sum(texts, []), np.int32), np.cumsum([len(t) for t in texts])
        order = suffixes.suffix_order(codes, ends)
        found = [codes[p : ends[np.searchsorted(ends, p, side="right")]].tolist() for p in order]
        assert found == sorted(found) and sorted(order) == list(range(len(codes)))
