"""Collocations against brute force, with hot pairs dealt out and tiny tasks."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from tripmarts.llm import phrases

DDL = "lang string, text string"


def brute(rows, least, best):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            counts.setdefault(lang, Counter()).update(
                tuple(words[i : i + k]) for k in range(1, 6) for i in range(len(words) - k + 1)
            )
    out = []
    for lang, held in counts.items():
        found = {p: a for p, a in held.items() if len(p) > 1 and a >= least}
        inside = {
            q[i:j] for q, b in found.items() for i in range(len(q)) for j in range(i + 1, len(q) + 1)
            if j - i < len(q) and b >= held[q[i:j]]
        }
        ranked = []
        for p, a in found.items():
            if p not in inside:
                score, k = min((1000 * a * totals[lang] // (held[p[:k]] * held[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), held[p[:k]], held[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


@pytest.mark.parametrize(("least", "hot", "best"), [(3, 512, 50), (2, 4, 2000), (5, 1, 2000)])
def test_equals_brute_force(spark, monkeypatch, least, hot, best):
    monkeypatch.setattr(phrases, "HOT_SHARE", hot)
    monkeypatch.setattr(phrases, "TASK_WEIGHT", 300)
    draw = random.Random(least)
    said = ["a", "B", "the", "dé", "x\x1cy", ".", "q!", "\t", "\n"]
    rows = [(draw.choice(["en", "de", None]), " ".join(draw.choices(said, k=draw.choice([0, 1, 5, 80])))) for _ in range(60)]
    rows += [("en", None), ("", "a a a")] + [("en", "the a b the a b the a b the")] * 9 + [("fr", "the " * 9)]
    made = spark.createDataFrame(rows, DDL).repartition(3).selectExpr("*", "1 AS words", "'x' AS phrase", "2 AS f", "3 AS route")
    assert sorted(map(tuple, phrases.collocations(made, least=least, best=best).collect())) == brute(rows, least, best)


def test_empty_table_and_nothing_frequent(spark):
    assert phrases.collocations(spark.createDataFrame([], DDL)).collect() == []
    assert phrases.collocations(spark.createDataFrame([("en", "a b c"), (None, None)], DDL)).collect() == []


def test_quicksort_counts_weighted_prefixes():
    draw = np.random.default_rng(1)
    rows = np.sort(draw.integers(0, 4, (300, 4)), axis=1)[:, ::-1].copy()
    rows[rows == 3] = 1
    rows = rows * np.cumprod(rows > 0, axis=1)
    weights = draw.integers(1, 5, 300)
    expected = Counter()
    for row, weight in zip(rows.tolist(), weights.tolist(), strict=True):
        for k in range(2, 5):
            if all(row[:k]):
                expected[tuple(row[:k])] += weight
    found = {tuple(codes.tolist()): weight for codes, weight in phrases.quicksort_counts(rows, weights, 20)}
    assert found == {codes: weight for codes, weight in expected.items() if weight >= 20}
