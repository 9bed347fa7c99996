"""Repeated and shuffled good words do not score as good texts."""

from __future__ import annotations

import numpy as np

from tripmarts.llm import quality
from tripmarts.llm.common import ship


def test_repeated_and_shuffled_words_score_lower(spark):
    ship(spark)
    draw, rows = np.random.default_rng(5), []
    listed = [f"{a}{b}" for a in ("ho", "ma", "ti", "re") for b in ("use", "ny", "mer", "ad", "lk", "nd")]
    for n in range(1200):
        start = int(draw.integers(0, 24))
        text = [listed[(start + k) % 24] for k in range(20)]
        if 600 <= n < 700:
            text = [word for word in text[:10] for _ in range(2)]
        elif n >= 700:
            draw.shuffle(text)
        rows.append((n, " ".join(text)))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    trusted = documents.filter("doc_id < 600").select("doc_id")
    made = {row.doc_id: row for row in quality.quality_scores(documents, trusted).collect()}
    assert not any(row.base_failed for row in made.values())
    good = min(made[n].score for n in range(600))
    assert good > -0.3 and all(made[n].kept for n in range(600))
    assert max(made[n].score for n in range(600, 1200)) < good - 0.25
    assert not any(made[n].kept for n in range(600, 700))
    # By chance a shuffled text keeps some pairs.
    assert sum(made[n].kept for n in range(700, 1200)) <= 25
