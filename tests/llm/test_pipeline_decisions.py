"""Decisions of the pipeline's stages reach its result."""

from __future__ import annotations

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tripmarts.llm import mixing, packing

FOLDER = "/root/testdata/sf0.001"


def test_weights_change_the_packed_rows(spark, monkeypatch):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")

    def packed():
        mixed = corpus_pipeline.mixing_stage(spark, docs, FOLDER)
        return {tuple(row) for row in corpus_pipeline.packing_stage(spark, mixed, FOLDER).collect()}

    even = packed()
    assert packed() == even
    monkeypatch.setattr(corpus_pipeline, "MIX_WEIGHTS", {f"src{n}": 0.9 if n == 0 else 0.01 for n in range(10)})
    assert packed() != even


def test_bins_follow_the_mix(spark):
    rows = [(n, "w " * (1 + n % 90), f"s{n % 3}") for n in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(docs, {"s0": 0.8, "s1": 0.1, "s2": 0.1}, block_docs=2)
    made = packing.pack(mixed, capacity=50, shard_docs=100, position="mix_position")
    assert made.agg(F.sum("piece_size")).first()[0] == sum(1 + n % 90 for n in range(900))
    places = made.join(mixed.select("doc_id", "mix_position"), "doc_id")
    bins = places.groupBy("bin_id").agg(F.min("mix_position").alias("first")).orderBy("bin_id").collect()
    firsts = [row["first"] for row in bins]
    assert firsts == sorted(firsts)
    assert made.groupBy("bin_id", "source").count().filter("count > 1 AND source <> 's9'").count() == 0
    early = {row.doc_id for row in places.filter("bin_id < 4294967296").select("doc_id").collect()}
    assert sum(n % 3 == 0 for n in early) == pytest.approx(0.8 * len(early), abs=4)


def test_near_copies_do_not_both_stay(spark):
    words = [f"word{n * 7919 % 613}" for n in range(200)]
    rows = [(9, " ".join(words)), (4, " ".join([*words[:100], "other", *words[101:]])), (5, " ".join(reversed(words)))]
    rows += [(20 + n, " ".join([*words[: n * 5 + 20], f"new{n}", *words[n * 5 + 20 :]])) for n in range(30)]
    # Half of the words are the same: no copies.
    rows += [(60 + n, " ".join([*words[:100], *(f"own{n}x{k}" for k in range(100))])) for n in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = sorted(row.doc_id for row in corpus_pipeline.near_duplicate_stage(spark, docs, FOLDER).collect())
    assert left == [4, 5, *range(60, 72)]
