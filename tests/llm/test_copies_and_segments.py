"""Rows equal in everything, near copies in bins, and schedules whose cycle is no table."""

from __future__ import annotations

import tracemalloc
from collections import Counter
from fractions import Fraction
from math import ceil, floor

import pytest
from pyspark.sql import functions as F

from tripmarts.llm import mixing, packing, simhash, warc
from tripmarts.llm.common import ship
from tripmarts.runtime import work_path

LONG = {"a": 0.1234567891, "b": 0.3333333333, "c": 0.0012345678, "d": 0.5419753098}


@pytest.fixture(autouse=True, scope="module")
def shipped(spark):
    ship(spark)


def plain_slots(blocks, weights):
    """(source, block) of every slot: windows of all blocks, and a look at every source for each slot."""
    done, order = dict.fromkeys(blocks, 0), []
    while any(done[name] < blocks[name] for name in blocks):
        active = [name for name in blocks if done[name] < blocks[name]]
        weighed = {name: Fraction(str(weights[name])) for name in active}
        total, first, slot = sum(weighed.values()), dict(done), 0
        while all(done[name] < blocks[name] for name in active):
            ready = []
            for name in active:
                share, block = weighed[name] / total, done[name] - first[name]
                if floor(block / share) <= slot:
                    ready.append((ceil((block + 1) / share), name))
            due, name = min(ready)
            assert due > slot
            order.append((name, done[name]))
            done[name] += 1
            slot += 1
    return order


@pytest.mark.parametrize("segment", [1, 7, 64, 1 << 14])
def test_segments_give_the_plain_schedule(spark, segment):
    blocks = {"a": 37, "b": 5, "c": 9, "d": 260}
    rows = [(n, name) for name, size in blocks.items() for n in range(2 * size)]
    df = spark.createDataFrame([(1000 * n + ord(name), name) for n, name in rows], "doc_id long, source string")
    made = mixing.mix(df, LONG, block_docs=2, segment=segment).collect()
    found = {row.mix_slot: (row.mix_source, row.mix_block) for row in made}
    assert [found[slot] for slot in range(len(found))] == plain_slots(blocks, LONG)
    assert sorted(row.mix_position for row in made) == list(range(len(rows)))


def test_short_and_long_cycles_in_one_schedule(spark):
    # Two sources are left of the long cycle in the end, and their cycle is short.
    weights = {"a": 0.5, "b": 0.25, "c": 0.1234567891}
    blocks = {"a": 40, "b": 60, "c": 4}
    df = spark.createDataFrame(
        [(1000 * n + ord(name), name) for name, size in blocks.items() for n in range(size)], "doc_id long, source string"
    )
    made = mixing.mix(df, weights, block_docs=1, segment=8).collect()
    found = {row.mix_slot: (row.mix_source, row.mix_block) for row in made}
    assert [found[slot] for slot in range(len(found))] == plain_slots(blocks, weights)


def test_driver_keeps_states_only():
    weights = {name: LONG[name] for name in "abd"}
    segments = []
    tracemalloc.start()
    rows = mixing.schedule(dict.fromkeys(weights, 100_000), weights, segments=segments)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 5_000_000 and len(segments) < 40
    # The last source alone has a cycle of one slot.
    assert all(len(row[3]) == 1 for row in rows)


def test_equal_rows_fill_no_shard(spark):
    df = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.lit("two words").alias("text"))
    made = packing.pack(df, shard_docs=200).toPandas()
    assert len(made) == 4000 and made["bin_id"].is_unique and made["doc_id"].isna().all()
    assert (made["bin_id"] % 20).value_counts().max() < 300
    again = packing.pack(df.repartition(7), shard_docs=200).toPandas()
    assert sorted(made["bin_id"]) == sorted(again["bin_id"])


def test_near_copies_lie_apart(spark):
    words = [f"w{n * n % 977}" for n in range(600)]
    texts = [" ".join([*words, f"end{n}"]) for n in range(6)]
    rows = [(n, f"s{n}", text, "x") for n, text in enumerate(texts)]
    rows += [(None, None, None, "x"), (7, "s1", "", "x"), (7, "s1", "", "x"), (8, None, "one two three", "x"), (None, "s2", texts[0], "x")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, cluster string")
    groups = simhash.near_duplicates(df.filter("doc_id < 6")).select("component_id").distinct().count()
    assert groups == 1
    marked = packing.with_near_copies(df)
    assert marked.count() == len(rows)
    made = packing.pack(marked, text="text_hash", size="size", cluster="cluster", capacity=4096).toPandas()
    assert len(made) == len(rows)
    long = made[made["piece_size"] > 600]
    assert len(long) == 7 and long["bin_id"].is_unique
    assert packing.pack(packing.with_near_copies(df.limit(0)), text="text_hash", size="size", cluster="cluster").count() == 0


@pytest.mark.parametrize("least", [0, 4])
def test_one_of_equal_pages_is_the_response(spark, monkeypatch, least):
    monkeypatch.setattr(warc, "COPIES", 2)
    pages = [(3, "http://a", "<p>x</p>")] * 6 + [(5, "http://a", "<p>x</p>")] * 2 + [(4, None, None)] * 3 + [(None, "http://b", "long enough")] * 2
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    path = work_path(spark, "warc")
    warc.write_archives(df, path, min_revisit_bytes=least)
    records = warc.read_archives(spark, path)
    found = Counter((r.page_id, r.url, r.record_type, r.refers_to, r.payload_bytes) for r in warc.archive_index(records).collect())
    wanted = Counter({
        (3, "http://a", "response", None, 8): 1, (3, "http://a", "revisit", 3, 8): 5, (5, "http://a", "revisit", 3, 8): 2,
        (None, "http://b", "response", None, 11): 1, (None, "http://b", "revisit", None, 11): 1,
    })
    wanted |= Counter({(4, None, "response", None, 0): 3} if least else {(4, None, "response", None, 0): 1, (4, None, "revisit", 4, 0): 2})
    assert found == wanted
    ids = [r.record_id for r in records.filter("page_id = 3").collect()]
    assert len(set(ids)) == len(ids) == 6


def test_payloads_are_shuffled_once_without_equal_rows(spark, monkeypatch):
    rows = [(n, f"u{n}", f"<p>{n % 7}</p>") for n in range(40)]
    df, plans = spark.createDataFrame(rows, "page_id long, url string, html string"), []
    whole = type(df).mapInArrow

    def spy(self, *args, **options):
        plans.append(self._jdf.queryExecution().optimizedPlan().toString())
        return whole(self, *args, **options)

    monkeypatch.setattr(type(df), "mapInArrow", spy)
    warc.write_archives(df, work_path(spark, "warc"))
    assert [text.count("Join ") for text in plans] == [1]
