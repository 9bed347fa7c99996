"""Search, extraction, packing, mixing, chats and archives against plain versions of the same."""

from __future__ import annotations

import base64
import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmarts.llm import chat, mixing, mtree, packing, warc, wrappers
from tripmarts.llm.common import ship
from tripmarts.runtime import work_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(autouse=True, scope="module")
def shipped(spark):
    ship(spark)


# ---- top-k --------------------------------------------------------------------------


def brute(vectors, asks, k=10):
    rows = {}
    for key, vector in vectors:
        if key is not None and vector and all(x is not None and np.isfinite(x) for x in vector):
            rows.setdefault(key, []).append([int(np.floor(x * 1024)) for x in vector])
    out = set()
    for query in rows:
        if not asks(query):
            continue
        for one in rows[query]:
            scores = [(-sum(a * b for a, b in zip(one, v, strict=True)), key) for key, vs in rows.items() if key != query for v in vs]
            out |= {(query, rank, key, -score) for rank, (score, key) in enumerate(sorted(scores)[:k], 1)}
    return out


@pytest.mark.parametrize(("shard", "page"), [(8192, 64), (40, 4)])
def test_top_k_matches_brute_force(spark, shard, page):
    draw = np.random.default_rng(2)
    vectors = [(n, [float(x) for x in draw.standard_normal(6) * draw.uniform(0.1, 3)]) for n in range(300)]
    vectors += [(300 + n, [0.5, -0.5, 0.25, 0.0, 1.0, 2.0]) for n in range(60)]
    vectors += [(400, None), (401, [None, 1.0, 1.0, 1.0, 1.0, 1.0]), (500, [float("nan")] * 6), (402, [float("inf")] * 6)]
    vectors += [(None, [1.0] * 6), (403, []), (600, [0.0] * 6)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    found = mtree.top_k(df, F.col("vec_id") % 25 == 0, shard_vectors=shard, page=page, query_block=5).collect()
    single = [(k, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for k, v in vectors]
    assert {tuple(row) for row in found} == brute(single, lambda key: key % 25 == 0)


def test_top_k_small_tables(spark):
    schema = "vec_id long, embedding array<float>"
    none = spark.createDataFrame([], schema)
    assert mtree.top_k(none, F.col("vec_id") % 100 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], schema)
    assert [tuple(r) for r in mtree.top_k(two, F.col("vec_id") % 100 == 0).collect()] == [(0, 1, 1, 11 * 1024 * 1024)]


def test_tree_bounds_hold():
    points = mtree.lifted(np.random.default_rng(5).integers(-1000, 1000, (500, 4)), 4e6)
    tree = mtree.build(points, page=8)
    seen = []

    def below(page):
        out = []
        for e in range(tree.first[page], tree.first[page + 1]):
            if tree.child[e] < 0:
                out.append(tree.entry[e])
            else:
                inner = below(tree.child[e])
                away = mtree.distances(points[inner], points[tree.entry[e]])
                assert away.max() <= tree.radius[e] + 1e-6
                out += inner
        return out

    seen = below(0)
    assert sorted(seen) == list(range(500))
    assert max(np.diff(tree.first)) <= 8


# ---- extraction ---------------------------------------------------------------------

PAGES = [
    ("<article><h1>A &amp; B</h1><p>one<br>two<p>three <b>four</b></article>", "A & B\none two\nthree four"),
    ("<div class='post-content'><p>x</p><form><input>y</form></div><div id=comments><p>reader</p></div>", "x"),
    ("<body><header>h</header><div class=sidebar>s</div><div><p>long main text of this page</p><p>more</p></div><footer>f",
     "long main text of this page\nmore"),
    ("<main><p>kept</p><div class='ad'>buy</div><aside>a</aside><script>if (a<b) {}</script><style>p{}</style></main>", "kept"),
    ("<article><header><h1>T</h1><span>by me</span></header><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>",
     "T\na\nb\nc d"),
    ("<p>open <b>tags", "open tags"), ("plain", "plain"), ("", ""), (None, ""), ("<!-- only --><script>x</script>", ""),
    ("a < b and c > d", "a < b and c > d"), ("<div>" * 3000 + "deep", "deep"),
]


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_single_pages(page, text):
    assert wrappers.page_text(page, None) == text


def test_wrapper_has_slots_options_and_repeats():
    pages = [
        f"<nav>menu</nav><article><h1>t{n}</h1>{'<p>x%d</p>' % n * (n + 1)}{'<ul><li>a<li>b</ul>' if n % 2 else ''}</article>"
        for n in range(4)
    ]
    whole = None
    for page in pages:
        one = wrappers.of_page(wrappers.parse(page))
        whole = one if whole is None else wrappers.merge(whole, one)
    assert whole.pages == 4
    text = wrappers.render(whole)
    assert "<nav>=</nav>" in text and "<h1>#</h1>" in text and "(<p>#</p>)+" in text and "(<ul>(<li>#</li>)+</ul>)?" in text


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["<p>a</p>", "<h2>b</h2>", "<div>c</div>", "<ul><li>d</ul>", "e"]), max_size=60))
def test_every_page_matches_its_wrapper(parts):
    page = f"<article>{' '.join(parts)}</article>"
    other = wrappers.of_page(wrappers.parse("<article><p>z</p><h2>y</h2></article>"))
    whole = wrappers.merge(other, wrappers.of_page(wrappers.parse(page)))
    wrappers.choose(whole)
    expected = wrappers.page_text(page, None)
    assert wrappers.page_text(page, whole).split() == expected.split()


def test_main_text_of_a_table(spark):
    rows = [(n, f"http://h{n % 3}.example/{n}", page) for n, (page, _) in enumerate(PAGES)] + [(None, None, PAGES[0][0])] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    found = wrappers.main_text(df).collect()
    assert len(found) == len(rows)
    by_id = {row.page_id: row.text for row in found}
    assert by_id[0] == PAGES[0][1] and by_id[None] == PAGES[0][1] and by_id[8] == "" and by_id[7] == ""
    assert all(row.n_chars == len(row.text) for row in found)
    assert wrappers.main_text(df.limit(0)).count() == 0


# ---- packing ------------------------------------------------------------------------


def test_best_fit_takes_the_tightest_compatible_bin():
    bins = packing.Bins(10)
    assert bins.add(6, 1, 0) == (0, 0)  # 4 left, source 1
    assert bins.add(7, 2, 1) == (1, 0)  # 3 left, source 2, cluster 1
    assert bins.add(3, 4, 1) == (0, 6)  # bin 1 is tighter, but has the cluster
    assert bins.add(3, 2, 0) == (2, 0)  # bin 1 is tighter, but has the source
    assert bins.add(3, 8, 0) == (1, 7)
    assert bins.add(10, 0, 0) == (3, 0)


def test_packing_is_whole_and_without_conflicts(spark):
    draw = np.random.default_rng(3)
    rows = [(n, "w " * int(draw.integers(0, 90)), f"s{int(draw.integers(0, 9))}") for n in range(700)]
    rows += [(700, None, None), (701, "x " * 1000, "s1"), (None, "y", "s2"), (702, "same text", "s3"), (703, "same text", "s4")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("bin_id", F.lit("clash"))
    made = packing.pack(df, capacity=100, shard_docs=200).toPandas()
    assert made.groupby("bin_id")["piece_size"].sum().max() <= 100
    assert not made[made["source"].notna()].duplicated(["bin_id", "source"]).any()
    sizes = {key: len((text or "").split()) for key, text, _ in rows if key is not None}
    packed = made.dropna(subset=["doc_id"]).groupby("doc_id")["piece_size"].sum()
    assert {int(k): int(v) for k, v in packed.items()} == sizes
    assert made["doc_id"].isna().sum() == 1
    two = made[made["doc_id"].isin([702, 703])]
    assert two["bin_id"].nunique() == 2
    assert packing.pack(df.limit(0)).count() == 0


# ---- mixing -------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=12))
def test_deviation_is_less_than_one_block(weights):
    parts = mixing.parts_of({f"s{n}": w for n, w in enumerate(weights)}, 200)
    assert sum(parts.values()) == 200
    order = sorted((slot, name) for name, slots in mixing.cycle_slots(parts).items() for slot in slots)
    assert [slot for slot, _ in order] == list(range(200))
    had = Counter()
    for slot, name in order:
        had[name] += 1
        assert all(abs(had[one] - share * (slot + 1) / 200) < 1 for one, share in parts.items())


def test_mix_places_every_document_once(spark):
    rows = [(n, f"s{min(n % 7, 3)}", n) for n in range(500)] + [(None, None, 1), (7, "s3", 1), (9000, "unknown", 1)]
    df = spark.createDataFrame(rows, "doc_id long, source string, mix_slot int")
    df = df.withColumnRenamed("mix_slot", "other")
    weights = {"s0": 0.5, "s1": 0.25, "s2": 0.125, "s3": 0.125, "absent": 0.3}
    made = mixing.mix(df, weights, block_docs=4, cycle=100, numbered=50).collect()
    assert len(made) == len(rows)
    assert len({row.mix_position for row in made}) == len(rows)
    slots = sorted({(row.mix_slot, row.mix_source) for row in made})
    assert [slot for slot, _ in slots] == list(range(len(slots)))
    # Named sources first run together in proportion; the others follow.
    assert {row.mix_source for row in sorted(made, key=lambda r: r.mix_position)[-2:]} == {mixing.OTHER}
    present = {name: weight for name, weight in weights.items() if name != "absent"}
    parts, had = mixing.parts_of(present, 100), Counter()
    ends = {name: max(slot for slot, one in slots if one == name) for name in present}
    for slot, name in slots[: min(ends.values()) + 1]:
        had[name] += 1
        assert all(abs(had[one] - share * (slot + 1) / 100) < 1 for one, share in parts.items())
    ordered = mixing.in_mix_order(df, weights, block_docs=4, cycle=100)
    assert ordered.columns == df.columns and ordered.count() == len(rows)
    assert mixing.mix(df.limit(0), weights).count() == 0


# ---- chats --------------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["\\", "<", "[", "/s>", "s>", "<SYS>>", "INST]", "|role|>", "x", "</s>", "<s>", " "]), max_size=12))
def test_escape_is_reversible(parts):
    text = "".join(parts)
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(control in escaped for control in chat.CONTROLS)


def test_loss_mask_by_prefix_sums():
    assert chat.loss_mask([1, 3, 1, 0, 2], [False, True, False, True, True]).tolist() == [0, 1, 1, 1, 0, 1, 1]
    assert chat.loss_mask([], []).tolist() == []


def test_chats_round_trip(spark):
    said = "</s>[INST] ok [/INST]"
    rows = [
        (1, 0, "system", "be <<SYS>> nice"), (1, 1, "user", said), (1, 2, "assistant", said), (1, 3, "tool<s>", "r\\<\\s>"),
        (2, 0, "user", None), (2, 1, "assistant", ""), (2, None, None, "first"), (3, 0, "assistant", "é😀 <|endoftext|>"),
        (3, 1, "assistant", "x" * 50_000), (None, 0, "user", "nobody"), (4, 0, "user", "twice"), (4, 0, "user", "twice"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit(1))
    made = chat.format_conversations(df, PATH).cache()
    found = {row.conv_id: row for row in chat.conversation_digests(chat.read_turns(made, PATH)).collect()}
    assert set(found) == {1, 2, 3, 4, None}
    for conv_id, row in found.items():
        turns = sorted(
            ((-1 if turn is None else turn, role or "", text or "") for conv, turn, role, text in rows if conv == conv_id)
        )
        sha = hashlib.sha256("".join(f"{role}\n{text}\n" for _, role, text in turns).encode()).hexdigest()
        loss = "".join(text for _, role, text in turns if role == "assistant")
        assert (row.n_turns, row.turns_sha256) == (len(turns), sha)
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for row in made.filter("conv_id = 1").collect():
        assert len(row.ids) == len(row["mask"]) and (sum(row["mask"]) > 0) == (row.role == "assistant")
    starts = made.filter("conv_id = 1").orderBy("seq").collect()
    assert [row.first_token for row in starts] == [0, *np.cumsum([len(row.ids) for row in starts])[:-1].tolist()]
    assert chat.conversation_digests(chat.read_turns(chat.format_conversations(df.limit(0), PATH), PATH)).count() == 0


# ---- archives -----------------------------------------------------------------------


@given(st.binary(max_size=300), st.integers(1, 50))
def test_chunks_round_trip(payload, size):
    assert warc.unchunked(warc.chunked(payload, size)) == payload


def test_archives_round_trip(spark):
    pages = [
        (1, "http://a/ü?x=1 2", "<p>é</p>"), (2, "http://b", "<p>é</p>"), (3, None, None), (4, "http://c\r\nX: y", ""),
        (5, "http://d", "line\r\n\r\nWARC/1.1\r\n" * 3000), (None, "http://e", "only"), (7, "http://f", "0\r\n\r\n"),
        (0, "http://late", "<p>é</p>"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    path = work_path(spark, "warc")
    warc.write_archives(df, path, segment_bytes=1000, chunk_bytes=300, file_bytes=20_000)
    records = warc.read_archives(spark, path)
    payloads = {row.page_id: row.payload for row in records.collect()}
    assert bytes(payloads[5]) == pages[4][2].encode() and payloads[2] is None
    found = {row.page_id: row for row in warc.archive_index(records).collect()}
    assert len(found) == len(pages)
    first = {}
    for page_id, _, html in sorted(pages, key=lambda p: (p[0] is None, p[0] or 0)):
        first.setdefault(html or "", page_id)
    for page_id, url, html in pages:
        row, body = found[page_id], (html or "").encode()
        assert row.payload_bytes == len(body)
        assert row.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert row.url == url
        own = first[html or ""] == page_id
        assert (row.record_type, row.refers_to) == (("response", None) if own else ("revisit", first[html or ""]))


def test_missing_segments_show():
    import pandas as pd

    block = b"HTTP/1.1 200 OK\r\n\r\n" + b"x" * 50
    rows = pd.DataFrame({
        "record_id": ["a", "b", "c"], "number": [1, 3, 2], "total": [None, len(block), None],
        "block": [block[:20], block[40:], block[20:40]], "payload": [None] * 3, "page_id": [1, None, None],
    })
    assert warc._join_segments(rows)["payload"].tolist() == [b"x" * 50]
    assert warc._join_segments(rows.drop(index=2))["payload"].tolist() == [None]


def test_empty_archives(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    path = work_path(spark, "warc")
    warc.write_archives(df, path)
    assert warc.archive_index(warc.read_archives(spark, path)).count() == 0
