"""Deep pages, reader comments, archives of several members, and columns named like the mix's own."""

from __future__ import annotations

import gzip

import pytest

from tripmarts.llm import mixing, warc, wrappers
from tripmarts.llm.common import ship
from tripmarts.runtime import work_path


@pytest.mark.parametrize("depth", [1, 60, 117, 118, 119, 120, 130, 3000])
def test_no_text_is_lost_at_any_depth(depth):
    inner = "<p>deep <b>bold</b> one</p><nav><a>menu</a><p>link</p></nav><p>deep two<br>line</p>"
    body = f"<p>first words</p>{'<div>' * depth}{inner}{'</div>' * depth}<p>last words</p>"
    page = f"<html><body><nav>top</nav><div class='content'>{body}</div><footer>end</footer></body></html>"
    assert wrappers.page_text(page, None) == "first words\ndeep bold one\ndeep two line\nlast words"


def test_reader_comments_in_articles_are_left_out():
    comment = "<article class='comment'><p>I read this.</p></article>"
    story = "<p>The story is told here in some words.</p>"
    inside = f"<html><body><article class='post'>{story}<section>{comment}</section></article></body></html>"
    beside = f"<html><body><article class='post comments-open'>{story}</article>{comment}</body></html>"
    assert {wrappers.page_text(page, None) for page in (inside, beside)} == {"The story is told here in some words."}


def test_two_optional_neighbours_may_both_be_missing():
    parts = [["p", 0, 1, wrappers.Wrapper("p")], ["p", 0, 1, wrappers.Wrapper("p")]]
    assert wrappers.fold(parts)[0][1] == 0
    parts[0][1] = 1
    assert wrappers.fold(parts)[0][1] == 1


def test_archives_of_many_members_and_plain_ones(spark, tmp_path):
    ship(spark)
    pages = [(n, f"http://h/{n}", f"<p>{n}</p>" * 9) for n in range(7)]
    path = work_path(spark, "members")
    warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1), path)
    data = b"".join(row.content for row in spark.read.format("binaryFile").load(path).orderBy("path").collect())
    plain = gzip.decompress(data)
    places = [at for at in range(len(plain)) if plain.startswith(b"WARC/", at)]
    members = [plain[a:b] for a, b in zip(places, [*places[1:], len(plain)], strict=True)]
    expected = sorted((n, len(html)) for n, _, html in pages)
    for name, content in (("plain.warc", plain), ("members.warc.gz", b"".join(map(gzip.compress, members)))):
        (tmp_path / name).write_bytes(content)
        found = warc.archive_index(warc.read_archives(spark, str(tmp_path / name)))
        assert sorted((row.page_id, row.payload_bytes) for row in found.collect()) == expected


def test_columns_named_like_the_mix_stay(spark):
    rows = [(n, f"s{n % 3}", n, f"x{n}", -n, n + 1) for n in range(200)] + [(None, None, None, None, None, None)] * 2
    df = spark.createDataFrame(rows, "doc_id long, source string, mix_slot int, MIX_POSITION string, mix_deal int, doc int")
    weights = {"s0": 0.5, "s1": 0.5}
    made = mixing.mix(df, weights, block_docs=4)
    assert made.columns == [
        "doc_id", "source", "own_mix_slot", "own_MIX_POSITION", "mix_deal", "doc", "mix_source", "mix_block", "mix_slot", "mix_position",
    ]
    plain = mixing.mix(df.select("doc_id", "source"), weights, block_docs=4)
    places = {row.doc_id: row.mix_position for row in plain.collect() if row.doc_id is not None}
    for row in made.collect():
        if row.doc_id is not None:
            assert row.mix_position == places[row.doc_id] and row.own_mix_slot == row.doc_id == -row.mix_deal
    ordered = mixing.in_mix_order(df, weights, block_docs=4)
    assert ordered.columns == df.columns and ordered.exceptAll(df).count() == 0 and ordered.count() == len(rows)
