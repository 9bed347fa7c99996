"""Near duplicates by SimHash fingerprints and multi-index hashing.

A fingerprint is cut into segments. Two fingerprints that differ in at most ``radius`` bits differ
in few bits of one segment, so each one looks up a small Hamming ball of every segment in a table
of segment values, and whole distances are checked for what it meets there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmarts.llm.common import kept
from tripmarts.llm.components import components

BITS = 64
SHINGLE_WORDS = 4
RADIUS = 4
SEGMENTS = 3
# Fingerprints of one side compared in one task; larger table entries are dealt out as pairs of blocks.
BLOCK = 8192
# Large table entries whose list is sent to every task at most, some 2 MB.
LISTED = 50_000
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_GAPS = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


def fingerprint_of(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of a text's word shingles, 0 without words."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().translate(_LOWER).translate(_GAPS).split(b" ")
    words = [word for word in words if word]
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        return xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    last = ends[shingle_words - 1 :].tolist()
    first = [0, *(ends[: len(words) - shingle_words] + 1).tolist()]
    hashes = [xxh64_intdigest(joined[a:b], 42) for a, b in zip(first, last, strict=True)]
    return _majority(np.array(hashes, np.uint64))


def _majority(hashes: np.ndarray) -> int:
    """Bits set in more than half of the hashes."""
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)].astype(">u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def long_fingerprint(hashes: np.ndarray, bits: int) -> np.ndarray:
    """SimHash of hashes in a multiple of 64 bits, as bytes; zero without hashes. Each 64 bits mix the hashes anew."""
    counts = np.zeros(bits, np.int64)
    seeds = np.arange(1, bits // BITS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for start in range(0, len(hashes), 1 << 12):
        mixed = hashes[start : start + (1 << 12), None] + seeds
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
        mixed ^= mixed >> np.uint64(31)
        counts += np.unpackbits(mixed.view(np.uint8), axis=1).sum(axis=0, dtype=np.int32)
    return np.packbits(counts * 2 > len(hashes))


def fingerprints(
    documents: DataFrame, *, key: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """``doc_id, text_hash, fp``: the fingerprint of every row as a signed long. NULL texts count as empty."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint_of(x.as_py(), shingle_words) for x in batch.column(2)]
            fps = pa.array(np.array(made, np.uint64).astype(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], fps], ["doc_id", "text_hash", "fp"])

    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(body).alias("text_hash"), body.alias("text"))
    return rows.mapInArrow(scan, "doc_id long, text_hash long, fp long")


def segment_bounds(segments: int = SEGMENTS) -> list[tuple[int, int]]:
    """(shift, width) of each segment, widths as equal as they can be."""
    cuts = [BITS * n // segments for n in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def ball_radii(radius: int, segments: int) -> list[int]:
    """Radius looked up in each segment.

    With ``radius = segments * q + r``, one of the first ``r + 1`` segments differs in at most q
    bits or one of the others in at most q - 1; those with -1 need not be looked up.
    """
    whole, rest = divmod(radius, segments)
    return [whole if n <= rest else whole - 1 for n in range(segments)]


def flips(width: int, radius: int) -> list[int]:
    """Masks of up to ``radius`` bits of a segment."""
    return [
        sum(1 << bit for bit in bits) for size in range(radius + 1) for bits in combinations(range(width), size)
    ]


def links(
    distinct: DataFrame, *, radius: int = RADIUS, segments: int = SEGMENTS, block: int = BLOCK
) -> DataFrame:
    """``a, b``: links that connect what fingerprints within ``radius`` connect.

    ``distinct`` holds every fingerprint once, in column ``fp``. Of the pairs that meet in one
    table entry only a spanning forest is returned, so dense groups give no quadratic output:
    two fingerprints are in one component of the result exactly if a chain of pairs within
    ``radius`` leads from one to the other.
    """
    tables, looks = [], []
    for n, ((shift, width), reach) in enumerate(zip(segment_bounds(segments), ball_radii(radius, segments), strict=True)):
        if reach < 0:
            continue
        value = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))
        own = distinct.select(F.lit(n).alias("segment"), value.alias("value"), "fp")
        tables.append(own)
        # The ball without its centre: fingerprints of one value meet as table entries.
        masks = [F.lit(mask).cast("long") for mask in flips(width, reach) if mask]
        if masks:
            ball = own.select("segment", "value", "fp", F.explode(F.array(*masks)).alias("mask"))
            looks.append(ball.select("segment", F.col("value").bitwiseXOR(F.col("mask")).alias("value"), "fp"))
    table = reduce(DataFrame.union, tables).withColumn("entry", F.lit(True))
    sides = reduce(DataFrame.union, [table, *(look.withColumn("entry", F.lit(False)) for look in looks)])
    held = table.groupBy("segment", "value").agg(F.count("*").alias("held"))
    large = kept(held.filter(F.col("held") > block), "large")
    sides = sides.withColumn("part", F.lit(0))
    if count := large.count():
        # Large entries are dealt out in parts, and whoever meets them visits every part.
        large = F.broadcast(large) if count <= LISTED else large
        parts = F.coalesce(F.ceil(F.col("held") / block), F.lit(1)).cast("int")
        sides = sides.drop("part").join(large, ["segment", "value"], "left").withColumn("parts", parts)
        dealt = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
        entries = sides.filter("entry").withColumn("part", dealt)
        visits = sides.filter("NOT entry OR parts > 1").withColumn("entry", F.lit(False))
        visits = visits.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        sides = entries.unionByName(visits)
    keys = ["segment", "value", "part"]
    dealt = sides.select(*keys, "entry", "fp").repartition(*keys).sortWithinPartitions(*keys, F.desc("entry"))
    return dealt.mapInArrow(_forests(radius, 4 * block), "a long, b long")


def _forests(radius: int, at_once: int):
    """Arrow mapper: a spanning forest for every (segment, value, part), whose rows come together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, table, asked, found = None, [], [], []

        def compare(last: bool):
            if table:
                entries = np.concatenate(table)
                others = [*asked, entries] if last and len(entries) > 1 else asked
                if others:
                    found.append(spanning_links(entries, np.concatenate(others), radius))
            asked.clear()

        for batch in batches:
            keys = np.stack([batch.column(n).to_numpy().astype(np.int64) for n in ("segment", "value", "part")])
            entry = batch.column("entry").to_numpy(zero_copy_only=False)
            fps = batch.column("fp").to_numpy().astype(np.uint64)
            if not len(fps):
                continue
            starts = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)))
            ends = np.append(starts[1:], len(fps))
            # Most groups are look-ups that meet nobody; the first and last may go on in another batch.
            visit = (np.add.reduceat(entry.astype(np.int64), starts) > 0) & (ends - starts > 1)
            visit[[0, -1]] = True
            for a, b in zip(starts[visit].tolist(), ends[visit].tolist(), strict=True):
                key = tuple(keys[:, a].tolist())
                if key != group:
                    compare(True)
                    table.clear()
                    group = key
                if entry[a]:
                    table.append(fps[a:b][entry[a:b]])
                if not entry[b - 1]:
                    asked.append(fps[a:b][~entry[a:b]])
                if sum(map(len, asked)) >= at_once:
                    compare(False)
            if len(found) > 1000:
                yield _pairs(found)
                found.clear()
        compare(True)
        if found:
            yield _pairs(found)

    return run


def _pairs(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a, b = (np.concatenate(side).astype(np.int64) for side in zip(*found, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def spanning_links(table: np.ndarray, asked: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs (table, asked) within ``radius``.

    Each table entry is compared with all look-ups at once; those in one component already are left out.
    """
    if len(table) == 1:
        near = asked[(np.bitwise_count(asked ^ table[0]) <= radius) & (asked != table[0])]
        near = np.unique(near)
        return np.full(len(near), table[0]), near
    everyone, place = np.unique(np.concatenate([table, asked]), return_inverse=True)
    if len(everyone) < 2:
        return table[:0], table[:0]
    label = np.arange(len(everyone))
    at_table, at_asked = place[: len(table)], place[len(table) :]
    left, right = [], []
    for row, one in zip(at_table.tolist(), table, strict=True):
        near = at_asked[np.bitwise_count(asked ^ one) <= radius]
        other = np.unique(label[near])
        other = other[other != label[row]]
        if not len(other):
            continue
        # One link to each component that is met.
        first = near[np.unique(label[near], return_index=True)[1]]
        first = first[label[first] != label[row]]
        left.append(np.full(len(first), one))
        right.append(everyone[first])
        label[np.isin(label, other)] = label[row]
    if not left:
        return table[:0], table[:0]
    return np.concatenate(left), np.concatenate(right)


def grouped(
    documents: DataFrame, *, key: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS,
    radius: int = RADIUS, segments: int = SEGMENTS, block: int = BLOCK,
) -> DataFrame:
    """``doc_id, text_hash, fp, component`` of every row; components are named by a fingerprint."""
    marked = kept(fingerprints(documents, key=key, text=text, shingle_words=shingle_words), "fingerprints")
    distinct = kept(marked.select("fp").distinct(), "distinct")
    joined = components(links(distinct, radius=radius, segments=segments, block=block))
    return marked.join(joined.withColumnRenamed("node", "fp"), "fp", "left").select(
        "doc_id", "text_hash", "fp", F.coalesce("component", "fp").alias("component")
    )


def near_duplicates(documents: DataFrame, **options) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row; options as of :func:`grouped`.

    Fingerprints within ``radius`` bits link; ``component_id`` is the smallest doc_id reachable,
    NULL only where all ids of a component are. Texts without words have fingerprint zero and link
    like any other. Rows with equal ids or texts are kept, each with its result. Other columns of
    ``documents`` are not read. An empty table gives an empty result.
    """
    rows = kept(grouped(documents, **options), "groups")
    lowest = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return rows.join(lowest, "component").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(documents: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest id.

    Among equal ids the smaller text hash stays, NULL ids come last, and of rows with equal id and
    text one stays.
    """
    rows = grouped(documents, key=key, text=text, **options)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")).alias("first")
    first = rows.groupBy("component").agg(first).select(F.col("first.doc_id").alias("own_id"), F.col("first.text_hash").alias("own_hash"))
    marked = documents.select(
        F.struct("*").alias("row"), F.col(key).cast("long").alias("row_id"),
        F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("row_hash"),
    )
    same = F.col("row_id").eqNullSafe(F.col("own_id")) & (F.col("row_hash") == F.col("own_hash"))
    chosen = marked.join(first.distinct(), same, "left_semi")
    return chosen.dropDuplicates(["row_id", "row_hash"]).select("row.*")
